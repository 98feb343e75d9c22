"""Files that many tasks read, and registered sources."""

import json
import random

import pytest

from landquill.operators import knn
from landquill.sources import config, features, sinks, tables


def _collection(rng, n):
    text = lambda: "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "a", "区", "\n", '\\"']) for _ in range(rng.randrange(12)))
    rows = []
    for i in range(n):
        props = {text(): text() for _ in range(rng.randrange(3))} | {"L01_001": "13", "L01_002": str(i % 3), "L01_003": str(i % 4), "L01_008": i, "L01_051": text()}
        geometry = rng.choice([None, {"type": "Polygon", "coordinates": [[[1.0, 2.0], [3.0, 4.0]]]}] + 4 * [{"type": "Point", "coordinates": [139.0 + i, 35.0]}])
        items = list({"type": "Feature", "geometry": geometry, "properties": rng.choice([None] + 5 * [props])}.items())
        rng.shuffle(items)
        rows.append(dict(items))
    return {"crs": {"type": "name", "properties": {"name": text()}}, "bbox": [1, 2], "features": rows, "tail": [text()]}


@pytest.mark.parametrize("split_bytes", [97, 1000, features.SPLIT_BYTES])
def test_features_are_the_same_however_files_are_split(spark, tmp_path, split_bytes):
    rng, want = random.Random(split_bytes), []
    for name, n, style in [("a.geojson", 9, {}), ("b.geojson", 12, {"indent": 1}), ("c.geojson", 0, {}), ("d.geojson", 6, {"ensure_ascii": False})]:
        whole = _collection(rng, n)
        (tmp_path / name).write_text(json.dumps(whole, **style), encoding="utf-8")
        for f in whole["features"]:
            if f["properties"] and f["geometry"] and f["geometry"]["type"] == "Point":
                own = f["properties"]
                want.append((f"13-{own['L01_002']}-{own['L01_003']:0>3}", f["geometry"]["coordinates"][0], float(own["L01_008"]), own["L01_051"]))
    (tmp_path / "e.geojson").write_bytes(b"")
    points = tables.read_points(spark, str(tmp_path), split_bytes=split_bytes)
    got = [(r["base_id"], r["lon"], r["price"], r["kind"]) for r in points.orderBy("pos").collect()]
    assert got == want and len(want) > 8
    ids, seen = [], {}
    for base, *_ in want:
        seen[base] = seen.get(base, 0) + 1
        ids.append(base if seen[base] == 1 else f"{base}#{seen[base]}")
    assert [r["point_id"] for r in knn.unique_ids(points, "base_id", "pos").orderBy("pos").collect()] == ids


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(json.dumps(_collection(random.Random(1), 400)), encoding="utf-8")
    tasks = features.read_features(spark, str(tmp_path), tables.FEATURE, 4096).selectExpr("spark_partition_id() AS p", "pos").distinct()
    assert tasks.select("p").distinct().count() > 3 and tasks.select("pos").count() >= 400


@pytest.mark.parametrize("before", [0, 1, 2, 3])
def test_quotes_behind_backslashes(before):
    raw = b'"a' + b"\\\\" * 2 + b'"{' + b'"\\"}"}'
    at, step, quotes = features.marks(b'"' + raw, before)
    kept = [0] if before % 2 == 0 else []
    assert [x for x in at.tolist() if x == 0] == kept
    assert [raw[x - 1 : x] for x, s in zip(at.tolist(), step.tolist()) if s] == [b"{", b"}", b"}"]


def test_overrides_from_files(spark, tmp_path):
    (tmp_path / "_note").write_text("[")
    (tmp_path / "a.yaml").write_text(
        """
1301:
  本社: 東京都港区
  空: []
  工場他:
  - &x {name: A, address: a, area_m2: 10, area_m2_note: " n "}
  - {name: B, address: b, area_m2: "2.5", book_value_yen: 7, area_m2_is_estimated: true, area_m2_source: s}
  - {name: C, area_m2: 1}
  - {name: D, address: d, area_m2: -1}
  - {name: E, address: e, area_m2: 1, area_m2_is_estimated: true, area_m2_source: " "}
  - text
  - {name: F, address: f, area_m2: many}
  番号: 12
1302: only text
1303: {x: old}
""",
        encoding="utf-8",
    )
    (tmp_path / "b.yaml").write_text("1303: {x: new}\n", encoding="utf-8")
    (tmp_path / "c.yaml").write_text("", encoding="utf-8")
    (tmp_path / "d.yaml").write_text("- a list\n", encoding="utf-8")
    rows = tables.read_overrides(spark, str(tmp_path))
    plain, splits = config.accepted_overrides(rows)
    assert {tuple(r) for r in plain.collect()} == {("1301", "本社", "東京都港区"), ("1301", "番号", "12"), ("1303", "x", "new")}
    assert {tuple(r) for r in splits.collect()} == {("1301", "工場他", 0, "A", "a", 10.0, None), ("1301", "工場他", 1, "B", "b", 2.5, 7.0)}
    bad = {(r["code"], r["site_name"], r["pos"]): r["reason"] for r in rows.filter("reason IS NOT NULL").collect()}
    assert bad == {
        ("1301", "空", None): "no splits", ("1301", "工場他", 2): "missing address", ("1301", "工場他", 3): "negative area", ("1301", "工場他", 4): "estimated area without a source",
        ("1301", "工場他", 5): "not a mapping", ("1301", "工場他", 6): "not a number", ("1302", None, None): "not a mapping",
    }
    notes = rows.filter("pos < 2").orderBy("pos").select("estimated", "source", "note").collect()
    assert [tuple(r) for r in notes] == [(False, None, "n"), (True, "s", None)]


def test_prices_from_files(spark, tmp_path):
    (tmp_path / "p.yaml").write_text("'1': {本社: 1000, x: many}\n2: {y: '5'}\n", encoding="utf-8")
    rows = tables.read_overrides(spark, str(tmp_path / "p.yaml"), "prices").select("code", "site_name", "unit_price", "reason").collect()
    assert {tuple(r) for r in rows} == {("1", "本社", 1000, None), ("1", "x", None, "not a number"), ("2", "y", 5, None)}


def test_sources_have_a_partition_for_each_file(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.yaml").write_text(f"{k}: {{s: a}}\n")
    spark.dataSource.register(config.OverrideSource)
    assert spark.read.format("overrides").load(str(tmp_path)).rdd.getNumPartitions() == 3


def test_csv_in_no_known_encoding_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(b"a\n\xff\x81\x20\n")
    with pytest.raises(Exception, match="decodes"):
        tables.read_mixed_csv(spark, str(tmp_path), ["a"]).collect()


def test_outputs_that_are_missing_or_break_the_contract_are_not_valid(spark):
    rows, codes = spark.createDataFrame([("1", 1), ("1", 2)], "code string, v int"), spark.createDataFrame([("1",), ("2",), ("2",)], "code string")
    assert {tuple(r) for r in sinks.valid_outputs(rows, ["code", "v"], codes).collect()} == {("1", True), ("2", False)}
    assert {tuple(r) for r in sinks.valid_outputs(rows, ["code", "w"], codes).collect()} == {("1", False), ("2", False)}
