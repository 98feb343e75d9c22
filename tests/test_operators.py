"""Operators on small tables."""

import datetime
import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from landquill.operators import filings, geocode, knn, master, ranking, sites, web
from landquill.plans import run
from landquill.shared import checkpointed
from landquill.sources import sinks, tables
from landquill.streaming.ingest import current, ingest

POINTS = [("13-101-001", 35.68, 139.77, 1000000, "1住居"), ("13-101-002", 35.69, 139.78, 2000000, "商業"), ("13-101-003", 35.70, 139.79, 3000000, "商業")]


def geo_points(spark):
    from landquill.functions.geo import plane_xy

    df = spark.createDataFrame(POINTS, "point_id string, lat double, lon double, price long, kind string").withColumn("_p", plane_xy(F.col("lat"), F.col("lon")))
    return df.select("point_id", F.col("_p.x").alias("x"), F.col("_p.y").alias("y"), "lat", "lon", "price", "kind")


def geo_queries(spark, *rows):
    from landquill.functions.geo import plane_xy

    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "query_id int, lat double, lon double").withColumn("_p", plane_xy(F.col("lat"), F.col("lon")))
    return df.select("query_id", F.col("_p.x").alias("x"), F.col("_p.y").alias("y"), "lat", "lon", F.lit("").alias("scope"))


def test_geodesic_nearest(spark):
    points = geo_points(spark).withColumn("scope", F.lit(""))
    got = knn.geodesic_knn_join(geo_queries(spark, (35.6801, 139.7701), (35.6901, 139.7801)), points, 1).orderBy("query_id").collect()
    assert [(r["point_id"], r["price"]) for r in got] == [("13-101-001", 1000000), ("13-101-002", 2000000)]


def test_idw(spark):
    points = geo_points(spark).withColumn("scope", F.lit(""))
    near = lambda k: knn.idw(knn.geodesic_knn_join(geo_queries(spark, (35.685, 139.775)), points, k)).first()
    assert 1000000 < near(2)["unit_price"] < 2000000
    assert near(1)["unit_price"] in (1000000, 2000000) and near(1)["variance"] == 0.0


def test_unknown_scope_falls_back_to_all(spark):
    scoped = knn.with_scopes(geo_points(spark))
    q = geo_queries(spark, (35.6801, 139.7701)).drop("scope").withColumn("family", F.lit("工業"))
    assert knn.nearest_with_fallback(q, scoped).first()["point_id"] == "13-101-001"
    q = q.withColumn("family", F.lit("商業系"))
    assert knn.nearest_with_fallback(q, scoped, far=5000.0).first()["point_id"] == "13-101-002"
    assert knn.nearest_with_fallback(q, scoped, far=10.0).first()["point_id"] == "13-101-001"


@pytest.mark.parametrize("strategy", ["broadcast", "tree"])
def test_knn_matches_brute_force(spark, strategy):
    rng = random.Random(3)
    pts = [(f"p{i:03}", float(rng.randrange(100)) if i % 3 else 50.0, float(rng.randrange(100)) if i % 3 else 50.0, "" if i % 2 else "a") for i in range(120)]
    qs = [(i, float(rng.randrange(-500, 600)), float(rng.randrange(100)), "" if i % 2 else "a") for i in range(60)] + [(900, None, 1.0, "")]
    got = knn.knn_join(spark.createDataFrame(qs, "query_id int, x double, y double, scope string"), spark.createDataFrame(pts, "point_id string, x double, y double, scope string"), 4, strategy=strategy)
    want = set()
    for q, x, y, s in qs[:-1]:
        best = sorted((((x - a) ** 2 + (y - b) ** 2) ** 0.5, p) for p, a, b, t in pts if t == s)[:4]
        want |= {(q, k + 1, p) for k, (_, p) in enumerate(best)}
    assert {(r["query_id"], r["rank"], r["point_id"]) for r in got.collect()} == want


def test_knn_without_points(spark):
    q = spark.createDataFrame([(1, 0.0, 0.0, "")], "query_id int, x double, y double, scope string")
    p = spark.createDataFrame([], "point_id string, x double, y double, scope string")
    assert knn.knn_join(q, p, 2).count() == 0 and knn.knn_join(q, p, 2, strategy="tree").count() == 0


def test_duplicate_ids_and_attributes(spark):
    p = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "")], "base string, pos int, kind string")
    u = knn.unique_ids(p, "base", "pos")
    assert sorted(r["point_id"] for r in u.collect()) == ["a", "a#2", "b"]
    ids = spark.createDataFrame([("a#2",), ("zz",)], "point_id string")
    assert {r["point_id"]: r["kind"] for r in knn.point_attribute(ids, u.select("point_id", "kind")).collect()} == {"a#2": "y", "zz": ""}


def test_conflation(spark):
    a = spark.createDataFrame([("a1", 35.123451, 139.0), ("a2", 35.2, 139.0)], "point_id string, lat double, lon double")
    b = spark.createDataFrame([("b1", 35.123452, 139.0), ("b2", 35.123461, 139.0), ("b3", 35.2, 139.0)], "point_id string, lat double, lon double")
    m = knn.conflate(a, b)
    assert sorted(r["point_id"] for r in m.collect()) == ["a1", "a2", "b2"]
    assert tuple(knn.conflation_counts(a, b, m).first()) == (2, 3, 1, 2, 3)


TOWNS = [("東京都", "中央区", "日本橋兜町", "35.670001", "139.770001"), ("東京都", "港区", "六本木三丁目", "35.660001", "139.730001"), ("東京都", "千代田区", "五番町", "35.689685", "139.733989"), ("東京都", "千代田区", "二番町", "35.686185", "139.736126"), ("東京都", "東村山市", "本町", "35.75", "139.47")]
BLOCKS = [("東京都", "中央区", "日本橋兜町", "11", "1", "1", "35.680001", "139.780001"), ("東京都", "中央区", "日本橋兜町", "11", "0", "1", "35.0", "139.0"), ("東京都", "港区", "六本木三丁目", "4", "1", "1", "35.665001", "139.735001"), ("東京都", "千代田区", "五番町", "4", "1", "1", "35.689856", "139.734955"), ("東京都", "千代田区", "二番町", "3", "1", "x", "35.685929", "139.737800"), ("大阪府", "北区", "梅田", "1", "1", "1", "34.7", "135.5")]


def test_geocode(spark):
    t = spark.createDataFrame(TOWNS, "pref string, muni string, town string, lat string, lon string")
    b = spark.createDataFrame(BLOCKS, "pref string, muni string, town string, block string, rep_flag string, addr_flag string, lat string, lon string")
    want = {
        "東京都中央区日本橋兜町11番5号": ("gaiku", 35.680001), "東京都中央区日本橋兜町11-5": ("gaiku", 35.680001), "東京都中央区日本橋兜町": ("oaza_chome", 35.670001), "東京都港区六本木3-4-33": ("gaiku", 35.665001),
        "東京都千代田区五番町4番7号": ("gaiku", 35.689856), "東京都千代田区二番町": ("oaza_chome", 35.686185), "東京都千代田区二番町3番地": ("gaiku", 35.685929), "東京都港区芝1-2": ("muni_centroid", 35.660001), "大阪府大阪市北区": (None, None), "東京都東村山市本町": (None, None),
    }
    rows = spark.createDataFrame([(k,) for k in want], "address string")
    index = (geocode.block_index(b), geocode.town_index(t), geocode.centroid_index(t))
    assert {r["address"]: (r["level"], r["lat"]) for r in geocode.geocode(rows, *index).collect()} == want
    full = {r["address"]: r["level"] for r in geocode.geocode(rows, *index, muni_match="dimension").collect()}
    assert full["東京都東村山市本町"] == "oaza_chome" and full["東京都中央区日本橋兜町11-5"] == "gaiku" and full["大阪府大阪市北区"] is None


SITE = "code string, site_name string, seq long, area double, book double, equipment string, has_hoka boolean"
SPLIT = "code string, site_name string, pos int, name string, address string, area double, book double"


@pytest.mark.parametrize("books, want", [((None, None), (500e6, 2200e6)), ((1e9, 1.7e9), (1e9, 1.7e9)), ((1e9, None), (1e9, 1.7e9))])
def test_split_allocation(spark, books, want):
    s = spark.createDataFrame([("1", "本社他", 1, 20000.0, 2.0e9, "事務所", True), ("1", "本社他", 2, 7000.0, 0.7e9, "x", False), ("1", "工場", 3, 5.0, 6.0, "工場", False)], SITE)
    p = spark.createDataFrame([("1", "本社他", 0, "A", "a", 5000.0, books[0]), ("1", "本社他", 1, "B", "b", 22000.0, books[1]), ("1", "無い", 0, "C", "c", 1.0, None)], SPLIT)
    rows = {r["site_name"]: r for r in sites.expand_splits(s, p).collect()}
    assert set(rows) == {"A", "B", "工場"} and (rows["A"]["book"], rows["B"]["book"]) == pytest.approx(want)
    assert rows["A"]["equipment"] == "" and rows["A"]["has_hoka"] is False and rows["工場"]["equipment"] == "工場"
    over = spark.createDataFrame([("1", "本社他", "o"), ("1", "工場", "f")], "code string, site_name string, address string")
    assert {(r["site_name"], r["address"]) for r in sites.flat_overrides(over, p).collect()} == {("工場", "f"), ("A", "a"), ("B", "b"), ("C", "c")}


def test_split_books_above_the_total_are_rejected(spark):
    s = spark.createDataFrame([("1", "本社他", 1, 10.0, 100.0, "", False)], SITE)
    p = spark.createDataFrame([("1", "本社他", 0, "A", "a", 5.0, 150.0), ("1", "本社他", 1, "B", "b", 5.0, None)], SPLIT)
    assert all(r["reject_reason"] for r in sites.expand_splits(s, p).collect())


def test_totals_keep_companies_without_sites(spark):
    c = spark.createDataFrame([("1", 1000), ("2", None)], "code string, market_cap long")
    v = spark.createDataFrame([("1", 300, 100.4, 300.5)], "code string, est long, book double, est_raw double")
    got = {r["code"]: r for r in sites.company_totals(c, v).collect()}
    assert (got["1"]["est"], got["1"]["book"], got["1"]["gain"]) == (300, 100, 200) and got["2"]["n_sites"] == 0 and got["2"]["multiple"] is None


def test_names_caps_and_prices(spark):
    t = spark.createDataFrame([("1", "甲", 111, 5), ("2", "2", None, 10), ("3", " ", None, 1)], "code string, company_name string, market_cap long, shares long")
    m = spark.createDataFrame([("2", "乙"), ("1", "別"), ("3", "3")], "code string, company_name string")
    assert {r["code"]: r["company_name"] for r in master.resolve_names(t, m).collect()} == {"1": "甲", "2": "乙", "3": None}
    d = lambda day: datetime.datetime(2024, 1, day)
    p = spark.createDataFrame([("2", d(1), 5.0), ("2", d(9), 7.0), ("2", d(12), 99.0), ("3", d(2), 4.0)], "code string, date timestamp, close double")
    caps = {r["code"]: r["market_cap"] for r in master.market_caps(t, p, F.lit(d(10))).collect()}
    assert caps == {"1": 111, "2": 70, "3": None}


def test_patches(spark):
    s = "code string, site_name string, address string"
    merged, effect = master.merge_patches(spark.createDataFrame([("1", "a", "x"), ("1", "b", "y")], s), spark.createDataFrame([("1", "a", "x"), ("1", "b", "z"), ("2", "c", "w"), ("3", "d", " ")], s))
    assert {(r["code"], r["site_name"], r["address"]) for r in merged.collect()} == {("1", "a", "x"), ("1", "b", "z"), ("2", "c", "w")}
    assert {(r["site_name"], r["effect"]) for r in effect.collect()} == {("a", "unchanged"), ("b", "updated"), ("c", "added"), ("d", "error")}


def test_ranking(spark):
    rows = spark.createDataFrame([("1000", 1, 0.1, 1), ("1000", 0, 0.9, 0), ("2000", 0, 0.3, 0), ("2000", 0, 0.2, 1), ("3000", 1, None, 0), ("4000", 1, 0.0, 0)], "code string, is_total int, ratio double, seq int")
    got = ranking.ranked(ranking.representative_rows(rows)).orderBy("rank").collect()
    assert [(r["rank"], r["code"], r["ratio"]) for r in got] == [(1, "2000", 0.3), (2, "1000", 0.1), (3, "4000", 0.0)]
    tags = spark.createDataFrame([("1", 2, "b|c"), ("1", 1, " a "), ("1", 3, ""), ("1", 4, "a")], "code string, seq int, tag string")
    tags = tags.unionByName(spark.createDataFrame([("2", 1, None)], tags.schema))
    assert {tuple(r) for r in ranking.ordered_distinct(tags, "tag", "tags").collect()} == {("1", "a / b / c"), ("2", "")}
    assert tags.filter("code = '1'").agg(ranking.count_filled("tag")).first()[0] == 2


def cells(spark, *grids):
    rows = [(d, 0, r, c, txt) for d, grid in enumerate(grids) for r, row in enumerate(grid) for c, txt in enumerate(row)]
    return spark.createDataFrame(rows, "doc_id int, table_idx int, r int, c int, txt string")


LAYOUTS = [
    ([["名称", "所在地", "年間賃借料(百万円)"], ["本社", "東京都港区", "30"]], []),
    ([["事業所名\n(所在地)", "土地\n帳簿価額(百万円)(面積㎡)"], ["本社\n(東京都江東区)", "407(190.1)"]], [("本社", "東京都江東区", 190.1, 407e6)]),
    ([["名称", "所在地", "土地", None], [None, None, "面積(㎡)", "帳簿価額(百万円)"], ["山王パークタワー", "東京都千代田区", "12,980", "132,222"], ["別館", "東京都港区", "10", "5"]], [("山王パークタワー", "東京都千代田区", 12980.0, 132222e6), ("別館", "東京都港区", 10.0, 5e6)]),
    ([["名称", "所在地", "帳簿価額(百万円)", None, "面積(㎡)"], [None, None, "建物", "土地", "土地"], ["Shibuya SakuraStage", "東京都渋谷区", "1", "72,118", "16,970"]], [("Shibuya SakuraStage", "東京都渋谷区", 16970.0, 72118e6)]),
    ([["会社名", "事業所名\n(所在地)", "土地(千円)\n(面積千㎡)"], ["甲社", "① 賃貸用", "5(6)"], ["甲社", "工場\n(東京都大田区)他", "※1 1,000(2)"], ["", "合計", "1(2)"]], [("工場", "東京都大田区", 2000.0, 1e6)]),
]


@pytest.mark.parametrize("grid, want", LAYOUTS)
def test_layouts(spark, grid, want):
    found, _ = filings.facilities(cells(spark, grid))
    assert sorted((r["site_name"], r["location"], r["area"], r["book"]) for r in found.collect()) == sorted(want)


def test_missing_area_goes_to_diagnostics(spark):
    grid = [["事業所名\n(所在地)", "土地\n帳簿価額(百万円)(面積㎡)"], ["本社\n(東京都江東区)", "407"]]
    found, missing = filings.facilities(cells(spark, grid))
    assert found.count() == 0 and missing.first()["site_name"] == "本社"


def test_filing_html_with_spans_and_a_continuation(spark):
    html = (
        "<table><tr><td rowspan=2>事業所名</td><td rowspan=2>所在地</td><td colspan=2>土地</td></tr><tr><td>面積(㎡)</td><td>帳簿価額(百万円)</td></tr>"
        "<tr><td>日本橋室町</td><td>東京都中央区</td><td>10,255</td><td>108,443</td></tr><tr><td></td><td></td><td>(注)</td><td></td></tr></table>"
    )
    docs = spark.createDataFrame([("d", html), ("e", None), ("f", "<p>no table</p>")], "doc string, html string")
    grid = filings.table_cells(docs, "doc", "html")
    assert {(r["r"], r["c"]) for r in grid.filter("txt IS NULL").collect()} == {(1, 0), (1, 1), (0, 3)}
    found, _ = filings.facilities(filings.merge_continuations(grid))
    assert [(r["site_name"], r["location"], r["area"], r["book"]) for r in found.collect()] == [("日本橋室町", "東京都中央区", 10255.0, 108443e6)]


def test_head_office_rule(spark):
    df = spark.createDataFrame([("本社欄に記載の土地は\n各所に所在している",), ("普通",), (None,)], "s string")
    assert [r[0] for r in df.select(filings.skips_head_office(F.col("s"))).collect()] == [True, False, False]


def test_targets(spark, tmp_path):
    with_head, bare, legacy = tmp_path / "a.csv", tmp_path / "b.csv", tmp_path / "c.csv"
    with_head.write_text("code,company_name,address_source_urls,market_cap\n1911,甲,http://a| |http://b,\"1,000\"\n,x,,\n", encoding="utf-8")
    bare.write_text("130A\n\n7203,トヨタ\n", encoding="utf-8")
    legacy.write_text("code,report_url\n1,x\n", encoding="utf-8")
    assert [tuple(r) for r in tables.read_targets(spark, str(with_head)).collect()] == [("1911", "甲", 1000, ["http://a", "http://b"])]
    assert [r["code"] for r in tables.read_targets(spark, str(bare)).collect()] == ["130A", "7203"]
    with pytest.raises(ValueError):
        tables.read_targets(spark, str(legacy))


def test_encodings(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("会社名\nテスト\n".encode("cp932"))
    (tmp_path / "y.csv").write_bytes("会社名\nテスト二\n".encode("utf-8-sig"))
    assert tables.read_csv(spark, str(tmp_path / "x.csv"), "windows-31j").first()["会社名"] == "テスト"
    assert {r["会社名"] for r in tables.read_mixed_csv(spark, str(tmp_path), ["会社名"]).collect()} == {"テスト", "テスト二"}


def test_geojson(spark, tmp_path):
    f = lambda geometry, props: {"type": "Feature", "geometry": geometry, "properties": props}
    point = {"type": "Point", "coordinates": [139.77, 35.68]}
    props = {"L01_001": "13", "L01_002": "101", "L01_003": "1", "L01_008": 1000000, "L01_051": "1住居"}
    path = tmp_path / "p.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [f(None, props), f(point, None), f(point, props), f(point, {**props, "L01_003": "1234", "L01_008": "x"})]}), encoding="utf-8")
    got = tables.read_points(spark, str(path)).orderBy("pos").collect()
    assert [(r["base_id"], r["lat"], r["price"], r["kind"]) for r in got] == [("13-101-001", 35.68, 1000000.0, "1住居"), ("13-101-1234", 35.68, 0.0, "1住居")]
    raw = path.read_bytes()
    assert [json.JSONDecoder().raw_decode(raw[r["pos"]["at"] :].decode())[0]["properties"]["L01_003"] for r in got] == ["1", "1234"]


def test_override_config(spark):
    plain, splits = tables.override_tables(spark, {"1": {"本社": "東京都港区", "工場他": [{"name": "A", "address": "a", "area_m2": 1}]}})
    assert plain.count() == 1 and splits.first()["area"] == 1.0
    for bad in ([], [{"name": "A", "address": "a"}], [{"name": "A", "address": "a", "area_m2": -1}], [{"name": "A", "address": "a", "area_m2": 1, "area_m2_is_estimated": True}]):
        with pytest.raises(ValueError):
            tables.override_tables(spark, {"1": {"x": bad}})


def test_sink_replaces_only_its_companies(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_by_company(spark.createDataFrame([("1", 1), ("2", 2)], "code string, v int"), path)
    sinks.write_by_company(spark.createDataFrame([("2", 5)], "code string, v int"), path)
    out = spark.read.schema("v int, code string").parquet(path)
    assert {(r["code"], r["v"]) for r in out.collect()} == {("1", 1), ("2", 5)}
    assert all(r["valid"] for r in sinks.valid_outputs(out, ["v"]).collect())


@pytest.mark.parametrize("k", [1, 3, 8])
def test_tree_of_clusters_outliers_and_far_queries(spark, k):
    rng = random.Random(k)
    pts = [(f"p{i:03}", 5e5 + rng.gauss(0, 3), 2e5 + rng.gauss(0, 3), "") for i in range(150)] + [(f"q{i:03}", rng.uniform(0, 1e6), rng.uniform(0, 1e6), "") for i in range(60)]
    pts += [("out", 1e8, -1e8, ""), *[(f"s{i}", 7.0, 7.0, "") for i in range(12)], ("a", 1.0, 1.0, "few"), ("b", 2.0, 2.0, "few")]
    qs = [(i, 5e5 + rng.gauss(0, 5), 2e5 + rng.gauss(0, 5), "") for i in range(40)] + [(100 + i, rng.uniform(-1e6, 2e6), rng.uniform(-1e6, 2e6), "") for i in range(20)]
    qs += [(200, 9e9, 9e9, ""), (201, -5e8, 0.0, ""), (202, 0.0, 0.0, "few"), (203, 1.0, 1.0, "none"), (204, 7.0, 7.0, ""), (205, None, 1.0, "")]
    got = knn.knn_join(spark.createDataFrame(qs, "query_id int, x double, y double, scope string"), spark.createDataFrame(pts, "point_id string, x double, y double, scope string"), k, strategy="tree")
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append(r["point_id"])
    for i, x, y, scope in qs:
        want = [] if x is None else [p for _, p in sorted((math.sqrt((x - a) * (x - a) + (y - b) * (y - b)), p) for p, a, b, s in pts if s == scope)[:k]]
        assert found.get(i, []) == want, i


def test_far_queries_and_small_scopes_meet_few_points(spark):
    rng = random.Random(5)
    pts = [(f"p{k:04}", rng.uniform(0, 1000), rng.uniform(0, 1000), "") for k in range(3000)] + [(f"s{k:03}", rng.uniform(0, 1000), rng.uniform(0, 1000), f"few{k // 3}") for k in range(300)]
    qs = [(k, rng.uniform(-9e5, -8e5), rng.uniform(-1e5, 1e5), "") for k in range(300)] + [(300 + k, rng.uniform(0, 1000), rng.uniform(0, 1000), "") for k in range(300)] + [(600 + k, rng.uniform(-1e6, 1e6), rng.uniform(-1e6, 1e6), f"few{k}") for k in range(100)]
    held = knn.point_tree(spark.createDataFrame(pts, "point_id string, x double, y double, scope string"), 3)
    spots = spark.createDataFrame(qs, "_q long, x double, y double, scope string")
    pairs = knn.met_pairs(spots, held, 3)
    met = {r["_q"]: r["count"] for r in pairs.groupBy("_q").count().collect()}
    mean = lambda a, b: sum(met[q] for q in range(a, b)) / (b - a)
    assert mean(0, 300) < 150 and mean(300, 600) < 100 and all(met[q] == 3 for q in range(600, 700))
    best = {(r["_q"], r["rank"]): r["point_id"] for r in knn._ranked(pairs, 3).collect()}
    for q, x, y, scope in qs:
        want = [p for _, p in sorted((math.sqrt((x - a) * (x - a) + (y - b) * (y - b)), p) for p, a, b, s in pts if s == scope)[:3]]
        assert [best[q, k] for k in (1, 2, 3)] == want


def test_nodes_behind_a_sure_one_are_left(spark):
    """Seen from a wide group far away only the near side of the points counts, though all nodes are about as far."""
    group = [("", 0, -1, 0.0, 10_000.0, 0.0, 10_000.0, float("inf"))]
    front = spark.createDataFrame(group, "gscope string, _group long, _one long, a0 double, a1 double, b0 double, b1 double, _u double")
    nodes = spark.createDataFrame([(c, 8, 1e6 + 100 * c, 1e6 + 100 * c + 90, 0.0, 90.0) for c in range(20)], "_child long, n long, x0 double, x1 double, y0 double, y1 double")
    assert sorted(r["_child"] for r in knn._bounded(front.crossJoin(nodes), 3, 1 + 1e-9).collect()) == [0]


def test_boxes_of_nodes_stay_small(spark):
    """Runs along the curve that don't begin at a power of two have small boxes too, so that a group meets few nodes however many there are (8.7 times the square of the extent on a curve with leaps)."""
    spots = spark.range(20_000).select(F.col("id").alias("_q"), (F.col("id") * 7919 % 10007).cast("double").alias("x"), (F.col("id") * 104729 % 9973).cast("double").alias("y"), F.lit("").alias("scope"))
    box = {"n": 20_000, "x0": 0.0, "x1": 10_006.0, "y0": 0.0, "y1": 9_972.0}
    rows, _ = knn._packed(spots, box, "scope", "x", "y", "_q", 24)
    wide = (F.max("x") - F.min("x")) ** 2 + (F.max("y") - F.min("y")) ** 2  # the square of a node's diagonal
    assert rows.groupBy("_node").agg(wide.alias("d")).agg(F.sum("d")).first()[0] < 4 * 10_006**2


@pytest.mark.parametrize(("width", "height"), [(3000, 2000), (700, 7000)])
def test_boxes_of_nodes_stay_small_in_oblong_extents(spark, width, height):
    """The curve doesn't leave the box of all rows, so no node is wide (at most 0.007 of the box as the square of a diagonal; 0.37 and 0.45 with leaps)."""
    spots = spark.range(20_000).select(F.col("id").alias("_q"), (F.col("id") * 7919 % 10007 / 10006 * width).alias("x"), (F.col("id") * 104729 % 9973 / 9972 * height).alias("y"), F.lit("").alias("scope"))
    box = spots.agg(F.count("*").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first().asDict()
    rows, _ = knn._packed(spots, box, "scope", "x", "y", "_q", 24)
    wide = (F.max("x") - F.min("x")) ** 2 + (F.max("y") - F.min("y")) ** 2
    assert rows.groupBy("_node").agg(wide.alias("d")).agg(F.max("d")).first()[0] < 0.02 * width * height


def test_groups_rank_their_points_and_send_no_pairs(spark):
    """The answers come ranked out of the groups, two rows of one id and place each with their own."""
    rng = random.Random(11)
    pts = [(f"p{k:04}", float(rng.randrange(300)), float(rng.randrange(300)), "") for k in range(2000)]
    qs = [(k // 2, float(k // 2 % 40) * 7, float(k // 2 % 23) * 11, "") for k in range(1400)]
    held = knn.point_tree(spark.createDataFrame(pts, "point_id string, x double, y double, scope string"), 3)
    got = knn.met_pairs(spark.createDataFrame(qs, "_q long, x double, y double, scope string"), held, 3).collect()
    assert len(got) == 3 * len(qs)
    want = {q: [p for _, p in sorted((math.sqrt((x - a) ** 2 + (y - b) ** 2), p) for p, a, b, _ in pts)[:3]] for q, x, y, _ in qs}
    assert all(want[r["_q"]][r["rank"] - 1] == r["point_id"] for r in got)


def _random_search(seed):
    rng = random.Random(seed)
    pts = [(f"p{k:04}", rng.uniform(0, 1000), rng.uniform(0, 1000), "") for k in range(6000)] + [(f"s{k:02}", rng.uniform(0, 1000), rng.uniform(0, 1000), f"few{k // 3}") for k in range(30)]
    qs = [(k, rng.uniform(0, 1000), rng.uniform(0, 1000), "") for k in range(200)] + [(200 + k, rng.uniform(-9e5, 9e5), 1e6, "") for k in range(50)] + [(250 + k, rng.uniform(0, 1000), 0.0, f"few{k}") for k in range(12)]
    want = {q: [p for _, p in sorted((math.sqrt((x - a) * (x - a) + (y - b) * (y - b)), p) for p, a, b, s in pts if s == scope)[:3]] for q, x, y, scope in qs}
    return pts, qs, want


def _found(spark, pts, qs):
    got = knn.knn_join(spark.createDataFrame(qs, "query_id long, x double, y double, scope string"), spark.createDataFrame(pts, "point_id string, x double, y double, scope string"), 3, strategy="tree")
    found = {q: [] for q, *_ in qs}
    for r in got.orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["point_id"])
    return found


def test_a_level_that_tasks_hold_is_met_without_a_shuffle(spark, monkeypatch):
    """No pair of a group and a node is in a window, whatever the number of levels above."""
    monkeypatch.setattr(knn, "_bounded", lambda *_: pytest.fail("a level went through a window"))
    monkeypatch.setattr(knn, "TOP", 4)
    pts, qs, want = _random_search(17)
    assert _found(spark, pts, qs) == want


@pytest.mark.parametrize(("held", "split", "group"), [(20, 2048, 64), (20, 3, 64), (1 << 16, 3, 64), (1, 2048, 64)])
def test_levels_below_the_held_one_and_single_queries(spark, monkeypatch, held, split, group):
    """The held level may lie above the leaves, or there may be none; wide groups go on as single queries."""
    for name, value in {"HELD_NODES": held, "SPLIT": split, "GROUP": group, "TOP": 4, "BLOCK": 8}.items():
        monkeypatch.setattr(knn, name, value, raising=False)
    pts, qs, want = _random_search(19)
    assert _found(spark, pts, qs) == want


def test_groups_share_the_points_they_meet(spark):
    """Groups of neighbouring queries are large enough that few points are sent for each query (2.7; 3.8 with groups of 512)."""
    pts = spark.range(20_000).select(F.col("id").cast("string").alias("point_id"), (F.col("id") * 7919 % 10007).cast("double").alias("x"), (F.col("id") * 104729 % 9973).cast("double").alias("y"), F.lit("").alias("scope"))
    spots = spark.range(60_000).select(F.col("id").alias("_q"), (F.col("id") * 15485863 % 10007).cast("double").alias("x"), (F.col("id") * 32452843 % 9973).cast("double").alias("y"), F.lit("").alias("scope"))
    seen = spark.sparkContext.accumulator(0)
    real = knn._comparer

    def counting(*args):
        compare = real(*args)

        def counted(points, queries):
            seen.add(points.num_rows)
            return compare(points, queries)

        return counted

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(knn, "_comparer", counting)
        assert knn.met_pairs(spots, knn.point_tree(pts, 1), 1).count() == 60_000
    assert seen.value < 3.2 * 60_000


def test_scopes_with_near_points_are_asked_once(spark):
    asked = []

    def join(queries, *args, **options):
        asked.append(queries.count())
        return knn.knn_join(queries, *args, **options)

    q = geo_queries(spark, (35.6801, 139.7701), (35.6901, 139.7801)).drop("scope").withColumn("family", F.lit("商業系"))
    scoped = knn.with_scopes(geo_points(spark))
    assert knn.nearest_with_fallback(q, scoped, far=5000.0, join=join).count() == 2 and asked == [2]
    asked.clear()
    got = {r["query_id"]: r["point_id"] for r in knn.nearest_with_fallback(q, scoped, far=100.0, join=join).collect()}
    assert got == {0: "13-101-001", 1: "13-101-002"} and asked == [2, 1]


def test_tables_that_grow_are_not_broadcast(spark):
    """However small their files are: orders in the splits, and what sites are joined with."""
    from landquill.plans.adapters import view

    sf = "/root/testdata/sf0.001"
    rows, split = view(spark, sf, "filed_sites"), view(spark, sf, "splits")
    made = sites.price_overridden(sites.with_address(sites.expand_splits(rows, split), view(spark, sf, "overrides")), view(spark, sf, "price_overrides"))
    for df in (split, made):
        assert "Broadcast" not in df._jdf.queryExecution().sparkPlan().toString()


def test_filings_prefer_public_documents(spark, tmp_path):
    for name in ("1/d1/XBRL/PublicDoc/b.htm", "1/d1/XBRL/PublicDoc/a.htm", "1/d1/XBRL/AuditDoc/c.htm", "2/e/x.html", "2/e/notes.txt"):
        (tmp_path / "f" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "f" / name).write_text(f"<p>{name}</p>")
    got = [(r["code"], r["doc_id"], r["seq"], r["html"]) for r in tables.read_filings(spark, str(tmp_path / "f")).orderBy("code", "seq").collect()]
    assert got == [("1", "d1", 1, "<p>1/d1/XBRL/PublicDoc/a.htm</p>"), ("1", "d1", 2, "<p>1/d1/XBRL/PublicDoc/b.htm</p>"), ("2", "e", 1, "<p>2/e/x.html</p>")]


def test_company_fingerprints_are_those_of_contents(spark, tmp_path):
    def marks(files):
        root = tmp_path / f"f{len(list(tmp_path.iterdir()))}"
        for name, text in files.items():
            (root / name).parent.mkdir(parents=True, exist_ok=True)
            (root / name).write_text(text)
        return {r["code"]: (r["n_files"], r["fingerprint"]) for r in tables.company_fingerprints(tables.filing_files(spark, str(root))).collect()}

    first = marks({"1/d/a.htm": "x", "1/d/b.htm": "y", "2/e/XBRL/PublicDoc/a.htm": "x", "2/e/XBRL/other.htm": "q"})
    assert first["1"] == marks({"1/d/c.htm": "y", "1/d/d.htm": "x"})["1"]  # other names and order
    assert first["1"] != marks({"1/d/a.htm": "x", "1/d/b.htm": "z"})["1"]  # another byte
    assert first["1"] != marks({"1/d/a.htm": "x", "1/d/b.htm": "y", "1/d/c.htm": "y"})["1"]  # one file twice
    assert first["2"] == marks({"2/e/a.htm": "x"})["2"]  # only public documents count
    assert marks({"code=1/doc_id=d/a.htm": "x", "code=1/doc_id=d/b.htm": "y"})["1"] == first["1"]  # folders with names of columns


def test_only_buckets_that_differ_are_joined(spark):
    old = spark.range(20_000).select(F.col("id").alias("code"), F.md5(F.col("id").cast("string")).alias("signature"))
    new = old.filter("code <> 7").withColumn("signature", F.when(F.col("code") == 11, "x").when(F.col("code") == 12, F.lit(None)).otherwise(F.col("signature"))).unionByName(spark.createDataFrame([(10**6, "n"), (None, "m")], "code long, signature string"))
    got = master.changed_keys_by_digest(old, new, buckets=512)
    assert {(r["code"], r["change"]) for r in got.collect()} == {(7, "deleted"), (11, "changed"), (12, "changed"), (10**6, "added"), (None, "added")}
    assert master.changed_keys_by_digest(old, old).count() == 0
    assert master.differing_buckets(master.bucket_digests(old, buckets=512), master.bucket_digests(new, buckets=512)).count() <= 5
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    full, semi = plan.index("Join FullOuter"), plan.index("Join LeftSemi")
    assert full < semi and plan.count("Join LeftSemi") >= 2  # below the join of keys, both sides are cut down to those buckets


def test_memos_by_company(spark, tmp_path):
    (tmp_path / "1911.md").write_text("# a\nb")
    assert [tuple(r) for r in tables.read_memos(spark, str(tmp_path)).collect()] == [("1911", "# a\nb")]


def test_tagged_blocks_and_their_text(spark):
    rented = "<table><tr><td rowspan=2>事業所名（所在地）</td><td colspan=2>帳簿価額（千円）</td></tr><tr><td>建物</td><td>合計</td></tr><tr><td>本社<br />（東京都渋谷区）</td><td>13,257</td><td>232,009</td></tr></table><p>賃借している設備があります。</p>"
    owned = "<table><tr><td>名称（所在地）</td><td>土地面積（㎡）</td><td>土地帳簿価額（百万円）</td></tr><tr><td>A<br>（東京都港区）</td><td>5</td><td>6</td></tr></table>"
    tag = lambda name, body: f'<ix:nonNumeric name="{name}">{body}</ix:nonNumeric>'
    docs = [("a", owned + tag("jpcrp_cor:MajorFacilitiesTextBlock", "<h3>設備&nbsp;の 状況</h3>" + rented)), ("b", tag("x:OtherTextBlock", owned) + tag("MajorFacilitiesTextBlock", tag("y:Inner", "x<br>y") + owned) + tag("MajorFacilitiesTextBlock", "z")), ("c", None)]
    parsed = filings.parsed_filings(spark.createDataFrame(docs, "doc string, html string"), "doc", "html", tagged=True)
    found, _ = filings.facilities(filings.merge_continuations(parsed.filter("table_idx >= 0")))
    assert [(r["doc_id"], r["site_name"], r["area"], r["book"]) for r in found.collect()] == [("b", "A", 5.0, 6e6)]
    texts = {r["doc_id"]: r["text"] for r in filings.section_texts(parsed).collect()}
    assert texts["a"].startswith("設備 の 状況\n事業所名") and texts["a"].endswith("賃借している設備があります。") and set(texts) == {"a", "b"}
    assert texts["b"].startswith("x\ny") and texts["b"].endswith("\n\nz")


def test_stream_takes_each_version_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    t = datetime.datetime(2024, 1, 1)
    rows = [("1", "d", 10, t), ("1", "d", 10, t), ("2", "e", 11, t)]
    schema = "code string, doc_id string, length long, modified timestamp"
    spark.createDataFrame(rows, schema).write.parquet(source)
    start = lambda: ingest(spark.readStream.schema(schema).parquet(source), lambda new: new, out, str(tmp_path / "ck"))
    start().awaitTermination(120)
    counts = lambda: {r["code"]: r["count"] for r in spark.read.parquet(out).groupBy("code").count().collect()}
    assert counts() == {"1": 1, "2": 1}
    # After a restart a filing copied in later with an old time still comes, a repeated one doesn't, and only the new one touches the state.
    spark.createDataFrame([("1", "old", 9, datetime.datetime(2020, 1, 1)), ("2", "e", 11, t), ("2", "e", 12, t), (None, "f", None, t), (None, "f", None, t)], schema).coalesce(1).write.mode("append").parquet(source)
    again = start()
    again.awaitTermination(120)
    assert counts() == {"1": 2, "2": 2, None: 1}
    assert sum(s["numRowsUpdated"] for p in again.recentProgress for s in p["stateOperators"]) == 3
    newest = {(r["code"], r["doc_id"]): r["length"] for r in current(spark.read.parquet(out)).collect()}
    assert newest == {("1", "d"): 10, ("1", "old"): 9, ("2", "e"): 12, (None, "f"): None}
    start().awaitTermination(120)
    assert counts() == {"1": 2, "2": 2, None: 1}


def test_running_and_ranked_keep_columns_of_any_name(spark):
    rows = [(k, float(k % 4), 5 + k, 6 + k, 7 + k, 8 + k, 9 + k) for k in range(30)]
    df = spark.createDataFrame(rows, "code long, ratio double, _range long, _r long, rank long, _add_rank long, _own_rank long")
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    got = {r["code"]: r for r in ranking.ranked(df).collect()}
    assert [got[r[0]]["rank"] for r in want] == list(range(1, 31))
    assert all((got[r[0]]["_range"], got[r[0]]["_r"], got[r[0]]["_add_rank"], got[r[0]]["_own_rank"]) == (r[2], r[3], r[5], r[6]) for r in rows)


@pytest.fixture(scope="module")
def small_run(spark):
    """Inputs of a run in which each reason occurs."""
    targets = spark.createDataFrame([("1", "A", 100), ("2", " ", 100), ("3", "C", 100), ("4", "D", None), ("5", "E", 100)], "code string, company_name string, market_cap long").withColumn("source_urls", F.array(F.concat(F.lit("p/"), "code")))
    filed = spark.createDataFrame([("1",), ("2",), ("4",), ("5",), ("9",)], "code string")
    where = "東京都港区六本木3丁目5番"
    rows = [("1", "S", where), ("1", "T", "大阪府大阪市"), ("1", "U", "東京都青梅市"), ("1", "V", where), ("1", "W", "東京都港区"), ("1", "X", None), ("2", "S", where), ("3", "S", where), ("4", "S", where), ("9", "S", where)]
    sites_ = spark.createDataFrame([(c, n, k, 10.0, 5.0, "工場", False, a) for k, (c, n, a) in enumerate(rows)], "code string, site_name string, seq long, area double, book double, equipment string, has_hoka boolean, location string")
    splits = spark.createDataFrame([("1", "V", 0, "V0", where, 4.0, 9.0), ("1", "V", 1, "V1", where, 6.0, None)], "code string, site_name string, pos int, name string, address string, area double, book double")
    overrides = spark.createDataFrame([], "code string, site_name string, address string")
    prices = spark.createDataFrame([], "code string, site_name string, unit_price long")
    blocks = spark.createDataFrame([("港区", "六本木3丁目", "5", 35.66, 139.73), ("港区", "六本木3丁目", "9", 35.67, 139.74)], "muni string, town string, block string, lat double, lon double")
    towns = spark.createDataFrame([("港区", "六本木3丁目", 35.66, 139.73)], "muni string, town string, lat double, lon double")
    centroids = spark.createDataFrame([("港区", 35.65, 139.75)], "muni string, lat double, lon double")
    return targets, [sites_, overrides, splits, prices, blocks, towns, centroids], filed


def test_splits_of_a_run_are_made_once(spark, small_run):
    targets, (sites_, overrides, splits, *rest), _ = small_run
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(name):
        made.add(1)
        return name

    n = splits.count()
    counted = splits.withColumn("name", seen.asNondeterministic()("name"))
    run.site_reasons(run.company_reasons(targets), sites_, overrides, counted, *rest).collect()
    assert made.value == n


def test_every_row_of_a_run_has_one_outcome(spark, small_run):
    targets, inputs, filed = small_run
    traced = run.trace(targets, *inputs, filings=filed)
    bad = {(r["stage"], r["code"], r["site_name"], r["reason"]) for r in run.rejects(traced).collect()}
    assert bad == {
        ("company", "2", None, run.NO_NAME), ("company", "3", None, run.NO_FILING), ("company", "4", None, run.NO_MARKET_VALUE), ("company", "2", "S", run.NO_NAME), ("company", "3", "S", run.NO_FILING), ("company", "4", "S", run.NO_MARKET_VALUE),
        ("company", "9", "S", run.NO_TARGET), ("region", "1", "T", run.ELSEWHERE), ("region", "1", "X", run.ELSEWHERE), ("geocode", "1", "U", run.UNRESOLVED), ("split", "1", "V0", run.OVER_ALLOCATED), ("split", "1", "V1", run.OVER_ALLOCATED),
    }
    kept = {r["site_name"] for r in traced.sites.filter("reason IS NULL").collect()}
    assert kept == {"S", "W"}
    counted = {(r["item"], r["stage"], r["reason"]): r["n"] for r in run.report(traced).collect()}
    assert counted[("company", "", "")] == 2 and counted[("site", "", "")] == 2 and counted[("site", "split", run.OVER_ALLOCATED)] == 2
    assert sum(n for (item, _, _), n in counted.items() if item == "site") == 11 == traced.sites.count()
    nothing = run.trace(targets.limit(0), *[x.limit(0) for x in inputs])
    assert run.rejects(nothing).count() == 0 and run.report(nothing).count() == 0


def test_price_methods_and_web_addresses_of_a_run(spark, small_run):
    targets, inputs, _ = small_run
    points = spark.createDataFrame([("a", 35.66, 139.7301, 100, "工業"), ("b", 35.66, 139.7302, 300, "商業"), ("c", 35.661, 139.73, 500, "商業"), ("d", 35.67, 139.74, 700, "商業")], "point_id string, lat double, lon double, price long, kind string")
    good = run.company_reasons(targets).filter("reason IS NULL").drop("reason")
    pages = spark.createDataFrame([("p/1", "S の 東京都港区六本木3丁目9番 です")], "url string, text string")
    every = checkpointed(run.site_reasons(good.filter("code = '1'"), *inputs, pages).filter("reason IS NULL"))
    found = {r["site_name"]: r for r in every.collect()}["S"]
    assert (found["address_source"], found["address"], found["address_source_url"], found["lat"]) == ("web", "東京都港区六本木3丁目9番", "p/1", 35.67)
    of = lambda **o: {r["site_name"]: r for r in run.valued(every, points, **o).collect()}
    near = of(price_method="nearest")["S"]
    assert (near["method"], near["target_kind"], near["knn_ids"], near["unit_price"]) == ("nearest+landuse_match", "工業", ["a"], 100)
    free = of(landuse_match=False)["S"]
    assert (free["method"], free["target_kind"], free["knn_ids"]) == ("idw(k=3,p=3)", "", ["d", "c", "b"])
    with pytest.raises(ValueError):
        of(price_method="mean")


def _exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_sites_and_splits_of_a_run_are_sent_once(spark, small_run, monkeypatch):
    targets, inputs, _ = small_run
    written = []
    monkeypatch.setattr(run, "stored", lambda df: written.append(_exchanges(df)) or checkpointed(df))
    pages = spark.createDataFrame([("p/1", "S の 東京都港区六本木3丁目9番 です")], "url string, text string")
    run.site_reasons(run.company_reasons(targets), *inputs, pages)
    # rows by code, companies by code, their pages by url from either side, and found pages by code
    assert len(written) == 1 and len(written[0]) == 5
    run.site_reasons(run.company_reasons(targets), *inputs)
    assert len(written) == 2 and len(written[1]) == 2


def test_numbered_inputs_make_their_texts_after_the_shuffle(spark):
    from landquill.plans.adapters import view

    plan = view(spark, "/root/testdata/sf0.001", "splits")._jdf.queryExecution().executedPlan().toString()
    assert "concat(" in plan[: plan.index("Window")] and "concat(" not in plan[plan.index("Window") :]
    assert len(re.findall("Exchange hashpartitioning", plan)) == 3


def test_rows_sent_once_are_those_of_the_joins(spark):
    rng = random.Random(5)
    code, name = lambda: rng.choice(["1", "2", "3", None]), lambda: rng.choice([*"ABCDEF", None])
    of = lambda n, *fs: [tuple(f() for f in fs) for _ in range(n)]
    amount = lambda: rng.choice([None, 0.0, 1.0, 2.0, 8.0])
    seqs, places = iter(range(1000)), iter(range(1000))
    s = spark.createDataFrame(of(40, code, name, lambda: next(seqs), amount, amount, lambda: rng.choice(["工場", None]), lambda: rng.choice([True, False, None]), lambda: rng.choice(["x", "y", None])), "code string, site_name string, seq long, area double, book double, equipment string, has_hoka boolean, location string")
    p = spark.createDataFrame(of(14, code, name, lambda: next(places), name, lambda: rng.choice(["p", "q", None]), amount, amount), "code string, site_name string, pos int, name string, address string, area double, book double")
    keys = {(c, n) for c, n in of(12, code, name)}
    over = spark.createDataFrame([(*k, rng.choice(["o", None])) for k in sorted(keys, key=repr)], "code string, site_name string, address string")
    prices = spark.createDataFrame([*[(*k, 7) for k in sorted(keys, key=repr)[::2]], ("1", "A", 8), ("1", "A", 9)], "code string, site_name string, unit_price long")
    flat = sites.flat_overrides(over, p).select("code", "site_name", F.col("address").alias("override"), F.lit(True).alias("overridden"))
    want = sites.price_overridden(sites.expand_splits(s, p), prices).join(flat, ["code", "site_name"], "left").fillna(False, "overridden")
    got = sites.filed_and_split(s, p, over, prices)
    assert set(got.columns) == set(want.columns)
    rows = sorted(want.collect(), key=repr)
    assert len(rows) > 20 and any(r["pos"] for r in rows) and any(r["override"] for r in rows) and any(r["override_price"] for r in rows)
    assert sorted(got.select(*want.columns).collect(), key=repr) == rows


def test_addresses_on_pages_of_companies(spark):
    pages = spark.createDataFrame([("a", "S の 東京都港区六本木3丁目9番 です\n東京都港区六本木3丁目5番"), ("b", "T 東京都中央区日本橋2-7-1 と 東京都港区六本木3丁目5番"), ("c", None), ("c", "S 東京都港区六本木1丁目1番"), ("d", "nothing")], "url string, text string")
    companies = spark.createDataFrame([("1", ["a", "b", "a"]), ("2", ["b", "c"]), ("3", ["d", None]), ("4", []), ("5", None)], "code string, source_urls array<string>")
    rows = [(c, n, a, h) for c in "12345" for n in ("S", "T", "S他", None) for a in ("東京都港区六本木", "東京都中央区", "", None) for h in (True, False, None)]
    s = spark.createDataFrame(rows, "code string, site_name string, location string, has_hoka boolean").join(companies, "code")
    keys = ["code", "site_name", "location", "has_hoka"]
    want = web.best_addresses(s, pages).filter("accepted").select(*keys, F.col("address").alias("web"), F.col("source_url").alias("url")).collect()
    got = web.accepted_address(s.join(web.company_pages(companies, pages), "code", "left"), F.lit(True)).filter("web IS NOT NULL").select(*keys, "web", "url")
    assert len(want) > 5 and sorted(got.collect(), key=repr) == sorted(want, key=repr)


def test_repeated_addresses_are_those_of_sites_that_go_on(spark, small_run):
    targets, (sites_, *rest), _ = small_run
    points = spark.createDataFrame([("a", 35.66, 139.7301, 100, "工業")], "point_id string, lat double, lon double, price long, kind string")
    large = sites_.filter("code = '1' AND site_name IN ('S', 'W')").withColumn("area", F.lit(30_000.0))
    same = large.withColumn("location", F.lit("東京都港区六本木3丁目5番"))
    good = run.company_reasons(targets).filter("reason IS NULL").drop("reason")
    for rows, n in ((large, 0), (same, 2)):
        every = run.site_reasons(good, rows, *rest).filter("reason IS NULL")
        assert every.filter("repeated_large").count() == n == run.valued(every, points).filter("repeated_large").count() == run.valued(every.drop("repeated_large"), points).filter("repeated_large").count()
