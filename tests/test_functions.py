"""Functions on small examples."""

import datetime
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landquill.functions import address as fa
from landquill.functions import filing as ff
from landquill.functions import valuation as fv
from landquill.functions.geo import plane_xy, with_geodesic
from landquill.functions.mining import address_candidates, candidate_score


def values(spark, rows, *columns, names="s string"):
    df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], names)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_numerals_round_trip(spark):
    rows = spark.range(-1, 101).select("id", fa.num_to_kanji(F.col("id")).alias("k")).select("id", "k", fa.kanji_to_int(F.col("k")).alias("n")).collect()
    by = {r["id"]: r for r in rows}
    assert by[-1]["k"] is None and by[100]["k"] is None
    assert all(by[n]["n"] == n for n in range(100))
    assert [by[n]["k"] for n in (0, 1, 10, 11, 20, 35, 99)] == ["零", "一", "十", "十一", "二十", "三十五", "九十九"]


def test_numeral_beyond_range_is_an_error_if_strict(spark):
    with pytest.raises(Exception, match="no numeral"):
        spark.range(100, 101).select(fa.num_to_kanji(F.col("id"), strict=True)).collect()


def test_kanji_to_int_of_other_text(spark):
    assert values(spark, ["", "三", "〇", "十十", "百", "一二", None], fa.kanji_to_int(F.col("s"))) == [None, 3, 0, None, None, None, None]


def test_normalize_addr(spark):
    got = values(spark, ["六本木３丁目", "六本木三丁目", "六本木３－４", "〒100 五番町4番", "　東京都　港区 ", None], fa.normalize_addr(F.col("s")))
    assert got == ["六本木3丁目", "六本木3丁目", "六本木3-4", "100 5番町4番", "東京都港区", None] or got[:5] == ["六本木3丁目", "六本木3丁目", "六本木3-4", "100 5番町4番", "東京都港区"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="東京都港区一二十三丁目番号０９－ー〒　12-", max_size=12), min_size=5, max_size=20))
def test_normalize_addr_is_idempotent(spark, texts):
    once = F.col("s")
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select(fa.normalize_addr(once).alias("a")).select("a", fa.normalize_addr(F.col("a")).alias("b")).select("b", fa.normalize_addr(F.col("b")).alias("c")).collect()
    assert all(r["b"] == r["c"] for r in rows)


def test_split_municipality(spark):
    got = values(spark, ["東京都中央区日本橋", "東京都八王子市元本郷町", "大阪府大阪市", "東京都東村山市本町"], fa.split_municipality(F.col("s"))["muni"], fa.split_municipality(F.col("s"))["rest"])
    assert got == [("中央区", "日本橋"), ("八王子市", "元本郷町"), (None, "大阪府大阪市"), ("東村", "山市本町")]


@pytest.mark.parametrize(
    "text, want",
    [("東京都中央区日本橋1丁目15番3号", ("日本橋", 1, 15)), ("東京都港区六本木3-4-33", ("六本木", 3, 4)), ("東京都中央区日本橋兜町11番5号", ("日本橋兜町", None, 11)), ("東京都中央区日本橋兜町", ("日本橋兜町", None, None)), ("", (None, None, None))],
)
def test_parse_town(spark, text, want):
    t = fa.parse_town(F.col("s"))
    assert values(spark, [text], t["town"], t["chome"], t["block"]) == [want]


def test_sql_functions(spark):
    fa.register_address_functions(spark)
    assert spark.sql("SELECT land_normalize_addr('〒東京都港区六本木三丁目４番') a, land_kanji_to_int('二十三') n").first() == ("東京都港区六本木3丁目4番", 23)


def test_geodesic(spark):
    rows = [(35.681236, 139.767125, 35.690921, 139.700258), (35.0, 139.0, 35.0, 139.0), (None, 139.0, 35.0, 139.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    near, same, none = (r["m"] for r in with_geodesic(df, "a", "b", "c", "d", "m").collect())
    assert abs(near - 6145) < 100 and same == 0.0 and none is None


def test_geodesic_converges(spark):
    df = spark.createDataFrame([(35.6, 139.7, 36.6, 140.9)], "a double, b double, c double, d double")
    few, many = (with_geodesic(df, "a", "b", "c", "d", "m", n).first()["m"] for n in (4, 12))
    assert abs(few - many) < 1e-3


def test_plane_agrees_with_geodesic(spark):
    df = spark.createDataFrame([(35.68, 139.77, 35.70, 139.79)], "a double, b double, c double, d double")
    r = with_geodesic(df, "a", "b", "c", "d", "m").select("m", plane_xy(F.col("a"), F.col("b")).alias("p"), plane_xy(F.col("c"), F.col("d")).alias("q")).first()
    assert abs(math.hypot(r["p"]["x"] - r["q"]["x"], r["p"]["y"] - r["q"]["y"]) / r["m"] - 0.9999) < 1e-5


def test_valuation_rounding(spark):
    v = fv.valuation(F.col("p"), F.col("f"), F.col("a"), F.col("b"), F.col("c"))
    df = spark.createDataFrame([(1001.0, 0.5, 10.0, 0.0, 0.0), (1000.0, 0.95, 100.0, 50000.0, 1e6)], "p double, f double, a double, b double, c double")
    got = [tuple(r) for r in df.select(v["unit_price"], v["est"], v["gain"], v["multiple"], v["cap_ratio"]).collect()]
    assert got == [(500, 5000, 5000, None, None), (950, 95000, 45000, 1.9, 0.095)]


def test_equipment_family_takes_the_first_keyword(spark):
    assert values(spark, ["賃貸マンション", "第一工場事務所", "社員寮", "研究所"], fv.equipment_family(F.col("s"))) == ["商業系", "工業系", "住居系", None]


def test_aggregate_names(spark):
    assert values(spark, ["本社他", "本社・営業部", "東京支店他", "本社等", "工場他", "工場"], fv.is_aggregate(F.col("s"))) == [True] * 5 + [False]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1e5), st.floats(0, 1e8)), min_size=1, max_size=20))
def test_uncertainty_is_in_range_and_agrees_with_its_label(spark, rows):
    s = fv.uncertainty(F.col("a"), F.col("b"))
    for score, label in values(spark, rows, s, fv.confidence_label(s), names="a double, b double"):
        assert 0 <= score <= 1 and label == ("high" if score >= 0.67 else "medium" if score >= 0.34 else "low")


def test_warnings(spark):
    w = fv.warnings(F.lit(True), F.lit("muni_centroid"), F.lit(10000.0), F.lit("low"), F.lit(5000.0), F.lit(500.0))
    assert spark.range(1).select(w).first()[0] == [fv.WARNINGS[c] for c in ("multi_location", "muni_centroid", "far_points", "low_confidence_large", "extreme_multiple")]


def test_numbers_of_cells(spark):
    assert values(spark, ["1,234.5", "－", "", "※ なし", "１２３"], ff.parse_number(F.col("s"))) == [1234.5, None, None, None, 123.0]
    cell = ff.parse_land_cell(F.col("s"))
    assert values(spark, ["407(190.1)", "※1 500 [20] (500)", "(12)"], cell["book"], cell["area"]) == [(407.0, 190.1), (500.0, None), (None, 12.0)]
    assert values(spark, ["※1※2 10,255", "[3] (4) 7"], ff.parse_area_cell(F.col("s"))) == [10255.0, 7.0]


def test_location(spark):
    loc = ff.extract_location(F.col("s"))
    assert values(spark, ["東京支店(東京都千代田区)他60営業所等", "本社(東京都千代田区丸の内一丁目4番1号)", "本社"], loc["location"], loc["has_hoka"]) == [("東京都千代田区", True), ("東京都千代田区", False), ("", False)]


def test_site_name(spark):
    assert values(spark, ["本社\n(東京都港区)", "第一\nビル", "東京及び\n大阪", ""], ff.extract_site_name(F.col("s"))) == ["本社", "第一ビル", "東京及び大阪", "不明"]


def test_units(spark):
    assert values(spark, ["帳簿価額(千円)", "(百万円)", "何もない"], ff.book_multiplier(F.col("s"))) == [1000, 1000000, 1000000]
    assert values(spark, ["面積(千㎡)", "面積(㎡)"], ff.area_scale(F.col("s"))) == [1000.0, 1.0]


def test_html_and_urls(spark):
    assert values(spark, ["a<br>b&amp;c <b>d</b>"], ff.html_to_text(F.col("s"))) == ["a\nb&c \nd\n"]
    assert values(spark, ["http://a/x.PDF?y=1", "http://a/x?y=.pdf"], ff.supported_url(F.col("s"))) == [False, True]
    assert values(spark, ["a | |b", None], ff.url_list(F.col("s"))) == [["a", "b"], []]
    assert values(spark, ["1,000", " ", "x", None], ff.to_float(F.col("s"))) == [1000.0, None, None, None]


def test_candidates(spark):
    text = "本社 〒106 東京都港区六本木3-4-333926.29 TEL 03\n東京都のどこか\n東京都中央区日本橋1丁目2番3号（別館）\n東京都中央区日本橋1丁目2番3号"
    assert values(spark, [text], address_candidates(F.col("s"))) == [["東京都港区六本木3-4", "東京都中央区日本橋1丁目2番3号"]]


def test_candidate_scores(spark):
    score = lambda addr, page: spark.range(1).select(candidate_score(F.lit("本社"), F.lit("東京都中央区"), F.lit(addr), F.lit(page))).first()[0]
    addr = "東京都中央区日本橋1-2-3"
    assert score(addr, f"本社所在地: {addr}") > score(addr, addr) >= 20
    assert score("東京都港区芝1-2-3", "") < 40
    assert score(addr, "") > score("東京都中央区日本橋1丁目", "")


def test_dates_are_utc(spark):
    assert spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00'").first()[0] == datetime.datetime(2024, 1, 1)


def test_character_references_are_replaced_before_tags(spark):
    text = ["&lt;b&gt;x&lt;/b&gt;", "&amp;lt; &copy;&middot;&nope; &#39;&#x3042;&#128512; &#0; &#xD800; &apos;", "plain", ""]
    assert values(spark, text, ff.unescape_html(F.col("s"))) == ["<b>x</b>", "&lt; ©·&nope; 'あ😀 � � '", "plain", ""]
    assert values(spark, ["a&lt;br&gt;b<i>c</i>"], ff.html_to_text(F.col("s"))) == ["a\nb\nc\n"]
