"""Registered queries of the valuation engine and the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landquill.functions import address as fa
from landquill.functions import filing as ff
from landquill.functions import geo
from landquill.functions import valuation as fv
from landquill.functions.mining import address_candidates, candidate_score
from landquill.operators import filings, geocode, knn, master, ranking, sites, web
from landquill.operators.asof import asof_join, market_caps_at
from landquill.plans import run
from landquill.plans.adapters import sql, view
from landquill.shared import checkpointed, stored
from landquill.sources.sinks import price_dates
from landquill.sources.tables import page_texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Callable[[SparkSession, str], DataFrame]], Callable[[SparkSession, str], DataFrame]]:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- nearest points and prices -------------------------------------------------

_DIST = "sqrt((q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y))"
_NEAREST = f"""
    SELECT query_id, point_id, price, kind, dist_m FROM (
        SELECT q.seq AS query_id, p.point_id, p.price, p.kind, {_DIST} AS dist_m, row_number() OVER (PARTITION BY q.seq ORDER BY {_DIST}, p.point_id) AS rank
        FROM {sql("sites")} q, {sql("points")} p) WHERE rank = 1
"""
_KNN = f"""
    SELECT q.seq AS query_id, p.point_id, p.price, {_DIST} AS dist_m, row_number() OVER (PARTITION BY q.seq ORDER BY {_DIST}, p.point_id) AS rank
    FROM {sql("sites")} q, {sql("points")} p
"""


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "sites").select(F.col("seq").alias("query_id"), "x", "y", F.lit("").alias("scope"), "equipment")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "points").select("point_id", "x", "y", "price", "kind")


def _all_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).withColumn("scope", F.lit(""))


@query(f"SELECT query_id, point_id, price, round(dist_m, 4) AS dist_m FROM ({_NEAREST})")
def nearest_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = knn.knn_join(_queries(spark, sf_dir), _all_points(spark, sf_dir), 1)
    return found.select("query_id", "point_id", "price", F.round("dist_m", 4).alias("dist_m"))


@query(f"SELECT query_id, CAST(rank AS INT) AS rank, point_id, price, round(dist_m, 4) AS dist_m FROM ({_KNN}) WHERE rank <= 3")
def knn_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = knn.knn_join(_queries(spark, sf_dir), _all_points(spark, sf_dir), 3, strategy="tree")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "point_id", "price", F.round("dist_m", 4).alias("dist_m"))


# Far queries: a ring about all points and a place beyond them; every second one asks in a scope of three points.
_FAR_QUERIES = "(SELECT o_orderkey AS query_id, CASE WHEN o_orderkey % 4 < 2 THEN -3000000 + o_orderkey * 7919 % 1000003 ELSE 900000 + o_orderkey * 104729 % 70001 END::DOUBLE AS x, CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey * 15485863 % 500009 - 200000 ELSE -800000 - o_orderkey * 31 % 977 END::DOUBLE AS y, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'few' || (o_orderkey % 40) END AS scope FROM orders WHERE o_orderpriority = '2-HIGH')"
_FAR_POINTS = f"(SELECT point_id, x, y, '' AS scope FROM {sql('points')} UNION ALL SELECT point_id, x, y, 'few' || (pos // 50) FROM {sql('points')} WHERE pos % 50 < 3)"


@query(f"SELECT query_id, CAST(rank AS INT) AS rank, point_id, round(dist_m, 3) AS dist_m FROM (SELECT q.query_id, p.point_id, {_DIST} AS dist_m, row_number() OVER (PARTITION BY q.query_id ORDER BY {_DIST}, p.point_id) AS rank FROM {_FAR_QUERIES} q JOIN {_FAR_POINTS} p USING (scope)) WHERE rank <= 4")
def far_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four nearest points of queries that lie far outside all points, half of them in scopes of three points."""
    key = F.col("o_orderkey")
    ring = key % 4 < 2
    orders = _table(spark, sf_dir, "orders").filter("o_orderpriority = '2-HIGH'")
    queries = orders.select(
        key.alias("query_id"), F.when(ring, key * 7919 % 1000003 - 3000000).otherwise(key * 104729 % 70001 + 900000).cast("double").alias("x"), F.when(ring, key * 15485863 % 500009 - 200000).otherwise(-800000 - key * 31 % 977).cast("double").alias("y"),
        F.when(key % 2 == 0, "").otherwise(F.concat(F.lit("few"), (key % 40).cast("string"))).alias("scope"),
    )
    points = view(spark, sf_dir, "points").select("point_id", "pos", "x", "y", F.lit("").alias("scope"))
    few = points.filter("pos % 50 < 3").withColumn("scope", F.concat(F.lit("few"), F.floor(F.col("pos") / 50).cast("string")))
    found = knn.knn_join(queries, points.unionByName(few).drop("pos"), 4, strategy="tree")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "point_id", F.round("dist_m", 3).alias("dist_m"))


@query(
    f"""SELECT query_id, CAST(round(sum(w * price) / sum(w)) AS BIGINT) AS unit_price, array_to_string(list(point_id ORDER BY rank), '|') AS knn_ids, round(max(dist_m), 3) AS max_dist,
        round(var_pop(dist_m), 2) AS variance FROM (SELECT *, 1 / pow(dist_m + 1, 3) AS w FROM ({_KNN}) WHERE rank <= 3) GROUP BY query_id"""
)
def idw_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = knn.idw(knn.knn_join(_queries(spark, sf_dir), _all_points(spark, sf_dir), 3))
    return out.select("query_id", "unit_price", F.array_join("knn_ids", "|").alias("knn_ids"), F.round("max_dist", 3).alias("max_dist"), F.round("variance", 2).alias("variance"))


_FAMILY = "CASE WHEN equipment LIKE '%工場%' OR equipment LIKE '%倉庫%' OR equipment LIKE '%物流%' THEN '工業系' WHEN equipment LIKE '%事務所%' OR equipment LIKE '%賃貸%' THEN '商業系' WHEN equipment LIKE '%寮%' THEN '住居系' END"
_FAMILY_OF = "CASE WHEN p.kind IN ('工業', '準工') THEN '工業系' WHEN p.kind IN ('商業', '近商') THEN '商業系' WHEN p.kind = '1住居' THEN '住居系' END"


@query(
    f"""WITH q AS (SELECT seq AS query_id, x, y, {_FAMILY} AS family FROM {sql("sites")}), d AS (SELECT q.query_id, p.point_id, p.kind, {_DIST} AS dist_m, family IS NOT NULL AND {_FAMILY_OF} = family AS own FROM q, {sql("points")} p),
        a AS (SELECT query_id, min(struct_pack(d := dist_m, i := point_id, k := kind)) AS m FROM d GROUP BY query_id), o AS (SELECT query_id, min(struct_pack(d := dist_m, i := point_id, k := kind)) AS m FROM d WHERE own GROUP BY query_id),
        r AS (SELECT a.query_id, CASE WHEN o.m IS NULL OR o.m.d > 1500 THEN a.m ELSE o.m END AS m FROM a LEFT JOIN o USING (query_id))
        SELECT query_id, m.i AS point_id, m.k AS kind, round(m.d, 4) AS dist_m FROM r"""
)
def scoped_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = _queries(spark, sf_dir).withColumn("family", fv.equipment_family(F.col("equipment"))).drop("scope")
    found = knn.nearest_with_fallback(queries, knn.with_scopes(_points(spark, sf_dir)))
    return found.select("query_id", "point_id", "kind", F.round("dist_m", 4).alias("dist_m"))


@query(
    f"""WITH a AS (SELECT * FROM {sql("points")}), b AS (SELECT * FROM {sql("second_points")}) SELECT point_id, price, 1 AS survey FROM a
        UNION ALL SELECT point_id, price, 2 FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.x = b.x AND a.y = b.y)"""
)
def survey_conflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _points(spark, sf_dir), view(spark, sf_dir, "second_points")
    return knn.conflate(first, second, "x", "y", 0).select("point_id", "price", "survey")


@query(
    f"""WITH a AS (SELECT * FROM {sql("points")}), b AS (SELECT * FROM {sql("second_points")}), n AS (SELECT (SELECT count(*) FROM a) AS f, (SELECT count(*) FROM b) AS s, (SELECT count(*) FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.x = b.x AND a.y = b.y)) AS d)
        SELECT f AS first, s AS second, d AS added, s - d AS skipped, f + d AS total FROM n"""
)
def conflation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _points(spark, sf_dir), view(spark, sf_dir, "second_points")
    return knn.conflation_counts(first, second, knn.conflate(first, second, "x", "y", 0))


@query(f"SELECT pos, CASE WHEN n = 1 THEN base_id ELSE base_id || '#' || n END AS point_id FROM (SELECT pos, base_id, row_number() OVER (PARTITION BY base_id ORDER BY pos) AS n FROM {sql('points')})")
def unique_point_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.unique_ids(view(spark, sf_dir, "points").drop("point_id"), "base_id", "pos").select("pos", "point_id")


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, coalesce(kind, '') AS kind FROM lineitem LEFT JOIN {sql('points')} p ON p.point_id = '13-' || (l_partkey * 2)")
def point_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.concat(F.lit("13-"), (F.col("l_partkey") * 2).cast("string")).alias("point_id"))
    return knn.point_attribute(ids, _points(spark, sf_dir)).select("l_orderkey", "l_linenumber", "l_partkey", "kind")


# --- valuation, totals, ranking ------------------------------------------------

_VALUED = f"""
    SELECT s.code, s.seq, s.area, s.book, v.price, f, round_even(v.price * f, 0) AS unit, v.price * f * s.area AS est_raw, round_even(round_even(v.price * f, 0) * s.area, 0) AS est
    FROM (SELECT *, CASE level WHEN 'gaiku' THEN 1.0 WHEN 'oaza_chome' THEN 0.95 WHEN 'muni_centroid' THEN 0.85 ELSE 1.0 END::DOUBLE AS f FROM {sql("sites")}) s JOIN ({_NEAREST}) v ON v.query_id = s.seq
"""
_TOTALS = f"""
    SELECT code, company_name, market_cap, coalesce(n, 0) AS n_sites, coalesce(e, 0) AS est, coalesce(b, 0) AS book, coalesce(e, 0) - coalesce(b, 0) AS gain, CASE WHEN braw <> 0 THEN eraw / braw END AS multiple, CASE WHEN market_cap <> 0 THEN coalesce(eraw, 0) / market_cap END AS cap_ratio
    FROM {sql("companies")} LEFT JOIN (SELECT code, count(*) AS n, CAST(sum(est) AS BIGINT) AS e, CAST(sum(round_even(book, 0)) AS BIGINT) AS b, sum(est_raw) AS eraw, sum(book) AS braw FROM ({_VALUED}) GROUP BY code) USING (code)
"""


def _valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = knn.knn_join(_queries(spark, sf_dir), _all_points(spark, sf_dir), 1).select("query_id", "price")
    joined = view(spark, sf_dir, "sites").join(found, F.col("seq") == F.col("query_id"))
    factor = fv.level_factor(F.col("level"))
    value = fv.valuation(F.col("price"), factor, F.col("area"), F.col("book"), F.lit(1.0))
    return joined.select("code", "seq", "site_name", "area", "book", "level", "has_hoka", value["unit_price"].alias("unit_price"), value["est"].alias("est"), value["gain"].alias("gain"), value["multiple"].alias("multiple"), (F.col("price") * factor * F.col("area")).alias("est_raw"))


@query(f"SELECT code, seq, CAST(unit AS BIGINT) AS unit_price, CAST(est AS BIGINT) AS est, CAST(est - round_even(book, 0) AS BIGINT) AS gain, CASE WHEN book <> 0 THEN round(est_raw / book, 6) END AS multiple FROM ({_VALUED})")
def site_valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _valued(spark, sf_dir).select("code", "seq", "unit_price", "est", "gain", F.round("multiple", 6).alias("multiple"))


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.company_totals(view(spark, sf_dir, "companies").select("code", "company_name", "market_cap"), _valued(spark, sf_dir))


@query(f"SELECT code, n_sites, est, book, gain, round(multiple, 6) AS multiple, round(cap_ratio, 8) AS cap_ratio FROM ({_TOTALS})")
def company_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(spark, sf_dir).select("code", "n_sites", "est", "book", "gain", F.round("multiple", 6).alias("multiple"), F.round("cap_ratio", 8).alias("cap_ratio"))


@query(f"SELECT CAST(row_number() OVER (ORDER BY cap_ratio DESC, code) AS INT) AS rank, code, est, gain, round(cap_ratio, 8) AS ratio FROM ({_TOTALS}) WHERE cap_ratio IS NOT NULL")
def gain_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest price of each site, valuation, company totals, ranking by estimate over market value."""
    rows = _totals(spark, sf_dir).withColumn("ratio", F.col("cap_ratio"))
    return ranking.ranked(rows).select("rank", "code", "est", "gain", F.round("ratio", 8).alias("ratio"))


@query(f"SELECT code, CAST(cap_ratio >= 0.5 AS BOOLEAN) AS good, round(cap_ratio, 8) AS ratio FROM ({_TOTALS}) WHERE cap_ratio IS NOT NULL ORDER BY cap_ratio DESC, code LIMIT 20")
def top_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranking.top(_totals(spark, sf_dir).withColumn("ratio", F.col("cap_ratio")), 20)
    return rows.select("code", fv.good_metric(F.col("ratio")).alias("good"), F.round("ratio", 8).alias("ratio"))


@query("SELECT CAST(o_custkey AS VARCHAR) AS code, o_orderkey AS site, CAST(grouping(o_orderkey) AS TINYINT) AS is_total, sum(CAST(o_totalprice * 100 AS BIGINT)) AS est, sum(CAST(o_orderkey AS BIGINT)) AS book FROM orders GROUP BY GROUPING SETS ((o_custkey, o_orderkey), (o_custkey))")
def sites_and_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("code"), F.col("o_orderkey").alias("site"), F.round(F.col("o_totalprice") * 100).cast("long").alias("est"), F.col("o_orderkey").alias("book"))
    return sites.sites_and_totals(rows)


_SCORE = "greatest(0, least(1, 1 - (0.7 * least(max_dist / 5000, 1) + 0.3 * least(variance / 1e6, 1))))"
_SPREAD = f"SELECT query_id, max(dist_m) AS max_dist, var_pop(dist_m) AS variance FROM ({_KNN}) WHERE rank <= 3 GROUP BY query_id"


@query(f"SELECT query_id, round(s, 6) AS score, CASE WHEN s >= 0.67 THEN 'high' WHEN s >= 0.34 THEN 'medium' ELSE 'low' END AS label FROM (SELECT query_id, {_SCORE} AS s FROM ({_SPREAD}))")
def price_uncertainty(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = knn.idw(knn.knn_join(_queries(spark, sf_dir), _all_points(spark, sf_dir), 3)).withColumn("s", fv.uncertainty(F.col("max_dist"), F.col("variance")))
    return out.select("query_id", F.round("s", 6).alias("score"), fv.confidence_label(F.col("s")).alias("label"))


_WARN = ", ".join(
    f"CASE WHEN {rule} THEN '{fv.WARNINGS[code]}' END"
    for code, rule in {
        "multi_location": "has_hoka", "muni_centroid": "level = 'muni_centroid'", "oaza_chome": "level = 'oaza_chome'", "far_points": "max_dist >= 10000", "low_confidence_large": "label = 'low' AND area >= 5000", "extreme_multiple": "multiple >= 500",
    }.items()
)
_LABEL = "CASE WHEN {s} >= 0.67 THEN 'high' WHEN {s} >= 0.34 THEN 'medium' ELSE 'low' END"
_FACTOR = "CASE level WHEN 'gaiku' THEN 1.0 WHEN 'oaza_chome' THEN 0.95 WHEN 'muni_centroid' THEN 0.85 ELSE 1.0 END::DOUBLE"


@query(
    f"""SELECT seq, concat_ws(' | ', {_WARN}) AS warnings FROM (SELECT *, {_LABEL.format(s=_SCORE)} AS label, CASE WHEN book <> 0 THEN unit * {_FACTOR} * area / book END AS multiple FROM {sql("sites")}
        JOIN (SELECT query_id, round(sum(w * price) / sum(w)) AS unit, max(dist_m) AS max_dist, var_pop(dist_m) AS variance FROM (SELECT *, 1 / pow(dist_m + 1, 3) AS w FROM ({_KNN}) WHERE rank <= 3) GROUP BY query_id) ON query_id = seq)"""
)
def anomaly_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = knn.idw(knn.knn_join(_queries(spark, sf_dir), _all_points(spark, sf_dir), 3))
    rows = view(spark, sf_dir, "sites").join(spread, F.col("seq") == F.col("query_id"))
    label = fv.confidence_label(fv.uncertainty(F.col("max_dist"), F.col("variance")))
    multiple = fv.valuation(F.col("unit_price"), fv.level_factor(F.col("level")), F.col("area"), F.col("book"), F.lit(1.0))["multiple"]
    return rows.select("seq", F.array_join(fv.warnings(F.col("has_hoka"), F.col("level"), F.col("max_dist"), label, F.col("area"), multiple), " | ").alias("warnings"))


@query(f"SELECT seq, coalesce(count(*) OVER w >= 2 AND sum(round(area, 2)) OVER w >= 12000, false) AS repeated_large FROM {sql('sites')} WINDOW w AS (PARTITION BY code, site_name)")
def repeated_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "sites").withColumn("address", F.col("site_name"))
    return sites.repeated_address_warning(rows, 12_000.0).select("seq", "repeated_large")


@query(
    f"SELECT seq, contains(site_name, '本社他') OR starts_with(site_name, '本社・') OR ends_with(site_name, '他') OR ends_with(site_name, '等') AS aggregate, regexp_matches(site_name, '他|ほか|及び|等|外') AS multi, {_FAMILY} AS family FROM {sql('sites')}"
)
def site_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "sites").select("seq", fv.is_aggregate(F.col("site_name")).alias("aggregate"), fv.is_multi_location(F.col("site_name")).alias("multi"), fv.equipment_family(F.col("equipment")).alias("family"))


@query("SELECT l_orderkey AS code, max(l_extendedprice) AS ratio, string_agg(DISTINCT l_returnflag, ' / ' ORDER BY l_returnflag) AS tags, count(DISTINCT l_returnflag) AS tag_count FROM lineitem GROUP BY 1")
def ranking_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("code"), F.lit(0).alias("is_total"), F.col("l_extendedprice").alias("ratio"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("seq"), F.col("l_returnflag").alias("tag"))
    best = ranking.representative_rows(rows).select("code", "ratio")
    counts = rows.groupBy("code").agg(ranking.count_filled("tag").alias("tag_count"))
    return best.join(ranking.ordered_distinct(rows, "tag", "tags"), "code").join(counts, "code")


@query(
    f"""SELECT r.code, r.company_name, n_orders, status FROM (SELECT code, trim(company_name) AS company_name FROM {sql("companies")}) r LEFT JOIN (SELECT CAST(o_custkey AS VARCHAR) AS code, count(*) AS n_orders, max(o_orderstatus) AS status FROM orders GROUP BY 1) m USING (code)
        WHERE EXISTS (SELECT 1 FROM events WHERE CAST(user_id AS VARCHAR) = r.code AND event_type = 'purchase')"""
)
def screened_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "companies").select("code", F.trim("company_name").alias("company_name"))
    metrics = _table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("code")).agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_orderstatus").alias("status"))
    allowed = _table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(F.col("user_id").cast("string").alias("code"))
    out = ranking.screened(ranking.with_metrics(rows, metrics, ["n_orders", "status"]), allowed)
    return out.select("code", "company_name", "metrics.n_orders", "metrics.status")


# --- companies -------------------------------------------------------------------

_GOOD = lambda name: f"CASE WHEN regexp_replace(coalesce({name}, ''), '\\s+', '', 'g') NOT IN ('', code) THEN trim({name}) END"


@query(f"SELECT code, coalesce({_GOOD('company_name')}, {_GOOD('m')}) AS company_name FROM {sql('companies')} LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS m FROM supplier) USING (code)")
def company_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    stock = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("company_name"))
    return master.resolve_names(view(spark, sf_dir, "companies"), stock).select("code", "company_name")


_ASOF = "TIMESTAMP '2024-01-20 00:00:00'"
_LAST = f"SELECT code, max(date) AS date, arg_max(close, (date, close)) AS close FROM {sql('prices')} WHERE date <= (SELECT max(ts) FROM events) GROUP BY code HAVING max(date) >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY"


def _asof(spark: SparkSession, sf_dir: str) -> F.Column:
    return F.lit(_table(spark, sf_dir, "events").agg(F.max("ts")).first()[0])


@query(f"SELECT code, date, close FROM ({_LAST})")
def latest_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.latest_price(view(spark, sf_dir, "prices"), _asof(spark, sf_dir))


@query(f"SELECT c.code, coalesce(c.market_cap, CAST(trunc(c.shares * l.close) AS BIGINT)) AS market_cap FROM (SELECT code, market_cap, CAST(code AS BIGINT) % 50 * 1000 + 1000 AS shares FROM {sql('companies')}) c LEFT JOIN ({_LAST}) l USING (code)")
def market_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = view(spark, sf_dir, "companies").select("code", "market_cap", (F.col("code").cast("long") % 50 * 1000 + 1000).alias("shares"))
    return master.market_caps(targets, view(spark, sf_dir, "prices"), _asof(spark, sf_dir)).select("code", "market_cap")


# Filings at the day of their order within the month of the events; a third of the codes has no events. Prices are those of purchases.
_FILED_AT = "SELECT o_orderkey AS doc_id, CAST(o_custkey % 225 AS VARCHAR) AS code, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(date_diff('day', TIMESTAMP '1995-01-01 00:00:00', o_orderdate) % 45 AS INT)) AS date, CAST(o_custkey % 50 + 1 AS BIGINT) * 1000 AS shares, CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey END AS market_cap FROM orders"
_PURCHASES = "(SELECT CAST(user_id AS VARCHAR) AS code, ts AS price_date, max(value) AS close FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)"
_PRICED = f"SELECT f.*, CASE WHEN p.price_date >= f.date - INTERVAL 7 DAY THEN p.close END AS close, CASE WHEN p.price_date >= f.date - INTERVAL 7 DAY THEN p.price_date END AS price_date FROM ({_FILED_AT}) f ASOF LEFT JOIN {_PURCHASES} p ON f.code = p.code AND f.date >= p.price_date"


def _filed_at(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(filings with a date of their own, prices)."""
    day = F.datediff("o_orderdate", F.lit("1995-01-01").cast("date")) % 45
    cap = F.when(F.col("o_orderkey") % 11 == 0, F.col("o_orderkey"))
    filed = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), (F.col("o_custkey") % 225).cast("string").alias("code"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(day)).alias("date"), ((F.col("o_custkey") % 50 + 1) * 1000).alias("shares"), cap.alias("market_cap"))
    prices = _table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(F.col("user_id").cast("string").alias("code"), F.col("ts").alias("date"), F.col("value").alias("close"))
    return filed, prices


@query(f"SELECT doc_id, close, price_date FROM ({_PRICED})")
def price_asof_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price at each filing's own date, not older than seven days."""
    filed, prices = _filed_at(spark, sf_dir)
    found = asof_join(filed, prices.withColumnRenamed("date", "price_date"), "code", "date", "price_date", ["close", "price_date"], tie=["close"], max_age=F.make_dt_interval(F.lit(7)))
    return found.select("doc_id", "close", "price_date")


@query(f"SELECT doc_id, coalesce(market_cap, CAST(trunc(shares * close) AS BIGINT)) AS market_cap FROM ({_PRICED})")
def market_caps_at_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market value at each filing's date: its own, else shares times the price."""
    return market_caps_at(*_filed_at(spark, sf_dir)).select("doc_id", "market_cap")


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def latest_filing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    return master.latest_per(rows, "o_custkey", "o_orderdate", "o_orderkey")


@query(
    f"""SELECT code, coalesce(n, o, '') AS company_name, CASE WHEN fresh THEN 2 ELSE 1 END AS updated_at FROM (SELECT code, company_name AS o FROM {sql("companies")} WHERE CAST(code AS BIGINT) % 3 > 0)
        FULL JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS code, nullif(trim(CASE WHEN s_suppkey % 4 = 0 THEN ' ' ELSE s_name END), '') AS n, true AS fresh FROM supplier) USING (code)"""
)
def master_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = view(spark, sf_dir, "companies").filter(F.col("code").cast("long") % 3 > 0).select("code", "company_name", F.lit(1).alias("updated_at"))
    new = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("code"), F.when(F.col("s_suppkey") % 4 == 0, " ").otherwise(F.col("s_name")).alias("company_name"))
    return master.upsert_names(old, new, F.lit(2))


@query(f"SELECT code, CASE WHEN regexp_replace(coalesce(company_name, ''), '\\s+', '', 'g') IN ('', code) THEN 'missing name' WHEN market_cap IS NULL THEN 'missing market value' ELSE 'accepted' END AS outcome FROM {sql('companies')}")
def target_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = master.split_rejects(view(spark, sf_dir, "companies"), [("missing name", master.is_placeholder(F.col("company_name"), F.col("code"))), ("missing market value", F.col("market_cap").isNull())])
    return good.select("code", F.lit("accepted").alias("outcome")).unionByName(bad.select("code", F.col("reject_reason").alias("outcome")))


@query("SELECT trim(event_type) AS code, min(event_id) AS seq FROM events WHERE trim(event_type) <> '' GROUP BY 1")
def distinct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").select(F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("code"), F.col("event_id").alias("seq"))
    return master.distinct_codes(rows)


_SIGN = "md5(CAST(o_orderstatus AS VARCHAR) || o_totalprice::BIGINT)"


@query(
    f"""WITH o AS (SELECT o_orderkey AS code, CAST(o_totalprice AS BIGINT) AS s FROM orders WHERE o_orderkey % 10 > 0), n AS (SELECT o_orderkey AS code, CASE WHEN o_orderkey % 7 = 0 THEN -1 ELSE CAST(o_totalprice AS BIGINT) END AS s FROM orders WHERE o_orderkey % 9 > 0)
        SELECT code, CASE WHEN o.s IS NULL THEN 'added' WHEN n.s IS NULL THEN 'deleted' ELSE 'changed' END AS change FROM o FULL JOIN n USING (code) WHERE o.s IS DISTINCT FROM n.s"""
)
def changed_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("code"), F.round("o_totalprice").cast("long").alias("signature"))
    return master.changed_keys(rows.filter("code % 10 > 0"), rows.withColumn("signature", F.when(F.col("code") % 7 == 0, -1).otherwise(F.col("signature"))).filter("code % 9 > 0"))


@query(
    """WITH o AS (SELECT o_orderkey AS code, CAST(o_totalprice AS BIGINT) AS s FROM orders WHERE o_orderkey % 1009 > 0), n AS (SELECT o_orderkey AS code, CASE WHEN o_orderkey % 907 = 0 THEN -1 WHEN o_orderkey % 911 = 0 THEN NULL ELSE CAST(o_totalprice AS BIGINT) END AS s FROM orders WHERE o_orderkey % 1013 > 0),
        c AS (SELECT code, CASE WHEN o.code IS NULL THEN 'added' WHEN n.code IS NULL THEN 'deleted' ELSE 'changed' END AS change FROM o FULL JOIN n USING (code) WHERE o.code IS NULL OR n.code IS NULL OR o.s IS DISTINCT FROM n.s)
        SELECT code % 512 AS bucket, count(*) FILTER (change = 'added') AS added, count(*) FILTER (change = 'changed') AS changed, count(*) FILTER (change = 'deleted') AS deleted FROM c GROUP BY 1"""
)
def changed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changes between two states of all orders, by bucket; buckets without change are never joined."""
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("code"), F.round("o_totalprice").cast("long").alias("signature"))
    new = rows.filter("code % 1013 > 0").withColumn("signature", F.when(F.col("code") % 907 == 0, -1).when(F.col("code") % 911 != 0, F.col("signature")))
    found = master.changed_keys_by_digest(rows.filter("code % 1009 > 0"), new, buckets=512, bucket=F.col("code") % 512)
    kinds = [F.count_if(F.col("change") == kind).alias(kind) for kind in ("added", "changed", "deleted")]
    return found.groupBy((F.col("code") % 512).alias("bucket")).agg(*kinds)


@query("SELECT o_orderkey AS code FROM orders WHERE NOT (o_orderkey % 7 <> 0 AND o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0)")
def unchanged_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("code"), F.md5(F.col("o_orderkey").cast("string")).alias("signature"))
    old = rows.filter("code % 7 <> 0").withColumn("signature", F.when(F.col("code") % 4 == 0, "stale").otherwise(F.col("signature")))
    return master.to_process(rows, old, rows.select("code", (F.col("code") % 5 != 0).alias("valid"))).select("code")


@query("SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 6 = 0 OR o_orderkey % 8 = 0 THEN 'fresh' ELSE 'kept' END AS state FROM orders")
def extraction_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    filings_ = _table(spark, sf_dir, "orders").select(F.lit(2).alias("version"), F.col("o_orderkey").alias("doc_id"), F.col("o_custkey").alias("size"), F.col("o_orderdate").alias("modified"))
    old = filings_.filter("doc_id % 6 <> 0").withColumn("size", F.when(F.col("doc_id") % 8 == 0, F.col("size") + 1).otherwise(F.col("size")))
    fresh, kept = master.reuse_extractions(filings_, old, ["version", "doc_id", "size", "modified"])
    return fresh.select("doc_id", F.lit("fresh").alias("state")).unionByName(kept.select("doc_id", F.lit("kept").alias("state")))


@query("SELECT c_custkey, md5('{\"c_mktsegment\":\"' || c_mktsegment || '\",\"c_name\":\"' || c_name || '\"}') AS signature FROM customer")
def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer").select("c_custkey", master.signature("c_name", "c_mktsegment").alias("signature"))


_PATCH = f"SELECT code, site_name, CASE WHEN CAST(code AS BIGINT) % 5 = 0 THEN '' WHEN CAST(code AS BIGINT) % 3 = 0 THEN address ELSE address || '号' END AS p FROM {sql('overrides')} WHERE CAST(code AS BIGINT) % 2 = 0"
_OLD = f"SELECT code, site_name, address FROM {sql('overrides')} WHERE CAST(code AS BIGINT) % 4 > 0"


def _patches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows, code = view(spark, sf_dir, "overrides"), F.col("code").cast("long")
    patches = rows.filter(code % 2 == 0).withColumn("address", F.when(code % 5 == 0, "").when(code % 3 == 0, F.col("address")).otherwise(F.concat("address", F.lit("号"))))
    return master.merge_patches(rows.filter(code % 4 > 0), patches)


@query(f"SELECT code, site_name, coalesce(nullif(p, ''), address) AS address FROM ({_OLD}) FULL JOIN (SELECT * FROM ({_PATCH}) WHERE p <> '') USING (code, site_name)")
def patched_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _patches(spark, sf_dir)[0]


@query(f"SELECT code, site_name, CASE WHEN p = '' THEN 'error' WHEN address IS NULL THEN 'added' WHEN address = p THEN 'unchanged' ELSE 'updated' END AS effect FROM ({_PATCH}) LEFT JOIN ({_OLD}) USING (code, site_name)")
def patch_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _patches(spark, sf_dir)[1]


@query("SELECT event_type AS status, CASE WHEN value > 50 THEN 'large' ELSE '' END AS reason, count(*) AS n FROM events GROUP BY 1, 2")
def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.run_counts(_table(spark, sf_dir, "events").select(F.col("event_type").alias("status"), F.when(F.col("value") > 50, "large").alias("reason")))


@query(f"SELECT code FROM {sql('companies')} WHERE code NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events)")
def not_researched(spark: SparkSession, sf_dir: str) -> DataFrame:
    memos = _table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("code"))
    return master.without_memo(view(spark, sf_dir, "companies"), memos).select("code")


@query(f"SELECT seq AS rank, level AS tags FROM {sql('sites')} WHERE level IN ('muni_centroid', 'oaza_chome') ORDER BY seq LIMIT 25")
def coarse_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return master.low_resolution(view(spark, sf_dir, "sites").select(F.col("seq").alias("rank"), F.col("level").alias("tags")), 25)


@query(f"SELECT code, bool_and(level = 'gaiku') AS all_gaiku, bool_or(risk) AS has_risk, string_agg(seq || ':' || risk, ',' ORDER BY seq) AS flags FROM (SELECT *, ends_with(site_name, '他') OR area >= 9000 AND seq % 2 = 0 AS risk FROM {sql('sites')}) GROUP BY code")
def risk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    ward = F.when(F.col("seq") % 2 == 0, "港区").otherwise("府中市")
    rows = view(spark, sf_dir, "sites").withColumn("risk", fv.high_value_risk(F.col("site_name"), ward, F.col("area") + 1000.0))
    out = master.risk_summary(rows)
    return out.select("code", "all_gaiku", "has_risk", F.array_join(F.transform("flags", lambda x: F.concat_ws(":", x["seq"].cast("string"), x["risk"].cast("string"))), ",").alias("flags"))


@query("SELECT CAST(max(ts) AS TIMESTAMP) AS price_date, DATE '2024-02-01' AS target_price_date FROM events")
def price_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_dates(view(spark, sf_dir, "prices"), "2024-02-01")


# --- sites, overrides, splits ------------------------------------------------------

def _expanded_sql(rows: str, location: str) -> str:
    """code, site_name, seq, pos, area, book, equipment, has_hoka, location, reject_reason after the splits; ``location`` is a column of rows or a literal."""
    merged = f"SELECT code, site_name, min(seq) AS seq, sum(book) AS total FROM {rows} GROUP BY 1, 2"
    return f"""(WITH s AS (SELECT p.code, p.pos, p.name AS site_name, p.address, p.area, p.book, m.seq, m.total - coalesce(sum(p.book) OVER w, 0) AS remainder, sum(CASE WHEN p.book IS NULL THEN p.area END) OVER w AS open_area
            FROM {sql("splits")} p JOIN ({merged}) m ON p.code = m.code AND p.site_name = m.site_name WINDOW w AS (PARTITION BY p.code, p.site_name))
        SELECT code, site_name, seq, 0 AS pos, area, book, equipment, has_hoka, {location} AS location, NULL AS reject_reason FROM {rows} x WHERE NOT EXISTS (SELECT 1 FROM {sql("splits")} p WHERE p.code = x.code AND p.site_name = x.site_name)
        UNION ALL SELECT code, site_name, seq, pos, area, coalesce(book, CASE WHEN coalesce(open_area, 0) > 0 THEN remainder * area / open_area ELSE 0 END), '', false, address, CASE WHEN open_area IS NOT NULL AND remainder < 0 THEN 'split book values exceed the total' END FROM s)"""


@query(f"SELECT code, site_name, pos, round(area, 4) AS area, round(book, 4) AS book, reject_reason FROM {_expanded_sql(sql('sites'), chr(39) * 2)}")
def split_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "sites").select("code", "site_name", "seq", "area", "book", "equipment", "has_hoka")
    out = sites.expand_splits(rows, view(spark, sf_dir, "splits"))
    return out.select("code", "site_name", "pos", F.round("area", 4).alias("area"), F.round("book", 4).alias("book"), "reject_reason")


_FLAT = f"(SELECT code, site_name, arg_max(address, pos) AS address FROM (SELECT code, site_name, address, -1 AS pos FROM {sql('overrides')} o WHERE NOT EXISTS (SELECT 1 FROM {sql('splits')} p WHERE p.code = o.code AND p.site_name = o.site_name) UNION ALL SELECT code, name, address, pos FROM {sql('splits')}) GROUP BY 1, 2)"


@query(f"SELECT * FROM {_FLAT}")
def flat_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.flat_overrides(view(spark, sf_dir, "overrides"), view(spark, sf_dir, "splits"))


@query(f"SELECT s.seq, coalesce(o.address, '東京都' || s.level) AS address, CASE WHEN o.address IS NULL THEN 'securities_report' ELSE 'override' END AS address_source, p.unit_price AS override_price FROM {sql('sites')} s LEFT JOIN {sql('overrides')} o USING (code, site_name) LEFT JOIN {sql('price_overrides')} p USING (code, site_name)")
def site_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "sites").withColumn("location", F.concat(F.lit("東京都"), "level"))
    rows = sites.price_overridden(sites.with_address(rows, view(spark, sf_dir, "overrides")), view(spark, sf_dir, "price_overrides"))
    return rows.select("seq", "address", "address_source", "override_price")


# --- addresses ---------------------------------------------------------------------

_DIGIT = lambda c: f"(strpos('〇一二三四五六七八九', replace({c}, '零', '〇')) - 1)"
_TENS = lambda t: f"((CASE WHEN split_part({t}, '十', 1) = '' THEN 1 ELSE {_DIGIT('split_part(' + t + ", '十', 1)")} END) * 10 + (CASE WHEN split_part({t}, '十', 2) = '' THEN 0 ELSE {_DIGIT('split_part(' + t + ", '十', 2)")} END))"
_NUMBER = f"(CASE WHEN regexp_matches(t, '^[零〇一二三四五六七八九]$') THEN {_DIGIT('t')}::VARCHAR WHEN regexp_matches(t, '^[零〇一二三四五六七八九]?十[零〇一二三四五六七八九]?$') THEN {_TENS('t')}::VARCHAR ELSE t END)"


def _norm_sql(rows: str, col: str, key: str) -> str:
    """key, a: normalised text of a column, numerals replaced piece by piece."""
    half = f"replace(replace(translate(regexp_replace({col}, '^[\\s　]+|[\\s　]+$', '', 'g'), '０１２３４５６７８９－ー―−', '0123456789----'), '〒', ''), '　', '')"
    return f"""(SELECT {key}, string_agg(CASE WHEN u = '' THEN piece ELSE {_NUMBER} || u END, '' ORDER BY i) AS a FROM (
        SELECT {key}, i, piece, regexp_extract(piece, '^([零〇一二三四五六七八九十]+)(丁目|番|号)$', 1) AS t, regexp_extract(piece, '^([零〇一二三四五六七八九十]+)(丁目|番|号)$', 2) AS u
        FROM (SELECT {key}, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM (SELECT {key}, regexp_extract_all({half}, '[零〇一二三四五六七八九十]+(?:丁目|番|号)|[零〇一二三四五六七八九十]+|[^零〇一二三四五六七八九十]+') AS pieces FROM {rows}))) GROUP BY {key})"""


def _town_sql(rows: str) -> str:
    """seq, a, muni, town, chome, block of rows of seq and address."""
    parsed = f"""(SELECT seq, a, CASE WHEN regexp_matches(a, '^東京都(.+?(?:区|市|町|村))(.*)$') THEN regexp_extract(a, '^東京都(.+?(?:区|市|町|村))(.*)$', 1) END AS muni,
    CASE WHEN regexp_matches(a, '^東京都(.+?(?:区|市|町|村))(.*)$') THEN regexp_extract(a, '^東京都(.+?(?:区|市|町|村))(.*)$', 2) ELSE a END AS rest FROM {_norm_sql(rows, "address", "seq")})"""
    return _TOWN_OF.replace("{parsed}", parsed)


_CHOME, _HYPHEN, _BLOCK = "'(.+?)([0-9]+)丁目(.*)$'", "'(.+?)([0-9]+)-([0-9]+)(?:-[0-9]+)?.*$'", "'(.+?)([0-9]+)(?:番地?|号).*$'"
_ALONE = "'^(?:[^0-9,，、]+|.+(?:町|丁目))$'"
_TOWN_OF = f"""(SELECT seq, a, muni, CASE WHEN regexp_matches(rest, {_CHOME}) THEN regexp_extract(rest, {_CHOME}, 1) WHEN regexp_matches(rest, {_HYPHEN}) THEN regexp_extract(rest, {_HYPHEN}, 1) WHEN regexp_matches(rest, {_BLOCK}) THEN regexp_extract(rest, {_BLOCK}, 1)
        WHEN rest <> '' AND regexp_matches(rest, {_ALONE}) THEN rest END AS town,
    CASE WHEN regexp_matches(rest, {_CHOME}) THEN regexp_extract(rest, {_CHOME}, 2)::INT WHEN regexp_matches(rest, {_HYPHEN}) THEN regexp_extract(rest, {_HYPHEN}, 2)::INT END AS chome,
    CASE WHEN regexp_matches(rest, {_CHOME}) THEN TRY_CAST(nullif(regexp_extract(regexp_extract(rest, {_CHOME}, 3), '([0-9]{{1,4}})', 1), '') AS INT) WHEN regexp_matches(rest, {_HYPHEN}) THEN regexp_extract(rest, {_HYPHEN}, 3)::INT WHEN regexp_matches(rest, {_BLOCK}) THEN regexp_extract(rest, {_BLOCK}, 2)::INT END AS block
    FROM {{parsed}})"""
_TOWN = _town_sql(sql("addresses"))


@query(f"SELECT seq, a AS address, muni, town, chome, block FROM {_TOWN}")
def address_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "addresses").select("seq", "address", fa.split_municipality(F.col("address"))["muni"].alias("muni"), fa.parse_town(F.col("address")).alias("t"))
    return rows.select("seq", fa.normalize_addr(F.col("address")).alias("address"), "muni", "t.town", "t.chome", "t.block")


_KANJI = "CASE WHEN {n} > 99 THEN NULL ELSE (CASE WHEN {n} // 10 = 0 THEN '' WHEN {n} // 10 = 1 THEN '十' ELSE substr('零一二三四五六七八九', CAST({n} // 10 AS INT) + 1, 1) || '十' END) || (CASE WHEN {n} % 10 = 0 AND {n} >= 10 THEN '' ELSE substr('零一二三四五六七八九', CAST({n} % 10 AS INT) + 1, 1) END) END"


@query(f"SELECT p_partkey, {_KANJI.format(n='(p_partkey % 110)')} AS numeral, CASE WHEN p_partkey % 110 <= 99 THEN CAST(p_partkey % 110 AS INT) END AS back, CASE WHEN p_partkey % 110 <= 99 THEN '六本木' || {_KANJI.format(n='(p_partkey % 110)')} || '丁目' END AS oaza FROM part")
def numerals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_partkey") % 110
    rows = _table(spark, sf_dir, "part").select("p_partkey", fa.num_to_kanji(n).alias("numeral"), fa.oaza_name(F.lit("六本木"), n).alias("oaza"))
    return rows.select("p_partkey", "numeral", fa.kanji_to_int(F.col("numeral")).alias("back"), "oaza")


_TOWNS = f"(SELECT r.muni, n.a AS town, lat::DOUBLE AS lat, lon::DOUBLE AS lon FROM (SELECT *, muni || town AS k FROM {sql('town_reference')}) r JOIN {_norm_sql('(SELECT DISTINCT town FROM ' + sql('town_reference') + ')', 'town', 'town')} n ON n.town = r.town)"
_BLOCKS = f"(SELECT r.muni, n.a AS town, block, rep_flag, addr_flag, lat::DOUBLE AS lat, lon::DOUBLE AS lon FROM {sql('block_reference')} r JOIN {_norm_sql('(SELECT DISTINCT town FROM ' + sql('block_reference') + ')', 'town', 'town')} n ON n.town = r.town)"


def _geocode_sql(rows: str) -> str:
    """address, lat, lon, level of the different addresses of rows of seq and address."""
    return f"""(WITH p AS (SELECT s.address AS raw, t.* FROM {_town_sql(rows)} t JOIN {rows} s USING (seq)), t1 AS (SELECT muni, town, min(struct_pack(a := lat, b := lon)) AS m FROM {_TOWNS} GROUP BY 1, 2),
        b1 AS (SELECT muni, town, block, min(struct_pack(r := -coalesce(TRY_CAST(rep_flag AS INT), 0), f := -coalesce(TRY_CAST(addr_flag AS INT), 0), a := lat, b := lon)) AS m FROM {_BLOCKS} GROUP BY 1, 2, 3), c1 AS (SELECT muni, avg(lat) AS a, avg(lon) AS b FROM {_TOWNS} GROUP BY 1),
        k AS (SELECT *, CASE WHEN chome <= 99 THEN town || chome || '丁目' END AS named FROM p)
        SELECT DISTINCT k.raw AS address, coalesce(x1.m.a, x2.m.a, y1.m.a, y2.m.a, c1.a) AS lat, coalesce(x1.m.b, x2.m.b, y1.m.b, y2.m.b, c1.b) AS lon,
            CASE WHEN x1.m IS NOT NULL OR x2.m IS NOT NULL THEN 'gaiku' WHEN y1.m IS NOT NULL OR y2.m IS NOT NULL THEN 'oaza_chome' WHEN c1.a IS NOT NULL THEN 'muni_centroid' END AS level
        FROM k LEFT JOIN b1 x1 ON x1.muni = k.muni AND x1.town = CASE WHEN k.chome IS NULL THEN k.town ELSE k.named END AND x1.block = k.block::VARCHAR LEFT JOIN b1 x2 ON x2.muni = k.muni AND k.named IS NOT NULL AND k.block IS NOT NULL AND x2.town = k.town AND x2.block = k.chome::VARCHAR
        LEFT JOIN t1 y1 ON y1.muni = k.muni AND y1.town = k.named LEFT JOIN t1 y2 ON y2.muni = k.muni AND y2.town = k.town LEFT JOIN c1 ON c1.muni = k.muni)"""


@query(f"SELECT address, round(lat, 9) AS lat, round(lon, 9) AS lon, level FROM {_geocode_sql(sql('addresses'))}")
def geocoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    towns, blocks = view(spark, sf_dir, "town_reference"), view(spark, sf_dir, "block_reference")
    out = geocode.geocode(view(spark, sf_dir, "addresses"), geocode.block_index(blocks), geocode.town_index(towns), geocode.centroid_index(towns))
    return out.select("address", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"), "level")


# --- text mining and pages -----------------------------------------------------------


# The references that the pages have, replaced one after the other; & itself comes last.
_PLAIN = """replace(replace(replace(replace(replace(html, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&#39;', ''''), '&amp;', '&')"""
_PAGE_TEXT = f"regexp_replace(regexp_replace(regexp_replace({_PLAIN}, '<br ?/?>', chr(10), 'g'), '<[^>]+>', chr(10), 'g'), '[ \\t\\r\\f\\x0B]+', ' ', 'g')"


@query(f"SELECT page_id, {_PAGE_TEXT} AS text FROM pages")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", ff.html_to_text(F.col("html")).alias("text"))


@query("SELECT page_id, NOT regexp_matches(lower(split_part(url, '?', 1)), '\\.(pdf|docx?|xlsx?|pptx?|zip|csv)$') AS supported FROM pages")
def page_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", ff.supported_url(F.col("url")).alias("supported"))


@query(
    f"""WITH n AS (SELECT seq, a FROM {_norm_sql(sql("addresses"), "address", "seq")}), t AS (SELECT seq, coalesce(nullif(regexp_extract(a, '^(東京都.+?号)', 1), ''), nullif(regexp_extract(a, '^(東京都.+?[0-9]{{1,4}}-[0-9]{{1,4}}(?:-[0-9]{{1,4}})?).*$', 1), ''), nullif(regexp_extract(a, '^(東京都.+?[0-9]+丁目).*$', 1), ''), a) AS address FROM n)
        SELECT seq, address FROM t WHERE regexp_matches(address, '[0-9]+丁目|[0-9]+-[0-9]+|[0-9]+番|[0-9]+号')"""
)
def mined_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses mined from a line of text around each one."""
    rows = view(spark, sf_dir, "addresses").select("seq", F.concat(F.lit("所在地: "), F.ltrim(F.regexp_replace("address", "　", "")), F.lit("（本館） TEL 03-1111-2222\n以上")).alias("text"))
    return rows.select("seq", F.explode(address_candidates(F.col("text"))).alias("address"))


@query(
    f"""WITH n AS (SELECT seq, a FROM {_norm_sql(sql("addresses"), "address", "seq")}), s AS (SELECT seq, a, 10 * CAST(contains(a, '丁目') OR contains(a, '-') AS INT) + 20 * CAST(regexp_matches(a, '[0-9]+番[0-9]*号?|[0-9]+-[0-9]+') AS INT) - 5 * CAST(ends_with(a, '丁目') AS INT)
            + CASE WHEN contains(a, '港区') THEN 20 ELSE -40 END + 30 * CAST(contains(a, '東京都港区') AS INT) + 40 + 10 * CAST(contains(a, '港区') AS INT) AS score FROM n)
        SELECT seq % 500 AS site, max(score) AS score, arg_min(a, (-score, a)) AS address FROM s GROUP BY 1"""
)
def best_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the addresses on a site's pages the one with the best score."""
    rows = view(spark, sf_dir, "addresses").select((F.col("seq") % 500).alias("site"), "seq", fa.normalize_addr(F.col("address")).alias("address"))
    rows = rows.withColumn("page", F.concat(F.lit("当社の本社 "), "address"))
    rows = rows.withColumn("score", candidate_score(F.lit("本社"), F.lit("東京都港区"), F.col("address"), F.col("page")))
    return master.first_by(rows, ["site"], F.col("score").desc(), F.col("address"), F.col("seq")).select("site", "score", "address")


@query("SELECT event_id, CAST(length(event_type) AS DOUBLE) + 1000 AS number, event_id % 4 = 0 AS bad FROM events")
def safe_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit(" 1,00"), F.length("event_type").cast("string"))
    text = F.when(F.length("event_type") >= 10, F.concat(F.lit(" 1,0"), F.length("event_type").cast("string"))).otherwise(text)
    bad = ff.to_float(F.when(F.col("event_id") % 4 == 0, F.lit("n/a")).otherwise(text)).isNull()
    return _table(spark, sf_dir, "events").select("event_id", ff.to_float(text).alias("number"), bad.alias("bad"))


@query("SELECT o_orderkey, list_filter(list_transform(string_split('u' || o_custkey || ' | |v' || o_orderkey, '|'), lambda x: trim(x)), lambda x: x <> '') AS urls FROM orders")
def url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit(" | |v"), F.col("o_orderkey").cast("string"))
    return _table(spark, sf_dir, "orders").select("o_orderkey", ff.url_list(text).alias("urls"))


# --- tables of filings ------------------------------------------------------------------

#: Three layouts of the facilities table, by nation: two header rows, book value and area in one cell, a column of places.
_LAYOUTS = (
    "<table><tr><td>事業所名<br>(所在地)</td><td>設備の内容</td><td colspan=\"2\">土地</td></tr><tr><td></td><td></td><td>面積(㎡)</td><td>帳簿価額(百万円)</td></tr>"
    "<tr><td>本社<br>(東京都千代田区)</td><td>事務所</td><td>{area}</td><td>{book}</td></tr><tr><td>工場{key}<br>(東京都大田区)他</td><td>工場</td><td>{area2}</td><td>{book2}</td></tr><tr><td>合計</td><td></td><td>1</td><td>2</td></tr></table>",
    "<table><tr><th>事業所名(所在地)</th><th>設備の内容</th><th>土地 帳簿価額(千円)(面積㎡)</th></tr><tr><td>支店{key}<br>(東京都港区)</td><td>店舗</td><td>{book}({area})</td></tr><tr><td></td><td></td><td>※2</td></tr></table>",
    "<table><tr><td rowspan=\"2\">名称</td><td rowspan=\"2\">所在地</td><td rowspan=\"2\">設備の内容</td><td colspan=\"2\">土地</td></tr><tr><td>面積（千㎡）</td><td>帳簿価額（百万円）</td></tr>"
    "<tr><td>倉庫{key}</td><td>神奈川県横浜市</td><td>物流倉庫</td><td>{area2}</td><td>{book2}</td></tr><tr><td>倉庫{key}</td><td>神奈川県横浜市</td><td>倉庫</td><td>7</td><td>{book2}</td></tr></table>",
)
_FILING = "<html><body><table><tr><td>事業所名</td><td>土地面積</td><td>土地帳簿価額</td></tr><tr><td>別表(東京都)</td><td>1</td><td>2</td></tr></table><ix:nonNumeric name=\"jpcrp_cor:MajorFacilitiesTextBlock\"><h3>主要な設備の状況</h3>{layout}<p>{note}</p></ix:nonNumeric></body></html>"
_HEAD_NOTE, _PLAIN_NOTE = "本社欄に記載の土地は 各所に所在しております。", "賃借している設備があります。"


def _filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, html: a filing for each customer."""
    key = F.col("c_custkey")
    values = {"area": F.format_number(key % 7000 + 1000, 0), "book": F.format_number(key % 900 + 1, 0), "key": key.cast("string"), "area2": F.concat(F.lit("※1 "), (key % 50 + 5).cast("string")), "book2": (key % 70 + 3).cast("string")}
    values["note"] = F.when(F.col("c_mktsegment") == "BUILDING", _HEAD_NOTE).otherwise(_PLAIN_NOTE)
    filled = lambda text: F.concat(*[values[part] if k % 2 else F.lit(part) for k, part in enumerate(re.split(r"\{(\w+)\}", text))])
    which = F.col("c_nationkey") % 3
    values["layout"] = F.when(which == 0, filled(_LAYOUTS[0])).when(which == 1, filled(_LAYOUTS[1])).otherwise(filled(_LAYOUTS[2]))
    return _table(spark, sf_dir, "customer").select(key.alias("doc_id"), filled(_FILING).alias("html"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checkpointed(filings.parsed_filings(_filings(spark, sf_dir), "doc_id", "html", tagged=True, partitions=spark.sparkContext.defaultParallelism))


@query(
    """SELECT c_custkey AS doc_id, '本社' AS site_name, '東京都千代田区' AS location, false AS has_hoka, (c_custkey % 7000 + 1000)::DOUBLE AS area, (c_custkey % 900 + 1)::DOUBLE * 1000000 AS book, '事務所' AS equipment FROM customer WHERE c_nationkey % 3 = 0 AND c_mktsegment <> 'BUILDING'
        UNION ALL SELECT c_custkey, '工場' || c_custkey, '東京都大田区', true, (c_custkey % 50 + 5)::DOUBLE, (c_custkey % 70 + 3)::DOUBLE * 1000000, '工場' FROM customer WHERE c_nationkey % 3 = 0
        UNION ALL SELECT c_custkey, '支店' || c_custkey, '東京都港区', false, (c_custkey % 7000 + 1000)::DOUBLE, (c_custkey % 900 + 1)::DOUBLE * 1000, '店舗' FROM customer WHERE c_nationkey % 3 = 1
        UNION ALL SELECT c_custkey, '倉庫' || c_custkey, '神奈川県横浜市', false, 7000, (c_custkey % 70 + 3)::DOUBLE * 1000000, '倉庫' FROM customer WHERE c_nationkey % 3 = 2"""
)
def filing_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facilities of tagged blocks in three layouts, without head offices whose land is listed elsewhere."""
    parsed = _parsed(spark, sf_dir)
    heads = filings.section_texts(parsed).filter(filings.skips_head_office(F.col("text"))).select("doc_id")
    found, _ = filings.facilities(filings.merge_continuations(parsed.filter("table_idx >= 0")), heads)
    return found.select("doc_id", "site_name", "location", "has_hoka", "area", "book", "equipment")


@query(
    f"""SELECT c_custkey AS doc_id, '主要な設備の状況' AS title, CASE WHEN c_mktsegment = 'BUILDING' THEN '{_HEAD_NOTE}' ELSE '{_PLAIN_NOTE}' END AS note, CASE c_nationkey % 3 WHEN 0 THEN '本社' WHEN 1 THEN '支店' || c_custkey ELSE '倉庫' || c_custkey || '神奈川県横浜市物流倉庫※1 ' || (c_custkey % 50 + 5) || (c_custkey % 70 + 3) END AS site,
        CASE c_nationkey % 3 WHEN 0 THEN 10 WHEN 1 THEN 6 ELSE 6 END AS n_lines FROM customer"""
)
def section_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last line, the first site's line and the number of lines of every section."""
    lines = F.split("text", "\n")
    site = F.filter(lines, lambda x: F.rlike(x, F.lit("^(本社|支店|倉庫)")) & ~F.contains(x, F.lit("記載")))
    return filings.section_texts(_parsed(spark, sf_dir)).select("doc_id", F.element_at(lines, 1).alias("title"), F.element_at(lines, -1).alias("note"), F.element_at(site, 1).alias("site"), F.size(lines).alias("n_lines"))


@query("SELECT l_orderkey AS doc_id, l_linenumber AS c, coalesce(last_value(CASE WHEN l_linenumber % 2 = 1 THEN l_returnflag END IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber ROWS UNBOUNDED PRECEDING), '') AS filled FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1, 2)")
def header_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("c")).agg(F.min("l_returnflag").alias("_f"))
    cells = cells.select("doc_id", F.lit(0).alias("table_idx"), F.lit(0).alias("r"), "c", F.when(F.col("c") % 2 == 1, F.col("_f")).alias("txt"))
    return filings.forward_fill(cells).select("doc_id", "c", "filled")


@query("SELECT o_custkey AS doc_id, o_orderstatus AS site_name, count(*) AS n, max(o_orderkey) AS kept FROM orders GROUP BY 1, 2")
def last_of_equal_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("site_name"), F.lit("x").alias("location"), F.col("o_orderkey").alias("kept"))
    counts = rows.groupBy("doc_id", "site_name").agg(F.count(F.lit(1)).alias("n"))
    return filings.last_of_equals(rows).join(counts, ["doc_id", "site_name"]).select("doc_id", "site_name", "n", "kept")


@query(f"SELECT url, {_PAGE_TEXT} AS text FROM pages UNION ALL SELECT 'filing://' || c_custkey || '/d1/major-facilities', c_name FROM customer")
def page_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = _table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("code"), F.lit("d1").alias("doc_id"), F.col("c_name").alias("text"))
    return page_texts(_table(spark, sf_dir, "pages").select("url", "html"), sections)


# --- distances on the ellipsoid ----------------------------------------------------------


def _geodesic_sql(rows: str) -> str:
    """rows of lat1, lon1, lat2, lon2 with dist_m, the inverse problem in as many steps as ``geo.with_geodesic`` takes."""
    a, f = geo.A, geo.FLAT
    b = a * (1 - f)
    out = f"(SELECT *, atan(tan(radians(lat1)) * {1 - f!r}) AS u1, atan(tan(radians(lat2)) * {1 - f!r}) AS u2, radians(lon2 - lon1) AS l FROM {rows})"
    out = f"(SELECT *, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, l AS m FROM {out})"
    for k in range(5):
        out = f"(SELECT *, sqrt(pow(c2 * sin(m), 2) + pow(c1 * s2 - s1 * c2 * cos(m), 2)) AS ss, s1 * s2 + c1 * c2 * cos(m) AS cs FROM {out})"
        out = f"(SELECT *, atan2(ss, cs) AS sigma, CASE WHEN ss = 0 THEN 0 ELSE c1 * c2 * sin(m) / ss END AS sa FROM {out})"
        out = f"(SELECT *, CASE WHEN 1 - sa * sa = 0 THEN 0 ELSE cs - 2 * s1 * s2 / (1 - sa * sa) END AS c2m, {f!r} / 16 * (1 - sa * sa) * (4 + {f!r} * (4 - 3 * (1 - sa * sa))) AS cc FROM {out})"
        if k < 4:
            out = f"(SELECT * EXCLUDE (ss, cs, sigma, sa, c2m, cc) REPLACE (l + (1 - cc) * {f!r} * sa * (sigma + cc * ss * (c2m + cc * cs * (2 * c2m * c2m - 1))) AS m) FROM {out})"
    out = f"(SELECT *, (1 - sa * sa) * {(a * a - b * b) / (b * b)!r} AS uu FROM {out})"
    out = f"(SELECT *, 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu))) AS aa, uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu))) AS bb FROM {out})"
    turn = "cs * (2 * c2m * c2m - 1) - bb / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3)"
    steps = "u1, u2, l, s1, c1, s2, c2, m, ss, cs, sigma, sa, c2m, cc, uu, aa, bb"
    return f"(SELECT * EXCLUDE ({steps}), {b!r} * aa * (sigma - bb * ss * (c2m + bb / 4 * ({turn}))) AS dist_m FROM {out})"


_PLACES = f"(SELECT s_suppkey AS query_id, 35 + CAST(s_suppkey * 7919 % 1000 AS DOUBLE) / 1024 AS lat1, 139 + CAST(s_suppkey * 104729 % 700 AS DOUBLE) / 1024 AS lon1 FROM supplier)"
_PAIRS = f"(SELECT query_id, lat1, lon1, point_id, lat AS lat2, lon AS lon2 FROM {_PLACES}, {sql('price_points')})"


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    rows = _table(spark, sf_dir, "supplier").select(key.alias("query_id"), (35 + (key * 7919 % 1000).cast("double") / 1024).alias("lat"), (139 + (key * 104729 % 700).cast("double") / 1024).alias("lon"), F.lit("").alias("scope"))
    return run.placed(rows)


@query(
    f"""SELECT query_id, CAST(rank AS INT) AS rank, point_id, round(dist_m, 3) AS dist_m FROM (SELECT query_id, point_id, dist_m, row_number() OVER (PARTITION BY query_id ORDER BY round(dist_m * 1e6), point_id) AS rank
        FROM {_geodesic_sql(_PAIRS)}) WHERE rank <= 3"""
)
def geodesic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three points nearest to each supplier's place, by the distance on the ellipsoid."""
    points = run.placed(view(spark, sf_dir, "price_points").withColumn("scope", F.lit("")))
    return knn.geodesic_knn_join(_places(spark, sf_dir), points, 3).select("query_id", F.col("rank").cast("int").alias("rank"), "point_id", F.round("dist_m", 3).alias("dist_m"))


# --- addresses from pages ------------------------------------------------------------------

_PAGE_ADDRESSES = "(SELECT 'p/' || c_custkey AS url, '東京都港区六本木' || (c_custkey % 7 + 1) || '丁目' || (c_custkey % 40 + 1) || '番' || (c_custkey % 9 + 1) || '号' AS address, c_custkey % 5 AS s FROM customer UNION ALL SELECT 'p/' || c_custkey, '東京都中央区日本橋' || (c_custkey % 8 + 1) || '-' || (c_custkey % 30 + 1), c_custkey % 5 FROM customer)"
_PAGE_SCORE = """CASE WHEN contains(address, substr(location, 4)) THEN 50 ELSE -40 END + 10 + 20 + CASE WHEN site_name = 'S' || s THEN 40 ELSE 0 END + 10"""


@query(
    f"""WITH u AS (SELECT DISTINCT code, seq, site_name, has_hoka, location, unnest(['p/' || code, 'p/' || (seq % 700)]) AS url FROM {sql("site_urls")}),
        c AS (SELECT u.*, address, {_PAGE_SCORE} AS score FROM u JOIN {_PAGE_ADDRESSES} USING (url)),
        b AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY score DESC, address, CASE WHEN url = 'p/' || code THEN 0 ELSE 1 END) AS n FROM c)
        SELECT code, seq, address, CAST(score AS INT) AS score, url AS source_url, NOT has_hoka AND NOT ends_with(site_name, '他') AND score >= 40 AS accepted FROM b WHERE n = 1"""
)
def web_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each site the best address on the pages that it names, and whether it is good enough."""
    rows = view(spark, sf_dir, "site_urls").withColumn("source_urls", ff.url_list(F.col("urls"))).drop("urls")
    return web.best_addresses(rows, page_texts(view(spark, sf_dir, "address_pages"))).select("code", "seq", "address", "score", "source_url", "accepted")


# --- the whole run ---------------------------------------------------------------------------

_BAD_NAME = "regexp_replace(coalesce(company_name, ''), '\\s+', '', 'g') IN ('', code)"
_ACCEPTED = f"(SELECT * FROM {sql('companies')} WHERE NOT {_BAD_NAME} AND market_cap IS NOT NULL)"
#: The pages that each company names, and the best accepted address for each of its sites on them.
_RUN_URLS = ["'p/' || code", "'p/' || (CAST(code AS BIGINT) % 97)"]
_PLAIN_PLACE = "replace(replace(location, '五番町', '5番町'), '九丁目', '9丁目')"
_PLACE_MUNI = "nullif(regexp_extract(location, '^東京都(.+?[区市町村])', 1), '')"
_RUN_WEB = f"""(
    WITH u AS (SELECT DISTINCT code, site_name, location, has_hoka, {_PLAIN_PLACE} AS place, {_PLACE_MUNI} AS muni, nth, CASE nth WHEN 1 THEN {_RUN_URLS[0]} ELSE {_RUN_URLS[1]} END AS url FROM x JOIN {_ACCEPTED} c USING (code), (VALUES (1), (2)) AS t(nth)),
    c AS (SELECT u.*, address, CASE WHEN muni IS NULL THEN 0 WHEN contains(address, muni) THEN 20 ELSE -40 END + CASE WHEN contains(address, place) THEN 30 ELSE 0 END + 30 + CASE WHEN site_name = 'S' || s THEN 40 ELSE 0 END + CASE WHEN muni IN ('港区', '中央区', '府中市') THEN 10 ELSE 0 END AS score
        FROM u JOIN {_PAGE_ADDRESSES} USING (url)),
    b AS (SELECT *, row_number() OVER (PARTITION BY code, site_name, location, has_hoka ORDER BY score DESC, address, nth) AS n FROM c)
    SELECT code, site_name, location, has_hoka, address, url FROM b WHERE n = 1 AND score >= 40 AND NOT has_hoka AND NOT ends_with(site_name, '他'))"""


def _run_sql(web: bool = False, k: int = 3, match: bool = True) -> str:
    """The CTEs of a run: x (sites after splits) up to rows (values) and t (totals)."""
    found = f"LEFT JOIN {_RUN_WEB} w ON w.code = x.code AND w.site_name = x.site_name AND w.location = x.location AND w.has_hoka = x.has_hoka" if web else "LEFT JOIN (SELECT NULL::VARCHAR AS address, NULL::VARCHAR AS url) w ON false"
    return f"""
    WITH x AS (SELECT * FROM {_expanded_sql(sql("filed_sites"), "location")} WHERE reject_reason IS NULL AND starts_with(location, '東京都')),
    a AS (SELECT x.*, c.company_name, c.market_cap, coalesce(o.address, w.address, x.location) AS address, CASE WHEN o.address IS NOT NULL THEN 'override' WHEN w.address IS NOT NULL THEN 'web' ELSE 'securities_report' END AS source, CASE WHEN o.address IS NULL THEN w.url END AS source_url, p.unit_price AS fixed, {_FAMILY} AS family
        FROM x JOIN {_ACCEPTED} c USING (code) LEFT JOIN {_FLAT} o USING (code, site_name) {found} LEFT JOIN {sql("price_overrides")} p ON p.code = x.code AND p.site_name = x.site_name),
    g AS (SELECT * FROM {_geocode_sql("(SELECT DISTINCT address, address AS seq FROM a)")} WHERE level IS NOT NULL),
    r AS (SELECT a.*, g.lat, g.lon, g.level FROM a JOIN g USING (address)),
    pl AS (SELECT DISTINCT lat AS lat1, lon AS lon1 FROM r WHERE fixed IS NULL),
    d AS (SELECT lat1, lon1, point_id, price, kind, dist_m, {_FAMILY_OF.replace("p.kind", "kind")} AS pf FROM {_geodesic_sql(f"(SELECT lat1, lon1, p.lat AS lat2, p.lon AS lon2, p.point_id, p.price, p.kind FROM pl, {sql('price_points')} p)")}),
    near AS (SELECT lat1, lon1, min(struct_pack(d := round(dist_m * 1e6), i := point_id, k := kind, m := dist_m)) AS n FROM d GROUP BY 1, 2),
    own AS (SELECT lat1, lon1, pf, min(struct_pack(d := round(dist_m * 1e6), i := point_id, k := kind, m := dist_m)) AS n FROM d WHERE pf IS NOT NULL GROUP BY 1, 2, 3),
    f AS (SELECT DISTINCT lat AS lat1, lon AS lon1, family FROM r WHERE fixed IS NULL),
    seed AS (SELECT f.*, CASE WHEN {str(not match).lower()} THEN '' WHEN own.n IS NULL OR own.n.m > 1500 THEN near.n.k ELSE own.n.k END AS kind FROM f JOIN near USING (lat1, lon1) LEFT JOIN own ON own.lat1 = f.lat1 AND own.lon1 = f.lon1 AND own.pf = f.family),
    k AS (SELECT *, row_number() OVER (PARTITION BY lat1, lon1, target ORDER BY round(dist_m * 1e6), point_id) AS rank FROM (SELECT d.*, s.kind AS target FROM d JOIN (SELECT DISTINCT lat1, lon1, kind FROM seed) s USING (lat1, lon1) WHERE s.kind = '' OR d.kind = s.kind)),
    e AS (SELECT lat1, lon1, target, round(sum(price / pow(dist_m + 1, 3)) / sum(1 / pow(dist_m + 1, 3))) AS price, list(struct_pack(i := point_id, k := kind, d := dist_m, p := price) ORDER BY rank) AS n, max(dist_m) AS max_dist, var_pop(dist_m) AS variance FROM k WHERE rank <= {k} GROUP BY 1, 2, 3),
    v AS (SELECT r.*, e.n, coalesce(seed.kind, '') AS target, coalesce(fixed, e.price) AS price, coalesce(max_dist, 0) AS max_dist, coalesce(variance, 0) AS variance, CASE WHEN fixed IS NULL THEN {_FACTOR} ELSE 1 END AS factor, CASE WHEN fixed IS NULL THEN {_SCORE} ELSE 1 END AS score,
        count(*) OVER w >= 2 AND sum(round(area, 2)) OVER w >= 50000 AS again FROM r LEFT JOIN seed ON fixed IS NULL AND seed.lat1 = r.lat AND seed.lon1 = r.lon AND seed.family IS NOT DISTINCT FROM r.family LEFT JOIN e ON e.lat1 = seed.lat1 AND e.lon1 = seed.lon1 AND e.target = seed.kind
        WINDOW w AS (PARTITION BY code, address)),
    o AS (SELECT *, CASE WHEN fixed IS NULL THEN {_LABEL.format(s="score")} ELSE 'override' END AS label, round_even(price * factor, 0) AS unit, price * factor * area AS est_raw, CASE WHEN book <> 0 THEN price * factor * area / book END AS multiple, CASE WHEN market_cap <> 0 THEN price * factor * area / market_cap END AS ratio, round_even(book, 0) AS book_int FROM v),
    rows AS (SELECT *, round_even(unit * area, 0) AS est FROM o),
    t AS (SELECT code, company_name, c.market_cap, coalesce(sum(est), 0) AS est, coalesce(sum(book_int), 0) AS book_int, coalesce(sum(est_raw), 0) AS est_raw, coalesce(sum(book), 0) AS book FROM {_ACCEPTED} c LEFT JOIN (SELECT code, est, book_int, est_raw, book FROM rows) USING (code) GROUP BY 1, 2, 3)
"""


_RUN = _run_sql()
_FIX = lambda x, n: f"CAST(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 16)) AS DECIMAL(38, {n}))::VARCHAR"  # noqa: E731  (a decimal text, rounded half up)
_SHOWN = {
    "code": "code", "company_name": "company_name", "site_name": "site_name", "address": "address", "address_source": "source", "address_source_url": "coalesce(source_url, '')", "level": "level", "area": f"{_FIX('area', 2)}", "unit_price": "CAST(unit AS BIGINT)",
    "factor": f"{_FIX('factor', 6)}", "geocode_factor": f"{_FIX('factor', 6)}", "method": "CASE WHEN fixed IS NULL THEN 'idw(k=3,p=3)+landuse_match' ELSE 'override' END", "target_kind": "target", "nearest_kind": "coalesce(n[1].k, '')", "nearest_id": "coalesce(n[1].i, '')",
    "nearest_dist": f"{_FIX('coalesce(n[1].d, 0)', 3)}", "knn_ids": "coalesce(array_to_string(list_transform(n, lambda x: x.i), '|'), '')", "knn_kinds": "coalesce(array_to_string(list_transform(n, lambda x: x.k), '|'), '')",
    "knn_dist": f"coalesce(array_to_string(list_transform(n, lambda x: {_FIX('x.d', 3)}), '|'), '')", "knn_prices": "coalesce(array_to_string(list_transform(n, lambda x: CAST(x.p AS VARCHAR)), '|'), '')", "variance": f"{_FIX('variance', 3)}", "max_dist": f"{_FIX('max_dist', 3)}",
    "score": f"{_FIX('score', 6)}", "label": "label", "warnings": f"concat_ws(' | ', {_WARN}, CASE WHEN again THEN '{fv.REPEATED_ADDRESS}' END)", "est": "CAST(est AS BIGINT)", "book": "CAST(book_int AS BIGINT)", "gain": "CAST(est - book_int AS BIGINT)",
    "multiple_raw": f"coalesce({_FIX('multiple', 6)}, '')", "multiple": f"coalesce({_FIX('multiple', 3)}, '')", "market_cap": "market_cap", "ratio_raw": f"coalesce({_FIX('ratio', 6)}, '')", "ratio": f"coalesce({_FIX('ratio', 3)}, '')",
}
_SHOWN_TOTAL = {"code": "code", "company_name": "company_name", "site_name": f"'{run.TOTAL}'", "method": "'idw(k=3,p=3)+landuse_match'", "unit_price": "NULL", "est": "CAST(est AS BIGINT)", "book": "CAST(book_int AS BIGINT)", "gain": "CAST(est - book_int AS BIGINT)", "market_cap": "market_cap"} | {
    f"{name}{end}": f"coalesce({_FIX(f'CASE WHEN {by} <> 0 THEN est_raw / {by} END', n)}, '')" for name, by in (("multiple", "book"), ("ratio", "market_cap")) for end, n in (("_raw", 6), ("", 3))
}


def _shown(method: str) -> str:
    """Both parts of the output's 33 columns over the CTEs of a run."""
    rows, total = _SHOWN | {"method": f"CASE WHEN fixed IS NULL THEN '{method}' ELSE 'override' END"}, _SHOWN_TOTAL | {"method": f"'{method}'"}
    return f"SELECT {', '.join(f'{rows[c]} AS {chr(34)}{name}{chr(34)}' for c, name in run.OUTPUT_COLUMNS.items())} FROM rows UNION ALL SELECT {', '.join(total.get(c, repr('')) for c in run.OUTPUT_COLUMNS)} FROM t"


def _run_inputs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """rows, overrides, splits, price overrides, and the three indexes of places."""
    of = lambda name: view(spark, sf_dir, name)
    towns, blocks = of("town_reference"), of("block_reference")
    return [of("filed_sites"), of("overrides"), of("splits"), of("price_overrides"), geocode.block_index(blocks), geocode.town_index(towns), geocode.centroid_index(towns)]


def _run(spark: SparkSession, sf_dir: str, web: bool = False, **options: object) -> tuple[DataFrame, DataFrame]:
    """(accepted companies, values of their sites)."""
    companies = run.company_reasons(view(spark, sf_dir, "companies").select("code", "company_name", "market_cap")).filter("reason IS NULL").drop("reason")
    pages = page_texts(view(spark, sf_dir, "address_pages")) if web else None
    asked = companies.withColumn("source_urls", F.array(F.concat(F.lit("p/"), "code"), F.concat(F.lit("p/"), (F.col("code").cast("long") % 97).cast("string")))) if web else companies
    return companies, run.site_values(asked, *_run_inputs(spark, sf_dir), view(spark, sf_dir, "price_points"), pages, **options)


@query(f"{_RUN} {_shown('idw(k=3,p=3)+landuse_match')}")
def valuation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 33 columns of the output for all accepted companies, from filed sites to total rows."""
    companies, values = _run(spark, sf_dir)
    return run.output_rows(companies, stored(values), decimals=6)


@query(f"{_run_sql(k=1, match=False)} {_shown('nearest')}")
def valuation_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the price of the nearest point of any land use."""
    options = {"price_method": "nearest", "landuse_match": False}
    companies, values = _run(spark, sf_dir, **options)
    return run.output_rows(companies, stored(values), decimals=6, **options)


@query(f"{_run_sql(web=True)} {_shown('idw(k=3,p=3)+landuse_match')}")
def valuation_web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with addresses from the pages that the companies name, where there is no override."""
    companies, values = _run(spark, sf_dir, web=True)
    return run.output_rows(companies, stored(values), decimals=6)


@query(f"{_RUN} SELECT code, seq, pos, site_name, address, level, method FROM (SELECT *, CASE WHEN fixed IS NULL THEN 'idw' ELSE 'override' END AS method FROM r)")
def regional_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sites in the region after their splits, with the address that counts, its level and how a price is found."""
    return _run(spark, sf_dir)[1].select("code", "seq", "pos", "site_name", "address", "level", F.substring_index("method", "(", 1).alias("method"))


# Companies without an urgent order have no filing here, codes of a nineteenth are no targets, and without centroids some addresses stay unresolved.
_OUTCOMES = f"""
    WITH co AS (SELECT c.*, CASE WHEN {_BAD_NAME} THEN '{run.NO_NAME}' WHEN NOT EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = '1-URGENT' AND CAST(o_custkey AS VARCHAR) = code) THEN '{run.NO_FILING}' WHEN market_cap IS NULL THEN '{run.NO_MARKET_VALUE}' END AS reason FROM {sql("companies")} c WHERE CAST(code AS BIGINT) % 19 > 0),
    xs AS (SELECT x.*, co.code IS NOT NULL AS is_target, co.reason AS by_company FROM {_expanded_sql(sql("filed_sites"), "location")} x LEFT JOIN co USING (code)),
    ys AS (SELECT xs.*, coalesce(o.address, location) AS address, CASE WHEN by_company IS NOT NULL OR NOT is_target THEN 'company' WHEN reject_reason IS NOT NULL THEN 'split' WHEN NOT starts_with(location, '東京都') THEN 'region' END AS early FROM xs LEFT JOIN {_FLAT} o USING (code, site_name)),
    gs AS (SELECT * FROM {_geocode_sql("(SELECT DISTINCT address, address AS seq FROM ys WHERE early IS NULL)")} WHERE level IS NOT NULL AND level <> 'muni_centroid'),
    sites AS (SELECT ys.*, coalesce(early, CASE WHEN gs.level IS NULL THEN 'geocode' END) AS stage,
        CASE WHEN by_company IS NOT NULL THEN by_company WHEN NOT is_target THEN '{run.NO_TARGET}' WHEN early = 'split' THEN '{run.OVER_ALLOCATED}' WHEN early = 'region' THEN '{run.ELSEWHERE}' WHEN gs.level IS NULL THEN '{run.UNRESOLVED}' END AS reason FROM ys LEFT JOIN gs USING (address))
"""


def _traced(spark: SparkSession, sf_dir: str) -> run.Traced:
    """A run over the companies of most codes, without centroids of municipalities."""
    targets = view(spark, sf_dir, "companies").select("code", "company_name", "market_cap").filter(F.col("code").cast("long") % 19 > 0)
    filed = _table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").cast("string").alias("code"))
    *inputs, centroids = _run_inputs(spark, sf_dir)
    return run.trace(targets, *inputs, centroids.limit(0), filings=filed)


@query(f"{_OUTCOMES} SELECT 'company' AS stage, code, NULL::VARCHAR AS site_name, NULL::BIGINT AS seq, NULL::INT AS pos, reason FROM co WHERE reason IS NOT NULL UNION ALL SELECT stage, code, site_name, seq, pos, reason FROM sites WHERE reason IS NOT NULL")
def run_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What doesn't come through a run, with the stage and the reason; codes that are no target are left out of the targets on purpose."""
    return run.rejects(_traced(spark, sf_dir))


@query(f"{_OUTCOMES} SELECT 'company' AS item, CASE WHEN reason IS NULL THEN '' ELSE 'company' END AS stage, coalesce(reason, '') AS reason, count(*) AS n FROM co GROUP BY ALL UNION ALL SELECT 'site', coalesce(stage, ''), coalesce(reason, ''), count(*) FROM sites GROUP BY ALL")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of the same run, taken while its rows are written."""
    return run.report(_traced(spark, sf_dir))
