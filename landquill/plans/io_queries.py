"""Registered queries of sources, sinks and streams: files that are written from the tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landquill.functions import address as fa
from landquill.functions import geo
from landquill.operators import knn, master, ranking
from landquill.plans.adapters import sql, view
from landquill.plans.queries import _GOOD, ORACLE_SQL, QUERIES, _table, query
from landquill.plans.run import ranking_payload
from landquill.shared import shared_folder, stored
from landquill.sources import sinks, tables
from landquill.streaming.ingest import current, ingest


__all__ = ["ORACLE_SQL", "QUERIES"]


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS company_name, CAST(c_custkey % 900 AS BIGINT) * 1000 AS market_cap, 'http://' || c_custkey || ',http://b' AS urls FROM customer")
def target_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A target list with header, grouped thousands and blank rows."""
    path, key = _path(spark, "targets"), F.col("c_custkey")
    quoted = F.concat(F.lit('"'), F.format_number(key % 900 * 1000, 0), F.lit('"'))
    lines = _table(spark, sf_dir, "customer").select(F.concat(key.cast("string"), F.lit(","), "c_name", F.lit(","), quoted, F.lit(",http://"), key.cast("string"), F.lit("| |http://b")).alias("value"))
    head = spark.createDataFrame([("code,company_name,market_cap,address_source_urls",), (",,,",)], "value string")
    head.unionByName(lines).coalesce(1).write.text(path)
    return tables.read_targets(spark, path).select("code", "company_name", "market_cap", F.array_join("address_source_urls", ",").alias("urls"))


@query(f"SELECT muni, town, block, CAST(lat AS DOUBLE) AS lat, rep_flag FROM {sql('block_reference')}")
def block_reference_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address reference of blocks as a file of another encoding."""
    path = _path(spark, "blocks")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows = view(spark, sf_dir, "block_reference")
    rows.select(*[F.col(short).alias(name) for name, short in tables.BLOCK_COLUMNS.items()]).write.option("header", True).option("encoding", "windows-31j").csv(path)
    return tables.read_reference(spark, path, tables.BLOCK_COLUMNS).select("muni", "town", "block", F.col("lat").cast("double").alias("lat"), "rep_flag")


@query(f"SELECT muni, town, CAST(lon AS DOUBLE) AS lon FROM {sql('town_reference')}")
def town_reference_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address reference of towns, each file in the encoding that decodes it."""
    path = _path(spark, "towns")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows = view(spark, sf_dir, "town_reference").select(*[F.col(short).alias(name) for name, short in tables.TOWN_COLUMNS.items()])
    split = F.xxhash64("緯度", "経度") % 2 == 0
    rows.filter(split).write.option("header", True).option("encoding", "windows-31j").csv(f"{path}/a")
    rows.filter(~split).write.option("header", True).csv(f"{path}/b")
    return tables.read_mixed_csv(spark, path, list(tables.TOWN_COLUMNS)).select(F.col("市区町村名").alias("muni"), F.col("大字町丁目名").alias("town"), F.col("経度").cast("double").alias("lon"))


def _write_features(rows: DataFrame, names: dict[str, str], path: str) -> None:
    """rows: part (of files), at (place in it), a, b, c (of the id), lat, lon, price, kind. A file of features for each part, some without a place."""
    names = {k: names.get(k, k) for k in ("L01_001", "L01_002", "L01_003", "L01_008", "L01_051")}
    texts = {"L01_001": "a", "L01_002": "b", "L01_003": "c", "L01_008": "price", "L01_051": "kind"}
    own = F.struct(*[F.col(texts[k]).cast("string").alias(v) for k, v in names.items()])
    place = F.when(F.col("kind") != "", F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")))
    lines = rows.select("part", F.lit(1).alias("kind"), F.col("at").cast("long").alias("at"), F.concat(F.lit(","), F.to_json(F.struct(place.alias("geometry"), own.alias("properties")))).alias("value"))
    head, foot = F.lit('{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"{["}},"features":[{"type":"Feature","geometry":null}'), F.lit("]}")
    ends = rows.select("part").distinct().select("part", F.explode(F.array(F.struct(F.lit(0).alias("kind"), head.alias("value")), F.struct(F.lit(2).alias("kind"), foot.alias("value")))).alias("x"))
    dealt = lines.unionByName(ends.select("part", "x.kind", F.lit(0).cast("long").alias("at"), "x.value")).repartition("part")
    dealt.sortWithinPartitions("part", "kind", "at").select("part", "value").write.partitionBy("part").text(path)


def _survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "price_points")
    key = F.substring_index("point_id", "-", -1)
    return rows.select((F.col("price") % 50_000 / 1000).cast("int").alias("part"), key.cast("long").alias("at"), F.lit("13").alias("a"), (key.cast("long") % 700).alias("b"), key.alias("c"), "lat", "lon", F.when(F.col("kind") == "商業", "n/a").otherwise(F.col("price").cast("string")).alias("price"), "kind")


_SURVEY = f"SELECT '13-' || (CAST(split_part(point_id, '-', 2) AS BIGINT) % 700) || '-' || CASE WHEN length(split_part(point_id, '-', 2)) < 3 THEN lpad(split_part(point_id, '-', 2), 3, '0') ELSE split_part(point_id, '-', 2) END AS base_id, lat, lon, CASE WHEN kind = '商業' THEN 0 ELSE price END::DOUBLE AS price, kind FROM {sql('price_points')} WHERE kind <> ''"


@query(_SURVEY)
def survey_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a survey's feature files; those without a place are left out and prices that are no number are 0."""
    path = _path(spark, "survey")
    _write_features(_survey(spark, sf_dir), {}, path)
    return tables.read_points(spark, path).select("base_id", "lat", "lon", "price", "kind")


@query(
    f"""SELECT base_id, lat, CASE WHEN n = 1 THEN base_id ELSE base_id || '#' || n END AS point_id FROM (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY CAST(part AS VARCHAR), k) AS n
        FROM (SELECT '13-' || (k % 7) || '-' || lpad(CAST(k % 50 AS VARCHAR), 3, '0') AS base_id, lat, k, part FROM (SELECT CAST(split_part(point_id, '-', 2) AS BIGINT) AS k, lat, kind, price % 50000 // 1000 AS part FROM {sql('price_points')}) WHERE kind <> ''))"""
)
def survey_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a survey's points that repeat within and across its files, numbered in the order of all files."""
    path = _path(spark, "survey")
    rows = _survey(spark, sf_dir)
    _write_features(rows.withColumns({"b": F.col("at") % 7, "c": F.col("at") % 50}), {}, path)
    return knn.unique_ids(tables.read_points(spark, path), "base_id", "pos").select("base_id", "lat", "point_id")


@query(f"SELECT base_id, price, 1 AS survey FROM ({_SURVEY}) UNION ALL SELECT '23' || substr(base_id, 3), price, 2 FROM ({_SURVEY}) WHERE price >= 1000000")
def merged_surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two surveys whose files name the same properties differently, as one table without the second one's repeats."""
    one, two, rows = _path(spark, "survey"), _path(spark, "survey"), _survey(spark, sf_dir)
    _write_features(rows, {}, one)
    moved = F.when(F.col("price").try_cast("long") >= 1_000_000, F.col("lat") + 2).otherwise(F.col("lat"))
    _write_features(rows.withColumns({"a": F.lit("23"), "lat": moved}), tables.SECOND_SURVEY, two)
    merged = knn.conflate(tables.read_points(spark, one).drop("pos"), tables.read_points(spark, two, tables.SECOND_SURVEY).drop("pos"))
    return merged.select("base_id", "price", "survey")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, 'S1' AS site_name, 0 AS pos, n_name AS address, CAST(NULL AS DOUBLE) AS area FROM nation WHERE n_regionkey < 3 UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'S2', p, 'part ' || p || ' ' || n_name, n_nationkey + p FROM nation, (SELECT unnest([0, 1]) AS p) WHERE n_regionkey >= 3")
def configured_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overrides and splits of a configuration that names every nation."""
    config: dict[str, dict[str, object]] = {}
    for r in _table(spark, sf_dir, "nation").collect():  # a configuration is read by the driver
        parts = [{"name": f"P{p}", "address": f"part {p} {r['n_name']}", "area_m2": r["n_nationkey"] + p} for p in (0, 1)]
        config[str(r["n_nationkey"])] = {"S1": r["n_name"]} if r["n_regionkey"] < 3 else {"S2": parts}
    plain, splits = tables.override_tables(spark, config)
    return plain.select("code", "site_name", F.lit(0).alias("pos"), "address", F.lit(None).cast("double").alias("area")).unionByName(splits.select("code", "site_name", "pos", "address", "area"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS site_name, CAST(n_regionkey * 1000 + 1 AS BIGINT) AS unit_price FROM nation")
def configured_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "nation").collect()
    return tables.price_override_table(spark, {str(r["n_nationkey"]): {r["n_name"]: r["n_regionkey"] * 1000 + 1} for r in rows})


def _yaml(spark: SparkSession, sf_dir: str) -> str:
    """A folder of YAML files: for every customer an address, two splits, or a split or list that breaks a rule."""
    path, key = _path(spark, "overrides"), F.col("c_custkey")
    part = F.concat(F.lit("\n  - {name: P0, address: 'part of "), "c_name", F.lit("', area_m2: "))
    text = F.when(key % 3 == 0, F.concat(F.lit("\n  S1: "), "c_name")).when(key % 3 == 1, F.concat(F.lit("\n  S2:"), part, (key % 500).cast("string"), F.lit("}"), part, F.lit("1.5, book_value_yen: "), (key * 10).cast("string"), F.lit("}")))
    bad = F.when(key % 5 == 0, F.concat(part, F.lit("-1}"))).when(key % 5 == 1, F.lit("\n  - {name: P0, area_m2: 2}")).when(key % 5 == 2, F.lit(" []"))
    bad = bad.when(key % 5 == 3, F.concat(part, F.lit("3, area_m2_is_estimated: true, area_m2_source: ' '}"))).otherwise(F.concat(part, F.lit("3, area_m2_is_estimated: true, area_m2_source: notes}")))
    lines = F.concat(F.lit("'"), key.cast("string"), F.lit("':"), text.otherwise(F.concat(F.lit("\n  S3:"), bad)))
    _table(spark, sf_dir, "customer").select(lines.alias("value")).repartition(8).write.text(path)
    return path


_YAML = """(SELECT k, CAST(k AS VARCHAR) AS code, CASE k % 3 WHEN 0 THEN 'S1' WHEN 1 THEN 'S2' ELSE 'S3' END AS site_name, CASE WHEN k % 3 = 0 OR k % 15 = 2 THEN NULL ELSE p END AS pos, c_name,
    CASE WHEN k % 3 < 2 THEN NULL WHEN k % 5 = 0 THEN 'negative area' WHEN k % 5 = 1 THEN 'missing address' WHEN k % 5 = 2 THEN 'no splits' WHEN k % 5 = 3 THEN 'estimated area without a source' END AS reason
    FROM (SELECT CAST(c_custkey AS BIGINT) AS k, c_name FROM customer), (SELECT unnest([0, 1]) AS p) WHERE p = 0 OR k % 3 = 1)"""


@query(
    f"""SELECT code, site_name, pos, CASE WHEN k % 3 = 0 THEN c_name ELSE 'part of ' || c_name END AS address, CASE WHEN k % 3 = 1 THEN CASE pos WHEN 0 THEN CAST(k % 500 AS DOUBLE) ELSE 1.5::DOUBLE END WHEN k % 3 = 2 THEN 3::DOUBLE END AS area,
        CASE WHEN pos = 1 THEN CAST(k * 10 AS DOUBLE) END AS book, CASE WHEN k % 3 = 2 THEN 'notes' END AS source FROM {_YAML} WHERE reason IS NULL"""
)
def override_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses and splits from YAML files."""
    rows = tables.read_overrides(spark, _yaml(spark, sf_dir))
    return rows.filter("reason IS NULL").select("code", "site_name", "pos", "address", "area", "book", "source")


@query(f"SELECT code, site_name, pos, reason FROM {_YAML} WHERE reason IS NOT NULL")
def override_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of YAML files that break a rule, and which."""
    return tables.read_overrides(spark, _yaml(spark, sf_dir)).filter("reason IS NOT NULL").select("code", "site_name", "pos", "reason")


@query(f"SELECT code, site_name, unit_price FROM {sql('price_overrides')}")
def price_override_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of sites from YAML files, in which companies' own mappings are in one line each."""
    path = _path(spark, "prices")
    sites = F.to_json(F.map_from_entries(F.collect_list(F.struct("site_name", "unit_price"))))
    view(spark, sf_dir, "price_overrides").groupBy("code").agg(sites.alias("sites")).select(F.concat(F.lit('"'), "code", F.lit('": '), F.regexp_replace("sites", '":', '": ')).alias("value")).write.text(path)
    return tables.read_overrides(spark, path, "prices").select("code", "site_name", "unit_price")


@query("SELECT c_mktsegment AS code, count(*) AS n, CAST(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN -c_custkey ELSE c_custkey END) AS BIGINT) AS total, true AS valid FROM customer GROUP BY 1")
def written_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results by company of which one company's are replaced, and whether they fit the contract."""
    path = _path(spark, "results")
    rows = _table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("code"), F.col("c_custkey").alias("v"))
    sinks.write_by_company(rows, path)
    sinks.write_by_company(rows.filter("code = 'BUILDING'").withColumn("v", -F.col("v")), path)
    back = spark.read.parquet(path)
    return back.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total")).join(sinks.valid_outputs(back, ["code", "v"]), "code")


@query("SELECT CAST(c_custkey AS VARCHAR) AS code, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS valid FROM customer")
def output_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each company has valid results, also those for which nothing was written."""
    orders = _table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    results = stored(orders.select(F.col("o_custkey").cast("string").alias("code"), F.col("o_orderkey").alias("v")))
    codes = _table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("code"))
    return sinks.valid_outputs(results, ["code", "v"], codes)


@query(
    "SELECT CAST(row_number() OVER (ORDER BY t DESC, code) AS INT) AS rank, code, round(t, 2) AS ratio, n, last FROM (SELECT CAST(o_custkey AS VARCHAR) AS code, sum(CAST(o_totalprice * 100 AS BIGINT)) / 100 AS t, count(*) AS n, max(o_orderkey) AS last FROM orders GROUP BY 1) WHERE code IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE value > 90)"
)
def ranking_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The screened ranking with nested metrics, written as JSON."""
    path, orders = _path(spark, "ranking"), _table(spark, sf_dir, "orders").withColumn("code", F.col("o_custkey").cast("string"))
    rows = orders.groupBy("code").agg((F.sum(F.round(F.col("o_totalprice") * 100).cast("long")) / 100).alias("ratio"))
    metrics = orders.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last"))
    allowed = _table(spark, sf_dir, "events").filter("value > 90").select(F.col("user_id").cast("string").alias("code"))
    sinks.write_ranking(ranking_payload(rows, metrics, ["n", "last"], allowed), path)
    back = spark.read.schema("rank int, code string, ratio double, metrics struct<n: bigint, last: bigint>").json(path)
    return back.select("rank", "code", F.round("ratio", 2).alias("ratio"), "metrics.n", "metrics.last")


@query("SELECT CAST(max(ts) AS TIMESTAMP) AS price_date, DATE '2024-03-01' AS target_price_date FROM events")
def price_date_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark, "dates")
    sinks.write_price_dates(view(spark, sf_dir, "prices"), "2024-03-01", path)
    return spark.read.schema("price_date string, target_price_date date").json(path).withColumn("price_date", F.col("price_date").cast("timestamp"))


def bucketed_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Targets, names and last orders of companies as bucketed tables."""
    run = uuid.uuid4().hex
    stock = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("company_name"))
    orders = _table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("code"), "o_orderkey", "o_orderdate")
    made = {"targets": view(spark, sf_dir, "companies"), "names": stock, "filings": master.latest_per(orders, "code", "o_orderdate", "o_orderkey")}
    return tuple(master.save_bucketed(rows, f"bucketed_{name}_{run}", _path(spark, name)) for name, rows in made.items())


@query(f"SELECT code, coalesce({_GOOD('company_name')}, {_GOOD('m')}) AS company_name, o_orderkey AS filing FROM {sql('companies')} LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS m FROM supplier) USING (code) LEFT JOIN (SELECT CAST(o_custkey AS VARCHAR) AS code, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) USING (code)")
def bucketed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and latest filings of companies from tables that are bucketed by code, so that no join shuffles."""
    targets, names, filings = bucketed_inputs(spark, sf_dir)
    named = master.resolve_names(targets, names)
    return named.join(filings.select("code", F.col("o_orderkey").alias("filing")), "code", "left").select("code", "company_name", "filing")


_FILES = "(SELECT CAST(c_nationkey AS VARCHAR) AS code, c_mktsegment AS doc_id, string_agg('<p>' || c_name || ', ' || c_custkey || '</p>' || chr(10), '' ORDER BY c_custkey) AS content FROM customer GROUP BY 1, 2)"


def _written_filings(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a file of all customers of each nation and segment."""
    path, key = _path(spark, "filings"), F.col("c_custkey")
    line = F.concat(F.lit("<p>"), "c_name", F.lit(", "), key.cast("string"), F.lit("</p>"))
    rows = _table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("code"), F.col("c_mktsegment").alias("doc_id"), key.alias("at"), line.alias("html"))
    dealt = rows.repartition("code", "doc_id").sortWithinPartitions("code", "doc_id", "at").drop("at")
    dealt.write.partitionBy("code", "doc_id").option("extension", "html").option("sep", "\u0001").option("quote", "").csv(path)
    return path


@query(f"SELECT code, doc_id, 1 AS seq, CAST(octet_length(encode(content)) AS BIGINT) AS length, md5(content) AS html_md5 FROM {_FILES}")
def filing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filing documents as they are read from their folders."""
    return tables.read_filings(spark, _written_filings(spark, sf_dir)).select("code", "doc_id", "seq", "length", F.md5(F.col("html").cast("binary")).alias("html_md5"))


@query(
    f"""SELECT code, n AS n_files, md5(n || ':' || a || ':' || b || ':' || c) AS fingerprint FROM (SELECT code, count(*) AS n, sum(CAST('0x' || substr(d, 1, 11) AS BIGINT)) AS a, sum(CAST('0x' || substr(d, 12, 11) AS BIGINT)) AS b, sum(CAST('0x' || substr(d, 23, 10) AS BIGINT)) AS c
        FROM (SELECT code, md5(content) AS d FROM {_FILES}) GROUP BY code)"""
)
def filing_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of each company's files."""
    return tables.company_fingerprints(tables.filing_files(spark, _written_filings(spark, sf_dir)))


@query("SELECT CAST(c_mktsegment AS VARCHAR) AS code, CAST(count(*) AS BIGINT) AS versions FROM customer GROUP BY 1")
def ingested_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of filings that arrive as a stream, some twice, counted by company."""
    rows = stored(_table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("code"), F.col("c_custkey").cast("string").alias("doc_id"), F.lit(1).cast("long").alias("length"), F.timestamp_seconds(F.col("c_custkey") * 100_000).alias("modified")))
    source, out = _path(spark, "filings"), _path(spark, "ingested")
    rows.write.parquet(source)
    rows.filter(F.xxhash64("doc_id") % 3 == 0).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    ingest(stream, lambda new: new, out, _path(spark, "progress")).awaitTermination()
    return spark.read.parquet(out).groupBy("code").agg(F.count(F.lit(1)).alias("versions"))


@query("SELECT c_mktsegment AS code, CAST(c_nationkey AS VARCHAR) AS doc_id, CAST(max(c_custkey) AS BIGINT) AS length FROM customer GROUP BY 1, 2")
def current_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document that arrived in many versions, in two runs of a stream, the newest."""
    key = F.col("c_custkey")
    rows = _table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("code"), F.col("c_nationkey").cast("string").alias("doc_id"), key.cast("long").alias("length"), F.timestamp_seconds(key * 100_000).alias("modified"))
    source, out, progress = (_path(spark, name) for name in ("filings", "ingested", "progress"))
    for arrived in (rows.filter("length % 2 = 0"), rows):  # the second run meets all of the first again
        arrived.write.mode("append").parquet(source)
        ingest(spark.readStream.schema(rows.schema).parquet(source), lambda new: new, out, progress).awaitTermination()
    return current(spark.read.parquet(out)).select("code", "doc_id", "length")


@query(f"SELECT seq, nullif(regexp_extract(address, '東京都([^ \t\n]+?[区市町村])', 1), '') AS ward FROM {sql('addresses')}")
def wards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "addresses").select("seq", fa.ward(F.col("address")).alias("ward"))


def _plane_sql() -> str:
    n, e2 = geo.FLAT / (2 - geo.FLAT), geo.FLAT * (2 - geo.FLAT)
    arc = f"{geo.A / (1 + n)!r} * ({1 + n**2 / 4 + n**4 / 64!r} * phi - {1.5 * (n - n**3 / 8)!r} * sin(2 * phi) + {15 / 16 * (n**2 - n**4 / 4)!r} * sin(4 * phi) - {35 / 48 * n**3!r} * sin(6 * phi))"
    rows = f"(SELECT point_id, lat, radians(lat) AS phi, radians(lon - {geo.LON0!r}) * cos(radians(lat)) AS d, pow(tan(radians(lat)), 2) AS tt, {e2 / (1 - e2)!r} * pow(cos(radians(lat)), 2) AS eta, {geo.A!r} / sqrt(1 - {e2!r} * pow(sin(radians(lat)), 2)) AS n FROM {sql('price_points')})"
    x = "n * (d + pow(d, 3) / 6 * (1 - tt + eta) + pow(d, 5) / 120 * (5 - 18 * tt + tt * tt + 14 * eta - 58 * tt * eta))"
    y = f"{arc} - (SELECT {arc.replace('phi', 'radians(36)')}) + n * tan(phi) * (d * d / 2 + pow(d, 4) / 24 * (5 - tt + 9 * eta + 4 * eta * eta) + pow(d, 6) / 720 * (61 - 58 * tt + tt * tt))"
    return f"SELECT point_id, round({geo.SCALE} * ({x}), 3) AS x, round({geo.SCALE} * ({y}), 3) AS y FROM {rows}"


@query(_plane_sql())
def plane_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points in metres of the plane of the search."""
    rows = view(spark, sf_dir, "price_points").withColumn("p", geo.plane_xy(F.col("lat"), F.col("lon")))
    return rows.select("point_id", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


@query("SELECT l_orderkey AS code, round(total, 2) AS ratio, is_total FROM (SELECT l_orderkey, max(l_extendedprice) AS total, 1 AS is_total FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1 UNION ALL SELECT l_orderkey, max(l_extendedprice), 0 FROM lineitem GROUP BY 1 HAVING sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) = 0)")
def total_rows_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each company its total row, or its best row if it has none."""
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("code"), (F.col("l_returnflag") == "A").cast("int").alias("is_total"), F.col("l_extendedprice").alias("ratio"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("seq"))
    return ranking.representative_rows(rows).select("code", F.round("ratio", 2).alias("ratio"), "is_total")
