"""The entry points, and the registered queries against their SQL on the smallest tables."""

import os
import pathlib
import re

import pytest

import __spark_entry__ as entry

ROOT = pathlib.Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def test_nothing_else_imports_the_corpus_operators():
    for path in (ROOT / "landquill").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"landquill\.llm|corpus_pipeline", path.read_text()), path


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_tables
def test_entry(spark):
    assert entry.entry(spark).columns == ["rank", "code", "est", "gain", "ratio"]


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return tuple(map(_plain, value)) if isinstance(value, (list, tuple)) else value


@needs_tables
@pytest.mark.parametrize("name", ["nearest_price", "knn_grid", "scoped_nearest", "company_totals", "split_sites", "market_caps", "address_parse", "geocoded", "mined_addresses", "filing_facilities", "patch_effects", "ranking_rows", "valuation_rows", "web_addresses", "geodesic_neighbours", "ingested_filings", "ranking_file", "survey_ids", "override_files", "override_rejects", "price_override_files", "output_checks"])
def test_query_matches_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for path in pathlib.Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == sorted((tuple(map(_plain, r)) for r in want.fetchall()), key=repr) and got


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    from landquill.operators import master
    from landquill.plans.io_queries import bucketed_inputs

    targets, names, filings = bucketed_inputs(spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = master.resolve_names(targets, names).join(filings.select("code", "o_orderkey"), "code", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Join") >= 2 and "Exchange" not in plan
