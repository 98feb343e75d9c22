"""As-of joins against a plain version."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from landquill.operators.asof import asof_join, market_caps_at

DAY = datetime.datetime(2024, 1, 1)


def plain(left, right, days):
    out = []
    for code, date, name in left:
        fit = [(d, c) for k, d, c in right if k is not None and d is not None and code is not None and date is not None and k == code and d <= date]
        best = max(fit, default=None)
        if best and best[0] < date - datetime.timedelta(days=days):
            best = None
        out.append((code, date, name, best and best[1], best and best[0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_asof_join(spark, partitions):
    rng = random.Random(partitions)
    hours = lambda: DAY + datetime.timedelta(hours=rng.randrange(400))
    codes = ["hot"] * 8 + ["a", "b", "c", "only left"]
    left = [(rng.choice(codes), hours(), f"n{k % 50}") for k in range(400)] + [(None, hours(), "x"), ("a", None, "x"), ("hot", DAY - datetime.timedelta(days=1), "early"), ("late", DAY + datetime.timedelta(days=40), "stale")]
    right = [(rng.choice([*codes[:-1], "only right"]), hours(), float(rng.randrange(30))) for _ in range(500)] + [(None, DAY, 1.0), ("a", None, 1.0), ("late", DAY, 1.0)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that there are as many ranges
    try:
        a = spark.createDataFrame(left, "code string, date timestamp, name string").withColumns({"_range": F.lit("clash"), "_row": F.lit("clash"), "close": F.lit("replaced")})
        b = spark.createDataFrame(right, "code string, price_date timestamp, close double")
        got = asof_join(a, b, "code", "date", "price_date", ["close", "price_date"], max_age=F.make_dt_interval(F.lit(7)))
        assert got.columns == ["code", "date", "name", "_range", "_row", "close", "price_date"]
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert {(r["_range"], r["_row"]) for r in rows} == {("clash", "clash")}
    assert sorted(((r["code"], r["date"], r["name"], r["close"], r["price_date"]) for r in rows), key=repr) == plain(left, right, 7)


def test_asof_join_of_nothing(spark):
    a = spark.createDataFrame([("a", DAY, 1, None), ("b", DAY, 1, 5)], "code string, date timestamp, shares long, market_cap long")
    none = spark.createDataFrame([], "code string, date timestamp, close double")
    assert {(r["code"], r["close"], r["market_cap"]) for r in market_caps_at(a, none).collect()} == {("a", None, None), ("b", None, 5)}
    assert market_caps_at(a.limit(0), none).count() == 0
    one = spark.createDataFrame([("a", DAY, 2.5)], none.schema)
    assert {r["code"]: r["market_cap"] for r in market_caps_at(a.withColumn("shares", F.lit(4)), one).collect()} == {"a": 10, "b": 5}
