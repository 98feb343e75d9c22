"""Sinks: results by company, ranking, price dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_by_company(rows: DataFrame, path: str) -> None:
    """Replace the partitions of the companies in ``rows`` and no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("code").parquet(path)


def valid_outputs(rows: DataFrame, contract: list[str], codes: DataFrame | None = None) -> DataFrame:
    """code, valid: the schema is the contract's and there is a row. With ``codes`` each of these has a row, also where nothing was written."""
    same = [c for c in rows.columns if c != "code"] == [c for c in contract if c != "code"]
    found = rows.groupBy("code").agg((F.lit(same) & (F.count(F.lit(1)) >= 1)).alias("valid"))
    if codes is None:
        return found
    return codes.select("code").distinct().join(found, "code", "left").select("code", F.coalesce("valid", F.lit(False)).alias("valid"))


def write_ranking(ranking: DataFrame, path: str) -> None:
    ranking.write.mode("overwrite").json(path)


def price_dates(prices: DataFrame, target_date: str) -> DataFrame:
    return prices.agg(F.max("date").alias("price_date")).withColumn("target_price_date", F.lit(target_date).cast("date"))


def write_price_dates(prices: DataFrame, target_date: str, path: str) -> None:
    """The dates as JSON; the price date as text to the microsecond."""
    price_dates(prices, target_date).withColumn("price_date", F.col("price_date").cast("string")).write.mode("overwrite").json(path)
