"""Ranking and screening of companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landquill.shared import running


def representative_rows(rows: DataFrame) -> DataFrame:
    """Of each company the total row, else the one with the largest ratio, the first of equals by seq."""
    w = Window.partitionBy("code").orderBy(F.col("is_total").desc(), F.col("ratio").desc_nulls_last(), F.col("seq"))
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def ordered_distinct(rows: DataFrame, value: str, out: str, key: str = "code", seq: str = "seq") -> DataFrame:
    """key, out: the different non-empty values of each key in order of their first seq, bars and blanks tidied, joined with ' / '.

    Values are made distinct before they are listed, so that a list is as long as there are different ones.
    """
    tidy = F.trim(F.regexp_replace(F.replace(F.coalesce(value, F.lit("")), F.lit("|"), F.lit(" / ")), r"\s+", " "))
    first = rows.select(key, tidy.alias("_v"), F.col(seq).alias("_s")).groupBy(key, "_v").agg(F.min("_s").alias("_s"))
    listed = F.array_sort(F.collect_list(F.when(F.col("_v") != "", F.struct(F.col("_s").alias("s"), F.col("_v").alias("v")))))
    return first.groupBy(key).agg(F.array_join(listed["v"], " / ").alias(out))


def count_filled(value: str) -> Column:
    return F.count_distinct(F.nullif(F.trim(value), F.lit("")))


def ranked(companies: DataFrame) -> DataFrame:
    """rank by ratio, the larger first, then by code; companies without a ratio are left out.

    Companies are ranked in ranges of the ratio, which then count those of the ranges before.
    """
    return running(companies.filter("ratio IS NOT NULL"), [F.col("ratio").desc(), F.col("code")], rank=F.lit(1)).withColumn("rank", (F.col("rank") + 1).cast("int"))


def top(companies: DataFrame, n: int) -> DataFrame:
    return companies.filter("ratio IS NOT NULL").orderBy(F.col("ratio").desc(), "code").limit(n)


def with_metrics(ranking: DataFrame, metrics: DataFrame, nested: list[str]) -> DataFrame:
    """ranking with ``metrics``, a struct of the named columns; null members where a company has none."""
    side = metrics.select("code", F.struct(*nested).alias("metrics"))
    return ranking.join(side, "code", "left")


def screened(ranking: DataFrame, allowed: DataFrame) -> DataFrame:
    return ranking.join(allowed.select("code").distinct(), "code", "left_semi")
