"""As-of joins: for each row the last row of another table at or before its own time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landquill.shared import checkpointed


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str], tie: list[str] | None = None, max_age: Column | None = None) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` that has the same key and a time at or before ``left_time``.

    Of rows of ``right`` at one time that with the largest ``tie`` columns counts, by default the
    largest values. A row older than ``max_age``, an interval, doesn't count; then, or without one, the values are null.
    Rows of ``left`` with a null key or time keep null values; such rows of ``right`` count for none. Columns of
    ``left`` named like a value are replaced; repeated rows are kept.

    Both tables go into one, dealt into ranges of key and time, so that a key of very many rows lies in
    many ranges. In each range the last values are carried forward; what a range begins with comes
    from the ranges before, of which each gives one row.
    """
    tie = tie or values
    rows = [c for c in left.columns if c not in values]
    # One shape for both: key, time, side, order of equal times, the row of left or the record of right.
    kind = left.schema[left_time].dataType
    asked = left.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{left_time}`").alias("_time"), F.lit(1).alias("_side"), F.struct(*[F.col(f"`{c}`") for c in rows]).alias("_row"))
    held = right.filter(F.col(f"`{key}`").isNotNull() & F.col(f"`{right_time}`").isNotNull())
    entry = F.struct(F.col(f"`{right_time}`").cast(kind).alias("time"), F.struct(*[F.col(f"`{c}`").alias(f"t{n}") for n, c in enumerate(tie)]).alias("tie"), F.struct(*[F.col(f"`{c}`").alias(f"v{n}") for n, c in enumerate(values)]).alias("value"))
    held = held.select(F.col(f"`{key}`").cast(left.schema[key].dataType).alias("_key"), F.col(f"`{right_time}`").cast(kind).alias("_time"), F.lit(0).alias("_side"), entry.alias("_record"))
    alone = asked.filter("_key IS NULL OR _time IS NULL")
    both = asked.filter("_key IS NOT NULL AND _time IS NOT NULL").unionByName(held, allowMissingColumns=True)
    order = [F.col("_key"), F.col("_time"), F.col("_side"), F.col("_record.tie"), F.col("_record.value"), F.xxhash64("_row")]  # the last deals out rows at one time
    dealt = checkpointed(checkpointed(both).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    # Of each range its last key and that key's last record in it; null records come first.
    ends = dealt.groupBy("_range").agg(F.max(F.struct("_key", "_record")).alias("_end")).select("_range", F.col("_end._key").alias("_end_key"), F.col("_end._record").alias("_end_record"))
    earlier = Window.partitionBy("_end_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("_end_record", F.last("_end_record", ignorenulls=True).over(earlier)).filter("_end_record IS NOT NULL")
    # What is carried into a range: the record of the last range before it that ends in the key.
    spans = dealt.groupBy("_range").agg(F.min("_key").alias("_first"))
    carry = spans.join(F.broadcast(ends.withColumnRenamed("_range", "_before")), (F.col("_first") == F.col("_end_key")) & (F.col("_before") < F.col("_range"))).groupBy("_range", "_first").agg(F.max_by("_end_record", "_before").alias("_carried"))
    carry = carry.select(F.col("_range").alias("_r"), "_first", "_carried")
    here = Window.partitionBy("_range", "_key").orderBy(*order[1:5]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = dealt.withColumn("_last", F.last("_record", ignorenulls=True).over(here)).filter("_side = 1")
    out = last.join(F.broadcast(carry), (F.col("_range") == F.col("_r")) & (F.col("_key") == F.col("_first")), "left").withColumn("_last", F.coalesce("_last", "_carried"))
    fits = F.lit(True) if max_age is None else F.col("_last.time") >= F.col("_time") - max_age
    out = out.select("_row", F.when(fits, F.col("_last.value")).alias("_value"))
    out = out.unionByName(alone.select("_row"), allowMissingColumns=True)
    return out.select("_row.*", *[F.col(f"_value.v{n}").alias(c) for n, c in enumerate(values)])


def market_caps_at(filings: DataFrame, prices: DataFrame, max_age_days: int = 7) -> DataFrame:
    """filings (code, date, shares, market_cap) with close and price_date at each one's own date, and market_cap.

    The market value is the filing's own, else shares times the last close at or before its date, unless that is older than
    the given days. prices: code, date, close; of equal dates the largest close counts.
    """
    known = prices.select("code", F.col("date").alias("price_date"), "close")
    out = asof_join(filings, known, "code", "date", "price_date", ["close", "price_date"], tie=["close"], max_age=F.make_dt_interval(F.lit(max_age_days)))
    return out.withColumn("market_cap", F.coalesce("market_cap", (F.col("shares") * F.col("close")).cast("long")))
