"""Session helpers: the shared folder, and cutting lineage into it."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one below the warehouse where that is unset, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage into the cluster's shared folder."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write a table into the shared folder and read it back."""
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def unsent(df: DataFrame) -> DataFrame:
    """df, not to be broadcast in a join: by the statistics of its compressed files a table of many rows looks small enough for the driver."""
    return df.hint("shuffle_merge")


def fresh(taken: list[str], *names: str) -> list[str]:
    """A column name for each of ``names`` that isn't ``taken``, whatever the case."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def running(df: DataFrame, order: list[Column], **sums: Column) -> DataFrame:
    """``df`` with, for each of ``sums``, its sum over all rows before in a total order (0 for the first row).

    Rows are dealt into ranges of the order and added up in each range on its
    own; the totals of earlier ranges, one row for each range, are joined to it.
    A column of ``df`` that has the name of a sum is replaced by it; all others are kept as they are, whatever their names.
    """
    own_range, other, *helpers = fresh([*df.columns, *sums], "_range", "_r", *[f"_{kind}_{name}" for kind in ("add", "of", "own") for name in sums])
    add, of, own = ({name: helpers[k * len(sums) + n] for n, name in enumerate(sums)} for k in range(3))
    known = checkpointed(df.withColumns({add[name]: value for name, value in sums.items()}))  # ranges are found by a pass of its own
    dealt = checkpointed(known.repartitionByRange(*order).withColumn(own_range, F.spark_partition_id()))
    totals = dealt.groupBy(own_range).agg(*[F.sum(add[name]).alias(of[name]) for name in sums])
    earlier = Window.orderBy(own_range).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col(own_range).alias(other), *[F.coalesce(F.sum(of[name]).over(earlier), F.lit(0)).alias(of[name]) for name in sums])
    here = Window.partitionBy(own_range).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumns({own[name]: F.coalesce(F.sum(add[name]).over(here), F.lit(0)) for name in sums})
    out = inside.join(F.broadcast(totals), F.col(own_range) == F.col(other))
    replaced = {name.lower() for name in sums}
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in replaced], *[(F.col(own[name]) + F.col(of[name])).alias(name) for name in sums])
