"""Small pieces that several corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landquill.shared import checkpointed, shared_folder, stored

__all__ = ["checkpointed", "columns_of", "fresh", "lower_ascii", "remainder", "shared_folder", "stored", "table", "unit"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """A column name for each of ``names`` that ``df`` has no column of, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of ``df``, by their names as they are."""
    return [F.col(f"`{c}`") for c in df.columns]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def remainder(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; the id null counts as the text ''."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def unit(*parts: Column) -> Column:
    """A reproducible uniform number in [0, 1) for the given values."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))
