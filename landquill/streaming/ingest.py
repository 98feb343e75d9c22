"""Incremental ingest of new filings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from landquill.shared import checkpointed

FINGERPRINT = ["code", "doc_id", "length", "modified"]


def ingest(stream: DataFrame, extract: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Write what ``extract`` makes of each version of a filing, once, however often and late it arrives.

    Versions seen are state keyed by the fingerprint (code, doc_id, length, modified; null is a value like any other), dealt out
    by it, so that a company of very many filings is no hot key, and a micro-batch looks up its own
    rows only: its work doesn't grow with what came before. The state is as large as the number of different
    fingerprints; a session with ``spark.sql.streaming.stateStore.providerClass`` set to the RocksDB provider keeps it on disk.

    ``extract`` gets the new versions and returns rows, which go below ``path`` by batch. A batch that is run again
    after a failure replaces its own part, so that nothing counts twice. A new query on the same ``checkpoint`` goes on where the last one ended.
    """

    def batch(rows: DataFrame, batch_id: int) -> None:
        made = extract(checkpointed(rows))
        made.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(path)

    return stream.dropDuplicates(FINGERPRINT).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(results: DataFrame, version: str = "modified") -> DataFrame:
    """The rows of each company's and document's newest version: what came last by ``version``, of equal ones in the later batch."""
    keys, order = ["code", "doc_id"], F.struct(version, "_batch")
    newest = results.groupBy(*keys).agg(F.max(order).alias("_newest")).select(F.col("code").alias("_c"), F.col("doc_id").alias("_d"), "_newest")
    same = F.col("code").eqNullSafe(F.col("_c")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (order == F.col("_newest"))
    return results.join(newest, same, "left_semi")
