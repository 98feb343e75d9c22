"""Features of large GeoJSON files, each file read by many tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that a task reads at a time.
SPLIT_BYTES = 32 << 20
#: Bytes that are read on behind a split until its last feature ends.
_AHEAD = 1 << 16
_QUOTE, _BACKSLASH = 0x22, 0x5C
_STEP = np.zeros(256, np.int8)
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1
#: Levels of nesting inside the list of features and inside a feature.
_LIST, _FEATURE = 2, 3


def read_range(path: str, start: int, end: int) -> bytes:
    """The bytes of a file from ``start`` up to ``end`` or its own end."""
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_file(inner) as file:
        size = file.size()
        return file.read_at(min(end, size) - start, start) if start < size else b""


def _escaping(path: str, start: int) -> int:
    """How many backslashes stand directly before a place of a file."""
    n, width = 0, 64
    while start > n:
        from_ = max(0, start - n - width)
        before = read_range(path, from_, start - n)
        own = len(before) - len(before.rstrip(b"\\"))
        n += own
        if own < len(before):
            break
        width *= 2
    return n


def marks(raw: bytes, escaping: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of quotes and brackets, +1 or -1 or 0 for a quote, number of quotes before each) without quotes behind an odd run of backslashes."""
    data = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero((data == _QUOTE) | (_STEP[data] != 0))
    slashes = np.concatenate([np.arange(-escaping, 0), np.flatnonzero(data == _BACKSLASH)])
    if len(slashes):
        first = np.searchsorted(slashes - np.arange(len(slashes)), slashes - np.arange(len(slashes)))  # of each backslash its run's first
        last = np.searchsorted(slashes, at) - 1
        run = np.where((last >= 0) & (slashes[last] == at - 1), last - first[last] + 1, 0)
        at = at[(data[at] != _QUOTE) | (run % 2 == 0)]
    quote = data[at] == _QUOTE
    return at, _STEP[data[at]], np.cumsum(quote) - quote


def _splits(spark: SparkSession, path: str, split_bytes: int) -> tuple[DataFrame, int]:
    """(path, start of splits of all files below a path; how many there are)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).filter("length > 0").select("path", "length")
    splits = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    return splits, max(1, splits.count())


def read_features(spark: SparkSession, path: str, schema: T.StructType, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """pos (struct of file and byte at which it begins), f (by ``schema``) of each feature of all files below a path.

    Whether a place of a file lies within a string, and how deep, follows from all bytes before it. Each split is therefore first
    summed up on its own, for both cases of its first byte; the sums of the splits before tell which case holds, and in a second pass each
    task cuts out the features that begin in its split and reads on to the end of the last one. A feature is an object within a
    list or object of the top level's object; what isn't of ``schema`` is null there. Empty files have no features.
    """
    splits, tasks = _splits(spark, path, split_bytes)
    # AQE would put these few rows, each of which stands for a whole split, into one task.
    splits = splits.repartition(tasks, "path", "start")

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, start in zip(frame["path"], frame["start"]):
                at, step, quotes = marks(read_range(name, start, start + split_bytes), _escaping(name, start))
                n = int((step == 0).sum())
                yield pd.DataFrame({"path": [name], "start": [start], "quotes": [n % 2], "outside": [int(step[quotes % 2 == 0].sum())], "inside": [int(step[quotes % 2 == 1].sum())]})

    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    sums = splits.mapInPandas(summed, "path string, start long, quotes long, outside long, inside long")
    states = sums.withColumn("state", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    states = states.withColumn("depth", F.coalesce(F.sum(F.when(F.col("state") == 0, F.col("outside")).otherwise(F.col("inside"))).over(before), F.lit(0)))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, start, state, depth in zip(frame["path"], frame["start"], frame["state"], frame["depth"]):
                raw = read_range(name, start, start + split_bytes)
                begins, ends = _bounds(raw, _escaping(name, start), state, depth)
                begins = begins[begins < split_bytes]
                ends = ends[np.searchsorted(ends, begins[0]) :] if len(begins) else ends[:0]
                more = _AHEAD
                while len(ends) < len(begins):  # the last one goes on behind the split
                    raw = read_range(name, start, start + split_bytes + more)
                    last = int(begins[-1])
                    _, found = _bounds(raw[last:], 0, 0, _FEATURE - 1)
                    if not len(found) and len(raw) == split_bytes + more:
                        more *= 4
                        continue
                    ends = np.append(ends, last + found[0] if len(found) else len(raw) - 1)
                texts = [raw[a : b + 1].decode("utf-8", "replace") for a, b in zip(begins.tolist(), ends.tolist())]
                if texts:
                    yield pd.DataFrame({"file": [name] * len(texts), "at": start + begins, "text": texts})

    dealt = states.select("path", "start", "state", "depth").repartition(tasks, "path", "start")
    texts = dealt.mapInPandas(cut, "file string, at long, text string")
    return texts.select(F.struct("file", "at").alias("pos"), F.from_json("text", schema).alias("f"))


def _bounds(raw: bytes, escaping: int, state: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes, last bytes) of the features that begin or end in ``raw``."""
    at, step, quotes = marks(raw, escaping)
    real = ((quotes + state) % 2 == 0) & (step != 0)
    at, step = at[real], step[real]
    level = depth + np.cumsum(step)
    curly = np.isin(np.frombuffer(raw, np.uint8)[at], list(b"{}"))
    return at[curly & (step > 0) & (level == _FEATURE)], at[curly & (step < 0) & (level == _LIST)]
