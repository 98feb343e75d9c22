"""Hard negatives by exact scores from residues (operator 12).

Vectors of integers are scored by matrix products in float32: every component
is replaced by its residue modulo each of several small primes, products of
residues are exact in float32, and the signed score is put together from its
residues by Chinese remaindering. Anchors, in blocks, meet all rows; each task
keeps the best of its rows, and the tasks' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landquill.llm.common import checkpointed

#: Bytes of residues, and anchors, that one job broadcasts; rows and anchors of one matrix product; rows that a task is to hold at least.
BLOCK_BYTES, ANCHORS, TILE_ROWS, TILE_ANCHORS, TASK_ROWS = 32 << 20, 16_384, 2_048, 256, 2_048
#: Odd primes below 2^9, the largest first: sums of 64 products of residues of at most half a prime stay below 2^24.
PRIMES = [p for p in range(509, 2, -2) if all(p % q for q in range(3, int(p**0.5) + 1, 2))]
_EXACT = 1 << 24
_LEAST = np.iinfo(np.int64).min


def primes_for(bound: float) -> list[int]:
    """As many primes as tell apart all integers of up to ``bound`` either side of zero."""
    out, product = [], 1
    for p in PRIMES:
        if product > 2 * bound + 1:
            break
        out.append(p)
        product *= p
    return out or PRIMES[:1]


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """x modulo each prime as float32, from -(p - 1) / 2 to (p - 1) / 2."""
    out = []
    for p in primes:
        r = x % p
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def exact_product(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The integer products of rows of a with rows of b, from their residues; exact if the primes' product is over twice as large."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        half = p // 2
        width = max(1, (_EXACT - 1) // (half * half))
        r = np.zeros((len(a[k]), len(b[k])), np.int64)
        for c in range(0, a[k].shape[1], width):  # sums of so many products are exact in float32
            r += (a[k][:, c : c + width] @ b[k][:, c : c + width].T).astype(np.int64)
        # Mixed radix: the digit of this prime from the residue and the digits before.
        known, scale = np.zeros_like(r), 1
        for d, q in zip(digits, primes):
            known += d * (scale % p)
            scale *= q
        digit = (r - known) * pow(scale % p, -1, p) % p if k else r % p
        digits.append(np.where(digit > half, digit - p, digit))
    out = np.zeros_like(digits[0])
    for d, p in zip(digits[::-1], primes[::-1]):
        out = out * p + d
    return out


@dataclass
class Anchors:
    """A block of anchors; with windows, one entry for each anchor and positive."""

    ids: np.ndarray
    labels: np.ndarray
    parts: list[np.ndarray]
    primes: list[int]
    owner: np.ndarray | None = None  # of each window: the anchor's place
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class _Best:
    """The k best (score, smaller id first) of each of n lists, kept while rows pass by."""

    def __init__(self, n: int, k: int) -> None:
        self.score, self.id = np.full((n, k), _LEAST), np.full((n, k), np.iinfo(np.int64).max)
        self.held = np.zeros((n, k), bool)

    def add(self, at: slice | np.ndarray, score: np.ndarray, ids: np.ndarray, fits: np.ndarray) -> None:
        """score, fits: lists x rows."""
        k = self.score.shape[1]
        s = np.concatenate([self.score[at], np.where(fits, score, _LEAST)], 1)
        i = np.concatenate([self.id[at], np.broadcast_to(ids, score.shape)], 1)
        h = np.concatenate([self.held[at], fits], 1)
        if s.shape[1] > 4 * k:  # all that are not below the kth score, in most lists very few
            kth = np.partition(s, -k, 1)[:, -k]
            width = int((h & (s >= kth[:, None])).sum(1).max(initial=1))
            if width < s.shape[1]:
                part = np.argsort(~(h & (s >= kth[:, None])), 1, kind="stable")[:, : max(width, k)]
                s, i, h = (np.take_along_axis(x, part, 1) for x in (s, i, h))
        order = np.lexsort((i, ~s, ~h))[:, :k]
        self.score[at], self.id[at], self.held[at] = (np.take_along_axis(x, order, 1) for x in (s, i, h))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists, place = np.nonzero(self.held)
        return lists, self.id[lists, place], self.score[lists, place]


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros."""
    offs = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(offs)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(offs[:-1] - offs[0], size)] = values[offs[0] : offs[-1]]
    return out


def _scorer(shared, k: int, width: int):
    """(list, id, score) of the best rows of a task: for each anchor of its own label, for each window of other labels."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        owner = np.arange(len(a.ids)) if a.owner is None else a.owner
        best = _Best(len(owner), k)
        for batch in batches:
            for t in range(0, batch.num_rows, TILE_ROWS):
                tile = batch.slice(t, TILE_ROWS)
                ids, labels = tile.column("id").to_numpy(), tile.column("label").to_numpy()
                parts = residues(_vectors(tile.column("vec"), width), a.primes)
                for c in range(0, len(a.ids), TILE_ANCHORS):
                    end = min(len(a.ids), c + TILE_ANCHORS)
                    s = exact_product([p[c:end] for p in a.parts], parts, a.primes)
                    alike = a.labels[c:end, None] == labels
                    if a.owner is None:
                        best.add(slice(c, end), s, ids, alike & (a.ids[c:end, None] != ids))
                        continue
                    first, last = np.searchsorted(owner, [c, end])
                    for w in range(first, last, TILE_ANCHORS):
                        at = slice(w, min(last, w + TILE_ANCHORS))
                        own = owner[at] - c
                        best.add(at, s[own], ids, ~alike[own] & (s[own] >= a.low[at, None]) & (s[own] <= a.high[at, None]))
        lists, ids, scores = best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (lists, ids, scores)], names=["list", "id", "score"])

    return score


def _merged(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("list").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def _share(score: np.ndarray, of: int, whole: int, up: bool) -> np.ndarray:
    """score * of / whole, rounded up or down, without a product that is too large."""
    q, r = np.divmod(score, whole)
    return q * of + (-(-r * of // whole) if up else r * of // whole)


def hard_negatives(
    rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", label: Column | None = None, anchors: Column | None = None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, block: int | None = None
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x), scores are integer inner products. Anchors are the rows that ``anchors`` holds
    for, by default those whose id is divisible by 100; an anchor's positives are the ``positives`` best other rows
    of its label. For each of both, of the rows of other labels with low * positive_score <= 100 * negative_score
    <= high * positive_score the ``negatives`` best are returned; higher scores first, then smaller ids. ``label`` is
    computed in place of ``label_col`` if given.

    Rows with a null id, label or vector, or a null or non-finite component take no part. A shorter vector counts as
    filled up with zeros, an empty one as all zeros. Rows that are alike in id, label and vector count once; different rows of one id each
    take part, and are no positives of each other. Anchors without a positive, and pairs whose window is empty, have
    no row; an empty table gives an empty one. Other columns, whatever their names, play no part. OverflowError if a score
    could be beyond a long.

    Every anchor meets every row, in blocks: a job broadcasts up to ``block`` anchors, by default those of BLOCK_BYTES, and scores them tile by tile; a task
    gives at most ``positives`` rows for an anchor or ``negatives`` for a pair, whatever it has read.
    """
    spark = rows.sparkSession
    ints = F.transform(F.col(f"`{vec_col}`"), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fine = F.forall(F.col(f"`{vec_col}`"), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    mark = F.col(f"`{id_col}`") % 100 == 0 if anchors is None else anchors
    own = F.col(f"`{label_col}`") if label is None else label
    taken = rows.filter(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{vec_col}`").isNotNull() & fine)
    taken = taken.select(F.col(f"`{id_col}`").cast("long").alias("id"), own.cast("long").alias("label"), ints.alias("vec"), F.coalesce(mark, F.lit(False)).alias("anchor")).filter("label IS NOT NULL").distinct()
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    size = taken.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width"), F.max(square).alias("square"), F.max(F.array_max(F.transform("vec", lambda x: F.abs(x.cast("double"))))).alias("most")).first()
    bound = (size["square"] or 0.0) * (1 + 1e-9) + 1  # of two vectors' product, by their lengths
    if bound >= 2.0**62 or (size["most"] or 0.0) >= 2.0**53:
        raise OverflowError(f"scores of up to {bound:.3g}")
    primes, width = primes_for(bound), max(1, size["width"] or 1)
    # As many tasks as there are cores at most, so that what they keep grows with the anchors alone.
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-size["n"] // TASK_ROWS)))
    block = block or max(1, min(ANCHORS, BLOCK_BYTES // (4 * width * len(primes))))
    held = checkpointed(taken.repartition(tasks))
    asked = held.filter("anchor").select("id", "label", "vec")
    n_blocks = max(1, -(-asked.count() // block))
    out = None
    for b in range(n_blocks):  # a job of its own for each block of anchors
        part = asked if n_blocks == 1 else asked.filter(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(n_blocks)) == b)
        found = _block(held, part, primes, width, positives, negatives, low, high)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def _block(held: DataFrame, part: DataFrame, primes: list[int], width: int, positives: int, negatives: int, low: int, high: int) -> DataFrame | None:
    spark, mine = held.sparkSession, part.orderBy("id", "label").toArrow()
    if not mine.num_rows:
        return None
    mine = mine.combine_chunks()
    ids, labels = mine.column("id").to_numpy(), mine.column("label").to_numpy()
    parts = residues(_vectors(mine.column("vec").combine_chunks(), width), primes)
    rows = held.select("id", "label", "vec")
    first = spark.sparkContext.broadcast(Anchors(ids, labels, parts, primes))
    found = _merged(rows.mapInArrow(_scorer(first, positives, width), "list long, id long, score long"), positives).orderBy("list", "rank").toArrow()
    first.destroy()
    if not found.num_rows:
        return None
    owner, positive, score = (found.column(c).to_numpy() for c in ("list", "id", "score"))
    windows = Anchors(ids, labels, parts, primes, owner, _share(score, low, 100, True), _share(score, high, 100, False))
    second = spark.sparkContext.broadcast(windows)
    best = checkpointed(_merged(rows.mapInArrow(_scorer(second, negatives, width), "list long, id long, score long"), negatives))
    second.destroy()
    pairs = pa.table({"list": np.arange(len(owner)), "anchor_id": ids[owner], "positive_id": positive, "positive_score": score})
    named = spark.createDataFrame(pairs)
    return best.join(F.broadcast(named), "list").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
