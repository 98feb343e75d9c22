"""SimHash near-duplicate groups by a binary trie self-join (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landquill.llm.common import checkpointed, columns_of, fresh
from landquill.llm.components import components
from landquill.llm.textbytes import LOWER, NOT_SPACE, ranges, text_blocks, word_bounds

BITS = 64
#: Fingerprints in a node up to which the trie is not refined further.
LEAF = 1024
#: Levels of the trie that one round of refinement descends.
STEP = 4


def fingerprints_of(data: np.ndarray, offs: np.ndarray, width: int = 4, seed: int = 42) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    low = LOWER[data]
    starts, ends, first = word_bounds(low, offs, NOT_SPACE)
    n_words = np.diff(first)
    out = np.zeros(len(n_words), np.uint64)
    if not len(starts):
        return out
    lengths = ends - starts
    place = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=place[1:])
    joined = np.full(int(place[-1]), 0x20, np.uint8)
    joined[ranges(place[:-1], lengths)] = low[ranges(starts, lengths)]
    body, digest = joined.tobytes(), xxhash.xxh64_intdigest
    span = np.minimum(n_words, width)  # a shorter text is one shingle
    count = np.where(n_words > 0, n_words - span + 1, 0)
    at = ranges(first[:-1], count)
    last = at + np.repeat(span, count) - 1
    h = np.fromiter((digest(body[a:b], seed) for a, b in zip(place[at].tolist(), (place[last] + lengths[last]).tolist())), np.uint64, len(at))
    some = np.flatnonzero(count)
    # Sums of single bits: eight counters of eight bits each in a word, over at
    # most 255 shingles, then added up by text.
    chunks = -(-count[some] // 255)
    chunk_first = np.concatenate([[0], np.cumsum(chunks)])
    inside = np.arange(chunk_first[-1]) - np.repeat(chunk_first[:-1], chunks)
    text_first = np.cumsum(count[some]) - count[some]
    bounds = np.repeat(text_first, chunks) + 255 * inside
    for bit in range(8):
        lanes = (h >> np.uint64(bit)) & np.uint64(0x0101010101010101)
        sums = np.add.reduceat(lanes, bounds)
        for byte in range(8):
            ones = np.add.reduceat(((sums >> np.uint64(8 * byte)) & np.uint64(0xFF)).astype(np.int64), chunk_first[:-1])
            out[some] |= (2 * ones > count[some]).astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """id, own (a 64-bit hash of the text), fp (the fingerprint as a signed long) of every text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [fingerprints_of(data, offs, width, seed) for _, data, offs in text_blocks(batch, "_text")]
            fps = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("own"), pa.array(fps.view(np.int64))], names=["_id", "own", "fp"])

    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("own"), F.col(text_col).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"_id {kind}, own bigint, fp bigint").withColumnRenamed("_id", id_col)


def _rotated(fp: Column, by: int) -> Column:
    """The fingerprint with its first ``by`` bits moved to the end."""
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by))


def _prefix(key: Column, depth: int) -> Column:
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(key, BITS - depth)


def leaf_links(a: np.ndarray, b: np.ndarray, same: bool, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a spanning set of the links between (or within) two leaves.

    All fingerprints are compared, but no more links come out than join
    whatever they join: one for each member of a component but the first.
    """
    n = len(a) if same else len(a) + len(b)
    left, right = [], []
    for i in range(0, len(a), 256):
        near = np.bitwise_count(a[i : i + 256, None] ^ b[None, :]) <= most
        x, y = np.nonzero(near)
        x = x + i
        if same:
            x, y = x[x < y], y[x < y]
        left.append(x)
        right.append(y)
    x, y = np.concatenate(left), np.concatenate(right)
    if len(x) < n:
        return x, y
    root = np.arange(n)
    shift = 0 if same else len(a)
    chosen = []
    for k, (u, v) in enumerate(zip(x.tolist(), (y + shift).tolist())):
        while root[u] != u:
            root[u] = root[root[u]]
            u = root[u]
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        if u != v:
            root[v] = u
            chosen.append(k)
    return x[chosen], y[chosen]


def trie_links(points: DataFrame, most: int = 4, tries: int = 3, leaf: int = LEAF) -> DataFrame:
    """A spanning set of the pairs (a, b) of ``node`` whose ``fp`` differ in at most ``most`` bits.

    points: node (long), fp (long), the fp all different. In each of ``tries``
    tries the bits are rotated so that another segment leads; of the
    segments one has at most most // tries differing bits, so a trie only
    follows pairs within that budget while it is inside its leading segment,
    and within ``most`` below. Pairs of nodes descend STEP levels a round
    together, add up the bits in which their prefixes differ, and are dropped
    beyond the budget. A pair rests once both nodes hold at most ``leaf``
    fingerprints; then the two leaves are compared. Only nodes that are still
    too large are refined, so a crowded branch goes deeper than the others.
    """
    edges = None
    lead = BITS // tries
    for t in range(tries):
        budget, own = most // tries, lead if t < tries - 1 else BITS - lead * (tries - 1)
        keyed = points.select("node", "fp", _rotated(F.col("fp"), lead * t).alias("key"))
        depth = 0
        pairs = points.sparkSession.createDataFrame([(0, 0, 0)], "a long, b long, diff int")
        resting = None
        while pairs is not None:
            down = min(depth + STEP, own if depth < own else BITS)
            sizes = keyed.groupBy(_prefix(F.col("key"), down).alias("p")).agg(F.count(F.lit(1)).alias("n"))
            sizes = sizes.withColumn("up", F.shiftrightunsigned("p", down - depth) if depth else F.lit(0).cast("long"))
            left = sizes.select(F.col("up").alias("a"), F.col("p").alias("pa"), F.col("n").alias("na"))
            right = sizes.select(F.col("up").alias("b"), F.col("p").alias("pb"), F.col("n").alias("nb"))
            differ = F.bit_count(F.col("pa").bitwiseXOR(F.col("pb")))
            limit = budget if down <= own else most
            grown = pairs.join(left, "a").join(right, "b").filter(F.col("pa") <= F.col("pb")).withColumn("diff", differ.cast("int")).filter(F.col("diff") <= limit)
            grown = checkpointed(grown.select(F.col("pa").alias("a"), F.col("pb").alias("b"), "diff", "na", "nb"))
            done = (F.col("na") <= leaf) & (F.col("nb") <= leaf) if down < BITS else F.lit(True)
            here = grown.filter(done).select(F.lit(down).alias("depth"), "a", "b")
            resting = here if resting is None else resting.union(here)
            more = grown.filter(~done).select("a", "b", "diff") if down < BITS else None
            pairs = None if more is None or more.isEmpty() else more
            depth = down
        found = _compare(keyed, resting, most)
        edges = found if edges is None else edges.union(found)
    return edges


def _compare(keyed: DataFrame, pairs: DataFrame, most: int) -> DataFrame:
    depths = [r[0] for r in pairs.select("depth").distinct().collect()]  # at most 64
    sides = None
    for d in sorted(depths):
        at = keyed.select("node", "fp", _prefix(F.col("key"), d).alias("p"))
        own = pairs.filter(F.col("depth") == d)
        one = own.join(at, own["a"] == at["p"]).select("depth", "a", "b", F.lit(0).alias("side"), "node", "fp")
        two = own.filter("a <> b").join(at, F.col("b") == at["p"]).select("depth", "a", "b", F.lit(1).alias("side"), "node", "fp")
        both = one.union(two)
        sides = both if sides is None else sides.union(both)
    if sides is None:
        return keyed.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        side = rows["side"].to_numpy()
        node, fp = rows["node"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
        one, two = side == 0, side == 1
        same = not two.any()
        x, y = leaf_links(fp[one], fp[one] if same else fp[two], same, most)
        return pd.DataFrame({"u": node[one][x], "v": (node[one] if same else node[two])[y]})

    def compare_pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = key[1], key[2]
        if a != b and rows["side"].nunique() < 2:
            return pd.DataFrame({"u": pd.Series([], dtype="int64"), "v": pd.Series([], dtype="int64")})
        return compare(rows)

    return sides.groupBy("depth", "a", "b").applyInPandas(compare_pairs, "u long, v long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, most: int, seed: int, leaf: int) -> DataFrame:
    """doc_id, own, fp, component_id of every row."""
    fps = checkpointed(fingerprints(docs, id_col, text_col, width, seed).select(F.col(id_col).alias("doc_id"), "own", "fp"))
    points = checkpointed(fps.groupBy("fp").agg(F.min("doc_id").alias("node")).filter("node IS NOT NULL"))
    labels = components(trie_links(points, most, leaf=leaf))
    named = points.join(labels, "node", "left").select("fp", F.coalesce("label", "node").alias("component_id"))
    return fps.join(named, "fp", "left").select("doc_id", "own", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, most: int = 4, seed: int = 42, leaf: int = LEAF) -> DataFrame:
    """Every document with its fingerprint and the smallest id of its group.

    Texts are lower-cased in A-Z and cut into words at white space; shingles
    are ``width`` words (a shorter text is one shingle). A bit of the
    fingerprint is set if it is set in over half of the shingles' XXH64.
    Fingerprints link at ``most`` or fewer differing bits, and groups are the
    connected components. Null, empty and blank texts have fingerprint 0 and
    link like any other. Repeated rows are returned as often as they come. A
    null id takes part in no group: it is its own component_id.
    Other columns, whatever their names, play no part; an empty table gives an empty one.
    A text is worked through as a whole, with up to a hundred bytes of arrays for each of its bytes.
    """
    out = _grouped(docs, id_col, text_col, width, most, seed, leaf)
    return out.select(F.col("doc_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, most: int = 4, seed: int = 42, leaf: int = LEAF) -> DataFrame:
    """The rows of ``docs`` that stay, unchanged: of each group the document with the smallest id.

    Rows are judged one by one: of an id with several texts those stay whose
    group has no smaller id. Rows that repeat the id and text of the one that
    stays are the same document and stay with it; rows with a null id stay.
    """
    gone = _grouped(docs, id_col, text_col, width, most, seed, leaf).filter(F.col("doc_id") != F.col("component_id"))
    own, gone_id, gone_own = fresh(docs, "own", "gone_id", "gone_own")
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("own").alias(gone_own)).distinct()
    marked = docs.withColumn(own, F.xxhash64(text_col))
    return marked.join(gone, (F.col(id_col) == F.col(gone_id)) & (F.col(own) == F.col(gone_own)), "left_anti").select(columns_of(docs))
