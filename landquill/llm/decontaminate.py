"""Benchmark decontamination (operator 4).

The windows of the test items form a hash set that is broadcast; training
texts are scanned word window by word window, hits are verified byte by byte,
and texts or the hit spans can be removed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landquill.llm.common import stored
from landquill.llm.textbytes import ALNUM, LOWER, lookup, prefix_sums, range_hash, ranges, segment_sums, text_blocks, word_bounds

#: Bytes of benchmark text whose windows, about one for each six bytes and some
#: hundred bytes of memory each, go into one broadcast. A larger benchmark is
#: scanned for in several blocks, one after another.
BLOCK_TEXT_BYTES = 4 << 20
_VERIFY_BYTES = 1 << 22
_FILTER_BITS = 20


@dataclass
class WindowSet:
    """Windows of one block of items, in order of their hashes."""

    items: list[str]
    widths: list[int] = field(default_factory=list)
    keys: dict[int, np.ndarray] = field(default_factory=dict)  # by width: sorted hashes, equal ones for different contents
    maybe: dict[int, np.ndarray] = field(default_factory=dict)  # by width: which leading bits occur
    text: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # by width: bytes, offsets
    owners: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # by width: item numbers, offsets
    repeats: dict[int, int] = field(default_factory=dict)  # by width: most contents of one hash


def _joined(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with one space behind each, and the place of each word there."""
    lengths = ends - starts
    place = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=place[1:])
    out = np.full(int(place[-1]), 0x20, np.uint8)
    out[ranges(place[:-1], lengths)] = low[ranges(starts, lengths)]
    return out, place


def _word_hashes(data: np.ndarray, offs: np.ndarray):
    low = LOWER[data]
    starts, ends, first = word_bounds(low, offs, ALNUM)
    hashes = range_hash(prefix_sums(low), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return low, starts, ends, first, hashes


def window_set(items: list[tuple[str, str]], width: int) -> WindowSet:
    """The windows of (id, text) pairs; ids are sorted as strings."""
    items = sorted(items)
    out, found = WindowSet([i for i, _ in items]), {}
    for number, (_, text) in enumerate(items):
        data = np.frombuffer((text or "").encode(), np.uint8)
        low, starts, ends, _, hashes = _word_hashes(data, np.array([0, len(data)]))
        if not len(starts):
            continue
        n = min(width, len(starts))
        sums = prefix_sums(hashes)
        at = np.arange(len(starts) - n + 1)
        body, place = _joined(low, starts, ends)
        body = body.tobytes()
        for i, h in zip(at.tolist(), range_hash(sums, at, at + n).tolist()):
            found.setdefault(n, {}).setdefault((h, body[place[i] : place[i + n]]), set()).add(number)
    for n, windows in found.items():
        order = sorted(windows)
        keys = np.array([h for h, _ in order], np.uint64)
        out.widths.append(n)
        out.keys[n] = keys
        out.maybe[n] = np.zeros(1 << _FILTER_BITS, bool)
        out.maybe[n][keys >> np.uint64(64 - _FILTER_BITS)] = True
        out.text[n] = (np.frombuffer(b"".join(t for _, t in order), np.uint8), np.cumsum([0, *(len(t) for _, t in order)]))
        out.owners[n] = (np.array([x for w in order for x in sorted(windows[w])], np.int64), np.cumsum([0, *(len(windows[w]) for w in order)]))
        out.repeats[n] = int(np.unique(keys, return_counts=True)[1].max())
    return out


def _same(body: np.ndarray, place: np.ndarray, n: int, at: np.ndarray, text: np.ndarray, offs: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Whether the n words at each ``at`` are byte for byte the window ``entry``."""
    size = place[at + n] - place[at]
    same = size == offs[entry + 1] - offs[entry]
    todo = np.flatnonzero(same)
    step = max(1, _VERIFY_BYTES // max(1, int(size[todo].max(initial=1))))
    for k in range(0, len(todo), step):
        part = todo[k : k + step]
        length = size[part]
        equal = body[ranges(place[at[part]], length)] == text[ranges(offs[entry[part]], length)]
        same[part] = segment_sums(equal, np.concatenate([[0], np.cumsum(length)])) == length
    return same


def hits(windows: WindowSet, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[set[int]], tuple[np.ndarray, np.ndarray]]:
    """(first word of each text, hit flag of each word, item numbers of each text, word bounds)."""
    low, starts, ends, first, hashes = _word_hashes(data, offs)
    n_words, texts = len(starts), len(offs) - 1
    marks = np.zeros(n_words + 1, np.int64)
    owners: list[set[int]] = [set() for _ in range(texts)]
    sums, joined = prefix_sums(hashes), None
    for n in windows.widths:
        at = ranges(first[:-1], np.maximum(0, np.diff(first) - n + 1))
        h = range_hash(sums, at, at + n)
        some = windows.maybe[n][h >> np.uint64(64 - _FILTER_BITS)]
        at, h = at[some], h[some]
        entry, found = lookup(windows.keys[n], h)
        at, h, entry = at[found], h[found], entry[found]
        if not len(at):
            continue
        if joined is None:
            joined = _joined(low, starts, ends)
        text_of = np.searchsorted(first, at, "right") - 1
        keys, (text, toffs), (items, ioffs) = windows.keys[n], windows.text[n], windows.owners[n]
        for k in range(windows.repeats[n]):  # different windows that share a hash stand side by side
            e = np.minimum(entry + k, len(keys) - 1)
            true = (keys[e] == h) & (entry + k < len(keys))
            true[true] = _same(*joined, n, at[true], text, toffs, e[true])
            np.add.at(marks, at[true], 1)
            np.add.at(marks, at[true] + n, -1)
            for t, x in set(zip(text_of[true].tolist(), e[true].tolist())):
                owners[t].update(items[ioffs[x] : ioffs[x + 1]].tolist())
    return first, np.cumsum(marks[:-1]) > 0, owners, (starts, ends)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def _scanner(windows, schema: T.StructType, cut: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds what one block's windows hit to the columns _n, _from, _to, _items (and _clean)."""
    types = {"_n": pa.int64(), "_from": pa.list_(pa.int32()), "_to": pa.list_(pa.int32()), "_items": pa.list_(pa.string())}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = windows.value
        for batch in batches:
            earlier = "_n" in batch.schema.names
            for rows, data, offs in text_blocks(batch, "_text"):
                first, flags, owners, (starts, ends) = hits(found, data, offs)
                part = batch.slice(rows.start, rows.stop - rows.start)
                old = part.select(["_from", "_to", "_items"]).to_pydict() if earlier else None
                out = {"_n": np.diff(first), "_from": [], "_to": [], "_items": []}
                clean: list[str | None] = []
                raw = data.tobytes() if cut else b""
                for t in range(len(offs) - 1):
                    own = flags[first[t] : first[t + 1]]
                    items = {found.items[x] for x in owners[t]}
                    if old:
                        items |= set(old["_items"][t])
                        own = own.copy()
                        for a, b in zip(old["_from"][t], old["_to"][t]):
                            own[a:b] = True
                    a, b = _runs(own) if items else ([], [])
                    out["_from"].append(list(map(int, a)))
                    out["_to"].append(list(map(int, b)))
                    out["_items"].append(sorted(items))
                    if cut:
                        pieces, last = [], int(offs[t])
                        for x, y in zip(a, b):
                            pieces.append(raw[last : int(starts[first[t] + x])])
                            last = int(ends[first[t] + y - 1])
                        clean.append(b"".join([*pieces, raw[last : int(offs[t + 1])]]).decode())
                columns = {k: part.column(k) for k in schema.names if k in part.schema.names and k not in types}
                columns |= {k: pa.array(v, types[k]) for k, v in out.items()}
                if cut:
                    columns["_clean"] = pa.array(clean, pa.string())
                yield pa.RecordBatch.from_arrays([columns[k] for k in schema.names], names=schema.names)

    return scan


def _blocks(items: DataFrame, total: int, block_bytes: int) -> list[DataFrame]:
    """The different items, dealt into measured blocks of up to ``block_bytes``, or of the few that share a small bucket with a longer item."""
    if total <= block_bytes:
        return [items]
    bucket = F.pmod(F.xxhash64("i", "t"), F.lit(64 * -(-total // block_bytes)))
    blocks, held = [], block_bytes
    for r in items.groupBy(bucket.alias("b")).agg(F.sum(F.octet_length("t")).alias("n")).orderBy("b").collect():
        if held + r["n"] > block_bytes:
            blocks.append((r["b"], r["b"]))
            held = 0
        blocks[-1] = (blocks[-1][0], r["b"])
        held += r["n"]
    return [items.filter(bucket.between(a, b)) for a, b in blocks]


def _scanned(docs: DataFrame, bench: DataFrame, text_col: str, item_col: str, item_text: str, width: int, block_bytes: int, keep: list[str], cut: bool) -> DataFrame:
    """The columns ``keep`` as _keep0 and so on, _n, _from, _to, _items, _hit, and with ``cut`` _clean."""
    items = bench.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t")).filter("t <> ''").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = _blocks(items, total, block_bytes)
    out = docs.select(*[F.col(f"`{c}`").alias(f"_keep{n}") for n, c in enumerate(keep)], F.col(text_col).alias("_text"))
    added = T.StructType().add("_n", "long").add("_from", T.ArrayType(T.IntegerType())).add("_to", T.ArrayType(T.IntegerType())).add("_items", T.ArrayType(T.StringType()))
    for block, part in enumerate(blocks):
        windows = docs.sparkSession.sparkContext.broadcast(window_set([(r["i"], r["t"]) for r in part.collect()], width))
        last = block == len(blocks) - 1
        fields = [f for f in out.schema.fields if f.name.startswith("_keep") or f.name == "_text" and not last]
        schema = T.StructType([*fields, *added.fields, *([T.StructField("_clean", T.StringType())] if cut and last else [])])
        out = out.mapInArrow(_scanner(windows, schema, cut and last), schema)
        if not last:  # a job of its own, so that one block's windows are in memory at a time
            out = stored(out)
            windows.destroy()
    n_hit = F.aggregate(F.zip_with("_to", "_from", lambda b, a: (b - a).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    return out.withColumn("_hit", n_hit)


def _contaminated(share: int) -> Column:
    return (F.col("_hit") > 0) & (F.col("_hit") * share >= F.col("_n"))


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = 13, share: int = 20, block_bytes: int = BLOCK_TEXT_BYTES, cut: bool = False) -> DataFrame:
    """Words of each text that lie in a window of a test item.

    Texts are lower-cased in A-Z; words are runs of ASCII letters, digits and
    characters beyond ASCII. A window is ``width`` words of an item in a row,
    or a shorter item as a whole. Returns id, n_words, n_hit, n_items,
    items_sha256, contaminated (n_hit > 0 and share * n_hit >= n_words),
    hit_from and hit_to (runs of hit words, end exclusive), and with ``cut``
    clean_text (the text without those runs).

    Null and empty texts have no words and are clean; items without words have
    no window; a null item id is named "null"; repeated items count once per
    id; repeated rows are each scanned. An empty benchmark hits nothing.
    Other columns, whatever their names, play no part; an empty table gives an empty one. A text is worked through as a whole, with some tens of bytes of arrays for each of its bytes.

    The total size of the different items is measured first. Up to ``block_bytes`` its
    windows are one broadcast; beyond that items are dealt into measured blocks, and every
    text is scanned for each block in a job of its own, with only that block broadcast.
    """
    out = _scanned(docs, bench, text_col, item_col, item_text, width, block_bytes, [id_col], cut)
    return out.select(
        F.col("_keep0").alias(id_col), F.col("_n").alias("n_words"), F.col("_hit").alias("n_hit"), F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        _contaminated(share).alias("contaminated"), F.col("_from").alias("hit_from"), F.col("_to").alias("hit_to"), *([F.col("_clean").alias("clean_text")] if cut else []),
    )


def clean_documents(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", width: int = 13, share: int = 20, block_bytes: int = BLOCK_TEXT_BYTES) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, unchanged; otherwise as ``contamination``."""
    out = _scanned(docs, bench, text_col, item_col, item_text, width, block_bytes, docs.columns, False)
    return out.filter(~_contaminated(share)).select(*[F.col(f"_keep{n}").alias(c) for n, c in enumerate(docs.columns)])
