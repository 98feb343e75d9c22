"""Removal of repeated byte strings by merging Burrows-Wheeler transforms (operator 3)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landquill.llm.common import stored
from landquill.llm.textbytes import mix, prefix_sums, range_hash, ranges, segment_sums, text_blocks, text_buffer

#: Bytes of a repeated string that is removed, and of one that is counted (words of a passage of over 50 take about 300 bytes).
LENGTH, PASSAGE = 400, 300
#: Bytes of the seeds by which windows are brought together.
SEED = 64
#: Bytes of a symbol of the transforms.
SYMBOL = 100
#: Texts are cut into parts of so many window starts, which bounds the arrays of a scan.
PART = 1 << 22
_POSITION_BITS = 24
#: Bytes of segments that one task merges, about, and of one shard of them.
TASK_BYTES, SHARD_BYTES = 1 << 20, 1 << 18
#: Different segments around one seed up to which they meet by that seed; more
#: of them meet by longer seeds, and beyond ENOUGH by whole windows.
CROWD, ENOUGH = 1 << 8, 1 << 12
#: Places of the seed in a window that share a longer seed.
SLICE = 32


def _parts(offs: np.ndarray, window: int, length: int) -> Iterator[tuple[int, int, int]]:
    """(text, from, to) of parts of at most PART windows, with the bytes of the ``length``-byte strings that start there; all windows are in one part each."""
    for t in range(len(offs) - 1):
        size = int(offs[t + 1] - offs[t])
        for a in range(0, size - window + 1, PART):
            yield t, a, min(size, a + PART + length - 1)


def anchors(seeds: np.ndarray, window: int) -> np.ndarray:
    """For every window of ``window`` seeds the place of its least one, the first of equals.

    Minima of all windows come from running minima of blocks from both sides.
    """
    n = len(seeds) - window + 1
    place = np.arange(len(seeds), dtype=np.uint64)
    low = np.uint64((1 << _POSITION_BITS) - 1)
    value = (seeds & ~low) | place
    blocks = -(-len(seeds) // window)
    padded = np.full(blocks * window, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(seeds)] = value
    grid = padded.reshape(blocks, window)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[:n], ahead[window - 1 : window - 1 + n]) & low).astype(np.int64)


def segments_of(data: np.ndarray, offs: np.ndarray, window: int, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, bytes, place of the seed from there, seed hash, segment hash) of the runs of windows with one anchor.

    ``data`` holds the texts on end, or one part of a text. A segment's bytes
    are those of all strings of ``length`` bytes that start at its windows, as
    far as the text goes. Equal windows have equal anchors at the same place,
    so only segments with equal seeds can hold equal windows.
    """
    sums = prefix_sums(data)
    at = np.arange(len(data) - seed + 1)
    hashes = range_hash(sums, at, at + seed)
    anchor = anchors(hashes, window - seed + 1)
    size = np.minimum(PART, np.maximum(0, np.diff(offs) - window + 1))
    text = np.repeat(np.arange(len(size)), size)
    at = ranges(offs[:-1], size)  # windows that lie within a text
    own_anchor = anchor[at]
    new = np.ones(len(at), bool)
    new[1:] = (own_anchor[1:] != own_anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(at)]]))
    text, start, place = text[first], at[first], own_anchor[first]
    stop = np.minimum(start + count + length - 1, offs[1:][text])
    whole = range_hash(sums, start, stop)
    own = mix(whole + mix(((place - start) << 32 | count).astype(np.uint64)))
    return text, start - offs[:-1][text], count, stop - start, place - start, hashes[place], own


def _segment_rows(texts: DataFrame, kind: str, window: int, length: int, seed: int) -> DataFrame:
    """_id, _own (hash of the text), s0, windows, size, place, key, seg of all segments."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in text_blocks(batch, "_text"):
                # Short texts are taken together.
                if offs[-1] <= PART:
                    found = [segments_of(data, offs, window, length, seed)] if offs[-1] >= window else []
                else:
                    found = []
                    for t, a, b in _parts(offs, window, length):
                        _, s0, *more = segments_of(data[offs[t] + a : offs[t] + b], np.array([0, b - a]), window, length, seed)
                        found.append((np.full(len(s0), t), s0 + a, *more))
                if not found:
                    continue
                text, s0, n, size, place, key, own = (np.concatenate(x) for x in zip(*found))
                take = pa.array(text + rows.start)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(take), batch.column("_own").take(take), pa.array(s0.astype(np.int64)), *(pa.array(x.astype(np.int32)) for x in (n, size, place)), pa.array(key.view(np.int64)), pa.array(own.view(np.int64))],
                    names=["_id", "_own", "s0", "windows", "size", "place", "key", "seg"],
                )

    return texts.mapInArrow(scan, f"_id {kind}, _own bigint, s0 bigint, windows int, size int, place int, key bigint, seg bigint")


class Shard:
    """Segments with the Burrows-Wheeler transform of their strands.

    A symbol is the hash of ``symbol`` bytes; the symbols of a segment at
    distance ``symbol`` form a strand, with an end symbol (0, the least)
    behind. The suffixes of all strands are in order here, with the segment
    and byte that each begins at, and the symbol before it (the end symbol
    before a strand's first).
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, windows: np.ndarray, symbol: int) -> None:
        size = np.diff(offs)
        count = size - symbol + 1  # symbols of a segment
        strands = np.minimum(symbol, count)
        sums = prefix_sums(data)
        at = ranges(offs[:-1], count)
        letters = range_hash(sums, at, at + symbol) | np.uint64(1)
        rank = np.unique(letters, return_inverse=True)[1].astype(np.uint64) + np.uint64(1)  # 0 is the end symbol's
        base = np.concatenate([[0], np.cumsum(count)])
        segment = np.repeat(np.arange(len(size)), count)
        place = np.arange(len(at)) - base[:-1][segment]
        deepest = int((count.max(initial=0) + symbol - 1) // symbol)
        # Columns of the suffixes' symbols; the end symbol's own suffixes come first.
        ends = int(strands.sum())
        total = ends + len(letters)
        columns = []
        for k in range(deepest):
            column = np.zeros(total, np.uint64)
            inside = np.flatnonzero(place + k * symbol < count[segment])
            column[ends + inside] = rank[inside + k * symbol]
            columns.append(column)
        strand_base = np.concatenate([[0], np.cumsum(strands)])
        columns.append(np.concatenate([np.arange(ends), strand_base[:-1][segment] + place % symbol]).astype(np.uint64))
        order = sorted_by(columns)
        before = np.zeros(total, np.uint64)
        later = np.flatnonzero(place >= symbol)
        before[ends + later] = letters[later - symbol]
        strand_segment = np.repeat(np.arange(len(size)), strands)
        strand_place = np.arange(ends) - strand_base[:-1][strand_segment]
        last = strand_place + (count[strand_segment] - 1 - strand_place) // symbol * symbol
        before[:ends] = letters[base[:-1][strand_segment] + last]
        self.transform = before[order]
        self.segment = np.concatenate([np.full(ends, -1, np.int32), segment.astype(np.int32)])[order]
        self.place = np.concatenate([np.zeros(ends, np.int32), place.astype(np.int32)])[order]
        starts = (self.segment >= 0) & (self.place < windows[self.segment])
        #: Bytes from here to the segment's end where a window begins, 0 elsewhere.
        self.room = np.where(starts, size[self.segment] - self.place, 0).astype(np.int32)


def sorted_by(columns: list[np.ndarray]) -> np.ndarray:
    """The order by the columns, whose values are below 2^20, the first counting most; two of them and the place so far make one sort key."""
    order = np.arange(len(columns[0]), dtype=np.uint64)
    bits, low = np.uint64(24), np.uint64((1 << 24) - 1)
    for k in range(len(columns) - 1, -1, -2):
        key = columns[k][order] << bits | np.arange(len(order), dtype=np.uint64)
        if k:
            key |= columns[k - 1][order] << np.uint64(44)
        key.sort()
        order = order[key & low]
    return order


def merge_transforms(transforms: list[np.ndarray], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """After each round (the merged place of every suffix, shard behind shard; the block at every merged place).

    Only the transforms are read. The interleave starts as shard behind shard.
    Each round reads the symbol before every suffix, in the order so far, and
    deals the suffixes one symbol longer into the symbols' buckets, which
    keeps the order of equal ones. Two neighbours share their first symbols
    as far as they were dealt into one bucket from one block, so the blocks
    after a round are the intervals with that long a common prefix.
    """
    sizes = [len(t) for t in transforms]
    total = sum(sizes)
    rank = np.unique(np.concatenate([*transforms, np.zeros(0, np.uint64)]), return_inverse=True)[1].astype(np.uint64) << np.uint64(32)
    interleave = np.repeat(np.arange(len(transforms), dtype=np.uint16), sizes)
    block, place = np.zeros(total, np.int32), np.arange(total)
    for _ in range(depth):
        key = np.empty(total, np.uint64)
        key[place] = rank
        key |= np.arange(total, dtype=np.uint64)
        key.sort()
        order, dealt = (key & np.uint64(0xFFFFFFFF)).astype(np.int64), key >> np.uint64(32)
        source = block[order]
        new = np.ones(total, bool)
        new[1:] = (dealt[1:] != dealt[:-1]) | (source[1:] != source[:-1])
        interleave, block = interleave[order], np.cumsum(new, dtype=np.int32) - 1
        place = np.argsort(interleave, kind="stable")
        yield place, block


def repeated_windows(shards: list[Shard], copies: list[np.ndarray], symbol: int, lengths: tuple[int, ...]) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    """For each length and shard (segment, place) of the windows whose string of that length occurs more than once, copies counted."""
    bounds = np.cumsum([0, *(len(s.transform) for s in shards)])
    room = np.concatenate([s.room for s in shards])
    n = np.concatenate([c[s.segment] for s, c in zip(shards, copies)])
    out = {}
    for depth, (place, block) in enumerate(merge_transforms([s.transform for s in shards], max(lengths) // symbol), 1):
        if depth * symbol in lengths:
            window = room >= depth * symbol
            mine = block[place]
            often = np.bincount(mine, np.where(window, n, 0), minlength=len(block)) > 1
            good = often[mine] & window
            out[depth * symbol] = [(s.segment[g], s.place[g]) for s, a, b in zip(shards, bounds, bounds[1:]) for g in [good[a:b]]]
    return out


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_buffer(pa.Array.from_buffers(pa.string(), len(column), column.buffers(), offset=column.offset))


def _merge_segments(rows: DataFrame, lengths: tuple[int, ...], symbol: int) -> DataFrame:
    """rows: key, seg, base, windows, n, body; returns length, seg, a, b of covered runs, for each segment that has any."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, copies, names, bases = [], [], [], []
        for batch in batches:
            data, offs = _binary(batch.column("body"))
            windows, n, seg, base = (batch.column(c).to_numpy() for c in ("windows", "n", "seg", "base"))
            i = 0
            while i < len(seg):
                j = max(i + 1, int(np.searchsorted(offs, offs[i] + SHARD_BYTES, "right")) - 1)
                shards.append(Shard(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], windows[i:j].astype(np.int64), symbol))
                copies.append(n[i:j].astype(np.int64))
                names.append(seg[i:j])
                bases.append(base[i:j])
                i = j
        if not shards:
            return
        for length, found in repeated_windows(shards, copies, symbol, lengths).items():
            for (segment, place), seg, base in zip(found, names, bases):
                order = np.lexsort((place, segment))
                segment, place = segment[order], place[order]
                new = np.ones(len(place), bool)
                new[1:] = (segment[1:] != segment[:-1]) | (place[1:] > place[:-1] + length)
                first = np.flatnonzero(new)
                if not len(first):
                    continue
                last = np.concatenate([first[1:], [len(place)]]) - 1
                shift = base[segment[first]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), length, np.int32)), pa.array(seg[segment[first]]), pa.array(shift + place[first]), pa.array(shift + place[last] + length)], names=["length", "seg", "a", "b"])

    return rows.mapInArrow(merge, "length int, seg bigint, a bigint, b bigint")


def _cut(rows: DataFrame) -> DataFrame:
    """rows: _text, wanted (array of key, seg, s0, size, place, windows, n); returns key, seg, base, place, windows, n, body."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in text_blocks(batch, "_text"):
                wanted = batch.column("wanted").slice(part.start, part.stop - part.start)
                counts = np.diff(np.asarray(wanted.offsets, np.int64))
                text = np.repeat(np.arange(len(counts)), counts)
                flat = wanted.flatten()
                fields = {name: flat.field(k) for k, name in enumerate(f.name for f in flat.type)}
                at, size = offs[:-1][text] + fields["s0"].to_numpy(), fields["size"].to_numpy()
                body = data[ranges(at, size)]
                bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                column = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(body))])
                arrays = [fields["key"], fields["seg"], pa.array(np.zeros(len(size), np.int64)), fields["place"], fields["windows"], fields["n"], column]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "seg", "base", "place", "windows", "n", "body"])

    return rows.mapInArrow(cut, "key bigint, seg bigint, base bigint, place int, windows int, n bigint, body binary")


def _longer_seeds(rows: DataFrame, window: int, length: int) -> DataFrame:
    """The segments of crowded seeds as slices that meet by nearly whole windows.

    Windows that hold the seed at one of SLICE neighbouring places share the
    window - SLICE + 1 bytes that all of them cover; the hash of these is the
    new key. Equal windows hold the seed at the same place, so they are in
    slices of the same key.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = window - SLICE + 1
        for batch in batches:
            data, offs = _binary(batch.column("body"))
            windows, place = batch.column("windows").to_numpy().astype(np.int64), batch.column("place").to_numpy().astype(np.int64)
            # Window j holds the seed at place - j; slice r has the places from r * SLICE on.
            low, high = (place - windows + 1) // SLICE, place // SLICE
            count = high - low + 1
            row = np.repeat(np.arange(len(windows)), count)
            r = ranges(low, count)
            first = np.maximum(0, place[row] - r * SLICE - SLICE + 1)
            last = np.minimum(windows[row] - 1, place[row] - r * SLICE)
            at = offs[:-1][row] + place[row] - r * SLICE
            key = mix(range_hash(prefix_sums(data), at, at + core) + mix(r.astype(np.uint64)))
            size = np.minimum(last + length, np.diff(offs)[row]) - first
            body = data[ranges(offs[:-1][row] + first, size)]
            bounds = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            column = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(body))])
            take = pa.array(row)
            arrays = [pa.array(key.view(np.int64)), batch.column("seg").take(take), pa.array(first), pa.array((last - first + 1).astype(np.int32)), batch.column("n").take(take), column]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "seg", "base", "windows", "n", "body"])

    return rows.mapInArrow(cut, "key bigint, seg bigint, base bigint, windows int, n bigint, body binary")


def _crowded_runs(rows: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """The same as _merge_segments where very many slices share even the longer seed: slices of one place each, which meet by both halves of the window, are added up before the shuffle."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = _binary(batch.column("body"))
            windows, sums = batch.column("windows").to_numpy().astype(np.int64), prefix_sums(data)
            for length in lengths:
                inside = np.minimum(windows, np.maximum(0, np.diff(offs) - length + 1))
                at = ranges(offs[:-1], inside)
                segment = np.repeat(np.arange(len(windows)), inside)
                h1, h2 = range_hash(sums, at, at + length // 2), range_hash(sums, at + length // 2, at + length)
                take = pa.array(segment)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), length, np.int32)), batch.column("seg").take(take), pa.array(at - offs[:-1][segment] + batch.column("base").to_numpy()[segment]), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), batch.column("n").take(take)],
                    names=["length", "seg", "a", "h1", "h2", "n"],
                )

    windows = stored(rows.mapInArrow(spread, "length int, seg bigint, a bigint, h1 bigint, h2 bigint, n bigint"))
    often = stored(windows.groupBy("length", "h1", "h2").agg(F.sum("n").alias("_t")).filter("_t > 1").select("length", "h1", "h2"))
    return windows.join(often, ["length", "h1", "h2"]).select("length", "seg", "a", (F.col("a") + F.col("length")).alias("b"))


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, passage: int = PASSAGE, seed: int = SEED, symbol: int = SYMBOL, crowd: int = CROWD, enough: int = ENOUGH, keep_bytes: bool = False) -> DataFrame:
    """Remove every byte of a string of ``length`` bytes that also starts anywhere else.

    Texts are UTF-8 bytes; strings stay within a text, may overlap and count
    in the same text too; all are judged on the input. Returns id, n_bytes,
    n_removed, n_spans (maximal removed runs), kept_sha256, n_repeated (bytes
    of strings of the shorter length ``passage`` that also start elsewhere;
    nothing is removed for these), and with ``keep_bytes`` kept (what is left,
    which may cut characters).

    1. Every window of ``passage`` bytes has an anchor, the least of its hashed
       seeds; windows in a row with one anchor are a segment, with the bytes of
       the longer strings that start there. Equal windows have equal seeds
       there, so segments whose seed is alone are dropped, and equal segments
       become one with a number of copies.
    2. Different segments around one seed meet in a task. It cuts them into
       shards, orders each shard's suffixes into a Burrows-Wheeler transform
       over ``symbol``-byte letters, and merges the transforms by refining
       their interleave, a letter a round; the intervals with a common prefix
       after ``passage`` and after ``length`` bytes are the repeated strings.
       The segments of a seed with more than ``crowd`` of them are cut into
       slices that meet by longer seeds. Should more than ``enough`` slices
       share even one of these, slices of one place each meet in an aggregate.
    3. The strings' bytes go back to all texts that hold the segment.

    ``length`` and ``passage`` are multiples of ``symbol``, ``passage`` at most
    ``length``. Null and empty texts have 0 bytes; repeated rows are each
    other's copies. A text's rows are known by id and a 64-bit hash of the
    text. Segments count as equal if the 64-bit hashes both of their seeds and
    of all their bytes are equal, strings in a task if those of all their
    letters are, so a chance of a mistake would need two hashes to meet at once.
    Other columns, whatever their names, play no part; an empty table gives an empty one.
    Long texts are cut into parts. ``passage`` suits words of about six bytes: 51 of them are some 314; in a script of longer words ``n_repeated`` asks for fewer words.
    """
    if length % symbol or passage % symbol or not seed <= passage <= length:
        raise ValueError("length and passage have to be multiples of symbol, in the order seed, passage, length")
    lengths = (passage, length) if passage < length else (length,)
    texts = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_own"), F.col(text_col).alias("_text"))
    kind = texts.schema["_id"].dataType.simpleString()
    rows = stored(_segment_rows(texts, kind, passage, length, seed))
    classes = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("seg").alias("lo"), F.max("seg").alias("hi")).filter("n > 1"))
    rows = stored(rows.join(classes, "key").select("_id", "_own", "s0", "windows", "size", "place", "key", "seg", (F.col("lo") != F.col("hi")).alias("mixed")))

    # One place for each different segment; which one doesn't matter.
    rank = F.xxhash64("_id", "_own", "s0")
    places = rows.filter("mixed").groupBy("key", "seg").agg(F.count(F.lit(1)).alias("n"), F.min_by("_id", rank).alias("_id"), F.min_by("_own", rank).alias("_own"), F.min_by("s0", rank).alias("s0"), F.max("windows").alias("windows"), F.max("size").cast("long").alias("size"), F.max("place").alias("place"))
    places = stored(places)
    of = lambda table, most: stored(table.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > most).select("key"))
    item = F.struct("key", "seg", "s0", "size", "place", "windows", "n")
    wanted = places.groupBy("_id", "_own").agg(F.collect_list(item).alias("wanted"))
    same = texts["_id"].eqNullSafe(wanted["_id"]) & (texts["_own"] == wanted["_own"])
    bodies = stored(_cut(texts.join(wanted, same).select("_text", "wanted")))
    columns = ["key", "seg", "base", "windows", "n", "body"]
    crowds = of(places, crowd)
    calm = bodies.join(crowds, "key", "left_anti").select(columns)
    hashed = None
    if not crowds.isEmpty():
        slices = stored(_longer_seeds(bodies.join(crowds, "key", "left_semi"), passage, length))
        still = of(slices, enough)
        calm = calm.unionByName(slices.join(still, "key", "left_anti").select(columns))
        hashed = None if still.isEmpty() else _crowded_runs(slices.join(still, "key", "left_semi"), lengths)
    calm = stored(calm)
    size = calm.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    runs = _merge_segments(calm.repartition(tasks, "key"), lengths, symbol)
    runs = stored(runs if hashed is None else runs.union(hashed))

    mixed = rows.filter("mixed").join(runs, "seg").select("_id", "_own", "length", (F.col("s0") + F.col("a")).alias("a"), (F.col("s0") + F.col("b")).alias("b"))
    alike = rows.filter("NOT mixed").select("_id", "_own", F.explode(F.array(*map(F.lit, lengths))).alias("length"), F.col("s0").alias("a"), "windows", "size")
    last = F.least("windows", F.col("size") - F.col("length") + 1)  # windows from which a string of that length goes on
    alike = alike.filter(last > 0).select("_id", "_own", "length", "a", (F.col("a") + last - 1 + F.col("length")).alias("b"))
    gone = mixed.union(alike).groupBy(F.col("_id").alias("_i"), F.col("_own").alias("_o")).agg(F.collect_list(F.struct("length", "a", "b")).alias("gone"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in text_blocks(batch, "_text"):
                lists = batch.column("gone").slice(part.start, part.stop - part.start)
                counts = np.diff(np.asarray(lists.offsets, np.int64)) * lists.is_valid().to_numpy(zero_copy_only=False)
                flat, text = lists.flatten(), np.repeat(np.arange(len(offs) - 1), counts)
                kinds, a, b = (flat.field(k).to_numpy() for k in range(3))
                hit = {}
                for size in lengths:
                    mine = kinds == size
                    change = np.bincount(offs[text[mine]] + a[mine], minlength=len(data) + 1) - np.bincount(offs[text[mine]] + b[mine], minlength=len(data) + 1)
                    hit[size] = np.cumsum(change[:-1]) > 0
                out, repeated = hit[length], segment_sums(hit[passage], offs)
                before = np.concatenate([[False], out[:-1]])[: len(out)]
                before[offs[:-1][offs[:-1] < len(out)]] = False
                edge = out & ~before
                digests, kept = [], []
                for t in range(len(offs) - 1):
                    own = slice(offs[t], offs[t + 1])
                    left = data[own][~out[own]].tobytes()
                    digests.append(hashlib.sha256(left).hexdigest())
                    if keep_bytes:
                        kept.append(left)
                ids = batch.column("_id").slice(part.start, part.stop - part.start)
                arrays = [ids, pa.array(np.diff(offs)), pa.array(segment_sums(out, offs)), pa.array(segment_sums(edge, offs)), pa.array(digests, pa.string()), pa.array(repeated)]
                names = ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_repeated"]
                if keep_bytes:
                    arrays, names = [*arrays, pa.array(kept, pa.binary())], [*names, "kept"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    joined = texts.join(gone, texts["_id"].eqNullSafe(gone["_i"]) & (texts["_own"] == gone["_o"]), "left").select("_id", "_text", "gone")
    schema = T.StructType([texts.schema["_id"]]).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string").add("n_repeated", "long")
    return joined.mapInArrow(finish, schema.add("kept", "binary") if keep_bytes else schema).withColumnRenamed("_id", id_col)
