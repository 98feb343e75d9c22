"""Substring dedup by sliding sentence spans (operator 1)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landquill.llm.common import stored
from landquill.llm.textbytes import LOWER, NOT_SPACE, mix, prefix_sums, range_hash, ranges, segment_sums, text_blocks, word_bounds

#: Sentences and words that a span has at least.
RUN, LEAST_WORDS = 3, 15
#: Sentences of over LONG words are cut behind the word of the least hash in
#: every WINDOW words (a power of two). Two texts that share RUN * LONG +
#: 3 * WINDOW words or more thus share a span: the first cut that both have
#: comes after at most 2 * WINDOW - 1 of these words, RUN parts of at most LONG
#: words follow, and only the last WINDOW - 1 words may be cut otherwise.
LONG, WINDOW = 9, 8
_MARKS = np.zeros(256, dtype=bool)
_MARKS[list(b".!?")] = True
#: Marks beyond ASCII, by their number of bytes.
_LONG_MARKS = {n: np.array([int.from_bytes(m.encode(), "big") for m in "。！？．｡…‼⁇⁈⁉।॥؟۔։።፧။។" if len(m.encode()) == n]) for n in (2, 3)}


def _marked(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each word has a sentence mark at its end."""
    out = _MARKS[low[ends - 1]]
    for n, marks in _LONG_MARKS.items():
        at = np.flatnonzero((low[ends - 1] >= 0x80) & (ends - starts >= n))
        code = np.zeros(len(at), np.int64)
        for k in range(n, 0, -1):
            code = code << 8 | low[ends[at] - k]
        out[at] |= np.isin(code, marks)
    return out


def _picked(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words with the least hash, the last of equal ones, in some WINDOW words within a sentence of over LONG words."""
    best, step = np.arange(len(hashes)), 1
    while step < WINDOW:
        left, right = best[:-step], best[step:]
        best = np.where(hashes[right] <= hashes[left], right, left)
        step *= 2
    sentence = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = (sentence[: len(best)] == sentence[len(sentence) - len(best) :]) & (np.diff(bounds) > LONG)[sentence[: len(best)]]
    return best[inside]


def sentences(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte, word count, hash of each sentence; first sentence of each text).

    A sentence ends behind a word with ., !, ? or a like mark of another script
    at its end, before a line feed and at the end of the text. Sentences of over LONG words are cut at
    words that their content picks, so that equal passages are cut alike.
    White space and the case of A-Z do not count.
    """
    low = LOWER[data]
    starts, ends, first = word_bounds(low, offs, NOT_SPACE)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    hashes = range_hash(prefix_sums(low), starts, ends)
    feeds = np.concatenate([[0], np.cumsum(data == 0x0A)])
    last = _marked(low, starts, ends)
    last[:-1] |= feeds[starts[1:]] > feeds[ends[:-1]]
    last[first[1:][first[1:] > 0] - 1] = True
    bounds = np.concatenate([[0], np.flatnonzero(last) + 1])
    last[_picked(hashes, bounds)] = True
    bounds = np.concatenate([[0], np.flatnonzero(last) + 1])
    h = range_hash(prefix_sums(hashes), bounds[:-1], bounds[1:])
    return starts[bounds[:-1]], ends[bounds[1:] - 1], np.diff(bounds), h, np.searchsorted(bounds[:-1], first)


def spans(words: np.ndarray, hashes: np.ndarray, first: np.ndarray, run: int, least_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first sentence, end sentence, hash) of every span: from each sentence on ``run`` sentences, and more until there are enough words."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(len(words))
    total = np.concatenate([[0], np.cumsum(words)])
    end = np.maximum(at + run, np.searchsorted(total, total[at] + least_words))
    good = end <= first[text + 1]
    at, end, text = at[good], end[good], text[good]
    h = range_hash(prefix_sums(hashes), at, end) if len(at) else np.zeros(0, np.uint64)
    return text, at, end, mix(h)


def span_checks(data: np.ndarray, offs: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A second hash of spans of whole words, from byte to byte: of the words themselves with one space between them."""
    low = LOWER[data]
    starts, stops, _ = word_bounds(low, offs, NOT_SPACE)
    lengths = stops - starts + 1
    place = np.concatenate([[0], np.cumsum(lengths)])
    plain = low[np.minimum(ranges(starts, lengths), len(low) - 1)]
    plain[place[1:] - 1] = 0x20
    raw = memoryview(plain.tobytes())
    bounds = zip(place[np.searchsorted(starts, begins)].tolist(), place[np.searchsorted(stops, ends) + 1].tolist())
    return np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in bounds), np.uint64, len(begins))


def _firsts(text: np.ndarray, *hashes: np.ndarray) -> np.ndarray:
    """Places of the first of equal hashes in each text, sorted by text."""
    order = np.lexsort((*hashes[::-1], text))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in (text, *hashes)])
    return order[new]


def _span_rows(texts: DataFrame, kind: str, run: int, least_words: int, hash_bits: int, checked: bool) -> DataFrame:
    """h of the different spans of each text, and with ``checked`` h2 and _id."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offs in text_blocks(batch, "_text"):
                start, end, words, hashes, first = sentences(data, offs)
                text, at, end_at, h = spans(words, hashes, first, run, least_words)
                h >>= np.uint64(64 - hash_bits)
                if not checked:
                    yield pa.RecordBatch.from_arrays([pa.array(h[_firsts(text, h)].view(np.int64))], names=["h"])
                    continue
                h2 = span_checks(data, offs, start[at], end[end_at - 1]) if len(at) else h
                own = _firsts(text, h, h2)
                ids = batch.column("_id").slice(rows.start, rows.stop - rows.start).take(pa.array(text[own]))
                yield pa.RecordBatch.from_arrays([pa.array(h[own].view(np.int64)), pa.array(h2[own].view(np.int64)), ids], names=["h", "h2", "_id"])

    return texts.mapInArrow(scan, f"h bigint, h2 bigint, _id {kind}") if checked else texts.select("_text").mapInArrow(scan, "h bigint")


def span_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, least_words: int = LEAST_WORDS, hash_bits: int = 64) -> DataFrame:
    """Remove sentences that a repeated span covers, wherever it isn't the first.

    From every sentence on, the run of ``run`` consecutive sentences, or of as
    many more as it takes to ``least_words`` words, is hashed. Spans whose hashes (their first ``hash_bits`` bits) repeat are read
    once more, and are equal where a second hash, of the words themselves, is too. The first of equal spans is the one of the smallest id,
    and in that text the one that comes first; all others are removed, judged
    on the input. Returns every document: id, n_sentences, n_removed,
    words_removed, first_ids (ids of the texts whose spans stay instead,
    sorted), kept_text. What is left of a text keeps its own white space, the
    removed sentences go with the white space behind them. Null and empty
    texts have no sentences; a null kept_text stands for a null text. Rows
    that repeat an id count as one document. Spans of rows with a null id are
    removed against others but are first for none.
    Other columns, whatever their names, play no part; an empty table gives an empty one.
    A text is worked through as a whole, with some tens of bytes of arrays for each of its bytes.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = texts.schema["_id"].dataType.simpleString()
    repeated = _span_rows(texts, kind, run, least_words, hash_bits, False).groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    hits = stored(_span_rows(texts, kind, run, least_words, hash_bits, True).join(stored(repeated).hint("merge"), "h", "left_semi"))
    heads = hits.groupBy("h", "h2").agg(F.min("_id").alias("head"), F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) & F.col("head").isNotNull()).select("h", "h2", "head")
    later = hits.join(stored(heads).hint("merge"), ["h", "h2"]).filter(~F.col("_id").eqNullSafe(F.col("head")))
    taken = later.groupBy("_id").agg(F.collect_list(F.struct((F.col("h").bitwiseXOR(F.col("h2"))).alias("key"), "head")).alias("taken"))  # at most a text's own spans

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offs in text_blocks(batch, "_text"):
                own = batch.slice(part.start, part.stop - part.start)
                start, end, words, hashes, first = sentences(data, offs)
                text, at, end_at, h = spans(words, hashes, first, run, least_words)
                h >>= np.uint64(64 - hash_bits)
                h2 = span_checks(data, offs, start[at], end[end_at - 1]) if len(at) else h
                again = np.ones(len(h), bool)
                again[_firsts(text, h, h2)] = False
                bounds = np.searchsorted(text, np.arange(len(offs)))
                gone = np.zeros(len(start) + 1, np.int64)
                head_ids: list[list[int]] = []
                for t, known in enumerate(own.column("taken").to_pylist()):
                    a, b = bounds[t], bounds[t + 1]
                    known = {x["key"]: x["head"] for x in known or ()}
                    first_ids = [known.get(x) for x in (h[a:b] ^ h2[a:b]).view(np.int64).tolist()] if known else []
                    if known:
                        again[a:b] |= np.array([x is not None for x in first_ids], bool)
                    head_ids.append(sorted({x for x in first_ids if x is not None}))
                np.add.at(gone, at[again], 1)
                np.add.at(gone, end_at[again], -1)
                removed = np.cumsum(gone[:-1]) > 0
                raw, kept = data.tobytes(), []
                nulls = own.column("_text").is_null().to_pylist()
                for t in range(len(offs) - 1):
                    pieces, last = [], int(offs[t])
                    for k in np.flatnonzero(removed[first[t] : first[t + 1]]) + first[t]:
                        pieces.append(raw[last : int(start[k])])
                        last = int(start[k + 1]) if k + 1 < first[t + 1] else int(offs[t + 1])
                    kept.append(None if nulls[t] else b"".join([*pieces, raw[last : int(offs[t + 1])]]).decode())
                arrays = [own.column("_id"), pa.array(np.diff(first)), pa.array(segment_sums(removed, first)), pa.array(segment_sums(words * removed, first)), pa.array(head_ids, pa.list_(own.schema.field("_id").type)), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["_id", "n_sentences", "n_removed", "words_removed", "first_ids", "kept_text"])

    joined = texts.join(taken, texts["_id"].eqNullSafe(taken["_id"]), "left").select(texts["_id"], "_text", "taken")
    schema = T.StructType([texts.schema["_id"]]).add("n_sentences", "long").add("n_removed", "long").add("words_removed", "long").add("first_ids", T.ArrayType(texts.schema["_id"].dataType)).add("kept_text", "string")
    return joined.mapInArrow(scan, schema).withColumnRenamed("_id", id_col)
