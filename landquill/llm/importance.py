"""Resampling towards a target distribution by importance weights (operator 11).

Features are runs of words; a feature's bucket is its CRC-32. Each different
word between delimiters is an entry of an Aho-Corasick dictionary with its CRC
and its length; scanning a text emits those payloads word by word, and payloads
side by side compose into that of the run, so that no run is ever spelled out.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landquill.llm.common import columns_of, stored
from landquill.llm.textbytes import ALNUM, LOWER, text_buffer
from landquill.shared import running

#: Bytes of text in work at once, entries of a task's dictionary at most, and bytes of a word that may be one; other words
#: have their CRC computed where they stand.
WINDOW_BYTES, ENTRIES, ENTRY_BYTES = 1 << 20, 1 << 17, 64
#: Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
_CLEAN = bytes(np.where(ALNUM[LOWER], LOWER, 0x20).astype(np.uint8))


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, the highest power in the lowest bit."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


def _shift_tables(bits: int) -> np.ndarray:
    """tables[k, j, v]: what byte j of a CRC, of value v, adds to it once 2^k bytes follow."""
    out, power = np.zeros((bits, 4, 256), np.uint32), 1 << 23  # x^8, one byte
    for k in range(bits):
        single = [_times(power, 1 << b) for b in range(32)]
        for j in range(4):
            for b in range(8):
                out[k, j, 1 << b : 2 << b] = out[k, j, : 1 << b] ^ np.uint32(single[8 * j + b])
        power = _times(power, power)
    return out


_SHIFTS = _shift_tables(31)


def composed(crc: np.ndarray, length: np.ndarray, next_crc: np.ndarray, next_length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Payloads (CRC, length) of texts each followed by another, from the payloads of both."""
    out = crc.astype(np.uint32)
    for k in range(int(next_length.max(initial=0)).bit_length()):
        at = np.flatnonzero(next_length >> k & 1)
        c = out[at]
        out[at] = _SHIFTS[k, 0, c & 255] ^ _SHIFTS[k, 1, c >> 8 & 255] ^ _SHIFTS[k, 2, c >> 16 & 255] ^ _SHIFTS[k, 3, c >> 24]
    return out ^ next_crc.astype(np.uint32), length + next_length


class Dictionary:
    """Words with their payloads; grows by the words that a scan doesn't know, up to ENTRIES."""

    def __init__(self) -> None:
        import ahocorasick

        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self._crc, self._bytes, self._chars = (np.zeros(0, t) for t in (np.uint32, np.int64, np.int64))
        self._new: dict[str, tuple[int, int]] = {}

    def _learn(self) -> None:
        room = ENTRIES - len(self._crc)
        words = [w for w, (_, n) in self._new.items() if n <= ENTRY_BYTES][:room]
        for k, w in enumerate(words, len(self._crc)):
            self._automaton.add_word(f" {w} ", k)
        self._automaton.make_automaton()
        self._crc = np.concatenate([self._crc, np.array([self._new[w][0] for w in words], np.uint32)])
        self._bytes = np.concatenate([self._bytes, np.array([self._new[w][1] for w in words], np.int64)])
        self._chars = np.concatenate([self._chars, np.array([len(w) for w in words], np.int64)])
        self._new.clear()

    def scan(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(CRCs, lengths in bytes) of the words of a text with one space before, between and behind them."""
        if len(self._crc):
            flat = np.fromiter(itertools.chain.from_iterable(self._automaton.iter(text)), np.int64)
        else:
            flat = np.zeros(0, np.int64)
        ends, entry = flat[0::2], flat[1::2]
        starts = ends - self._chars[entry]
        before, behind = np.concatenate([[0], ends]), np.append(starts, len(text))
        place, crc, length = [], [], []
        for gap in np.flatnonzero(behind - before > 1).tolist():
            for w in text[before[gap] + 1 : behind[gap] - 1].split(" "):
                held = self._new.get(w)
                if held is None:
                    raw = w.encode()
                    held = (zlib.crc32(raw), len(raw))
                    if len(self._new) < ENTRIES:
                        self._new[w] = held
                place.append(gap)
                crc.append(held[0])
                length.append(held[1])
        place = np.array(place, np.int64)
        out = np.insert(self._crc[entry], place, np.array(crc, np.uint32)), np.insert(self._bytes[entry], place, np.array(length, np.int64))
        if len(self._new) > max(2000, len(self._crc) // 2) and len(self._crc) < ENTRIES:
            self._learn()
        return out


def _windows(data: bytes, offs: np.ndarray) -> Iterator[list[tuple[int, bytes]]]:
    """(number of the text, its words or a part of them, one space between them) of about WINDOW_BYTES together; texts are cut between words only."""
    out, size = [], 0
    for t, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
        while True:
            cut = b
            if b - a > WINDOW_BYTES:
                part = data[a : a + WINDOW_BYTES].translate(_CLEAN)
                cut = a + part.rfind(b" ") + 1
                while cut == a and a + len(part) < b:  # one word that is longer than a window
                    part = data[a : min(b, a + 2 * len(part))].translate(_CLEAN)
                    cut = a + part.find(b" ") + 1
                cut = b if cut == a else cut
            out.append((t, b" ".join(data[a:cut].translate(_CLEAN).split())))
            size += cut - a
            if size >= WINDOW_BYTES:
                yield out
                out, size = [], 0
            a = cut
            if a >= b:
                break
    if out:
        yield out


def features(dictionary: Dictionary, data: np.ndarray, offs: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text of each feature, its CRC, words of each text) of window after window: all runs of 1 to ``longest`` words."""
    last = np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64)  # the words that further runs may begin with
    raw = data.tobytes()
    for window in _windows(raw, offs):
        words = [w.count(b" ") + 1 if w else 0 for _, w in window]
        text = np.repeat(np.array([t for t, _ in window]), words)
        body = b" ".join(w for _, w in window if w)
        crc, size = dictionary.scan(f" {body.decode()} ") if body else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        old = len(last[0])
        text, crc, size = np.concatenate([last[0], text]), np.concatenate([last[1], crc]), np.concatenate([last[2], size])
        texts, crcs = [text[old:]], [crc[old:]]
        run, length = crc, size
        space, one = np.uint32(zlib.crc32(b" ")), 1
        for k in range(2, longest + 1):
            n = max(0, len(crc) - k + 1)
            run, length = composed(run[:n], length[:n], np.full(n, space), np.full(n, one))
            run, length = composed(run, length, crc[k - 1 :][:n], size[k - 1 :][:n])
            new = (text[:n] == text[k - 1 :][:n]) & (np.arange(n) + k > old)
            texts.append(text[:n][new])
            crcs.append(run[new])
        keep = max(0, len(crc) - (longest - 1))
        last = text[keep:], crc[keep:], size[keep:]
        yield np.concatenate(texts), np.concatenate(crcs), np.bincount(text[old:], minlength=len(offs) - 1)


_own: list[Dictionary] = []


def _dictionary() -> Dictionary:
    if not _own:
        _own.append(Dictionary())
    return _own[0]


def _counter(longest: int, buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc, _ in features(_dictionary(), *text_buffer(batch.column("_text")), longest):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return count


def _scorer(gains, longest: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gains.value
        for batch in batches:
            data, offs = text_buffer(batch.column("_text"))
            n, words, weight = (np.zeros(len(offs) - 1, np.int64) for _ in range(3))
            for text, crc, own in features(_dictionary(), data, offs, longest):
                words += own
                n += np.bincount(text, minlength=len(n))
                np.add.at(weight, text, gain[crc % np.uint32(len(gain))])
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(n), pa.array(words), pa.array(weight)], names=["_id", "n_features", "n_words", "weight"])

    return score


def bucket_counts(texts: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """bucket, n: features of all texts; each task adds up its own first, so that a bucket is one row of a task at most."""
    own = texts.select(F.col(f"`{text_col}`").alias("_text")).mapInArrow(_counter(longest, buckets), "bucket long, n long")
    return own.groupBy("bucket").agg(F.sum("n").alias("n"))


def gumbel(id_col: Column, seed: int) -> Column:
    """The noise of a draw: floor(-1000 ln(-ln(u))), u from the first eight hex digits of sha256("seed:id")."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def importance(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", longest: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: int = 2024
) -> DataFrame:
    """id, n_features, weight, score, rank of each document; the drawn ones, without replacement, have a rank.

    Texts are lower-cased in A-Z; words are runs of ASCII letters, digits and characters beyond ASCII; features
    are all runs of 1 to ``longest`` words, one space between them, repeats included, in ``buckets`` by CRC-32. A bucket's gain is
    floor(1000 ln of its smoothed share in ``target`` over that in ``docs``), weight the sum of gains over a document's
    features, score the weight and Gumbel noise. Of the documents with at least ``least_words`` words ``percent`` of a
    hundred are drawn, the highest scores first, then the smaller ids.

    Null and empty texts have no feature and weight 0; a null id counts as the text "" for the noise and comes first among
    equal scores; repeated rows are documents of their own; with an empty target, or no features at all, the
    smoothing alone decides; an empty table gives an empty one. Other columns, whatever their names, play no part. A text of
    any length is worked through in windows of 1 MiB, cut between words; only a single word is never cut.

    The corpus is scanned twice, for the counts and for the scores; what goes to the driver and to all
    tasks is one number for each bucket. Dictionaries are the tasks' own and bounded; they change no result.
    """
    asked = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    s = bucket_counts(asked, "_text", longest, buckets).withColumnRenamed("n", "s")
    t = bucket_counts(target, target_text, longest, buckets).withColumnRenamed("n", "t")
    every = docs.sparkSession.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0, ["s", "t"]).collect()
    own, aim = (np.zeros(buckets) for _ in range(2))
    for r in every:
        own[r["bucket"]], aim[r["bucket"]] = r["s"], r["t"]
    gain = np.floor(1000 * np.log((aim + 1) * (own.sum() + buckets) / ((own + 1) * (aim.sum() + buckets)))).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kind = asked.schema["_id"].dataType.simpleString()
    found = asked.mapInArrow(_scorer(shared, longest), f"_id {kind}, n_features long, n_words long, weight long")
    found = stored(found.withColumn("score", F.col("weight") + gumbel(F.col("_id"), seed)).withColumn("_in", F.col("n_words") >= least_words))
    most = found.filter("_in").count() * percent // 100
    placed = running(found, [F.desc("_in"), F.desc("score"), F.asc("_id")], _before=F.lit(1))
    return placed.select(F.col("_id").alias(id_col), "n_features", "weight", "score", F.when(F.col("_in") & (F.col("_before") < most), F.col("_before").cast("long") + 1).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **options: object) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, unchanged; otherwise as ``importance``."""
    drawn = importance(docs, target, id_col, **options).filter("rank IS NOT NULL").select(F.col(f"`{id_col}`").alias("_drawn")).distinct()
    return docs.join(drawn, F.col(f"`{id_col}`").eqNullSafe(F.col("_drawn")), "left_semi").select(columns_of(docs))
