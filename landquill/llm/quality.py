"""Quality classifier: a generalised additive model with pairwise terms (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landquill.llm.common import remainder
from landquill.llm.textbytes import LOWER, NOT_SPACE, prefix_sums, range_hash, segment_sums, text_blocks, word_bounds

#: Labelled rows that the model is fitted on, about; the ones with the
#: smallest hashes of their id.
SAMPLE = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 120
PAIR_ROUNDS = 40
RATE = 0.15
LEAVES = 4

FEATURES = (
    "log_bytes", "log_words", "word_length", "word_spread", "upper", "digit", "stop", "comma", "shout", "symbol", "bar", "beyond_ascii", "line_length", "lines",
    "distinct_words", "same_as_before", "distinct_pairs", "ends_marked", "capitalised", "longest_word", "one_letter", "top_byte",
)
_UPPER, _DIGIT, _STOP, _COMMA, _SHOUT, _SYMBOL, _BAR, _BEYOND, _LINE = range(9)


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, 15, np.uint8)
    kinds[0x41:0x5B], kinds[0x30:0x3A], kinds[0x80:], kinds[0x0A] = _UPPER, _DIGIT, _BEYOND, _LINE
    for kind, chars in ((_STOP, b"."), (_COMMA, b",;:"), (_SHOUT, b"!?"), (_SYMBOL, b"#$%&*+<=>@\\^_`~/{}[]()"), (_BAR, b"|")):
        kinds[list(chars)] = kind
    return kinds


_CLASSES = _byte_classes()


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many different hashes each text has."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return segment_sums(new, first)


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text; all zero for texts without words."""
    n = len(offs) - 1
    out = np.zeros((n, len(FEATURES)))
    starts, ends, first = word_bounds(data, offs, NOT_SPACE)
    size, words = np.diff(offs), np.diff(first)
    some = np.maximum(size, 1)
    out[:, 0], out[:, 1] = np.log1p(size), np.log1p(words)
    kinds = _CLASSES[data]
    for column, kind in ((4, _UPPER), (5, _DIGIT), (6, _STOP), (7, _COMMA), (8, _SHOUT), (9, _SYMBOL), (10, _BAR), (11, _BEYOND), (13, _LINE)):
        out[:, column] = segment_sums(kinds == kind, offs) / some
    out[:, 12] = np.log1p(size / (1 + segment_sums(kinds == _LINE, offs)))
    if not len(starts):
        return out
    every = np.maximum(words, 1)
    length = ends - starts
    mean = segment_sums(length, first) / every
    out[:, 2] = mean
    out[:, 3] = np.sqrt(np.maximum(0, segment_sums(length**2, first) / every - mean**2))
    hashes = range_hash(prefix_sums(LOWER[data]), starts, ends)
    text = np.repeat(np.arange(n), words)
    out[:, 14] = _distinct(hashes, first) / every
    follows = np.zeros(len(hashes), bool)
    follows[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    out[:, 15] = segment_sums(follows, first) / every
    pair = hashes.copy()
    pair[1:] += np.where(text[1:] == text[:-1], hashes[:-1] * np.uint64(0x9E3779B97F4A7C15), np.uint64(0))
    out[:, 16] = _distinct(pair, first) / every
    out[:, 17] = segment_sums(np.isin(kinds[ends - 1], (_STOP, _COMMA, _SHOUT)), first) / every
    out[:, 18] = segment_sums(kinds[starts] == _UPPER, first) / every
    full = np.flatnonzero(words)
    out[full, 19] = np.log1p(np.maximum.reduceat(length, first[:-1][full]))
    out[:, 20] = segment_sums(length == 1, first) / every
    top = np.zeros(n)
    for byte in b"etaoinrs":
        top = np.maximum(top, segment_sums(data == byte, offs))
    out[:, 21] = top / some
    return out


@dataclass
class AdditiveModel:
    """Lookup tables: one for each feature's bins, and one for each chosen pair's coarse bins."""

    bias: float
    cuts: list[np.ndarray]
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for j, cuts in enumerate(self.cuts):
            out += self.tables[j][np.searchsorted(cuts, x[:, j], "right")]
        coarse = {j: np.searchsorted(self.pair_cuts[j], x[:, j], "right") for p in self.pairs for j in p}
        for k, (i, j) in enumerate(self.pairs):
            out += self.pair_tables[k][coarse[i], coarse[j]]
        return out


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Inner bounds of bins with about equally many values."""
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Step values over ordered bins: the best cut of any leaf, until there are ``leaves``."""
    parts, n = [(0, len(g))], len(g)
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for a, b in parts:
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            gain = _gain(cg[m] - cg[a], ch[m] - ch[a]) + _gain(cg[b] - cg[m], ch[b] - ch[m]) - _gain(cg[b] - cg[a], ch[b] - ch[a])
            if gain.max() > best[0]:
                best = (gain.max(), (a, b), int(m[gain.argmax()]))
        if best[1] is None:
            break
        (a, b), m = best[1], best[2]
        parts.remove((a, b))
        parts += [(a, m), (m, b)]
    out = np.zeros(n)
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both axes of a table: gain, and the values of the four parts."""
    cg, ch = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0))), np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    best = (0.0, np.zeros_like(g))
    for a in range(1, g.shape[0]):
        for b in range(1, g.shape[1]):
            rows, cols = ((0, a), (a, g.shape[0])), ((0, b), (b, g.shape[1]))
            cut = [(r, c, cg[r[1], c[1]] - cg[r[0], c[1]] - cg[r[1], c[0]] + cg[r[0], c[0]], ch[r[1], c[1]] - ch[r[0], c[1]] - ch[r[1], c[0]] + ch[r[0], c[0]]) for r in rows for c in cols]
            gain = sum(u * u / (v + 1.0) for _, _, u, v in cut)
            if gain > best[0]:
                value = np.zeros_like(g)
                for r, c, u, v in cut:
                    value[r[0] : r[1], c[0] : c[1]] = u / (v + 1.0)
                best = (gain, value)
    return best


def fit_additive(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS, pair_rounds: int = PAIR_ROUNDS) -> AdditiveModel:
    """Boost one shallow tree for each feature in turn, again and again; then the strongest pairs.

    All features get the same small steps, so that correlated ones share an
    effect. Pairs are ranked by what a four-part table gains on the residuals.
    """
    mean = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
    bias = float(np.log(mean / (1 - mean)))
    d = x.shape[1]
    cuts = [_cuts(x[:, j], BINS) for j in range(d)]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    tables = np.zeros((d, BINS + 1))
    logit = np.full(len(y), bias)
    for _ in range(rounds):
        for j in range(d):
            p = 1 / (1 + np.exp(-logit))
            k = len(cuts[j]) + 1
            step = RATE * _shallow_tree(np.bincount(bins[j], y - p, k), np.bincount(bins[j], p * (1 - p), k), LEAVES)
            tables[j, :k] += step
            logit += step[bins[j]]
    pair_cuts = [_cuts(x[:, j], PAIR_BINS) for j in range(d)]
    coarse = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(pair_cuts)]

    def sums(i: int, j: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cell = coarse[i] * (PAIR_BINS + 1) + coarse[j]
        n = (PAIR_BINS + 1) ** 2
        shape = (PAIR_BINS + 1, PAIR_BINS + 1)
        return cell, np.bincount(cell, y - p, n).reshape(shape), np.bincount(cell, p * (1 - p), n).reshape(shape)

    p = 1 / (1 + np.exp(-logit))
    ranked = sorted(((_quadrants(*sums(i, j, p)[1:])[0], i, j) for i in range(d) for j in range(i + 1, d)), reverse=True)
    chosen = [(i, j) for gain, i, j in ranked[:pairs] if gain > 0]
    pair_tables = np.zeros((len(chosen), PAIR_BINS + 1, PAIR_BINS + 1))
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(chosen):
            p = 1 / (1 + np.exp(-logit))
            cell, g, h = sums(i, j, p)
            step = RATE * _quadrants(g, h)[1]
            pair_tables[k] += step
            logit += step.ravel()[cell]
    return AdditiveModel(bias, cuts, tables, chosen, pair_cuts, pair_tables)


def _described(rows: DataFrame, keep: list[str], kind: str) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [features(data, offs) for _, data, offs in text_blocks(batch, "_text")]
            x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            column = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), column], names=[*keep, "x"])

    return rows.mapInArrow(scan, f"{kind}, x array<double>")


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held: int, sample: int) -> AdditiveModel | None:
    """The model of about ``sample`` labelled rows outside the held-out fold; None without both labels."""
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).filter("_id IS NOT NULL AND label IN (0, 1)").distinct()
    known = known.filter(remainder(F.col("_id"), folds) != held)
    total = known.count()
    if total > sample:  # a hash decides; the count of those taken is close to the bound
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int((1 << 20) * sample / total))
    chosen = texts.join(F.broadcast(known), "_id").select("label", "_id", "_text")
    kind = texts.schema["_id"].dataType.simpleString()
    rows = _described(chosen, ["_id", "label"], f"_id {kind}, label int").toPandas()
    if rows.empty or rows["label"].nunique() < 2:
        return None
    rows = rows.sort_values(["_id", "label"], kind="stable")
    return fit_additive(np.stack(rows["x"].to_numpy()), rows["label"].to_numpy(float))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 4, held: int = 2, sample: int = SAMPLE, threshold: float = 0.7) -> DataFrame:
    """A quality score for every text: id, held_out, score, predicted (1 if the score is ``threshold`` or more).

    The model sees features of the text alone and learns from labelled rows
    outside the held-out fold (crc32 of the id modulo ``folds`` is ``held``),
    about ``sample`` at most. Scoring adds up the entries of the lookup tables
    at the text's bins. Null and empty texts have the features of an empty
    text. Null ids or labels in ``labels`` are no samples; an id with both
    labels counts for each. Without samples of both labels every score is 0.5.
    Other columns, whatever their names, play no part; an empty table gives an empty one.
    A text is worked through as a whole, with some tens of bytes of arrays for each of its bytes.
    """
    scored = _scored(docs, labels, id_col, text_col, label_col, folds, held, sample, [id_col])
    return scored.select(F.col("_keep0").alias(id_col), (remainder(F.col("_keep0"), folds) == held).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 4, held: int = 2, sample: int = SAMPLE, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score is ``threshold`` or more, unchanged; otherwise as ``quality``."""
    scored = _scored(docs, labels, id_col, text_col, label_col, folds, held, sample, docs.columns)
    return scored.filter(F.col("score") >= threshold).select(*[F.col(f"_keep{k}").alias(c) for k, c in enumerate(docs.columns)])


def _scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, folds: int, held: int, sample: int, keep: list[str]) -> DataFrame:
    """The columns ``keep`` as _keep0 and so on, and score."""
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, id_col, text_col, label_col, folds, held, sample))
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_keep{k}") for k, c in enumerate(keep)], F.col(text_col).alias("_text"))
    kept = [f"_keep{k}" for k in range(len(keep))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        for batch in batches:
            parts = [own.logit(features(data, offs)) if own else np.zeros(len(offs) - 1) for _, data, offs in text_blocks(batch, "_text")]
            logit = np.concatenate(parts) if parts else np.zeros(0)
            score = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(score)], names=[*kept, "score"])

    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in kept)
    return rows.mapInArrow(scan, f"{kinds}, score double")
