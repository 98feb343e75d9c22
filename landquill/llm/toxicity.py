"""Toxicity by Levenshtein automata over a lexicon trie (operator 2)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landquill.llm.common import checkpointed, remainder
from landquill.llm.textbytes import ALNUM, LOWER, segment_sums, text_blocks, word_bounds

#: Labelled rows that the lexicon and the weights are fitted on, about; the
#: ones with the smallest hashes of their id.
SAMPLE = 20_000
#: Stems are the first characters of words, from and to so many.
STEM = (4, 10)
#: Bytes from which on a term may hold one error.
FUZZY_FROM = 5
#: Words to each side of a hit that make its context.
WINDOW = 8
QUOTES = np.zeros(256, dtype=bool)
QUOTES[[0x22, 0x27, 0xAB, 0xBB, 0x9C, 0x9D, 0x9E]] = True  # ", ', and last bytes of « » “ ” „
FEATURES = ("exact", "fuzzy", "quoted", "crowded", "kinds", "share", "any")


def folded(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and for the capitals of Latin-1."""
    low = LOWER[data].copy()
    if len(low) > 1:
        capital = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
        low[1:][capital] += 0x20
    return low


@dataclass
class Automaton:
    """Deterministic automaton that accepts words which start with a term, or are a term with one error.

    It is the intersection of the trie of terms with the Levenshtein automaton
    of each: a state is a set of (trie node, errors so far). kind[byte] is a
    byte's column in the table, 0 for those in no term; table[state, kind] is
    the next state, 0 is dead. exact[state] is the term just read without
    error, whatever follows, and near[state] the first term that the word is
    within one error of if it ends here, or -1.
    """

    kind: np.ndarray
    table: np.ndarray
    exact: np.ndarray
    near: np.ndarray
    terms: list[bytes]


def build_automaton(terms: list[bytes], fuzzy_from: int = FUZZY_FROM, first_right: bool = True) -> Automaton:
    """With ``first_right`` the error can't be in a term's first letter."""
    trie: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    deepest: list[int] = [0]  # longest term through each node
    for number, term in enumerate(terms):
        node = 0
        deepest[0] = max(deepest[0], len(term))
        for byte in term:
            if byte not in trie[node]:
                trie[node][byte] = len(trie)
                trie.append({})
                deepest.append(0)
            node = trie[node][byte]
            deepest[node] = max(deepest[node], len(term))
        ends[node] = number

    def closed(states: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        """With what a letter left out of the word leads to; states that an exact one covers go."""
        todo, seen = list(states), set(states)
        while todo:
            node, errors = todo.pop()
            if errors == 0 and (node or not first_right):
                for child in trie[node].values():
                    if deepest[child] >= fuzzy_from and (child, 1) not in seen:
                        seen.add((child, 1))
                        todo.append((child, 1))
        return frozenset(s for s in seen if s[1] == 0 or (s[0], 0) not in seen)

    def step(states: frozenset[tuple[int, int]], byte: int) -> frozenset[tuple[int, int]]:
        out: set[tuple[int, int]] = set()
        for node, errors in states:
            child = trie[node].get(byte)
            if child is not None:
                out.add((child, errors))
            if errors == 0 and (node or not first_right):
                if deepest[node] >= fuzzy_from:
                    out.add((node, 1))
                out.update((c, 1) for b, c in trie[node].items() if b != byte and deepest[c] >= fuzzy_from)
        return closed(out)

    def reached(states: frozenset[tuple[int, int]], errors: int, least: int) -> int:
        return min((ends[n] for n, e in states if e == errors and n in ends and len(terms[ends[n]]) >= least), default=-1)

    used = sorted({b for t in terms for b in t})
    kind = np.zeros(256, np.int32)
    kind[used] = np.arange(1, len(used) + 1)
    start = closed({(0, 0)})
    names: dict[frozenset, int] = {frozenset(): 0, start: 1}
    order = [frozenset(), start]
    rows = [np.zeros(len(used) + 1, np.int32)]
    k = 1
    while k < len(order):
        other = step(order[k], -1)
        # Bytes that no node of the state goes on with all lead to the same.
        targets = {b: step(order[k], b) for b in sorted({b for n, _ in order[k] for b in trie[n]})}
        for t in (other, *targets.values()):
            if t not in names:
                names[t] = len(order)
                order.append(t)
        row = np.full(len(used) + 1, names[other], np.int32)
        for b, t in targets.items():
            row[kind[b]] = names[t]
        rows.append(row)
        k += 1
    exact, near = (np.array([reached(s, e, least) for s in order], np.int32) for e, least in ((0, 0), (1, fuzzy_from)))
    return Automaton(kind, np.stack(rows), exact, near, terms)


def match_words(auto: Automaton, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word index, term times 2 plus errors) of the words that the automaton accepts; an exact match wins over one with an error."""
    alive, state = np.arange(len(starts)), np.ones(len(starts), np.int32)
    best = np.full(len(starts), -1, np.int32)
    kinds = auto.kind[low]
    k = 0
    while len(alive):
        state = auto.table[state, kinds[starts[alive] + k]]
        k += 1
        got = auto.exact[state]
        hit = got >= 0
        best[alive[hit]] = got[hit] * 2
        got = auto.near[state]
        near = ~hit & (got >= 0) & (starts[alive] + k == ends[alive])
        best[alive[near]] = got[near] * 2 + 1
        go = (state > 0) & ~hit & (starts[alive] + k < ends[alive])
        alive, state = alive[go], state[go]
    found = np.flatnonzero(best >= 0)
    return found, best[found]


def features(auto: Automaton, weights: np.ndarray, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text.

    Each hit has its term's weight. Its context is WINDOW words to each side:
    with quote marks on both sides there it counts as quoted; with other hits
    there as crowded, which speaks for abuse.
    """
    low = folded(data)
    starts, ends, first = word_bounds(low, offs, ALNUM)
    at, value = match_words(auto, low, starts, ends)
    out = np.zeros((len(offs) - 1, len(FEATURES)))
    if not len(at):
        return out
    text = np.searchsorted(first, at, "right") - 1
    bounds = np.searchsorted(at, first)
    w = weights[value // 2]
    quotes = np.concatenate([[0], np.cumsum(QUOTES[data])])
    left = np.maximum(at - WINDOW, first[text])
    right = np.minimum(at + WINDOW, first[text + 1] - 1)
    before = quotes[starts[at]] - quotes[starts[left]]
    after = quotes[ends[right]] - quotes[ends[at]]
    quoted = (before > 0) & (after > 0)
    crowd = np.searchsorted(at, right, "right") - np.searchsorted(at, left, "left") - 1
    n_words = np.maximum(1, np.diff(first))
    out[:, 0] = np.log1p(segment_sums(w * (value % 2 == 0) * ~quoted, bounds))
    out[:, 1] = np.log1p(segment_sums(w * (value % 2 == 1) * ~quoted, bounds))
    out[:, 2] = np.log1p(segment_sums(w * quoted, bounds))
    out[:, 3] = np.log1p(segment_sums(np.minimum(crowd, 4) * ~quoted, bounds))
    pairs = np.unique(text.astype(np.int64) * (2 * len(auto.terms)) + value)
    out[:, 4] = np.log1p(np.bincount(pairs // (2 * len(auto.terms)), minlength=len(out)))
    out[:, 5] = np.sqrt(np.diff(bounds) / n_words)
    out[:, 6] = segment_sums((value % 2 == 0) & ~quoted, bounds) > 0
    return out


def _prefixes(data: np.ndarray, offs: np.ndarray) -> Iterator[set[bytes]]:
    """For each text the stems of its words: cut between characters, and whole words of STEM's lengths."""
    low = folded(data)
    starts, ends, first = word_bounds(low, offs, ALNUM)
    body = low.tobytes()
    for t in range(len(offs) - 1):
        words = {body[a:b] for a, b in zip(starts[first[t] : first[t + 1]].tolist(), ends[first[t] : first[t + 1]].tolist())}
        out = set()
        for word in {w.decode() for w in words if len(w) >= STEM[0]}:
            out.update(word[:k].encode() for k in range(STEM[0], min(len(word), STEM[1]) + 1))
        yield out


def _stem_counts(rows: DataFrame, among: frozenset[bytes] | None = None) -> DataFrame:
    """stem, n: in how many texts (of ``among`` only, if given) each stem occurs."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[bytes] = Counter()
            for _, data, offs in text_blocks(batch, "_text"):
                for stems in _prefixes(data, offs):
                    counts.update(stems if among is None else stems & among)
            yield pa.RecordBatch.from_arrays([pa.array([s.decode() for s in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["stem", "n"])

    return rows.select("_text").mapInArrow(scan, "stem string, n bigint").groupBy("stem").agg(F.sum("n").alias("n"))


def mine_lexicon(sample: DataFrame, least_share: float = 0.005) -> list[tuple[bytes, float]]:
    """Stems with weights (log odds) that texts labelled 1 hold and others hardly do.

    sample: _text, label; a bounded sample, so its stems are bounded too. Of
    a stem and its extensions the shortest one that is precise enough is kept,
    drawn out to the longest that nearly as many texts hold.
    """
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = n.get(1, 0), n.get(0, 0)
    least = max(3, int(least_share * bad))
    toxic = {r["stem"].encode(): r["n"] for r in _stem_counts(sample.filter("label = 1")).filter(F.col("n") >= least).collect()}
    if not toxic:
        return []
    clean = {r["stem"].encode(): r["n"] for r in _stem_counts(sample.filter("label = 0"), frozenset(toxic)).collect()}
    odds = lambda s: float(np.log((toxic[s] + 0.5) / (bad + 1.0)) - np.log((clean.get(s, 0) + 0.5) / (good + 1.0)))
    precise = {s for s in toxic if odds(s) >= 2.5 and clean.get(s, 0) <= 0.1 * toxic[s]}
    shortest = [s for s in precise if not any(s[:k] in precise for k in range(STEM[0], len(s)))]
    longer = {s: max((t for t in precise if t.startswith(s) and toxic[t] >= 0.95 * toxic[s]), key=len) for s in shortest}
    kept = sorted(set(longer.values()))
    kept.sort(key=lambda s: (-odds(s) * np.sqrt(toxic[s]), s))
    return [(s, odds(s)) for s in kept]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights and bias of a ridge logistic regression by Newton's method."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-3])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _feature_rows(rows: DataFrame, keep: list[str], auto: Automaton, weights: np.ndarray, schema: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast((auto, weights))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = shared.value
        for batch in batches:
            parts = [features(own, w, data, offs) for _, data, offs in text_blocks(batch, "_text")]
            x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            column = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), column], names=[*keep, "x"])

    return rows.select(*keep, "_text").mapInArrow(scan, f"{schema}, x array<double>")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, held: int = 0, sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """A toxicity score for every text.

    The lexicon of stems and the weights of hits and contexts are learnt from
    labelled rows outside the held-out fold (crc32 of the id modulo ``folds``
    is ``held``), about ``sample`` of them at most. Every text is scanned in
    whole. Returns id, held_out, score (0 to 1), predicted, hits (share of hit
    words, square root). Null and empty texts have no hits and get the score
    of a text without hits. Null ids or labels in ``labels`` are no samples;
    an id that has both labels counts for each. Without samples of both labels
    every score is 0.
    Other columns, whatever their names, play no part; an empty table gives an empty one.
    A text is worked through as a whole, with some tens of bytes of arrays for each of its bytes.
    """
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).filter("_id IS NOT NULL AND label IN (0, 1)").distinct()
    known = known.filter(remainder(F.col("_id"), folds) != held)
    total = known.count()
    if total > sample:  # a hash decides; the count of those taken is close to the bound
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int((1 << 20) * sample / total))
    chosen = checkpointed(texts.join(F.broadcast(known), "_id").select("_text", "label"))
    lexicon = mine_lexicon(chosen)
    kind = texts.schema["_id"].dataType.simpleString()
    if lexicon:
        auto, weights = build_automaton([s for s, _ in lexicon], first_right=False), np.array([w for _, w in lexicon])
        fitted = _feature_rows(chosen, ["label"], auto, weights, "label int").toPandas()
        x = np.stack(fitted["x"].to_numpy())
        model = fit_logistic(x, fitted["label"].to_numpy(float))
    else:
        auto, weights, model = build_automaton([b"\x00"]), np.zeros(1), np.array([0.0] * len(FEATURES) + [-30.0])
    scored = _feature_rows(texts, ["_id"], auto, weights, f"_id {kind}")
    terms = [F.element_at("x", k + 1) * float(w) for k, w in enumerate(model[:-1])]
    logit = sum(terms, F.lit(float(model[-1])))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    out = scored.select(F.col("_id").alias(id_col), (remainder(F.col("_id"), folds) == held).alias("held_out"), score.alias("score"), F.element_at("x", FEATURES.index("share") + 1).alias("hits"))
    return out.select(id_col, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "hits")
