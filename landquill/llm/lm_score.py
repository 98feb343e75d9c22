"""Language-model scores by a probabilistic suffix tree (operator 10).

The tree's symbols are the bytes of a text whose words are joined by one
space; the end of a text is a symbol of its own (a line feed, which the joined
text can't hold). A state is a context of up to DEPTH bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landquill.llm.common import checkpointed, remainder
from landquill.llm.textbytes import LOWER, NOT_SPACE, lookup, mix, prefix_sums, range_hash, ranges, segment_sums, text_blocks, word_bounds

DEPTH = 5
END = 0x0A
#: Contexts of up to so many bytes are few whatever the corpus and are shared;
#: longer ones are dealt out by their last SHORT + 1 bytes.
SHORT = 2
#: Different grams that a task fits at once, about.
DEALT = 1 << 17
#: Occurrences that a state needs at least.
LEAST = 4
#: A context is retained if its next symbols diverge from those of its parent
#: by so many nats for each occurrence and in all.
DIVERGENCE, EVIDENCE = 0.01, 12.0
#: Words whose counts are broadcast at most: the most frequent ones.
HEAD_WORDS = 1 << 19
#: The same for grams with their probabilities.
HEAD_GRAMS = 1 << 20
#: Counts that a task gathers before it passes them on.
HELD = 1 << 20
_END_HASH = _END_SIGNED = 0x0E0D0E0D0E0D0E0D


#: What stands before the first symbol of a text.
_LEAD = np.array([0] * (DEPTH - 1) + [END], np.uint8)


def joined_texts(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(packed grams of all texts on end, offsets of the texts there, hashes of the words, offsets of the words by text).

    A gram is a symbol with the DEPTH symbols before it; a text is preceded by
    zeros and one end.
    """
    low = LOWER[data]
    starts, ends, first = word_bounds(low, offs, NOT_SPACE)
    lengths, words = ends - starts, np.diff(first)
    size = np.where(words > 0, segment_sums(lengths, first) + words, 1)  # spaces between words, and the end
    place = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=place[1:])
    lead = DEPTH * np.arange(1, len(size) + 1)
    out = np.full(int(place[-1]) + DEPTH * len(size) + 8, 0x20, np.uint8)
    text = np.repeat(np.arange(len(words)), words)
    before = np.cumsum(lengths + 1) - (lengths + 1)
    if len(starts):
        at = before - before[np.minimum(first[:-1], len(before) - 1)][text] + (place[:-1] + lead)[text]
        out[ranges(at, lengths)] = low[ranges(starts, lengths)]
    out[place[1:] + lead - 1] = END
    for k in range(DEPTH):
        out[place[:-1] + lead - DEPTH + k] = _LEAD[k]
    # Eight bytes from every byte on, as one number; of those that end at a symbol the last DEPTH + 1 are its gram.
    every = np.ndarray(shape=(len(out) - 7,), dtype=">u8", buffer=out, strides=(1,))
    start = ranges(place[:-1] + lead, size) - DEPTH
    grams = every[start].astype(np.uint64) >> np.uint64(8 * (7 - DEPTH))
    hashes = range_hash(prefix_sums(low), starts, ends) if len(starts) else np.zeros(0, np.uint64)
    return grams, place, hashes, first


class _Tally:
    """Counts of 64-bit keys, added up until there are HELD of them."""

    def __init__(self) -> None:
        self.parts: list[pd.Series] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> None:
        counts = pd.Series(keys).value_counts(sort=False)
        self.parts.append(counts)
        self.size += len(counts)
        if self.size > HELD:
            self.merge()

    def merge(self) -> None:
        if len(self.parts) > 1:
            both = pd.concat(self.parts)
            self.parts = [both.groupby(level=0, sort=False).sum()]
        self.size = sum(map(len, self.parts))

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        one = self.parts[0] if self.parts else pd.Series([], dtype="int64", index=pd.Index([], dtype="uint64"))
        self.parts, self.size = [], 0
        return one.index.to_numpy().astype(np.uint64), one.to_numpy().astype(np.int64)


def corpus_counts(texts: DataFrame) -> DataFrame:
    """kind (0 for words, 1 for grams), key, n over all rows of ``_text`` that aren't ``_held``, m over all rows.

    Held-out texts add no words.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies = {0: _Tally(), 1: _Tally(), 2: _Tally()}  # 2: grams of held-out texts

        def out(kind: int) -> Iterator[pa.RecordBatch]:
            keys, n = tallies[kind].taken()
            for i in range(0, len(keys), 1 << 16):
                k = keys[i : i + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int8)), pa.array(k), pa.array(n[i : i + (1 << 16)])], names=["kind", "key", "n"])

        for batch in batches:
            held = batch.column("_held").to_numpy(zero_copy_only=False).astype(bool)
            for rows, data, offs in text_blocks(batch, "_text"):
                grams, place, words, first = joined_texts(data, offs)
                apart = held[rows]
                of_gram = np.repeat(apart, np.diff(place))
                ends = np.full(int((~apart).sum()), _END_HASH, np.uint64)
                tallies[0].add(np.concatenate([words[~np.repeat(apart, np.diff(first))], ends]))
                tallies[1].add(grams[~of_gram])
                tallies[2].add(grams[of_gram])
                for kind, tally in tallies.items():
                    if tally.size > HELD:
                        yield from out(kind)
        for kind in tallies:
            yield from out(kind)

    found = texts.mapInArrow(scan, "kind tinyint, key bigint, n bigint").withColumn("learnt", F.when(F.col("kind") < 2, F.col("n")).otherwise(0))
    found = found.withColumn("kind", F.least("kind", F.lit(1).cast("tinyint")))
    return found.groupBy("kind", "key").agg(F.sum("learnt").alias("n"), F.sum("n").alias("m"))


@dataclass
class SuffixTree:
    """States by depth: sorted contexts with the log factor of what they don't list, and their listed symbols.

    entries[d] are sorted keys of context and symbol with log10 probabilities.
    """

    contexts: list[np.ndarray]
    rest: list[np.ndarray]
    entries: list[np.ndarray]
    logp: list[np.ndarray]

    def slow(self, g: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last symbol in the longest state that ends its context."""
        out = np.zeros(len(g))
        entered = np.zeros(len(g), bool)
        done = np.zeros(len(g), bool)
        for d in range(DEPTH, -1, -1):
            todo = np.flatnonzero(~done)
            key = g[todo] & np.uint64((1 << (8 * (d + 1))) - 1)
            at, is_state = lookup(self.contexts[d], key >> np.uint64(8))
            entered[todo] |= is_state  # below the longest state all suffixes are states
            here = entered[todo] & is_state
            todo, key, at = todo[here], key[here], at[here]
            e, listed = lookup(self.entries[d], key)
            out[todo[listed]] += self.logp[d][e[listed]]
            done[todo[listed]] = True
            out[todo[~listed]] += self.rest[d][at[~listed]]
        return out

    def score(self, g: np.ndarray) -> np.ndarray:
        code, different = pd.factorize(g)
        return self.slow(different)[code]


class FrequentGrams:
    """log10 probabilities of the frequent grams: a gram is in its slot, or among the sorted keys, or not frequent."""

    def __init__(self, keys: np.ndarray, logp: np.ndarray, n: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.logp = keys[order], logp[order]
        slots = 1 << max(10, int(2 * len(keys)).bit_length())
        self.at = np.full(slots, -1, np.int32)
        often = np.argsort(n[order], kind="stable")  # the most frequent come last and keep their slots
        self.at[mix(self.keys[often]) & np.uint64(slots - 1)] = often

    def find(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability or 0, found) of each gram."""
        if not len(self.keys):
            return np.zeros(len(g)), np.zeros(len(g), bool)
        at = self.at[mix(g) & np.uint64(len(self.at) - 1)]
        found = (at >= 0) & (self.keys[at] == g)
        rest = np.flatnonzero(~found)
        at[rest], found[rest] = lookup(self.keys, g[rest])
        return np.where(found, self.logp[at], 0.0), found


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys and the sums of their counts."""
    different, at = np.unique(keys, return_inverse=True)
    return different, np.bincount(at, n, len(different))


def _by_depth(keys: np.ndarray, n: np.ndarray, least: int, most: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[tuple[np.ndarray, np.ndarray]]]:
    """(grams, contexts with LEAST occurrences), sorted and with their counts, for each depth from ``least`` to ``most``."""
    own, ctx = [], []
    for d in range(most, least - 1, -1):
        keys, n = _summed(keys & np.uint64((1 << (8 * (d + 1))) - 1), n)
        key, total = _summed(keys >> np.uint64(8), n)
        own.append((keys, n))
        ctx.append((key[total >= LEAST], total[total >= LEAST]))
    return own[::-1], ctx[::-1]


def grow_tree(own: list[tuple[np.ndarray, np.ndarray]], ctx: list[tuple[np.ndarray, np.ndarray]], extended: np.ndarray | None = None) -> SuffixTree:
    """The tree of grams and candidate contexts, sorted, with their counts, by depth.

    A context is retained if the symbols after it diverge from those after its
    parent (the context without its first byte), or if an extension of it is
    retained, so that the suffixes of a state are states; ``extended`` are
    contexts of SHORT bytes that have retained extensions elsewhere. A state
    lists every symbol seen after it. A symbol's probability is
    (n + D * parent's) / (N + D), where D is the number of different symbols
    seen after the state, and n is 0 for what isn't listed.
    The root lists all 256 symbols with one added to each count. So each
    state's sum is 1.
    """
    byte = np.uint64(8)
    kept = [np.zeros(len(k), bool) for k, _ in ctx]
    for d in range(1, DEPTH + 1):
        key, n = own[d]
        if not len(key) or not len(ctx[d][0]):
            continue
        at, ok = lookup(ctx[d][0], key >> byte)
        pa_, ok2 = lookup(own[d - 1][0], key & np.uint64((1 << (8 * d)) - 1))
        up, ok3 = lookup(ctx[d - 1][0], (key & np.uint64((1 << (8 * d)) - 1)) >> byte)
        good = ok & ok2 & ok3
        at, n, pa_, up = at[good], n[good], pa_[good], up[good]
        p = n / ctx[d][1][at]
        q = own[d - 1][1][pa_] / ctx[d - 1][1][up]
        kl = np.bincount(at, p * np.log(p / q), len(ctx[d][0]))
        kept[d] = (kl >= DIVERGENCE) & (kl * ctx[d][1] >= EVIDENCE)
    if extended is not None:
        at, ok = lookup(ctx[SHORT][0], extended)
        kept[SHORT][at[ok]] = True
    for d in range(DEPTH, 1, -1):
        parents = np.unique(ctx[d][0][kept[d]] & np.uint64((1 << (8 * (d - 1))) - 1))
        at, ok = lookup(ctx[d - 1][0], parents)
        kept[d - 1][at[ok]] = True
        _, ok = lookup(ctx[d - 1][0], ctx[d][0] & np.uint64((1 << (8 * (d - 1))) - 1))
        kept[d] &= ok
    root = np.ones(256)
    root[own[0][0].astype(np.int64)] += own[0][1]
    prob = [root / root.sum()]
    tree = SuffixTree([np.zeros(1, np.uint64)], [np.zeros(1)], [np.arange(256, dtype=np.uint64)], [np.log10(prob[0])])
    for d in range(1, DEPTH + 1):
        states, total_n = ctx[d][0][kept[d]], ctx[d][1][kept[d]]
        key, n = own[d]
        at, ok = lookup(states, key >> byte)
        pa_, ok2 = lookup(tree.entries[d - 1], key & np.uint64((1 << (8 * d)) - 1))
        key, n, at, pa_ = key[ok & ok2], n[ok & ok2], at[ok & ok2], pa_[ok & ok2]
        up = prob[d - 1][pa_] if len(pa_) else np.zeros(0)
        different = np.bincount(at, minlength=len(states)).astype(float)
        p = (n + different[at] * up) / (total_n[at] + different[at])
        tree.contexts.append(states)
        tree.rest.append(np.log10(different / (total_n + different)))
        tree.entries.append(key)
        tree.logp.append(np.log10(p))
        prob.append(p)
    return tree


def fit_tree(gram_counts: DataFrame) -> SuffixTree:
    """The whole tree in one place. gram_counts: key, n of all grams of a small corpus."""
    got = gram_counts.select("key", "n").toArrow()
    return grow_tree(*_by_depth(got.column("key").to_numpy().view(np.uint64), got.column("n").to_numpy().astype(float), 0, DEPTH))


def gram_logs(grams: DataFrame) -> tuple[DataFrame, SuffixTree]:
    """(key, m, logp of all grams, the tree of contexts of up to SHORT bytes).

    grams: key, n, m, different keys; they may have n = 0. Grams with the same
    SHORT + 1 bytes before their symbol meet in one task, and with them all
    longer contexts that end so. logp is null where no such context is
    retained; the tree that is returned has the probability then.
    """
    last = (1 << (8 * (SHORT + 1))) - 1
    short = grams.filter("n > 0").groupBy(F.col("key").bitwiseAND(F.lit(last)).alias("key")).agg(F.sum("n").alias("n")).toArrow()
    own, ctx = _by_depth(short.column("key").to_numpy().view(np.uint64), short.column("n").to_numpy().astype(float), 0, SHORT)
    shared = grams.sparkSession.sparkContext.broadcast((own, ctx))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        key, n, m = (np.concatenate([b.column(name).to_numpy() for b in parts]) for name in ("key", "n", "m"))
        key, seen = key.view(np.uint64), n > 0
        more, longer = _by_depth(key[seen], n[seen].astype(float), SHORT + 1, DEPTH)
        tree = grow_tree(shared.value[0] + more, shared.value[1] + longer)
        _, deep = lookup(tree.contexts[SHORT + 1], (key >> np.uint64(8)) & np.uint64(last))
        logp = tree.slow(key)
        for i in range(0, len(key), 1 << 16):
            j = slice(i, i + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(key[j].view(np.int64)), pa.array(m[j]), pa.array(logp[j], mask=~deep[j])], names=["key", "m", "logp"])

    before = F.shiftright("key", 8)
    dealt = grams.select("key", "n", "m").repartition(max(1, -(-grams.count() // DEALT)), before.bitwiseAND(F.lit(last)))
    logs = checkpointed(dealt.mapInArrow(scan, "key bigint, m bigint, logp double"))
    extended = logs.filter("logp IS NOT NULL").select(before.bitwiseAND(F.lit(last >> 8)).alias("c")).distinct().toArrow()
    none = [(np.zeros(0, np.uint64), np.zeros(0))] * (DEPTH - SHORT)
    return logs, grow_tree(own + none, ctx + none, extended.column("c").to_numpy().view(np.uint64))


def _levels(frame: DataFrame, column: str) -> dict[int, tuple[int, int]]:
    """How many rows of each power of two the counts of a column have, and their sum."""
    return {r["b"]: (r["v"], r["s"]) for r in frame.groupBy(F.floor(F.log2(column)).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("v"), F.sum(column).alias("s")).collect()}


def _cut(levels: dict[int, tuple[int, int]], most: int) -> int:
    """The power of two from which on at most ``most`` rows are."""
    cut, taken = 63, 0
    for b in range(63, -1, -1):
        taken += levels.get(b, (0, 0))[0]
        if taken > most:
            break
        cut = b
    return cut


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, head_words: int = HEAD_WORDS, head_grams: int = HEAD_GRAMS) -> DataFrame:
    """log10 probabilities of every text by words alone and by the suffix tree.

    Learns from all texts whose id has a crc32 modulo ``folds`` other than
    ``held``. Returns id, held_out, n_tokens, n_known, train_tokens,
    base_score, score. Tokens are words (runs of anything but white space,
    A-Z lower-cased) and one end for each text, so null and empty texts have
    one token. Words are told apart by a 64-bit hash. Counts of the at most
    ``head_words`` most frequent words are broadcast; the other words of all
    texts meet theirs in a join, and so do grams beyond the ``head_grams`` most
    frequent ones their probabilities. Repeated rows are scored each on its own.
    Without training texts every word is unknown and the tree is its root.
    Other columns, whatever their names, play no part; an empty table gives an empty one.
    A text is worked through as a whole, with some tens of bytes of arrays for each of its bytes.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    counts = checkpointed(corpus_counts(texts.select("_text", (remainder(F.col("_id"), folds) == held).alias("_held"))))
    logs, short = gram_logs(counts.filter("kind = 1").select("key", "n", "m"))
    gram_cut = _cut(_levels(logs, "m"), head_grams)
    often = logs.filter(F.col("m") >= (1 << gram_cut)).toArrow()
    keys = often.column("key").to_numpy().view(np.uint64)
    logp = often.column("logp").to_numpy().astype(float)  # null becomes nan
    logp = np.where(np.isnan(logp), short.slow(keys), logp)
    frequent = FrequentGrams(keys, logp, often.column("m").to_numpy())
    words = counts.filter("kind = 0").select("key", "n")
    levels = _levels(words, "n")
    vocabulary, tokens = sum(v for v, _ in levels.values()), sum(s for _, s in levels.values())
    cut = _cut(levels, head_words)
    head = words.filter(F.col("n") >= (1 << cut)).toArrow()
    keys = head.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    ends = words.filter(F.col("key") == _END_SIGNED).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shared = spark.sparkContext.broadcast((frequent, keys[order], np.log10(head.column("n").to_numpy()[order] + 1.0)))
    tree = spark.sparkContext.broadcast(short)
    del often, logp, frequent, head, keys, order
    kind = texts.schema["_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, common, log_n = shared.value
        for batch in batches:
            for rows, data, offs in text_blocks(batch, "_text"):
                grams, place, hashes, first = joined_texts(data, offs)
                logp, cached = model.find(grams)
                score = segment_sums(logp, place)
                at, found = lookup(common, hashes)
                known = segment_sums(found, first) + int(ends > 0)
                sums = segment_sums(np.where(found, log_n[at] if len(log_n) else 0.0, 0.0), first) + float(np.log10(ends + 1))
                own = range_hash(prefix_sums(data), offs[:-1], offs[1:])
                of_word, of_gram = (np.repeat(np.arange(len(offs) - 1), np.diff(x)) for x in (first, place))
                text = np.concatenate([of_word[~found], of_gram[~cached]])
                order = np.argsort(text, kind="stable")
                kinds = np.repeat(np.array([0, 1], np.int8), [(~found).sum(), (~cached).sum()])[order]
                missing = np.concatenate([hashes[~found], grams[~cached]])[order]
                rare = np.searchsorted(text[order], np.arange(len(offs)))
                tail = pa.ListArray.from_arrays(pa.array(rare.astype(np.int32)), pa.StructArray.from_arrays([pa.array(kinds), pa.array(missing.view(np.int64))], names=["kind", "key"]))
                ids = batch.column("_id").slice(rows.start, rows.stop - rows.start)
                arrays = [ids, pa.array(own.view(np.int64)), pa.array(np.diff(first) + 1), pa.array(known.astype(np.int64)), pa.array(sums), pa.array(score), tail]
                yield pa.RecordBatch.from_arrays(arrays, names=["_id", "_own", "n_tokens", "known", "sums", "score", "tail"])

    scored = checkpointed(texts.mapInArrow(scan, f"_id {kind}, _own bigint, n_tokens bigint, known bigint, sums double, score double, tail array<struct<kind: tinyint, key: bigint>>"))
    # Rows that repeat id and text have the same tail; each has one first
    # element, so their number divides what they add up to together.
    tails = scored.select("_id", "_own", F.posexplode("tail").alias("_pos", "_t")).select("_id", "_own", "_pos", "_t.kind", "_t.key")

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("logp").to_numpy(zero_copy_only=False).astype(float)
            todo = np.flatnonzero(np.isnan(v))
            v[todo] = tree.value.slow(batch.column("key").to_numpy().view(np.uint64)[todo])
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(v), np.int8)), batch.column("key"), pa.array(v)], names=["kind", "key", "v"])

    of_words = words.filter(F.col("n") < (1 << cut)).select(F.lit(0).cast("tinyint").alias("kind"), "key", F.log10(F.col("n") + 1).alias("v"))
    of_grams = logs.filter(F.col("m") < (1 << gram_cut)).select("key", "logp").mapInArrow(filled, "kind tinyint, key bigint, v double")
    met = tails.join(of_words.unionByName(of_grams), ["kind", "key"], "left")
    is_word, is_gram = F.col("kind") == 0, F.col("kind") == 1
    rest = met.groupBy("_id", "_own").agg(
        F.sum(F.when(is_word & F.col("v").isNotNull(), 1).otherwise(0)).alias("more"), F.sum(F.when(is_word, F.col("v"))).alias("extra"),
        F.sum(F.when(is_gram, F.col("v"))).alias("deep"), F.sum(F.when(F.col("_pos") == 0, 1).otherwise(0)).alias("rep"),
    )
    both = scored.drop("tail").alias("a").join(rest.alias("b"), F.col("a._id").eqNullSafe(F.col("b._id")) & (F.col("a._own") == F.col("b._own")), "left")
    base = F.col("sums") + F.coalesce(F.col("extra") / F.col("rep"), F.lit(0.0)) - F.col("n_tokens") * float(np.log10(tokens + vocabulary + 1))
    return both.select(
        F.col("a._id").alias(id_col), (remainder(F.col("a._id"), folds) == held).alias("held_out"), "n_tokens", (F.col("known") + F.coalesce((F.col("more") / F.col("rep")).cast("long"), F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + F.coalesce(F.col("deep") / F.col("rep"), F.lit(0.0))).alias("score"),
    )
