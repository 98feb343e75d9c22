"""Each corpus operator against a plain version of it, with awkward rows."""

import bisect
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from landquill.llm import decontaminate, exact_dedup, lm_score, mixing, quality, secrets, simhash, span_dedup, suffix_dedup, toxicity
from landquill.llm.components import components

SCHEMA = "doc_id long, text string, source string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = r"[^\x20\x09-\x0D]+"


def prose(rng, n):
    words = ["the", "of", "and", "stone", "river", "über", "niño", "a", "light", "house", "Winter", "paper", "green", "walks", "seven"]
    out = []
    for k in range(n):
        w = rng.choice(words) + rng.choice(["", "", "", "s", "er"])
        out.append(w + (rng.choice([".", ".\n", ",", "!"]) if k % rng.randrange(6, 12) == 5 else ""))
    return " ".join(out)


def corpus(seed=1, n=40):
    """Texts with copies, near copies, shared passages, nulls, blanks and one long text."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 300)) for _ in range(n)]
    texts += [texts[0], texts[1].replace(" ", "  \t"), texts[2] + " end", texts[3] + " " + texts[4][:700] + " " + texts[5], texts[6].upper()]
    texts += [None, None, "", " \n ", "one", "ab" * 600, "x" * 900, prose(rng, 9000)]
    return [(i, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With further columns whose names the operators use inside, and a row that comes twice."""
    df = spark.createDataFrame([*rows, rows[3]], SCHEMA).repartition(3)
    for name in ("fp", "key", "n", "h", "seg", "score", "size", "_chunks", "label", "x", "node", "copies"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# 1 ---------------------------------------------------------------------------


def test_span_dedup(docs, rows, empty):
    got = by_id(span_dedup.span_dedup(docs))
    firsts, removed = {}, 0
    for i, text, _ in rows:
        data = (text or "").encode()
        start, end, words, hashes, first = span_dedup.sentences(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        plain = [b" ".join(re.findall(rb"[^\x20\x09-\x0D]+", data[a:b].translate(bytes.maketrans(LOW_FROM, LOW_TO)))) for a, b in zip(start, end)]
        gone = set()
        for k in range(len(plain) - 2):
            e = k + 3
            while e <= len(plain) and sum(len(p.split()) for p in plain[k:e]) < span_dedup.LEAST_WORDS:
                e += 1
            if e > len(plain):
                continue
            if tuple(plain[k:e]) in firsts:
                gone |= set(range(k, e))
            else:
                firsts[tuple(plain[k:e])] = i
        kept, last = b"", 0
        for k in sorted(gone):
            kept += data[last : start[k]]
            last = start[k + 1] if k + 1 < len(start) else len(data)
        kept += data[last:]
        removed += len(gone)
        assert (got[i]["n_sentences"], got[i]["n_removed"]) == (len(plain), len(gone))
        assert got[i]["kept_text"] == (None if text is None else kept.decode())
    assert removed > 20
    assert span_dedup.span_dedup(empty).count() == 0


LOW_FROM, LOW_TO = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"


def test_span_dedup_tells_spans_apart_that_share_the_first_hash(docs):
    plain = span_dedup.span_dedup(docs)
    for bits in (1, 6):
        clashing = span_dedup.span_dedup(docs, hash_bits=bits)
        assert sorted(map(tuple, clashing.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_span_checks_follow_the_words():
    texts = ["One  two\nthree.", "one two three.", "one twothree.", ""]
    data, offs = np.frombuffer("".join(texts).encode(), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = span_dedup.span_checks(data, offs, offs[:3], offs[1:4])
    assert found[0] == found[1] == xxhash.xxh3_64_intdigest(b"one two three. ") and found[2] != found[0]


def test_span_dedup_finds_a_moved_passage(spark):
    rng = random.Random(9)
    passage = " ".join(f"w{rng.randrange(10**6)}" + ("." if k % 9 == 8 else "") for k in range(60))
    a, b = (" ".join(f"v{rng.randrange(10**6)}" for _ in range(40)) + ". " for _ in range(2))
    got = by_id(span_dedup.span_dedup(spark.createDataFrame([(1, a + passage, ""), (2, b + passage, "")], SCHEMA)))
    assert got[1]["n_removed"] == 0 and got[2]["words_removed"] >= 45 and got[2]["first_ids"] == [1]


@pytest.mark.parametrize("kind", ["plain", "marks", "other marks", "few words"])
def test_span_dedup_finds_every_passage_of_51_words(kind):
    rng = random.Random(17)
    marks = {"marks": ".!?", "other marks": "。？…؟।"}.get(kind, "")

    def words(n, few):
        every = rng.randrange(2, 30)
        return [(rng.choice(few) if few else f"w{rng.randrange(10**7)}") + (rng.choice(marks) if marks and rng.random() < 1 / every else "") for _ in range(n)]

    def found(text):
        data = np.frombuffer(text.encode(), np.uint8)
        _, _, n, hashes, first = span_dedup.sentences(data, np.array([0, len(data)]))
        return set(span_dedup.spans(n, hashes, first, span_dedup.RUN, span_dedup.LEAST_WORDS)[3].tolist())

    for _ in range(500):
        passage = words(51, [f"u{rng.randrange(10**7)}" for _ in range(2)] if kind == "few words" else None)
        a, b = (" ".join(words(rng.randrange(0, 40), None) + passage + words(rng.randrange(0, 40), None)) for _ in range(2))
        assert found(a) & found(b)


def test_span_dedup_ends_sentences_at_marks_of_other_scripts():
    data = np.frombuffer("één twee。 três… да؟ नमस्ते। end".encode(), np.uint8)
    assert span_dedup.sentences(data, np.array([0, len(data)]))[2].tolist() == [2, 1, 1, 1, 1]


# 2 ---------------------------------------------------------------------------


def labelled(spark, seed, n, bad, kind):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        hit = rng.random() < 0.3
        text = prose(rng, rng.randrange(20, 80))
        rows.append((i, bad(rng, text) if hit else text, "s"))
        if i % 10:
            labels.append((i, int(hit) if kind == "toxic" else int(not hit)))
    rows += [(n, None, "s"), (n + 1, "", "s")]
    labels += [(n, None), (None, 1)]
    truth = {i: (r[1] or "") for i, r in enumerate(rows)}
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, f"doc_id long, {kind} int"), truth


def test_toxicity(spark, empty):
    insult = lambda rng, t: t + " you " + rng.choice(["blockhead", "nincompoop", "scoundrels", "Blockheads", "nincompoops"]) + " " + prose(rng, 10)
    docs, labels, _ = labelled(spark, 5, 400, insult, "toxic")
    docs = docs.unionByName(spark.createDataFrame([(1000, "what a nincompop he is", "s"), (1001, "the river and the house", "s")], SCHEMA))
    got = by_id(toxicity.toxicity(docs, labels))
    assert len(got) == 404 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["toxic"] is not None}
    held = [i for i in truth if got.get(i) and got[i]["held_out"]]
    assert sum(got[i]["predicted"] == truth[i] for i in held) >= 0.95 * len(held)
    assert got[1000]["score"] > got[1001]["score"]
    none = by_id(toxicity.toxicity(docs, labels.limit(0)))
    assert all(r["predicted"] == 0 for r in none.values())
    assert toxicity.toxicity(empty, labels).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_automaton_matches_edit_distance(seed):
    rng = random.Random(seed)
    terms = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randrange(4, 8))) for _ in range(12)})
    auto = toxicity.build_automaton(terms, fuzzy_from=5)
    words = [bytes(rng.choice(b"abcd") for _ in range(rng.randrange(1, 9))) for _ in range(800)]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, up = [i, *([0] * len(b))], row
            for j, y in enumerate(b, 1):
                row[j] = min(up[j] + 1, row[j - 1] + 1, up[j - 1] + (x != y))
        return row[-1]

    data = np.frombuffer(b" ".join(words), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    at, value = toxicity.match_words(auto, data, starts, ends)
    found = dict(zip(at.tolist(), value.tolist()))
    for k, w in enumerate(words):
        exact = [t for t in terms if w.startswith(t)]
        near = [t for t in terms if len(t) >= 5 and w[0] == t[0] and abs(len(w) - len(t)) <= 1 and any(distance(w[:n], t) == 1 for n in range(len(w) + 1))]
        if exact:
            assert found[k] % 2 == 0 and terms[found[k] // 2] in exact
        elif k in found:
            assert found[k] % 2 == 1 and terms[found[k] // 2] in near
        else:
            assert not [t for t in terms if len(t) >= 5 and w[0] == t[0] and distance(w, t) <= 1]


def test_errors_are_judged_over_the_whole_word():
    terms = [b"scoun", b"scoundrel", b"idiot", b"moron"]
    auto = toxicity.build_automaton(terms, first_right=False)
    want = {b"sscoundrel": 1, b"scounsomething": 0, b"sconudrel": None, b"scondrel": 1, b"scoudnrel": None, b"scudrel": None, b"idioms": None, b"morose": None, b"idiott": 2, b"idiof": 2, b"ydiot": 2, b"diot": 2, b"xidiot": 2, b"moran": 3, b"mron": 3, b"idiots": 2}
    for word, term in want.items():
        data = np.frombuffer(word, np.uint8)
        _, value = toxicity.match_words(auto, data, np.array([0]), np.array([len(data)]))
        assert (value // 2).tolist() == ([] if term is None else [term]), word


def test_lexicon_keeps_every_precise_stem(spark):
    names = [f"{a}{b}{c}zz" for a in "bcdfghj" for b in "aeiou" for c in "klmnp"]  # 175
    rows = [(f"the river {name} and {names[(k + 1) % len(names)]}", 1) for k, name in enumerate(names) for _ in range(3)] + [("the river and", 0)] * 600
    found = toxicity.mine_lexicon(spark.createDataFrame(rows, "_text string, label int"))
    assert {s.decode() for s, _ in found} >= set(names)


# 3 ---------------------------------------------------------------------------


def removed_bytes(texts, length):
    count = collections.Counter(b[s : s + length] for b in texts for s in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if count[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        out.append(gone)
    return out


@pytest.mark.parametrize("crowd, enough", [(1, 1), (1, 4096), (3, 2), (4096, 4096)])
def test_suffix_dedup(docs, rows, empty, crowd, enough):
    texts = [(t or "").encode() for _, t, _ in [*rows, rows[3]]]
    got = by_id(suffix_dedup.repeated_bytes(docs, length=60, passage=40, seed=20, symbol=20, crowd=crowd, enough=enough))
    for (i, _, _), data, gone, again in zip(rows, texts, removed_bytes(texts, 60), removed_bytes(texts, 40)):
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()), i
        assert got[i]["n_repeated"] == sum(again), i
    assert suffix_dedup.repeated_bytes(empty).count() == 0


def test_suffix_dedup_of_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", 500)
    rng = random.Random(4)
    body = prose(rng, 600)
    texts = [body.encode(), (prose(rng, 50) + body[500:1500]).encode()]
    whole = []
    for t in texts:
        data = np.frombuffer(t, np.uint8)
        for _, a, b in suffix_dedup._parts(np.array([0, len(t)]), 40, 60):
            _, s0, n, size, *_ = suffix_dedup.segments_of(data[a:b], np.array([0, b - a]), 40, 60, 20)
            for x, y, z in zip(s0, n, size):
                assert z == min(x + y + 59, b - a) - x and (a + x + z == len(t) or z == y + 59)
                whole += range(a + x, a + x + y)
    assert whole == [*range(len(texts[0]) - 39), *range(len(texts[1]) - 39)]


@pytest.mark.parametrize("seed", range(4))
def test_merged_transforms_have_the_blocks_of_sorted_suffixes(seed):
    rng = np.random.default_rng(seed)
    bodies = [[bytes(rng.choice(list(b"ab"), int(rng.integers(12, 40)))) for _ in range(int(rng.integers(1, 5)))] for _ in range(3)]
    length, symbol = 12, 4
    shards = []
    for shard in bodies:
        size = np.array([len(b) for b in shard])
        shards.append(suffix_dedup.Shard(np.frombuffer(b"".join(shard), np.uint8), np.concatenate([[0], np.cumsum(size)]), size - 8 + 1, symbol))
    found = suffix_dedup.repeated_windows(shards, [np.ones(len(b), np.int64) for b in bodies], symbol, (8, length))
    for size in (8, length):
        count = collections.Counter(b[s : s + size] for shard in bodies for b in shard for s in range(len(b) - size + 1))
        for shard, (segment, place) in zip(bodies, found[size]):
            want = {(k, s) for k, b in enumerate(shard) for s in range(len(b) - size + 1) if count[b[s : s + size]] > 1}
            assert set(zip(segment.tolist(), place.tolist())) == want


# 4 ---------------------------------------------------------------------------

ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@pytest.mark.parametrize("block", [1 << 25, 40])
def test_decontaminate(spark, docs, rows, empty, block):
    words = lambda t: re.findall(ALNUM_WORD, (t or "").translate(LOW))
    rng = random.Random(2)
    items = [(11, " ".join(words(rows[7][1])[5:30])), (2, "RIVER, of the"), (3, None), (4, "!!"), (5, prose(rng, 20)), (2, "RIVER, of the"), (None, "paper paper")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = by_id(decontaminate.contamination(docs, bench, width=5, block_bytes=block, cut=True))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(0, len(w) - 4) if len(w) >= 5 else bool(w)):
            windows[tuple(w[k : k + 5])].add("null" if i is None else str(i))
    for i, text, _ in rows:
        w, hit, named = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    named |= windows[tuple(w[k : k + n])]
        want = (len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == want
        assert len(words(r["clean_text"])) == len(w) - len(hit) or hit
    assert any(r["contaminated"] for r in got.values()) and not all(r["contaminated"] for r in got.values())
    assert decontaminate.contamination(empty, bench).count() == 0
    assert not any(r["n_hit"] for r in decontaminate.contamination(docs, bench.limit(0)).collect())


def test_decontaminate_bounds_blocks_of_repeated_items(spark, docs, monkeypatch):
    rng = random.Random(8)
    items = [(k, prose(rng, 20)) for k in range(200)] + [(500, prose(rng, 20))] * 100
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks, plain = [], decontaminate.window_set
    monkeypatch.setattr(decontaminate, "window_set", lambda rows, width: blocks.append(list(rows)) or plain(rows, width))
    decontaminate.contamination(docs, bench, block_bytes=8000)
    assert len(blocks) > 1 and sorted(int(i) for b in blocks for i, _ in b) == [*range(200), 500]
    assert all(sum(len(t.encode()) for _, t in b) <= 8000 for b in blocks)


# 5 ---------------------------------------------------------------------------


def targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    capped, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        out = {s: 2 * sizes[s] if s in capped else rest * weight[s] / w for s in names}
        more = {s for s in names if s not in capped and out[s] > 2 * sizes[s]}
        if not more:
            return out
        capped |= more


def test_mixing(spark, empty):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 60)), rng.choice(["a", "a", "a", "b", "é", None, "Z"])) for i in range(900)] + [(2000, None, "a"), (2001, "", "void")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = by_id(mixing.mixed(docs, block=8))
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken, part = targets(sizes), collections.Counter(), collections.Counter()
    for i, t, s in rows:
        n, r = len((t or "").split()), got[i]
        assert (r["size"], r["source_size"]) == (n, sizes[s]) and r["copies"] in (0, 1, 2) and n * r["copies"] <= r["taken"] <= 2 * n
        part[s] += r["taken"] > n * r["copies"]
        assert r["target"] == pytest.approx(want[s])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes) and max(part.values()) == 1
    again = by_id(mixing.mixed(docs.repartition(5), block=8))
    assert {i: r["taken"] for i, r in got.items()} == {i: r["taken"] for i, r in again.items()}
    assert mixing.mixed(empty).count() == 0
    large = spark.createDataFrame([(k, "w " * (50_000 if k == 3 else 5), f"s{k % 2}") for k in range(40)], SCHEMA)
    out = mixing.mixed(large, block=8).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert len(out) == 2 and all(abs(r["t"] - r["target"]) <= 1 for r in out)
    twice = mixing.mixed(docs.unionByName(docs.filter("doc_id = 5")), block=8)
    assert twice.filter("doc_id = 5").count() == 2


# 6 ---------------------------------------------------------------------------


def fingerprint(text):
    w = re.findall(WORD, (text or "").translate(LOW))
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def groups(fps, most=4):
    root = {i: i for i in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if bin(fps[a] ^ fps[b]).count("1") <= most:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_simhash(docs, rows, empty):
    got = by_id(simhash.near_groups(docs))
    fps = {i: fingerprint(t) for i, t, _ in rows}
    want = groups(fps)
    assert {i: (r["fingerprint"], r["component_id"]) for i, r in got.items()} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
    assert len(set(want.values())) < len(want)
    assert simhash.near_groups(empty).count() == 0


@pytest.mark.parametrize("leaf", [2, 16])
def test_trie_links_join_what_all_pairs_join(spark, leaf):
    rng = random.Random(leaf)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in list(fps[:30]):
        for _ in range(6):
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                f ^= 1 << b
            fps.append(f)
    fps = {i: f for i, f in enumerate(dict.fromkeys(fps))}
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in fps.items()]
    links = simhash.trie_links(spark.createDataFrame(signed, "node long, fp long"), leaf=leaf)
    labels = {r["node"]: r["label"] for r in components(links).collect()}
    assert {i: labels.get(i, i) for i in fps} == groups(fps)


# 7 ---------------------------------------------------------------------------


def test_quality(spark, empty):
    junk = lambda rng, t: rng.choice([" ".join(w + rng.choice(["###", "&&&"]) for w in t.split()), " ".join([t.split()[0]] * 40)])
    docs, labels, _ = labelled(spark, 6, 400, junk, "quality")
    got = by_id(quality.quality(docs, labels))
    assert len(got) == 402 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    held = [i for i in truth if got.get(i) and got[i]["held_out"]]
    assert sum(got[i]["predicted"] == truth[i] for i in held) >= 0.95 * len(held)
    assert all(r["score"] == 0.5 for r in quality.quality(docs, labels.limit(0)).collect())
    assert quality.quality(empty, labels).count() == 0


def plain_features(text):
    b = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", b)
    classes = {4: b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 5: b"0123456789", 6: b".", 7: b",;:", 8: b"!?", 9: b"#$%&*+<=>@\\^_`~/{}[]()", 10: b"|", 11: bytes(range(128, 256)), 13: b"\n"}
    out = [0.0] * len(quality.FEATURES)
    out[0], out[1], out[12] = math.log1p(len(b)), math.log1p(len(words)), math.log1p(len(b) / (1 + b.count(b"\n")))
    for k, chars in classes.items():
        out[k] = sum(x in chars for x in b) / max(1, len(b))
    if words:
        low, n = [w.lower() for w in words], len(words)
        mean = sum(map(len, words)) / n
        out[2], out[3] = mean, math.sqrt(max(0, sum(len(w) ** 2 for w in words) / n - mean**2))
        out[14], out[15], out[16] = len(set(low)) / n, sum(a == c for a, c in zip(low, low[1:])) / n, len({(None, low[0]), *zip(low, low[1:])}) / n
        out[17], out[18] = sum(w[-1] in b".,;:!?" for w in words) / n, sum(w[0] in classes[4] for w in words) / n
        out[19], out[20], out[21] = math.log1p(max(map(len, words))), sum(len(w) == 1 for w in words) / n, max(b.count(c) for c in b"etaoinrs") / len(b)
    return out


def test_quality_features_and_scores_are_those_of_plain_lookups(spark, rows):
    texts = [t or "" for _, t, _ in rows] + ["a b", "a", "b a b a", "b"]
    data, offs = b"".join(t.encode() for t in texts), np.cumsum([0, *(len(t.encode()) for t in texts)])
    assert np.allclose(quality.features(np.frombuffer(data, np.uint8), offs), [plain_features(t) for t in texts])
    junk = lambda rng, t: " ".join(w + rng.choice(["###", "&&&"]) for w in t.split())
    docs, labels, _ = labelled(spark, 9, 200, junk, "quality")
    model = quality.fit_quality(docs, labels, "doc_id", "text", "quality", 4, 2, quality.SAMPLE)
    got = {(r["doc_id"], round(r["score"], 12)) for r in quality.quality(docs, labels).collect()}
    for r in docs.collect():
        x = plain_features(r["text"] or "")
        logit = model.bias + sum(t[bisect.bisect_right(list(c), v)] for t, c, v in zip(model.tables, model.cuts, x))
        logit += sum(t[bisect.bisect_right(list(model.pair_cuts[i]), x[i])][bisect.bisect_right(list(model.pair_cuts[j]), x[j])] for t, (i, j) in zip(model.pair_tables, model.pairs))
        assert any(i == r["doc_id"] and s == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-9) for i, s in got)


def test_additive_model_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x, y)
    assert ((model.logit(x) > 0) == (y > 0)).mean() > 0.9


# 8 ---------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_dedup(docs, rows, empty, bits):
    got = by_id(exact_dedup.exact_groups(docs, least=16, most=64, bits=bits))
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t, _ in rows}
    count = collections.Counter([*norm.values(), norm[3]])
    for i, t in norm.items():
        keep = min(k for k, v in norm.items() if v == t)
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (keep, count[t], keep == i, hashlib.sha256(t.encode()).hexdigest())
    assert exact_dedup.exact_groups(empty).count() == 0


def test_exact_dedup_keeps_repeated_rows_once(docs, rows):
    left = exact_dedup.exact_dedup(docs)
    assert left.columns == docs.columns
    ids = [r["doc_id"] for r in left.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in rows})


# 9 ---------------------------------------------------------------------------

ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def test_secrets(spark, empty):
    rng = random.Random(3)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    texts = ["token: secret: abcdefghij", "é PassWord = 'hunter2hunter2' tail", "token=short", "AKIA" + "A1" * 8 + " AKIAshort", "ſecret=abcdefgh12 ÅPI_KEY:\"x.y-z_0/1+2\"", pick("0123456789abcdef", 40) + "g" + "0" * 31, "", None, "\U0001f600 api_key=abcdefgh", "a\x01b token=12345678"]
    texts += [f"password={pick(b64, 30)} word" for _ in range(60)] + [" ".join("".join(rng.choice(["inter", "nation", "alization", "keit", "ver", "schlich", "ungen", "_identifier", "_long", "name", "words"]) for _ in range(6)) for _ in range(8)) for _ in range(60)]
    texts += ["see " + pick(b64, 34) + "7 here", "the identifier_number_with_long_words_1 here"]
    got = by_id(secrets.secret_report(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA)))
    for i, text in enumerate(texts):
        t = text or ""
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 8] + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        base = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        r = got[i]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == x for _, x, _ in found) for k in range(3))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("markov")] == [s for s in base.split(",") if s]
    assert got[len(texts) - 2]["spans"] == "markov:4:39" and got[len(texts) - 1]["spans"] == ""
    assert secrets.secret_report(empty).count() == 0


def test_markov_log_odds_and_held_out_samples(spark):
    rng = random.Random(6)
    pick = lambda chars: "".join(rng.choice(chars) for _ in range(rng.randrange(12, 40)))
    kinds = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", secrets.ALPHABET]
    ordinary = ["inter", "nation", "schung", "keit", "ment", "able", "verb", "tion", "user", "_id", "-name", "2024", "house"]
    samples = [(pick(rng.choice(kinds)), True) for _ in range(300)] + [("".join(rng.choice(ordinary) for _ in range(rng.randrange(4, 7))), False) for _ in range(900)]
    table = spark.createDataFrame(samples, "token string, random boolean")
    held = F.crc32(F.col("token").cast("binary")) % 5 == 2
    model = secrets.markov_model(table.filter(~held))
    count, start = collections.Counter(), collections.Counter()
    for token, kind in samples:
        if zlib.crc32(token.encode()) % 5 != 2:
            start[kind] += 1
            for a, b in zip("^" + token, token):
                count[kind, a, b] += 1
                count[kind, a] += 1
    judged = table.filter(held).select("token", "random", secrets.log_odds(F.col("token"), model).alias("odds")).collect()
    for r in judged:
        want = math.log(start[True] / start[False])
        for a, b in zip("^" + r["token"], r["token"]):
            want += math.log((count[True, a, b] + 0.5) / (count[True, a] + 0.5 * 69)) - math.log((max(0, count[False, a, b] - 1) + 0.5) / (max(0, count[False, a] - 1) + 0.5 * 69))
        assert r["odds"] == pytest.approx(want)
    assert len(judged) > 150 and sum((r["odds"] > 0) == r["random"] for r in judged) >= 0.97 * len(judged)
    assert secrets.markov_model(table.filter("random")) is None and secrets.markov_model(table.filter("NOT random")) is None


def test_one_kind_of_sample_adds_no_span(spark):
    texts = ["internationalization of responsibilities", "ZK8QW2XN5VB7MT3LP9RDXX", ""]
    got = secrets.secret_report(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], SCHEMA)).collect()
    assert all(r["spans"] == "" and r["n_markov"] == 0 for r in got)


def test_places_of_very_many_matches(spark):
    text = "é token: abcdefgh1 secret=x " * 1000
    row = secrets.secret_report(spark.createDataFrame([(1, text, "s")], SCHEMA)).first()
    assert row["n_assign"] == 1000 and row["base_sha256"] == hashlib.sha256(",".join(f"assign:{28 * k + 2}:{28 * k + 18}" for k in range(1000)).encode()).hexdigest()


# 10 --------------------------------------------------------------------------


@pytest.mark.parametrize("head", [1 << 19, 3])
def test_lm_base_counts(docs, rows, empty, head):
    got = by_id(lm_score.lm_scores(docs, head_words=head))
    tokens = {i: [*re.findall(WORD, (t or "").translate(LOW)), "\n"] for i, t, _ in rows}
    count = collections.Counter()
    for i in [*tokens, 3]:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(tokens[i])
    total = sum(count.values())
    for i, w in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(count[x] > 0 for x in w), total)
        assert r["base_score"] == pytest.approx(sum(math.log10((count[x] + 1) / (total + len(count) + 1)) for x in w))
        assert r["score"] < 0
    assert lm_score.lm_scores(empty).count() == 0


def test_lm_scores_are_those_of_a_plain_suffix_tree(docs, rows):
    depth, end = lm_score.DEPTH, b"\n"
    joined = {i: b" ".join(w.encode() for w in re.findall(WORD, (t or "").translate(LOW))) + end for i, t, _ in rows}
    lead = b"\0" * (depth - 1) + end
    count = [collections.defaultdict(collections.Counter) for _ in range(depth + 1)]
    for i in [*joined, 3]:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            text = lead + joined[i]
            for k in range(depth, len(text)):
                for d in range(depth + 1):
                    count[d][text[k - d : k]][text[k]] += 1
    total = [{c: sum(n.values()) for c, n in level.items()} for level in count]
    kept = {b""}
    for d in range(1, depth + 1):
        for c, after in count[d].items():
            n, up = total[d][c], count[d - 1][c[1:]]
            divergence = sum(v / n * math.log((v / n) / (up[s] / total[d - 1][c[1:]])) for s, v in after.items())
            if n >= lm_score.LEAST and divergence >= lm_score.DIVERGENCE and divergence * n >= lm_score.EVIDENCE:
                kept |= {c[k:] for k in range(d + 1)}
    known = {}

    def p(c, s):
        if (c, s) not in known:
            if not c:
                known[c, s] = (count[0][c][s] + 1) / (total[0][c] + 256)
            elif c not in kept:
                known[c, s] = p(c[1:], s)
            else:
                own, n = count[len(c)][c], total[len(c)][c]
                known[c, s] = (own[s] + len(own) * p(c[1:], s)) / (n + len(own))
        return known[c, s]

    got = by_id(lm_score.lm_scores(docs, head_grams=2000))
    for i, t in joined.items():
        text = lead + t
        assert got[i]["score"] == pytest.approx(sum(math.log10(p(text[k - depth : k], text[k])) for k in range(depth, len(text))))
    assert sum(len(c) > lm_score.SHORT for c in kept) > 20


def test_suffix_tree_is_a_distribution_and_uses_the_longest_state(spark):
    text = "the river and the house of stone and the light. " * 30
    raw = np.frombuffer(text.encode(), np.uint8)
    grams, place, _, _ = lm_score.joined_texts(raw, np.array([0, len(raw)]))
    packed = spark.createDataFrame([(int(k), int(n)) for k, n in collections.Counter(grams.tolist()).items()], "key long, n long")
    tree = lm_score.fit_tree(packed)
    assert len(tree.contexts[3])
    for d in range(1, lm_score.DEPTH + 1):
        suffixes = np.unique(tree.contexts[d] & np.uint64((1 << (8 * (d - 1))) - 1))
        assert np.isin(suffixes, tree.contexts[d - 1]).all()
    for context in (b"e riv", b"zzzzz", b"f sto", b"\x00\x00\x00\x00\n"):
        g = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)], np.uint64)
        slow = tree.slow(g)
        assert (10**slow).sum() == pytest.approx(1, abs=1e-6)
        assert tree.score(g) == pytest.approx(slow, abs=1e-5)
    assert tree.slow(np.array([int.from_bytes(b"e rive", "big")], np.uint64))[0] > math.log10(30 / 34 - 0.01)  # seen 30 times, always so, with a prior of 4


def test_lm_keeps_rare_contexts_of_a_large_corpus(spark, monkeypatch):
    rng = random.Random(4)
    phrase = "þæt wæs gōd cyning"
    common = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    texts = [" ".join(rng.choice(common) for _ in range(20_000)) for _ in range(20)]  # 2.4 million symbols
    texts += [phrase] * 7 + ["zq " + phrase + " qz"]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    monkeypatch.setattr(lm_score, "DEALT", 1 << 12)
    got = by_id(lm_score.lm_scores(spark.createDataFrame(rows, SCHEMA), head_grams=1000))
    learnt = [i for i in got if not got[i]["held_out"]]
    assert len({20, 21, 22, 23, 24, 25, 26, 27} & set(learnt)) >= 5
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    grams = [lm_score.joined_texts(r, np.array([0, len(r)]))[0] for r in raw]
    keys, n = np.unique(np.concatenate([grams[i] for i in learnt]), return_counts=True)
    tree = lm_score.fit_tree(spark.createDataFrame(list(zip(keys.tolist(), n.tolist())), "key long, n long"))
    for i, g in enumerate(grams):
        assert got[i]["score"] == pytest.approx(tree.score(g).sum(), rel=1e-9)
    symbols = len(phrase.encode()) + 1
    assert got[20]["score"] / symbols > -0.45  # seen 5 to 8 times, always so
