"""Importance resampling, hard negatives and token counts against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_ops import LOW, SCHEMA, corpus

from landquill.llm import hard_negatives, importance, token_counts
from landquill.llm.textbytes import text_buffer

ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame([*rows, rows[3]], SCHEMA).repartition(3)
    for name in ("_id", "_text", "bucket", "n", "weight", "score", "rank", "n_bytes", "_in", "_before", "_range"):
        df = df.withColumn(name, F.lit("clash"))
    return df


# 11 --------------------------------------------------------------------------


def runs(text, longest):
    w = re.findall(ALNUM_WORD, (text or "").translate(LOW))
    return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)], len(w)


def plain_importance(rows, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    own, aim = [0] * buckets, [0] * buckets
    for _, text in rows:
        for f in runs(text, longest)[0]:
            own[bucket(f)] += 1
    for text in target:
        for f in runs(text, longest)[0]:
            aim[bucket(f)] += 1
    s, t = sum(own), sum(aim)
    gain = [math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in zip(own, aim)]
    out = []
    for i, text in rows:
        found, n = runs(text, longest)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0]))
    rank = {id(r): k for k, r in enumerate(fit[: len(fit) * percent // 100], 1)}
    return sorted(((*r[:4], rank.get(id(r))) for r in out), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_importance(spark, docs, rows, longest):
    target = [prose for _, prose, _ in corpus(seed=5, n=8)] + [None]
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.importance(docs, bench, longest=longest, percent=40)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = plain_importance([(i, t) for i, t, _ in [*rows, rows[3]]], target, longest, percent=40)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert sum(r[4] is not None for r in want) > 10


def test_importance_of_nothing(spark, docs, rows):
    nothing = spark.createDataFrame([], "text string")
    assert importance.importance(spark.createDataFrame([], SCHEMA), nothing).count() == 0
    got = {r["doc_id"]: r for r in importance.importance(docs.filter("doc_id < 5"), nothing, least_words=10**6).collect()}
    assert len(got) == 5 and all(r["rank"] is None for r in got.values())
    drawn = importance.resampled(docs, nothing, percent=50)
    assert drawn.columns == docs.columns and 0 < drawn.count() < len(rows)


def test_payloads_compose():
    rng = random.Random(2)
    parts = [bytes(rng.randrange(256) for _ in range(rng.randrange(0, 3000))) for _ in range(40)]
    a, b = parts[:20], parts[20:]
    crc = [np.array([zlib.crc32(x) for x in p], np.uint32) for p in (a, b)]
    size = [np.array([len(x) for x in p]) for p in (a, b)]
    both, length = importance.composed(crc[0], size[0], crc[1], size[1])
    assert both.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b)] and length.tolist() == [len(x + y) for x, y in zip(a, b)]


@pytest.mark.parametrize(("window", "entries"), [(1 << 20, 1 << 17), (60, 1 << 17), (500, 40)])
def test_dictionary_changes_no_feature(monkeypatch, window, entries):
    monkeypatch.setattr(importance, "WINDOW_BYTES", window)
    monkeypatch.setattr(importance, "ENTRIES", entries)
    rng = random.Random(4)
    texts = ["", "a", "A b  c!!é ü9", "x" * 5000 + " y", "日本 " * 900] + [" ".join("".join(rng.choice("abcé1") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(80))) for _ in range(150)]
    dictionary = importance.Dictionary()
    for _ in range(2):  # the second time the dictionary knows words
        got = [[] for _ in texts]
        for text, crc, _ in importance.features(dictionary, *text_buffer(pa.array(texts)), 3):
            for t, c in zip(text.tolist(), crc.tolist()):
                got[t].append(c)
        assert [sorted(g) for g in got] == [sorted(zlib.crc32(f.encode()) for f in runs(t, 3)[0]) for t in texts]


# 12 --------------------------------------------------------------------------


def plain_negatives(rows, n_pos=5, n_neg=10):
    held = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, lab, v in held:
        if i % 100:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), j, m) for j, m, w in held if j != i))
        for s, j, _ in [x for x in scored if x[2] == lab][:n_pos]:
            fit = [(t, k) for t, k, m in scored if m != lab and 30 * -s <= 100 * -t <= 90 * -s][:n_neg]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(fit, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, extra string"


def vectors(seed, n, width=12, scale=0.4):
    rng = np.random.default_rng(seed)
    v = rng.normal(0, scale, (n, width)).astype(np.float32)
    v[n // 3 : n // 2] = v[n // 3]  # a third of all rows are one vector
    out = [(k, [float(x) for x in v[k]], int(rng.integers(0, 3)), "x") for k in range(n)]
    out[5] = (5, out[5][1], None, "x")
    out[6] = (6, None, 1, "x")
    out[7] = (7, [float("nan")] * width, 1, "x")
    out[8] = (8, [1.0, None], 1, "x")
    out[9] = (9, [float("inf")] * width, 1, "x")
    out[10] = (10, [0.5, 0.25], 1, "x")
    out[11] = (11, [], 1, "x")
    return [*out, out[20], (None, out[20][1], 1, "x")]


@pytest.mark.parametrize("block", [None, 2])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "TASK_ROWS", 150)
    rows = vectors(3, 700)
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("id", "vec", "list", "score", "anchor", "rank"):
        df = df.withColumn(name, F.lit("clash"))
    got = hard_negatives.hard_negatives(df, block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives([r[:3] for r in rows])
    assert sorted(map(tuple, got.collect())) == want and len(want) > 200


def test_hard_negatives_of_little(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(empty).count() == 0
    one = spark.createDataFrame([(100, [0.5], 1, ""), (101, [0.5], 2, "")], VECTORS)
    assert hard_negatives.hard_negatives(one).count() == 0  # no positive
    with pytest.raises(OverflowError):
        hard_negatives.hard_negatives(spark.createDataFrame([(100, [1e30], 1, ""), (101, [1.0], 1, "")], VECTORS))


@pytest.mark.parametrize(("most", "width"), [(1, 3), (160, 64), (10**6, 700), (2**28, 9)])
def test_products_from_residues_are_exact(most, width):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-most, most + 1, (15, width)), rng.integers(-most, most + 1, (20, width))
    a[0], b[0] = most, -most
    primes = hard_negatives.primes_for(float(width) * most * most)
    got = hard_negatives.exact_product(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, c)) for c in b] for r in a]


# 13 --------------------------------------------------------------------------


def awkward(seed):
    rng = random.Random(seed)
    texts = [None, "", " ", "  a", "it's 'sfoo ''s !'s 's's we'll  they're\n\n x'", "a<|endoftext|>b", "<|endoftext|><|endoftext|>'s <|endoftext", "\n\n a \n b\t\tc  ", "x" * 3000, "ab" * 4000, " " * 1999 + "a", "aaaaaaaa", "---" * 700, "日本語" * 400, "\x1c a\x1d\x85b"]
    letters = [*"aabbccs'tlrevmd  \n\t1234!?.<|>", "é", "ß", "日", " ", "　", "٣", "Ⅷ", "😀", "́", "<|endoftext|>"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(800)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(150)) for _ in range(60)]
    return texts + ["".join(rng.choice("0123456789abcdefABCDEFxyz+/=") for _ in range(rng.randrange(1, 900))) for _ in range(80)]


@pytest.fixture(scope="module")
def vocab():
    return token_counts.vocabulary(BPE)


def library(texts):
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize(("window", "chunk", "states"), [(1 << 20, 128, 500_000), (150, 16, 500_000), (700, 8, 300)])
def test_transducer_counts_as_the_library(monkeypatch, vocab, window, chunk, states):
    for name, value in (("WINDOW_BYTES", window), ("CHUNK", chunk), ("MOST_STATES", states)):
        monkeypatch.setattr(token_counts, name, value)
    texts = awkward(6)
    data, offs = text_buffer(pa.array(texts))
    assert token_counts._counted(token_counts.Transducer(vocab), data, offs).tolist() == library(texts)


def test_token_counts(spark, docs, rows):
    got = token_counts.token_counts(docs, BPE)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    every = [*rows, rows[3]]
    want = [(i, len((t or "").encode()), n, n > 512) for (i, t, _), n in zip(every, library([t for _, t, _ in every]))]
    assert sorted(map(tuple, got.collect())) == sorted(want) and any(w[3] for w in want)
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA), BPE).count() == 0


def test_token_counts_of_a_text_of_several_windows(spark):
    text = " ".join(corpus()[-1][1] for _ in range(60)) + "z" * 300_000
    assert len(text) > 3 << 20
    got = token_counts.token_counts(spark.createDataFrame([(1, text, None)], SCHEMA), BPE).first()
    assert got["n_tokens"] == library([text])[0]


def test_other_vocabularies_are_refused(tmp_path):
    with pytest.raises(ValueError):
        token_counts.vocabulary(public_tokenizers.path("word_bpe_49k.json"))
