"""The corpus pipeline stage by stage on a small corpus."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from landquill.llm.exact_dedup import exact_dedup
from landquill.llm.quality import quality
from landquill.llm.simhash import near_dedup
from test_ops import prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    path = str(tmp_path_factory.mktemp("tables"))
    rows, labels = [], []
    for i in range(300):
        junk = i % 4 == 0
        text = prose(rng, rng.randrange(30, 90))
        rows.append((i, " ".join(w + "###" for w in text.split()) if junk else text, "en", f"s{i % 4}", len(text)))
        labels.append((i, int(not junk), 0))
    item = " ".join(f"q{k}" for k in range(30))
    rows += [(400, rows[1][1], "en", "s1", 1), (401, rows[2][1] + " ", "en", "s1", 1), (402, prose(rng, 20) + " " + item, "en", "s2", 1), (403, rows[5][1].replace("a", "A").replace("t", "T"), "en", "s2", 1)]
    rows += [(404, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontaminate", "mix"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        path = f"{folder}/out{k}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if k < 4:
            assert docs.columns == columns
    good = {r["doc_id"] for r in quality(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")).filter("predicted = 1").collect()}
    assert kept["quality"] == good and {i for i in range(300) if i % 4 == 0}.isdisjoint(good)
    assert {400}.isdisjoint(kept["exact_dedup"]) and {1, 2} <= kept["exact_dedup"]
    assert 403 not in kept["near_dedup"] and {1, 2, 5} <= kept["near_dedup"]
    assert kept["near_dedup"] - kept["decontaminate"] == {402}
    assert kept["mix"] == kept["decontaminate"]


def test_stages_leave_columns_alone_whatever_their_names(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["predicted", "held_out", "Score", "contaminated", "n_words", "_gone", "gone_id", "own", "_kept_id", "kept_id", "sha", "kept_sha", "fp", "n", "component_id", "a.b"]
    wide = docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])
    for _, stage in corpus_pipeline.STAGES[:4]:
        plain, out = stage(spark, docs, folder), stage(spark, wide, folder)
        assert out.columns == wide.columns
        assert collections.Counter(tuple(r) for r in out.collect()) == collections.Counter((*r, *range(len(names))) for r in plain.collect())
    assert corpus_pipeline.STAGES[4][1](spark, wide, folder).count() == docs.count()


@pytest.mark.parametrize("stage", [exact_dedup, near_dedup])
def test_an_id_with_two_texts_is_judged_text_by_text(spark, stage):
    rng = random.Random(1)
    same, other = prose(rng, 40), prose(random.Random(99), 60)
    rows = [(3, same), (5, other), (5, same.replace(" ", "  ")), (5, other), (None, same), (None, other + " x"), (9, None), (8, "")]
    left = [(r["doc_id"], r["text"]) for r in stage(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert (3, same) in left and (5, other) in left and (5, same.replace(" ", "  ")) not in left and (8, "") in left and (9, None) not in left
    assert left.count((5, other)) == (1 if stage is exact_dedup else 2)


def test_run(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    total = out.agg(F.sum("size"), F.sum("taken")).first()
    assert 1.3 * total[0] < total[1] < 1.7 * total[0]


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
