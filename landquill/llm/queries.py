"""The corpus queries, each over the whole of its tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landquill.llm.common import table
from landquill.llm.decontaminate import contamination
from landquill.llm.exact_dedup import exact_groups
from landquill.llm.hard_negatives import hard_negatives
from landquill.llm.importance import importance
from landquill.llm.lm_score import lm_scores
from landquill.llm.mixing import mixed
from landquill.llm.quality import quality
from landquill.llm.secrets import secret_report
from landquill.llm.simhash import near_groups
from landquill.llm.span_dedup import span_dedup
from landquill.llm.suffix_dedup import repeated_bytes
from landquill.llm.token_counts import token_counts
from landquill.llm.toxicity import toxicity


def op1_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that lose sentences, with the ids of those that keep them."""
    found = span_dedup(table(spark, sf_dir, "documents")).filter("n_removed > 0")
    return found.select("doc_id", "first_ids", "n_sentences", "n_removed", "words_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_span_dedup": op1_span_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_secrets": op9_secrets,
    "op10_lm_score": op10_lm_score,
    "op11_importance": op11_importance,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_counts": op13_token_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op4_decontaminate": r"""
        WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
        b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ),
        items AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
        at_item AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items),
        windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM at_item),
        widths AS (SELECT DISTINCT n FROM items),
        at_doc AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, widths WHERE len(w) >= n),
        grams AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM at_doc),
        found AS (SELECT doc_id, n, i, item_id FROM grams JOIN windows USING (n, g)),
        words AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM found),
        hit AS (SELECT doc_id, count(*) AS n_hit FROM words GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
        )
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op8_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
        FROM n JOIN g USING (t)
    """,
    # The CRC of every different word goes byte by byte through a table made of the polynomial.
    "op11_importance": r"""
        WITH tab AS (
            SELECT list_transform(range(256), lambda b: list_reduce(range(9), lambda c, k: CASE WHEN k = 0 THEN c WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, CAST(b AS BIGINT))) AS t
        ),
        d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
        dw AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM d) GROUP BY doc_id, w),
        words AS (SELECT DISTINCT w FROM (SELECT w FROM dw UNION ALL SELECT w FROM b)),
        bytes AS (SELECT w, list_transform(range(CAST(len(hex(encode(w))) // 2 AS BIGINT)), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT)) AS x FROM words),
        hashed AS (
            SELECT w, xor(list_reduce(x, lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 10000 AS bucket
            FROM bytes, tab
        ),
        s AS (SELECT bucket, sum(n) AS s FROM dw JOIN hashed USING (w) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM b JOIN hashed USING (w) GROUP BY bucket),
        sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS all_s, (SELECT coalesce(sum(t), 0) FROM t) AS all_t),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (all_s + 10000) AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
            FROM s LEFT JOIN t USING (bucket), sums
        ),
        weights AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM dw JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM d LEFT JOIN weights USING (doc_id)
        ),
        ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN r <= n * 10 // 100 THEN r END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)
    """,
    "op12_hard_negatives": r"""
        WITH v AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.id AS anchor_id, b.id, a.label = b.label AS alike, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
            FROM v AS a, v AS b WHERE a.id % 100 = 0 AND a.id <> b.id
        ),
        p AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        ),
        n AS (
            SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
                CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
            FROM p JOIN s USING (anchor_id)
            WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
    """,
}
