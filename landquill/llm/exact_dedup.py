"""Exact deduplication by content-defined chunk recipes (operator 8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landquill.llm.common import checkpointed, columns_of, fresh

WHITESPACE = r"[\x20\x09-\x0D]+"
#: A chunk ends behind the first cut point after ``least`` characters: a
#: vowel, any character, then one of a few consonants or a space. The rule
#: looks at the last three characters only, so that an edit moves the cuts
#: near it and no others; ``most`` bounds chunks of texts without cut points.
CHUNK = r"(?s).{{{least},{most}}}?(?:[aeiou].[ tnsr]|\z)|.{{1,{edge}}}"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE, " ")


def fingerprint(chunk: Column, bits: int = 64) -> Column:
    h = F.xxhash64(chunk)
    return h if bits >= 64 else F.shiftrightunsigned(h, 64 - bits)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 512, most: int = 4096, bits: int = 64) -> DataFrame:
    """Group documents whose texts are equal after collapsing white space.

    Every text is cut at content-defined points; each chunk's identifier is its
    64-bit fingerprint and a variant number. The variant is 0 unless two
    different chunks share the fingerprint: the distinct chunks are gathered
    once (combined before the shuffle), and fingerprints that stand for several
    contents number these. So identifiers are verified against the contents,
    and texts are equal exactly if their ordered identifier lists are. Long
    texts move once, as distinct chunks; everything after that moves lists of
    identifiers.

    Returns id, keep_id (smallest id of the group), group_size, kept,
    text_sha256. Null texts count as empty; empty texts are one group. Rows
    that repeat an id and its text each count in group_size, and each carries
    kept = true if the id is the smallest. A null id sorts after all others
    (it is the keep_id only of a group without any other id). ``bits`` narrows
    the fingerprint, which tests use to force clashes.
    Other columns, whatever their names, play no part; an empty table gives an empty one.
    A text of any length is cut into chunks where it lies.
    """
    body = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("_norm"))
    pattern = CHUNK.format(least=least, most=most, edge=most)
    chunked = body.select("doc_id", F.sha2(F.col("_norm").cast("binary"), 256).alias("text_sha256"), F.regexp_extract_all("_norm", F.lit(pattern), F.lit(0)).alias("_chunks"))
    recipes = chunked.select("doc_id", "text_sha256", F.transform("_chunks", lambda c: fingerprint(c, bits)).alias("_fps"))

    contents = chunked.select(F.explode("_chunks").alias("_chunk")).select(fingerprint(F.col("_chunk"), bits).alias("_fp"), "_chunk").distinct()
    clashes = checkpointed(contents.groupBy("_fp").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_fp"))
    if clashes.isEmpty():  # every fingerprint is verified to stand for one content
        lists = recipes.withColumn("_variants", F.lit(""))
    else:
        variants = contents.join(clashes, "_fp").groupBy("_fp").agg(F.array_sort(F.collect_list("_chunk")).alias("_all"))
        pieces = chunked.select("doc_id", "text_sha256", F.posexplode("_chunks").alias("_pos", "_chunk")).withColumn("_fp", fingerprint(F.col("_chunk"), bits))
        placed = pieces.join(variants, "_fp").select("doc_id", "text_sha256", "_pos", (F.array_position("_all", F.col("_chunk")) - 1).alias("_variant")).distinct()
        resolved = placed.groupBy("doc_id", "text_sha256").agg(F.to_json(F.array_sort(F.collect_list(F.struct("_pos", "_variant")))).alias("_variants"))
        same_row = recipes["doc_id"].eqNullSafe(resolved["doc_id"]) & (recipes["text_sha256"] == resolved["text_sha256"])
        lists = recipes.join(resolved, same_row, "left").select(recipes["doc_id"], recipes["text_sha256"], "_fps", F.coalesce("_variants", F.lit("")).alias("_variants"))

    # Both sides of the join are shuffled for it, so that a group with very
    # many copies is split like any skewed key.
    lists = checkpointed(lists)
    groups = checkpointed(lists.groupBy("_fps", "_variants").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    out = lists.join(groups, ["_fps", "_variants"])
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, unchanged: of equal texts the one with the smallest id.

    Rows are judged by id and text: of an id with several texts each one stays
    or goes with its own group. Of rows that repeat an id and its text, white
    space apart, one stays, whichever; nulls count as the empty text.
    """
    kept = checkpointed(exact_groups(docs, id_col, text_col).filter("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")))
    sha, kept_id, kept_sha = fresh(docs, "sha", "kept_id", "kept_sha")
    marked = docs.withColumn(sha, F.sha2(normalised(F.col(text_col)).cast("binary"), 256))
    same = F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(sha) == F.col(kept_sha))
    out = marked.join(kept.select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias(kept_sha)), same, "left_semi")
    if not kept.filter("n > 1").isEmpty():
        out = out.dropDuplicates([id_col, sha])
    return out.select(columns_of(docs))
