"""A corpus pipeline of the subpackage llm.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and
reread as the next one's docs. Stages 1 to 4 return rows of ``docs`` unchanged.

1. quality: documents whose score is below 0.7 go.
2. exact_dedup: of equal texts (white space apart) the smallest doc_id stays.
3. near_dedup: of each SimHash group the smallest doc_id stays.
4. decontaminate: documents of which a twentieth or more lies in windows of
   ``benchmark`` go.
5. mix: how many words the mix takes of each document that is left.

Empty tables pass through as empty tables; nulls, empty and very long texts,
repeated rows and further columns are treated as each operator's docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landquill.llm.common import stored, table
from landquill.llm.decontaminate import clean_documents
from landquill.llm.exact_dedup import exact_dedup
from landquill.llm.mixing import mixed
from landquill.llm.quality import good_documents
from landquill.llm.simhash import near_dedup


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def clean_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", clean_stage),
    ("mix", mix_stage),
]

#: The learnt scores of stage 1 and the draws of stage 5 have no SQL; the tests
#: hold each stage against a plain version of it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
