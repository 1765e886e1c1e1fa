"""Training corpus from raw documents: five stages, each an operator of ``wardstar.llm``.

Every stage works on all that its predecessor kept, is written as Parquet in
the shared folder and read again.  All but the last keep the columns of
``documents``.

1. language_id: documents without a language (null text or no letter) go.
2. toxicity: documents scored toxic go; learned from ``labels`` of documents here.
3. simhash_near_dedup: of each group of near copies the least doc_id stays.
4. mixing: documents repeat or go so that sources meet their target weights.
5. packing: what is left becomes token sequences of at most 2048 ids.

A table without rows gives no rows in every stage.  Columns of the input that no
operator reads come through unchanged, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.llm import langid, mixing, packing, simhash, toxicity
from wardstar.llm.common import staged, table

READ = ("doc_id", "text", "lang", "source")  # columns that operators read
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apart(stage: Stage) -> Stage:
    """A stage whose operator meets the columns it does not read under other names, so that its own cannot clash with them."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        named = docs.toDF(*[c if c.lower() in READ else f"kept_{i}" for i, c in enumerate(docs.columns)])
        return stage(spark, named, sf_dir).select(named.columns).toDF(*docs.columns)

    return run


@apart
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names, model = langid.train(docs)
    if model is None:  # no document tells a language: whether there are letters decides alone
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs, names, model)
    return found.where(F.col("lang_pred") != langid.UNKNOWN)


@apart
def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    found = toxicity.score(docs, toxicity.train(docs, labels))
    return found.where(F.col("score") < toxicity.THRESHOLD)


@apart
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


@apart
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(mixing.mix(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("toxicity", toxic_documents),
    ("simhash_near_dedup", near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL has no trained models and no tokenizer; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
