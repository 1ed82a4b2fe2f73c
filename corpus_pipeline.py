"""Corpus pipeline: low quality goes, repeated lines go, near copies go, benchmark leaks go, the rest is encoded.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All stages but the last
return the columns of documents. An empty or null text is a document like any other: it is scored, is a copy of
other empty texts, and has no tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallspan.llm import bpe, decontamination, line_dedup, near_dedup, quality_model
from tallspan.llm.common import read, with_checkpoints

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores at its cut or above; all, if the labels teach no rule."""
    labels = read(spark, sf_dir, "labels").filter(~quality_model.held_out(4, 2)).select("doc_id", "quality")
    model = quality_model.train(docs, labels)
    if not model.rules:
        return docs
    return quality_model.score(docs, model, "__score").filter(F.col("__score") >= quality_model.CUT).drop("__score")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier one has, equal or nearly so."""
    cut = line_dedup.dedup_lines(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return cut.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of least id."""
    return near_dedup.one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token count and digests of the ids and of the decoded bytes."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=False)


STAGES = [("quality classifier", quality), ("line dedup", lines), ("near dedup", near_copies), ("decontamination", leaks), ("byte BPE", encode)]

#: SQL can't express the learned rules or the edit joins; tests/llm hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is cut off in the shared checkpoint folder."""
    with_checkpoints(spark)
    docs = read(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
    return STAGES[-1][1](spark, docs, sf_dir)
