"""The corpus pipeline: from documents to token ids in five stages.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns the columns of
``documents``; the last one returns ``doc_id, n_pieces, ids``. Documents that a stage rejects are gone afterwards; a text
that loses passages keeps its row; a document that the mix takes several times has several rows.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import minhash, mixing, pieces, quality, substring
from tidemark.llm.text import bounded_batches
from tidemark.session import release_paths, scratch_mark, scratch_since, settled


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return minhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word windows that start in a document with a smaller id; n_chars follows the text."""
    done = substring.remove_repeats(docs, as_words=False)
    new = {"text": F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")),
           "n_chars": F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long")).otherwise(F.col("n_chars"))}
    return done.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's pieces."""
    coded = pieces.encode(docs, pieces.load(public_tokenizers.path("piece_bpe_32k.model")))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


_made: list[str] = []  # scratch tables of the stage before, whose result is written when the next one starts


def _bounded(stage):
    """The stage, with batches of bounded size to Python workers and without the scratch tables of the stage before."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        release_paths(spark, _made)
        mark = scratch_mark()
        out = stage(spark, docs, sf_dir)
        _made[:] = scratch_since(mark)
        return out

    return run_stage


STAGES = [("quality_classifier", good_quality), ("minhash_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("mixing", mixture), ("sentencepiece", encoding)]
STAGES = [(name, _bounded(stage)) for name, stage in STAGES]

ORACLE_SQL = None  # learned scores, drawn samples and knapsacks are beyond SQL; tests hold stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
