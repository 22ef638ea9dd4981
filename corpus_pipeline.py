"""From raw documents to packed training sequences, one written table per stage."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rejoinder.llm import toxicity
from rejoinder.llm.decontamination import drop_contaminated
from rejoinder.llm.frames import bound_batches, discard, saved
from rejoinder.llm.line_dedup import drop_lines, repeated_lines
from rejoinder.llm.near_dedup import drop_near_duplicates
from rejoinder.llm.packing import pack_documents
from rejoinder.session import forget_scratch, scratch_made


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_left: dict[str, list[str]] = {}


def _stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Bounds what a task holds of texts, and deletes what the stage before has written for itself: its output is written by now."""

    @functools.wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        forget_scratch(spark, _left.pop(sf_dir, []))
        before = set(scratch_made())
        result = work(spark, docs, sf_dir)
        _left[sf_dir] = [path for path in scratch_made() if path not in before]
        return result

    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    model = toxicity.train(docs.select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


@_stage
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go, and documents that nothing is left of."""
    return drop_lines(docs, repeated_lines(docs))


@_stage
def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the least id stays."""
    return drop_near_duplicates(docs)


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and the sequences they lie in."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Learned models and vocabularies have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = _table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
