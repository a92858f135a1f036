"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

Each stage works on all that the one before it kept, and what it decides takes
effect.  Defined cases, for every stage: a null text is a text without words, which
the first stage rejects; repeated rows are rows of their own until near-dedup keeps
one of them; ties go to the smaller doc_id, null ids last, then to the earlier row;
empty tables give empty tables; a text of any length is a row held whole by one task;
further columns pass through, whatever their names.

A stage's result reads tables that the stage wrote.  It is written and read again
before the next stage: that deletes the tables of the stages before it, unless its
``docs`` still read them.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.llm import decontamination, line_dedup, packing, quality_rules, simhash_dedup
from granary.llm.storage import cut, discard, drop, recorded

#: Folders that the last result of each stage reads.
_tables: dict[int, list[str]] = {}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the rules' posterior reject go, those without words among them."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of like lines of five words or more one occurrence stays; a text can become empty and stays a document."""
    return line_dedup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id stays; texts without words are one group."""
    return simhash_dedup.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more are benchmark passages go; texts without words stay."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left and their places in sequences; a text without words is its end token."""
    return packing.packed(docs)


def _stage(number: int, work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``work`` that records its tables and deletes those of earlier stages that nothing reads any more."""

    @functools.wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        earlier = [k for k in _tables if k < number and _tables[k]]
        if earlier:
            files = docs.inputFiles()
            for k in earlier:
                if not any(path in f for path in _tables[k] for f in files):
                    for path in _tables.pop(k):
                        drop(spark, path)
        with recorded() as paths:
            out = work(spark, docs, sf_dir)
        _tables[number] = paths
        return out

    return stage


STAGES = [
    (name, _stage(number, work))
    for number, (name, work) in enumerate(
        (
            ("quality rules", quality),
            ("line dedup", lines),
            ("simhash near-dedup", near_duplicates),
            ("benchmark decontamination", decontaminated),
            ("best-fit packing", packed),
        ),
        1,
    )
]
#: Votes, SimHash and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = cut(docs, f"stage{k}")
            if before is not None:
                discard(before)
            before = docs
    return docs
