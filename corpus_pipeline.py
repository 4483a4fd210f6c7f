"""Corpus pipeline over `documents`: quality rules, near and exact repeats, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; run() writes each stage's
result and reads it back for the next. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curlew.llm._common import store, table
from curlew.llm.decontaminate import decontaminate
from curlew.llm.near_dups import near_dedup
from curlew.llm.packing import best_fit_pack
from curlew.llm.quality import quality_filter
from curlew.llm.repeats import drop_repeats
from curlew.llm.tokens import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own rules and their host's verdict keep."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of its five-word shingles."""
    return near_dedup(docs, 5, 80)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 50 bytes that a smaller doc_id has too."""
    return drop_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of the documents in sequences of 2048 tokens."""
    return best_fit_pack(docs, vocabulary("byte_bpe_50k.json"), end_id=0)


STAGES = [("quality rules", quality), ("minhash near-dedup", near_duplicates), ("suffix-array dedup", repeated_strings), ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

#: Signatures, tiling and packing can't be said in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    last = STAGES[-1][0]
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != last:
            docs = store(docs, name.replace(" ", "-")).df
    return docs
