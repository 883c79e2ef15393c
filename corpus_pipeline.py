"""A corpus pipeline of five stages; each works on all that the one before it kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, the first four with the columns of ``documents``. The
last stage's packing isn't expressible in SQL, so ``ORACLE_SQL`` is None and
the tests hold the pipeline against a brute-force version.

Every stage handles nulls in any column (a null text is empty and fails the
quality rules, a null source is a source of its own, a null doc_id an id above
all others), empty and very long texts, ties (the least id or the hash decides),
repeated rows (one of them stays), empty tables (empty results), and extra
columns of any name, which all but the last stage return as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomspan.llm.common import staged, table
from loomspan.llm.exact_dedup import dedup_filter
from loomspan.llm.mixing import mix
from loomspan.llm.ngram_join import near_filter
from loomspan.llm.packing import pack
from loomspan.llm.quality import quality_filter


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_filter(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each exact text."""
    return dedup_filter(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates: five words to a shingle, similarity of at least 0.8."""
    return near_filter(docs, size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written as Parquet and reread for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, f"stage{k}")
    return docs
