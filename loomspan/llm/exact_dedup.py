"""Operator 4: exact dedup against immutable snapshots.

Texts are equal when identical after all characters of [\\x20\\x09-\\x0D] are
deleted. A snapshot is a table with one row per distinct text (SHA-256 digest,
best document, copies), cut into buckets by digest, and a static binary-fuse
filter for each bucket. An incoming batch is first grouped by digest on its
own; the filters screen its digests; what they let through joins the exact
bucket on the whole digest, and the bytes of the two texts are compared. Of
equal texts the row with the most code points, then the smallest doc_id stays.

Nulls: a null text counts as empty and empties are equal; a null doc_id sorts
after all others. Rows repeated with one doc_id and text: exactly one stays.
Empty tables give empty results. Extra columns are ignored by
:func:`dedup_report` and kept by :func:`dedup_filter`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import fuse
from .common import SPACES, as_rows, staged

#: Digests in a bucket, at most about: bounds a filter and the task that builds it.
BUCKET_KEYS = 500_000


def normal_text(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def digests(docs: DataFrame, batch: Column) -> DataFrame:
    """doc_id, n_chars, batch and the binary digest of each row, computed once."""
    rows = docs.select(F.col("doc_id"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"), batch.alias("batch"), F.unhex(F.sha2(normal_text(F.col("text")), 256)).alias("digest"))
    return staged(rows, "digests")


def group_texts(rows: DataFrame) -> DataFrame:
    """One row per distinct text of each batch; partial aggregation takes the weight off texts with many copies."""
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    return rows.groupBy("batch", "digest").agg(best.alias("best"), F.count(F.lit(1)).alias("copies"))


def _keyed(groups: DataFrame, buckets: int) -> DataFrame:
    # The first 8 bytes of the digest as a key, the bucket from the next 4.
    key = F.conv(F.hex(F.substring("digest", 2, 7)), 16, 10).cast("long")
    bucket = F.conv(F.hex(F.substring("digest", 10, 4)), 16, 10).cast("long") % buckets
    return groups.withColumn("key", key).withColumn("bucket", bucket.cast("int"))


def build_filters(snapshot: DataFrame) -> DataFrame:
    """One binary-fuse filter per bucket of the snapshot."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "filter": [fuse.build(pdf["key"].to_numpy())]})

    return snapshot.select("bucket", "key").groupBy("bucket").applyInPandas(build, "bucket int, filter binary")


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """``incoming`` (bucket, key, digest) with ``seen``: what its bucket's filter says."""

    def ask(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        seen = fuse.contains(right["filter"].iloc[0], left["key"].to_numpy()) if len(right) else np.zeros(len(left), bool)
        return pd.DataFrame({"digest": left["digest"], "seen": seen})

    rows = incoming.select("bucket", "key", "digest")
    return rows.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(ask, "digest binary, seen boolean")


def same_bytes(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The digests of ``pairs`` (digest, doc ids of both sides) whose two texts differ in their bytes."""
    sides = pairs.select("digest", F.explode(F.array("old_id", "new_id")).alias("doc_id")).distinct()
    texts = docs.select("doc_id", F.unhex(F.sha2(normal_text(F.col("text")), 256)).alias("digest"), normal_text(F.col("text")).alias("text"))
    held = texts.alias("t").join(sides.alias("s"), (F.col("t.digest") == F.col("s.digest")) & F.col("t.doc_id").eqNullSafe(F.col("s.doc_id")), "left_semi")
    return held.groupBy("digest").agg(F.min("text").alias("a"), F.max("text").alias("b")).where(F.col("a") != F.col("b")).select("digest")


def dedup_report(docs: DataFrame, batch: Column | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    ``batch`` is 0 for rows of the snapshot and 1 for incoming rows; by default
    a hash of doc_id deals the rows out, about half to each.
    """
    rows = digests(docs, batch if batch is not None else F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))
    groups = group_texts(rows)
    buckets = 1 + rows.count() // BUCKET_KEYS
    groups = staged(_keyed(groups, buckets), "groups")
    old, new = groups.where("batch = 0"), groups.where("batch = 1")
    positive = screen(new, build_filters(old)).where("seen").select("digest")
    met = new.join(positive, "digest", "left_semi").select("digest", F.col("best.doc_id").alias("new_id")).join(old.select("digest", F.col("best.doc_id").alias("old_id")), "digest")
    met = staged(met, "met")
    differ = same_bytes(docs, met)
    # A digest stands for one text, unless the bytes differ: then each batch has its own.
    joined = groups.join(met.join(differ, "digest", "left_anti").select("digest", F.lit(True).alias("met")), "digest", "left")
    joined = joined.withColumn("variant", F.when(F.col("met"), F.lit(-1)).otherwise(F.col("batch")))
    whole = joined.groupBy("digest", "variant").agg(F.min("best").alias("keep"), F.sum("copies").alias("group_size"), F.collect_set("batch").alias("batches"))
    final = whole.select("digest", F.explode("batches").alias("batch"), F.col("keep.doc_id").alias("keep_id"), (-F.col("keep.less")).alias("keep_chars"), "group_size")
    out = rows.join(final, ["digest", "batch"])
    # Repeated rows of the document that stays: the first one stays.
    again = Window.partitionBy("digest", "doc_id", "n_chars").orderBy(F.lit(0))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    out = out.withColumn("kept", stays & (F.row_number().over(again) == 1))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"), F.col("n_chars").alias("text_chars"))


def dedup_filter(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct text, with all their columns."""
    kept = dedup_report(docs).where("kept").select("doc_id", F.col("text_sha256").alias("sha"), F.col("text_chars").alias("chars"))
    text = F.col("row")["text"]
    rows = as_rows(docs).withColumns({"id": F.col("row")["doc_id"], "digest": F.sha2(normal_text(text), 256), "length": F.length(F.coalesce(text, F.lit("")))})
    same = rows["id"].eqNullSafe(kept["doc_id"]) & (rows["digest"] == kept["sha"]) & (rows["length"] == kept["chars"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["id", "digest", "length"]).select("row.*")


def add_snapshot(docs: DataFrame, path: str, version: int, known: list[str] | None = None) -> DataFrame:
    """Screen a batch against the snapshots at ``known``, write what is new under ``path`` and return it.

    Each snapshot is two tables, ``texts`` and ``filters``, never changed once
    written; so screening costs one filter lookup per digest and snapshot.
    """
    spark = docs.sparkSession
    rows = digests(docs, F.lit(1))
    buckets = 1 + rows.count() // BUCKET_KEYS
    fresh = staged(_keyed(group_texts(rows), buckets), "batch")
    for old in known or []:
        texts, filters = spark.read.parquet(f"{old}/texts"), spark.read.parquet(f"{old}/filters")
        kinds = spark.read.parquet(f"{old}/meta").first()["buckets"]
        positive = screen(_keyed(fresh.drop("key", "bucket"), kinds), filters).where("seen").select("digest")
        fresh = staged(fresh.join(texts.join(positive, "digest", "left_semi"), "digest", "left_anti"), "batch")
    at = f"{path}/v{version}"
    fresh.write.parquet(f"{at}/texts")
    build_filters(fresh).write.parquet(f"{at}/filters")
    spark.createDataFrame([(buckets, version)], "buckets int, version int").write.parquet(f"{at}/meta")
    return spark.read.parquet(f"{at}/texts")


