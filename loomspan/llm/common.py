"""Helpers shared by the operators: scratch tables, row keys and salted ranks."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The ASCII white space that separates words: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SPACE_CLASS = r"[\x20\x09-\x0D]"


def scratch_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder of ``spark.checkpoint.dir``.

    Unset, it is beside the warehouse where all runs on one machine (as in
    tests); on a cluster that folder could be any machine's own, so it raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{found.rstrip('/')}/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application staged; DataFrames that read it can't be used any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is planned and run within go when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back: computed once, and safe against lost executors."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one, ``row``, beside which any names are free."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")


def as_rows(df: DataFrame) -> DataFrame:
    """``df`` as one column ``row``; ``row.*`` gives it back."""
    return df.select(as_row(df))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(*columns: str) -> Column:
    """64 bits that tell rows with one id but another text apart."""
    return F.xxhash64(*[F.col(c) for c in columns])


#: Bytes of an Arrow batch on its way to Python, about; and of the rows that are Python objects at one time.
BATCH_BYTES = 4 << 20
SLICE_BYTES = 4 << 20
#: What empties the caches that a Python worker has built.
FORGET: list[Callable[[], None]] = []


def small_batches(spark: SparkSession) -> None:
    """Cut Arrow batches at a few MB, unless the session has a limit of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) == 64 << 20:  # as it is by default
        spark.conf.set(key, str(BATCH_BYTES))


def tidied(run):
    """``run`` over batches, after which the worker's caches are empty and its free memory is the system's again."""

    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for forget in FORGET:
                forget()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return wrapped


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of at most ``rows`` rows and about ``SLICE_BYTES``; a longer row is a part of its own."""
    at = 0
    while at < batch.num_rows:
        n = min(rows, batch.num_rows - at)
        while n > 1 and batch.slice(at, n).nbytes > SLICE_BYTES:
            n //= 2
        yield batch.slice(at, n)
        at += n


def map_batches(df: DataFrame, rows: Callable[[dict[str, list]], dict[str, list]], schema: T.StructType, slice_rows: int = 256) -> DataFrame:
    """``mapInArrow`` over column lists, a slice at a time so that long texts stay bounded in memory."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    small_batches(df.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, slice_rows):
                out = rows({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def salted_rank(df: DataFrame, group: list[str], order: list[Column], salt: Column, out: str) -> DataFrame:
    """0-based ranks within ``group`` without a task per group.

    ``salt`` cuts a group into parts that are ranked on their own; the sizes of
    the parts, one small row each, give where each part begins.
    """
    part = [F.col(c) for c in group] + [F.col("__salt")]
    df = df.withColumn("__salt", salt)
    sizes = df.groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inner = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*part).orderBy(*order)) - F.lit(1))
    joined = inner.join(starts, [*group, "__salt"])
    return joined.withColumn(out, (F.col("__start") + F.col("__rank")).cast("long")).drop("__salt", "__start", "__rank")
