"""Tables written once to the shared scratch folder, to cut lineage and survive lost executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scratch_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder of ``spark.checkpoint.dir``.

    Unset, it is beside the warehouse where all runs on one machine; on a
    cluster that folder could be any machine's own, so it raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/scratch"
    return f"{found.rstrip('/')}/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Delete what this application wrote here; DataFrames that read it can't be used any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, which the optimizer knows: unions and joins with it cost nothing."""
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in T.StructType.fromDDL(schema))
    return spark.sql(f"SELECT {columns} WHERE false")


def small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of plain values as a table whose size the optimizer knows, so that joins with it deal out nothing."""
    if len(rows) > 1000:
        return spark.createDataFrame(rows, schema)
    if not rows:
        return empty(spark, schema)
    told = lambda v: "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    columns = ", ".join(f"CAST(c{k} AS {f.dataType.simpleString()}) AS `{f.name}`" for k, f in enumerate(T.StructType.fromDDL(schema).fields))
    names = ", ".join(f"c{k}" for k in range(len(rows[0])))
    return spark.sql(f"SELECT {columns} FROM VALUES {', '.join('(' + ', '.join(map(told, r)) + ')' for r in rows)} AS t({names})")
