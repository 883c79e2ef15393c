"""The knowledge base as tables, the lookup cache, and how both persist."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import WIKI
from ..scratch import empty

LOOKUP = "iri string, id string, kind string, datatype string"
SCHEMAS = {
    "entities": "id string, kind string, datatype string",
    "terms": "id string, kind string, lang string, value string",
    "claims": f"guid string, subject_id string, pid string, datatype string, value {WIKI}, value_key string, rank string, snaktype string",
    "qualifiers": f"guid string, pid string, value {WIKI}",
    "references": f"guid string, ref_hash string, snaks array<struct<pid:string,value:{WIKI}>>",
}


#: Parts of a table from which on a write makes one of them.
PARTS = 16


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place whole: readers see the one before or this one."""
    jvm = spark.sparkContext._jvm
    at, fs = _hadoop(spark, path)
    beside, _ = _hadoop(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(beside, at, how)


def get_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it isn't there."""
    at, fs = _hadoop(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass
class Store:
    """kb tables; every operation returns a new store and leaves this one as it is.

    On disk a table is the parts that the file ``current`` names. A run adds
    parts with what is new and then puts a new ``current`` in place, so a run
    that breaks off leaves the store as it was.
    """

    entities: DataFrame
    terms: DataFrame
    claims: DataFrame
    qualifiers: DataFrame
    references: DataFrame
    #: Rows added since the store was read from ``origin``; without an origin all rows are new.
    added: dict[str, tuple[DataFrame, ...]] = field(default_factory=dict, repr=False)
    origin: str | None = None

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in SCHEMAS}

    @classmethod
    def empty(cls, spark: SparkSession) -> Store:
        return cls(**{k: empty(spark, s) for k, s in SCHEMAS.items()})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Store:
        """The store at ``path``; tables that aren't there are empty."""
        parts = json.loads(get_text(spark, f"{path}/current") or "{}")

        def read(name: str) -> DataFrame:
            own = parts.get(name)
            return spark.read.schema(SCHEMAS[name]).parquet(*[f"{path}/{p}" for p in own]) if own else empty(spark, SCHEMAS[name])

        return cls(**{k: read(k) for k in SCHEMAS}, origin=path)

    def append(self, **more: DataFrame) -> Store:
        added = {k: (*self.added.get(k, ()), *((more[k],) if k in more else ())) for k in SCHEMAS}
        return replace(self, **{k: getattr(self, k).unionByName(df) for k, df in more.items()}, added=added)

    def delta(self, before: Store) -> dict[str, DataFrame]:
        """Rows that are here and weren't in ``before``."""
        return {k: df.exceptAll(before.tables[k]) for k, df in self.tables.items()}

    def write(self, path: str) -> None:
        """Add what is new since the store was read from ``path``; a store from elsewhere is written whole, as is a table of many parts."""
        spark = self.entities.sparkSession
        parts = json.loads(get_text(spark, f"{path}/current") or "{}") if self.origin == path else {}
        for name, df in self.tables.items():
            own = parts.get(name, [])
            if own and not self.added.get(name):
                continue
            whole = not own or len(own) >= PARTS
            rows = df if whole else reduce(DataFrame.unionByName, self.added[name])
            if not whole and rows.isEmpty():
                continue
            part = f"{name}-{uuid.uuid4().hex}"
            rows.write.parquet(f"{path}/{part}")
            parts[name] = [part] if whole else [*own, part]
        put_text(spark, f"{path}/current", json.dumps(parts))

    @staticmethod
    def vacuum(spark: SparkSession, path: str, grace: float = 24 * 3600) -> int:
        """Delete parts below ``path`` that the store doesn't name, older than ``grace`` seconds; how many."""
        live = {p for own in json.loads(get_text(spark, f"{path}/current") or "{}").values() for p in own}
        at, fs = _hadoop(spark, path)
        before, gone = (time.time() - grace) * 1000, 0
        for f in fs.listStatus(at) if fs.exists(at) else []:
            name = f.getPath().getName()
            if name != "current" and name not in live and f.getModificationTime() <= before:
                gone += bool(fs.delete(f.getPath(), True))
        return gone

    # Reads that a remote store would answer --------------------------------

    def existing(self, ids: DataFrame) -> DataFrame:
        """Those of ``ids`` (id) that exist."""
        return ids.join(self.entities.select("id"), "id", "left_semi")

    def claims_of(self, ids: DataFrame) -> DataFrame:
        return self.claims.join(ids.select(F.col("id").alias("subject_id")), "subject_id", "left_semi")

    def search(self, label: str, language: str, kind: str = "item") -> DataFrame:
        """Ids whose label or alias is ``label``, whatever its case."""
        same = (F.lower(F.trim("value")) == label.strip().lower()) & (F.col("lang") == language) & F.col("kind").isin("label", "alias")
        return self.terms.where(same).select("id").distinct().join(self.entities.where(F.col("kind") == kind).select("id"), "id", "left_semi")

    def delete(self, ids: DataFrame) -> Store:
        """Without the entities ``ids`` (id) and all that hangs on them."""
        gone = ids.select("id").distinct()
        claims = self.claims.join(gone.withColumnRenamed("id", "subject_id"), "subject_id", "left_anti").select(*self.claims.columns)
        live = claims.select("guid")
        keep = lambda df: df.join(live, "guid", "left_semi")
        return Store(self.entities.join(gone, "id", "left_anti"), self.terms.join(gone, "id", "left_anti"), claims, keep(self.qualifiers), keep(self.references))

    def delete_range(self, spark: SparkSession, letter: str, start: int, end: int) -> tuple[Store, int, int]:
        """Without ``letter`` start to end, both included; how many were deleted and how many didn't exist."""
        if start > end:
            raise ValueError(f"{start} is after {end}")
        ids = spark.range(start, end + 1).select(F.concat(F.lit(letter), F.col("id").cast("string")).alias("id"))
        there = self.existing(ids).count()
        return self.delete(ids), there, end - start + 1 - there


def load_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The lookup cache: Parquet, or JSON with the sections items and properties; empty if it isn't there.

    JSON is the small form for exchange, read on the driver; large caches are Parquet.
    """
    if path.endswith(".json"):
        found = json.loads(get_text(spark, path) or "{}")
        items = [(iri, i, "item", None) for iri, i in found.get("items", {}).items()]
        properties = [(iri, p["id"], "property", p.get("datatype")) for iri, p in found.get("properties", {}).items()]
        return spark.createDataFrame(items + properties, LOOKUP)
    folder = get_text(spark, f"{path}.current")
    return spark.read.schema(LOOKUP).parquet(folder) if folder else empty(spark, LOOKUP)


def save_lookup(lookup: DataFrame, path: str) -> None:
    """Items and properties; JSON keeps all characters as they are and is meant for small graphs. Either is put in place whole."""
    spark = lookup.sparkSession
    if not path.endswith(".json"):
        folder = f"{path}-{uuid.uuid4().hex}"
        lookup.write.parquet(folder)
        put_text(spark, f"{path}.current", folder)
        return
    sections: dict[str, dict] = {"items": {}, "properties": {}}
    for r in lookup.orderBy("iri").toLocalIterator():
        if r["kind"] == "item":
            sections["items"][r["iri"]] = r["id"]
        else:
            sections["properties"][r["iri"]] = {"id": r["id"], "datatype": r["datatype"]}
    put_text(spark, path, json.dumps(sections, ensure_ascii=False, indent=2))


def evict_stale(lookup: DataFrame, store: Store) -> DataFrame:
    """The lookup without ids that the store no longer has."""
    return lookup.join(store.entities.select("id"), "id", "left_semi").select("iri", "id", "kind", "datatype")
