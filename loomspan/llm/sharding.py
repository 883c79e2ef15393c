"""Operator 5: sharding with size-tiered compaction and a versioned manifest.

An arrival is appended as small immutable Parquet shards. Shards of one tier
(sizes within a factor of ``fan_in``) are merged once ``fan_in`` of them have
come together, into files of about the target size; all merges of a round are
one job. Every change ends with a new manifest, a small file that names the
live shards, put in its place by an atomic rename that fails if another writer
was first; readers see the manifest before or the one after.

An append that meets another writer's commit is tried again on top of it. Files
are deleted by :func:`ShardStore.vacuum` once no manifest that is kept names them
and they are older than a grace time, so that an append that is written but not
yet committed loses nothing.

Rows come through whole: nulls, empty or long texts, repeated rows and extra
columns, whatever their names, are kept as they are. Empty arrivals add a version
without shards.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_row

TARGET = 32 << 20
FAN_IN = 4
#: Seconds that a file without a manifest is kept, and how many manifests are.
GRACE, KEEP = 24 * 3600, 10


class Conflict(RuntimeError):
    """Another writer committed this version first."""


@dataclass(frozen=True)
class Shard:
    name: str
    size: int


class ShardStore:
    """Shards and manifests below ``path``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, target: int = TARGET, fan_in: int = FAN_IN):
        self.spark, self.path, self.target, self.fan_in = spark, path.rstrip("/"), target, fan_in
        self._jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._at = lambda name: self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        self._fs = self._at("").getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._at("").toUri(), conf)

    def versions(self) -> list[int]:
        if not self._fs.exists(self._at("manifests")):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at("manifests"))]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> list[Shard]:
        versions = self.versions()
        if not versions:
            return []
        stream = self._fs.open(self._at(f"manifests/v{versions[-1] if version is None else version:012d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Shard(**s) for s in json.loads(text)["shards"]]

    def commit(self, shards: list[Shard], after: int) -> int:
        """Make ``shards`` version ``after`` + 1, or raise :class:`Conflict`."""
        version = after + 1
        waiting = self._at(f"manifests/.{uuid.uuid4().hex}")
        self._fs.mkdirs(self._at("manifests"))
        stream = self._fs.create(waiting, False)
        stream.write(bytearray(json.dumps({"version": version, "shards": [vars(s) for s in shards]}).encode()))
        stream.close()
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            self._context.rename(waiting, self._at(f"manifests/v{version:012d}.json"), none)
        except Exception as e:
            self._fs.delete(waiting, False)
            if version in self.versions():
                raise Conflict(f"version {version}") from e
            raise
        return version

    def _last(self) -> int:
        return (self.versions() or [0])[-1]

    def _written(self, folder: str) -> list[Shard]:
        found, files = [], self._fs.listFiles(self._at(folder), True)
        root = self._fs.makeQualified(self._at("")).toString().rstrip("/") + "/"
        while files.hasNext():
            f = files.next()
            if f.getPath().getName().endswith(".parquet"):
                found.append(Shard(f.getPath().toString().removeprefix(root), f.getLen()))
        return sorted(found, key=lambda s: s.name)

    def append(self, rows: DataFrame, tries: int = 10) -> int:
        """Write an arrival as small shards and commit it, after whatever others commit meanwhile."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        own = self._written(folder)
        while True:
            after = self._last()
            try:
                return self.commit(self.manifest(after or None) + own, after)
            except Conflict:
                tries -= 1
                if not tries:
                    raise

    def tier(self, size: int) -> int:
        """0 for the smallest shards; the highest tier, from the target's half on, is never merged."""
        return max(0, math.floor(math.log(max(size, 1) / (self.target / 2)) / math.log(self.fan_in) + 12)) if size < self.target / 2 else 99

    def plan(self, shards: list[Shard], all_tiers: bool = False) -> list[list[Shard]]:
        """Runs to merge: shards of one tier, first-fit in order of size up to the target. ``all_tiers``: whatever is below the target."""
        tiers: dict[int, list[Shard]] = {}
        for s in shards:
            if (t := self.tier(s.size)) != 99:
                tiers.setdefault(0 if all_tiers else t, []).append(s)
        runs = []
        for own in tiers.values():
            if len(own) < (2 if all_tiers else self.fan_in):
                continue
            run, size = [], 0
            for s in sorted(own, key=lambda s: (s.size, s.name)):
                if run and size + s.size > self.target:
                    runs.append(run)
                    run, size = [], 0
                run.append(s)
                size += s.size
            runs.append(run)
        return [r for r in runs if len(r) > 1]

    def compact(self, all_tiers: bool = False) -> int:
        """One round of merges, all in one job; the version after it."""
        after = self._last()
        shards = self.manifest(after or None)
        runs = self.plan(shards, all_tiers)
        if not runs:
            return after
        # One file for each run, by a task of its own. The plan has a row per merged file and goes to all tasks only while small.
        files = self.spark.createDataFrame([(s.name, k) for k, run in enumerate(runs) for s in run], "name string, run int")
        root = self._fs.makeQualified(self._at("")).toString().rstrip("/") + "/"
        rows = self._read([s for run in runs for s in run])
        path = F.regexp_replace(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/"), "^" + root.replace(":///", ":/"), "")
        rows = rows.select(as_row(rows), path.alias("name")).join(files, "name")
        folder = f"data/{uuid.uuid4().hex}"
        rows.repartitionById(len(runs), "run").select("row.*").write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        gone = {s.name for run in runs for s in run}
        return self.commit([s for s in shards if s.name not in gone] + self._written(folder), after)

    def vacuum(self, grace: float = GRACE, keep: int = KEEP) -> int:
        """Delete manifests but the last ``keep``, and files that none of those names, older than ``grace`` seconds; how many files."""
        versions = self.versions()
        kept = versions[-max(1, keep) :]
        live = {s.name for v in kept for s in self.manifest(v)}
        for v in versions[: -max(1, keep)]:
            self._fs.delete(self._at(f"manifests/v{v:012d}.json"), False)
        before, gone = (time.time() - grace) * 1000, 0
        for s in self._written("data") if self._fs.exists(self._at("data")) else []:
            at = self._at(s.name)
            if s.name not in live and self._fs.getFileStatus(at).getModificationTime() <= before:
                gone += bool(self._fs.delete(at, False))
        return gone

    def _read(self, shards: list[Shard]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{s.name}" for s in shards])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, with ``_metadata`` of their shards."""
        return self._read(self.manifest(version))


def shard_report(docs: DataFrame, path: str, arrivals: int = 4, target: int = TARGET, fan_in: int = FAN_IN) -> DataFrame:
    """Append ``docs`` in ``arrivals`` parts, compacting after each and at the end; one row per document: doc_id, shard, shard_bytes, version."""
    store = ShardStore(docs.sparkSession, path, target, fan_in)
    for k in range(arrivals):
        store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(arrivals)) == k))
        store.compact()
        store.vacuum(0, 1)  # nobody else writes here
    version = store.compact(all_tiers=True)
    store.vacuum(0, 1)
    return store.read(version).select("doc_id", F.col("_metadata.file_name").alias("shard"), F.col("_metadata.file_size").alias("shard_bytes"), F.lit(version).cast("long").alias("version"))
