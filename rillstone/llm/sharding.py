"""Size-tiered compaction of immutable shards under a versioned manifest.

Arrivals are appended as runs of small files. Runs of similar size (the same power of FANOUT) are merged, once FANOUT of
them have gathered, into a run of target-sized files. Each append or merge commits a whole new manifest: it is written
aside and renamed to manifest/<version>, which fails if another writer was first, so readers see either version whole.
Only DataFrame operations touch rows; the manifest (a line per run) is the driver's.

An append that finds its version taken reads the manifest again and commits after it; a merge does so too if the runs it
merged are still listed. Compaction ends when no tier holds FANOUT runs that may still grow: runs of at least the target
size in few files are final, and fewer than FANOUT small runs of a tier wait for further arrivals.

Defined cases: null values in any column are kept; a null arrival is an arrival of its own; empty arrivals add no run, an
empty table leaves a manifest without runs; repeated rows are all kept; values of any length are stored as they are;
columns of any name are stored, as an arrival's name is kept in the path under a name that no column has; a later arrival
may lack columns or have new ones, which are null where a shard has none. A column keeps the type it first had: numbers of a
narrower type are widened as they arrive, any other type is refused before a row is written, or, where another writer has
brought the column meanwhile, before the commit; the store stays as it was.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class VersionTaken(Exception):
    """Another writer has committed that version; it exists already."""


class TypeChanged(ValueError):
    """An arrival has a known column in a type that its values cannot be widened from."""


#: Types whose values are all values of the later ones.
WIDER = ["tinyint", "smallint", "int", "bigint"], ["float", "double"]


def widened(known: StructType, arriving: StructType) -> dict[str, str]:
    """Columns of an arrival that are widened to a known type. Raises TypeChanged where that would not do."""
    kinds, casts = {f.name: f.dataType.simpleString() for f in known}, {}
    for f in arriving:
        was, now = kinds.get(f.name), f.dataType.simpleString()
        if was is None or was == now:
            continue
        if not any(was in order and now in order and order.index(now) < order.index(was) for order in WIDER):
            raise TypeChanged(f"{f.name} is {was} in the store and {now} in the arrival")
        casts[f.name] = was
    return casts


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 << 20, fanout: int = 4):
        self.spark, self.root, self.target, self.fanout = spark, root.rstrip("/"), target_bytes, fanout
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.FileContext.getFileContext(self._path(root).toUri(), spark._jsc.hadoopConfiguration())
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._hadoop.Path(name)

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/manifest")
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def manifest(self, version: int | None = None) -> dict:
        found = self.versions()
        if not found:
            return {"version": 0, "schema": None, "runs": []}
        text = self.spark.read.text(f"{self.root}/manifest/{found[-1] if version is None else version}", wholetext=True).first()
        return json.loads(text["value"])

    def commit(self, before: dict, runs: list[dict], schema: str | None) -> dict:
        """Publish runs as the version after before. Raises VersionTaken if that version exists."""
        after = {"version": before["version"] + 1, "schema": schema or before["schema"], "runs": runs}
        aside, final = f"{self.root}/aside/{uuid.uuid4().hex}", self._path(f"{self.root}/manifest/{after['version']}")
        out = self._fs.create(self._path(aside), False)
        out.write(bytearray(json.dumps(after).encode()))
        out.close()
        self._fs.mkdirs(self._path(f"{self.root}/manifest"))
        rename = self._hadoop.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE  # never over an existing version
        try:
            self._files.rename(self._path(aside), final, options)
        except Py4JJavaError as failed:
            if "FileAlreadyExistsException" not in str(failed.java_exception.getClass()):
                raise
            raise VersionTaken(f"version {after['version']} exists") from failed
        return after

    def _publish(self, change: Callable[[list[dict]], list[dict] | None], schema: StructType | None = None) -> dict | None:
        """Commit what change makes of the last version's runs, again after each version that another writer commits first;
        nothing if change gives None. schema adds its new columns to those known."""
        while True:
            before = self.manifest()
            runs = change(before["runs"])
            if runs is None:
                return None
            known = self.schema(before)
            if widened(known, schema or StructType()):
                raise TypeChanged("another writer has brought a column in a wider type; append again")
            merged = StructType([*known, *(f for f in schema or () if f.name not in known.names)])
            try:
                return self.commit(before, runs, merged.json())
            except VersionTaken:
                continue

    @staticmethod
    def schema(manifest: dict) -> StructType:
        return StructType.fromJson(json.loads(manifest["schema"])) if manifest["schema"] else StructType()

    def _run(self, path: str, arrivals: int) -> dict | None:
        sizes = [s.getLen() for s in self._fs.listStatus(self._path(path)) if s.getPath().getName().startswith("part-")]
        return {"path": path, "bytes": int(sum(sizes)), "files": len(sizes), "arrivals": arrivals} if sizes else None

    def append(self, df: DataFrame, arrival: Column) -> dict:
        """Write df's rows as one run of small immutable shards for each value of arrival, all in one job. Raises TypeChanged."""
        casts = widened(self.schema(self.manifest()), df.schema)
        df = df.withColumns({c: F.col(f"`{c}`").cast(kind) for c, kind in casts.items()}) if casts else df
        path, label = f"{self.root}/runs/{uuid.uuid4().hex}", f"arrival_{uuid.uuid4().hex}"
        df.withColumn(label, arrival.cast("string")).write.option("compression", "zstd").partitionBy(label).parquet(path)
        folders = [s.getPath().toString() for s in self._fs.listStatus(self._path(path)) if s.isDirectory()]
        new = [r for f in sorted(folders) if (r := self._run(f, 1))]
        return self._publish(lambda runs: runs + new, df.schema)

    def tier(self, run: dict) -> int:
        return max(0, math.floor(math.log(max(run["bytes"], 1) / self.target, self.fanout)) + 20)

    def compact(self) -> list[dict]:
        """Merge tiers that have gathered FANOUT runs until none is left; the manifests committed, one for each round."""
        done = []
        while True:
            now = self.manifest()
            tiers: dict[int, list[dict]] = {}
            for run in now["runs"]:
                if run["bytes"] < self.target or run["files"] > 2 * math.ceil(run["bytes"] / self.target):
                    tiers.setdefault(self.tier(run), []).append(run)
            full = [runs for _, runs in sorted(tiers.items()) if len(runs) >= self.fanout]
            if not full:
                return done
            merged = [r for runs in full if (r := self._merge(runs, now["schema"]))]
            gone = {r["path"] for runs in full for r in runs}
            after = self._publish(lambda runs, gone=gone, merged=merged: [r for r in runs if r["path"] not in gone] + merged if gone <= {r["path"] for r in runs} else None)
            done += [after] if after else []

    def _merge(self, runs: list[dict], schema: str) -> dict | None:
        path = f"{self.root}/runs/{uuid.uuid4().hex}"
        files = max(1, math.ceil(sum(r["bytes"] for r in runs) / self.target))
        # Whole input splits are put together, so rows move no further than to the task that writes them.
        self._read([r["path"] for r in runs], schema).coalesce(files).write.option("compression", "zstd").parquet(path)
        return self._run(path, sum(r["arrivals"] for r in runs))

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        kind = StructType.fromJson(json.loads(schema))
        return self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)

    def read(self, version: int | None = None) -> DataFrame:
        now = self.manifest(version)
        return self._read([r["path"] for r in now["runs"]], now["schema"])

    def vacuum(self, grace_s: float = 86_400) -> int:
        """Delete the files of runs that the last manifest does not list and that are older than grace_s seconds, so that
        what other writers have not committed yet stays; the number of folders deleted."""
        before = 1000 * (time.time() - grace_s)
        tops = self._fs.listStatus(self._path(f"{self.root}/runs"))
        kept = [r["path"] for r in self.manifest()["runs"]]
        gone = 0
        for top in tops:
            inside = [s for s in self._fs.listStatus(top.getPath()) if s.isDirectory()]
            for s in inside or [top]:
                listed = any(k.endswith(s.getPath().toUri().getPath()) for k in kept)
                if not listed and s.getModificationTime() <= before:
                    gone += bool(self._fs.delete(s.getPath(), True))
        return gone


def shard_arrivals(df: DataFrame, root: str, arrival: Column, target_bytes: int = 128 << 20, fanout: int = 4) -> DataFrame:
    """Append df by arrival, compact, drop replaced runs; the rows of the last version. No other writer may use root."""
    store = ShardStore(df.sparkSession, root, target_bytes, fanout)
    store.append(df, F.coalesce(arrival.cast("string"), F.lit("__none")))
    store.compact()
    store.vacuum(0)
    return store.read()
