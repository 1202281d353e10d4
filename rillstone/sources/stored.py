"""Keyed tables kept by merging: bucketed by key, one row for each key, a new version for each merge.

A merge joins the last version with the new rows, which alone are shuffled, and writes buckets again as they came. Joining such a
table on its key moves only the other side: choose at least as many buckets as shuffle partitions. Versions are published
one by one (commits.py): of two writers one finds its version taken and merges again; readers keep the version they read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.sources import commits

Merge = Callable[[Column, Column], Column]


def newest(old: Column, new: Column) -> Column:
    """The new row where there is one."""
    return F.coalesce(new, old)


class StoredTable:
    """Rows (key, ...) under root; key is a column of any type that can be bucketed, null keys are left out."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64) -> None:
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets

    def version(self) -> int:
        found = [int(n) for n in commits.names(self.spark, f"{self.root}/versions") if n.isdigit()]
        return max(found, default=0)

    def _state(self, version: int) -> dict | None:
        return commits.document(self.spark, f"{self.root}/versions/{version}") if version else None

    def marks(self, version: int | None = None) -> list[str]:
        """Names of the merges that a version holds."""
        state = self._state(self.version() if version is None else version)
        return state["marks"] if state else []

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, the last by default; None before the first merge."""
        state = self._state(self.version() if version is None else version)
        if not state:
            return None
        if not self.spark.catalog.tableExists(state["table"]):
            self.spark.sql(f"CREATE TABLE {state['table']} ({state['columns']}) USING parquet CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {state['buckets']} BUCKETS LOCATION '{state['path']}'")
        return self.spark.table(state["table"])

    def merge(self, rows: DataFrame, how: Merge = newest, mark: str | None = None) -> int:
        """Merge rows, at most one for each key, into the last version; how gives the row of a key from the old and the new
        one (structs without the key; null where there is none). A mark that is held already changes nothing, so a merge
        can be tried again. The version that holds the rows."""
        while True:
            at = self.version()
            state = self._state(at)
            if mark is not None and state and mark in state["marks"]:
                return at
            new = rows.filter(F.col(self.key).isNotNull())
            names = [c for c in new.columns if c != self.key]
            old = self.read(at)
            if old is None:
                merged = new.select(self.key, how(F.lit(None).cast(new.select(F.struct(*names)).schema[0].dataType), F.struct(*names)).alias("_r"))
            else:
                a = old.select(self.key, F.struct(*names).alias("_old"))
                b = new.select(self.key, F.struct(*names).alias("_new"))
                merged = a.join(b, self.key, "full").select(self.key, how(F.col("_old"), F.col("_new")).alias("_r"))
            made = merged.select(self.key, "_r.*")
            table, path = f"stored_{uuid.uuid4().hex}", f"{self.root}/data/{uuid.uuid4().hex}"
            made.repartition(self.buckets, self.key).write.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", path).format("parquet").saveAsTable(table)
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema)
            try:
                commits.publish(self.spark, f"{self.root}/versions/{at + 1}", {"table": table, "path": path, "columns": columns, "buckets": self.buckets, "marks": [*(state["marks"] if state else []), *([mark] if mark else [])]})
            except commits.Taken:
                self.spark.sql(f"DROP TABLE {table}")
                commits.delete(self.spark, path)
                continue
            return at + 1
