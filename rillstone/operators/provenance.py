"""Provenance that locates: a hash tree over ranges of keys, stored with the rows it covers.

A row's range is the head of its key's SHA-256, so ranges are even whatever the keys are. A leaf's digest is of the sums of its
rows' digests (their order is nothing to it), an inner node's of its children's; each level takes four bits more. Of two
stored tables the trees are compared from the top, and only children of nodes that differ are read; then only the ranges
that differ are read from the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators.release import row_digest, summed_digest

#: Hexadecimal digits of a range: 16 ** LEVELS ranges.
LEVELS = 2


def range_of(key: Column, levels: int = LEVELS) -> Column:
    return F.conv(F.substring(F.sha2(key.cast("string"), 256), 1, levels), 16, 10).cast("int")


def tree(ranged: DataFrame, columns: list[str], levels: int = LEVELS) -> DataFrame:
    """(level, node, n_rows, digest): the hash tree over the rows of ranged (range, *columns); ranges without rows have no node."""
    leaves = ranged.select("range", row_digest(ranged, columns).alias("d")).groupBy(F.col("range").alias("node")).agg(F.count("*").alias("n_rows"), F.sha2(summed_digest("d"), 256).alias("digest"))
    level = leaves.select(F.lit(levels).alias("level"), "node", "n_rows", "digest")
    made, below = level, level
    for k in range(levels - 1, -1, -1):
        children = F.array_sort(F.collect_list(F.struct("node", "digest")))  # 16 at most
        below = below.groupBy(F.shiftright("node", 4).alias("parent")).agg(F.sum("n_rows").alias("n_rows"), F.sha2(F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["node"], c["digest"])), ","), 256).alias("digest"))
        below = below.select(F.lit(k).alias("level"), F.col("parent").alias("node"), "n_rows", "digest")
        made = made.unionByName(below)
    return made


def store(df: DataFrame, key: str, path: str, levels: int = LEVELS) -> None:
    """Write rows by range, and their tree by level, under path."""
    df.withColumn("range", range_of(F.coalesce(F.col(key).cast("string"), F.lit("")), levels)).repartition("range").write.partitionBy("range").parquet(f"{path}/rows")
    written = df.sparkSession.read.schema(f"{_ddl(df)}, range int").parquet(f"{path}/rows")
    tree(written, df.columns, levels).coalesce(1).write.partitionBy("level").parquet(f"{path}/tree")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _nodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("node int, n_rows long, digest string, level int").parquet(f"{path}/tree")


def differing_ranges(spark: SparkSession, before: str, after: str, levels: int = LEVELS) -> list[int]:
    """The ranges in which two stored tables differ, found from the top of their trees."""
    nodes = [0]
    for level in range(levels + 1):
        of = lambda path: _nodes(spark, path).filter((F.col("level") == level) & F.col("node").isin(nodes)).select("node", "digest")  # noqa: B023, E731
        a, b = of(before).withColumnRenamed("digest", "a"), of(after).withColumnRenamed("digest", "b")
        changed = sorted(r["node"] for r in a.join(b, "node", "full").filter("not a <=> b").collect())  # 16 ** levels at most
        if not changed or level == levels:
            return changed
        nodes = [16 * n + c for n in changed for c in range(16)]
    return nodes


def changes(spark: SparkSession, before: str, after: str, key: str, columns: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(range, key, change): rows added, removed or changed between two stored tables, key null where it is; of rows that repeat a
    key, how often each occurs counts too. Reads the differing ranges and no others. columns: a table with the rows' columns."""
    found = differing_ranges(spark, before, after, levels)
    rows = lambda path: spark.read.schema(f"{_ddl(columns)}, range int").parquet(f"{path}/rows").filter(F.col("range").isin(found) if found else F.lit(False))
    of = lambda path, name: rows(path).select("range", F.col(key).alias("_key"), row_digest(columns, columns.columns).alias("d")).groupBy("range", "_key").agg(F.count("*").alias(f"n_{name}"), summed_digest("d").alias(name))
    a, b = of(before, "a"), of(after, "b")
    both = a.join(b, (a["range"] == b["range"]) & a["_key"].eqNullSafe(b["_key"]), "full").filter("not (a <=> b and n_a <=> n_b)")
    change = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed")
    return both.select(F.coalesce(a["range"], b["range"]).alias("range"), F.coalesce(a["_key"], b["_key"]).alias(key), change.alias("change"))
