"""Audit of records that arrive in batches: identities are counted across all of them.

A stored table (sources/stored.py) has a row for each identity: how many records have had it, and where the first one stands.
A batch is audited against it: a record is a possible duplicate where its identity occurs in the batch again or in any
batch before. The first record of an identity, approved in its day, becomes one too; those are named, so that any cut of
the records into batches ends with the statuses and notes of one audit of all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.operators.validate import REPEATED, audit_parts, merged_status
from rillstone.plans.rulebook import Rulebook
from rillstone.sources.scratch import written
from rillstone.sources.stored import StoredTable


def _summed(old, new):
    first = F.coalesce(old["first"], new["first"])
    n = F.coalesce(old["n"], F.lit(0)) + F.coalesce(new["n"], F.lit(0))
    return F.struct(n.cast("long").alias("n"), first.alias("first"))


def audit_batch(df: DataFrame, book: Rulebook, store: StoredTable, batch: str, row: str = "row_number") -> tuple[DataFrame, DataFrame]:
    """(audited, became): the batch's records as audit() gives them, with their batch, and (batch, row) of records of earlier
    batches whose identity was theirs alone until now. The batch's name makes the merge happen once: a batch that is tried
    again is judged against what stood before it."""
    rules, keyed = audit_parts(df, book)
    keyed = written(keyed.withColumn("_digest", F.unhex(F.sha2("_identity", 256))))
    own = keyed.groupBy("_digest").agg(F.count("*").alias("n"), F.min(F.col(row)).alias("_row"))
    own = written(own.select(F.col("_digest").alias("digest"), "n", F.struct(F.lit(batch).alias("batch"), F.col("_row").cast("string").alias("row")).alias("first")))
    held = _before(store, batch)
    store.merge(own, _summed, mark=batch)
    old = held.select("digest", F.col("n").alias("_before"), F.col("first").alias("_first")) if held is not None else own.limit(0).select("digest", F.col("n").alias("_before"), F.col("first").alias("_first"))
    counts = own.join(old, "digest", "left")
    repeated = counts.filter("n + coalesce(_before, 0) > 1").select(F.col("digest").alias("_digest"), F.lit(True).alias("_again"))
    became = counts.filter("_before = 1").select("_first.batch", F.col("_first.row").alias(row))
    flagged = keyed.join(repeated, "_digest", "left").withColumn("_again", F.coalesce("_again", F.lit(False)))
    return rules(flagged).drop("_digest").withColumn("batch", F.lit(batch)), became


def _before(store: StoredTable, batch: str) -> DataFrame | None:
    """The table as it was before the batch was merged; the last version where it has not been."""
    at = store.version()
    while at and batch in store.marks(at):
        at -= 1
    return store.read(at) if at else None


def with_later_duplicates(audited: DataFrame, became: DataFrame, book: Rulebook, row: str = "row_number") -> DataFrame:
    """Audited records of all batches, with the note and status of those that later batches made duplicates."""
    later = became.select("batch", F.col(row).alias("_row"), F.lit(True).alias("_later")).distinct()
    rows = audited.withColumn("_row", F.col(row).cast("string")).join(later, ["batch", "_row"], "left")
    told = F.col("_later").isNotNull() & ~F.array_contains("validation_notes", REPEATED)
    status = merged_status(book, [(F.col("validation_status") == s, s) for s in book.allowed_statuses] + [(F.lit(True), "needs_review")])
    return rows.withColumns({"validation_status": F.when(told, status).otherwise(F.col("validation_status")), "validation_notes": F.when(told, F.array_append("validation_notes", F.lit(REPEATED))).otherwise(F.col("validation_notes"))}).drop("_row", "_later")
