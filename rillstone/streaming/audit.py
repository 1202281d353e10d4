"""Audit of record files as they arrive: rules run per micro-batch, identities are counted within it, or across all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from rillstone.operators.batches import audit_batch
from rillstone.operators.validate import audit
from rillstone.plans.rulebook import Rulebook
from rillstone.sources.stored import StoredTable


def audit_stream(spark: SparkSession, source: str, schema: str, book: Rulebook, sink: str, checkpoint: str, store: StoredTable | None = None, row: str = "row_number", max_files: int | None = None) -> StreamingQuery:
    """Read JSON-lines records from source, write audited records by status to sink; ends when all files are read.

    With a store of identities (operators/batches.py) a record is a duplicate of those of any earlier batch too, and
    sink-became names the (batch, row) of earlier records that have become one. Both are written by epoch, and a batch that
    is tried again writes and counts the same.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        if store is None:
            audit(batch, book).write.mode("overwrite").partitionBy("validation_status").parquet(f"{sink}/epoch={epoch}")
            return
        own = StoredTable(batch.sparkSession, store.root, store.key, store.buckets)
        audited, became = audit_batch(batch, book, own, f"epoch{epoch}", row)
        audited.write.mode("overwrite").partitionBy("validation_status").parquet(f"{sink}/epoch={epoch}")
        became.write.mode("overwrite").parquet(f"{sink}-became/epoch={epoch}")

    read = spark.readStream.schema(schema)
    read = read.option("maxFilesPerTrigger", max_files) if max_files else read
    return read.json(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
