"""Record scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from rillstone.sources.array_scan import array_elements


def record_array(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Records of JSON array documents with file_path and position (load order); elements that are no objects go, a document
    that is no array is an error, or where not strict has no rows. One large file is read by many tasks."""
    each = array_elements(spark, path, strict).withColumn("_r", F.from_json("element", schema))
    return each.select("file_path", "position", "_r.*")


def record_array_or_empty(spark: SparkSession, path: str | None, schema: str) -> DataFrame:
    """The same, with no rows for an absent path or a document that is no array."""
    empty = spark.createDataFrame([], f"file_path string, position int, {schema}")
    if path is None:
        return empty
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return empty
    return record_array(spark, path, schema, strict=False)


def variant_records(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """(file_path, position, record): the same records as VARIANT, whatever fields each has."""
    return array_elements(spark, path, strict).select("file_path", "position", F.try_parse_json("element").alias("record")).filter("record is not null")


def field_names(records: DataFrame, *by: str, record: str = "record") -> DataFrame:
    """(*by, name, n): the field names that records really have, null fields too, and in how many records each is."""
    keys = [f"`{c}`" for c in by]
    each = records.sparkSession.sql(f"SELECT {', '.join(['e.key AS name', *keys])} FROM {{r}}, LATERAL variant_explode(`{record}`) AS e", r=records)
    return each.groupBy(*keys, "name").agg(F.count("*").alias("n"))


def typed(records: DataFrame, fields: dict[str, str], *keep: str, record: str = "record") -> DataFrame:
    """Columns of VARIANT records: fields by name with their types, null where a record lacks one or has another kind of value.
    A name may hold quotes of one kind, not of both."""
    path = lambda name: f'$["{name}"]' if "'" in name else f"$['{name}']"
    return records.select(*keep, *[F.try_variant_get(record, path(n), kind).alias(n) for n, kind in fields.items()])


def flat(df: DataFrame) -> DataFrame:
    """Nested values as JSON text."""
    nested = [f.name for f in df.schema if isinstance(f.dataType, ArrayType | MapType | StructType | VariantType)]
    return df.withColumns({c: F.to_json(f"`{c}`") for c in nested}) if nested else df


def write_csv(df: DataFrame, path: str) -> None:
    """One header per file over all columns, nested values as JSON text, '\\r\\n' line ends; nulls and '' alike empty."""
    flat(df).write.option("header", True).option("escape", '"').option("emptyValue", "").option("nullValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("lineSep", "\r\n").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines that keep nulls."""
    df.write.option("ignoreNullFields", False).json(path)


def write_by_status(audited: DataFrame, path: str) -> None:
    """approved, needs_review and rejected as partitions, in one pass."""
    audited.write.partitionBy("validation_status").parquet(path)


def write_twin(df: DataFrame, path: str) -> None:
    """The same rows as JSON lines and as CSV."""
    write_json(df, f"{path}/json")
    write_csv(df, f"{path}/csv")


def write_document(row: DataFrame, path: str) -> None:
    """A table of one row as one JSON document that keeps nulls."""
    write_json(row.coalesce(1), path)
