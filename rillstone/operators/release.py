"""Release: gates, tables published as one, inventory, completeness and provenance hashes.

The tables of a release are written aside; its manifest is published last, under a name that must not exist yet. A release is what
has a manifest: a writer that dies half-way leaves files that nobody lists, and of two writers of one tag one is refused.
"""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions.fields import present
from rillstone.sources import commits
from rillstone.sources.records import write_csv, write_json

# Fixed values.
REQUIRED_PATHS = ["api/validated_rows.json", "api/analytics_summary.json", "api/publication_payload.json", "release_manifest.json", "README.md"]
OPTIONAL_PATHS = ["api/context_manifest.json", "api/enriched_rows.json", "reports/pollutant_summary.csv", "reports/matrix_summary.csv", "reports/geography_summary.csv", "site_index.json", "release_notes.md", "public_api_schema.json"]
REQUIRED_MANIFEST_FIELDS = ["release_tag", "generated_at", "bundle_root", "copied_artifacts"]
PUBLISHED_FIELDS = ["paper_title", "doi", "validation_status"]


def release_rows(audited: DataFrame) -> DataFrame:
    return audited.filter(F.col("validation_status") == "approved")


def gate(rows: DataFrame) -> DataFrame:
    """One row: how many rows are not approved, and whether the gate is passed."""
    return rows.agg(F.count_if(~F.coalesce(F.col("validation_status") == "approved", F.lit(False))).alias("not_approved")).withColumn("passed", F.col("not_approved") == 0)


def exclusions(audited: DataFrame) -> DataFrame:
    """(validation_status, note, n): why rows are left out."""
    rows = audited.filter(F.col("validation_status") != "approved")
    return rows.select("validation_status", F.explode("validation_notes").alias("note")).groupBy("validation_status", "note").agg(F.count("*").alias("n"))


def completeness(inventory: DataFrame) -> DataFrame:
    """(path, kind, present) of the contract's paths. inventory: (path), as inventory() lists those of a release."""
    spark = inventory.sparkSession
    paths = spark.createDataFrame([(p, "required") for p in REQUIRED_PATHS] + [(p, "optional") for p in OPTIONAL_PATHS], "path string, kind string")
    got = inventory.select("path").distinct().withColumn("present", F.lit(True))
    return paths.join(got, "path", "left").withColumn("present", F.coalesce("present", F.lit(False)))


def missing_manifest_fields(manifest: dict) -> list[str]:
    """The required fields that a manifest lacks or has no value for."""
    return [f for f in REQUIRED_MANIFEST_FIELDS if manifest.get(f) in (None, "", [], {})]


def nonconforming(rows: DataFrame) -> DataFrame:
    """(field, n): how many rows lack a published field."""
    lacks = [F.struct(F.lit(f).alias("field"), present(rows, f).isNull().cast("long").alias("n")) for f in PUBLISHED_FIELDS]
    return rows.select(F.inline(F.array(*lacks))).groupBy("field").agg(F.sum("n").alias("n"))


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 of a row: its values in order of column names, nulls as \\N, divided by the unit separator."""
    nested = {f.name for f in df.schema if f.dataType.typeName() in ("array", "map", "struct", "variant")}
    text = lambda c: F.to_json(F.col(f"`{c}`")) if c in nested else F.col(f"`{c}`").cast("string")
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(text(c), F.lit("\\N")) for c in sorted(columns)]), 256)


def summed_digest(digest: str) -> Column:
    """An aggregate that the rows' order doesn't change: four sums, each of 15 hexadecimal digits of their digests."""
    pieces = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
    return F.concat_ws("-", *[F.coalesce(F.sum(p), F.lit(0)).cast("decimal(38,0)").cast("string") for p in pieces])


def provenance_hash(df: DataFrame) -> DataFrame:
    """One row: n_rows, and a hash of all rows that their order doesn't change."""
    return df.select(row_digest(df, df.columns).alias("d")).agg(F.count("*").alias("n_rows"), summed_digest("d").alias("hash"))


def _write(df: DataFrame, name: str, path: str) -> int:
    """Write a table in the form its name asks for; the number of rows, as they are read back."""
    spark = df.sparkSession
    if name.endswith(".csv"):
        write_csv(df, path)
    elif name.endswith(".json"):
        df.coalesce(1).write.text(path) if df.columns == ["document"] else write_json(df, path)
    elif name.endswith(".md"):
        df.coalesce(1).write.text(path)
    else:
        df.write.mode("errorifexists").parquet(path)
        return spark.read.parquet(path).count()
    lines = spark.read.option("lineSep", "\r\n").option("header", True).csv(path) if name.endswith(".csv") else spark.read.text(path)
    return lines.count()


def publish(root: str, tag: str, tables: dict[str, DataFrame | None], **facts: object) -> DataFrame:
    """Write tables and publish them as the release root/tag, all or none; its inventory. Refuses records that are not approved,
    and a tag that is taken. A table's name ends in .json, .csv or .md, or it is stored as Parquet; None is an absent one."""
    spark = next(df.sparkSession for df in tables.values() if df is not None)
    for name, df in tables.items():
        if df is not None and "validation_status" in df.columns and not gate(df).first()["passed"]:
            raise ValueError(f"{name} holds rows that are not approved")
    bundle = f"{root}/{tag}/data/{uuid.uuid4().hex}"
    counts = {name: _write(df, name, f"{bundle}/{name}") for name, df in tables.items() if df is not None}
    manifest = {"release_tag": tag, "generated_at": datetime.now(UTC).isoformat(), "bundle_root": bundle, "copied_artifacts": {name: f"{bundle}/{name}" if name in counts else None for name in tables}, "n_rows": counts} | facts
    commits.publish(spark, f"{root}/{tag}/release_manifest.json", manifest)
    return inventory(spark, manifest)


def manifest_of(spark: SparkSession, root: str, tag: str) -> dict | None:
    """The manifest of a release; None where there is no such release, whatever files there are."""
    name = f"{root}/{tag}/release_manifest.json"
    return commits.document(spark, name) if commits.exists(spark, name) else None


def inventory(spark: SparkSession, manifest: dict) -> DataFrame:
    """(name, path, present, n_rows) of the artifacts that a manifest lists."""
    rows = [(name, path, path is not None, manifest["n_rows"].get(name)) for name, path in manifest["copied_artifacts"].items()]
    return spark.createDataFrame(rows, "name string, path string, present boolean, n_rows long")


def released_paths(spark: SparkSession, root: str, tag: str) -> DataFrame:
    """(path): what a release holds of the contract's paths, its manifest included; nothing where there is no release."""
    manifest = manifest_of(spark, root, tag)
    if manifest is None:
        return spark.createDataFrame([], "path string")
    listed = inventory(spark, manifest).filter("present").select(F.col("name").alias("path"))
    return listed.unionByName(spark.createDataFrame([("release_manifest.json",)], "path string"))


#: Names of a bundle's tables by what they are; fixed values.
ENDPOINTS = {"validated_rows": "api/validated_rows.json", "analytics_summary": "api/analytics_summary.json", "context_manifest": "api/context_manifest.json", "enriched_rows": "api/enriched_rows.json"}
REPORTS = {"pollutants": "reports/pollutant_summary.csv", "matrices": "reports/matrix_summary.csv", "geographies": "reports/geography_summary.csv"}


def publish_bundle(root: str, tag: str, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Publish tables under the contract's paths, with the documents that point to them: publication payload, site index, public
    schema, notes and readme; the inventory of all."""
    spark = next(df.sparkSession for df in tables.values() if df is not None)
    there = {n for n, df in tables.items() if df is not None}
    of = lambda paths: {k: p if p in there else None for k, p in paths.items()}
    schema = {n: {f.name: f.dataType.simpleString() for f in df.schema} for n, df in tables.items() if df is not None}
    one = lambda text: spark.createDataFrame([(text,)], "value string")
    listed = [f"- {n}: {'included' if n in there else 'not included'}" for n in sorted(tables)]
    documents = {
        "api/publication_payload.json": _document(spark, {"release_tag": tag, "assets": of(ENDPOINTS)}),
        "site_index.json": _document(spark, {"release_tag": tag, "title": "publication bundle", "api": of(ENDPOINTS), "reports": of(REPORTS)}),
        "public_api_schema.json": _document(spark, schema),
        "release_notes.md": one("\n".join([f"# Release notes: {tag}", "", *listed])),
        "README.md": one("\n".join([f"# {tag}", "", "Rows that passed the audit, and tables made of them. `release_manifest.json` lists what this release holds."])),
    }
    return publish(root, tag, tables | documents, api_endpoints=of(ENDPOINTS))


def _document(spark: SparkSession, content: dict) -> DataFrame:
    return spark.createDataFrame([(json.dumps(content, ensure_ascii=False),)], "document string")
