"""Landed service payloads, flattened to dimension rows. A malformed or foreign payload gives no row; landed() keeps it apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions.keys import doi, dois_in_text, first_year

_DATE = "struct<`date-parts`: array<array<int>>>"
WORKS_A = f"message struct<DOI: string, title: array<string>, `container-title`: array<string>, publisher: string, type: string, `is-referenced-by-count`: int, author: array<struct<family: string>>, `published-print`: {_DATE}, `published-online`: {_DATE}, created: {_DATE}, URL: string>"
WORKS_B = "id string, doi string, ids struct<doi: string>, title string, publication_year int, cited_by_count int, primary_location struct<source: struct<display_name: string>>, open_access struct<is_oa: boolean, oa_status: string>, concepts array<struct<display_name: string>>, authorships array<struct<institutions: array<struct<display_name: string>>>>"
INDICATOR = "array<struct<country: struct<value: string>, indicator: struct<value: string>, date: string, value: double>>"
MAX_CONCEPTS, MAX_INSTITUTIONS = 5, 10


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, value): a document per file. The files' order is that of file_path: where the last one wins, it is the
    load order given to context.last_row(); nothing needs all of them sorted."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file_path"), "value")


def _works_a(docs: DataFrame) -> DataFrame:
    return docs.withColumn("m", F.from_json("value", WORKS_A)["message"]).withColumn("_good", F.col("m").isNotNull())


def _rows_a(parsed: DataFrame, *keep: str) -> DataFrame:
    return parsed.select(
        *keep, "file_path", doi(F.col("m.DOI")).alias("doi"), F.get("m.title", F.lit(0)).alias("title"), F.col("m.publisher").alias("publisher"), F.get("m.container-title", F.lit(0)).alias("journal"),
        first_year(F.col("m.published-print"), F.col("m.published-online"), F.col("m.created")).alias("year"), F.col("m.type").alias("type"), F.col("m.is-referenced-by-count").alias("citation_count"),
        F.coalesce(F.when(F.col("m.author").isNotNull(), F.size("m.author")), F.lit(0)).alias("author_count"), F.col("m.URL").alias("url"),
    )


def flatten_works_a(docs: DataFrame) -> DataFrame:
    return _rows_a(_works_a(docs).filter("_good"))


def _works_b(docs: DataFrame) -> DataFrame:
    return docs.withColumn("m", F.from_json("value", WORKS_B)).withColumn("_good", F.coalesce(F.col("m.id").isNotNull() | F.col("m.doi").isNotNull() | F.col("m.ids").isNotNull() | F.col("m.title").isNotNull(), F.lit(False)))


def _rows_b(parsed: DataFrame, *keep: str) -> DataFrame:
    names = F.flatten(F.transform(F.coalesce("m.authorships", F.array().cast("array<struct<institutions: array<struct<display_name: string>>>>")), lambda a: F.coalesce(a["institutions"]["display_name"], F.array().cast("array<string>"))))
    named = lambda xs: F.filter(xs, lambda x: x.isNotNull() & (x != ""))
    concepts = F.coalesce(named(F.slice(F.col("m.concepts")["display_name"], 1, MAX_CONCEPTS)), F.array().cast("array<string>"))
    return parsed.select(
        *keep, "file_path", doi(F.coalesce(F.nullif("m.doi", F.lit("")), "m.ids.doi")).alias("doi"), F.col("m.id").alias("openalex_id"), F.col("m.title").alias("title"), F.col("m.publication_year").alias("publication_year"), F.col("m.cited_by_count").alias("cited_by_count"),
        F.col("m.primary_location.source.display_name").alias("journal"), F.col("m.open_access.is_oa").alias("is_oa"), F.col("m.open_access.oa_status").alias("oa_status"), concepts.alias("top_concepts"), F.slice(F.array_distinct(named(names)), 1, MAX_INSTITUTIONS).alias("institutions"),
    )


def flatten_works_b(docs: DataFrame) -> DataFrame:
    """Concepts are the first MAX_CONCEPTS, then those with a name; institutions the first MAX_INSTITUTIONS distinct names."""
    return _rows_b(_works_b(docs).filter("_good"))


def _indicators(docs: DataFrame) -> DataFrame:
    path = r"([^/]+)/([^/]+)\.json$"
    name = F.url_decode("file_path")
    keyed = docs.withColumns({"country_iso3": F.regexp_extract(name, path, 1), "indicator": F.regexp_extract(name, path, 2)})
    return keyed.withColumn("m", F.from_json(F.get(F.from_json("value", "array<string>"), F.lit(1)), INDICATOR)).withColumn("_good", F.col("m").isNotNull())


def _rows_indicators(parsed: DataFrame, *keep: str) -> DataFrame:
    each = parsed.select(*keep, "country_iso3", "indicator", F.posexplode_outer("m").alias("pos", "r"))
    return each.select(*keep, "country_iso3", "indicator", "pos", F.col("r.country.value").alias("country_name"), F.col("r.indicator.value").alias("indicator_name"), F.col("r.date").alias("year"), F.col("r.value").alias("value"))


def flatten_indicators(docs: DataFrame) -> DataFrame:
    """Keys from the path <country>/<indicator>.json; rows are the second element of the document's array."""
    return _rows_indicators(_indicators(docs).filter("_good")).filter("pos is not null")


#: Of each kind of payload: how it is parsed, and its rows.
KINDS = {"works_a": (_works_a, _rows_a), "works_b": (_works_b, _rows_b), "indicators": (_indicators, _rows_indicators)}
DEAD = "file_path string, reason string, text string"


def landed(docs: DataFrame, kind: str, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, dead): a kind's payloads flattened to dimension rows, and those that give none as (file_path, reason, text). Both
    are written under path by one pass over the payloads, and read again."""
    parse, rows_of = KINDS[kind]
    parsed = parse(docs)
    reason = F.when(F.coalesce(F.trim("value"), F.lit("")) == "", "empty").when(F.try_parse_json("value").isNull(), "no JSON").when(~F.col("_good"), "foreign document")
    apart = parsed.withColumns({"_dead": F.when(reason.isNotNull() | ~F.col("_good"), F.struct("file_path", F.coalesce(reason, F.lit("foreign document")).alias("reason"), F.col("value").alias("text")))})
    flat = rows_of(apart, "_dead")
    if "pos" in flat.columns:
        flat = flat.filter("pos is not null or _dead is not null")
    flat.withColumn("outcome", F.when(F.col("_dead").isNull(), "rows").otherwise("dead")).write.partitionBy("outcome").parquet(path)
    both = docs.sparkSession.read.schema(f"{_ddl(flat)}, outcome string").parquet(path)
    return both.filter("outcome = 'rows'").drop("_dead", "outcome"), both.filter("outcome = 'dead'").select("_dead.*")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def dead_counts(dead: DataFrame) -> DataFrame:
    """(reason, n) of payloads that gave no row."""
    return dead.groupBy("reason").agg(F.count("*").alias("n"))


def dois_of_texts(docs: DataFrame, text: str, *order: str) -> DataFrame:
    """(doi, first): distinct DOIs of a text column, case-sensitive, with where each is first seen."""
    each = docs.select(*order, F.posexplode(dois_in_text(F.col(text))).alias("pos", "doi"))
    return each.groupBy("doi").agg(F.min(F.struct(*order, "pos")).alias("first"))
