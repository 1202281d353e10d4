"""Context: request manifests, dimensions with the last row per key, enrichment, and counts over both."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import keys
from rillstone.functions.fields import first_present, present
from rillstone.operators.summarize import beside, counts, listed, top
from rillstone.sources.records import write_json
from rillstone.sources.stored import Merge, StoredTable

# The default indicators.
INDICATORS = ["SP.POP.TOTL", "EN.POP.DNST", "NY.GDP.PCAP.CD"]
COUNTRY_FIELDS = ["country", "geographic_scope", "location"]


def doi_inventory(df: DataFrame) -> DataFrame:
    """The distinct DOIs; orderBy("doi") lists them sorted."""
    return df.select(keys.doi(present(df, "doi")).alias("doi")).filter("doi is not null").distinct()


def country_inventory(df: DataFrame, columns: list[str] = COUNTRY_FIELDS) -> DataFrame:
    """The distinct countries; orderBy("country_iso3") lists them sorted."""
    return df.select(keys.iso3(first_present(df, columns)).alias("country_iso3")).filter("country_iso3 is not null").distinct()


def request_manifest(df: DataFrame, indicators: list[str] = INDICATORS) -> DataFrame:
    """(service, request_key, url): two works requests per DOI, one per country and indicator. URLs carry no service key."""
    d, c = doi_inventory(df), country_inventory(df)
    encoded = keys.percent_encoded(F.col("doi"))
    works = F.array(F.struct(F.lit("works_a").alias("service"), F.concat(F.lit(keys.WORKS_A), encoded).alias("url")), F.struct(F.lit("works_b").alias("service"), F.concat(F.lit(keys.WORKS_B), encoded).alias("url")))
    of_works = d.select(F.col("doi").alias("request_key"), F.inline(works)).select("service", "request_key", "url")
    names = df.sparkSession.createDataFrame([(i,) for i in indicators], "indicator string")
    both = c.crossJoin(F.broadcast(names))  # a fixed list of indicators
    return of_works.unionByName(both.select(F.lit("indicators").alias("service"), F.concat_ws("/", "country_iso3", "indicator").alias("request_key"), keys.indicator_url(F.col("country_iso3"), F.col("indicator")).alias("url")))


def fetch_results(manifest: DataFrame, landed: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Each request with status ok where its payload has landed, else error with a message: that of failures (service,
    request_key, message), or that no payload has landed. landed: (service, request_key)."""
    by = ["service", "request_key"]
    done = manifest.join(landed.select(*by).distinct().withColumn("_ok", F.lit(True)), by, "left")
    if failures is None:
        done = done.withColumn("_why", F.lit(None).cast("string"))
    else:
        done = done.join(failures.groupBy(*by).agg(F.max("message").alias("_why")), by, "left")
    message = F.when(F.col("_ok").isNull(), F.coalesce("_why", F.lit("no payload has landed")))
    return done.withColumns({"status": F.when(F.col("_ok"), "ok").otherwise("error"), "message": message}).drop("_ok", "_why")


def last_row(dim: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last in load order; null and blank keys go."""
    rows = dim.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    return rows.groupBy(key).agg(F.max_by(F.struct(*[c for c in dim.columns if c != key]), order).alias("_r")).select(key, "_r.*")


def indicator_maps(latest: DataFrame, order: str) -> DataFrame:
    """(country_iso3, indicators): a map per country; the last value of an indicator wins, null values are kept."""
    one = latest.filter("country_iso3 is not null and indicator is not null").groupBy("country_iso3", "indicator").agg(F.max_by("value", order).alias("value"))
    return one.groupBy("country_iso3").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("indicator", "value")))).alias("indicators"))


def latest_indicators(series: DataFrame, pos: str = "pos") -> DataFrame:
    """Per country and indicator the first row in payload order that has a value (0 counts), not the largest year."""
    rows = series.filter("value is not null")
    return rows.groupBy("country_iso3", "indicator").agg(F.min_by(F.struct("year", "value"), pos).alias("_r")).select("country_iso3", "indicator", "_r.*")


def enrich(df: DataFrame, a: DataFrame, b: DataFrame, indicators: DataFrame) -> DataFrame:
    """Records with a nested context; nulls where nothing matches, one row per record. a and b have one row per doi, with
    doi first; indicators has country_iso3 and a map. Joins are left to Spark's sizes: small dimensions are broadcast."""
    rows = df.drop("context").withColumns({"_doi": keys.doi(present(df, "doi")), "_iso": keys.iso3(present(df, "country"))})
    wa = a.select(F.col("doi").alias("_doi"), F.struct(*a.columns).alias("_a"))
    wb = b.select(F.col("doi").alias("_doi"), F.struct(*b.columns).alias("_b"))
    wc = indicators.select(F.col("country_iso3").alias("_iso"), F.col("indicators").alias("_i"))
    joined = rows.join(wa, "_doi", "left").join(wb, "_doi", "left").join(wc, "_iso", "left")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    context = F.struct(F.col("_a").alias("crossref"), F.col("_b").alias("openalex"), F.struct(F.col("_iso").alias("country_iso3"), F.coalesce("_i", none).alias("indicators")).alias("world_bank"))
    return joined.withColumn("context", context).drop("_doi", "_iso", "_a", "_b", "_i")


def exploded_counts(df: DataFrame, array: Column, order: str = "row_number") -> DataFrame:
    """(key, n, first_row): records per element of an array column."""
    return df.select(F.col(order).alias("_row"), F.explode(array).alias("key")).groupBy("key").agg(F.count("*").alias("n"), F.min("_row").alias("first_row"))


def context_sizes(a: DataFrame, b: DataFrame, series: DataFrame) -> DataFrame:
    """One row: distinct DOIs of both works dimensions and raw indicator rows."""
    rows = a.select(F.lit("a").alias("d"), "doi").unionByName(b.select(F.lit("b").alias("d"), "doi")).unionByName(series.select(F.lit("i").alias("d"), F.lit(None).cast("string").alias("doi")))
    of = lambda d: F.count_distinct(F.when((F.col("d") == d) & (F.col("doi") != ""), F.col("doi")))
    return rows.agg(of("a").alias("works_a"), of("b").alias("works_b"), F.count_if(F.col("d") == "i").alias("indicator_rows"))


def context_overview(df: DataFrame, fetched: bool = False) -> DataFrame:
    doi, iso = keys.doi(present(df, "doi")), keys.iso3(first_present(df, COUNTRY_FIELDS))
    return df.agg(F.count_distinct(doi).alias("doi_count"), F.count_distinct(iso).alias("country_count"), F.lit(fetched).alias("fetched"))


#: Names of the normalised tables; fixed values.
TABLES = ["crossref_works", "openalex_works", "world_bank_records", "world_bank_latest"]


def write_context_tables(root: str, a: DataFrame, b: DataFrame, series: DataFrame) -> dict[str, str]:
    """The four normalised tables as JSON lines under root; their paths by name."""
    paths = {}
    for name, df in zip(TABLES, (a, b, series, latest_indicators(series)), strict=True):
        paths[name] = f"{root}/{name}"
        write_json(df, paths[name])
    return paths


def dimension_summary(a: DataFrame, b: DataFrame, series: DataFrame, order: str = "load_order") -> DataFrame:
    """(kind, key, n) over the dimensions' own rows: how many rows each has, the ten most frequent publishers and journals,
    and how many countries have a latest value of each indicator."""
    latest = latest_indicators(series)
    rows = [df.agg(F.lit("rows").alias("kind"), F.lit(name).alias("key"), F.count("*").alias("n")) for name, df in zip(TABLES, (a, b, series, latest), strict=True)]
    of = lambda df, kind: df.select(F.lit(kind).alias("kind"), "key", "n")
    rows += [of(top(counts(a, F.col("publisher"), order)), "publisher"), of(top(counts(b, F.col("journal"), order)), "journal")]
    rows.append(of(latest.groupBy(F.col("indicator").alias("key")).agg(F.count("*").alias("n")), "indicator"))
    return reduce(DataFrame.unionByName, rows)


def context_document(a: DataFrame, b: DataFrame, series: DataFrame, order: str = "load_order") -> DataFrame:
    """One row, the summary document of the normalised tables: their rows, the ten most frequent publishers and journals, and
    the indicators that have latest values, all of them."""
    latest = latest_indicators(series)
    sizes = [df.agg(F.count("*").alias(name)) for name, df in zip(("crossref_rows", "openalex_rows", "world_bank_rows", "world_bank_latest_rows"), (a, b, series, latest), strict=True)]
    indicators = latest.groupBy(F.col("indicator").alias("key")).agg(F.count("*").alias("n"), F.min("country_iso3").alias("first_row"))
    return beside(*sizes, listed(counts(a, F.col("publisher"), order), "crossref_publishers"), listed(counts(b, F.col("journal"), order), "openalex_journals"), listed(indicators, "world_bank_indicators", None))


def later(order: str) -> Merge:
    """For stored dimensions: of two rows of a key the one later in load order, whichever batch came first."""
    return lambda old, new: F.when(old.isNull() | (new[order] >= old[order]), new).when(new.isNull(), old).otherwise(old)


def keep_dimension(store: StoredTable, rows: DataFrame, order: str, mark: str | None = None) -> DataFrame:
    """Merge a batch of dimension rows into its stored table, the last row per key in load order; the table."""
    store.merge(last_row(rows, store.key, order), later(order), mark)
    return store.read()
