"""Source gates and extraction contracts: data rules over tables of documents, attempts, records and references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import keys
from rillstone.functions.fields import first_present, identity_text, present, strip

# Fixed values.
INTEGRITY_STATUSES = ["fulltext_ready", "pdf_one_page_only", "pdf_corrupted", "html_only", "abstract_only", "supplement_available", "wrong_article", "access_blocked", "not_found"]
CONFIDENCES = ["high", "medium", "low"]
SOURCE_KINDS = ["supplement_table", "main_table", "paragraph", "figure"]
SERVICE_KEYS = {"Elsevier": "ELSEVIER_API_KEY", "Springer": "SPRINGER_API_KEY", "Wiley": "WILEY_TDM_TOKEN"}
PROVENANCE_GROUPS = [["doi", "paper_title"], ["evidence_location", "evidence_page", "table_figure_id"], ["extraction_confidence"]]


def integrity_status(pages: Column, usable: Column) -> Column:
    """usable: whether the text is extractable (keys.is_extractable)."""
    return F.when(pages.isNull(), "pdf_corrupted").when(pages <= 1, "pdf_one_page_only").when(~usable, "abstract_only").otherwise("fulltext_ready")


def doi_routes(dois: DataFrame, supported: list[str] = tuple(SERVICE_KEYS)) -> DataFrame:
    """dois with publisher, supported and failure_reason."""
    house = keys.publisher(F.col("doi"))
    return dois.withColumn("publisher", house).withColumn("supported", F.col("publisher").isin(*supported)).withColumn("failure_reason", F.when(~F.col("supported"), "unsupported publisher"))


def harvest_outcome(attempts: DataFrame, keyed: tuple[str, ...] = tuple(SERVICE_KEYS)) -> DataFrame:
    """attempts (doi, http_status, body) with publisher, status, source_type and failure_reason. keyed: houses whose service
    key was at hand."""
    house = keys.publisher(F.col("doi"))
    good = (F.col("http_status") == 200) & keys.is_pdf(F.col("body"))
    lacks = reduce(lambda rest, h: F.when(F.col("publisher") == h, f"missing {SERVICE_KEYS[h]}").otherwise(rest), [h for h in SERVICE_KEYS if h not in keyed], F.lit(None).cast("string"))
    reason = F.when(F.col("publisher") == "Unknown", "unsupported publisher").otherwise(F.coalesce(lacks, F.when(~F.coalesce(good, F.lit(False)), F.concat(F.lit("http "), F.coalesce(F.col("http_status").cast("string"), F.lit("none"))))))
    rows = attempts.withColumn("publisher", house).withColumn("failure_reason", reason)
    ok = F.col("failure_reason").isNull()
    return rows.withColumns({"status": F.when(ok, "ok").otherwise("failed"), "source_type": F.when(ok, "publisher_api_pdf").otherwise("none")})


def first_success(attempts: DataFrame, target: str, rung: str, ok: Column) -> DataFrame:
    """(target, rung, source_type): the first rung that worked, nulls where none did."""
    made = attempts.select(target, rung, "source_type", ok.alias("_ok")).groupBy(target).agg(F.min(F.when(F.col("_ok"), F.struct(rung, "source_type"))).alias("_r"))
    return made.select(target, F.col(f"_r.{rung}").alias(rung), F.col("_r.source_type").alias("source_type"))


def source_gate(docs: DataFrame, has_html: Column) -> DataFrame:
    """docs (pages, text, identity_match) with integrity_status, passed and reasons."""
    rows = docs.withColumn("_usable", keys.is_extractable(F.col("text")))
    rows = rows.withColumn("integrity_status", integrity_status(F.col("pages"), F.col("_usable")))
    junk = F.col("integrity_status").isin("pdf_one_page_only", "abstract_only")
    reasons = F.array_compact(F.array(F.when(~F.col("identity_match"), F.lit("wrong_article")), F.when(junk, F.col("integrity_status")), F.when(~F.col("_usable") & ~has_html, F.lit("no usable text"))))
    return rows.withColumn("reasons", reasons).withColumn("passed", F.size("reasons") == 0).drop("_usable")


def outside_vocabulary(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """(value, n) of values that the closed vocabulary lacks, null included."""
    return df.filter(~F.coalesce(F.col(column).isin(*allowed), F.lit(False))).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def lacks_provenance(df: DataFrame) -> DataFrame:
    """df with missing_provenance, the groups that are missing."""
    found = [F.when(first_present(df, g).isNull(), F.lit("/".join(g))) for g in PROVENANCE_GROUPS]
    return df.withColumn("missing_provenance", F.array_compact(F.array(*found)))


def unresolved_reason(df: DataFrame, accessible: Column) -> Column:
    """Why a record belongs to the unresolved output, or null."""
    return (
        F.when(keys.doi(present(df, "doi")).isNull() & present(df, "paper_title").isNull(), "ambiguous identity")
        .when(keys.doi(present(df, "doi")).isNull(), "no doi")
        .when(~accessible, "inaccessible")
        .when(keys.number(present(df, "value_numeric")).isNull(), "implicit values")
    )


def source_conflicts(df: DataFrame, identity: Column, value: Column, rank: Column) -> DataFrame:
    """Records kept: all of an identity whose sources disagree on the value, with conflict true; else the one of least rank
    (ties: first row)."""
    rows = df.withColumns({"_id": identity, "_value": value, "_rank": rank})
    found = rows.groupBy("_id").agg((F.count_distinct("_value") > 1).alias("conflict"), F.min(F.struct("_rank", "row_number")).alias("_first"))
    return rows.join(found, "_id").filter(F.col("conflict") | (F.col("row_number") == F.col("_first.row_number"))).drop("_id", "_value", "_rank", "_first")


def source_rank(kind: Column) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SOURCE_KINDS)), kind), F.lit(0)), F.lit(len(SOURCE_KINDS) + 1))


def granularity_violations(df: DataFrame, identity: Column) -> DataFrame:
    """(identity, n): full identities that more than one record has."""
    return df.groupBy(identity.alias("identity")).agg(F.count("*").alias("n")).filter("n > 1")


def with_paper_rows(records: DataFrame, papers: DataFrame, key: str) -> DataFrame:
    """Records, and a flagged row for each paper that has none."""
    bare = papers.join(records.select(key).distinct(), key, "left_anti").withColumn("no_record", F.lit(True))
    return records.withColumn("no_record", F.lit(False)).unionByName(bare, allowMissingColumns=True)


def inconsistent_titles(df: DataFrame) -> DataFrame:
    """(doi, n_titles): DOIs with more than one normalised title."""
    rows = df.select(keys.doi(present(df, "doi")).alias("doi"), identity_text(present(df, "paper_title")).alias("title")).filter("doi is not null and title <> ''")
    return rows.groupBy("doi").agg(F.count_distinct("title").alias("n_titles")).filter("n_titles > 1")


# Names of the reference-rebuild source table as record fields.
REBUILD_COLUMNS = {"source_title_matched": "paper_title", "source_literature_doi": "doi", "chemical_name": "pollutant_original", "medium": "matrix", "sampling_year_or_period": "sampling_period", "min_concentration": "value_min", "max_concentration": "value_max", "mean_concentration": "value_numeric"}


def mapped_columns(df: DataFrame, mapping: dict[str, str] = REBUILD_COLUMNS) -> DataFrame:
    """Source columns under their record names. Where a record has both, its own value goes first and the source's fills in."""
    for a, b in mapping.items():
        if a in df.columns and b in df.columns:
            df = df.withColumn(b, first_present(df, [b, a])).drop(a)
        elif a in df.columns:
            df = df.withColumnRenamed(a, b)
    return df


def resolve_references(rows: DataFrame, mapping: DataFrame, citations: DataFrame | None = None) -> DataFrame:
    """rows (short_ref) with doi and doi_match_status: the DOI mapping first, then the citation list's DOI; a reference that
    the mapping lists with a blank DOI stays blank. One row per source row: each side has one row per short_ref."""
    one = lambda d, name: d.groupBy("short_ref").agg(F.min("doi").alias(name), F.lit(True).alias(f"{name}_known"))
    out = rows.join(one(mapping, "_m"), "short_ref", "left")
    cited = F.lit(None).cast("string")
    if citations is not None:
        out, cited = out.join(one(citations, "_c"), "short_ref", "left"), F.col("_c")
    blank = F.col("_m_known") & F.coalesce(strip(F.col("_m")) == "", F.lit(True))
    doi = F.when(blank, F.lit(None).cast("string")).otherwise(F.coalesce(keys.doi(F.col("_m")), keys.doi(cited)))
    status = F.when(blank, "blank").when(doi.isNull(), "unresolved").otherwise("matched")
    return out.withColumns({"doi": doi, "doi_match_status": status}).drop("_m", "_m_known", "_c", "_c_known")


def reused_benchmark_dois(rows: DataFrame, benchmark_dois: DataFrame) -> DataFrame:
    """Rows whose source DOI is a benchmark's own: violations for review."""
    return rows.join(benchmark_dois.select("doi").distinct(), "doi", "left_semi")


def reconciled(source: DataFrame, output: DataFrame, key: str) -> DataFrame:
    """(key, n_in, n_out) of source rows that are not in the output exactly once each; a null key is a key. See reconcile.py
    for the way that moves the difference alone."""
    of = lambda df, n_in, n_out: df.select(key, F.lit(n_in).cast("long").alias("n_in"), F.lit(n_out).cast("long").alias("n_out"))
    both = of(source, 1, 0).unionByName(of(output, 0, 1))
    return both.groupBy(key).agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out")).filter("n_in <> n_out")
