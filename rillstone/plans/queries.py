"""The reference's queries over the driver tables: (spark, sf_dir) -> DataFrame of scalar columns."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import keys
from rillstone.functions.fields import alias, as_rows, identity_text, present
from rillstone.operators import batches, context, contracts, provenance, reconcile, release, ruled, summarize, validate
from rillstone.plans import rulebook as rb
from rillstone.plans.views import view
from rillstone.sources import payloads, records
from rillstone.sources.scratch import shared_path, written
from rillstone.sources.stored import StoredTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
C = F.col
STATUS = ["row_number", "validation_status", "validation_notes"]
#: Labels of batches in the routing queries, by row number.
LABELS = ["nature_geoscience_waters", "science_advances ocean", "EST TFA rebuild", "latest test", "plain"]


def query(f):
    QUERIES[f"q_{f.__name__.rstrip('_')}"] = f
    return f


def joined(array: str) -> Column:
    return F.array_join(array, "; ")


def audited(spark: SparkSession, sf: str, book: rb.Rulebook = rb.GENERIC) -> DataFrame:
    return validate.audit(view(spark, sf, "r1"), book)


def out(df: DataFrame) -> DataFrame:
    return df.select("row_number", "applied_rulebook", "validation_status", joined("validation_notes").alias("notes"))


# Record audit


@query
def audit_rows(spark, sf):
    return out(audited(spark, sf))


@query
def audit_counts(spark, sf):
    return validate.status_counts(audited(spark, sf))


@query
def audit_notes_freq(spark, sf):
    return validate.note_counts(audited(spark, sf))


@query
def duplicates(spark, sf):
    flagged = audited(spark, sf).filter(F.array_contains("validation_notes", validate.REPEATED))
    return flagged.select("row_number", "validation_status")


@query
def duplicate_groups(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = validate.repeated_identities(docs, F.lower(F.trim("text")))
    return sizes.groupBy(C("_n").alias("copies")).agg(F.count("*").alias("n_groups"))


def _batches(df: DataFrame) -> DataFrame:
    return df.withColumn("label", F.get(F.array(*map(F.lit, LABELS)), (C("row_number") % len(LABELS)).cast("int")))


@query
def multi_rulebook(spark, sf):
    names = F.get(F.array(*map(F.lit, rb.RULEBOOKS)), (C("row_number") % 4).cast("int"))
    rules = rb.rule_table(spark, list(rb.RULEBOOKS.values()))
    return out(ruled.audit_ruled(view(spark, sf, "r1").withColumn("book", names), "book", rules))


#: Rulebook documents of the query below: whole kinds in place of the default's, one of them empty.
DOCUMENTS = {
    "strict": {"required_fields": ["paper_title", "doi", "pollutant_group|pollutant_original", "unit_standardized"], "review_if_missing": [], "reject_if_missing": ["doi", "unit_standardized"]},
    "by_site": {"required_any_groups": [["location", "country|geographic_scope"], ["trend_direction", "risk_threshold"]], "duplicate_identity_fields": ["country", "matrix"], "forbidden_fields": ["risk_threshold"]},
}


@query
def ruled_audit(spark, sf):
    """Records judged by rulebook documents that are written, read again and merged over the default, one for each source."""
    path = shared_path(spark)
    named = view(spark, sf, "r1").select("source_kind").distinct().withColumn("book", F.when(C("source_kind").endswith("table"), "strict").otherwise("by_site"))
    texts = F.create_map(*[x for n, d in DOCUMENTS.items() for x in (F.lit(n), F.lit(json.dumps(d | {"name": n})))])
    named.select("book").distinct().select(texts[C("book")].alias("value")).write.text(path)
    rules = rb.with_defaults(rb.rules_of_documents(spark.read.text(path)), rb.rule_table(spark, [rb.GENERIC]))
    return out(ruled.audit_ruled(view(spark, sf, "r1").join(F.broadcast(named), "source_kind"), "book", rules))


@query
def route_label(spark, sf):
    routed = rb.route_by_label(_batches(view(spark, sf, "r1")), F.array("label"), "by_word")
    routed = rb.route_by_label(routed, F.array("label"), "by_substring", substring=True)
    return routed.groupBy("label", "by_word", "by_substring").agg(F.count("*").alias("n"))


def _field_batches(spark, sf) -> DataFrame:
    """(batch, record): records as JSON array documents, a file for each batch, read as VARIANT. A record has a field where its
    value is not null; records of every 16th batch have all of one reference field, null or not."""
    rows = view(spark, sf, "r1").withColumn("batch", C("row_number") % 240)
    kept = lambda c, which: F.when(which, C(c)).alias(c)
    thin = F.struct("row_number", "doi", "matrix", kept("value_numeric", C("batch") % 5 == 0), kept("trend_direction", C("batch") % 7 == 0), kept("risk_threshold", C("batch") % 8 == 1))
    rebuilt = F.struct("row_number", "doi", F.when(C("row_number") % 2 == 0, C("matrix")).alias("reference_resolution_status"))
    text = F.when(C("batch") % 16 == 3, F.to_json(rebuilt, {"ignoreNullFields": "false"})).otherwise(F.to_json(thin))
    path = shared_path(spark)
    docs = rows.select("batch", text.alias("j")).groupBy("batch").agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ",\n"), F.lit("]")).alias("value"))
    docs.repartition("batch").write.partitionBy("batch").text(path)
    return records.variant_records(spark, path).withColumn("batch", F.regexp_extract("file_path", "batch=([0-9]+)", 1).cast("long"))


@query
def route_columns(spark, sf):
    return rb.route_by_names(records.field_names(_field_batches(spark, sf), "batch"), "batch")


@query
def field_overlap(spark, sf):
    """The fields that each batch's records really have and each rulebook names."""
    names = records.field_names(_field_batches(spark, sf), "batch")
    return rb.shared_fields(names, "batch", rb.rule_table(spark, list(rb.RULEBOOKS.values()))).select("batch", "rulebook", F.array_join("fields", ",").alias("fields"))


@query
def variant_columns(spark, sf):
    """Records of different fields as one table of typed columns."""
    rows = records.typed(_field_batches(spark, sf), {"row_number": "long", "value_numeric": "double", "trend_direction": "string", "reference_resolution_status": "string", "absent": "string"}, "batch")
    return rows.select("batch", "row_number", F.round("value_numeric", 6).alias("value_numeric"), "trend_direction", "reference_resolution_status", "absent")


@query
def route_many_aliases(spark, sf):
    """Labels made of the documents' sources and languages, routed by an alias for each customer, most of them never met."""
    aliases = spark.read.parquet(f"{sf}/customer.parquet").select(C("c_custkey").cast("int").alias("alias_ord"), F.concat(F.lit("src"), (C("c_custkey") % 9).cast("string"), F.lit(" "), F.element_at(F.array(*map(F.lit, ("en", "de", "fr", "es", "xx"))), (C("c_custkey") % 5 + 1).cast("int"))).alias("alias"), F.concat(F.lit("book"), C("c_custkey").cast("string")).alias("rulebook"))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.concat_ws("/", F.lit("Batch"), "source", "lang").alias("label"))
    routed = rb.route_by_label(docs, F.array("label"), aliases=aliases)
    return routed.groupBy("label", "rulebook").agg(F.count("*").alias("n"))


@query
def rule_table(spark, sf):
    default = rb.rule_table(spark, [rb.GENERIC])
    merged = rb.with_defaults(rb.rule_table(spark, [rb.RECORD]).filter("rule_kind in ('required_fields', 'review_if_missing')"), default)
    rules = merged.select("rule_kind", "ordinal", F.explode("field_group").alias("field"))
    rows = view(spark, sf, "r1")
    held = rows.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), present(rows, c).isNotNull().cast("long").alias("has")) for c in ("doi", "matrix", "unit_original", "unit_standardized", "paper_title", "evidence_page")])))
    return rules.join(held.groupBy("field").agg(F.sum("has").alias("n_present")), "field").select("rule_kind", "ordinal", "field", "n_present")


@query
def row_numbers(spark, sf):
    return validate.numbered(view(spark, sf, "r1").select(C("row_number").alias("position"), "country"), "position").select("position", "row_number")


# Keys


@query
def doi_inventory(spark, sf):
    return context.doi_inventory(view(spark, sf, "r1")).orderBy("doi")


@query
def doi_from_text(spark, sf):
    found = payloads.dois_of_texts(view(spark, sf, "r3"), "text", "doc_id")
    return found.select("doi", C("first.doc_id").alias("first_doc"), C("first.pos").alias("first_pos"))


@query
def publisher_mix(spark, sf):
    routed = contracts.doi_routes(context.doi_inventory(view(spark, sf, "r1")))
    return routed.groupBy("publisher", "supported", "failure_reason").agg(F.count("*").alias("n"))


@query
def doi_slug(spark, sf):
    return context.doi_inventory(view(spark, sf, "r1")).select("doi", keys.slug(C("doi")).alias("slug"))


@query
def iso3(spark, sf):
    return view(spark, sf, "r1").select("row_number", keys.iso3(C("country")).alias("iso3"))


@query
def country_inventory(spark, sf):
    return context.country_inventory(view(spark, sf, "r1")).orderBy("country_iso3")


@query
def safe_number(spark, sf):
    return view(spark, sf, "r1").select("row_number", F.round(keys.number(C("value_numeric")), 6).alias("value"))


# Summaries


def _summary(df: DataFrame) -> DataFrame:
    return df.withColumn("mean", F.round("mean", 6)).withColumn("min", F.round("min", 6)).withColumn("max", F.round("max", 6))


@query
def numeric_summary(spark, sf):
    return _summary(summarize.numeric_summary(summarize.numeric_values(view(spark, sf, "r1"))))


@query
def numeric_by_column(spark, sf):
    return _summary(summarize.numeric_summary(summarize.numeric_values(view(spark, sf, "r1")), "column"))


@query
def numeric_lineitem(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet").select(C("l_quantity").alias("value_numeric"), C("l_extendedprice").alias("value_max"), C("l_discount").alias("value_min"))
    return _summary(summarize.numeric_summary(summarize.numeric_values(items), "column"))


@query
def threshold_summary(spark, sf):
    return summarize.threshold_summary(view(spark, sf, "r1"))


def _top(spark, sf, key: str) -> DataFrame:
    rows = view(spark, sf, "r1")
    return summarize.top(summarize.counts(rows, alias(rows, key)))


@query
def top_pollutants(spark, sf):
    return _top(spark, sf, rb.POLLUTANT)


@query
def top_matrices(spark, sf):
    return _top(spark, sf, "matrix")


@query
def top_geographies(spark, sf):
    return _top(spark, sf, rb.GEOGRAPHY)


@query
def trend_counts(spark, sf):
    rows = view(spark, sf, "r1")
    return summarize.counts(rows, present(rows, "trend_direction")).select("key", "n")


@query
def key_counts(spark, sf):
    rows = view(spark, sf, "r1")
    return summarize.several_counts(rows, {"pollutant": alias(rows, rb.POLLUTANT), "matrix": present(rows, "matrix"), "geography": alias(rows, rb.GEOGRAPHY), "trend": present(rows, "trend_direction")})


def _table(spark, sf, key: str) -> DataFrame:
    rows = view(spark, sf, "r1")
    return summarize.group_table(rows, alias(rows, key))


@query
def pollutant_table(spark, sf):
    return _table(spark, sf, rb.POLLUTANT)


@query
def matrix_table(spark, sf):
    return _table(spark, sf, "matrix")


@query
def geography_table(spark, sf):
    return _table(spark, sf, rb.GEOGRAPHY)


# Context


def _dims(spark, sf) -> tuple[DataFrame, DataFrame, DataFrame]:
    a = context.last_row(view(spark, sf, "d1"), "doi", "load_order").drop("load_order")
    b = context.last_row(view(spark, sf, "d2"), "doi", "load_order").drop("load_order").withColumn("top_concepts", F.split("concepts_text", ";"))
    maps = context.indicator_maps(context.latest_indicators(view(spark, sf, "d3")).withColumn("pos", F.lit(0)), "pos")
    return a, b, maps


def _enriched(spark, sf) -> DataFrame:
    return context.enrich(view(spark, sf, "r1"), *_dims(spark, sf))


@query
def enrich_a(spark, sf):
    return _enriched(spark, sf).select("row_number", C("context.crossref.publisher").alias("publisher"), C("context.crossref.journal").alias("journal"), C("context.crossref.year").alias("year"), C("context.crossref.citation_count").alias("citation_count"))


@query
def enrich_b(spark, sf):
    return _enriched(spark, sf).select("row_number", C("context.openalex.journal").alias("journal"), C("context.openalex.cited_by_count").alias("cited_by_count"), C("context.openalex.is_oa").alias("is_oa"), F.array_join("context.openalex.top_concepts", ";").alias("concepts"))


@query
def enrich_country(spark, sf):
    i = C("context.world_bank.indicators")
    return _enriched(spark, sf).select("row_number", C("context.world_bank.country_iso3").alias("country_iso3"), F.size(i).cast("long").alias("n_indicators"), i["SP.POP.TOTL"].alias("population"))


@query
def enriched_flat(spark, sf):
    flat = _enriched(spark, sf)
    return flat.groupBy(C("context.crossref.doi").isNotNull().alias("in_a"), C("context.openalex.doi").isNotNull().alias("in_b"), (F.size("context.world_bank.indicators") > 0).alias("has_indicators")).agg(F.count("*").alias("n"))


@query
def context_top_publishers(spark, sf):
    rows = _enriched(spark, sf)
    return summarize.top(summarize.counts(rows, C("context.crossref.publisher")))


@query
def context_top_journals(spark, sf):
    rows = _enriched(spark, sf)
    return summarize.top(summarize.counts(rows, F.coalesce("context.crossref.journal", "context.openalex.journal")))


@query
def dimension_publishers(spark, sf):
    return summarize.top(summarize.counts(view(spark, sf, "d1"), C("publisher"), "load_order"))


@query
def dimension_journals(spark, sf):
    return summarize.top(summarize.counts(view(spark, sf, "d2"), C("journal"), "load_order"))


@query
def dimension_summary(spark, sf):
    return context.dimension_summary(view(spark, sf, "d1"), view(spark, sf, "d2"), view(spark, sf, "d3"))


@query
def context_tables(spark, sf):
    """The four normalised tables, written and read again."""
    paths = context.write_context_tables(shared_path(spark), view(spark, sf, "d1"), view(spark, sf, "d2"), view(spark, sf, "d3"))
    kinds = {"crossref_works": "doi string, publisher string", "openalex_works": "doi string, journal string", "world_bank_records": "country_iso3 string, value double", "world_bank_latest": "country_iso3 string, value double"}
    rows = [spark.read.schema(kinds[n]).json(p).select(F.lit(n).alias("name"), C(kinds[n].split()[0]).alias("key"), C(kinds[n].split()[2]).alias("value")) for n, p in paths.items()]
    read = reduce(DataFrame.unionByName, [r.withColumn("value", C("value").cast("string")) for r in rows])
    return read.groupBy("name").agg(F.count("*").alias("n"), F.count_distinct("key").alias("n_keys"), F.count("value").alias("n_values"))


@query
def concepts(spark, sf):
    return context.exploded_counts(_enriched(spark, sf), C("context.openalex.top_concepts")).orderBy(F.desc("n"), "first_row")


@query
def indicator_coverage(spark, sf):
    return summarize.top(context.exploded_counts(_enriched(spark, sf), F.map_keys("context.world_bank.indicators")), None).select("key", "n")


@query
def context_sizes(spark, sf):
    return context.context_sizes(view(spark, sf, "d1"), view(spark, sf, "d2"), view(spark, sf, "d3"))


@query
def context_overview(spark, sf):
    return context.context_overview(view(spark, sf, "r1"))


@query
def latest_indicator(spark, sf):
    return context.latest_indicators(view(spark, sf, "d3"))


@query
def request_manifest(spark, sf):
    return context.request_manifest(view(spark, sf, "r1"))


@query
def fetch_results(spark, sf):
    manifest = context.request_manifest(view(spark, sf, "r1"))
    landed = view(spark, sf, "d1").select(F.lit("works_a").alias("service"), C("doi").alias("request_key")).unionByName(view(spark, sf, "d2").select(F.lit("works_b").alias("service"), C("doi").alias("request_key")))
    failures = manifest.filter("service = 'works_b' and request_key like '%7'").select("service", "request_key", F.lit("HTTP Error 404: Not Found").alias("message"))
    return context.fetch_results(manifest, landed, failures).groupBy("service", "status", "message").agg(F.count("*").alias("n"))


# Payloads, made from the dimensions


@query
def flatten_a(spark, sf):
    d = view(spark, sf, "d1")
    dates = lambda y: F.struct(F.array(F.array(y)).alias("date-parts"))
    none = F.lit(None).cast("struct<`date-parts`: array<array<int>>>")
    odd = C("load_order") % 4 == 0
    message = F.struct(C("doi").alias("DOI"), F.array(F.concat(F.lit("T"), C("load_order").cast("string"))).alias("title"), F.array("journal").alias("container-title"), "publisher", C("citation_count").alias("is-referenced-by-count"), F.when(odd, dates(C("year"))).otherwise(none).alias("published-print"), dates(C("year") + 1).alias("created"))
    docs = d.select(F.concat(F.lit("/p/"), C("load_order").cast("string"), F.lit(".json")).alias("file_path"), F.when(C("load_order") % 50 == 2, F.lit("{broken")).otherwise(F.to_json(F.struct(message.alias("message")))).alias("value"))
    return payloads.flatten_works_a(docs).select("file_path", "doi", "title", "publisher", "journal", "year", "citation_count", C("author_count").cast("long"))


@query
def payload_order(spark, sf):
    """Payload files, a document each: of those with one DOI the last by path gives the row."""
    per_nation = spark.read.parquet(f"{sf}/customer.parquet").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    message = F.struct(F.concat(F.lit("10.1016/N"), (C("c_nationkey") % 10).cast("string")).alias("DOI"), C("n").alias("is-referenced-by-count"))
    path = shared_path(spark)
    docs = per_nation.select(F.format_string("%03d", C("c_nationkey").cast("int")).alias("nation"), F.to_json(F.struct(message.alias("message"))).alias("value"))
    docs.repartition("nation").write.partitionBy("nation").text(path)
    rows = payloads.flatten_works_a(payloads.payloads(spark, path))
    return context.last_row(rows, "doi", "file_path").select("doi", "citation_count")


@query
def flatten_b(spark, sf):
    d = view(spark, sf, "d2")
    names = F.transform(F.split(F.coalesce("concepts_text", F.lit("")), ";"), lambda x: F.struct(x.alias("display_name")))
    places = F.array(F.struct(F.array(F.struct(C("journal").alias("display_name")), F.struct(F.lit("Lab").alias("display_name"))).alias("institutions")), F.struct(F.array(F.struct(C("journal").alias("display_name"))).alias("institutions")))
    body = F.struct(F.concat(F.lit("W"), C("load_order").cast("string")).alias("id"), F.struct(C("doi")).alias("ids"), C("cited_by_count"), F.struct(F.struct(C("journal").alias("display_name")).alias("source")).alias("primary_location"), F.struct("is_oa").alias("open_access"), names.alias("concepts"), places.alias("authorships"))
    docs = d.select(F.concat(F.lit("/q/"), C("load_order").cast("string"), F.lit(".json")).alias("file_path"), F.to_json(body).alias("value"))
    return payloads.flatten_works_b(docs).select("openalex_id", "doi", "cited_by_count", "journal", "is_oa", F.array_join("top_concepts", ";").alias("concepts"), F.array_join("institutions", ";").alias("institutions"))


@query
def flatten_indicators(spark, sf):
    d = view(spark, sf, "d3")
    item = F.struct(F.struct(C("country_iso3").alias("value")).alias("country"), C("year").alias("date"), "value")
    series = d.groupBy("country_iso3", "indicator").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", item.alias("i")))), lambda x: x["i"]).alias("rows"))
    docs = series.select(F.concat(F.lit("/w/"), "country_iso3", F.lit("/"), "indicator", F.lit(".json")).alias("file_path"), F.concat(F.lit('[{"page":1},'), F.to_json("rows"), F.lit("]")).alias("value"))
    return payloads.flatten_indicators(docs).select("country_iso3", "indicator", C("pos").cast("long"), "year", "value")


# Gates and contracts


@query
def integrity(spark, sf):
    return view(spark, sf, "r2").select("doc_id", contracts.integrity_status(C("pages"), keys.is_extractable(C("text"))).alias("integrity_status"))


@query
def ladder(spark, sf):
    good = (C("http_status") == 200) & (C("body_head").startswith("%PDF"))
    return contracts.first_success(view(spark, sf, "r4"), "target_id", "rung", F.coalesce(good, F.lit(False)))


@query
def source_gate(spark, sf):
    gated = contracts.source_gate(view(spark, sf, "r2"), C("source") == "src1")
    return gated.select("doc_id", "passed", joined("reasons").alias("reasons"))


@query
def harvest_outcome(spark, sf):
    attempts = view(spark, sf, "r4").withColumn("body", C("body_head").cast("binary"))
    done = contracts.harvest_outcome(attempts, ("Elsevier", "Springer"))
    return done.groupBy("publisher", "status", contracts.F.col("source_type"), "failure_reason").agg(F.count("*").alias("n"))


@query
def status_vocabulary(spark, sf):
    rows = view(spark, sf, "r2").withColumn("status", F.when(C("doc_id") % 9 == 0, F.concat(F.lit("odd_"), C("lang"))).otherwise(contracts.integrity_status(C("pages"), keys.is_extractable(C("text")))))
    return contracts.outside_vocabulary(rows, "status", contracts.INTEGRITY_STATUSES)


@query
def confidence(spark, sf):
    return contracts.outside_vocabulary(view(spark, sf, "r1"), "extraction_confidence", contracts.CONFIDENCES)


@query
def provenance_min(spark, sf):
    return contracts.lacks_provenance(view(spark, sf, "r1")).select("row_number", joined("missing_provenance").alias("missing"))


@query
def unresolved(spark, sf):
    rows = view(spark, sf, "r1")
    return rows.select("row_number", contracts.unresolved_reason(rows, C("source_kind") != "figure").alias("reason")).filter("reason is not null")


def _pair(df: DataFrame) -> Column:
    return F.concat_ws("\x1f", identity_text(alias(df, "doi")), identity_text(alias(df, rb.POLLUTANT)), identity_text(alias(df, "matrix")))


@query
def conflicts(spark, sf):
    rows = view(spark, sf, "r1")
    kept = contracts.source_conflicts(rows, _pair(rows), present(rows, "unit_standardized"), contracts.source_rank(C("source_kind")))
    return kept.select("row_number", "conflict", "source_kind")


@query
def source_priority(spark, sf):
    rows = view(spark, sf, "r1")
    kept = contracts.source_conflicts(rows, _pair(rows), F.lit(1), contracts.source_rank(C("source_kind")))
    return kept.groupBy("source_kind").agg(F.count("*").alias("n"))


@query
def granularity(spark, sf):
    rows = view(spark, sf, "r1")
    found = contracts.granularity_violations(rows, validate.identity(rows, rb.RECORD))
    return found.select(F.md5("identity").alias("identity"), "n")


@query
def no_record_papers(spark, sf):
    rows = view(spark, sf, "r1").select(keys.doi(C("doi")).alias("doi"), "row_number").filter("doi is not null")
    papers = view(spark, sf, "d1").select("doi").distinct()
    return contracts.with_paper_rows(rows, papers, "doi").groupBy("doi").agg(F.count("row_number").alias("n_records"), F.max("no_record").alias("no_record"))


@query
def doi_title_consistency(spark, sf):
    return contracts.inconsistent_titles(view(spark, sf, "r1").withColumn("paper_title", F.when(C("row_number") % 37 == 0, F.lit("Other")).otherwise(C("paper_title"))))


def _resolved(spark, sf) -> DataFrame:
    return contracts.resolve_references(view(spark, sf, "r5"), view(spark, sf, "r5_map"))


@query
def reference_resolution(spark, sf):
    return _resolved(spark, sf).select("row_id", "doi", "doi_match_status")


@query
def mapped_audit(spark, sf):
    found = _resolved(spark, sf).withColumn("source_literature_doi", C("doi")).withColumn("doi", F.when(C("row_id") % 2 == 0, C("doi")))
    rows = contracts.mapped_columns(found).withColumns({"paper_title": C("short_ref"), "evidence_page": F.lit("S1"), "row_number": C("row_id")})
    return validate.status_counts(validate.audit(rows, rb.REBUILD))


@query
def benchmark_doi_reuse(spark, sf):
    own = view(spark, sf, "r5_map").filter("doi = '10.1021/benchmark'").select("doi")
    return contracts.reused_benchmark_dois(_resolved(spark, sf), own).select("row_id", "doi")


@query
def reconcile_(spark, sf):
    source = view(spark, sf, "r5")
    kept = _resolved(spark, sf).filter("row_id % 97 <> 5")
    return contracts.reconciled(source, kept.unionByName(kept.filter("row_id % 89 = 3")), "row_id")


@query
def reconcile_by_difference(spark, sf):
    """The same by lookup tables of the difference."""
    source = view(spark, sf, "r5")
    kept = _resolved(spark, sf).filter("row_id % 97 <> 5")
    return reconcile.reconciled_by_difference(source, kept.unionByName(kept.filter("row_id % 89 = 3")), "row_id")


# Release


@query
def release_rows(spark, sf):
    return release.release_rows(audited(spark, sf)).select("row_number", "doi", "validation_status")


@query
def release_gate(spark, sf):
    rows = audited(spark, sf)
    return release.gate(release.release_rows(rows)).withColumn("kind", F.lit("approved")).unionByName(release.gate(rows).withColumn("kind", F.lit("all")))


@query
def release_exclusions(spark, sf):
    return release.exclusions(audited(spark, sf))


@query
def bundle_completeness(spark, sf):
    """A bundle published whole: which of the contract's paths its manifest lists, and how many rows the tables among them have."""
    rows, root = written(release.release_rows(audited(spark, sf))), shared_path(spark)  # audited once, not by every table
    tables = {
        "api/validated_rows.json": rows.select("row_number", "doi", "paper_title", "validation_status", "validation_notes"),
        "api/analytics_summary.json": validate.status_counts(rows),
        "api/context_manifest.json": None,
        "reports/pollutant_summary.csv": summarize.group_table(rows, alias(rows, rb.POLLUTANT)),
        "reports/matrix_summary.csv": summarize.group_table(rows, alias(rows, "matrix")),
    }
    release.publish_bundle(root, "v1", tables)
    manifest = release.manifest_of(spark, root, "v1")
    sizes = release.inventory(spark, manifest).filter(C("name").isin(*tables)).select(C("name").alias("path"), "n_rows")
    missing = len(release.missing_manifest_fields(manifest))
    return release.completeness(release.released_paths(spark, root, "v1")).join(sizes, "path", "left").withColumn("fields_missing", F.lit(missing).cast("long"))


@query
def release_diff(spark, sf):
    """Two stored releases of records; the rows in which they differ, found by their hash trees."""
    rows = out(audited(spark, sf))
    before, after, n = shared_path(spark), shared_path(spark), C("row_number")
    provenance.store(rows.filter(n % 613 != 5), "row_number", before)
    provenance.store(rows.filter(n % 701 != 9).withColumn("notes", F.when(n % 509 == 3, F.concat(F.lit("seen; "), "notes")).otherwise(C("notes"))), "row_number", after)
    return provenance.changes(spark, before, after, "row_number", rows)


@query
def published_conformance(spark, sf):
    return release.nonconforming(audited(spark, sf))


@query
def release_hash(spark, sf):
    return release.provenance_hash(out(audited(spark, sf)))


@query
def release_inventory(spark, sf):
    """The tables of a release as they are written, and one that there is none of."""
    rows = audited(spark, sf)
    tables = {"api/validated_rows": release.release_rows(rows), "reports/pollutant_summary": summarize.group_table(rows, alias(rows, rb.POLLUTANT)), "reports/site_index": None}
    return release.publish(shared_path(spark), "v1", tables).select("name", "present", "n_rows")


@query
def summary_document(spark, sf):
    """The run's summary as one JSON document, read again."""
    path = shared_path(spark)
    records.write_document(validate.summary_document(audited(spark, sf), rulebook_name="generic"), path)
    read = spark.read.schema("total long, approved long, needs_review long, rejected long, notes array<struct<note: string, n: long>>, rulebook_name string").json(path)
    return read.select("total", "approved", "needs_review", "rejected", F.size("notes").cast("long").alias("n_notes"), F.aggregate("notes", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_noted"), "rulebook_name")


@query
def analytics_document(spark, sf):
    """The analytics summary as one JSON document, read again."""
    rows, path = view(spark, sf, "r1"), shared_path(spark)
    made = summarize.analytics_document(rows, alias(rows, rb.POLLUTANT), alias(rows, rb.GEOGRAPHY), context.context_overview(rows), context.context_sizes(view(spark, sf, "d1"), view(spark, sf, "d2"), view(spark, sf, "d3")))
    records.write_document(made, path)
    d = spark.read.schema(made.schema).json(path)
    pairs = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("=", x["key"], x["n"])), ";")
    return d.select(
        "total_rows", pairs("top_pollutants").alias("pollutants"), pairs("top_matrices").alias("matrices"), pairs("top_geographies").alias("geographies"), F.size("trend_direction_counts").cast("long").alias("n_trends"),
        C("numeric_summary.count").alias("n_numbers"), F.round("numeric_summary.mean", 6).alias("mean"), C("risk_threshold_summary.max").alias("threshold"), C("context_overview.doi_count").alias("doi_count"), C("external_context_summary.works_b").alias("works_b"),
    )


@query
def context_document(spark, sf):
    """The summary of the normalised context tables as one JSON document, read again."""
    path = shared_path(spark)
    made = context.context_document(view(spark, sf, "d1"), view(spark, sf, "d2"), view(spark, sf, "d3"))
    records.write_document(made, path)
    pairs = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("=", x["key"], x["n"])), ";")
    read = spark.read.schema(made.schema).json(path)
    return read.select("crossref_rows", "openalex_rows", "world_bank_rows", "world_bank_latest_rows", pairs("crossref_publishers").alias("publishers"), pairs("openalex_journals").alias("journals"), F.size("world_bank_indicators").cast("long").alias("n_indicators"))


# Batches and stored tables


@query
def batch_audit(spark, sf):
    """Records that arrive in three batches, identities counted across them: what all batches end with."""
    rows, store = view(spark, sf, "r1"), StoredTable(spark, shared_path(spark), "digest", 16)
    parts = [batches.audit_batch(rows.filter(C("row_number") % 7 % 3 == k), rb.GENERIC, store, f"batch{k}") for k in range(3)]
    whole, became = (reduce(DataFrame.unionByName, x) for x in zip(*parts, strict=True))
    return out(batches.with_later_duplicates(whole, became, rb.GENERIC))


@query
def stored_dimension(spark, sf):
    """A works dimension kept by merging three batches in any order, joined to the records."""
    d, store = view(spark, sf, "d1"), StoredTable(spark, shared_path(spark), "doi", 16)
    for k in (2, 0, 1):
        a = context.keep_dimension(store, d.filter(C("load_order") % 3 == k), "load_order", f"batch{k}")
    rows = view(spark, sf, "r1").withColumn("_doi", keys.doi(C("doi")))
    joined = rows.join(a.withColumnRenamed("doi", "_doi"), "_doi", "left")
    return joined.select("row_number", "publisher", "journal", "year", "citation_count")


@query
def quarantine(spark, sf):
    """Landed payloads of all kinds, some broken, empty or foreign: rows and dead letters of one pass each."""
    n = C("c_custkey")
    body = {
        "works_a": F.to_json(F.struct(F.struct(F.concat(F.lit("10.1016/q"), n.cast("string")).alias("DOI")).alias("message"))),
        "works_b": F.to_json(F.struct(F.concat(F.lit("W"), n.cast("string")).alias("id"), F.lit(3).alias("cited_by_count"))),
        "indicators": F.concat(F.lit('[{"page":1},'), F.to_json(F.transform(F.sequence(F.lit(1), (n % 3).cast("int") + 1), lambda y: F.struct((y + 2000).cast("string").alias("date"), (y * 1.5).alias("value")))), F.lit("]")),
    }
    kinds = []
    for at, (kind, good) in enumerate(body.items()):
        value = F.when(n % 31 == at, F.substring(good, 1, 9)).when(n % 37 == at, "  ").when(n % 41 == at, F.lit("[7]")).otherwise(good)
        docs = spark.read.parquet(f"{sf}/customer.parquet").select(F.concat(F.lit("/l/C"), n.cast("string"), F.lit("/I.json")).alias("file_path"), value.alias("value"))
        rows, dead = payloads.landed(docs, kind, shared_path(spark))
        kinds += [rows.agg(F.lit(kind).alias("kind"), F.lit("rows").alias("outcome"), F.count("*").alias("n")), payloads.dead_counts(dead).select(F.lit(kind).alias("kind"), C("reason").alias("outcome"), "n")]
    return reduce(DataFrame.unionByName, kinds)


@query
def flatten_caps(spark, sf):
    """Works with up to 19 institutions, some repeated or without a name, and up to 8 concepts: ten and five at most stay."""
    n = C("c_custkey").cast("int")
    many = lambda k, f: F.filter(F.transform(F.sequence(F.lit(0), k), f), lambda x: x.isNotNull())
    places = many(n % 19, lambda i: F.struct(F.array(F.struct(F.when(i % 5 != 3, F.concat(F.lit("I"), ((i * 7 + n) % 16).cast("string"))).alias("display_name"))).alias("institutions")))
    names = many(n % 8, lambda i: F.struct(F.when(i % 4 != 2, F.concat(F.lit("C"), (i + n % 3).cast("string"))).alias("display_name")))
    text = F.to_json(F.struct(F.concat(F.lit("W"), n.cast("string")).alias("id"), names.alias("concepts"), places.alias("authorships")), {"ignoreNullFields": "false"})
    docs = spark.read.parquet(f"{sf}/customer.parquet").select(F.lit("/q").alias("file_path"), text.alias("value"))
    flat = payloads.flatten_works_b(docs)
    return flat.select("openalex_id", F.array_join("top_concepts", ";").alias("concepts"), F.array_join("institutions", ";").alias("institutions"))


# Round trips


@query
def roundtrip_csv(spark, sf):
    path = shared_path(spark)
    records.write_csv(audited(spark, sf).select(*STATUS, "doi", "country"), path)
    return spark.read.option("header", True).option("escape", '"').option("lineSep", "\r\n").schema("row_number long, validation_status string, validation_notes string, doi string, country string").csv(path)


@query
def roundtrip_json(spark, sf):
    path = shared_path(spark)
    df = audited(spark, sf).select(*STATUS, "doi")
    records.write_json(df, path)
    return spark.read.schema(df.schema).json(path).select("row_number", "validation_status", joined("validation_notes").alias("notes"), "doi")


@query
def roundtrip_split(spark, sf):
    path = shared_path(spark)
    records.write_by_status(audited(spark, sf).select("row_number", "doi", "validation_status"), path)
    return spark.read.parquet(path).select("row_number", "doi", "validation_status")


@query
def roundtrip_twin(spark, sf):
    """The harvest manifest as JSON and as CSV, both read again."""
    attempts = view(spark, sf, "r4").withColumn("body", C("body_head").cast("binary"))
    done = contracts.harvest_outcome(attempts).select("target_id", "rung", "publisher", "status", "failure_reason")
    path = shared_path(spark)
    records.write_twin(done, path)
    of_json = spark.read.schema(done.schema).json(f"{path}/json").withColumn("form", F.lit("json"))
    of_csv = spark.read.option("header", True).option("escape", '"').option("lineSep", "\r\n").schema(done.schema).csv(f"{path}/csv").withColumn("form", F.lit("csv"))
    return of_json.unionByName(of_csv).groupBy("form", "publisher", "status", "failure_reason").agg(F.count("*").alias("n"), F.sum("target_id").alias("targets"))


@query
def roundtrip_enriched(spark, sf):
    """Enriched records, nested, as JSON and read again."""
    path = shared_path(spark)
    rows = _enriched(spark, sf).select("row_number", "context")
    records.write_json(rows, path)
    i = C("context.world_bank.indicators")
    return spark.read.schema(rows.schema).json(path).select("row_number", C("context.crossref.publisher").alias("publisher"), C("context.openalex.journal").alias("journal"), F.size(i).cast("long").alias("n_indicators"), i["SP.POP.TOTL"].alias("population"))


@query
def schema_union(spark, sf):
    """Tables of different columns as one: records, references, attempts."""
    r1, r5, r4 = view(spark, sf, "r1").select("row_number", "doi", "matrix"), view(spark, sf, "r5"), view(spark, sf, "r4").select("doi", "rung", "http_status")
    rows = as_rows([r1, r5, r4])
    has = [C(c).isNotNull().alias(f"has_{c}") for c in ("row_number", "row_id", "rung", "doi", "medium")]
    return rows.groupBy(*has).agg(F.count("*").alias("n"))


def _array_documents(spark, sf) -> str:
    """Records in JSON array documents of at most a thousand, a file each, with numbers and arrays among the objects."""
    path = shared_path(spark)
    rows = view(spark, sf, "r1").select(F.floor((C("row_number") - 1) / 1000).alias("part"), F.to_json(F.struct("row_number", "doi", "matrix")).alias("j"))
    docs = rows.groupBy("part").agg(F.concat(F.lit("[1,"), F.concat_ws(",", F.collect_list("j")), F.lit(",[2]]")).alias("value"))
    docs.write.partitionBy("part").text(path)
    return path


@query
def array_scan(spark, sf):
    return records.record_array(spark, _array_documents(spark, sf), "row_number long, doi string, matrix string").select("row_number", "doi", "matrix")


@query
def optional_scan(spark, sf):
    """The same documents, a path that does not exist, no path, and documents that are no arrays."""
    path, schema = _array_documents(spark, sf), "row_number long, doi string"
    view(spark, sf, "d1").groupBy("year").agg(F.count("*").alias("n")).select("year", F.to_json(F.struct("n")).alias("value")).write.partitionBy("year").text(f"{path}-objects")
    found = {"there": path, "absent": f"{path}-absent", "none": None, "objects": f"{path}-objects"}
    rows = [records.record_array_or_empty(spark, p, schema).agg(F.lit(k).alias("kind"), F.count("*").alias("n"), F.count("doi").alias("n_doi")) for k, p in found.items()]
    return reduce(DataFrame.unionByName, rows)
