"""The reference queries in DuckDB SQL."""

from __future__ import annotations

import re

from rillstone.functions import keys
from rillstone.operators import context, contracts, release
from rillstone.plans import rulebook as rb
from rillstone.plans.queries import DOCUMENTS, LABELS
from rillstone.plans.views import VIEWS, with_views


#: The columns of r1.
HAS = set(re.findall(r"\bAS (\w+)(?=[,\n])", VIEWS["r1"]))


def present(c: str) -> str:
    return f"nullif({c}, '')" if c in HAS and c != "row_number" else "CAST(NULL AS VARCHAR)"


def alias(group: str) -> str:
    return f"coalesce({', '.join(present(c) for c in group.split('|'))}, NULL)"


def text(x: str) -> str:
    return f"lower(trim(coalesce({x}, '')))"


def identity(b: rb.Rulebook) -> str:
    return "concat_ws(chr(31), " + ", ".join(text(alias(g)) for g in b.duplicate_identity_fields) + ")"


def audit_sql(books: list[rb.Rulebook], book: str) -> str:
    """CTEs a (row_number, rulebook, status, notes) over r1; book is an expression for the rulebook's name."""
    rank = {"needs_review": 1, "rejected": 2}
    ids = " ".join(f"WHEN '{b.name}' THEN {identity(b)}" for b in books)
    levels, notes = [], []
    for b in books:
        rules = [(f"{alias(f)} IS NULL", "rejected" if f in b.reject_if_missing else "needs_review", f"missing {f}") for f in b.required_fields]
        rules += [(f"{alias('|'.join(g))} IS NULL", "rejected" if set(g) & set(b.reject_if_missing) else "needs_review", f"missing one of {'/'.join(g)}") for g in b.required_any_groups]
        rules += [(f"{alias(g)} IS NULL", "needs_review", f"review required for missing {g}") for g in b.review_if_missing]
        rules += [(f"{alias(f)} IS NOT NULL", "rejected", f"forbidden field present: {f}") for f in b.forbidden_fields]
        rules += [("n > 1", "needs_review", "possible duplicate row")]
        levels.append(f"WHEN '{b.name}' THEN greatest(0, " + ", ".join(f"CASE WHEN {c} THEN {rank[s]} ELSE 0 END" for c, s, _ in rules) + ")")
        notes.append(f"WHEN '{b.name}' THEN concat_ws('; ', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, _, n in rules) + ")")
    return f"""{with_views('r1')}, k AS (SELECT *, {book} AS book FROM r1), i AS (SELECT *, CASE book {ids} END AS ident FROM k),
        c AS (SELECT *, count(*) OVER (PARTITION BY book, ident) AS n FROM i),
        a AS (SELECT *, (['approved', 'needs_review', 'rejected'])[1 + CASE book {' '.join(levels)} END] AS validation_status, CASE book {' '.join(notes)} END AS notes FROM c)"""


AUDIT = audit_sql([rb.GENERIC], "'generic'")
R1, D = with_views("r1"), with_views("d1", "d2", "d3", "r1")


def doi(x: str) -> str:
    return f"lower(nullif(regexp_extract({x}, '(?i)10\\.\\d{{4,9}}/\\S+', 0), ''))"


def iso(x: str) -> str:
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in keys.COUNTRIES.items())
    return f"CASE WHEN regexp_matches(trim({x}), '^\\p{{L}}{{3}}$') THEN upper(trim({x})) ELSE CASE lower(trim({x})) {names} END END"


def house(x: str) -> str:
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'starts_with({x}, {p!r})' for p in ps)} THEN '{h}'" for h, ps in keys.PUBLISHERS.items()) + " ELSE 'Unknown' END"


def encoded(x: str) -> str:
    return f"replace(replace(url_encode({x}), '+', '%20'), '*', '%2A')"


COUNTRY = iso(alias("country|geographic_scope|location"))
DOIS = f"SELECT DISTINCT {doi('doi')} AS doi FROM r1 WHERE {doi('doi')} IS NOT NULL"
NUM = "CASE WHEN regexp_matches(trim({0}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN CAST(trim({0}) AS DOUBLE) END"
VALUES = "SELECT row_number, 'value_numeric' AS \"column\", " + NUM.format("value_numeric") + " AS value FROM r1 UNION ALL SELECT row_number, 'measurement_record_count_min', " + NUM.format("measurement_record_count_min") + " FROM r1"
STATS = "count(value) AS n, round(avg(value), 6) AS mean, round(min(value), 6) AS min, round(max(value), 6) AS max, CAST(0 AS BIGINT) AS not_finite"
LABEL = "(" + str(LABELS).replace('"', "'") + ")[1 + row_number % 5]"


def counts(key: str, source: str = "r1", order: str = "row_number", limit: str = "LIMIT 10") -> str:
    return f"SELECT {key} AS key, count(*) AS n, min({order}) AS first_row FROM {source} WHERE nullif({key}, '') IS NOT NULL GROUP BY 1 ORDER BY n DESC, first_row {limit}"


def table(key: str) -> str:
    return f"{R1} SELECT {key} AS key, count(*) AS row_count, coalesce(string_agg(DISTINCT trend_direction, '; ' ORDER BY trend_direction), '') AS trend_notes FROM r1 WHERE {key} IS NOT NULL GROUP BY 1"


#: Records of the batches by field names: k as columns, n (batch, name) the names that any record of a batch has.
FIELD_NAMES = ["doi", "matrix", "value_numeric", "trend_direction", "risk_threshold", "reference_resolution_status", "row_number"]
FIELDS = f"""{R1}, b AS (SELECT *, row_number % 240 AS batch FROM r1),
    k AS (SELECT batch, row_number, doi, CASE WHEN batch % 16 <> 3 THEN matrix END AS matrix, CASE WHEN batch % 16 <> 3 AND batch % 5 = 0 THEN value_numeric END AS value_numeric, CASE WHEN batch % 16 <> 3 AND batch % 7 = 0 THEN trend_direction END AS trend_direction,
            CASE WHEN batch % 16 <> 3 AND batch % 8 = 1 THEN risk_threshold END AS risk_threshold, CASE WHEN batch % 16 = 3 AND row_number % 2 = 0 THEN matrix END AS status, batch % 16 = 3 AS rebuilt FROM b),
    n AS (SELECT DISTINCT batch, unnest(list_filter([CASE WHEN rebuilt OR doi IS NOT NULL THEN 'doi' END, CASE WHEN matrix IS NOT NULL THEN 'matrix' END, CASE WHEN value_numeric IS NOT NULL THEN 'value_numeric' END, CASE WHEN trend_direction IS NOT NULL THEN 'trend_direction' END,
            CASE WHEN risk_threshold IS NOT NULL THEN 'risk_threshold' END, CASE WHEN rebuilt THEN 'reference_resolution_status' END, 'row_number'], lambda x: x IS NOT NULL)) AS name FROM k)"""


def _named(b: rb.Rulebook) -> set[str]:
    """The field names of a rulebook."""
    return {n for kind in rb.KINDS for x in getattr(b, kind) for f in (x if isinstance(x, tuple) else (x,)) for n in f.split("|")}


RULED = [rb.GENERIC.overridden(d | {"name": n}) for n, d in DOCUMENTS.items()]
A_LAST = "SELECT doi, arg_max(struct_pack(publisher, journal, year, citation_count), load_order) AS s FROM d1 GROUP BY doi"
I_LATEST = "SELECT country_iso3, indicator, arg_min(struct_pack(year, value), pos) AS s FROM d3 WHERE value IS NOT NULL GROUP BY ALL"
I_MAP = f"SELECT country_iso3, count(*) AS n, max(s.value) FILTER (WHERE indicator = 'SP.POP.TOTL') AS population FROM ({I_LATEST}) GROUP BY 1"
ENRICHED = f"{D}, e AS (SELECT r.*, a.doi AS a_doi, a.s.publisher AS publisher, a.s.journal AS a_journal, a.s.year AS year, a.s.citation_count AS citation_count, b.doi AS b_doi, b.journal AS b_journal, b.cited_by_count AS cited_by_count, b.is_oa AS is_oa, b.concepts_text AS concepts_text, {iso('r.country')} AS iso FROM r1 r LEFT JOIN ({A_LAST}) a ON a.doi = {doi('r.doi')} LEFT JOIN d2 b ON b.doi = {doi('r.doi')}), f AS (SELECT e.*, coalesce(i.n, 0) AS n_indicators, i.population AS population FROM e LEFT JOIN ({I_MAP}) i ON i.country_iso3 = e.iso)"
LONG = "length(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) >= 200"
INTEGRITY = f"CASE WHEN pages IS NULL THEN 'pdf_corrupted' WHEN pages <= 1 THEN 'pdf_one_page_only' WHEN NOT ({LONG}) THEN 'abstract_only' ELSE 'fulltext_ready' END"
PAIR = f"concat_ws(chr(31), {text(alias('doi'))}, {text(alias(rb.POLLUTANT))}, {text(alias('matrix'))})"
RANK = "coalesce(nullif(list_position(" + str(contracts.SOURCE_KINDS) + ", source_kind), 0), 5)"
RESOLVED = f"{with_views('r5', 'r5_map')}, m AS (SELECT short_ref, min(doi) AS m FROM r5_map GROUP BY 1), v AS (SELECT r5.*, CASE WHEN coalesce(trim(m.m), '') <> '' THEN {doi('m.m')} END AS doi, CASE WHEN m.short_ref IS NOT NULL AND coalesce(trim(m.m), '') = '' THEN 'blank' WHEN m.short_ref IS NULL THEN 'unresolved' ELSE 'matched' END AS doi_match_status FROM r5 LEFT JOIN m USING (short_ref))"
PATHS = " UNION ALL ".join(f"SELECT '{p}' AS path, '{k}' AS kind, {str(p == 'api/validated_rows.json').lower()} AS present" for k, ps in (("required", release.REQUIRED_PATHS), ("optional", release.OPTIONAL_PATHS)) for p in ps)

ORACLES = {
    "q_audit_rows": f"{AUDIT} SELECT row_number, 'generic' AS applied_rulebook, validation_status, notes FROM a",
    "q_audit_counts": f"{AUDIT} SELECT count(*) AS total, count(*) FILTER (WHERE validation_status = 'approved') AS approved, count(*) FILTER (WHERE validation_status = 'needs_review') AS needs_review, count(*) FILTER (WHERE validation_status = 'rejected') AS rejected FROM a",
    "q_audit_notes_freq": f"{AUDIT} SELECT note, count(*) AS n FROM (SELECT unnest(string_split(notes, '; ')) AS note FROM a) WHERE note <> '' GROUP BY 1",
    "q_duplicates": f"{AUDIT} SELECT row_number, validation_status FROM a WHERE n > 1",
    "q_duplicate_groups": "SELECT n AS copies, count(*) AS n_groups FROM (SELECT count(*) AS n FROM documents GROUP BY lower(trim(text)) HAVING count(*) > 1) GROUP BY 1",
    "q_multi_rulebook": audit_sql(list(rb.RULEBOOKS.values()), "(" + str(list(rb.RULEBOOKS)) + ")[1 + row_number % 4]") + " SELECT row_number, book AS applied_rulebook, validation_status, notes FROM a",
    "q_route_label": f"{R1} SELECT label, CASE label WHEN '{LABELS[0]}' THEN 'record' WHEN '{LABELS[1]}' THEN 'synthesis' WHEN '{LABELS[2]}' THEN 'reference_rebuild' ELSE 'generic' END AS by_word, CASE WHEN contains(lower(label), 'science') THEN 'synthesis' WHEN contains(lower(label), 'nature') THEN 'record' WHEN contains(lower(label), 'est') OR contains(lower(label), 'tfa') THEN 'reference_rebuild' ELSE 'generic' END AS by_substring, count(*) AS n FROM (SELECT {LABEL} AS label FROM r1) GROUP BY 1, 2, 3",
    "q_route_columns": f"{FIELDS} SELECT batch, CASE WHEN bool_or(s) THEN 'synthesis' WHEN bool_or(r) THEN 'record' WHEN bool_or(b) THEN 'reference_rebuild' ELSE 'generic' END AS rulebook FROM (SELECT batch, name IN ('trend_direction', 'risk_threshold') AS s, name = 'value_numeric' AS r, name = 'reference_resolution_status' AS b FROM n) GROUP BY 1",
    "q_field_overlap": f"{FIELDS}, r(rulebook, name) AS (VALUES {', '.join(f"('{b.name}', '{n}')" for b in rb.RULEBOOKS.values() for n in FIELD_NAMES if n in _named(b))}) SELECT batch, rulebook, string_agg(name, ',' ORDER BY name) AS fields FROM n JOIN r USING (name) GROUP BY 1, 2",
    "q_variant_columns": f"{FIELDS} SELECT batch, row_number, round(try_cast(value_numeric AS DOUBLE), 6) AS value_numeric, trend_direction, status AS reference_resolution_status, CAST(NULL AS VARCHAR) AS absent FROM k",
    "q_ruled_audit": f"{audit_sql(RULED, "CASE WHEN source_kind LIKE '%table' THEN 'strict' ELSE 'by_site' END")} SELECT row_number, book AS applied_rulebook, validation_status, notes FROM a",
    "q_row_numbers": f"{R1} SELECT row_number AS position, row_number() OVER (ORDER BY row_number) AS row_number FROM r1",
    "q_doi_inventory": f"{R1} {DOIS}",
    "q_doi_from_text": f"{with_views('r3')}, x AS (SELECT doc_id, regexp_extract_all(text, '(?i)10\\.\\d{{4,9}}/[-._;()/:A-Z0-9]+') AS d FROM r3), y AS (SELECT doc_id, unnest(d) AS doi, unnest(range(len(d))) AS pos FROM x) SELECT doi, min(struct_pack(doc_id, pos)).doc_id AS first_doc, CAST(min(struct_pack(doc_id, pos)).pos AS INT) AS first_pos FROM y GROUP BY doi",
    "q_publisher_mix": f"{R1}, p AS (SELECT {house('doi')} AS publisher FROM ({DOIS})) SELECT publisher, publisher <> 'Unknown' AS supported, CASE WHEN publisher = 'Unknown' THEN 'unsupported publisher' END AS failure_reason, count(*) AS n FROM p GROUP BY 1, 2, 3",
    "q_doi_slug": f"{R1} SELECT doi, regexp_replace(regexp_replace(doi, '[^0-9A-Za-z._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS slug FROM ({DOIS})",
    "q_iso3": f"{R1} SELECT row_number, {iso('country')} AS iso3 FROM r1",
    "q_country_inventory": f"{R1} SELECT DISTINCT {COUNTRY} AS country_iso3 FROM r1 WHERE {COUNTRY} IS NOT NULL",
    "q_safe_number": f"{R1} SELECT row_number, round({NUM.format('value_numeric')}, 6) AS value FROM r1",
    "q_numeric_summary": f"{R1} SELECT {STATS} FROM ({VALUES})",
    "q_numeric_by_column": f"{R1} SELECT \"column\", {STATS} FROM ({VALUES}) GROUP BY 1",
    "q_numeric_lineitem": f"SELECT \"column\", {STATS} FROM (SELECT 'value_numeric' AS \"column\", l_quantity AS value FROM lineitem UNION ALL SELECT 'value_max', l_extendedprice FROM lineitem UNION ALL SELECT 'value_min', l_discount FROM lineitem) GROUP BY 1",
    "q_threshold_summary": f"{R1} SELECT count(risk_threshold) AS n, CAST(min(risk_threshold) AS DOUBLE) AS min, CAST(max(risk_threshold) AS DOUBLE) AS max, CAST(0 AS BIGINT) AS not_finite FROM r1",
    "q_top_pollutants": f"{R1} {counts(alias(rb.POLLUTANT))}",
    "q_top_matrices": f"{R1} {counts('matrix')}",
    "q_top_geographies": f"{R1} {counts(alias(rb.GEOGRAPHY))}",
    "q_trend_counts": f"{R1} SELECT trend_direction AS key, count(*) AS n FROM r1 WHERE trend_direction IS NOT NULL GROUP BY 1",
    "q_key_counts": f"{R1} " + " UNION ALL ".join(f"SELECT '{k}' AS kind, {e} AS key, count(*) AS n, min(row_number) AS first_row FROM r1 WHERE {e} IS NOT NULL GROUP BY 1, 2" for k, e in (("pollutant", alias(rb.POLLUTANT)), ("matrix", alias("matrix")), ("geography", alias(rb.GEOGRAPHY)), ("trend", alias("trend_direction")))),
    "q_pollutant_table": table(alias(rb.POLLUTANT)),
    "q_matrix_table": table(alias("matrix")),
    "q_geography_table": table(alias(rb.GEOGRAPHY)),
    "q_enrich_a": f"{ENRICHED} SELECT row_number, publisher, a_journal AS journal, year, citation_count FROM f",
    "q_enrich_b": f"{ENRICHED} SELECT row_number, b_journal AS journal, cited_by_count, is_oa, concepts_text AS concepts FROM f",
    "q_enrich_country": f"{ENRICHED} SELECT row_number, iso AS country_iso3, n_indicators, population FROM f",
    "q_enriched_flat": f"{ENRICHED} SELECT a_doi IS NOT NULL AS in_a, b_doi IS NOT NULL AS in_b, n_indicators > 0 AS has_indicators, count(*) AS n FROM f GROUP BY 1, 2, 3",
    "q_context_top_publishers": f"{ENRICHED} {counts('publisher', 'f')}",
    "q_context_top_journals": f"{ENRICHED} {counts('coalesce(a_journal, b_journal)', 'f')}",
    "q_dimension_publishers": f"{with_views('d1')} {counts('publisher', 'd1', 'load_order')}",
    "q_concepts": f"{ENRICHED} SELECT key, count(*) AS n, min(row_number) AS first_row FROM (SELECT row_number, unnest(string_split(concepts_text, ';')) AS key FROM f) GROUP BY 1",
    "q_indicator_coverage": f"{ENRICHED}, l AS ({I_LATEST}) SELECT indicator AS key, count(*) AS n FROM f JOIN l ON l.country_iso3 = f.iso GROUP BY 1",
    "q_context_sizes": f"{with_views('d1', 'd2', 'd3')} SELECT (SELECT count(DISTINCT doi) FROM d1) AS works_a, (SELECT count(DISTINCT doi) FROM d2) AS works_b, (SELECT count(*) FROM d3) AS indicator_rows",
    "q_context_overview": f"{R1} SELECT count(DISTINCT {doi('doi')}) AS doi_count, count(DISTINCT {COUNTRY}) AS country_count, false AS fetched FROM r1",
    "q_latest_indicator": f"{with_views('d3')} SELECT country_iso3, indicator, s.year AS year, s.value AS value FROM ({I_LATEST})",
    "q_request_manifest": f"{R1} SELECT 'works_a' AS service, doi AS request_key, '{keys.WORKS_A}' || {encoded('doi')} AS url FROM ({DOIS}) UNION ALL SELECT 'works_b', doi, '{keys.WORKS_B}' || {encoded('doi')} FROM ({DOIS}) UNION ALL SELECT 'indicators', c || '/' || i, '{keys.INDICATORS_URL}' || c || '/indicator/' || i || '?format=json&date=2010%3A2024&per_page=20000' FROM (SELECT DISTINCT {COUNTRY} AS c FROM r1 WHERE {COUNTRY} IS NOT NULL), (SELECT unnest({context.INDICATORS}) AS i)",
    "q_fetch_results": f"{D}, q AS (SELECT 'works_a' AS service, doi, doi IN (SELECT doi FROM d1) AS ok FROM ({DOIS}) UNION ALL SELECT 'works_b', doi, doi IN (SELECT doi FROM d2) FROM ({DOIS}) UNION ALL SELECT 'indicators', c || i, false FROM (SELECT DISTINCT {COUNTRY} AS c FROM r1 WHERE {COUNTRY} IS NOT NULL), (SELECT unnest({context.INDICATORS}) AS i)) SELECT service, CASE WHEN ok THEN 'ok' ELSE 'error' END AS status, CASE WHEN NOT ok THEN CASE WHEN service = 'works_b' AND doi LIKE '%7' THEN 'HTTP Error 404: Not Found' ELSE 'no payload has landed' END END AS message, count(*) AS n FROM q GROUP BY 1, 2, 3",
    "q_flatten_a": f"{with_views('d1')} SELECT concat('/p/', load_order, '.json') AS file_path, doi, concat('T', load_order) AS title, publisher, journal, CAST(CASE WHEN load_order % 4 = 0 THEN year ELSE year + 1 END AS INT) AS year, citation_count, CAST(0 AS BIGINT) AS author_count FROM d1 WHERE load_order % 50 <> 2",
    "q_flatten_b": f"{with_views('d2')} SELECT concat('W', load_order) AS openalex_id, doi, cited_by_count, journal, is_oa, coalesce(concepts_text, '') AS concepts, journal || ';Lab' AS institutions FROM d2",
    "q_flatten_indicators": f"{with_views('d3')} SELECT country_iso3, indicator, CAST(pos AS BIGINT) AS pos, year, value FROM d3",
    "q_integrity": f"{with_views('r2')} SELECT doc_id, {INTEGRITY} AS integrity_status FROM r2",
    "q_ladder": f"{with_views('r4')} SELECT target_id, min(rung) FILTER (WHERE ok) AS rung, arg_min(source_type, rung) FILTER (WHERE ok) AS source_type FROM (SELECT *, coalesce(http_status = 200 AND starts_with(body_head, '%PDF'), false) AS ok FROM r4) GROUP BY 1",
    "q_source_gate": f"{with_views('r2')}, g AS (SELECT doc_id, concat_ws('; ', CASE WHEN NOT identity_match THEN 'wrong_article' END, CASE WHEN {INTEGRITY} IN ('pdf_one_page_only', 'abstract_only') THEN {INTEGRITY} END, CASE WHEN NOT ({LONG}) AND source <> 'src1' THEN 'no usable text' END) AS reasons FROM r2) SELECT doc_id, reasons = '' AS passed, reasons FROM g",
    "q_harvest_outcome": f"{with_views('r4')}, h AS (SELECT *, {house('doi')} AS publisher FROM r4), g AS (SELECT publisher, CASE WHEN publisher = 'Unknown' THEN 'unsupported publisher' WHEN publisher = 'Wiley' THEN 'missing {contracts.SERVICE_KEYS['Wiley']}' WHEN coalesce(http_status = 200 AND starts_with(body_head, '%PDF'), false) THEN NULL ELSE 'http ' || coalesce(CAST(http_status AS VARCHAR), 'none') END AS failure_reason FROM h) SELECT publisher, CASE WHEN failure_reason IS NULL THEN 'ok' ELSE 'failed' END AS status, CASE WHEN failure_reason IS NULL THEN 'publisher_api_pdf' ELSE 'none' END AS source_type, failure_reason, count(*) AS n FROM g GROUP BY ALL",
    "q_status_vocabulary": f"{with_views('r2')} SELECT 'odd_' || lang AS value, count(*) AS n FROM r2 WHERE doc_id % 9 = 0 GROUP BY 1",
    "q_confidence": f"{R1} SELECT extraction_confidence AS value, count(*) AS n FROM r1 WHERE extraction_confidence NOT IN ('high', 'medium', 'low') OR extraction_confidence IS NULL GROUP BY 1",
    "q_provenance_min": f"{R1} SELECT row_number, concat_ws('; ', " + ", ".join(f"CASE WHEN {alias('|'.join(g))} IS NULL THEN '{'/'.join(g)}' END" for g in contracts.PROVENANCE_GROUPS) + ") AS missing FROM r1",
    "q_unresolved": f"{R1}, u AS (SELECT row_number, CASE WHEN {doi('doi')} IS NULL AND nullif(paper_title, '') IS NULL THEN 'ambiguous identity' WHEN {doi('doi')} IS NULL THEN 'no doi' WHEN source_kind = 'figure' THEN 'inaccessible' WHEN {NUM.format('value_numeric')} IS NULL THEN 'implicit values' END AS reason FROM r1) SELECT * FROM u WHERE reason IS NOT NULL",
    "q_conflicts": f"{R1}, p AS (SELECT row_number, source_kind, {PAIR} AS id, {RANK} AS rank, unit_standardized AS v FROM r1), g AS (SELECT id, count(DISTINCT v) > 1 AS conflict, min(struct_pack(rank, row_number)).row_number AS f FROM p GROUP BY id) SELECT row_number, conflict, source_kind FROM p JOIN g USING (id) WHERE conflict OR row_number = f",
    "q_source_priority": f"{R1}, p AS (SELECT row_number, source_kind, row_number() OVER (PARTITION BY {PAIR} ORDER BY {RANK}, row_number) AS k FROM r1) SELECT source_kind, count(*) AS n FROM p WHERE k = 1 GROUP BY 1",
    "q_granularity": f"{R1} SELECT md5({identity(rb.RECORD)}) AS identity, count(*) AS n FROM r1 GROUP BY 1 HAVING count(*) > 1",
    "q_no_record_papers": f"{D}, r AS (SELECT {doi('doi')} AS doi FROM r1 WHERE {doi('doi')} IS NOT NULL) SELECT doi, count(*) AS n_records, false AS no_record FROM r GROUP BY 1 UNION ALL SELECT DISTINCT doi, CAST(0 AS BIGINT), true FROM d1 WHERE doi NOT IN (SELECT doi FROM r)",
    "q_doi_title_consistency": f"{R1}, t AS (SELECT {doi('doi')} AS doi, lower(trim(CASE WHEN row_number % 37 = 0 THEN 'Other' ELSE paper_title END)) AS title FROM r1) SELECT doi, count(DISTINCT title) AS n_titles FROM t WHERE doi IS NOT NULL AND title <> '' GROUP BY 1 HAVING count(DISTINCT title) > 1",
    "q_reference_resolution": f"{RESOLVED} SELECT row_id, doi, doi_match_status FROM v",
    "q_mapped_audit": f"{RESOLVED}, x AS (SELECT doi, count(*) OVER (PARTITION BY lower(coalesce(doi, '')), lower(trim(chemical_name)), lower(trim(medium)), lower(location)) AS n FROM v) SELECT count(*) AS total, count(*) FILTER (WHERE doi IS NOT NULL AND n = 1) AS approved, count(*) FILTER (WHERE doi IS NOT NULL AND n > 1) AS needs_review, count(*) FILTER (WHERE doi IS NULL) AS rejected FROM x",
    "q_benchmark_doi_reuse": f"{RESOLVED} SELECT row_id, doi FROM v WHERE doi = '10.1021/benchmark'",
    "q_reconcile": f"{with_views('r5')} SELECT row_id, CAST(1 AS BIGINT) AS n_in, CAST(CASE WHEN row_id % 97 = 5 THEN 0 ELSE 2 END AS BIGINT) AS n_out FROM r5 WHERE row_id % 97 = 5 OR row_id % 89 = 3",
    "q_reconcile_by_difference": f"{with_views('r5')} SELECT row_id, CAST(1 AS BIGINT) AS n_in, CAST(CASE WHEN row_id % 97 = 5 THEN 0 ELSE 2 END AS BIGINT) AS n_out FROM r5 WHERE row_id % 97 = 5 OR row_id % 89 = 3",
    "q_route_many_aliases": """
        WITH l AS (SELECT concat_ws('/', 'Batch', source, lang) AS label, count(*) AS n FROM documents GROUP BY 1),
        a AS (SELECT c_custkey AS k, '_src' || (c_custkey % 9) || '_' || (['en', 'de', 'fr', 'es', 'xx'])[c_custkey % 5 + 1] || '_' AS words FROM customer),
        m AS (SELECT label, min(k) AS k FROM l JOIN a ON contains('_' || regexp_replace(lower(label), '[^a-z0-9]+', '_', 'g') || '_', words) GROUP BY 1)
        SELECT label, coalesce('book' || k, 'generic') AS rulebook, n FROM l LEFT JOIN m USING (label)""",
    "q_release_rows": f"{AUDIT} SELECT row_number, doi, validation_status FROM a WHERE validation_status = 'approved'",
    "q_release_gate": f"{AUDIT} SELECT 'all' AS kind, count(*) AS not_approved, false AS passed FROM a WHERE validation_status <> 'approved' UNION ALL SELECT 'approved', CAST(0 AS BIGINT), true",
    "q_release_exclusions": f"{AUDIT} SELECT validation_status, note, count(*) AS n FROM (SELECT validation_status, unnest(string_split(notes, '; ')) AS note FROM a WHERE validation_status <> 'approved') GROUP BY 1, 2",
    "q_bundle_completeness": f"""{AUDIT}, p AS (SELECT * FROM a WHERE validation_status = 'approved'), s AS (SELECT 'api/validated_rows.json' AS path, count(*) AS n_rows FROM p UNION ALL SELECT 'api/analytics_summary.json', 1
        UNION ALL SELECT 'reports/pollutant_summary.csv', count(DISTINCT {alias(rb.POLLUTANT)}) FROM p UNION ALL SELECT 'reports/matrix_summary.csv', count(DISTINCT {alias('matrix')}) FROM p), o AS ({PATHS})
        SELECT path, kind, s.path IS NOT NULL OR path IN ('api/publication_payload.json', 'release_manifest.json', 'README.md', 'site_index.json', 'release_notes.md', 'public_api_schema.json') AS present, n_rows, CAST(0 AS BIGINT) AS fields_missing FROM o LEFT JOIN s USING (path)""",
    "q_release_diff": f"""{AUDIT}, x AS (SELECT row_number AS n, row_number % 613 <> 5 AS was, row_number % 701 <> 9 AS is_now, row_number % 509 = 3 AS altered FROM a)
        SELECT CAST(('0x' || substr(sha256(CAST(n AS VARCHAR)), 1, 2)) AS INTEGER) AS range, n AS row_number, CASE WHEN NOT was THEN 'added' WHEN NOT is_now THEN 'removed' ELSE 'changed' END AS change FROM x WHERE (was OR is_now) AND (was <> is_now OR altered)""",
    "q_analytics_document": f"""{R1}, d1 AS ({VIEWS['d1']}), d2 AS ({VIEWS['d2']}) SELECT (SELECT count(*) FROM r1) AS total_rows, {', '.join(f"(SELECT string_agg(key || '=' || n, ';' ORDER BY n DESC, first_row) FROM ({counts(e)})) AS {c}" for c, e in (('pollutants', alias(rb.POLLUTANT)), ('matrices', 'matrix'), ('geographies', alias(rb.GEOGRAPHY))))},
        (SELECT count(DISTINCT trend_direction) FROM r1) AS n_trends, (SELECT count(value) FROM ({VALUES})) AS n_numbers, (SELECT round(avg(value), 6) FROM ({VALUES})) AS mean, (SELECT CAST(max(risk_threshold) AS DOUBLE) FROM r1) AS threshold, (SELECT count(DISTINCT {doi('doi')}) FROM r1) AS doi_count, (SELECT count(DISTINCT doi) FROM d2) AS works_b""",
    "q_context_document": f"""{with_views('d1', 'd2', 'd3')}, l AS ({I_LATEST}) SELECT (SELECT count(*) FROM d1) AS crossref_rows, (SELECT count(*) FROM d2) AS openalex_rows, (SELECT count(*) FROM d3) AS world_bank_rows, (SELECT count(*) FROM l) AS world_bank_latest_rows,
        (SELECT string_agg(key || '=' || n, ';' ORDER BY n DESC, first_row) FROM ({counts('publisher', 'd1', 'load_order')})) AS publishers, (SELECT string_agg(key || '=' || n, ';' ORDER BY n DESC, first_row) FROM ({counts('journal', 'd2', 'load_order')})) AS journals, (SELECT count(DISTINCT indicator) FROM l) AS n_indicators""",
    "q_batch_audit": f"{AUDIT} SELECT row_number, 'generic' AS applied_rulebook, validation_status, notes FROM a",
    "q_stored_dimension": f"{ENRICHED} SELECT row_number, publisher, a_journal AS journal, year, citation_count FROM f",
    "q_quarantine": """
        WITH k(kind, i) AS (VALUES ('works_a', 0), ('works_b', 1), ('indicators', 2)), c AS (SELECT kind, i, c_custkey AS n, CASE WHEN c_custkey % 31 = i THEN 'no JSON' WHEN c_custkey % 37 = i THEN 'empty' WHEN c_custkey % 41 = i THEN 'foreign document' END AS dead FROM customer, k)
        SELECT kind, 'rows' AS outcome, CAST(sum(CASE kind WHEN 'indicators' THEN n % 3 + 1 ELSE 1 END) AS BIGINT) AS n FROM c WHERE dead IS NULL GROUP BY kind UNION ALL SELECT kind, dead, count(*) FROM c WHERE dead IS NOT NULL GROUP BY ALL""",
    "q_flatten_caps": """
        WITH c AS (SELECT c_custkey AS n FROM customer), i AS (SELECT n, name, min(i) AS i FROM (SELECT n, i, CASE WHEN i % 5 <> 3 THEN 'I' || ((i * 7 + n) % 16) END AS name FROM (SELECT n, unnest(range(0, n % 19 + 1)) AS i FROM c)) WHERE name IS NOT NULL GROUP BY ALL),
        t AS (SELECT n, string_agg(name, ';' ORDER BY i) AS institutions FROM (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY n ORDER BY i) <= 10) GROUP BY n)
        SELECT 'W' || n AS openalex_id, array_to_string(list_filter(list_transform(range(0, least(n % 8 + 1, 5)), lambda i: CASE WHEN i % 4 <> 2 THEN 'C' || (i + n % 3) END), lambda x: x IS NOT NULL), ';') AS concepts, institutions FROM c JOIN t USING (n)""",
    "q_published_conformance": f"{R1} SELECT 'paper_title' AS field, count(*) FILTER (WHERE nullif(paper_title, '') IS NULL) AS n FROM r1 UNION ALL SELECT 'doi', count(*) FILTER (WHERE doi IS NULL) FROM r1 UNION ALL SELECT 'validation_status', CAST(0 AS BIGINT)",
    "q_roundtrip_csv": f"{AUDIT} SELECT row_number, validation_status, '[' || list_aggregate(list_transform(list_filter(string_split(notes, '; '), lambda x: x <> ''), lambda x: '\"' || x || '\"'), 'string_agg', ',') || ']' AS validation_notes, doi, nullif(country, '') AS country FROM a WHERE notes <> '' UNION ALL SELECT row_number, validation_status, '[]', doi, nullif(country, '') FROM a WHERE notes = ''",
    "q_roundtrip_json": f"{AUDIT} SELECT row_number, validation_status, notes, doi FROM a",
    "q_roundtrip_split": f"{AUDIT} SELECT row_number, doi, validation_status FROM a",
    "q_dimension_journals": f"{with_views('d2')} {counts('journal', 'd2', 'load_order')}",
    "q_dimension_summary": f"{with_views('d1', 'd2', 'd3')}, l AS ({I_LATEST}) SELECT 'rows' AS kind, 'crossref_works' AS key, count(*) AS n FROM d1 UNION ALL SELECT 'rows', 'openalex_works', count(*) FROM d2 UNION ALL SELECT 'rows', 'world_bank_records', count(*) FROM d3 UNION ALL SELECT 'rows', 'world_bank_latest', count(*) FROM l UNION ALL SELECT 'publisher', key, n FROM ({counts('publisher', 'd1', 'load_order')}) UNION ALL SELECT 'journal', key, n FROM ({counts('journal', 'd2', 'load_order')}) UNION ALL SELECT 'indicator', indicator, count(*) FROM l GROUP BY indicator",
    "q_context_tables": f"{with_views('d1', 'd2', 'd3')}, l AS ({I_LATEST}) SELECT 'crossref_works' AS name, count(*) AS n, count(DISTINCT doi) AS n_keys, count(publisher) AS n_values FROM d1 UNION ALL SELECT 'openalex_works', count(*), count(DISTINCT doi), count(journal) FROM d2 UNION ALL SELECT 'world_bank_records', count(*), count(DISTINCT country_iso3), count(value) FROM d3 UNION ALL SELECT 'world_bank_latest', count(*), count(DISTINCT country_iso3), count(s.value) FROM l",
    "q_payload_order": "SELECT doi, CAST(arg_max(n, k) AS INT) AS citation_count FROM (SELECT concat('10.1016/n', c_nationkey % 10) AS doi, c_nationkey AS k, count(*) AS n FROM customer GROUP BY ALL) GROUP BY doi",
    "q_release_hash": f"""{AUDIT}, h AS (SELECT sha256(concat_ws(chr(31), 'generic', notes, CAST(row_number AS VARCHAR), validation_status)) AS d FROM a)
        SELECT count(*) AS n_rows, concat_ws('-', {', '.join(f"CAST(coalesce(sum(CAST(('0x' || substr(d, {1 + 15 * i}, 15)) AS BIGINT)), 0) AS VARCHAR)" for i in range(4))}) AS hash FROM h""",
    "q_release_inventory": f"{AUDIT} SELECT 'api/validated_rows' AS name, true AS present, (SELECT count(*) FROM a WHERE validation_status = 'approved') AS n_rows UNION ALL SELECT 'reports/pollutant_summary', true, (SELECT count(DISTINCT {alias(rb.POLLUTANT)}) FROM r1) UNION ALL SELECT 'reports/site_index', false, NULL",
    "q_summary_document": f"{AUDIT}, x AS (SELECT unnest(string_split(notes, '; ')) AS note FROM a WHERE notes <> '') SELECT count(*) AS total, count(*) FILTER (WHERE validation_status = 'approved') AS approved, count(*) FILTER (WHERE validation_status = 'needs_review') AS needs_review, count(*) FILTER (WHERE validation_status = 'rejected') AS rejected, (SELECT count(DISTINCT note) FROM x) AS n_notes, (SELECT count(*) FROM x) AS n_noted, 'generic' AS rulebook_name FROM a",
    "q_roundtrip_twin": f"{with_views('r4')}, h AS (SELECT *, {house('doi')} AS publisher FROM r4), g AS (SELECT target_id, publisher, CASE WHEN publisher = 'Unknown' THEN 'unsupported publisher' WHEN coalesce(http_status = 200 AND starts_with(body_head, '%PDF'), false) THEN NULL ELSE 'http ' || coalesce(CAST(http_status AS VARCHAR), 'none') END AS failure_reason FROM h) SELECT form, publisher, CASE WHEN failure_reason IS NULL THEN 'ok' ELSE 'failed' END AS status, failure_reason, count(*) AS n, CAST(sum(target_id) AS BIGINT) AS targets FROM g, (SELECT unnest(['json', 'csv']) AS form) GROUP BY ALL",
    "q_roundtrip_enriched": f"{ENRICHED} SELECT row_number, publisher, b_journal AS journal, n_indicators, population FROM f",
    "q_schema_union": f"{with_views('r1', 'r5', 'r4')} SELECT * , count(*) AS n FROM (SELECT true AS has_row_number, false AS has_row_id, false AS has_rung, doi IS NOT NULL AS has_doi, false AS has_medium FROM r1 UNION ALL SELECT false, row_id IS NOT NULL, false, false, medium IS NOT NULL FROM r5 UNION ALL SELECT false, false, true, doi IS NOT NULL, false FROM r4) GROUP BY ALL",
    "q_optional_scan": f"{R1} SELECT 'there' AS kind, count(*) AS n, count(doi) AS n_doi FROM r1 UNION ALL SELECT unnest(['absent', 'none', 'objects']), 0, 0",
    "q_array_scan": f"{R1} SELECT row_number, doi, matrix FROM r1",
    "q_rule_table": f"""{R1}, n AS (SELECT 'doi' AS field, count(doi) AS n_present FROM r1 UNION ALL SELECT 'matrix', count(nullif(matrix, '')) FROM r1 UNION ALL SELECT 'unit_original', count(unit_original) FROM r1 UNION ALL SELECT 'unit_standardized', count(unit_standardized) FROM r1 UNION ALL SELECT 'paper_title', count(nullif(paper_title, '')) FROM r1 UNION ALL SELECT 'evidence_page', count(evidence_page) FROM r1),
        r(rule_kind, ordinal, field) AS (VALUES ('required_fields', 0, 'paper_title'), ('required_fields', 1, 'doi'), ('required_fields', 2, 'matrix'), ('review_if_missing', 0, 'unit_original'), ('review_if_missing', 1, 'unit_standardized'), ('required_any_groups', 1, 'matrix'), ('required_any_groups', 2, 'evidence_page'), ('duplicate_identity_fields', 0, 'doi'), ('duplicate_identity_fields', 2, 'matrix'), ('reject_if_missing', 0, 'paper_title'), ('reject_if_missing', 1, 'doi'))
        SELECT rule_kind, ordinal, field, n_present FROM r JOIN n USING (field)""",
}
