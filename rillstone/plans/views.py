"""Views of the driver tables in the record model; each SQL runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "r1": r"""
SELECT event_id + 1 AS row_number,
  CASE WHEN event_id % 17 = 0 THEN '' ELSE concat('Study ', cast(user_id AS string)) END AS paper_title,
  CASE WHEN event_id % 23 = 0 THEN NULL
       WHEN event_id % 5 = 0 THEN concat('https://doi.org/10.1016/J.U', cast(user_id AS string))
       WHEN user_id % 4 = 0 THEN concat('10.1016/j.u', cast(user_id AS string))
       WHEN user_id % 4 = 1 THEN concat('10.1007/s', cast(user_id AS string))
       WHEN user_id % 4 = 2 THEN concat('10.1002/w', cast(user_id AS string))
       ELSE concat('10.1126/a', cast(user_id AS string)) END AS doi,
  CASE WHEN event_id % 7 = 0 THEN event_type END AS pollutant_group,
  CASE WHEN event_id % 7 BETWEEN 1 AND 4 THEN upper(event_type) END AS pollutant_original,
  CASE WHEN event_id % 7 = 5 THEN concat(' ', event_type, ' ') END AS pollutant,
  CASE cast(regexp_extract(props, '[0-9]+', 0) AS int) % 5
       WHEN 0 THEN 'river water' WHEN 1 THEN 'Soil' WHEN 2 THEN 'sediment' WHEN 3 THEN '' END AS matrix,
  CASE WHEN event_id % 11 = 0 THEN 'global' END AS geographic_scope,
  CASE WHEN event_id % 3 = 0 THEN concat('Site ', cast(user_id % 20 AS string)) END AS location,
  CASE user_id % 9 WHEN 0 THEN 'China' WHEN 1 THEN 'Germany' WHEN 2 THEN 'usa' WHEN 3 THEN 'DEU'
       WHEN 4 THEN 'Atlantis' WHEN 5 THEN '' WHEN 6 THEN ' japan ' WHEN 7 THEN 'South Korea' END AS country,
  CASE WHEN event_id % 4 <> 0 THEN substr(cast(ts AS string), 1, 7) END AS temporal_window,
  CASE event_id % 13 WHEN 0 THEN 'n/a' WHEN 1 THEN ' 1e3 ' WHEN 2 THEN '' ELSE cast(value AS string) END AS value_numeric,
  'ng/L' AS unit_original,
  CASE WHEN event_id % 2 = 0 THEN 'ng/L' END AS unit_standardized,
  CASE WHEN event_id % 6 <> 0 THEN cast(event_id % 300 AS string) END AS evidence_page,
  CASE event_id % 10 WHEN 0 THEN 'increasing' WHEN 1 THEN 'decreasing' WHEN 2 THEN 'stable' END AS trend_direction,
  CASE WHEN event_id % 29 = 0 THEN '0.1' END AS risk_threshold,
  CASE WHEN event_id % 31 = 0 THEN cast(event_id AS string) END AS measurement_record_count_min,
  CASE WHEN event_id % 101 = 0 THEN '1.0' END AS model_prediction,
  CASE event_id % 8 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'HIGH' ELSE 'high' END AS extraction_confidence,
  CASE event_id % 4 WHEN 0 THEN 'supplement_table' WHEN 1 THEN 'main_table' WHEN 2 THEN 'paragraph' ELSE 'figure' END AS source_kind
FROM events""",
    "d1": r"""
SELECT concat('10.1016/j.u', cast(c_custkey AS string)) AS doi, c_custkey * 2 AS load_order,
  c_mktsegment AS publisher, concat('Journal ', cast(c_nationkey AS string)) AS journal,
  cast(1990 + c_custkey % 30 AS int) AS year, cast(c_custkey % 97 AS int) AS citation_count
FROM customer
UNION ALL
SELECT concat('10.1016/j.u', cast(c_custkey AS string)), c_custkey * 2 + 1,
  'LATE ROW', NULL, cast(2024 AS int), cast(0 AS int)
FROM customer WHERE c_custkey % 10 = 0""",
    "d2": r"""
SELECT concat('10.1007/s', cast(c_custkey AS string)) AS doi, c_custkey AS load_order,
  concat('Source ', cast(c_nationkey AS string)) AS journal, cast(c_custkey % 53 AS int) AS cited_by_count,
  c_custkey % 2 = 0 AS is_oa,
  CASE c_custkey % 4 WHEN 1 THEN 'chemistry;water' WHEN 3 THEN 'water;soil;risk' END AS concepts_text
FROM customer""",
    "d3": r"""
SELECT CASE c_custkey WHEN 1 THEN 'CHN' WHEN 2 THEN 'DEU' WHEN 3 THEN 'USA' WHEN 4 THEN 'JPN' WHEN 5 THEN 'KOR'
       ELSE concat('N', cast(c_custkey AS string)) END AS country_iso3,
  i.indicator, cast(2020 + y.k AS string) AS year, 4 - y.k AS pos,
  CASE WHEN (c_custkey + y.k) % 3 <> 0 THEN cast(c_custkey * 100 + y.k AS double) END AS value
FROM customer CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS y(k)
CROSS JOIN (VALUES ('SP.POP.TOTL'), ('EN.POP.DNST'), ('NY.GDP.PCAP.CD')) AS i(indicator)""",
    "r2": r"""
SELECT doc_id, lang, source, text,
  CASE WHEN doc_id % 50 = 0 THEN NULL ELSE cast(floor(n_chars / 3000.0) AS bigint) + doc_id % 3 END AS pages,
  doc_id % 41 <> 0 AS identity_match
FROM documents""",
    "r3": r"""
SELECT doc_id, concat(coalesce(text, ''), ' doi:10.1016/J.D', cast(doc_id AS string),
  ' and 10.1038/n', cast(doc_id % 7 AS string), '; see 10.1021/es', cast(doc_id % 90 AS string), ' end') AS text
FROM documents""",
    "r4": r"""
SELECT doc_id AS target_id, r.rung,
  CASE r.rung WHEN 1 THEN 'open_pdf' WHEN 2 THEN 'publisher_api' WHEN 3 THEN 'institutional' ELSE 'browser' END AS source_type,
  CASE (doc_id * 7 + r.rung * 3) % 5 WHEN 0 THEN 200 WHEN 1 THEN 403 WHEN 2 THEN 404 WHEN 3 THEN 200 END AS http_status,
  CASE WHEN (doc_id * 7 + r.rung * 3) % 5 = 0 THEN '%PDF-1.7' ELSE '<html>' END AS body_head,
  CASE doc_id % 4 WHEN 0 THEN concat('10.1016/x', cast(doc_id AS string)) WHEN 1 THEN concat('10.1038/x', cast(doc_id AS string))
    WHEN 2 THEN concat('10.1111/x', cast(doc_id AS string)) ELSE concat('10.1126/x', cast(doc_id AS string)) END AS doi
FROM documents CROSS JOIN (VALUES (1), (2), (3), (4)) AS r(rung)""",
    "r5": r"""
SELECT doc_id AS row_id, concat('Author', cast(doc_id % 120 AS string), ', ', cast(1990 + doc_id % 30 AS string)) AS short_ref,
  source AS chemical_name, lang AS medium, concat('Site ', cast(doc_id % 25 AS string)) AS location
FROM documents""",
    "r5_map": r"""
SELECT DISTINCT concat('Author', cast(doc_id % 120 AS string), ', ', cast(1990 + doc_id % 30 AS string)) AS short_ref,
  CASE WHEN doc_id % 120 = 7 THEN NULL WHEN doc_id % 120 = 11 THEN '10.1021/benchmark'
       ELSE concat('10.1021/m', cast(doc_id % 120 AS string)) END AS doi
FROM documents WHERE doc_id % 120 <> 13""",
}
TABLES = ["events", "documents", "customer", "nation", "region"]
#: Views that make 15 rows of one: the table and its key, spread over tasks before that, so that no task has the rows of a whole file.
MULTIPLIED = {"d3": ("customer", "c_custkey")}
#: Rows of such a table in one task.
SPREAD_ROWS = 25_000


def _spread(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(-(-df.count() // SPREAD_ROWS) or 1, key)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    for t in TABLES:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    if name in MULTIPLIED:
        table, key = MULTIPLIED[name]
        tables[table] = _spread(tables[table], key)
    return spark.sql(sql, **tables)


def with_views(*names: str) -> str:
    """The head of a SQL statement that defines the views."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
