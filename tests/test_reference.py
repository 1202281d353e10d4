"""The reference's record semantics: goldens, odd values, round trips, plans, and every query against its oracle."""

from __future__ import annotations

import json
from collections import Counter

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import TABLES, rows
from rillstone.functions import fields, keys
from rillstone.operators import context, contracts, release, summarize, validate
from rillstone.plans import oracles, queries
from rillstone.plans import rulebook as rb
from rillstone.plans.views import view
from rillstone.sources import payloads, records
from rillstone.streaming.audit import audit_stream

from .conftest import SF

RECORD = "paper_title string, doi string, pollutant_original string, matrix string, location string, value_numeric string, unit_original string, unit_standardized string, evidence_page string, trend_direction string, risk_threshold string, measurement_record_count_min string, sampling_period string, model_prediction string"
NAMES = [c.split()[0] for c in RECORD.split(", ")]


def _records(spark, *given):
    return spark.createDataFrame([tuple(r.get(n) for n in NAMES) for r in given], RECORD)


SYNTHESIS = [
    {"paper_title": "T", "doi": "10.1126/sciadv.ado5534", "pollutant_original": "legacy POPs", "matrix": "ocean", "location": "global", "evidence_page": "1", "trend_direction": "synthesis benchmark", "measurement_record_count_min": "10000", "sampling_period": "1980-2023"},
    {"paper_title": "T", "doi": "10.1126/sciadv.ado5534", "pollutant_original": "legacy POPs", "matrix": "ocean", "location": "arctic", "evidence_page": "2", "trend_direction": "increasing", "sampling_period": "1980-2023"},
    {"paper_title": "T", "doi": "10.1126/sciadv.ado5534", "pollutant_original": "cumulative risk", "matrix": "ocean", "location": "global", "evidence_page": "3", "risk_threshold": "0.1", "sampling_period": "1980-2023"},
]


def test_synthesis_golden(spark):
    df = _records(spark, *SYNTHESIS)
    got = validate.audit(df, rb.SYNTHESIS).collect()
    assert len(got) == 3 and all(r["validation_status"] == "approved" and r["validation_notes"] == [] for r in got)
    numbered = df.withColumn("row_number", F.monotonically_increasing_id())
    assert {(r["key"], r["n"]) for r in summarize.counts(numbered, F.col("trend_direction")).collect()} == {("synthesis benchmark", 1), ("increasing", 1)}
    s = summarize.numeric_summary(summarize.numeric_values(df)).first()
    assert (s["n"], s["mean"], s["min"], s["max"]) == (1, 10000.0, 10000.0, 10000.0)
    t = summarize.threshold_summary(df).first()
    assert (t["n"], t["min"], t["max"]) == (1, 0.1, 0.1)
    table = summarize.group_table(df, F.col("pollutant_original")).collect()
    assert [(r["key"], r["row_count"], r["trend_notes"]) for r in table] == [("legacy POPs", 2, "increasing; synthesis benchmark"), ("cumulative risk", 1, "")]
    urls = context.request_manifest(df).collect()
    assert sorted((r["service"], r["url"].rpartition("/")[2]) for r in urls) == [("works_a", "10.1126%2Fsciadv.ado5534"), ("works_b", "10.1126%2Fsciadv.ado5534")]


def test_record_and_rebuild_goldens(spark):
    df = _records(spark, {"paper_title": "T", "doi": "d", "matrix": "m", "pollutant_original": "p", "location": "l", "evidence_page": "1", "unit_original": "u"})
    assert validate.audit(df, rb.RECORD).first()["validation_notes"] == ["missing one of value_numeric/value_min/value_max", "review required for missing unit_standardized"]
    assert validate.audit(df, rb.SYNTHESIS).first()["validation_notes"] == ["missing one of temporal_window/sampling_period/sampling_period_label", f"review required for missing {rb.PERIOD}"]
    source = spark.createDataFrame([("t", "10.1/x", "TFA", "rain", "Site")], "source_title_matched string, source_literature_doi string, chemical_name string, medium string, location string")
    bare = validate.audit(source, rb.REBUILD).first()
    assert bare["validation_status"] == "rejected" and len(bare["validation_notes"]) == 5
    assert validate.audit(contracts.mapped_columns(source), rb.REBUILD).first()["validation_notes"] == ["missing one of evidence_location/evidence_page/table_figure_id"]


def test_empty_object(spark):
    got = validate.audit(_records(spark, {}), rb.GENERIC).first()
    assert got["validation_status"] == "rejected" and len(got["validation_notes"]) == 6


def test_missing_is_not_blank(spark):
    df = spark.createDataFrame([("", [], 0, " "), (None, None, None, "x"), ("a", ["b"], 5, "")], "s string, a array<string>, n int, t string")
    got = df.select(*[fields.present(df, c).isNull().alias(c) for c in "sant"], fields.present(df, "nope").isNull().alias("u")).collect()
    assert [tuple(r) for r in got] == [(True, True, False, False, True), (True, True, True, False, True), (False, False, False, True, True)]
    assert [r[0] for r in df.select(fields.first_present(df, ["s", "n", "t"])).collect()] == ["0", "x", "a"]


def test_duplicates_flag_every_member_and_status_order(spark):
    df = _records(spark, *[{"paper_title": "T", "doi": d, "matrix": "m", "pollutant_original": p, "evidence_page": "1"} for d, p in ((" D\t", "x"), ("d", "X "), ("d", "y"))])
    got = [r["validation_notes"] for r in validate.audit(df, rb.GENERIC).orderBy("pollutant_original").collect()]
    assert Counter(map(tuple, got)) == Counter({("possible duplicate row",): 2, (): 1})
    short = rb.GENERIC.overridden({"allowed_statuses": ["approved", "rejected"]})
    one = _records(spark, {"paper_title": "T", "doi": "d", "pollutant_original": "p", "evidence_page": "1"})
    assert validate.audit(one, short).first()["validation_status"] == "needs_review"  # outside the list, so it wins
    forbidden = _records(spark, {"paper_title": "T", "doi": "d", "matrix": "m", "pollutant_original": "p", "evidence_page": "1", "model_prediction": "0"})
    assert validate.audit(forbidden, rb.GENERIC).first()["validation_notes"] == ["forbidden field present: model_prediction"]


def test_audit_overwrites_audit_columns_and_keeps_rows(spark):
    df = view(spark, SF, "r1").withColumn("validation_status", F.lit("old"))
    got = validate.audit(df, rb.GENERIC)
    c = validate.status_counts(got).first()
    assert (c["total"], c["approved"], c["needs_review"], c["rejected"]) == (1000, 244, 647, 109)
    assert got.select("row_number").exceptAll(df.select("row_number")).count() == 0


@given(st.text(max_size=12))
@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_numbers(spark, text):
    def python(x):
        try:
            return float(x) if x.isascii() else "skip"
        except ValueError:
            return None

    some = [text, " 1.5 ", "1e3", "nan", "inf", "1_000", "1.5d", "1.5f", "", ".", "5.", ".5", "-2E-3", "0x10", "1__0", "+7"]
    got = [r["v"] for r in spark.createDataFrame([(i, x) for i, x in enumerate(some)], "i int, x string").select("i", keys.number(F.col("x")).alias("v")).orderBy("i").collect()]
    for x, v in zip(some, got, strict=True):
        want = python(x)
        assert want == "skip" or v == want or (v != v and want != want)


def test_keys(spark):
    rows_ = [("see https://doi.org/10.1016/J.X).", "germany\n", "10.10167/a"), ("none", "deu", "10.1038/x"), (None, "Österreich", "x")]
    df = spark.createDataFrame(rows_, "t string, c string, d string")
    got = df.select(keys.doi(F.col("t")), keys.iso3(F.col("c")), keys.publisher(F.col("d")), keys.slug(F.lit("._10.1/a b*c_.")), keys.percent_encoded(F.lit("a b*~/é"))).collect()
    same = ("10.1_a_b_c", "a%20b%2A~%2F%C3%A9")
    assert [tuple(r) for r in got] == [("10.1016/j.x).", "DEU", "Elsevier", *same), (None, "DEU", "Springer", *same), (None, None, "Unknown", *same)]


def test_dois_of_whole_texts(spark, tmp_path):
    texts = [(1, "word " * 5000 + "10.5555/late.one and more"), (2, None), (3, "10.5555/early")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {(r["doi"], r["first_doc"], r["first_pos"]) for r in queries.QUERIES["q_doi_from_text"](spark, f"file://{tmp_path}").collect()}
    assert {("10.5555/late.one", 1, 0), ("10.5555/early", 3, 0), ("10.1016/J.D1", 1, 1), ("10.1016/J.D2", 2, 0)} <= got


def test_routing_oddities(spark):
    df = spark.createDataFrame([("nature_geoscience",), ("latest",), ("EST run",), ("",)], "label string")
    words = {r["label"]: r["rulebook"] for r in rb.route_by_label(df, F.array("label")).collect()}
    parts = {r["label"]: r["rulebook"] for r in rb.route_by_label(df, F.array("label"), substring=True).collect()}
    assert words == {"nature_geoscience": "record", "latest": "generic", "EST run": "reference_rebuild", "": "generic"}
    assert parts == {"nature_geoscience": "synthesis", "latest": "reference_rebuild", "EST run": "reference_rebuild", "": "generic"}


def test_array_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"doi": "x", "n": 1}, 5, "s", [1], {"doi": None}]))
    got = records.record_array(spark, f"file://{tmp_path}/a.json", "doi string, n string")
    assert [(r["position"], r["doi"], r["n"]) for r in got.collect()] == [(0, "x", "1"), (4, None, None)]
    (tmp_path / "b.json").write_text('{"doi": 1}')
    with pytest.raises(Exception, match="not a JSON array"):
        records.record_array(spark, f"file://{tmp_path}/b.json", "doi string").collect()
    for path in (f"file://{tmp_path}/b.json", f"file://{tmp_path}/none.json", None):
        assert records.record_array_or_empty(spark, path, "doi string").count() == 0


def test_payload_files(spark, tmp_path):
    for name, body in {"DEU/SP.POP.TOTL.json": [{"page": 1}, [{"country": {"value": "Germany"}, "indicator": {"value": "Population"}, "date": "2024", "value": None}, {"date": "2023", "value": 0}]], "USA/X.json": [{"message": "none"}]}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(json.dumps(body))
    flat = payloads.flatten_indicators(payloads.payloads(spark, f"file://{tmp_path}"))
    assert [(r["country_iso3"], r["indicator"], r["pos"], r["year"], r["value"]) for r in flat.orderBy("pos").collect()] == [("DEU", "SP.POP.TOTL", 0, "2024", None), ("DEU", "SP.POP.TOTL", 1, "2023", 0.0)]
    assert context.latest_indicators(flat).first()["year"] == "2023"
    works = spark.createDataFrame([("f", '{"message": {"DOI": "10.1000/A", "published-print": {}, "created": {"date-parts": [[2001, 5]]}, "author": [{"family": "x"}]}}'), ("g", "[]"), ("h", "{")], "file_path string, value string")
    got = payloads.flatten_works_a(works).collect()
    assert [(r["doi"], r["year"], r["author_count"], r["title"]) for r in got] == [("10.1000/a", 2001, 1, None)]


def test_enrichment_keeps_rows_and_joins_url_dois(spark):
    df = spark.createDataFrame([(1, "https://doi.org/10.1000/A", "Germany", 7), (2, None, None, 8)], "row_number long, doi string, country string, context int")
    a = spark.createDataFrame([("10.1000/a", "P")], "doi string, publisher string")
    maps = context.indicator_maps(spark.createDataFrame([("DEU", "i", 1.0, 1), ("DEU", "i", None, 2)], "country_iso3 string, indicator string, value double, pos int"), "pos")
    got = context.enrich(df, a, a, maps).orderBy("row_number").collect()
    assert got[0]["context"]["crossref"]["publisher"] == "P" and got[0]["context"]["world_bank"]["indicators"] == {"i": None}
    assert got[1]["context"]["crossref"] is None and got[1]["context"]["world_bank"]["indicators"] == {}


def test_a_view_that_multiplies_rows_spreads_one_file_over_tasks(spark, tmp_path):
    spark.range(60_000).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(f"file://{tmp_path}/customer.parquet")
    series = view(spark, f"file://{tmp_path}", "d3")
    assert series.count() == 15 * 60_000
    assert max(r["n"] for r in series.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()) < 15 * 30_000
    assert context.latest_indicators(series).count() == 3 * 60_000


def test_a_bundle_audits_its_records_once(spark, monkeypatch):
    given = []
    publish = release.publish_bundle
    monkeypatch.setattr(release, "publish_bundle", lambda root, tag, tables: given.append(tables) or publish(root, tag, tables))
    queries.QUERIES["q_bundle_completeness"](spark, SF).collect()
    assert len(given) == 1 and not any("events.parquet" in f for df in given[0].values() if df is not None for f in df.inputFiles())


def test_publish_refuses_and_lists(spark, tmp_path):
    audited = validate.audit(view(spark, SF, "r1"), rb.GENERIC)
    good = release.release_rows(audited).select("row_number", "doi", "paper_title", "validation_status")
    inventory = release.publish(f"file://{tmp_path}", "v1", {"api/validated_rows": good, "reports/none": None}).collect()
    assert [(r["name"], r["present"], r["n_rows"]) for r in inventory] == [("api/validated_rows", True, 244), ("reports/none", False, None)]
    with pytest.raises(ValueError, match="not approved"):
        release.publish(f"file://{tmp_path}", "v2", {"api/validated_rows": audited})
    assert release.provenance_hash(good).first() == release.provenance_hash(good.orderBy(F.desc("row_number"))).first()
    assert release.missing_manifest_fields({}) == release.REQUIRED_MANIFEST_FIELDS


def test_stream_audits_files(spark, tmp_path):
    source = tmp_path / "in"
    records.write_json(_records(spark, *SYNTHESIS), f"file://{source}")
    audit_stream(spark, f"file://{source}", RECORD, rb.SYNTHESIS, f"file://{tmp_path}/out", f"file://{tmp_path}/check").awaitTermination()
    assert Counter(r["validation_status"] for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == {"approved": 3}


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_row_numbers_of_many_ranges(spark, parts):
    """A million rows in shuffled order, ties included, with adaptive execution on."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = spark.range(1_000_000).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("h"), (F.col("id") % 1000).alias("k"))
        got = validate.numbered(rows, "k", "h").selectExpr("row_number AS n", "k", "h").cache()
        assert tuple(got.selectExpr("count(*)", "count(DISTINCT n)", "min(n)", "max(n)").first()) == (1_000_000, 1_000_000, 1, 1_000_000)
        assert got.filter("floor((n - 1) / 1000) <> k").isEmpty()  # each k has a thousand rows
        assert validate.numbered(rows.limit(0), "k").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_mapped_columns_where_both_are_there(spark):
    rows = spark.createDataFrame([("10.1/a", "10.1/b", "x"), ("", "10.1/c", "y"), (None, None, "z")], "doi string, source_literature_doi string, medium string")
    got = contracts.mapped_columns(rows)
    assert got.columns == ["doi", "matrix"] and [tuple(r) for r in got.collect()] == [("10.1/a", "x"), ("10.1/c", "y"), (None, "z")]


def test_thresholds_that_are_not_finite(spark):
    rows = spark.createDataFrame([("0.5",), ("nan",), ("inf",), ("2",), (None,)], "risk_threshold string")
    assert tuple(summarize.threshold_summary(rows).first()) == (2, 0.5, 2.0, 2)


def test_provenance_hash_ignores_order_alone(spark):
    rows = [(1, "a", [1, 2]), (2, None, None), (2, None, None)]
    of = lambda r: tuple(release.provenance_hash(spark.createDataFrame(r, "k long, t string, a array<int>")).first())
    assert of(rows) == of(rows[::-1]) != of(rows[:2]) and of([]) == (0, "0-0-0-0")
    assert of(rows) != of([(1, "a", [1, 2]), (2, "", None), (2, None, None)])


def test_plans_have_no_single_partition(spark):
    for name in ("q_audit_rows", "q_multi_rulebook", "q_duplicates", "q_pollutant_table", "q_enrich_a", "q_conflicts", "q_row_numbers"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        if name != "q_row_numbers":  # the sizes of its partitions are summed in one task
            assert "SinglePartition" not in plan, name


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_oracle(spark, name):
    got = queries.QUERIES[name](spark, SF)
    if name not in oracles.ORACLES:
        assert name == "q_release_hash" and got.count() == 1
        return
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = db.execute(oracles.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() == 1000
    assert set(entry.oracle_sql()) <= set(entry.queries())
