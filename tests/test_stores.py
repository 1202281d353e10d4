"""Splittable array scans, rules as data, audits in batches, stored tables, releases, hash trees and dead letters."""

from __future__ import annotations

import json
import random
from collections import Counter
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillstone.operators import batches, context, contracts, provenance, reconcile, release, ruled, validate
from rillstone.plans import rulebook as rb
from rillstone.plans.views import view
from rillstone.sources import array_scan, commits, payloads, records, scratch
from rillstone.sources.stored import StoredTable
from rillstone.streaming.audit import audit_stream

from .conftest import SF

# Array documents

ODD = ['a"b', "\\", "}]},{[", '\\"}', "é} ", "", "x" * 300, "{}", '"', "\n\t,"]


def _array(seed, n):
    rng = random.Random(seed)
    value = lambda depth: rng.choice(ODD) if depth > 2 or rng.random() < 0.6 else rng.choice([[value(depth + 1) for _ in range(rng.randint(0, 3))], {rng.choice(ODD): value(depth + 1) for _ in range(rng.randint(0, 3))}, 1.5, None, True])
    return [{"i": k, "v": rng.choice(ODD), "w": value(0)} if rng.random() < 0.9 else rng.choice([7, "}", [{"i": 1}], None]) for k in range(n)]


@pytest.mark.parametrize(("block", "broadcast_blocks"), [(64, 1000), (257, 0), (4096, 1000), (1 << 20, 1000)])
def test_array_scan_across_every_kind_of_cut(spark, tmp_path, block, broadcast_blocks):
    docs = {"a": _array(1, 120), "b": [], "c": _array(2, 40), "d": [{"i": 0, "v": "x", "w": 1}]}
    for name, rows in docs.items():
        (tmp_path / f"{name}.json").write_text("﻿" * (name == "c") + " " * (name == "a") + json.dumps(rows, indent=2 if name == "a" else None, ensure_ascii=name == "c") + "\n")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = array_scan.array_elements(spark, f"file://{tmp_path}", broadcast_blocks=broadcast_blocks)
        found = {(r["file_path"][-6], r["position"], r["element"]) for r in got.collect()}
        blocks = array_scan.pieces(spark, f"file://{tmp_path}/a.json").select("block").distinct().count()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert blocks > 20 or block > 300
    assert {(f, p): json.loads(e) for f, p, e in found} == {(n, p): x for n, rows in docs.items() for p, x in enumerate(rows) if isinstance(x, dict)} and len(found) == sum(isinstance(x, dict) for rows in docs.values() for x in rows)


def test_effects_compose_at_every_brace():
    text = json.dumps(_array(5, 12))
    whole = array_scan.Effect(False)
    whole.add(text)
    for cut in [k + 1 for k, c in enumerate(text) if c == "}"]:
        a = array_scan.Effect(False)
        a.add(text[:cut])
        b = array_scan.Effect(a.in_string)
        b.add(text[cut:])
        commas = Counter(a.commas)
        commas.update({d + a.depth: n for d, n in b.commas.items()})
        assert (b.in_string, a.depth + b.depth, commas) == (whole.in_string, whole.depth, whole.commas)


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path):
    with (tmp_path / "one.json").open("w") as f:
        f.write("[" + ",".join(f'{{"n":{i},"t":"}}{i}]"}}' for i in range(200_000)) + "]")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        assert array_scan.pieces(spark, f"file://{tmp_path}/one.json").rdd.getNumPartitions() >= 8
        got = records.record_array(spark, f"file://{tmp_path}/one.json", "n long, t string")
        assert tuple(got.agg(F.count("*"), F.count_distinct("n"), F.count_if(F.col("n") == F.col("position")), F.count_if(F.col("t") == F.concat(F.lit("}"), "n", F.lit("]")))).first()) == (200_000,) * 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_names_of_variant_records(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"a": 1, "b": None}, {"a": "x", "it's": [1]}, {}, 3]))
    rows = records.variant_records(spark, f"file://{tmp_path}/a.json")
    assert {(r["name"], r["n"]) for r in records.field_names(rows).collect()} == {("a", 2), ("b", 1), ("it's", 1)}
    got = records.typed(rows, {"a": "string", "b": "long", "it's": "array<long>"}, "position").orderBy("position").collect()
    assert [tuple(r) for r in got] == [(0, "1", None, None), (1, "x", None, [1]), (2, None, None, None)]
    named = records.field_names(rows.withColumn("batch", F.lit(1)), "batch")
    assert rb.route_by_names(named, "batch").first()["rulebook"] == "generic"
    some = spark.createDataFrame([(1, "trend_direction"), (1, "value_min"), (2, "value_min"), (3, "reference_short_citation"), (4, None)], "batch int, name string")
    assert {tuple(r) for r in rb.route_by_names(some, "batch").collect()} == {(1, "synthesis"), (2, "record"), (3, "reference_rebuild"), (4, "generic")}


# Rules as data

FIELDS = [f"f{i}" for i in range(70)]


def _random_book(rng, name, n):
    field = lambda: "|".join(rng.sample([*FIELDS, "nowhere"], rng.choice([1, 1, 1, 2])))
    some = lambda k: tuple(field() for _ in range(k))
    required = some(n // 4)
    statuses = rng.choice([("approved", "needs_review", "rejected"), ("approved", "rejected"), ("rejected", "approved")])
    return rb.Rulebook(name, required, tuple(some(rng.randint(1, 3)) for _ in range(n // 4)), some(rng.randint(1, 4)), some(n // 4), tuple(rng.sample(required, min(len(required), 3))) + some(1), some(n - 3 * (n // 4)), statuses)


def _audit_by_hand(rows, book):
    """The rules as the record semantics state them, row by row."""
    def get(row, field):
        return next((row[f] for f in field.split("|") if row.get(f) not in (None, "")), None)

    order = {s: i for i, s in enumerate(book.allowed_statuses)}
    ids = [tuple(str(get(r, f) or "").strip().lower() for f in book.duplicate_identity_fields) for r in rows]
    times, out = Counter(ids), []
    for row, own in zip(rows, ids, strict=True):
        hits = [("rejected" if f in book.reject_if_missing else "needs_review", f"missing {f}") for f in book.required_fields if get(row, f) is None]
        hits += [("rejected" if set(g) & set(book.reject_if_missing) else "needs_review", f"missing one of {'/'.join(g)}") for g in book.required_any_groups if all(get(row, f) is None for f in g)]
        hits += [("needs_review", f"review required for missing {f}") for f in book.review_if_missing if get(row, f) is None]
        hits += [("rejected", f"forbidden field present: {f}") for f in book.forbidden_fields if get(row, f) is not None]
        hits += [("needs_review", validate.REPEATED)] * (times[own] > 1)
        status = "approved"
        for s, _ in hits:
            status = s if s not in order or status not in order or order[s] > order[status] else status
        out.append((row["id"], status, [n for _, n in hits]))
    return out


def _rows(rng, n):
    return [{"id": i} | {f: rng.choice([None, None, "", " A ", "a", "b"]) for f in FIELDS} for i in range(n)]


def _frame(spark, rows, books):
    return spark.createDataFrame([(r["id"], books[r["id"] % len(books)], *[r[f] for f in FIELDS]) for r in rows], "id long, book string, " + ", ".join(f"{f} string" for f in FIELDS))


def _wanted(rows, books):
    return sorted(x for k, b in enumerate(books) for x in _audit_by_hand([r for r in rows if r["id"] % len(books) == k], b))


def _got(audited):
    return sorted((r["id"], r["validation_status"], r["validation_notes"]) for r in audited.collect())


@pytest.mark.parametrize("n", [64, 200, 1000])
def test_compiled_audit_of_many_rules(spark, n):
    rng = random.Random(n)
    book, rows = _random_book(rng, "one", n), _rows(rng, 30)
    df = _frame(spark, rows, ["one"])
    assert _got(validate.audit(df, book)) == _wanted(rows, [book]) == _got(ruled.audit_ruled(df, "book", rb.rule_table(spark, [book])))


@pytest.mark.parametrize("broadcast_rules", [1 << 30, 0])
def test_five_hundred_rulebooks_of_two_hundred_rules(spark, broadcast_rules):
    rng = random.Random(7)
    books = [_random_book(rng, f"book{k}", 200) for k in range(500)]
    rows = _rows(rng, 2000)
    df = _frame(spark, rows, [b.name for b in books])
    got = ruled.audit_ruled(df, "book", rb.rule_table(spark, books), broadcast_rules)
    assert _got(got) == _wanted(rows, books)
    one = ruled.audit_ruled(df, "book", rb.rule_table(spark, books[:1]))
    size = lambda made: len(made._jdf.queryExecution().optimizedPlan().toString())
    assert size(got) < 1.5 * size(one) + 200_000  # no plan for each rule
    unknown = ruled.audit_ruled(df.withColumn("book", F.lit("other")), "book", rb.rule_table(spark, books[:2]))
    assert unknown.filter("validation_status is null and validation_notes is null").count() == 2000


def test_rulebook_documents(spark):
    texts = ['{"name": "x", "required_fields": ["a|b", "c"], "required_any_groups": [["a", "b|d"], ["c"]], "forbidden_fields": [], "comment": "no kind"}', "[1]", "no json", '{"review_if_missing": ["z"]}']
    rules = rb.rules_of_documents(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert {tuple(map(str, r)) for r in rules.collect()} == {("x", "required_fields", "-1", "[]"), ("x", "required_fields", "0", "['a', 'b']"), ("x", "required_fields", "1", "['c']"), ("x", "required_any_groups", "-1", "[]"), ("x", "required_any_groups", "0", "['a', 'b|d']"), ("x", "required_any_groups", "1", "['c']"), ("x", "forbidden_fields", "-1", "[]"), ("generic", "review_if_missing", "-1", "[]"), ("generic", "review_if_missing", "0", "['z']")}
    merged = rb.with_defaults(rules, rb.rule_table(spark, [rb.GENERIC]))
    df = spark.createDataFrame([(1, "", "B", None, "m", "x"), (1, None, None, "C", None, "x")], "id int, a string, b string, c string, model_prediction string, book string")
    got = {r["c"]: r["validation_notes"] for r in ruled.audit_ruled(df, "book", merged).collect()}
    assert got == {None: ["missing c", "missing one of c", "review required for missing matrix", validate.REPEATED], "C": ["missing a|b", "missing one of a/b|d", "review required for missing matrix", validate.REPEATED]}


# Batches


@pytest.mark.parametrize("seed", [1, 2])
def test_any_cut_into_batches_ends_as_one_audit(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = view(spark, SF, "r1").filter("row_number <= 300")
    same = {c: F.lit("x") for c in ("pollutant_group", "pollutant_original", "matrix", "geographic_scope", "temporal_window", "value_numeric")}
    rows = rows.withColumns(same | {"doi": F.when(F.col("row_number") % 3 == 0, F.lit("10.1/hot")).otherwise(F.concat(F.lit("10.1/"), F.col("row_number") % 110))})
    rows = scratch.written(rows.withColumn("part", F.pmod(F.hash("row_number", F.lit(seed)), F.lit(rng.randint(2, 3)))))
    store, done = StoredTable(spark, f"file://{tmp_path}", "digest", 4), []
    for k in range(3):
        part = rows.filter(F.col("part") == k)
        first = batches.audit_batch(part, rb.RECORD, store, f"b{k}")
        again = batches.audit_batch(part, rb.RECORD, store, f"b{k}")  # a batch that is tried again
        for a, b in zip(first, again, strict=True):
            assert Counter(map(str, a.collect())) == Counter(map(str, b.collect()))
        done.append(again)
    whole, became = (reduce(DataFrame.unionByName, x) for x in zip(*done, strict=True))
    columns = ["row_number", "validation_status", "validation_notes"]
    got = Counter(map(str, batches.with_later_duplicates(whole, became, rb.RECORD).select(*columns).collect()))
    assert got == Counter(map(str, validate.audit(rows, rb.RECORD).select(*columns).collect()))
    assert became.count() > 0


def test_stored_tables_merge_without_moving(spark, tmp_path):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        store = StoredTable(spark, f"file://{tmp_path}", "doi", 8)
        assert store.read() is None
        dim = lambda rows: spark.createDataFrame(rows, "doi string, publisher string, load_order long")
        context.keep_dimension(store, dim([("a", "new", 5), ("b", "x", 1), ("a", "newer", 6), (None, "n", 1), ("", "n", 1)]), "load_order", "one")
        context.keep_dimension(store, dim([("a", "old", 2), ("c", None, 3), ("b", None, 9)]), "load_order", "two")
        context.keep_dimension(store, dim([("a", "again", 99)]), "load_order", "two")  # held already
        assert {tuple(r) for r in store.read().collect()} == {("a", "newer", 6), ("b", None, 9), ("c", None, 3)}
        assert {tuple(r) for r in store.read(1).collect()} == {("a", "newer", 6), ("b", "x", 1)}
        again = StoredTable(spark, f"file://{tmp_path}", "doi", 8)
        spark.sql(f"DROP TABLE {again._state(2)['table']}")  # as in another session: the files are what is kept
        joined = spark.createDataFrame([("a",), ("z",)], "doi string").join(again.read(), "doi", "left")
        assert {tuple(r) for r in joined.collect()} == {("a", "newer", 6), ("z", None, None)}
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.split("== Initial Plan")[0].count("Exchange hashpartitioning") == 1, plan  # the records, not the dimension
        with pytest.raises(commits.Taken):
            commits.publish(spark, f"file://{tmp_path}/versions/2", {})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


# Releases


def test_a_release_is_whole_or_none(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = spark.createDataFrame([(1, "approved"), (2, "approved")], "row_number long, validation_status string")
    broken = rows.select(F.raise_error(F.lit("dies")).cast("string").alias("x"))
    with pytest.raises(Exception, match="dies"):
        release.publish_bundle(root, "v1", {"api/validated_rows.json": rows, "reports/matrix_summary.csv": broken})
    assert release.manifest_of(spark, root, "v1") is None and release.released_paths(spark, root, "v1").count() == 0
    assert not release.completeness(release.released_paths(spark, root, "v1")).filter("present").count()
    made = {r["name"]: r["n_rows"] for r in release.publish_bundle(root, "v1", {"api/validated_rows.json": rows, "api/analytics_summary.json": rows.agg(F.count("*").alias("n")), "reports/matrix_summary.csv": rows, "api/enriched_rows.json": None}).collect()}
    assert made["api/validated_rows.json"] == 2 == made["reports/matrix_summary.csv"] and made["api/enriched_rows.json"] is None
    manifest = release.manifest_of(spark, root, "v1")
    assert release.missing_manifest_fields(manifest) == [] and release.missing_manifest_fields({"release_tag": "x", "copied_artifacts": {}}) == ["generated_at", "bundle_root", "copied_artifacts"]
    site = json.loads(spark.read.text(manifest["copied_artifacts"]["site_index.json"]).first()["value"])
    assert site["api"]["validated_rows"] == "api/validated_rows.json" and site["api"]["enriched_rows"] is None and site["reports"]["matrices"]
    assert {r["path"] for r in release.completeness(release.released_paths(spark, root, "v1")).filter("kind = 'required' and not present").collect()} == set()
    with pytest.raises(commits.Taken):
        release.publish(root, "v1", {"t": rows})
    assert release.manifest_of(spark, root, "v1") == manifest


def test_hash_trees_find_the_ranges_that_differ(spark, tmp_path):
    rows = scratch.written(spark.range(3000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"), F.array("id").alias("a")).unionByName(spark.createDataFrame([(7, "twice", None), (None, None, None)], "k long, v string, a array<long>")))
    paths = [f"file://{tmp_path}/{k}" for k in "abc"]
    provenance.store(rows, "k", paths[0])
    provenance.store(rows.orderBy(F.desc("v")), "k", paths[1])
    other = rows.filter("k is null or k <> 12").withColumn("v", F.when(F.col("k") == 999, "w").otherwise(F.col("v"))).unionByName(spark.createDataFrame([(5000, "n", None), (7, "twice", None)], rows.schema))
    provenance.store(other, "k", paths[2])
    assert provenance.differing_ranges(spark, paths[0], paths[1]) == [] and provenance.changes(spark, paths[0], paths[1], "k", rows).count() == 0
    found = provenance.differing_ranges(spark, paths[0], paths[2])
    changes = provenance.changes(spark, paths[0], paths[2], "k", rows)
    assert {(r["k"], r["change"]) for r in changes.collect()} == {(12, "removed"), (999, "changed"), (5000, "added"), (7, "changed")}
    assert {r["range"] for r in changes.collect()} == set(found) and len(found) <= 4
    assert "PartitionFilters: [isnotnull(range" in changes._jdf.queryExecution().toString() or "range#" in changes._jdf.queryExecution().toString().split("PartitionFilters")[1][:200]
    read = changes._jdf.queryExecution().toString()
    assert read.count("PartitionFilters: []") == 0


def test_dead_letters(spark, tmp_path):
    good = {"works_a": '{"message": {"DOI": "10.1000/A"}}', "works_b": '{"id": "W1"}', "indicators": '[{}, [{"date": "2020", "value": 1}, {"date": "2021", "value": null}]]'}
    for kind, text in good.items():
        docs = spark.createDataFrame([("/DEU/I.json", text), ("/b", None), ("/c", " "), ("/d", "{"), ("/e", '{"other": 1}'), ("/f", "[]"), ("/g", "3")], "file_path string, value string")
        rows, dead = payloads.landed(docs, kind, f"file://{tmp_path}/{kind}")
        assert rows.count() == (2 if kind == "indicators" else 1)
        assert {(r["file_path"], r["reason"], r["text"]) for r in dead.collect()} == {("/b", "empty", None), ("/c", "empty", " "), ("/d", "no JSON", "{"), ("/e", "foreign document", '{"other": 1}'), ("/f", "foreign document", "[]"), ("/g", "foreign document", "3")}
        assert {tuple(r) for r in payloads.dead_counts(dead).collect()} == {("empty", 2), ("no JSON", 1), ("foreign document", 3)}
    none = payloads.flatten_indicators(spark.createDataFrame([("/DEU/I.json", "[{}, []]")], "file_path string, value string"))
    assert none.count() == 0


def test_scratch_where_no_folder_is_named():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        applicationId, master = "app-1", "local[2]"

    class Session:
        conf, sparkContext = Conf(), Context()

    one, two = scratch.shared_path(Session()), scratch.shared_path(Session())
    assert one != two and one.rpartition("/")[0] == two.rpartition("/")[0] and one.startswith("file:///tmp/spark-")
    Context.master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_path(Session())


# Reconciliation and routing


@pytest.mark.parametrize(("n", "cells"), [(0, 8), (3, 8), (40, 64), (900, 64), (900, 4096)])
def test_reconciliation_by_difference(spark, monkeypatch, n, cells):
    rng = random.Random(n)
    keys = [None if k == 0 else f"key{k}" for k in range(1500)]
    copies = {k: rng.choice([0, 2, 3]) for k in rng.sample(keys, n)} | ({"only out": 2} if n else {})
    source = spark.createDataFrame([(k, "x") for k in keys] + [("key7", "y")], "k string, v string")
    output = spark.createDataFrame([(k,) for k in [*keys, "only out"] for _ in range(copies.get(k, 2 if k == "key7" else k != "only out"))], "k string")
    full = []
    monkeypatch.setattr(reconcile, "reconciled", lambda a, b, key, of=reconcile.reconciled: full.append(a.count()) or of(a, b, key))
    got = Counter(tuple(r) for r in reconcile.reconciled_by_difference(source, output, "k", cells).collect())
    assert got == Counter(tuple(r) for r in contracts.reconciled(source, output, "k").collect())
    assert (full[0] > 1000) == (n == 900 and cells == 64)  # joined in full only where the cells do not do


def test_fifty_thousand_aliases(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    aliases = [(i, " ".join(rng.choices(words, k=rng.randint(1, 3))) if i else "", f"book{i}") for i in range(50_000)]
    labels = ["/".join(rng.choices([*words, "W1-x", "none"], k=rng.randint(0, 6))) for _ in range(60)] + ["", "?!", "w1w2", "xw1"]
    df = spark.createDataFrame([([a, b],) for a, b in zip(labels, labels[::-1], strict=True)], "probes array<string>")
    table = spark.createDataFrame(aliases, "alias_ord int, alias string, rulebook string")
    routed = rb.route_by_label(df, F.col("probes"), aliases=table)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    at = {}
    for i, a, book in aliases:
        if a:
            at.setdefault(tuple(a.split()), (i, book))

    def by_hand(probes):
        for p in probes:
            own = [w for w in "".join(c if c.isalnum() else " " for c in p.lower()).split()]
            hits = [at[t] for k in range(len(own)) for n in (1, 2, 3) if (t := tuple(own[k : k + n])) in at and len(t) == n]
            if hits:
                return min(hits)[1]
        return "generic"

    assert [r["rulebook"] for r in routed.orderBy("probes").collect()] == [by_hand(p) for p in sorted([a, b] for a, b in zip(labels, labels[::-1], strict=True))]


def test_stream_counts_identities_across_batches(spark, tmp_path):
    rows = view(spark, SF, "r1").filter("row_number <= 120").withColumn("doi", F.concat(F.lit("10.1/"), F.col("row_number") % 50))
    same = {c: F.lit("x") for c in ("pollutant_group", "matrix", "geographic_scope", "temporal_window")}
    rows = scratch.written(rows.withColumns(same))
    for k in range(3):
        rows.filter(F.col("row_number") % 3 == k).coalesce(1).write.json(f"file://{tmp_path}/part{k}")
        (tmp_path / "in").mkdir(exist_ok=True)
        next((tmp_path / f"part{k}").glob("part-*.json")).rename(tmp_path / "in" / f"{k}.json")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    store = StoredTable(spark, f"file://{tmp_path}/ids", "digest", 4)
    audit_stream(spark, f"file://{tmp_path}/in", ddl, rb.GENERIC, f"file://{tmp_path}/out", f"file://{tmp_path}/check", store, max_files=1).awaitTermination()
    whole, became = spark.read.parquet(f"file://{tmp_path}/out"), spark.read.parquet(f"file://{tmp_path}/out-became")
    assert whole.select("epoch").distinct().count() == 3 and became.count() > 0
    columns = ["row_number", "validation_status", "validation_notes"]
    got = batches.with_later_duplicates(whole, became.drop("epoch"), rb.GENERIC).select(*columns)
    assert Counter(map(str, got.collect())) == Counter(map(str, validate.audit(rows, rb.GENERIC).select(*columns).collect()))
