"""Audit by a table of rules: any number of rulebooks and rules in one plan.

A record becomes two arrays: words of a bit mask that says which fields it has, and the identity texts of its fields. A rulebook
becomes one row: its rules as masks in the same words, its identity as field numbers, its statuses. The rows are joined on the
rulebook's name, and array functions judge; the plan is the same for one rule and for a hundred thousand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions.fields import identity_text, present
from rillstone.operators.validate import BITS, REPEATED, with_repeats, worse

#: Up to so many rules go to every executor; beyond it rulebooks are shuffled to their records.
BROADCAST_RULES = 200_000
#: The order in which a record's notes are listed.
ORDER = {"required_fields": 0, "required_any_groups": 1, "review_if_missing": 2, "forbidden_fields": 3}
STATUSES = ["approved", "needs_review", "rejected"]


def _numbers(names: Column, columns: list[str]) -> Column:
    """Places, from 0, of the names that are columns."""
    places = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))]) if columns else F.create_map().cast("map<string,int>")
    return F.array_compact(F.transform(names, lambda x: F.try_element_at(places, F.trim(x))))


def _mask(numbers: Column, words: int) -> Column:
    shifted = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i % BITS)
    return F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda w: F.aggregate(F.filter(numbers, lambda i: F.floor(i / BITS) == w), F.lit(0).cast("long"), lambda m, i: m.bitwiseOR(shifted(i))))


def compiled(rules: DataFrame, columns: list[str], identity_columns: list[str]) -> DataFrame:
    """(rulebook, rules, identity, statuses): one row for each rulebook of a rule table."""
    words = max(1, -(-len(columns) // BITS))
    names = F.flatten(F.transform("field_group", lambda f: F.split(f, "[|]")))
    told = rules.filter("ordinal >= 0")
    rejecting = told.filter("rule_kind = 'reject_if_missing'").groupBy("rulebook").agg(F.collect_set(F.array_join("field_group", "|")).alias("_rejecting"))
    name, kind = F.array_join("field_group", "|"), F.col("rule_kind")
    rejects = F.coalesce(F.when(kind == "required_fields", F.array_contains("_rejecting", name)).when(kind == "required_any_groups", F.arrays_overlap("_rejecting", "field_group")), F.lit(False))
    note = F.when(kind == "required_fields", F.concat(F.lit("missing "), name)).when(kind == "required_any_groups", F.concat(F.lit("missing one of "), F.array_join("field_group", "/"))).when(kind == "review_if_missing", F.concat(F.lit("review required for missing "), name)).otherwise(F.concat(F.lit("forbidden field present: "), name))
    order = F.create_map(*[x for k, i in ORDER.items() for x in (F.lit(k), F.lit(i))])
    rule = F.struct(F.try_element_at(order, kind).alias("kind"), "ordinal", (kind == "forbidden_fields").alias("forbids"), F.when(rejects | (kind == "forbidden_fields"), "rejected").otherwise("needs_review").alias("status"), note.alias("note"), _mask(_numbers(names, columns), words).alias("mask"))
    sorted_of = lambda which, x: F.array_sort(F.collect_list(F.when(which, x)))
    return (
        told.join(rejecting, "rulebook", "left")
        .groupBy("rulebook")
        .agg(
            sorted_of(kind.isin(*ORDER), rule).alias("_rules"),
            F.transform(sorted_of(kind == "duplicate_identity_fields", F.struct("ordinal", _numbers(names, identity_columns).alias("numbers"))), lambda x: x["numbers"]).alias("_groups"),
            F.transform(sorted_of(kind == "allowed_statuses", F.struct("ordinal", name.alias("name"))), lambda x: x["name"]).alias("_statuses"),
        )
        .withColumn("_statuses", F.when(F.size("_statuses") > 0, F.col("_statuses")).otherwise(F.array(*map(F.lit, STATUSES))))
    )


def audit_ruled(df: DataFrame, book_col: str, rules: DataFrame, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """Records with validation_status, validation_notes and applied_rulebook, judged by the rulebook that each names; records
    of a rulebook that the table has not are not judged and have null columns. rules: (rulebook, rule_kind, ordinal,
    field_group). Identities are counted within a rulebook; arrays in identities are compared as text."""
    used = rules.select(F.explode("field_group").alias("f"), (F.col("rule_kind") == "duplicate_identity_fields").alias("i"))
    named = used.select(F.explode(F.transform(F.split("f", "[|]"), lambda x: F.trim(x))).alias("name"), "i").filter(F.col("name").isin(*df.columns))
    found = named.groupBy("name").agg(F.max("i").alias("i")).collect()  # a row for each column of the records at most
    columns, identity_columns = sorted(r["name"] for r in found), sorted(r["name"] for r in found if r["i"])
    has = lambda part: sum((F.when(present(df, c).isNotNull(), F.lit(1 << i)).otherwise(0) for i, c in enumerate(part)), F.lit(0).cast("long"))
    words = F.array(*[has(columns[k : k + BITS]) for k in range(0, max(1, len(columns)), BITS)])
    texts = F.array(*[F.when(present(df, c).isNotNull(), identity_text(present(df, c))) for c in identity_columns]) if identity_columns else F.array().cast("array<string>")

    books = compiled(rules, columns, identity_columns).withColumnRenamed("rulebook", "_book")
    books = F.broadcast(books) if rules.count() <= broadcast_rules else books
    judged = df.withColumns({"_words": words, "_texts": texts}).join(books, F.col(book_col) == F.col("_book"), "left")
    first = lambda group: F.coalesce(F.get(F.array_compact(F.transform(group, lambda i: F.get("_texts", i))), F.lit(0)), F.lit(""))
    identity = F.concat_ws("\x1e", F.col(book_col), F.array_join(F.transform("_groups", first), "\x1f"))
    fires = lambda r: F.exists(F.zip_with("_words", r["mask"], lambda a, b: a.bitwiseAND(b) != 0), lambda hit: hit) == r["forbids"]
    hits = F.filter("_rules", fires)
    flagged = with_repeats(judged.withColumns({"_identity": identity, "_hits": F.transform(hits, lambda r: F.struct(r["status"], r["note"]))}))
    again = F.when(F.col("_again"), F.array(F.struct(F.lit("needs_review").alias("status"), F.lit(REPEATED).alias("note")))).otherwise(F.array().cast("array<struct<status: string, note: string>>"))
    told = flagged.withColumn("_hits", F.concat("_hits", again))
    status = F.aggregate("_hits", F.lit("approved"), lambda now, h: worse(F.col("_statuses"), now, h["status"]))
    made = told.withColumns({"validation_status": F.when(F.col("_hits").isNotNull(), status), "validation_notes": F.transform("_hits", lambda h: h["note"]), "applied_rulebook": F.col(book_col)})
    return made.drop("_words", "_texts", "_book", "_rules", "_groups", "_statuses", "_identity", "_hits", "_again")
