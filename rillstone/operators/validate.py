"""Record audit: rules to severity and notes, duplicate identities, status counts.

All rules of a record are one projection. Counting identities shuffles identities alone. Repeated ones are joined back: where
they are few they are broadcast, and records stay where they are; else records are shuffled once, in a join that Spark can
split at an identity that very many records share (all blank).

A rulebook in code is compiled into the plan; rulebooks in a table, of any number and size, go through operators/ruled.py.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillstone.functions.fields import alias, first_present, identity_text, present
from rillstone.plans.rulebook import Rulebook
from rillstone.sources.scratch import written

REPEATED = "possible duplicate row"
#: Rules of a record that one word of its bit mask holds.
BITS = 62


def _rules(df: DataFrame, book: Rulebook) -> list[tuple[Column, str, str]]:
    """(condition, status, note) in the order notes are listed."""
    out = []
    for f in book.required_fields:
        out.append((alias(df, f).isNull(), "rejected" if f in book.reject_if_missing else "needs_review", f"missing {f}"))
    for group in book.required_any_groups:
        status = "rejected" if set(group) & set(book.reject_if_missing) else "needs_review"
        out.append((first_present(df, [name for f in group for name in f.split("|")]).isNull(), status, f"missing one of {'/'.join(group)}"))
    for g in book.review_if_missing:
        out.append((alias(df, g).isNull(), "needs_review", f"review required for missing {g}"))
    for f in book.forbidden_fields:
        out.append((alias(df, f).isNotNull(), "rejected", f"forbidden field present: {f}"))
    return out


def _mask(df: DataFrame, book: Rulebook) -> Column:
    """Which rules a record breaks, as bits of an array of words."""
    rules = _rules(df, book)
    word = lambda part: reduce(lambda m, r: m + F.when(r[1][0], F.lit(1 << r[0])).otherwise(0), enumerate(part), F.lit(0).cast("long"))
    return F.array(*[word(rules[k : k + BITS]) for k in range(0, max(1, len(rules)), BITS)])


def worse(order: Column, now: Column, then: Column) -> Column:
    """The later of two statuses in the order of an array; one outside it wins."""
    at = lambda s: F.array_position(order, s)
    return F.when((at(then) == 0) | (at(now) == 0) | (at(then) > at(now)), then).otherwise(now)


def merged_status(book: Rulebook, rules: list[tuple[Column, str]]) -> Column:
    """The status of a record from (condition, status) pairs, in order. Where the rulebook lists all statuses, it is the
    greatest severity; a truncated list makes the order of rules matter."""
    statuses = list(book.allowed_statuses)
    if all(s in statuses for _, s in rules) and statuses[0] == "approved":
        worst = F.greatest(F.lit(0), F.lit(0), *[F.when(c, statuses.index(s)).otherwise(0) for c, s in rules])
        return F.get(F.array(*map(F.lit, statuses)), worst)
    hits = F.array_compact(F.array(*[F.when(c, F.lit(s)) for c, s in rules]))
    return F.aggregate(hits, F.lit("approved"), lambda a, s: worse(F.array(*map(F.lit, statuses)), a, s))


def identity(df: DataFrame, book: Rulebook) -> Column:
    """The record's identity: its normalised alias groups as one text."""
    return F.concat_ws("\x1f", *[identity_text(alias(df, g)) for g in book.duplicate_identity_fields])


def repeated_identities(df: DataFrame, key: Column) -> DataFrame:
    """(key, n) of identities that more than one record has."""
    return df.select(key.alias("_identity")).groupBy("_identity").agg(F.count("*").alias("_n")).filter("_n > 1")


def with_repeats(keyed: DataFrame) -> DataFrame:
    """Records with _identity, and _again: whether another record has the same."""
    many = repeated_identities(keyed, F.col("_identity"))
    return keyed.join(many, "_identity", "left").withColumn("_again", F.col("_n").isNotNull()).drop("_n")


def audit(df: DataFrame, book: Rulebook) -> DataFrame:
    """Records with validation_status, validation_notes and applied_rulebook; every record is kept."""
    return audit_many(df.withColumn("_book", F.lit(book.name)), "_book", [book]).drop("_book")


def audit_many(df: DataFrame, book_col: str, books: list[Rulebook]) -> DataFrame:
    """Audit of a table whose records name their rulebook. Identities are counted within a rulebook; records of a
    rulebook that is not among books are not judged and have null columns."""
    chosen = lambda of: reduce(lambda rest, b: F.when(F.col(book_col) == b.name, of(b)).otherwise(rest), books, F.lit(None))
    # Every rule is judged once, as a bit; statuses and notes are read from the bits.
    keyed = df.withColumns({"_identity": F.concat_ws("\x1e", F.col(book_col), chosen(lambda b: identity(df, b))), "_mask": chosen(lambda b: _mask(df, b))})
    return _told(df, with_repeats(keyed), chosen, book_col)


def audit_parts(df: DataFrame, book: Rulebook) -> tuple[Callable[[DataFrame], DataFrame], DataFrame]:
    """(judge, keyed): records with _identity, and what gives them their audit columns once _again says whether it is repeated."""
    keyed = df.withColumn("_book", F.lit(book.name)).withColumns({"_identity": F.concat_ws("\x1e", "_book", identity(df, book)), "_mask": _mask(df, book)})
    return lambda flagged: _told(df, flagged, lambda of: of(book), "_book").drop("_book"), keyed


def _told(df: DataFrame, flagged: DataFrame, chosen: Callable[[Callable[[Rulebook], Column]], Column], book_col: str) -> DataFrame:
    again = F.col("_again")

    def told(b: Rulebook) -> list[tuple[Column, str, str]]:
        return [(F.get("_mask", F.lit(i // BITS)).bitwiseAND(F.lit(1 << i % BITS)) != 0, s, n) for i, (_, s, n) in enumerate(_rules(df, b))] + [(again, "needs_review", REPEATED)]

    def status(b: Rulebook) -> Column:
        return merged_status(b, [(c, s) for c, s, _ in told(b)])

    def notes(b: Rulebook) -> Column:
        return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, _, n in told(b)]))

    made = flagged.withColumns({"validation_status": chosen(status), "validation_notes": chosen(notes), "applied_rulebook": F.col(book_col)})
    return made.drop("_identity", "_again", "_mask")


def status_counts(audited: DataFrame) -> DataFrame:
    """One row: total, approved, needs_review, rejected; zeros are shown."""
    of = lambda s: F.count_if(F.col("validation_status") == s).alias(s)
    return audited.agg(F.count("*").alias("total"), of("approved"), of("needs_review"), of("rejected"))


def note_counts(audited: DataFrame) -> DataFrame:
    return audited.select(F.explode("validation_notes").alias("note")).groupBy("note").agg(F.count("*").alias("n"))


def numbered(df: DataFrame, *order: str, to: str = "row_number") -> DataFrame:
    """Rows numbered from 1 in the given order, without one task for all: ranges are sorted, counted, and each range's rows
    number on from the rows of the ranges before it. The ranges are written first, as drawing them again may cut them elsewhere."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = written(ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id() % (1 << 33)))
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_size"))  # a row for each partition
    before = sizes.select("_part", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return parts.join(F.broadcast(before), "_part").withColumn(to, F.col("_before") + F.col("_at") + 1).drop("_part", "_at", "_before")


def summary_document(audited: DataFrame, **facts: str) -> DataFrame:
    """One row, the summary document of a run: the status counts, the notes with their counts, and the facts given."""
    notes = note_counts(audited)
    listed = notes.agg(F.array_sort(F.collect_list(F.struct("note", "n"))).alias("notes"))  # a row for each rule
    return status_counts(audited).crossJoin(F.broadcast(listed)).withColumns({k: F.lit(v) for k, v in facts.items()})
