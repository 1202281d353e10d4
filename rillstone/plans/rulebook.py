"""Rulebooks as data: field lists merged over a default, a rule table, and the routing of batches to them."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rulebook:
    name: str
    required_fields: tuple[str, ...]
    required_any_groups: tuple[tuple[str, ...], ...]
    duplicate_identity_fields: tuple[str, ...]
    review_if_missing: tuple[str, ...]
    reject_if_missing: tuple[str, ...]
    forbidden_fields: tuple[str, ...]
    allowed_statuses: tuple[str, ...] = ("approved", "needs_review", "rejected")

    def overridden(self, custom: dict) -> Rulebook:
        """This rulebook with the given kinds of rules in place of its own."""
        known = {f.name for f in fields(self)}
        kinds = {k: tuple(tuple(x) if isinstance(x, list) else x for x in v) if isinstance(v, list) else v for k, v in custom.items() if k in known}
        return replace(self, **kinds)


# Alias groups and the four rulebooks.
POLLUTANT = "pollutant_group|pollutant_original|pollutant"
GEOGRAPHY = "geographic_scope|location|country"
PERIOD = "temporal_window|sampling_period|sampling_period_label"
VALUE = "value_numeric|value_min|value_max"
EVIDENCE = "evidence_location|evidence_page|table_figure_id"
FORBIDDEN = ("model_prediction", "toxicity_threshold", "regulatory_limit")


def _group(text: str) -> tuple[str, ...]:
    return tuple(text.split("|"))


GENERIC = Rulebook("generic", ("paper_title", "doi"), (_group(POLLUTANT), ("matrix",), _group(EVIDENCE)), ("doi", POLLUTANT, "matrix", GEOGRAPHY, PERIOD), ("matrix",), ("paper_title", "doi"), FORBIDDEN)
RECORD = Rulebook("record", ("paper_title", "doi", "matrix"), (_group(POLLUTANT), _group(GEOGRAPHY), _group(VALUE), _group(EVIDENCE)), ("doi", POLLUTANT, "matrix", GEOGRAPHY, PERIOD, VALUE), ("unit_original", "unit_standardized"), ("paper_title", "doi", "matrix"), FORBIDDEN)
SYNTHESIS = Rulebook("synthesis", ("paper_title", "doi"), (_group(POLLUTANT), ("matrix",), _group(GEOGRAPHY), _group(PERIOD), _group(EVIDENCE)), ("doi", POLLUTANT, "matrix", GEOGRAPHY, PERIOD), (PERIOD,), ("paper_title", "doi"), FORBIDDEN)
REBUILD = Rulebook("reference_rebuild", ("paper_title", "doi"), (_group(POLLUTANT), _group(EVIDENCE)), ("doi", POLLUTANT, "matrix", GEOGRAPHY), ("matrix", GEOGRAPHY), ("paper_title", "doi"), FORBIDDEN)
RULEBOOKS = {r.name: r for r in (GENERIC, RECORD, SYNTHESIS, REBUILD)}
ALIASES = [("science", "synthesis"), ("science_synthesis", "synthesis"), ("scienceadv", "synthesis"), ("nature", "record"), ("nature_record", "record"), ("est", "reference_rebuild"), ("tfa", "reference_rebuild"), ("est_reference_rebuild", "reference_rebuild")]
SYNTHESIS_FIELDS, RECORD_FIELDS, REBUILD_FIELDS = ("trend_direction", "risk_threshold", "measurement_record_count_min"), ("value_numeric", "value_min", "value_max"), ("reference_short_citation", "reference_resolution_status")


RULES = "rulebook string, rule_kind string, ordinal int, field_group array<string>"
KINDS = [f.name for f in fields(Rulebook) if f.name != "name"]


def rule_table(spark: SparkSession, books: list[Rulebook]) -> DataFrame:
    """(rulebook, rule_kind, ordinal, field_group): one row for each rule. A group is the names of one alias group, or the
    members of a required-any group."""
    rows = []
    for b in books:
        for f in fields(b):
            value = getattr(b, f.name)
            if f.name != "name":
                rows += [(b.name, f.name, i, list(x) if isinstance(x, tuple) else x.split("|")) for i, x in enumerate(value)]
    return spark.createDataFrame(rows, RULES)


def rules_of_documents(docs: DataFrame, default_name: str = "generic") -> DataFrame:
    """The rule table of JSON rulebook documents (value): objects of rule kinds, other fields are passed over. Each kind that a
    document lists also gives a row of ordinal -1, so that an empty list is a rule kind without rules."""
    parsed = docs.select(F.from_json("value", "map<string, string>").alias("_kinds")).filter("_kinds is not null")
    named = parsed.select(F.coalesce(F.col("_kinds")["name"], F.lit(default_name)).alias("rulebook"), F.explode("_kinds").alias("rule_kind", "_items")).filter(F.col("rule_kind").isin(*KINDS))
    items = F.transform(F.coalesce(F.from_json("_items", "array<string>"), F.array().cast("array<string>")), lambda x, i: F.struct(i.alias("ordinal"), F.when(x.startswith("["), F.from_json(x, "array<string>")).otherwise(F.split(x, "[|]")).alias("field_group")))
    listed = F.concat(F.array(F.struct(F.lit(-1).alias("ordinal"), F.array().cast("array<string>").alias("field_group"))), items)
    return named.select("rulebook", "rule_kind", F.inline(listed)).select("rulebook", "rule_kind", "ordinal", "field_group")


def with_defaults(custom: DataFrame, default: DataFrame) -> DataFrame:
    """Rule tables merged: in each rulebook of the custom table, a kind of rule that it has replaces the default's whole kind.
    default: the few rules of one rulebook."""
    books, kinds = custom.select("rulebook").distinct(), custom.select("rulebook", "rule_kind").distinct()
    rest = books.join(F.broadcast(default.drop("rulebook").withColumn("_", F.lit(1))), F.col("_") == 1).drop("_")
    return custom.unionByName(rest.join(kinds, ["rulebook", "rule_kind"], "left_anti"))


def alias_table(spark: SparkSession, aliases: list[tuple[str, str]] = ALIASES) -> DataFrame:
    """(alias_ord, alias, rulebook) in the order in which they are tried."""
    return spark.createDataFrame([(i, a, r) for i, (a, r) in enumerate(aliases)], "alias_ord int, alias string, rulebook string")


def _worded(text: Column) -> Column:
    """A text's words, runs of a-z and 0-9 of its lower case, each with _ on both sides."""
    return F.concat(F.lit("_"), F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_")), F.lit("_"))


def alias_index(aliases: DataFrame) -> DataFrame:
    """(token, alias_ord, worded, rulebook): each alias under the one of its words that fewest aliases have."""
    worded = aliases.select("alias_ord", _worded(F.col("alias")).alias("worded"), "rulebook").filter("worded <> '__'")
    each = worded.withColumn("token", F.explode(F.array_distinct(F.split(F.trim("worded", F.lit("_")), "_"))))
    rare = each.join(each.groupBy("token").agg(F.count("*").alias("n")), "token")
    return rare.groupBy("alias_ord", "worded", "rulebook").agg(F.min(F.struct("n", "token")).alias("r")).select("r.token", "alias_ord", "worded", "rulebook")


def route_by_label(batches: DataFrame, probes: Column, to: str = "rulebook", substring: bool = False, aliases: DataFrame | None = None) -> DataFrame:
    """batches with the rulebook whose alias is first found in the probes (an array, in order), else generic. aliases:
    (alias_ord, alias, rulebook), any number of them.

    By default an alias must be a run of whole words of the probe, so that "geoscience" is no "science" and "latest" no
    "est": probes meet aliases by a word, in a plain join. substring takes any occurrence, and tries every alias.
    """
    aliases = alias_table(batches.sparkSession) if aliases is None else aliases
    rows = batches.withColumn("_probes", probes)
    each = rows.select("_probes").distinct().select("_probes", F.posexplode("_probes").alias("_p", "_probe"))
    if substring:
        met = each.join(F.broadcast(aliases), F.contains(F.lower("_probe"), F.col("alias")))
    else:
        worded = each.withColumn("_worded", _worded(F.col("_probe")))
        tokens = worded.withColumn("token", F.explode(F.array_distinct(F.split(F.trim("_worded", F.lit("_")), "_"))))
        met = tokens.join(alias_index(aliases), "token").filter(F.contains("_worded", F.col("worded")))
    hit = met.groupBy("_probes").agg(F.min_by("rulebook", F.struct("_p", "alias_ord")).alias("_book"))
    return rows.join(hit, "_probes", "left").withColumn(to, F.coalesce("_book", F.lit("generic"))).drop("_probes", "_book")


def route_by_names(names: DataFrame, batch: str) -> DataFrame:
    """(batch, rulebook) by the field names that any record of the batch has, null or not: synthesis, record, rebuild,
    generic. names: (batch, name), as records.field_names() finds them."""
    has = lambda which: F.coalesce(F.max(F.col("name").isin(*which)), F.lit(False))
    flags = names.groupBy(batch).agg(has(SYNTHESIS_FIELDS).alias("s"), has(RECORD_FIELDS).alias("r"), has(REBUILD_FIELDS).alias("b"))
    return flags.select(batch, F.when(F.col("s"), "synthesis").when(F.col("r"), "record").when(F.col("b"), "reference_rebuild").otherwise("generic").alias("rulebook"))


def shared_fields(names: DataFrame, batch: str, rules: DataFrame) -> DataFrame:
    """(batch, rulebook, fields): the fields that a batch has and a rulebook names. names: (batch, name); rules: a rule table."""
    named = rules.select("rulebook", F.explode("field_group").alias("f")).select("rulebook", F.explode(F.transform(F.split("f", "[|]"), lambda x: F.trim(x))).alias("name")).distinct()
    met = names.select(batch, "name").distinct().join(named, "name")
    return met.groupBy(batch, "rulebook").agg(F.array_sort(F.collect_list("name")).alias("fields"))  # a rulebook's fields at most
