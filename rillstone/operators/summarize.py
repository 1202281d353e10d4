"""Grouped, top-k and numeric summaries of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions.fields import present, unpivoted
from rillstone.functions.keys import number

NUMERIC = ["value_numeric", "value_min", "value_max", "measurement_record_count_min"]


def counts(df: DataFrame, key: Column, order: str = "row_number") -> DataFrame:
    """(key, n, first_row) of the values present."""
    rows = df.select(key.cast("string").alias("key"), F.col(order).alias("_row"))
    return rows.filter(F.col("key").isNotNull() & (F.col("key") != "")).groupBy("key").agg(F.count("*").alias("n"), F.min("_row").alias("first_row"))


def several_counts(df: DataFrame, keys: dict[str, Column], order: str = "row_number") -> DataFrame:
    """(kind, key, n, first_row) of several keys from one scan and one shuffle."""
    rows = df.select(F.col(order).alias("_row"), F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in keys.items()])))
    return rows.filter(F.col("key").isNotNull() & (F.col("key") != "")).groupBy("kind", "key").agg(F.count("*").alias("n"), F.min("_row").alias("first_row"))


def top(counted: DataFrame, k: int | None = 10) -> DataFrame:
    """The k most frequent, ties by first appearance; all of them for None."""
    ordered = counted.orderBy(F.desc("n"), "first_row")
    return ordered if k is None else ordered.limit(k)


def numeric_values(df: DataFrame, *keep: str) -> DataFrame:
    """(*keep, column, value): every numeric reading of the four columns."""
    rows = unpivoted(df, NUMERIC, *keep)
    return rows.withColumn("value", number(F.col("value"))).filter(F.col("value").isNotNull())


def numeric_summary(values: DataFrame, *by: str) -> DataFrame:
    """count, mean, min and max of the finite values, and how many were not finite."""
    v = F.col("value")
    finite = ~F.isnan(v) & (F.abs(v) != float("inf"))
    kept = F.when(finite, v)
    return values.groupBy(*by).agg(F.count(kept).alias("n"), F.avg(kept).alias("mean"), F.min(kept).alias("min"), F.max(kept).alias("max"), F.count_if(~finite).alias("not_finite"))


def threshold_summary(df: DataFrame) -> DataFrame:
    """count, min and max of the finite thresholds, and how many were not finite."""
    v = number(present(df, "risk_threshold"))
    finite = ~F.isnan(v) & (F.abs(v) != float("inf"))
    kept = F.when(finite, v)
    return df.agg(F.count(kept).alias("n"), F.min(kept).alias("min"), F.max(kept).alias("max"), F.count_if(~finite).alias("not_finite"))


def group_table(df: DataFrame, key: Column) -> DataFrame:
    """(key, row_count, trend_notes): trend_notes are the distinct trend directions, sorted, joined by '; '."""
    rows = df.select(key.cast("string").alias("key"), present(df, "trend_direction").alias("_trend"))
    made = rows.filter(F.col("key").isNotNull() & (F.col("key") != "")).groupBy("key").agg(F.count("*").alias("row_count"), F.array_join(F.array_sort(F.collect_set("_trend")), "; ").alias("trend_notes"))
    return made.orderBy(F.desc("row_count"), "key")


def listed(counted: DataFrame, name: str, k: int | None = 10) -> DataFrame:
    """One row: the k most frequent (all for None) as one array of (key, n), most frequent first, ties by first appearance."""
    rows = top(counted, k) if k is not None else counted
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("_n"), "first_row", "key", "n")))
    return rows.agg(F.transform(ordered, lambda x: F.struct(x["key"], x["n"])).alias(name))


def beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Tables of one row side by side."""
    for other in others:
        first = first.crossJoin(F.broadcast(other))
    return first


def analytics_document(df: DataFrame, pollutant: Column, geography: Column, overview: DataFrame, external: DataFrame, order: str = "row_number") -> DataFrame:
    """One row, the analytics summary of a run: how many rows, the most frequent pollutants, matrices and places, trends, numeric
    and threshold summaries, the context's overview and what external context was joined (tables of one row each)."""
    numeric = numeric_summary(numeric_values(df)).select(F.struct(F.col("n").alias("count"), "mean", "min", "max").alias("numeric_summary"))
    threshold = threshold_summary(df).select(F.struct(F.col("n").alias("count"), "min", "max").alias("risk_threshold_summary"))
    whole = lambda one, name: one.select(F.struct(*one.columns).alias(name))
    trends = listed(counts(df, present(df, "trend_direction"), order), "trend_direction_counts", None)  # a row for each trend there is
    tops = [listed(counts(df, key, order), name) for key, name in ((pollutant, "top_pollutants"), (present(df, "matrix"), "top_matrices"), (geography, "top_geographies"))]
    return beside(df.agg(F.count("*").alias("total_rows")), *tops, trends, numeric, threshold, whole(overview, "context_overview"), whole(external, "external_context_summary"))
