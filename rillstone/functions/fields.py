"""Missing values, alias groups and text identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_EDGE_SPACE = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    """Without Unicode white space at either end (trim() takes spaces alone)."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def present(df: DataFrame, name: str) -> Column:
    """The column's value, or null where it is missing: null, '' or []. Unknown columns are missing everywhere. 0, false and
    ' ' are present."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, StringType):
        return F.nullif(value, F.lit(""))
    if isinstance(kind, ArrayType):
        return F.when(F.size(value) > 0, value)
    return value


def first_present(df: DataFrame, names: list[str]) -> Column:
    """The first value present among several columns, as text where their types differ."""
    found = [present(df, n) for n in names if n.strip()]
    kinds = {df.schema[n].dataType for n in names if n in df.columns}
    if len(kinds) > 1:
        found = [F.to_json(c) if isinstance(df.schema[n].dataType, ArrayType) else c.cast("string") for n, c in zip([n for n in names if n.strip()], found, strict=True) if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def alias(df: DataFrame, group: str) -> Column:
    """The first value present of an alias group a|b|c; blank parts are skipped."""
    return first_present(df, [p.strip() for p in group.split("|")])


def identity_text(value: Column) -> Column:
    """Text identity: stripped and lower-cased, missing as ''."""
    return F.lower(strip(F.coalesce(value.cast("string"), F.lit(""))))


def as_rows(frames: list[DataFrame]) -> DataFrame:
    """One table of heterogeneous ones: the union of their columns, null where a table has none."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def unpivoted(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """(*keep, column, value): one row for each of the columns, value as text."""
    values = [F.struct(F.lit(c).alias("column"), present(df, c).cast("string").alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*values)))
