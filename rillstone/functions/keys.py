"""Keys and scalars: DOIs, countries, publishers, numbers, URLs, text and payload tests. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fields import strip

# Fixed values.
DOI = r"(?i)10\.\d{4,9}/\S+"
DOI_IN_TEXT = r"(?i)(10\.\d{4,9}/[-._;()/:A-Z0-9]+)"
COUNTRIES = {"china": "CHN", "united states": "USA", "usa": "USA", "germany": "DEU", "argentina": "ARG", "canada": "CAN", "japan": "JPN", "south korea": "KOR", "australia": "AUS"}
PUBLISHERS = {"Elsevier": ["10.1016", "10.1011"], "Springer": ["10.1007", "10.1038", "10.1186"], "Wiley": ["10.1002", "10.1111"]}
WORKS_A, WORKS_B = "https://api.crossref.org/works/", "https://api.openalex.org/works/https://doi.org/"
INDICATORS_URL = "https://api.worldbank.org/v2/country/"
MIN_TEXT = 200


def doi(value: Column) -> Column:
    """The first DOI anywhere in the text, lower-cased, closing punctuation kept; else null."""
    return F.lower(F.nullif(F.regexp_extract(value, DOI, 0), F.lit("")))


def dois_in_text(text: Column) -> Column:
    """Every DOI of the stricter character class, in its own case and order."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(DOI_IN_TEXT), F.lit(1)), F.array().cast("array<string>"))


def iso3(value: Column) -> Column:
    """Three letters as a code, a known name as its code, else null."""
    name = strip(value)
    names = F.create_map(*[F.lit(x) for pair in COUNTRIES.items() for x in pair])
    return F.when(name.rlike(r"^\p{L}{3}$"), F.upper(name)).otherwise(F.element_at(names, F.lower(name)))


def publisher(key: Column) -> Column:
    """The publishing house by DOI prefix, else Unknown."""
    low, out = F.lower(key), F.lit("Unknown")
    for house, prefixes in PUBLISHERS.items():
        fits = F.lit(False)
        for p in prefixes:
            fits = fits | low.startswith(p)
        out = F.when(fits, house).otherwise(out)
    return out


def slug(key: Column) -> Column:
    """Runs outside [0-9A-Za-z._-] become _, and . and _ go at both ends."""
    return F.regexp_replace(F.regexp_replace(key, "[^0-9A-Za-z._-]+", "_"), "^[._]+|[._]+$", "")


def number(value: Column) -> Column:
    """Text as a double: blanks around it, exponents, nan, inf and _ between digits are read; anything else is null."""
    text = F.regexp_replace(strip(value.cast("string")), r"(?<=[0-9])_(?=[0-9])", "")
    form = r"(?i)^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|nan|inf|infinity)$"
    return F.when(text.rlike(form), text.try_cast("double"))


def percent_encoded(text: Column) -> Column:
    """URL percent-encoding with no safe characters but letters, digits and _.-~"""
    form = F.url_encode(text)
    return F.replace(F.replace(F.replace(form, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def indicator_url(country: Column, indicator: Column, first_year: int = 2010, last_year: int = 2024) -> Column:
    return F.concat(F.lit(INDICATORS_URL), country, F.lit("/indicator/"), indicator, F.lit(f"?format=json&date={first_year}%3A{last_year}&per_page=20000"))


def is_extractable(text: Column) -> Column:
    """At least MIN_TEXT characters once white space is collapsed."""
    return F.length(strip(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))) >= MIN_TEXT


def is_pdf(body: Column) -> Column:
    return F.coalesce(F.startswith(body, F.unhex(F.lit("25504446"))), F.lit(False))


def first_year(*dates: Column) -> Column:
    """Year of the first date that has any parts. dates: structs with an array<array<int>> field date-parts."""
    parts = [F.when(F.size(d["date-parts"]) > 0, F.get(F.get(d["date-parts"], F.lit(0)), F.lit(0))) for d in dates]
    has = [F.size(d["date-parts"]) > 0 for d in dates]
    out = F.lit(None).cast("int")
    for ok, year in reversed(list(zip(has, parts, strict=True))):
        out = F.when(ok, year).otherwise(out)
    return out
