"""Benchmark decontamination by size-partitioned MinHash containment search.

An item of n distinct five-word shingles is contained in a document when at least MIN_CONTAINMENT of them occur there. For
a random order of shingles, the least shingle of an item is in the document with just that probability; an item's sketch
keeps its least-hashed shingles, floor((1 - MIN_CONTAINMENT) * u) + 1 of them, where u is the upper size of the item's
partition (powers of two). A contained item misses at most floor((1 - MIN_CONTAINMENT) * n) shingles, so at least one of
its sketch is in the document: the search loses nothing, and short items keep short sketches.

Documents' shingles are hashed inside generated code and meet only the sketches' hashes; candidate documents alone are
shingled again and verified by the exact share of the item's shingles, compared as text.

Words are lower-cased runs of letters and digits. An item of one to four words has one shingle, all its words, and is
searched among the documents' runs of as many words. Items are told apart by their text: ids take no part in the search.

Defined cases: items without words (null texts too) are contained in nothing; null documents have no words; a null item id
is reported as null, and an id with several texts once for each of them that is contained; repeated rows of documents are
reported each, repeated rows of items once; ties do not arise; documents are read whole, of any length; only the four named
columns are read, so others may have any name; empty tables give empty results. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import save, small, text_key

SHINGLE_WORDS, MIN_CONTAINMENT = 5, 0.8
#: Shingles of items, and keys of candidate documents, that may be broadcast; beyond it Spark shuffles.
BROADCAST_SHINGLES, BROADCAST_DOCS = 500_000, 1_000_000


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _runs(df: DataFrame, text: str, sizes: list[int], *keep: str, whole: bool = False) -> DataFrame:
    """(*keep, h, shingle): a row for each place where a run of so many words starts. whole: below SHINGLE_WORDS, only runs
    that are all of a text."""

    def of(m: int) -> DataFrame:
        size = F.size("_w") == m if whole and m < SHINGLE_WORDS else F.size("_w") >= m
        each = worded.filter(size).select(*keep, "_w", F.explode(F.sequence(F.lit(0), F.size("_w") - m)).alias("_i"))
        words = [F.get("_w", F.col("_i") + k) for k in range(m)]
        return each.select(*keep, F.xxhash64(*words).alias("h"), F.concat_ws(" ", *words).alias("shingle"))

    worded = df.select(*keep, _words(F.col(text)).alias("_w"))
    return reduce(DataFrame.unionByName, [of(m) for m in sizes])


def item_shingles(items: DataFrame, text: str, least: float) -> DataFrame:
    """(item, h, shingle, n, in_sketch): the distinct shingles of every item, named by the hash of its text."""
    rows = items.select(F.sha2(text, 256).alias("item"), text).distinct()
    each = _runs(rows, text, list(range(1, SHINGLE_WORDS + 1)), "item", whole=True).distinct()
    sizes = each.groupBy("item").agg(F.count("*").alias("n"))
    upper = F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1  # sizes 1, 2-3, 4-7, 8-15, ...
    sizes = sizes.withColumn("kept", F.floor(F.round((1 - least) * upper, 9)) + 1)
    order = F.row_number().over(Window.partitionBy("item").orderBy("h", "shingle"))  # an item is a short text
    return each.join(sizes, "item").withColumn("in_sketch", order <= F.col("kept")).drop("kept")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = MIN_CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles): each document row with each item it contains."""
    named = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("_t")).filter("_t is not null").distinct()
    index = save(item_shingles(named, "_t", least), "item-shingles")
    n = index.count()
    short = F.size(F.split("shingle", " "))
    sizes = sorted({SHINGLE_WORDS, *(r["m"] for r in index.select(short.alias("m")).distinct().collect())})  # SHINGLE_WORDS numbers at most
    sketch = index.filter("in_sketch").select("h", "item")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_t"), *text_key(text))
    first = _runs(rows, "_t", sizes, "k1", "k2").select("k1", "k2", "h")
    found = first.join(small(sketch, n, BROADCAST_SHINGLES), "h").select("k1", "k2", "item")
    candidates = save(found.distinct(), "candidates")
    keys = candidates.select("k1", "k2").distinct()
    again = rows.select("k1", "k2", "_t").join(small(keys, candidates.count(), BROADCAST_DOCS), ["k1", "k2"], "left_semi")
    shared = _runs(again, "_t", sizes, "k1", "k2").join(small(index.select("h", "shingle", "item", "n"), n, BROADCAST_SHINGLES), ["h", "shingle"])
    counted = shared.select("k1", "k2", "item", "n", "h", "shingle").distinct().groupBy("k1", "k2", "item", "n").agg(F.count("*").alias("n_shared"))
    verified = counted.filter(F.col("n_shared") >= F.ceil(F.round(F.lit(least) * F.col("n"), 9)))
    pairs = save(verified.join(candidates, ["k1", "k2", "item"], "left_semi"), "contained")
    copies = rows.select("doc_id", "k1", "k2").join(small(pairs.select("k1", "k2").distinct(), pairs.count(), BROADCAST_DOCS), ["k1", "k2"], "left_semi")
    ids = named.select("item_id", F.sha2("_t", 256).alias("item"))
    return copies.join(pairs, ["k1", "k2"]).join(small(ids, n, BROADCAST_SHINGLES), "item").select(F.col("doc_id").alias(id_col), F.col("item_id").alias(item_col), F.col("n_shared"), F.col("n").alias("n_shingles"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", least: float = MIN_CONTAINMENT) -> DataFrame:
    """The documents that contain no item. Texts decide, so rows with a null or repeated id are treated each."""
    text = F.col(text_col).cast("string")
    keys = text_key(text)
    bad = contaminated(docs.select(F.struct(*keys).alias("_key"), text_col), items, "_key", text_col, item_col, item_text_col, least)
    bad = save(bad.select(F.col("_key.k1").alias("_k1"), F.col("_key.k2").alias("_k2")).distinct(), "contaminated")
    keyed = docs.select(F.struct("*").alias("_doc"), *[k.alias(f"_k{i}") for i, k in enumerate(keys, 1)])
    return keyed.join(small(bad, bad.count(), BROADCAST_DOCS), ["_k1", "_k2"], "left_anti").select("_doc.*")
