"""Shared helpers: table reading, scratch tables on the shared folder, checked broadcasts."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Temporary folders of local sessions, by application.
_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; in local mode, where it is unset, one temporary folder for
    the session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        name = spark.sparkContext.applicationId
        if name not in _LOCAL:
            _LOCAL[name] = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        found = _LOCAL[name]
    return found.rstrip("/")


def save(df: DataFrame, what: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and return its reader.

    This cuts the lineage: a lost executor later costs a re-read, not a recomputation, and values such as
    monotonically_increasing_id() are fixed once written.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    saved = spark.read.schema(df.schema).parquet(path)
    saved._scratch = path
    return saved


def discard(saved: DataFrame) -> None:
    """Delete what save() wrote. Only for tables that nothing still to be run reads."""
    spark = saved.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(saved._scratch)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast hint only where the counted rows are within the limit; beyond it Spark shuffles (AQE splits hot keys)."""
    return F.broadcast(df) if rows <= limit else df


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most rows distinct rows of df, those with the least hash of key. A first cut by the hash keeps what reaches the
    last task near that bound, however large df is."""
    n, space = df.count(), 1 << 30
    if n > 2 * rows:
        df = df.filter(F.pmod(F.xxhash64(key), F.lit(space)) < int(2 * rows / n * space) + 1)
    return df.distinct().orderBy(F.xxhash64(key), *df.columns).limit(rows)


def text_key(text: Column) -> list[Column]:
    """Two 64-bit halves that identify a text; rows with equal texts share them."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(text, F.lit(1)).alias("k2")]


def slices(batch: pa.RecordBatch, column: int, most_bytes: int = 1 << 20, most_rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most most_rows rows and, if they hold more than one, most_bytes bytes in the column."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(batch):
        before = ends[at - 1] if at else 0
        end = max(at + 1, min(at + most_rows, int(np.searchsorted(ends, before + most_bytes, "right"))))
        yield batch.slice(at, end - at)
        at = end


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow; when its task ends, what Arrow and the C library have freed goes back to the system, as Python workers are
    used again."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)

    return tidied


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


class WordHasher:
    """64-bit hashes of a text's words, lower-cased runs of word characters; the hashes of some words are remembered."""

    WORDS, REMEMBERED = re.compile(r"\w+"), 100_000

    def __init__(self) -> None:
        self.known = _Hashes()

    def words(self, text: str | None) -> np.ndarray:
        found = self.WORDS.findall((text or "").lower())
        if len(self.known) > self.REMEMBERED:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, found), np.uint64, len(found))
