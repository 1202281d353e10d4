"""Removal of repeated byte strings by buckets of q-grams, refined by the buckets at later offsets.

This is not bucket-pointer refinement to the letter: no bucket is sorted by later identifiers, and updated buckets are not
used again (see the README for why). The bucket of a position is the hash of the Q bytes that start there. Buckets are refined from others:
the refined bucket of a span is made of the bucket identifiers at its start and at later offsets, and only spans
whose bucket still has another member are looked at again, at a finer step:

1. every LENGTH-byte window is represented by the position in it whose bucket hash is least (leftmost on ties), which
   depends on the window's own bytes alone, so equal windows are represented at equal offsets. Representatives with a
   bucket of their own rule out their windows.
2. the windows of a surviving representative are dealt into cells of CELL offsets. The core of a cell, shared by its
   windows, and its hull, which spans them all, get refined buckets. A unique core rules the cell out; a repeated hull
   settles that all its windows are repeated.
3. only cells in between, and one member of each settled hull that such a cell may still meet, are refined to single
   windows.

A bucket has another member when the least and the largest of its occurrences (text, offset) differ: a partial aggregate,
so a string that a third of the corpus shares costs a row per task. Texts travel once per step, and only those concerned.

Defined cases: null and empty texts have no windows; a text of fewer than LENGTH bytes keeps all; equal texts of at least
LENGTH bytes lose all, repeated rows included; windows never cross documents; overlaps within a document count; ids may be
null, repeated or of any type; columns of other names are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, save, slices, small, text_key, tidy
from .near_dedup import mix

LENGTH, Q, CELL = 200, 100, 25
#: Bytes handled at once; longer documents overlap by LENGTH - 1.
BLOCK = 1 << 18
#: Keys of texts that may be broadcast to filter documents before they are shuffled.
BROADCAST_TEXTS = 1_000_000
_U = np.uint64
OCCURRENCE = "xxhash64(k1, k2, at)"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """A rolling hash: the bucket identifier of each position at which Q bytes start."""

    def __init__(self, base: int, seed: int):
        self.bytes = mix(np.arange(seed, seed + 256, dtype=_U))
        self.up, self.down = _powers(base, BLOCK + LENGTH), _powers(pow(base, -1, 1 << 64), BLOCK + LENGTH)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n < Q:
            return np.empty(0, _U)
        total = np.empty(n + 1, _U)
        total[0] = 0
        np.cumsum(self.bytes[data] * self.down[:n], out=total[1:])
        return mix((total[Q:] - total[:-Q]) * self.up[: n - Q + 1])


#: Two hashes that share neither base nor byte values: what one of them confuses, the other tells apart.
FIRST, SECOND = Rolling(0x9E3779B97F4A7C15, 1), Rolling(0xD1342543DE82EF95, 1 << 32)


def _window_argmin(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of width hashes the position of the least one, by its upper half, leftmost on ties."""
    n = len(hashes)
    key = (hashes & _U(0xFFFFFFFF00000000)) | np.arange(n, dtype=_U)
    padded = np.full(-(-n // width) * width, ~_U(0), _U)
    padded[:n] = key
    rows = padded.reshape(-1, width)
    before = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return (np.minimum(after[:m], before[width - 1 : width - 1 + m]) & _U(0xFFFFFFFF)).astype(np.int64)


def _blocks(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of a document of at most BLOCK windows; each window of LENGTH bytes is in exactly one."""
    for start in range(0, max(0, len(text) - LENGTH + 1), BLOCK):
        yield start, np.frombuffer(text, np.uint8, min(len(text) - start, BLOCK + LENGTH - 1), start)


def refined(buckets: tuple[np.ndarray, np.ndarray], start: np.ndarray, length: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The refined bucket, in two halves, of spans of Q to 3 * Q bytes: from the identifiers at the start and at two later
    offsets, so that the three cover the span. Each half is made by a hash of its own, of all the span's bytes."""
    halves = []
    for bucket in buckets:
        made = bucket[start]
        for k in (np.minimum(Q, length - Q), length - Q):
            made = mix(made * _U(3) + bucket[start + k])
        halves.append(made)
    return halves[0], halves[1]


class _Part:
    """Buckets of one part of a document, and for each window its representative."""

    def __init__(self, data: np.ndarray):
        self.data, self.bucket = data, FIRST(data)
        self.chosen = _window_argmin(self.bucket, LENGTH - Q + 1)  # one for each window
        self.windows = len(self.chosen)
        cut = np.flatnonzero(np.diff(self.chosen)) + 1
        self.first = np.concatenate(([0], cut))  # windows [first, last] have the same representative
        self.last = np.concatenate((cut, [self.windows])) - 1
        self.at = self.chosen[self.first]

    def cells(self, keep: np.ndarray) -> list[np.ndarray]:
        """Cells of the kept representatives: cell c has the windows that start c * CELL ... c * CELL + CELL - 1 before it.
        First and last window, then the keys of core and hull."""
        at, low, high = self.at[keep], (self.at - self.last)[keep], (self.at - self.first)[keep]
        buckets, found = (self.bucket, SECOND(self.data)), []
        for c in range((LENGTH - Q) // CELL + 1):
            a, b = c * CELL, min(c * CELL + CELL - 1, LENGTH - Q)
            has = (low <= b) & (high >= a)
            p, lo, hi = at[has], np.maximum(low[has], a), np.minimum(high[has], b)
            core = refined(buckets, p - a, LENGTH - (b - a))  # a partly filled cell's windows cover the full cell's core too
            hull = refined(buckets, p - hi, LENGTH + hi - lo)
            shape = (lo * LENGTH + hi + 1).astype(_U)  # where its windows stand is part of a hull's key
            found.append((p - hi, p - lo, *(mix(x + _U(c + 1)) for x in core), *(mix(x + shape) for x in hull)))
        return [np.concatenate(x) for x in zip(*found, strict=True)]


def _array(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == _U else x)


def _concerned(texts: DataFrame, keys: DataFrame, what: DataFrame) -> DataFrame:
    """Texts joined with what; keys' number is checked before they are broadcast to filter texts ahead of the shuffle."""
    n = keys.count()
    if n <= BROADCAST_TEXTS:
        texts = texts.join(F.broadcast(keys), ["k1", "k2"], "left_semi")
    return texts.join(what, ["k1", "k2"])


def _repeated(df: DataFrame, *key: str) -> DataFrame:
    """(key, one): keys with more than one occurrence (text, offset), and the least of them. They are written, so that the
    join back to the occurrences shuffles both sides and Spark can split it at hot keys."""
    found = df.groupBy(*key).agg(F.min(F.expr(OCCURRENCE)).alias("one"), F.max(F.expr(OCCURRENCE)).alias("_other")).filter("one <> _other").drop("_other")
    return save(found, "repeated")


def _emit(rows: list[tuple]) -> pa.RecordBatch:
    """Of (k1, k2, columns): one batch for many documents."""
    sizes = [len(next(iter(columns.values()))) for _, _, columns in rows]
    keys = {k: pa.array(np.repeat(np.array([r[i] for r in rows], np.int64), sizes)) for i, k in enumerate(("k1", "k2"))}
    return pa.RecordBatch.from_pydict(keys | {name: _array(np.concatenate([r[2][name] for r in rows])) for name in rows[0][2]})


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(k1, k2, first, last): runs of windows of each text that start anywhere else too. texts: (k1, k2, text binary)."""

    @tidy
    def represent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            rows = [(k1, k2, {"at": part.at + start, "bucket": part.bucket[part.at]}) for k1, k2, text in keys for start, data in _blocks(text) for part in [_Part(data)]]
            if rows:
                yield _emit(rows)

    chosen = save(texts.mapInArrow(represent, "k1 long, k2 long, at long, bucket long"), "representatives")
    alive = chosen.join(_repeated(chosen, "bucket"), "bucket", "left_semi").groupBy("k1", "k2").agg(F.collect_set("at").alias("at"))
    alive = save(alive, "survivors")
    discard(chosen)

    @tidy
    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            rows = []
            for k1, k2, text, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wanted = np.array(at, np.int64)
                for start, data in _blocks(text):
                    part = _Part(data)
                    keep = np.isin(part.at + start, wanted)
                    if keep.any():
                        first, last, c1, c2, h1, h2 = part.cells(keep)
                        rows.append((k1, k2, {"at": first + start, "last": last + start, "c1": c1, "c2": c2, "h1": h1, "h2": h2}))
            if rows:
                yield _emit(rows)

    cells = _concerned(texts, alive.select("k1", "k2"), alive).select("k1", "k2", "text", "at").mapInArrow(refine, "k1 long, k2 long, at long, last long, c1 long, c2 long, h1 long, h2 long")
    cells = save(cells, "cells")
    alive = save(cells.join(_repeated(cells, "c1", "c2"), ["c1", "c2"], "left_semi"), "cells")
    discard(cells)
    known = save(alive.join(_repeated(alive, "h1", "h2"), ["h1", "h2"], "left").select("k1", "k2", "at", "last", "c1", "c2", "one"), "hulls")
    discard(alive)
    settled, open_cells = known.filter("one is not null"), known.filter("one is null")
    # A settled hull has many members; one of them stands for all where an open cell with the same core may meet it.
    stand_in = settled.filter(F.col("one") == F.expr(OCCURRENCE)).join(open_cells.select("c1", "c2").distinct(), ["c1", "c2"], "left_semi")
    spans = open_cells.select("k1", "k2", "at", "last").union(stand_in.select("k1", "k2", "at", "last"))
    spans = save(spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("at", "last")).alias("spans")), "spans")

    @tidy
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            rows = []
            for k1, k2, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for start, data in _blocks(text):
                    mine = [np.arange(s["at"] - start, s["last"] - start + 1) for s in spans if start <= s["at"] < start + len(data) - LENGTH + 1]
                    if mine:
                        at = np.concatenate(mine)
                        one, two = refined((FIRST(data), SECOND(data)), at, LENGTH)
                        rows.append((k1, k2, {"at": at + start, "w1": one, "w2": two}))
            if rows:
                yield _emit(rows)

    single = _concerned(texts, spans.select("k1", "k2"), spans).select("k1", "k2", "text", "spans").mapInArrow(windows, "k1 long, k2 long, at long, w1 long, w2 long")
    single = save(single, "windows")
    found = single.join(_repeated(single, "w1", "w2"), ["w1", "w2"], "left_semi").select("k1", "k2", F.col("at").alias("first"), F.col("at").alias("last"))
    return settled.select("k1", "k2", F.col("at").alias("first"), "last").union(found)


def _covered(n: int, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal byte intervals that the windows starting in the runs cover."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], last + LENGTH)
        else:
            out.append((first, last + LENGTH))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary or null): kept is null where nothing was removed, so whole texts
    don't travel; restore() or a reader takes the document's own text there."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", "text", *text_key(F.col("text")))
    rows = save(keyed.select("id", "k1", "k2", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "rows")
    texts = keyed.filter(F.octet_length("text") >= LENGTH).select("k1", "k2", "text")
    copied = save(rows.filter(F.col("n_bytes") >= LENGTH).groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").select("k1", "k2"), "copied")
    n = copied.count()
    keys = small(copied, n, BROADCAST_TEXTS)
    # One row for each text that has copies; the others are read where they are.
    once = save(texts.join(keys, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text")), "copied-texts")
    texts = texts.join(keys, ["k1", "k2"], "left_anti").unionByName(once)
    runs = repeated_windows(texts).join(copied, ["k1", "k2"], "left_anti")
    runs = save(runs.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("runs")), "runs")

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            out = []
            for text, runs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                spans = _covered(len(text), [(r["first"], r["last"]) for r in runs])
                edges = [0, *(e for s in spans for e in s), len(text)]
                out.append((sum(b - a for a, b in spans), len(spans), b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))))
            removed, n, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(n, pa.int64()), pa.array(kept, pa.binary())], ["k1", "k2", "n_removed", "n_spans", "kept"])

    changed = _concerned(texts, runs.select("k1", "k2"), runs).select("k1", "k2", "text", "runs").mapInArrow(cut, "k1 long, k2 long, n_removed long, n_spans long, kept binary")
    whole = copied.join(rows.select("k1", "k2", "n_bytes"), ["k1", "k2"]).groupBy("k1", "k2").agg(F.max("n_bytes").alias("n_removed")).select("k1", "k2", "n_removed", F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept"))
    changed = save(changed.union(whole), "changed")
    return rows.join(changed, ["k1", "k2"], "left").select(F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"), "kept", F.coalesce(F.sha2("kept", 256), F.col("sha")).alias("kept_sha256"))
