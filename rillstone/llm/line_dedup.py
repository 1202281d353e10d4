"""Line dedup with two mergeable Bloom filters (once seen, twice seen).

Pass 1 builds both filters per task and folds them chunk by chunk; a key that occurs in two documents has all its bits
in the twice-seen filter, so there are no false negatives. Pass 2 shuffles only keys the filter suspects, summed per
batch before the shuffle, and counts them exactly by the key itself. Pass 3 drops the confirmed keys' lines.

The filters' size follows the number of documents. Beyond MAX_FILTER_BITS, too large to send to every executor, keys' 8-byte
hashes are dealt out by range instead: each range has a pair of filters of its own that never leaves its task, and what it
sees a second time are the suspects. They make one filter of bounded size, through which pass 2 goes as before: of lines
only suspects' keys leave a task (a full filter lets more through, and loses nothing). Results never depend on the filters.

Defined cases: null and empty texts are one empty line, whose key is empty and never dropped; repeated rows count as
separate documents; several equal lines of one document count once; lines and texts may have any length; ids may be null,
repeated, or of any type that has an order; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import save, slices

LINES_PER_DOCUMENT = 16
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 16, 1 << 28
#: Bits of one range's filters; bits for each suspect in the filter of all.
RANGE_BITS, SUSPECT_BITS = 1 << 26, 12
CHUNK_BYTES = 1 << 14
#: Tasks that each build a pair of filters.
MOST_LANES = 64
HASHES = 3
#: Confirmed keys up to so many bytes go to the executors as one set; beyond it they are joined.
BROADCAST_KEY_BYTES = 16 << 20


def line_key(line: bytes) -> bytes:
    """Stripped of [\\x20\\x09-\\x0D] at both ends, A-Z lower-cased (bytes.lower touches ASCII letters alone)."""
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def _bits(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(i) * step) & np.uint64(n_bits - 1) for i in range(HASHES)])


def _contains(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _set(bits: np.ndarray, at: np.ndarray) -> None:
    flat = at.ravel()
    np.bitwise_or.at(bits, flat >> np.uint64(3), np.left_shift(np.uint8(1), (flat & np.uint64(7)).astype(np.uint8)))


def _keys(texts: pa.Array, min_length: int) -> Iterator[set[bytes]]:
    for text in texts.to_pylist():
        keys = {line_key(line) for line in (text or b"").split(b"\n")}
        yield {k for k in keys if k and (min_length <= 1 or len(k.decode("utf-8", "replace")) >= min_length)}


def twice_seen_filter(docs: DataFrame, text_col: str, n_bits: int, min_length: int = 1) -> bytes:
    """The merged twice-seen filter, of n_bits bits at most MAX_FILTER_BITS."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(n_bits // 8, np.uint8), np.zeros(n_bits // 8, np.uint8)
        for batch in batches:
            found = [xxhash.xxh3_64_intdigest(k) for keys in _keys(batch.column(0), min_length) for k in keys]
            if not found:
                continue
            hashes, counts = np.unique(np.array(found, np.uint64), return_counts=True)
            at = _bits(hashes, n_bits)
            again = _contains(once, at) | (counts > 1)
            _set(twice, at[:, again])
            _set(once, at)
        for k in range(0, n_bits // 8, CHUNK_BYTES):
            a, b = once[k : k + CHUNK_BYTES], twice[k : k + CHUNK_BYTES]
            if a.any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([k // CHUNK_BYTES], pa.int32()), "once": [a.tobytes()], "twice": [b.tobytes()]})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, once, twice = 0, None, None
        for batch in batches:
            for row in batch.to_pylist():
                a, b = np.frombuffer(row["once"], np.uint8), np.frombuffer(row["twice"], np.uint8)
                chunk, once, twice = (row["chunk"], a.copy(), b.copy()) if once is None else (chunk, once | a, twice | b | (once & a))
        if once is not None:
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([chunk], pa.int32()), "twice": [twice.tobytes()]})

    # One pair of filters per task, 32 bytes a document each: MOST_LANES of them are less than a document's text. Filters
    # of this kind are for some millions of documents at most, so a task's share of them is small, too.
    lanes = min(MOST_LANES, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    texts = docs.select(F.col(text_col).cast("binary").alias("text")).coalesce(lanes)
    parts = texts.mapInArrow(build, "chunk int, once binary, twice binary")
    merged = np.zeros(n_bits // 8, np.uint8)
    for row in parts.groupBy("chunk").applyInArrow(fold, "chunk int, twice binary").toLocalIterator():
        merged[row["chunk"] * CHUNK_BYTES : (row["chunk"] + 1) * CHUNK_BYTES] = np.frombuffer(row["twice"], np.uint8)
    return merged.tobytes()


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def suspects_filter(suspects: DataFrame, most_bits: int) -> bytes:
    """One filter of the suspected hashes (h), of most_bits bits at most; each of its chunks is set in one place."""
    wanted = max(MIN_FILTER_BITS, SUSPECT_BITS * suspects.count())
    n_bits = min(most_bits, 1 << (wanted - 1).bit_length())

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_bits(batch.column(0).to_numpy().view(np.uint64), n_bits))
            yield pa.RecordBatch.from_arrays([pa.array((at // np.uint64(8 * CHUNK_BYTES)).astype(np.int32)), pa.array((at % np.uint64(8 * CHUNK_BYTES)).astype(np.int32))], ["chunk", "bit"])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, bits = 0, np.zeros(8 * CHUNK_BYTES, np.uint8)
        for batch in batches:
            if len(batch):
                chunk = batch.column(0)[0].as_py()
                bits[batch.column(1).to_numpy()] = 1
        yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["chunk", "bits"])

    merged = np.zeros(n_bits // 8, np.uint8)
    for row in suspects.mapInArrow(places, "chunk int, bit int").groupBy("chunk").applyInArrow(put, "chunk int, bits binary").toLocalIterator():
        part = merged[row["chunk"] * CHUNK_BYTES : (row["chunk"] + 1) * CHUNK_BYTES]
        part[:] = np.frombuffer(row["bits"], np.uint8)[: len(part)]
    return merged.tobytes()


def _by_key(docs: DataFrame, id_col: str, text_col: str, min_length: int, twice: bytes) -> DataFrame:
    """(key, h, n, first): for every batch of texts the keys that the filter suspects, their hash, in how many documents each
    is, and the smallest id of those."""
    sent = docs.sparkSession.sparkContext.broadcast(twice)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary"))
    kind = rows.schema["_id"].dataType.simpleString()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                flat = [(k, i) for i, keys in enumerate(_keys(part.column(1), min_length)) for k in keys]
                hashes = _hashes([k for k, _ in flat])
                hit = np.flatnonzero(_contains(bits, _bits(hashes, len(bits) * 8)))
                ids, found = part.column(0).to_pylist(), {}
                for j in hit:
                    key, i = flat[j]
                    n, first, h = found.get(key, (0, None, hashes[j]))
                    found[key] = n + 1, ids[i] if first is None else first if ids[i] is None else min(first, ids[i]), h
                made = list(found.values())
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array([v[2] for v in made], pa.uint64()).view(pa.int64()), pa.array([v[0] for v in made], pa.int64()), pa.array([v[1] for v in made], part.column(0).type)], ["key", "h", "n", "first"])

    return rows.mapInArrow(keys, f"key binary, h long, n long, first {kind}")


def range_suspects(docs: DataFrame, text_col: str, ranges: int, min_length: int = 1) -> DataFrame:
    """(h): hashes of keys that more than one document has, and a few others, found in ranges of hashes: each range takes
    its hashes one after the other and names those that its once-seen filter knows and its twice-seen one does not."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, 4 << 20):
                found, n = np.unique(_hashes([k for keys in _keys(part.column(0), min_length) for k in keys]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n > 1)], ["h", "again"])

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(RANGE_BITS // 8, np.uint8), np.zeros(RANGE_BITS // 8, np.uint8)
        for batch in batches:
            found, at, n = np.unique(batch.column(0).to_numpy().view(np.uint64), return_inverse=True, return_counts=True)
            again = (np.bincount(at, batch.column(1).to_numpy(zero_copy_only=False), len(found)) > 0) | (n > 1)
            bits = _bits(found, RANGE_BITS)
            new = (again | _contains(once, bits)) & ~_contains(twice, bits)
            _set(once, bits)
            _set(twice, bits[:, new])
            yield pa.RecordBatch.from_arrays([pa.array(found[new].view(np.int64))], ["h"])

    dealt = docs.select(F.col(text_col).cast("binary")).mapInArrow(hashes, "h long, again boolean").repartition(ranges, "h")
    return dealt.mapInArrow(seen, "h long").distinct()


def repeated_keys(docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_length: int = 1) -> DataFrame:
    """(key, h, n_docs, owner): the suspected keys that are exactly confirmed; owner is the smallest id that has the key."""
    wanted = max(MIN_FILTER_BITS, 8 * LINES_PER_DOCUMENT * docs.count())
    n_bits = 1 << (wanted - 1).bit_length()
    if n_bits <= MAX_FILTER_BITS:
        twice = twice_seen_filter(docs, text_col, n_bits, min_length)
    else:
        twice = suspects_filter(save(range_suspects(docs, text_col, -(-n_bits // RANGE_BITS), min_length), "line-suspects"), MAX_FILTER_BITS)
    rows = _by_key(docs, id_col, text_col, min_length, twice)
    return rows.groupBy("key").agg(F.first("h").alias("h"), F.sum("n").alias("n_docs"), F.min("first").alias("owner")).filter(F.col("n_docs") >= min_docs)


def _drop(text: bytes | None, owner_of: dict, doc_id, keep_first: bool) -> tuple[bytes, int, int]:
    lines, kept, seen = (text or b"").split(b"\n"), [], set()
    for line in lines:
        key = line_key(line)
        if key in owner_of:
            if not (keep_first and owner_of[key] == doc_id and key not in seen):
                continue
            seen.add(key)
        kept.append(line)
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _dropped(docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_length: int, keep_first: bool, broadcast_bytes: int) -> DataFrame:
    """(id, text, n_lines, n_dropped, row): row is the whole input row, without its text."""
    spark = docs.sparkSession
    keys = save(repeated_keys(docs, id_col, text_col, min_docs, min_length), "line-keys")
    size = keys.agg(F.coalesce(F.sum(F.octet_length("key") + 64), F.lit(0)).alias("b")).first()["b"]
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), F.struct(*others).alias("row"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, text binary, n_lines long, n_dropped long, row {rows.schema['row'].dataType.simpleString()}"

    def output(batch: pa.RecordBatch, found: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
        text, n, dropped = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.binary()), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), batch.column(2)], ["id", "text", "n_lines", "n_dropped", "row"])

    if size <= broadcast_bytes:
        owners = spark.sparkContext.broadcast({bytes(r["key"]): r["owner"] for r in keys.toLocalIterator()})

        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, 1, 4 << 20):
                    yield output(part, [_drop(t, owners.value, i, keep_first) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)])

        return rows.mapInArrow(drop, schema)
    return _drop_by_join(rows, keys, keep_first, schema, output)


def _drop_by_join(rows: DataFrame, keys: DataFrame, keep_first: bool, schema: str, output) -> DataFrame:
    """The way for key sets too large to send: confirmed keys are joined to each text's keys, then to the text."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, 4 << 20):
                flat = [(k, t) for t, keys in zip(part.column(1).to_pylist(), _keys(part.column(0), 1), strict=True) for k in keys]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in flat], pa.binary()), pa.array([t for _, t in flat], pa.string())], ["key", "tk"])

    tk = F.sha2(F.coalesce("text", F.lit(b"")), 256)
    per_text = rows.select("text", tk.alias("tk")).mapInArrow(lines, "key binary, tk string").distinct().join(keys, "key").groupBy("tk").agg(F.collect_list(F.struct("key", "owner")).alias("drop"))  # of one text

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)
            yield output(batch, [_drop(t, {x["key"]: x["owner"] for x in d or ()}, i, keep_first) for i, t, d in found])

    return rows.withColumn("tk", tk).join(per_text, "tk", "left").select("id", "text", "row", "drop").mapInArrow(drop, schema)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_length: int = 1, keep_first: bool = False, broadcast_bytes: int = BROADCAST_KEY_BYTES) -> DataFrame:
    """(id, text, n_lines, n_dropped): texts without the lines whose key is in at least min_docs documents.

    keep_first leaves the first such line of the document with the smallest id.
    """
    done = _dropped(docs, id_col, text_col, min_docs, min_length, keep_first, broadcast_bytes)
    return done.select(F.col("id").alias(id_col), F.col("text").cast("string").alias(text_col), "n_lines", "n_dropped")


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_length: int = 1, keep_first: bool = False) -> DataFrame:
    """The documents with all their columns, their texts without those lines (null texts are empty then)."""
    done = _dropped(docs, id_col, text_col, min_docs, min_length, keep_first, BROADCAST_KEY_BYTES)
    return done.select(*[F.col("text").cast("string").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
