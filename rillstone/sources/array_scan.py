"""JSON array documents read by many tasks: a file is cut at closing braces, wherever they stand, and put together again.

Spark's text reader divides a file at any separator, so a "}" as the separator makes every array of objects splittable. What a
cut means depends on what stands before it: inside a string or not, and how deep. Two scans settle that without reading a file
in one task:

1. Each block of a file tells, for both possible starts (outside and inside a string), where it would end, by how much it
   would go deeper, and how many commas it has at each relative depth. (A cut follows a "}", so it is never after a backslash.)
   The blocks' answers, one row each, are composed in file order: every block's true start.
2. Each block is scanned again from its true start. Elements that begin and end inside it are whole; the pieces before its first
   and after its last top-level comma are fragments, two for a block, which are joined by element.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.sources.scratch import written

#: Up to so many blocks' starts go to every executor; beyond it they are joined by shuffle.
BROADCAST_BLOCKS = 100_000
#: A string outside which the scan stands, a structural character, or a quote that opens a string with no end here.
TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[\[\]{},"]', re.S)
REST_OF_STRING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*"', re.S)
STEP = {"[": 1, "{": 1, "]": -1, "}": -1}


def tokens(text: str, in_string: bool) -> Iterator[tuple[int, str]]:
    """(offset, character) of brackets and commas outside strings; '"' last where a string is still open at the end."""
    at = 0
    if in_string:
        closed = REST_OF_STRING.match(text)
        if not closed:
            yield len(text), '"'
            return
        at = closed.end()
    for found in TOKEN.finditer(text, at):
        if found[0] == '"':
            yield found.start(), '"'
            return
        if found[0][0] != '"':
            yield found.start(), found[0]


class Effect:
    """What a block does from one start: whether it ends in a string, its change of depth, its commas by relative depth."""

    def __init__(self, in_string: bool) -> None:
        self.in_string, self.depth, self.commas = in_string, 0, Counter()

    def add(self, text: str) -> None:
        started, self.in_string = self.in_string, False
        for _, c in tokens(text, started):
            if c == ",":
                self.commas[self.depth] += 1
            elif c == '"':
                self.in_string = True
            else:
                self.depth += STEP[c]

    def row(self) -> dict:
        return {"in_string": self.in_string, "depth": self.depth, "commas": list(self.commas.items())}


_EFFECT = "struct<in_string: boolean, depth: int, commas: map<int, long>>"
_EFFECT_TYPE = pa.struct([("in_string", pa.bool_()), ("depth", pa.int32()), ("commas", pa.map_(pa.int32(), pa.int64()))])


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): text between closing braces; the rows of a block stand in the order of its file."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _by_block(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    start, files, blocks = 0, batch.column(0).to_pylist(), batch.column(1).to_pylist()
    for end in range(1, len(batch) + 1):
        if end == len(batch) or (files[end], blocks[end]) != (files[start], blocks[start]):
            yield (files[start], blocks[start]), batch.slice(start, end - start)
            start = end


def block_effects(parts: DataFrame) -> DataFrame:
    """(file, block, first, outside, inside): a row for each block; first: its first character that is no white space."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, outside, inside = None, None, None, None
        names = ["file", "block", "first", "outside", "inside"]

        def made() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.string(), _EFFECT_TYPE, _EFFECT_TYPE]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*key, first, outside.row(), inside.row()), kinds, strict=True)], names)

        for batch in batches:
            for block, part in _by_block(batch):
                if block != key:
                    if key is not None:
                        yield made()
                    key, first, outside, inside = block, None, Effect(False), Effect(True)
                text = "}".join(part.column(2).to_pylist()) + "}"
                first = first or (text.lstrip("\ufeff \t\r\n") or " ")[0].strip() or None
                outside.add(text)
                inside.add(text)
        if key is not None:
            yield made()

    return parts.mapInArrow(scan, f"file string, block long, first string, outside {_EFFECT}, inside {_EFFECT}")


def block_starts(effects: DataFrame) -> DataFrame:
    """(file, block, is_array, in_string, depth, position): the state in which each block starts, composed in file order."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, is_array, in_string, depth, position = None, False, False, 0, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["file"] != file:
                    file, is_array, in_string, depth, position = row["file"], row["first"] == "[", False, 0, 0
                out.append((file, row["block"], is_array, in_string, depth, position))
                effect = row["inside" if in_string else "outside"]
                position += dict(effect["commas"]).get(1 - depth, 0)
                in_string, depth = effect["in_string"], depth + effect["depth"]
            if out:
                kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["file", "block", "is_array", "in_string", "depth", "position"])

    ordered = effects.repartition("file").sortWithinPartitions("file", "block")
    return ordered.mapInArrow(compose, "file string, block long, is_array boolean, in_string boolean, depth int, position long")


def _cut(parts: DataFrame) -> DataFrame:
    """(file, position, block, whole, text) of elements and fragments. parts (file, block, value, in_string, depth, position)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, in_string, depth, position, held, whole = None, False, 0, 0, [], False
        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["file", "position", "block", "whole", "text"])
            out.clear()
            return made

        for batch in batches:
            for block, part in _by_block(batch):
                if block != key:
                    if key is not None:
                        out.append((key[0], position, key[1], False, "".join(held)))
                    key, held, whole = block, [], False
                    in_string, depth, position = (part.column(i)[0].as_py() for i in (3, 4, 5))
                text, at, started = "}".join(part.column(2).to_pylist()) + "}", 0, in_string
                in_string = False
                for offset, c in tokens(text, started):
                    if c == '"':
                        in_string = True
                    elif c == "," and depth == 1:
                        out.append((key[0], position, key[1], whole, "".join(held) + text[at:offset]))
                        position, at, held, whole = position + 1, offset + 1, [], True
                    elif c != ",":
                        depth += STEP[c]
                        if depth == 1 and c == "[" and position == 0:
                            at, held, whole = offset + 1, [], True  # what stands before the array is no element
                        elif depth == 0 and c == "]":
                            out.append((key[0], position, key[1], whole, "".join(held) + text[at:offset]))
                            position, at, held, whole, depth = position + 1, len(text), [], False, -(1 << 30)
                            in_string = False
                            break
                held.append(text[at:] if depth >= 0 else "")
                if len(out) >= 1000:
                    yield flushed()
            if out:
                yield flushed()
        if key is not None:
            out.append((key[0], position, key[1], False, "".join(held)))
            yield flushed()

    return parts.mapInArrow(scan, "file string, position long, block long, whole boolean, text string")


def array_elements(spark: SparkSession, path: str, strict: bool = True, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """(file_path, position, element): the objects of JSON array documents as text, with their place in their array; other
    elements count but are left out. Documents that are no array are an error, or where not strict have no rows. What
    follows an array's end is not read; of a document that breaks off, the elements before the break are."""
    parts = pieces(spark, path)
    starts = written(block_starts(block_effects(parts)))
    if strict:
        bad = starts.filter(~F.col("is_array")).select("file").first()
        if bad:
            raise ValueError(f"not a JSON array: {bad['file']}")
    begun = starts.filter("is_array").select("file", "block", "in_string", "depth", F.col("position").alias("number"))
    if starts.count() <= broadcast_blocks:
        placed = parts.join(F.broadcast(begun), ["file", "block"])
    else:
        ordered = parts.withColumn("_at", F.monotonically_increasing_id()).join(begun, ["file", "block"])
        placed = ordered.repartition("file", "block").sortWithinPartitions("file", "block", "_at")
    cut = _cut(placed.select("file", "block", "value", "in_string", "depth", "number"))
    fragments = cut.filter(~F.col("whole")).groupBy("file", "position").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("f"))
    joined = fragments.select("file", "position", F.array_join(F.transform("f", lambda x: x["text"]), "").alias("text"))
    every = cut.filter("whole").select("file", "position", "text").unionByName(joined)
    return every.select(F.col("file").alias("file_path"), F.col("position").cast("int").alias("position"), F.regexp_replace("text", r"^\s+|\s+$", "").alias("element")).filter(F.col("element").startswith("{"))
