"""Best-fit packing planned on the histogram of lengths.

Documents become token pieces of at most max_tokens. The plan is best-fit decreasing over counts: bins that have the same
free space are one entry, so planning costs depend on max_tokens and never on the number of pieces. Pieces then take the
planned slots by joining on their rank within their length; ranks of a frequent length are dealt out over salts.

Defined cases: null and empty texts give one piece of the end id alone; texts of any length are cut into pieces, read whole;
repeated rows and repeated, null or text ids are packed each; pieces of one length are alike, and which of them takes which of
its slots is not defined; columns of other names are not read; an empty table gives an empty plan.
"""

from __future__ import annotations

import bisect
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import save, slices, small, tidy

MAX_TOKENS = 2048
END_ID = 0
#: Rows that one task ranks.
RANKED_ROWS = 50_000
PLAN_ROWS = 200_000
#: Words that each of two generations remembers, and the characters of the longest.
CACHE_WORDS, CACHED_LENGTH = 60_000, 48
JOINED_WORDS, ENCODED_BYTES = 4096, 3 << 20
CLOSING = r"(\pL)([.,;:!?]+)([ \n]|$)"


class WordEncoder:
    """Ids of texts, as little-endian unsigned 32-bit bytes, from a vocabulary that drops white space and marks word ends.

    White space never reaches the ids, and no rule of the vocabulary looks across a space or line feed, so a text's ids are
    those of its parts between them. A part that ends in a letter before closing punctuation is two such parts, and ASCII
    letters are alike in either case, as the vocabulary lower-cases. Parts are remembered; new ones of letters alone are
    encoded many at a time and told apart by their word-end ids. Texts that may name a special token are encoded whole.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _each(self, parts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _encode(self, new: list[str]) -> dict[str, bytes]:
        others = [p for p in new if not p.isalpha()]
        words = [p for p in new if p.isalpha()]
        out = {}
        for at in range(0, len(others), JOINED_WORDS):
            some = others[at : at + JOINED_WORDS]
            out.update(zip(some, self._each(some), strict=True))
        for at in range(0, len(words), JOINED_WORDS):
            some = words[at : at + JOINED_WORDS]
            raw = self._each([" ".join(some)])[0]
            cut = ((np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1) * 4).tolist()
            if len(cut) == len(some):  # each is one word of the vocabulary's rule
                out.update(zip(some, (raw[a:b] for a, b in zip([0, *cut], cut, strict=False)), strict=True))
            else:
                out.update(zip(some, self._each(some), strict=True))
        return out

    def _parts(self, distinct: list[str]) -> list[bytes]:
        if len(self.parts) > CACHE_WORDS:
            self.older, self.parts = self.parts, {}
        found = list(map(self.parts.get, distinct))
        lacking = [i for i, v in enumerate(found) if v is None]
        made = dict(zip((distinct[i] for i in lacking), map(self.older.get, (distinct[i] for i in lacking)), strict=True))
        made.update(self._encode([p for p, v in made.items() if v is None]))
        for i in lacking:
            found[i] = made[distinct[i]]
        self.parts.update((p, v) for p, v in made.items() if len(p) <= CACHED_LENGTH)
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text; null counts as empty."""
        texts = texts.fill_null("")
        special = pc.match_substring(texts, "<|")
        plain = pc.ascii_lower(pc.if_else(special, "", texts))  # each step's texts are freed by the next
        plain = pc.replace_substring_regex(plain, CLOSING, r"\1 \2\3")
        plain = pc.replace_substring(plain, "\n", " ")
        plain = pc.split_pattern(plain, " ")
        first = plain.offsets.to_numpy() - plain.offsets[0].as_py()
        coded = plain.flatten().dictionary_encode()
        del plain
        values = self._parts(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, values), np.int32, len(values)) // 4
        ids, start = np.frombuffer(b"".join(values), "<u4"), np.cumsum(size, dtype=np.int32) - size
        code = coded.indices.to_numpy()
        del coded, values
        n = size[code]
        ends = np.concatenate(([0], np.cumsum(n, dtype=np.int64)))
        place = np.repeat(start[code] - ends[:-1].astype(np.int32), n)  # an Arrow text, and so its ids, are fewer than 2^31
        place += np.arange(ends[-1], dtype=np.int32)
        raw = ids[place].tobytes()
        del place, n, code
        at = (ends[first] * 4).tolist()
        out = [raw[a:b] for a, b in zip(at, at[1:], strict=False)]
        for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self._each([texts[i].as_py()])[0]
        return out


#: One encoder for each vocabulary in a Python worker, which Spark uses for one task after another.
_ENCODERS: dict[str, WordEncoder] = {}


def token_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(doc_id, piece, start, length, ids): ids are little-endian unsigned 32-bit, the document's last one is END_ID."""

    @tidy
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _ENCODERS:
            _ENCODERS[vocabulary] = WordEncoder(vocabulary)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for part in slices(batch, 1, ENCODED_BYTES):
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), _ENCODERS[vocabulary].encode(part.column(1)), strict=True):
                    whole = ids + end
                    for piece, start in enumerate(range(0, len(whole), 4 * max_tokens)):
                        cut = whole[start : start + 4 * max_tokens]
                        rows.append((doc_id, piece, start // 4, len(cut) // 4, cut))
                kinds = (part.column(0).type, pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string"))
    return rows.mapInArrow(encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids binary")


def best_fit_plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, rank_from, rank_to, first_bin, per_bin, offset): pieces of that length with a rank in [from, to) fill bins
    first_bin, first_bin + 1, ... with per_bin of them each, from offset on.

    This is best-fit decreasing: each length goes to the bins with least space that still hold it.
    """
    open_bins: dict[int, list[tuple[int, int]]] = {}  # free space -> (first bin, number)
    spaces: list[int] = []
    plan, made = [], 0

    def put(space: int, first: int, n: int) -> None:
        if n and space:
            if space not in open_bins:
                bisect.insort(spaces, space)
                open_bins[space] = []
            open_bins[space].append((first, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            k = bisect.bisect_left(spaces, length)
            if k < len(spaces):
                space = spaces[k]
                first, n = open_bins[space].pop()
                if not open_bins[space]:
                    del open_bins[space], spaces[k]
            else:
                space, first = capacity, made
                n = -(-left // (capacity // length))
                made += n
            each = space // length
            full = min(n, left // each)
            if full:
                plan.append((length, rank, rank + full * each, first, each, capacity - space))
                put(space - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n and left:  # fewer than fill one bin
                plan.append((length, rank, rank + left, first + full, left, capacity - space))
                put(space - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(space, first + full, n - full)
    return plan


def pack(pieces: DataFrame, length_col: str = "length", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """pieces with sequence_id and offset. Every row gets a place of its own; sequences are gapless from 0."""
    spark = pieces.sparkSession
    rows = save(pieces.select(F.col(length_col).alias("_len"), F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_piece")), "pack-pieces")
    histogram = {r["_len"]: r["n"] for r in rows.groupBy("_len").agg(F.count("*").alias("n")).collect()}  # max_tokens rows at most
    plan = best_fit_plan(histogram, max_tokens)
    salts = spark.createDataFrame([(k, -(-n // RANKED_ROWS)) for k, n in histogram.items()], "_len long, _salts int")
    salted = rows.join(F.broadcast(salts), "_len").withColumn("_salt", F.pmod(F.xxhash64("_row"), F.col("_salts")))
    by_length = Window.partitionBy("_len").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = salted.groupBy("_len", "_salt").agg(F.count("*").alias("n")).select("_len", "_salt", F.coalesce(F.sum("n").over(by_length), F.lit(0)).alias("_before"))
    ranked = salted.withColumn("_rank", F.row_number().over(Window.partitionBy("_len", "_salt").orderBy("_row")) - 1)
    ranked = ranked.join(before, ["_len", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    slots = spark.createDataFrame(plan, "_plan_len long, _from long, _to long, _bin long, _each long, _offset long")
    fits = (F.col("_len") == F.col("_plan_len")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    placed = ranked.join(small(slots, len(plan), PLAN_ROWS), fits)
    nth = F.col("_rank") - F.col("_from")
    return placed.select("_piece.*", (F.col("_bin") + F.floor(nth / F.col("_each"))).alias("sequence_id"), (F.col("_offset") + F.pmod(nth, F.col("_each")) * F.col("_len")).alias("offset"))


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece."""
    pieces = token_pieces(docs, vocabulary, id_col, text_col, max_tokens)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), max_tokens=max_tokens)
