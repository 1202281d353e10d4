"""Periodic runs of words, by longest common extensions over a difference cover.

A run of period q and length at least three times that holds an anchor of the harmonic grid of q: two words q apart that are
equal, and agree as far as the run goes. So for each q only every 2q-th word (a wider step for small q) is compared with
the word q further on. Where they are equal, their common extensions to both sides give the run. An extension compares the
few words up to the next place where both positions are in a difference cover modulo 31; only suffixes at cover positions
are sorted, and a sparse table of minima over their common prefixes tells the rest. Texts are handled whole, some at a
time: each is ended by a word of its own, so that no extension leaves its text, and only those that still have an equal
pair after a few words are sorted.

Defined cases: null and empty texts, and texts of white space, have no words and no runs; texts may have any length;
of runs with the same stretch the smallest period counts; rows with equal texts have equal results; null, repeated and
text ids stay as they are; an empty table gives an empty result; columns of other names are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import slices, tidy

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: A perfect difference cover: any two positions meet within 30 words at positions that are both in it.
MODULUS, COVER = 31, [0, 1, 3, 8, 12, 18]
#: Words that are told apart before anything is sorted.
FEW = 8
PART_BYTES = 1 << 19


class Codes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = code = len(self) + 1
        return code


def _meeting() -> np.ndarray:
    """steps[a, b]: words from positions of residues a and b to where both are in the cover."""
    steps = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    for step in reversed(range(MODULUS)):
        inside = np.isin((np.arange(MODULUS) + step) % MODULUS, COVER)
        steps[np.ix_(inside, inside)] = step
    return steps


MEETING = _meeting()


class Extensions:
    """Longest common extensions to the right within an array of word codes whose texts end in words of their own."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes, n = np.concatenate([codes, -np.arange(1, MODULUS + 1, dtype=codes.dtype) - codes.size]), len(codes)
        places = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        self.at = np.full(n + MODULUS, -1, np.int64)
        self.at[places] = np.arange(len(places))
        blocks = np.ascontiguousarray(self.codes[places[:, None] + np.arange(MODULUS)].astype(np.int32))
        ranks = np.unique(blocks.view(np.dtype((np.void, 4 * MODULUS))).ravel(), return_inverse=True)[1].ravel()
        # Prefix doubling from cover position to cover position: a block further on is a cover position too.
        levels, span = [ranks], MODULUS
        while len(places) and ranks.max() + 1 < len(places):
            further = places + span
            next_rank = np.where(further < n, ranks[self.at[np.minimum(further, n - 1)]] + 1, 0)
            ranks = np.unique(ranks * (len(places) + 1) + next_rank, return_inverse=True)[1].ravel()
            levels.append(ranks)
            span *= 2
        self.rank = ranks
        order = np.argsort(ranks, kind="stable")
        a, b, common = places[order[:-1]].copy(), places[order[1:]].copy(), np.zeros(max(0, len(places) - 1), np.int64)
        for level in reversed(range(len(levels))):
            fits = (a < n) & (b < n)
            same = np.zeros(len(a), bool)
            same[fits] = levels[level][self.at[a[fits]]] == levels[level][self.at[b[fits]]]
            step = np.where(same, MODULUS << level, 0)
            a, b, common = a + step, b + step, common + step
        common += self._compared(a, b, np.full(len(a), MODULUS))
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            width, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words are equal from i and j on, most at most, one word after the other for all pairs still equal."""
        found, going, end = np.zeros(len(i), np.int64), np.flatnonzero(most > 0), len(self.codes) - 1
        while len(going):
            at = found[going]
            equal = self.codes[np.minimum(i[going] + at, end)] == self.codes[np.minimum(j[going] + at, end)]
            going = going[equal]
            found[going] += 1
            going = going[found[going] < most[going]]
        return found

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        step = MEETING[i % MODULUS, j % MODULUS]
        found = self._compared(i, j, step)
        met = np.flatnonzero(found == step)
        if len(met):
            a, b = i[met] + step[met], j[met] + step[met]
            inside = np.maximum(a, b) < len(self.at) - MODULUS
            met, a, b = met[inside], self.rank[self.at[a[inside]]], self.rank[self.at[b[inside]]]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp(np.maximum(high - low, 1))[1] - 1
            least = np.zeros(len(met), np.int64)
            for k in np.unique(level):
                own = level == k
                least[own] = np.minimum(self.table[k][low[own]], self.table[k][high[own] - (1 << k)])
            found[met] += least
        return found


def _anchors(starts: np.ndarray, sizes: np.ndarray, min_length: int, min_periods: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of the harmonic grids of all texts."""
    most = np.where(sizes >= min_length, sizes // min_periods, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(min_length - period, (min_periods - 1) * period)
    n = (sizes[text] - period - 1) // step + 1
    which = np.repeat(np.arange(len(text)), n)
    turn = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return starts[text][which] + turn * step[which], period[which]


def runs_of(texts: list[np.ndarray], min_length: int = 24, min_periods: int = 3) -> list[list[tuple[int, int, int]]]:
    """For each text, given as positive word codes, its runs (start, length, period), by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.concatenate([x for k, t in enumerate(texts) for x in (t, [-k - 1])]).astype(np.int64) if texts else np.empty(0, np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    at, period = _anchors(starts, sizes, min_length, min_periods)
    live = np.flatnonzero(codes[at] == codes[at + period])
    at, period = at[live], period[live]
    # A run reaches min_length - period words at least past its anchors' pairs: FEW of them, in all, are looked at first.
    right, left = np.ones(len(at), np.int64), np.zeros(len(at), np.int64)
    for _ in range(FEW):
        right += (codes[np.minimum(at + right + period, len(codes) - 1)] == codes[np.minimum(at + right, len(codes) - 1)]) & (at + right + period < len(codes))
        left += (at - left > 0) & (codes[np.maximum(at - left - 1, 0)] == codes[np.maximum(at - left - 1, 0) + period])
    live = np.flatnonzero((right > FEW) | (left >= FEW) | (right + left + period >= np.maximum(min_length, min_periods * period)))
    at, period = at[live], period[live]
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(at):
        return found
    text = np.searchsorted(starts, at, "right") - 1
    own = np.unique(text)
    moved, size = np.zeros(len(texts), np.int64), sizes[own] + 1
    moved[own] = starts[own] - (np.cumsum(size) - size)
    kept = np.concatenate([codes[starts[k] : starts[k] + sizes[k] + 1] for k in own])
    at, n = at - moved[text], len(kept)
    forward, backward = Extensions(kept), Extensions(np.concatenate([kept[:-1][::-1], kept[-1:]]))
    right = forward(at, at + period)
    left = backward(n - 1 - at, n - 1 - at - period)
    start, length = at - left, left + right + period
    good = np.flatnonzero(length >= np.maximum(min_length, min_periods * period))
    rows = np.stack([text[good], start[good] + moved[text[good]] - starts[text[good]], length[good], period[good]], axis=1)
    rows = rows[np.lexsort(rows.T[::-1])]
    least = np.ones(len(rows), bool)
    least[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)  # the smallest period of a stretch
    rows = rows[least]
    for k, s, size, q in rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))].tolist():
        found[k].append((s, size, q))
    return found


def _summary(words: list[str], runs: list[tuple[int, int, int]]) -> tuple:
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [w for w, n in zip(words, np.cumsum(change), strict=False) if n == 0]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(listed.encode()).hexdigest(), " ".join(words))


def collapsed_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_length: int = 24, min_periods: int = 3) -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, text) for each row: how many runs its text has, the run
    of greatest exponent (ties: smallest start, then period), all runs' digest, and the text whose runs keep their first
    period only, words joined by one space."""
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").cast("binary").alias("_text"))
    names = [id_col, "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "text"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, PART_BYTES):
                codes = Codes()
                words = [WORDS.findall((t or b"").decode("utf-8", "replace")) for t in part.column(1).to_pylist()]
                coded = [np.fromiter(map(codes.__getitem__, w), np.int64, len(w)) for w in words]
                out = [_summary(w, r) for w, r in zip(words, runs_of(coded, min_length, min_periods), strict=True)]
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.int64()) for c in columns[:5]], *[pa.array(c, pa.string()) for c in columns[5:]]], names)

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(tidy(find), f"`{id_col}` {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, text string")
