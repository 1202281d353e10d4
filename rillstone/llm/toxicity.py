"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes.

Every word of a text counts: words are hashed to TERMS dimensions, and a dimension's idf is counted over the whole corpus.
Examples are a documented bounded sample of labelled texts (MAX_EXAMPLES of them, MAX_EXAMPLE_BYTES of text). A dimension's
weight is log tf times idf times a relevance, LEAST_RELEVANCE for all of them and up to 1 more for those that go with label 1
beyond what chance explains; no dimension is left out. (Without a relevance neighbours follow a text's subject: see the README
for the figures of both.) The index has postings per term, in blocks of BLOCK examples, and each
term's largest weight in every block; terms that many examples have are kept as whole rows and added up at once. A query's
bound of a block is the largest such sum in it and the maxima of the other terms. The blocks with the largest bounds are
scored, and then all whose bound reaches the K-th best cosine so far, so its neighbours are exact. Votes are weighted by
1 / (distance + SMOOTH), and a monotone map from out-of-fold votes to label frequency calibrates them.

Defined cases: null and empty texts have no neighbour and take the label rate of the examples; ties at the K-th place all
vote, so ids never decide; equal example texts are one example with the larger label; of the rows that share a labelled id
one text is an example; null ids and null labels are no labels; rows with a null id, repeated rows and rows without a label
are scored like any other; texts are read whole, of any length; other columns, of any name, stay in row; without any usable
label every score is 0; ids may be of any type, the evidence names them as text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import WordHasher, bounded_sample, save, slices, tidy

TERMS = 1 << 20
MAX_EXAMPLES, MAX_EXAMPLE_BYTES = 3_000, 8 << 20
K, BLOCK, SMOOTH = 15, 64, 0.05
#: Blocks scored before the others are ruled out.
FIRST_BLOCKS = 2
#: A term that one example in so many has is a row of the index. Cosines are of single precision; TIE is what that may cost.
ROW_SHARE, TIE = 24, 1e-6
#: Queries whose sums over rows are one product of matrices.
TOGETHER = 64
LEAST_RELEVANCE, HALF_RELEVANCE = 0.1, 200.0
EVIDENCE = 3

Vector = tuple[np.ndarray, np.ndarray]


def term_counts(words: np.ndarray) -> Vector:
    """Dimensions in order, and how often each occurs, of the hashes of a text's words."""
    return np.unique((words & np.uint64(TERMS - 1)).astype(np.int32), return_counts=True)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of all documents each dimension is, and how many documents there are."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = WordHasher(), np.zeros(TERMS, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                found = [term_counts(hasher.words(t))[0] for t in part.column(0).to_pylist()]
                total += np.bincount(np.concatenate(found), minlength=TERMS)
        here = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(here.astype(np.int32)), pa.array(total[here])], ["term", "n"])

    # A row for each dimension that a split has: a few hundredths of the split, and a lost task repeats its split alone.
    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(count, "term int, n long")
    got = rows.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # TERMS rows at most
    counts = np.zeros(TERMS, np.int64)
    counts[got["term"].to_numpy()] = got["n"].to_numpy()
    return counts, docs.count()


def _expand(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [low, high), one range after the other."""
    n = high - low
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())


def relevance(terms: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Of every dimension: LEAST_RELEVANCE, and up to 1 more as the root of the likelihood ratio of its going with label 1
    exceeds what the largest of so many independent ones reaches by chance."""
    with_one = np.bincount(np.concatenate([t for t, y in zip(terms, labels, strict=True) if y] or [np.empty(0, int)]), minlength=TERMS).astype(float)
    having = np.bincount(np.concatenate(terms or [np.empty(0, int)]), minlength=TERMS).astype(float)
    at = np.flatnonzero(having)
    a, n, ones, size = with_one[at], having[at], float(labels.sum()), len(labels)
    table = np.stack([a, n - a, ones - a, size - ones - n + a])
    expected = np.stack([n * ones, n * (size - ones), (size - n) * ones, (size - n) * (size - ones)]) / max(size, 1)
    ratio = 2 * np.where(table > 0, table * np.log(np.maximum(table, 1) / np.maximum(expected, 1e-12)), 0).sum(axis=0)
    beyond = np.where(a * (size - ones) > (n - a) * ones, np.maximum(0, ratio - 2 * np.log(max(len(at), 2))), 0)
    out = np.full(TERMS, LEAST_RELEVANCE)
    out[at] += np.sqrt(beyond / (beyond + HALF_RELEVANCE))
    return out


class BlockMaxIndex:
    """Cosine search over examples, given as term counts, labels and ids; weight: of every dimension."""

    def __init__(self, weight: np.ndarray, examples: list[Vector], labels: np.ndarray, ids: list[str | None]):
        self.weight = weight.astype(np.float32)
        vectors = [self.vector(*e) for e in examples]
        # Examples with the same weightiest terms stand together, so that block maxima are sharp.
        strongest = [tuple(t[np.argsort(-w, kind="stable")[:2]].tolist()) for t, w in vectors]
        order = sorted((i for i, v in enumerate(vectors) if len(v[0])), key=lambda i: (strongest[i], vectors[i][1].tolist(), vectors[i][0].tolist(), labels[i]))
        self.ids, self.labels = [ids[i] for i in order], labels[order].astype(float)
        self.blocks = -(-len(order) // BLOCK)
        sizes = [len(vectors[i][0]) for i in order]
        term = np.concatenate([vectors[i][0] for i in order] or [np.empty(0, np.int32)])
        at, w = np.repeat(np.arange(len(order), dtype=np.int32), sizes), np.concatenate([vectors[i][1] for i in order] or [np.empty(0, np.float32)])
        del vectors
        sort = np.lexsort((at, term))
        term, at, w = term[sort], at[sort], w[sort]
        known, start, n = np.unique(term, return_index=True, return_counts=True)
        often = n * ROW_SHARE > len(order)
        # Of every dimension: its row, or -2 minus its place among those that have postings; -1 for neither.
        self.place = np.full(TERMS, -1, np.int32)
        self.place[known[often]] = np.arange(often.sum())
        self.rows = np.zeros((int(often.sum()), self.blocks * BLOCK), np.float32)
        p = _expand(start[often], start[often] + n[often])
        self.rows[np.repeat(np.arange(often.sum()), n[often]), at[p]] = w[p]
        p = _expand(start[~often], start[~often] + n[~often])
        term, self.at, self.w = term[p], at[p], w[p]
        # An entry is a term in a block: its range of postings, its block, its largest weight.
        block = self.at // BLOCK
        new = np.concatenate(([True], (np.diff(term) != 0) | (np.diff(block) != 0))) if len(term) else np.empty(0, bool)
        starts = np.flatnonzero(new)
        self.post = np.concatenate((starts, [len(term)])).astype(np.int32)
        self.block = block[starts]
        self.most = np.maximum.reduceat(self.w, starts) if len(starts) else np.empty(0, np.float32)
        known, first = np.unique(term[starts], return_index=True)
        self.entry = np.concatenate((first, [len(starts)]))
        self.place[known] = -2 - np.arange(len(known))

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> Vector:
        """Dimensions and weights of length 1."""
        w = (1 + np.log(counts)) * self.weight[terms]
        return terms, (w / np.sqrt((w * w).sum()) if len(w) else w).astype(np.float32)

    def row_sums(self, vectors: list[Vector]) -> np.ndarray:
        """For each query the sums over the terms that are rows, for every example."""
        wanted = np.zeros((len(vectors), len(self.rows)), np.float32)
        for k, (terms, weights) in enumerate(vectors):
            row = self.place[terms]
            wanted[k, row[row >= 0]] = weights[row >= 0]
        return wanted @ self.rows

    def nearest_of(self, queries: list[Vector], k: int = K) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """nearest() of each query, given as term counts."""
        for at in range(0, len(queries), TOGETHER):
            vectors = [self.vector(*q) for q in queries[at : at + TOGETHER]]
            for (terms, weights), sums in zip(vectors, self.row_sums(vectors), strict=True):
                yield self.nearest(terms, weights, sums, k)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, sums: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples, and of all that tie with the last, nearest first."""
        n, score = len(self.labels), sums.astype(np.float64)
        place = -2 - self.place[terms]
        weights = weights[place >= 0]
        place = place[place >= 0]
        low, high = self.entry[place], self.entry[place + 1]
        entry, weight = _expand(low, high), np.repeat(weights, high - low)
        of = self.block[entry]
        bound = score.reshape(-1, BLOCK).max(axis=1, initial=0) + np.bincount(of, weight * self.most[entry], self.blocks)

        def add(wanted: np.ndarray) -> None:
            here = wanted[of]
            e = entry[here]
            low, high = self.post[e], self.post[e + 1]
            p = _expand(low, high)
            score[:] += np.bincount(self.at[p], np.repeat(weight[here], high - low) * self.w[p], len(score))

        first = np.zeros(self.blocks, bool)
        first[np.argsort(-bound, kind="stable")[:FIRST_BLOCKS]] = True
        add(first)
        least = np.partition(score[:n], -k)[-k] if n >= k else 0.0
        add(~first & (bound >= least - TIE))
        hit = np.flatnonzero(score > 0)
        if len(hit) > k:
            hit = hit[score[hit] >= np.partition(score[hit], -k)[-k] - TIE]
        hit = hit[np.lexsort((hit, -score[hit]))]
        return hit, score[hit]

    def vote(self, at: np.ndarray, cosine: np.ndarray) -> float:
        """Distance-weighted share of label 1, or the share among all examples where there is no neighbour."""
        if not len(at):
            return float(self.labels.sum() / (len(self.labels) + 1))
        w = 1 / (np.maximum(0, 1 - cosine) + SMOOTH)
        return float((w * self.labels[at]).sum() / w.sum())


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing steps (vote, frequency) by pooling adjacent violators, each smoothed by half an example of either label."""
    order = np.argsort(votes, kind="stable")
    blocks: list[list[float]] = []  # first vote, last vote, ones, number
    for v, y in zip(votes[order].tolist(), labels[order].tolist(), strict=True):
        if blocks and blocks[-1][1] == v:
            blocks[-1][2] += y
            blocks[-1][3] += 1
        else:
            blocks.append([v, v, y, 1])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, last, ones, n = blocks.pop()
            blocks[-1][1], blocks[-1][2], blocks[-1][3] = last, blocks[-1][2] + ones, blocks[-1][3] + n
    x = [b[k] for b in blocks for k in (0, 1)]
    y = [(b[2] + 0.5) / (b[3] + 1) for b in blocks for _ in (0, 1)]
    return np.array(x), np.maximum.accumulate(np.array(y))


class Model:
    """What a task needs to score texts: the index, of a documented bound, and the calibration."""

    def __init__(self, idf: np.ndarray, examples: list[Vector], labels: np.ndarray, ids: list[str | None]):
        make = lambda of: BlockMaxIndex(idf * relevance([examples[i][0] for i in of], labels[of]), [examples[i] for i in of], labels[of], [ids[i] for i in of])
        everyone = np.arange(len(examples))
        votes = np.zeros(len(examples))
        for half in (0, 1):  # an example's own label takes no part in its vote
            other = make(everyone[everyone % 2 != half])
            mine = everyone[everyone % 2 == half]
            votes[mine] = [other.vote(*found) for found in other.nearest_of([examples[i] for i in mine])]
            del other
        self.index = make(everyone)
        self.map = isotonic(votes, labels) if len(examples) else (np.zeros(1), np.zeros(1))

    def scores(self, queries: list[Vector]) -> tuple[np.ndarray, list[list[dict]]]:
        """Scores and evidence of texts, given as term counts: the nearest examples' ids, labels and cosines."""
        ix, votes, evidence = self.index, [], []
        for at, cosine in ix.nearest_of(queries):
            votes.append(ix.vote(at, cosine))
            evidence.append([{"example": ix.ids[i], "label": y, "cosine": c} for i, y, c in zip(at[:EVIDENCE].tolist(), ix.labels[at[:EVIDENCE]].astype(int).tolist(), cosine[:EVIDENCE].round(6).tolist(), strict=True)])
        return np.interp(votes, *self.map), evidence


def examples_of(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, most: int, most_bytes: int) -> DataFrame:
    """(id, text, label): at most most distinct labelled texts of at most most_bytes bytes together, in order of a hash."""
    usable = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = usable.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    known = save(bounded_sample(known, "id", most), "labels")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(known), "id")  # most rows
    one = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    distinct = save(one.groupBy("text").agg(F.max("label").alias("label"), F.min("id").alias("id")), "examples")  # most rows
    order = Window.orderBy(F.xxhash64("text"), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = distinct.select("id", F.sum(F.octet_length("text")).over(order).alias("bytes")).filter(F.col("bytes") <= most_bytes)
    return distinct.join(F.broadcast(fits.select("id")), "id", "left_semi")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_examples: int = MAX_EXAMPLES, max_bytes: int = MAX_EXAMPLE_BYTES) -> Model:
    """Learn from the rows of labels (id, label); idf is counted over all of docs."""
    examples = examples_of(docs, labels, id_col, text_col, label_col, max_examples, max_bytes)
    counts, n = document_frequencies(docs, text_col)
    idf = np.log((n + 1) / (counts + 0.5)).clip(0.001)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            found = [term_counts(hasher.words(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *(pa.array([f[i].astype("<i4").tobytes() for f in found], pa.binary()) for i in (0, 1))], ["id", "label", "terms", "counts"])

    rows = examples.select(F.col("id").cast("string"), "text", F.col("label").cast("int")).mapInArrow(vectors, "id string, label int, terms binary, counts binary").collect()  # max_bytes bytes of text
    rows.sort(key=lambda r: (bytes(r["terms"])[::-1], bytes(r["counts"])))
    return Model(idf, [(np.frombuffer(r["terms"], "<i4"), np.frombuffer(r["counts"], "<i4")) for r in rows], np.array([r["label"] for r in rows], int), [r["id"] for r in rows])


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """(row, text, score, evidence) of (row, text)."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("example", pa.string()), ("label", pa.int32()), ("cosine", pa.float64())]))
        hasher = WordHasher()
        for batch in batches:
            for part in slices(batch, 1):
                scores, evidence = sent.value.scores([term_counts(hasher.words(t)) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64()), pa.array(evidence, kind)], ["row", "text", "score", "evidence"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string, score double, evidence array<struct<example: string, label: int, cosine: double>>")


def score_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, score, evidence): row is the whole input row, its text as a string; evidence an array of the nearest examples
    (id, label, cosine)."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    done = _scored(docs.select(F.struct(*others).alias("row"), F.col(text_col).cast("string").alias("text")), model)
    return done.select(F.struct(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]).alias("row"), "score", "evidence")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, evidence)."""
    done = _scored(docs.select(F.col(id_col).alias("row"), F.col(text_col).cast("string").alias("text")), model)
    return done.select(F.col("row").alias(id_col), "score", "evidence")
