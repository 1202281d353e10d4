"""Exact top-k by inner product: a KD-tree for each shard, searched best-first by box bounds.

Vectors are scaled and floored to integers, so scores are exact. A bounded sample gives the median splits of a top tree, whose
cells are the shards; a cell of more rows than a shard may hold (one vector that very many rows share) is dealt to several.
Each shard builds its KD-tree: median splits along the widest side, a tight box for each node. First each query searches its
home shard. Its kth score there goes with it to the other shards, and only to those whose box may hold a better one; within a
shard nodes are visited best bound first, until none can reach the kth score. Rows of a shard stream into its task, then
its queries: a task holds one shard and one batch of queries, never all of either.

Defined cases: vectors that are null, or hold null, NaN or infinite components, take no part; empty vectors do (score 0).
Only vectors of one length are compared. A row is never its own result, but a repeated row is one of the other's. Ties go to
the smaller id, null last. Fewer than k candidates: all. Queries with a null condition are none. Components are floored
within a long's range, and scores beyond it count as its ends. Ids may be of any type that has an order; columns other than
the id and the vector are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import bounded_sample, save, small

#: Rows of a leaf; rows of a shard at most, fewer where vectors are long.
LEAF, SHARD_ROWS, SHARD_BYTES = 256, 4096, 32 << 20
#: The sample that the top tree is fitted on, and its cells at most.
SAMPLE_ROWS, SAMPLE_BYTES, MOST_CELLS = 16_384, 8 << 20, 1024
#: Shard boxes up to so many bytes are broadcast to the queries; beyond it both are dealt to blocks of queries.
BOX_BYTES, QUERY_BLOCKS = 32 << 20, 64
LONG = np.iinfo(np.int64)


def top_tree(sample: np.ndarray, levels: int) -> tuple[list[int], list[int]]:
    """Axis and cut of each inner node of a complete binary tree (node i has children 2i+1, 2i+2): medians along the widest side."""
    axes, cuts, parts = [], [], [sample]
    for _ in range(levels):
        below = []
        for rows in parts:
            axis = int(np.argmax(rows.max(axis=0) - rows.min(axis=0))) if len(rows) else 0
            cut = int(np.partition(rows[:, axis], (len(rows) - 1) // 2)[(len(rows) - 1) // 2]) if len(rows) else 0
            axes.append(axis)
            cuts.append(cut)
            left = rows[:, axis] <= cut
            below += [rows[left], rows[~left]]
        parts = below
    return axes, cuts


def _cell(vector: Column, axes: list[int], cuts: list[int], levels: int) -> Column:
    """The cell of the top tree that a vector falls in."""
    if not levels:
        return F.lit(0)
    axis, cut = F.array(*[F.lit(a + 1) for a in axes]), F.array(*[F.lit(c).cast("long") for c in cuts])
    step = lambda node, _: node * 2 + F.when(F.element_at(vector, F.element_at(axis, node + 1)) > F.element_at(cut, node + 1), 2).otherwise(1)
    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(0), step)


def exact_products(rows: np.ndarray, query: np.ndarray, most_row: int, most_query: int) -> np.ndarray:
    """Integer inner products; doubles are exact below 2^53, and beyond a long's range results are cut to its ends."""
    most = most_row * most_query * max(1, len(query))
    if most < 1 << 53:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return rows @ query
    return np.array([min(max(x, LONG.min), LONG.max) for x in rows.astype(object) @ query.astype(object)], np.int64)


def _most(a: np.ndarray) -> int:
    return max(abs(int(a.max())), abs(int(a.min()))) if a.size else 0


@dataclass
class Node:
    start: int
    end: int
    children: tuple[int, int] | None = None


class Tree:
    """A KD-tree over rows in the order of their ids; position i is row i."""

    def __init__(self, rows: np.ndarray) -> None:
        self.order = np.arange(len(rows))
        self.nodes = [Node(0, len(rows))]
        at = 0
        while at < len(self.nodes):
            node = self.nodes[at]
            at += 1
            own = self.order[node.start : node.end]
            if len(own) <= LEAF:
                continue
            part = rows[own]
            axis = int(np.argmax(part.max(axis=0).astype(float) - part.min(axis=0))) if rows.shape[1] else 0
            keys = part[:, axis] if rows.shape[1] else own
            self.order[node.start : node.end] = own[np.lexsort((own, keys))]  # equal rows are cut by position
            middle = (node.start + node.end) // 2
            node.children = len(self.nodes), len(self.nodes) + 1
            self.nodes += [Node(node.start, middle), Node(middle, node.end)]
        self.rows, self.most = rows[self.order], _most(rows)
        self.low = np.stack([self.rows[n.start : n.end].min(axis=0) for n in self.nodes])
        self.high = np.stack([self.rows[n.start : n.end].max(axis=0) for n in self.nodes])
        self.first = np.array([self.order[n.start : n.end].min() for n in self.nodes])
        self.exact = self.rows.astype(np.float64) if self.most < 1 << 31 else None

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The greatest product that a row in each node's box can have with each query; rounded up where doubles are not exact."""
        q, low, high = queries.astype(np.float64), self.low.astype(np.float64), self.high.astype(np.float64)
        found = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        if self.most * _most(queries) * max(1, q.shape[1]) >= 1 << 53:
            found += 1e-12 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T) + 1
        return np.clip(found, -(2.0**63), 2.0**63)  # as scores are cut

    def best(self, query: np.ndarray, bounds: np.ndarray, k: int, least: int | None, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and positions of the k best rows but own, of those that reach least; ties to the smaller position."""
        scores, places = np.empty(0, np.int64), np.empty(0, np.int64)
        heap, most = [(-bounds[0], self.first[0], 0)], _most(query)
        while heap:
            bound, first, at = heapq.heappop(heap)
            full = len(scores) >= k
            if full and (-bound < scores[-1] or (-bound == scores[-1] and first > places[-1])) or least is not None and -bound < least:
                break
            node = self.nodes[at]
            if node.children:
                for child in node.children:
                    heapq.heappush(heap, (-bounds[child], self.first[child], child))
                continue
            if self.exact is not None and self.most * most * max(1, len(query)) < 1 << 53:
                found = (self.exact[node.start : node.end] @ query.astype(np.float64)).astype(np.int64)
            else:
                found = exact_products(self.rows[node.start : node.end], query, self.most, most)
            floor = max([LONG.min] + ([int(scores[-1])] if full else []) + ([least] if least is not None else []))
            hit = np.flatnonzero(found >= floor)
            position = self.order[node.start + hit]
            hit, position = hit[position != own], position[position != own]
            scores, places = np.concatenate([scores, found[hit]]), np.concatenate([places, position])
            top = np.lexsort((places, -scores.astype(object) if len(scores) and scores.min() == LONG.min else -scores))[:k]
            scores, places = scores[top], places[top]
        return scores, places


def _vectors(column: pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def _searched(rows: DataFrame, k: int, boxes: bool) -> DataFrame:
    """Candidates (query, query_id, vec_id, vec_row, score) of each shard's queries; with boxes also a row for each shard with
    its box. rows (shard, kind, row, id, vector, least): kind 0 the shard's rows, 1 its queries."""
    kind = rows.schema["id"].dataType.simpleString()
    made = pa.schema([("query", pa.int64()), ("shard", pa.string()), ("dim", pa.int32()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())), ("score", pa.int64()), ("vec_row", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, own, vectors, tree = None, [], [], [], None

        def table(columns: dict, query_ids: pa.Array, vec_ids: pa.Array) -> pa.RecordBatch:
            n = len(query_ids)
            fixed = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in made]
            return pa.RecordBatch.from_arrays([*fixed, query_ids, vec_ids], [*made.names, "query_id", "vec_id"])

        for batch in batches:
            codes = batch.column(0).dictionary_encode().indices.to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(batch)] if len(batch) else [0]
            for start, end in zip(cuts, cuts[1:], strict=False):
                part = batch.slice(start, end - start)
                if part.column(0)[0].as_py() != shard:
                    shard, ids, own, vectors, tree = part.column(0)[0].as_py(), [], [], [], None
                n_rows = int((part.column(1).to_numpy() == 0).sum())
                if n_rows:
                    mine = part.slice(0, n_rows)
                    ids.append(mine.column(3))
                    own.append(mine.column(2).to_numpy(zero_copy_only=False))
                    vectors.append(_vectors(mine.column(4)))
                if n_rows == len(part):
                    continue
                if tree is None:
                    tree, all_ids, all_rows = Tree(np.concatenate(vectors)), pa.concat_arrays(ids), np.concatenate(own)
                    by_row = np.argsort(all_rows)
                asked = part.slice(n_rows)
                if asked.column(2)[0].as_py() is None:  # the mark that a shard is complete, before its queries
                    if boxes:
                        yield table({"shard": [shard], "dim": [tree.rows.shape[1]], "low": [tree.low[0].tolist()], "high": [tree.high[0].tolist()]}, pa.nulls(1, asked.column(3).type), pa.nulls(1, asked.column(3).type))
                    asked = asked.slice(1)
                for at in range(0, len(asked), 512):
                    some = asked.slice(at, 512)
                    queries, least, number = _vectors(some.column(4)), some.column(5).to_pylist(), some.column(2).to_numpy(zero_copy_only=False)
                    bounds, out = tree.bounds(queries), []
                    for i in range(len(some)):
                        place = int(np.searchsorted(all_rows, number[i], sorter=by_row))
                        mine = by_row[place] if place < len(by_row) and all_rows[by_row[place]] == number[i] else -1
                        scores, places = tree.best(queries[i], bounds[i], k, least[i], mine)
                        out.append((np.full(len(scores), i), scores, places))
                    of, scores, places = (np.concatenate(x) for x in zip(*out, strict=True))
                    yield table({"query": number[of], "score": scores, "vec_row": all_rows[places]}, some.column(3).take(pa.array(of)), all_ids.take(pa.array(places)))

    ordered = rows.repartition("shard").sortWithinPartitions("shard", "kind", F.asc_nulls_last("id"), F.asc_nulls_first("row"))
    return ordered.select("shard", "kind", "row", "id", "vector", "least").mapInArrow(search, f"query long, shard string, dim int, low array<long>, high array<long>, score long, vec_row long, query_id {kind}, vec_id {kind}")


def _bound(query: Column, low: Column, high: Column) -> Column:
    """The greatest product that a row in a box can have, rounded up."""
    q = lambda i: F.element_at(query, i).cast("double")
    sides = F.transform(F.sequence(F.lit(1), F.size(query)), lambda i: F.struct((q(i) * F.element_at(low, i)).alias("a"), (q(i) * F.element_at(high, i)).alias("b")))
    reach = lambda s: F.greatest(s["a"], s["b"]) + F.greatest(F.abs(s["a"]), F.abs(s["b"])) * 1e-12
    return F.when(F.size(query) == 0, F.lit(0.0)).otherwise(F.greatest(F.aggregate(sides, F.lit(0.0), lambda total, s: total + reach(s)), F.lit(-(2.0**63))))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0, shard_rows: int = SHARD_ROWS, box_bytes: int = BOX_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row that is_query names, best first from rank 1."""
    as_double = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taken = vectors.select(F.col(f"`{id_col}`").alias("id"), as_double.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asked")).filter(sound)
    rows = save(taken.select(F.monotonically_increasing_id().alias("row"), "id", F.transform("vector", lambda x: F.floor(x * scale)).alias("vector"), "asked", F.size("vector").alias("dim")), "vectors")

    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    dim, n = (common["dim"], common["count"]) if common else (0, 0)
    per_shard = max(16, min(shard_rows, SHARD_BYTES // (8 * max(1, dim))))
    levels = max(0, min(n // per_shard, MOST_CELLS)).bit_length() if dim else 0
    levels = min(levels, MOST_CELLS.bit_length() - 1)
    axes, cuts = [], []
    if levels:
        most = max(256, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
        sample = bounded_sample(rows.filter(F.col("dim") == dim).select("row", "vector"), "row", most).toPandas()["vector"]
        axes, cuts = top_tree(np.stack(sample.to_numpy()), levels)
    placed = rows.withColumn("cell", F.when(F.col("dim") == dim, _cell(F.col("vector"), axes, cuts, levels)).otherwise(0))
    sizes = save(placed.groupBy("dim", "cell").count().withColumn("salts", F.ceil(F.col("count") / per_shard)).drop("count"), "cells")
    shard = F.concat_ws("/", "dim", "cell", F.pmod(F.xxhash64("row"), F.col("salts")))
    index = save(placed.join(small(sizes, sizes.count(), 100_000), ["dim", "cell"]).select("row", "id", "vector", "dim", "asked", shard.alias("shard")), "shards")

    none = F.lit(None).cast("long")
    held = index.select("shard", F.lit(0).alias("kind"), "row", "id", "vector", none.alias("least"))
    marks = index.groupBy("shard").agg(F.lit(1).alias("kind"), none.alias("row"), F.lit(None).cast(index.schema["id"].dataType).alias("id"), F.lit(None).cast("array<long>").alias("vector"), none.alias("least"))
    asked = index.filter("asked")
    at_home = asked.select("shard", F.lit(2).alias("kind"), "row", "id", "vector", none.alias("least"))
    first = save(_searched(held.unionByName(marks).unionByName(at_home), k, boxes=True), "home")

    boxes = first.filter("query is null").select(F.col("shard").alias("to"), "dim", "low", "high")
    reached = first.filter("query is not null").groupBy(F.col("query").alias("row")).agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    waiting = asked.join(reached, "row", "left")
    n_boxes = boxes.count()
    may = (F.col("least").isNull() | (_bound(F.col("vector"), F.col("low"), F.col("high")) >= F.col("least"))) & (F.col("to") != F.col("shard"))
    if n_boxes * max(1, dim) * 16 <= box_bytes:
        met = waiting.join(F.broadcast(boxes), "dim")
    else:
        blocks = F.pmod(F.xxhash64("row"), F.lit(QUERY_BLOCKS))
        met = waiting.withColumn("block", blocks).join(boxes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(QUERY_BLOCKS - 1).cast("long")))), ["dim", "block"])
    routed = met.filter(may).select(F.col("to").alias("shard"), F.lit(2).alias("kind"), "row", "id", "vector", "least")
    rest = _searched(held.unionByName(marks).unionByName(routed), k, boxes=False)

    found = first.filter("query is not null").unionByName(rest).select("query", "query_id", "vec_id", "vec_row", "score")
    by = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "vec_row")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
