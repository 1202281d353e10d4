"""The prefix trie of conversations, by digests of fixed-length blocks of turns.

Turns of a conversation are chained into running digests (SHA-256 of each turn, BLAKE2b along the chain): two conversations
share a node of depth d where their digests at d agree. Digests at block ends, every BLOCK turns, are grouped first. A block
whose start no other conversation shares has nothing to group; one that all who share its start leave together has the
same members all through; only inside blocks where siblings diverge are single turns grouped.

A node belongs to its smallest member, and a conversation owns the end of its path. So what a subtree sums up is what its
members' own nodes add, and no sum walks the trie: one value for each conversation, summed over those that share a node.

Conversations stream through their task in order, with a running digest as the only state; a long one is never gathered. Counts are
summed before they are shuffled, and joins on shared digests are plain joins, which AQE splits where one prefix is in very
many conversations. The ids that end at a node are joined in chunks of id ranges (at most 65,536 ids), then chunks stream
through SHA-256 in order.

Defined cases: null roles and texts are empty; turns are ordered by the given columns, nulls first, ties by role, then digest;
repeated rows are turns of their own; rows with a null conversation are left out; conversations without turns end at the
root; texts may have any length; no conversation, no node; columns of other names are not read. Ids are integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import save, tidy

BLOCK = 4
WORD = r"[^\x20\x09-\x0D]+"
ROOT = bytes(16)
#: Ids of one chunk share all but so many bits.
CHUNK_BITS = 16


def chained(turns: DataFrame, order: list[Column]) -> DataFrame:
    """(conv, depth, chain, words, last) for the root and every turn of each conversation. turns (conv, role, text, ...): a
    conversation's root is the row whose text_kind is 0."""

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, depth, digest = None, 0, ROOT

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv", "depth", "chain", "words", "last"])

        for batch in batches:
            out = []
            for conv, turn, words in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                same = held is not None and held[0] == conv
                if held is not None:
                    out.append((*held, not same))
                depth, digest = (depth + 1, hashlib.blake2b(digest + turn, digest_size=16).digest()) if same else (0, ROOT)
                held = conv, depth, digest, words
            if out:
                yield batch_of(out)
        if held is not None:
            yield batch_of([(*held, True)])

    ordered = turns.repartition("conv").sortWithinPartitions("conv", *order)
    return ordered.select("conv", "turn", "words").mapInArrow(tidy(chain), "conv long, depth long, chain binary, words long, last boolean")


def _digests(ends: DataFrame) -> DataFrame:
    """(chain, ends_sha256) of (chain, conv): the ids that end at a node, ascending, comma-joined."""
    some = ends.groupBy("chain", F.shiftright("conv", CHUNK_BITS).alias("range")).agg(F.concat_ws(",", F.array_sort(F.collect_list("conv")).cast("array<string>")).alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain, state = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"chain": pa.array([chain], pa.binary()), "ends_sha256": [state.hexdigest()]})

        for batch in batches:
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node == chain:
                    state.update(b",")
                else:
                    if state is not None:
                        yield done()
                    chain, state = node, hashlib.sha256()
                state.update(ids.encode())
        if state is not None:
            yield done()

    return some.repartition("chain").sortWithinPartitions("chain", "range").select("chain", "ids").mapInArrow(hashed, "chain binary, ends_sha256 string")


def _members(rows: DataFrame) -> DataFrame:
    """(chain, n, owner, n_ends, end) of nodes that more than one conversation shares: members, the smallest, how many end
    there, and the smallest of those. Written, so that a join with it is one whose hot partitions Spark can split."""
    found = rows.groupBy("chain").agg(F.count("*").alias("n"), F.min("conv").alias("owner"), F.count_if("last").alias("n_ends"), F.min(F.when(F.col("last"), F.col("conv"))).alias("end")).filter("n > 1")
    return save(found, "members")


def prefix_trie(turns: DataFrame, order: list[Column], conversations: DataFrame | None = None, conv_col: str = "conv_id", block: int = BLOCK) -> DataFrame:
    """A row for each node (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of the
    trie over turns (conv, role, text, and what order names); see the module. conversations: ids, for those without turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = F.col(f"`{conv_col}`").cast("long").alias("conv")
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    keys = [f"_o{i}" for i in range(len(order))]
    rows = turns.select(conv, digest.alias("turn"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.lit(1).alias("text_kind"), *[o.alias(k) for o, k in zip(order, keys, strict=True)], role.alias("_role"), F.xxhash64(text).alias("_text"))
    ids = turns.select(conv).unionByName(conversations.select(conv)) if conversations is not None else turns.select(conv)
    roots = ids.distinct().select("conv", F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("words"), F.lit(0).alias("text_kind"))
    both = rows.unionByName(roots, allowMissingColumns=True).filter("conv is not null")
    path = save(chained(both, ["text_kind", *[F.asc_nulls_first(k) for k in keys], "_role", "_text", "turn"]), "paths")

    # Block ends first.
    ends = path.filter(F.col("depth") % block == 0)
    at_ends = ends.join(_members(ends), "chain", "left").withColumn("number", F.floor(F.col("depth") / block))
    by_conv = Window.partitionBy("conv").orderBy("depth")
    after = lambda c: F.lead(c).over(by_conv).alias(f"end_{c}")
    at_ends = save(at_ends.select("*", *[after(c) for c in ("chain", "n", "owner")]), "blocks")
    shared = at_ends.filter("n > 1").select("conv", "number", F.col("n").alias("start_n"), "end_chain", "end_n", "end_owner")
    inner = path.filter(F.col("depth") % block != 0).withColumn("number", F.floor(F.col("depth") / block)).join(shared, ["conv", "number"], "left")
    together, apart = F.col("start_n").isNotNull() & F.col("start_n").eqNullSafe(F.col("end_n")), F.col("start_n").isNotNull() & ~F.col("start_n").eqNullSafe(F.col("end_n"))
    inner = save(inner.withColumn("kind", F.when(together, "together").when(apart, "apart").otherwise("alone")), "inner")

    # Then single turns, only where a block's siblings part.
    parted = inner.filter("kind = 'apart'").select("conv", "depth", "chain", "words", "last")
    columns = ["conv", "depth", "chain", "words", "last", "n", "owner", "n_ends", "end"]
    none = F.lit(None).cast("long")
    found = at_ends.select(*columns, F.lit(True).alias("grouped"), F.col("chain").alias("sums_of"))
    found = found.unionByName(parted.join(_members(parted), "chain", "left").select(*columns, F.lit(True).alias("grouped"), F.col("chain").alias("sums_of")))
    found = found.unionByName(inner.filter("kind = 'together'").select("conv", "depth", "chain", "words", "last", F.col("end_n").alias("n"), F.col("end_owner").alias("owner"), F.lit(0).cast("long").alias("n_ends"), none.alias("end"), F.lit(False).alias("grouped"), F.col("end_chain").alias("sums_of")))
    found = found.unionByName(inner.filter("kind = 'alone'").select("conv", "depth", "chain", "words", "last", none.alias("n"), none.alias("owner"), none.alias("n_ends"), none.alias("end"), F.lit(False).alias("grouped"), F.lit(None).cast("binary").alias("sums_of")))
    alone = F.col("n").isNull()
    found = found.withColumns({"owner": F.when(alone, F.col("conv")).otherwise(F.col("owner")), "n_ends": F.when(alone, F.col("last").cast("long")).otherwise(F.col("n_ends")), "end": F.when(alone & F.col("last"), F.col("conv")).otherwise(F.col("end")), "n": F.when(alone, 1).otherwise(F.col("n")).cast("long")})
    nodes = save(found.withColumn("own", F.col("owner") == F.col("conv")), "nodes")

    # What each conversation adds to every node it shares: its own nodes' tokens and leaf.
    saved = (F.col("n") - 1) * F.col("words")
    leaf = F.col("own") & F.col("last") & (F.col("n_ends") == F.col("n"))
    each = save(nodes.groupBy("conv").agg(F.min(F.when(F.col("own"), F.col("depth"))).alias("first"), F.sum(F.when(F.col("own"), saved).otherwise(0)).alias("tokens"), F.max(leaf.cast("long")).alias("leaf"), F.max_by(F.when(~F.col("own"), F.col("owner")), F.when(~F.col("own"), F.col("depth"))).alias("parent")).filter("first is not null"), "conversations")
    given = nodes.filter("n > 1 and not own and grouped").select("conv", "depth", "chain").join(each, "conv")
    sums = given.groupBy(F.col("chain").alias("sums_of")).agg(F.sum("tokens").alias("tokens_in"), F.sum("leaf").alias("leaves_in"))
    branches = given.filter("first = depth + 1").groupBy("chain").agg(F.count("*").alias("branches"))
    onward = Window.partitionBy("conv").orderBy("depth").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    owned = nodes.filter("own")
    common = owned.filter("n > 1").withColumn("own_tokens", F.sum(saved).over(onward)).join(sums, "sums_of", "left").join(branches, "chain", "left").join(_digests(nodes.filter("last and n_ends > 1").select("chain", "conv")), "chain", "left")
    single = owned.filter("n = 1")
    made = common.unionByName(single, allowMissingColumns=True).join(each.select("conv", "first", "leaf", "parent"), "conv")
    few = F.when(F.col("n_ends") == 0, F.sha2(F.lit(""), 256)).otherwise(F.sha2(F.col("end").cast("string"), 256))
    return made.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") == 0, None).when(F.col("depth") == F.col("first"), F.col("parent")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        ((~F.col("last")).cast("long") + F.coalesce("branches", F.lit(0))).alias("n_children"), (F.col("leaf") + F.coalesce("leaves_in", F.lit(0))).alias("n_leaves"),
        (F.coalesce("own_tokens", F.lit(0)) + F.coalesce("tokens_in", F.lit(0))).alias("saved_tokens"), F.coalesce("ends_sha256", few).alias("ends_sha256"),
    )
