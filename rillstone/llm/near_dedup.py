"""Near-duplicates by ProbMinHash: weighted five-word shingles, banding, exact verification, components.

Each shingle is a Poisson process whose rate is its count; its arrivals fall on registers at random and a register keeps
the shingle that arrives first. A shingle stops once its next arrival is later than every register's first one, so long
documents need about one arrival for most of their shingles. Two documents agree on a register with their probability
Jaccard similarity J_P, the scale-free Jaccard of weighted sets (plain Jaccard where no shingle repeats).

Texts with the same words are one representative before anything is compared. In every band bucket, members are compared
with one leader and not with each other, so a group of near copies costs a comparison per member. Members of buckets that
still hold several components are banded a second time, with stricter bands, unless the shingles that they alone have
rule every partner out (an exact bound); there they are compared with leaders of other components, a few rounds long.
Leaders only save comparisons. What still shares a bucket of several components is joined on prefixes: the rarest
shingles of a set, up to the mass that two alike sets can leave unshared. Every pair of these sets that reaches the
least similarity meets there and is verified, whatever leaders were drawn; parities of their shingles, an exact bound, and
sketches rule most of the others out.

Defined cases: texts of 1 to 4 words have one shingle, all their words; texts without words are alike only when they are
equal (null as empty); texts of any length are read whole; repeated rows share a class; a null id keeps its row; ids may be of
any type that has an order; ties go to the smallest id, then the smallest text key; columns of other names are not read, and
keep_one() keeps them as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import WordHasher, save, slices, small, text_key, tidy
from .components import components

SHINGLE_WORDS, MIN_SIMILARITY = 5, 0.8
#: 25 bands of 5 registers find a pair of similarity 0.8 with probability 0.99995.
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Text keys that may be broadcast to choose texts by; beyond it Spark shuffles.
BROADCAST_TEXTS = 300_000
#: Members of buckets that hold several components are banded once more: 110 bands of 12 registers find a pair of
#: similarity 0.8 with probability 0.9996, and few of those below it.
STRICT_BANDS, STRICT_ROWS = 110, 12
LEADER_ROUNDS = 2
#: The strict registers also give a sketch of a bit each, in so many 64-bit words. Two sets agree on a bit with probability
#: (1 + J_P) / 2; a pair is left out only if it agrees on SIGMAS standard deviations fewer bits than a pair of the least
#: similarity is expected to (a pair of just that similarity is lost with probability 0.0000034).
SKETCH_WORDS, SIGMAS = 20, 4.5
#: Beside it a set has marks: as many bits, each the parity of the number of its shingles that fall there. A shingle that one set
#: alone has changes one bit, so two sets hold at least as many unshared shingles as their marks differ in bits.
MARKS = 64 * SKETCH_WORDS
#: Holders of a shingle that one lane of the prefix join takes, and what rounding may add to a bound.
LANE_ROWS, ROUNDING = 2_000, 1e-9
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


class Shingler(WordHasher):
    """Words of a text to its distinct shingles, as 64-bit hashes in order, with counts."""

    def shingles(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = max(1, len(words) - SHINGLE_WORDS + 1)
        if not len(words):
            return np.empty(0, _U), np.empty(0, np.int64)
        h = np.zeros(n, _U)
        for k in range(min(SHINGLE_WORDS, len(words))):
            h = mix(h * _U(3) + words[k : k + n])
        return np.unique(h, return_counts=True)


def representative(text: str | None, words: np.ndarray) -> bytes:
    """16 bytes: of the words, or of the text where it has none."""
    return xxhash.xxh3_128_digest(words.tobytes()) if len(words) else b"\xff" + xxhash.xxh3_128_digest((text or "").encode("utf-8", "replace"))[1:]


def prob_min_hash(shingles: list[np.ndarray], counts: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """One row of registers per document: in each, the hash of the shingle that arrived first (0 where there is none)."""
    n = len(shingles)
    first = np.full(n * registers, np.inf)
    holds = np.zeros(n * registers, _U)
    doc = np.repeat(np.arange(n), [len(s) for s in shingles])
    if not len(doc):
        return holds.reshape(n, registers)
    item, rate = np.concatenate(shingles), np.concatenate(counts).astype(np.float64)
    at, k = np.zeros(len(item)), 0
    while len(item):
        draw = mix(item + _U(0x9E3779B97F4A7C15 * (k + 1) % (1 << 64)))
        at = at - np.log(_unit(draw)) / rate
        place = doc * registers + (mix(draw ^ _U(0xD1B54A32D192ED03)) % _U(registers)).astype(np.int64)
        early = at < first[place]
        where, when = place[early], at[early]
        np.minimum.at(first, where, when)
        won = when == first[where]
        holds[where[won]] = item[early][won]
        going = at < first.reshape(n, registers).max(axis=1)[doc]
        doc, item, rate, at, k = doc[going], item[going], rate[going], at[going], k + 1
    return holds.reshape(n, registers)


def band_keys(holds: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band, that differs between bands."""
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=_U), (len(holds), bands)).copy()
    for k in range(rows):
        keys = mix(keys * _U(5) + holds[:, k::rows])
    return keys.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P: the sum over shared i of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = a[1].astype(float), b[1].astype(float)
    xi, yi = x[i], y[j]
    if x.max() == x.min() and y.max() == y.min():
        return len(both) / (len(x) + len(y) - len(both))
    ratio = yi / xi
    order = np.argsort(ratio, kind="stable")
    ratio, xs, ys = ratio[order], xi[order], yi[order]
    only_x, only_y = x.sum() - xi.sum(), y.sum() - yi.sum()
    below = np.concatenate(([0.0], np.cumsum(xs)))  # x of shared j with a smaller ratio: x_j / x_i is the larger
    above = np.concatenate((np.cumsum(ys[::-1])[::-1], [0.0]))
    k = np.searchsorted(ratio, ratio, side="right")
    return float((1 / ((only_x + below[k]) / xs + (only_y + above[k]) / ys)).sum())


def _packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    return hashes.astype("<u8").tobytes() + counts.astype("<u4").tobytes()


def _unpacked(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(b) // 12
    return np.frombuffer(b, "<u8", n), np.frombuffer(b, "<u4", n, 8 * n)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, k1, k2, rep, bands): the text's key and the band keys of every document; none for texts without words."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for part in slices(batch, 1):
                texts = part.column(1).to_pylist()
                words = [shingler.words(t) for t in texts]
                reps = [representative(t, w) for t, w in zip(texts, words, strict=True)]
                new = list({r: i for i, r in enumerate(reps) if len(words[i])}.items())
                made = [shingler.shingles(words[i]) for _, i in new]
                keys = band_keys(prob_min_hash([m[0] for m in made], [m[1] for m in made])) if made else []
                of = {r: k.tolist() for (r, _), k in zip(new, keys, strict=True)}
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), pa.array(reps, pa.binary()), pa.array([of.get(r) for r in reps], pa.list_(pa.int64()))], ["id", "k1", "k2", "rep", "bands"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text, *text_key(text))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, k1 long, k2 long, rep binary, bands array<long>")


def shingle_sets(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """(rep, packed shingles), one row for each row of wanted: (k1, k2, rep), the key of one text of the rep."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for part in slices(batch, 1):
                found = {}
                for rep, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if rep not in found:
                        found[rep] = _packed(*shingler.shingles(shingler.words(text)))
                yield pa.RecordBatch.from_pydict({"rep": pa.array(found, pa.binary()), "packed": pa.array(found.values(), pa.binary())})

    text = F.col(text_col).cast("string")
    chosen = docs.select(text.alias("_t"), *text_key(text)).join(small(wanted, wanted.count(), BROADCAST_TEXTS), ["k1", "k2"]).select("rep", "_t")
    return chosen.mapInArrow(run, "rep binary, packed binary").groupBy("rep").agg(F.first("packed").alias("packed"))


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b) of the pairs whose exact similarity is at least least. Hot partners are split by Spark's skew join."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [similarity(_unpacked(x), _unpacked(y)) >= least for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(near)), batch.column(1).filter(pa.array(near))], ["a", "b"])

    x, y = sets.select(F.col("rep").alias("a"), F.col("packed").alias("x")), sets.select(F.col("rep").alias("b"), F.col("packed").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def sketch_bits(holds: np.ndarray) -> np.ndarray:
    """A bit of each of the first 64 * SKETCH_WORDS registers, drawn anew for each register, as 64-bit words."""
    n = 64 * SKETCH_WORDS
    drawn = mix(holds[:, :n] ^ mix(np.arange(1, n + 1, dtype=_U))) & _U(1)
    return np.packbits(drawn.astype(np.uint8), axis=1, bitorder="little").view("<i8")


def parity_marks(shingles: np.ndarray) -> np.ndarray:
    """The marks of a set, as 64-bit words."""
    odd = np.bincount((mix(shingles ^ _U(0x5851F42D4C957F2D)) % _U(MARKS)).astype(np.int64), minlength=MARKS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


@tidy
def _strict_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1, most_rows=200):
            sets = [_unpacked(x) for x in part.column(1).to_pylist()]
            holds = prob_min_hash([x[0] for x in sets], [x[1] for x in sets], STRICT_BANDS * STRICT_ROWS)
            keys = band_keys(holds, STRICT_BANDS, STRICT_ROWS)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(keys.tolist(), pa.list_(pa.int64())), pa.array(sketch_bits(holds).tolist(), pa.list_(pa.int64())), pa.array([parity_marks(x[0]).tolist() for x in sets], pa.list_(pa.int64())), pa.array([float(x[1].sum() / x[1].min()) for x in sets])], ["rep", "bucket", "bits", "marks", "extent"])


def _differing(x: str, y: str) -> Column:
    return reduce(add, [F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(SKETCH_WORDS)])


def _agree(x: str, y: str, least: float) -> Column:
    """Whether two sketches agree on as many bits as a pair of the least similarity may."""
    n, p = 64 * SKETCH_WORDS, (1 + least) / 2
    return _differing(x, y) <= int(n * (1 - p) + SIGMAS * (n * p * (1 - p)) ** 0.5)


def _marks_allow(least: float) -> Column:
    """Whether the marks of two sets let them be alike; exact. Of a set of extent e, the inverse of its smallest mass, a shingles
    that it alone has are a mass of a / e at least, and cost e / (e - a) (see _costs). For d such shingles in both sets, however
    they fall on them, the costs add up to (sqrt(e) + sqrt(x_e))^2 / (e + x_e - d) at least."""
    shared = F.col("extent") + F.col("x_extent") - _differing("x_marks", "marks")
    return (F.sqrt("extent") + F.sqrt("x_extent")) * (F.sqrt("extent") + F.sqrt("x_extent")) <= shared * (1 / least + 1 + ROUNDING)


def _members(banded: DataFrame) -> DataFrame:
    """(rep, bucket, n) of buckets with n > 1 members, written."""
    banded = save(banded, "bands")
    return save(banded.join(banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "bucket").select("rep", "bucket", "n"), "members")


def _with_leaders(members: DataFrame) -> DataFrame:
    """(a, b): each member with its bucket's leader, the member that shares most buckets with others: of a group of copies
    the one that they were made from, rather than one of them."""
    known = members.groupBy("rep").agg(F.sum("n").alias("weight"))
    led = members.join(known, "rep").groupBy("bucket").agg(F.max(F.struct("weight", "rep")).alias("lead"))
    both = members.join(led, "bucket").filter(F.col("rep") != F.col("lead.rep"))
    return both.select(F.least("rep", "lead.rep").alias("a"), F.greatest("rep", "lead.rep").alias("b"))


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    return members.join(found.select(F.col("node").alias("rep"), "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))


def _still_mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """(rep) of the members of buckets that hold several components."""
    mixed = _mixed(members, found).groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    return members.join(mixed, "bucket", "left_semi").select("rep").distinct()


def _shingle_rows(sets: DataFrame) -> DataFrame:
    """(rep, shingle, mass, size): mass is the shingle's share of its set; size is the number of shingles, 0 where counts differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashes, counts = _unpacked(packed)
                n = len(hashes)
                size = n if counts.min() == counts.max() else 0
                yield pa.RecordBatch.from_arrays([pa.array([rep] * n, pa.binary()), pa.array(hashes.view("<i8")), pa.array(counts / counts.sum()), pa.array([size] * n, pa.int32())], ["rep", "shingle", "mass", "size"])

    return sets.select("rep", "packed").mapInArrow(run, "rep binary, shingle long, mass double, size int")


def _costs(sets: DataFrame) -> DataFrame:
    """(rep, cost): cost is 1 / (1 - u) for the mass u of a set's shingles that no other of the sets has. What two sets can
    share is bounded by that: J_P is at most 1 / (cost + cost - 1)."""
    own = _shingle_rows(sets).groupBy("shingle").agg(F.count("*").alias("n"), F.first("rep").alias("rep"), F.first("mass").alias("mass"))
    alone = own.filter("n = 1").groupBy("rep").agg(F.sum("mass").alias("u"))
    return sets.select("rep").join(alone, "rep", "left").select("rep", F.when(F.col("u") > 0.999, F.lit(1000.0)).otherwise(1 / (1 - F.coalesce("u", F.lit(0.0)))).alias("cost"))


def _prefix_pairs(sets: DataFrame, strict: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """(a, b): a superset of the pairs of sets, of different components, whose similarity is at least least.

    Sets list their shingles in one order, rarest first. At the first shingle that two sets share, the mass that stands
    before it is unshared in both, so the bound of _costs holds for that mass: cost + cost is at most 1 / least + 1, and the
    cheaper side pays at most half of it. Sets without repeated shingles also differ in size by at most the factor least.
    Marks rule most of the rest out where sets have some hundred shingles, sketches where they have more: of strict, (rep, bits,
    marks, extent)."""
    most, half = 1 / least + 1 + ROUNDING, (1 / least + 1) / 2 + ROUNDING
    rows = _shingle_rows(sets)
    rarest = Window.partitionBy("rep").orderBy("n", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.join(rows.groupBy("shingle").agg(F.count("*").alias("n")), "shingle").withColumn("before", F.coalesce(F.sum("mass").over(rarest), F.lit(0.0)))
    prefix = ranked.filter((F.col("n") > 1) & (F.col("before") <= 1 - least + ROUNDING)).select("rep", "shingle", "size", (1 / (1 - F.col("before"))).alias("cost"))
    at = save(_mixed(prefix, found), "prefixes")
    shared = at.groupBy("shingle").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("cost").alias("cheapest"))
    shared = shared.filter((F.col("lo") != F.col("hi")) & (F.col("cheapest") <= half)).select("shingle", F.ceil(F.col("n") / LANE_ROWS).cast("int").alias("lanes"))
    at = at.join(shared, "shingle").join(strict.select("rep", "bits", "marks", "extent"), "rep")
    x = at.filter(F.col("cost") <= half).select("shingle", F.pmod(F.xxhash64("rep"), "lanes").cast("int").alias("lane"), *[F.col(c).alias(f"x_{c}") for c in ("rep", "comp", "cost", "size", "bits", "marks", "extent")])
    y = at.select("shingle", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"), "rep", "comp", "cost", "size", "bits", "marks", "extent")
    near = (F.col("size") == 0) | (F.col("x_size") == 0) | (F.least("size", "x_size") >= F.greatest("size", "x_size") * least - ROUNDING)
    once = (F.col("cost") > half) | (F.col("x_rep") < F.col("rep"))
    both = x.join(y, ["shingle", "lane"]).filter((F.col("comp") != F.col("x_comp")) & (F.col("cost") + F.col("x_cost") <= most) & near & once & _marks_allow(least) & _agree("x_bits", "bits", least))
    return both.select(F.least("rep", "x_rep").alias("a"), F.greatest("rep", "x_rep").alias("b")).distinct()


def _across(at: DataFrame, k: int, least: float) -> DataFrame:
    """(a, b): in buckets of several components, the members with a leader of another one, where the bound lets them be
    alike. The first round's leaders share most, later ones are drawn by hash."""
    known = at.groupBy("rep").agg(F.sum("n").alias("weight"))
    order = F.col("weight") if k == 0 else F.xxhash64("rep", F.lit(k), "bucket")
    led = at.join(known, "rep").groupBy("bucket").agg(F.max(F.struct(order.alias("order"), "rep", "comp", "cost")).alias("lead"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi")
    both = at.join(led.select("bucket", "lead"), "bucket").filter((F.col("comp") != F.col("lead.comp")) & (F.col("cost") + F.col("lead.cost") <= 1 / least + 1))
    return both.select(F.least("rep", "lead.rep").alias("a"), F.greatest("rep", "lead.rep").alias("b"))


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components of those found and further links: a star for each component stands for the links that made it."""
    a, b = links.columns
    return components(found.filter("node <> comp").select(F.col("node").alias(a), F.col("comp").alias(b)).unionByName(links))


def _classes(docs: DataFrame, id_col: str, text_col: str, least: float) -> DataFrame:
    """(id, k1, k2, rep, comp), one row per document; comp is the component that verified links make."""
    rows = save(sketches(docs, id_col, text_col), "sketches")
    reps = rows.filter(F.col("bands").isNotNull()).groupBy("rep").agg(F.first("bands").alias("bands"))
    members = _members(reps.select("rep", F.explode("bands").alias("bucket")))
    one = rows.join(members.select("rep").distinct(), "rep", "left_semi").groupBy("rep").agg(F.min(F.struct("k1", "k2")).alias("k"))
    sets = save(shingle_sets(docs, text_col, save(one.select("k.k1", "k.k2", "rep"), "wanted")), "sets")
    pairs = save(_with_leaders(members).distinct(), "pairs")
    found = save(components(save(verified(pairs, sets, least), "links")), "components")
    apart = sets.join(_still_mixed(members, found), "rep", "left_semi")
    costs = save(_costs(apart).filter(F.col("cost") <= 1 / least), "costs")
    strict = save(sets.join(costs, "rep", "left_semi").mapInArrow(_strict_sketches, "rep binary, bucket array<long>, bits array<long>, marks array<long>, extent double"), "strict")
    again = _members(strict.select("rep", F.explode("bucket").alias("bucket")))
    for k in range(LEADER_ROUNDS):
        at = _mixed(again, found).join(costs, "rep")
        some = _across(at, k, least).distinct().join(pairs, ["a", "b"], "left_anti")
        more = save(some, "pairs")
        new = save(verified(more, sets, least), "links")
        pairs = pairs.unionByName(more)
        if not new.isEmpty():
            found = save(_merged(found, new), "components")
        elif k:
            break
    apart = apart.join(_still_mixed(members, found), "rep", "left_semi").join(costs, "rep", "left_semi")
    rest = save(_prefix_pairs(save(apart, "apart"), strict, found, least).join(pairs, ["a", "b"], "left_anti"), "pairs")
    new = save(verified(rest, sets, least), "links")
    if not new.isEmpty():
        found = save(_merged(found, new), "components")
    comps = found.select(F.col("node").alias("rep"), "comp")
    return save(rows.drop("bands").join(comps, "rep", "left").withColumn("comp", F.coalesce("comp", "rep")), "classes")


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = MIN_SIMILARITY) -> DataFrame:
    """(id, class_id, class_size), one row per document; class_id is the smallest id of the documents that verified links
    connect, null where all of theirs are."""
    rows = _classes(docs, id_col, text_col, least)
    classes = rows.groupBy("comp").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    return rows.join(classes, "comp").select(F.col("id").alias(id_col), "class_id", "class_size")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = MIN_SIMILARITY) -> DataFrame:
    """The documents, one of each class: the one with the smallest id (null last), then the smallest text key."""
    rows = _classes(docs, id_col, text_col, least)
    who = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    kept = save(rows.groupBy("comp").agg(F.min(who).alias("one")).select("one.id", "one.k1", "one.k2"), "kept")
    again = rows.groupBy("id", "k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").join(kept, (rows["id"].eqNullSafe(kept["id"])) & (rows["k1"] == kept["k1"]) & (rows["k2"] == kept["k2"]), "left_semi")
    keyed = docs.select(F.struct("*").alias("_doc"), F.col(id_col).alias("_id"), *[k.alias(f"_{i}") for i, k in enumerate(text_key(F.col(text_col).cast("string")), 1)])
    left = keyed.join(kept, (keyed["_id"].eqNullSafe(kept["id"])) & (keyed["_1"] == kept["k1"]) & (keyed["_2"] == kept["k2"]), "left_semi")
    if not again.isEmpty():
        left = left.dropDuplicates(["_id", "_1", "_2"])
    return left.select("_doc.*")
