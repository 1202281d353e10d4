"""Reconciliation in proportion to the difference: invertible Bloom lookup tables of both sides.

Every row adds 1 (source) or -1 (output), its key's hash and a check of it to one cell in each of three tables; tasks sum their
cells before anything moves. What both sides have cancels out. A cell that holds one key alone tells its hash and how
often it is too many; taking that key out of its other cells frees the next ones. Only rows with the hashes found are then
counted exactly. Where the tables do not come out even, because the sides differ in more keys than the cells can tell
apart, both sides are joined in full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.operators.contracts import reconciled

#: Cells of each of the three tables; they tell some two thirds as many differing keys, all tables together, twice that.
CELLS, TABLES, SHIFT = 1 << 13, 3, 20
PRIME = (1 << 31) - 1


def _checked(h: Column) -> Column:
    return F.pmod(h, F.lit(PRIME)) * F.pmod(h, F.lit(PRIME)) % PRIME


def lookup_table(source: DataFrame, output: DataFrame, key: str, cells: int = CELLS) -> DataFrame:
    """(cell, n, hashes, checks): what the source has more than the output, cells without a difference left out."""
    of = lambda df, sign: df.select(F.xxhash64(key).alias("h"), F.lit(sign).alias("s"))
    both = of(source, 1).unionByName(of(output, -1))
    at = F.array(*[F.pmod(F.shiftright("h", SHIFT * i), F.lit(cells)) + i * cells for i in range(TABLES)])
    wide = lambda c: (c * F.col("s")).cast("decimal(20,0)")
    each = both.select("s", F.col("h").cast("decimal(20,0)").alias("_h"), _checked(F.col("h")).alias("_c"), F.explode(at).alias("cell"))
    summed = each.groupBy("cell").agg(F.sum("s").alias("n"), F.sum(F.col("_h") * F.col("s")).cast("decimal(38,0)").alias("hashes"), F.sum(wide(F.col("_c"))).cast("decimal(38,0)").alias("checks"))
    return summed.filter("n <> 0 or hashes <> 0 or checks <> 0")


def differing(rows: list[tuple[int, int, int, int]], cells: int = CELLS) -> dict[int, int] | None:
    """Hash and surplus of each key in which the sides differ, from (cell, n, hashes, checks); None where they can't be told."""
    table = {c: [int(n), int(h), int(k)] for c, n, h, k in rows}
    found: dict[int, int] = {}
    waiting = list(table)
    while waiting:
        cell = waiting.pop()
        n, hashes, checks = table.get(cell, (0, 0, 0))
        if n == 0 or hashes % n or checks % n:
            continue
        h = hashes // n
        places = [((h >> SHIFT * i) % cells) + i * cells for i in range(TABLES)]
        if not -(1 << 63) <= h < 1 << 63 or checks // n != (h % PRIME) ** 2 % PRIME or cell not in places:
            continue
        found[h] = found.get(h, 0) + n
        for place in places:
            held = table.setdefault(place, [0, 0, 0])
            held[0], held[1], held[2] = held[0] - n, held[1] - n * h, held[2] - checks
            if any(held):
                waiting.append(place)
            else:
                del table[place]
    return None if table else {h: n for h, n in found.items() if n}


def reconciled_by_difference(source: DataFrame, output: DataFrame, key: str, cells: int = CELLS) -> DataFrame:
    """contracts.reconciled(), (key, n_in, n_out) of keys that the sides have unequally often, without moving what is equal. Keys
    of equal 64-bit hashes that differ in opposite ways by the same number would not be seen."""
    rows = [tuple(r) for r in lookup_table(source, output, key, cells).collect()]  # TABLES * cells at most
    found = differing(rows, cells)
    if found is None:
        return reconciled(source, output, key)
    hashes = F.broadcast(source.sparkSession.createDataFrame([(h,) for h in found], "_h long"))  # as many as cells at most
    some = lambda df: df.select(key, F.xxhash64(key).alias("_h")).join(hashes, "_h", "left_semi").select(key)
    return reconciled(some(source), some(output), key)
