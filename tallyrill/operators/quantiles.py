"""Exact, linearly interpolated quantiles of columns of any size.

The built-in exact ``percentile`` keeps every distinct value of a column in one buffer. Here a sketch says
between which two values a wanted rank must lie; values outside are only counted, and equal values inside are
counted and written in order. The sizes of the written parts say which part holds a wanted rank. Only those parts get
running counts, and two values per quantile reach the driver. A rank that the sketch misplaced shows up among
the values that were only counted; its column is then ordered whole.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrill.scratch import write_once

SKETCH = 1000  # a sketched rank is off by at most one part in so many
SKETCH_ABOVE = 100_000  # values of a column that are ordered whole


def exact_quantiles(df: DataFrame, wanted: dict[str, list[float]]) -> dict[tuple[str, float], float | None]:
    """{(column, probability): value}; None for a column without values. NaN counts as missing.

    ``df`` is read once, and only the wanted columns of it are written.
    """
    cells = write_once(df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"v{i}")
                                   for i, c in enumerate(wanted)]), "values")
    between = _brackets(cells, wanted)
    out = _quantiles(cells, wanted, between)
    missed = {c: probs for c, probs in wanted.items() if between[c] and any(out[(c, p)] is None for p in probs)}
    if missed:
        out |= _quantiles(cells, {c: probs if c in missed else [] for c, probs in wanted.items()}, {c: [] for c in wanted})
    return out


def _brackets(cells: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[tuple[float, float]]]:
    """Per column the ascending, disjoint ranges of values that hold the wanted ranks; none for a short column."""
    margin, probes = 2 / SKETCH, {}
    for i, (c, probs) in enumerate(wanted.items()):
        probes[c] = [min(max(p + m, 0.0), 1.0) for p in sorted(probs) for m in (-margin, margin)]
    sketched = cells.agg(*[e for i, c in enumerate(wanted) for e in (
        F.count(f"v{i}").alias(f"n{i}"), F.percentile_approx(f"v{i}", probes[c] or [0.5], SKETCH).alias(f"q{i}"))]).first()
    out: dict[str, list[tuple[float, float]]] = {}
    for i, c in enumerate(wanted):
        held: list[tuple[float, float]] = []
        for low, high in zip(sketched[f"q{i}"][::2], sketched[f"q{i}"][1::2]) if sketched[f"n{i}"] > SKETCH_ABOVE else ():
            if held and low <= held[-1][1]:
                held[-1] = held[-1][0], max(high, held[-1][1])
            else:
                held.append((low, high))
        out[c] = held
    return out


def _zone(value: Column, between: list[tuple[float, float]]) -> Column:
    """Odd numbers for the ranges, even ones for what lies before, between and after them; without ranges all is 1."""
    if not between:
        return F.lit(1)
    passed = [F.when(value >= low, 1).otherwise(0) + F.when(value > high, 1).otherwise(0) for low, high in between]
    return reduce(lambda a, b: a + b, passed)


def _quantiles(cells: DataFrame, wanted: dict[str, list[float]],
               between: dict[str, list[tuple[float, float]]]) -> dict[tuple[str, float], float | None]:
    """As ``exact_quantiles`` of the written columns; also None where a wanted rank lies outside the given ranges."""
    columns = list(wanted)
    parted = []
    for i, c in enumerate(columns):
        if wanted[c]:
            value = F.col(f"v{i}")
            zone = _zone(value, between[c])
            parted.append(F.struct(F.lit(i).alias("c"), F.when(value.isNotNull(), zone).alias("zone"),
                                   F.when(zone % 2 == 1, value).alias("v")))
    out: dict[tuple[str, float], float | None] = {(c, p): None for c, probs in wanted.items() for p in probs}
    if not parted:
        return out
    counted = (cells.select(F.explode(F.array(*parted)).alias("_cell")).select("_cell.*").filter(F.col("zone").isNotNull())
               .groupBy("c", "zone", "v").agg(F.count(F.lit(1)).alias("n")))
    order = ("c", "zone", "v")
    values = write_once(counted.repartitionByRange(*order).sortWithinPartitions(*order)
                        .withColumn("part", F.spark_partition_id()), "value-counts")
    # one row per written part, and one more for each column that begins inside a part
    sizes = values.groupBy("c", "part").agg(F.sum("n").alias("n")).collect()
    parts: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for row in sorted(sizes):
        parts[row["c"]].append((row["part"], row["n"]))

    spots: dict[tuple[str, float], tuple[float, list[tuple[int, int, int]]]] = {}
    for i, c in enumerate(columns):
        total = sum(n for _, n in parts[i])
        for prob in wanted[c] if total else ():
            exact = (total - 1) * prob
            low = math.floor(exact)
            ranks = {low, min(low + 1, total - 1)}
            spots[(c, prob)] = exact - low, [_spot(i, parts[i], rank) for rank in sorted(ranks)]
    found = _values_at(values, sorted({s for _, held in spots.values() for s in held}))
    for key, (weight, held) in spots.items():
        ends = found[held[0]], found[held[-1]]
        out[key] = None if None in ends else _between(*ends, weight)
    return out


def _spot(column: int, parts: list[tuple[int, int]], rank: int) -> tuple[int, int, int]:
    """(column, part, rank inside the part) of a rank inside the column."""
    for part, n in parts:
        if rank < n:
            return column, part, rank
        rank -= n
    raise IndexError(rank)


def _values_at(values: DataFrame, spots: list[tuple[int, int, int]]) -> dict[tuple[int, int, int], float]:
    if not spots:
        return {}
    asked = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(part).alias("part"), F.lit(rank).cast("bigint").alias("rank"))
                      for c, part, rank in spots])
    held = values.filter(F.struct("c", "part").isin(
        *[F.struct(F.lit(c).alias("c"), F.lit(part).alias("part")) for c, part in sorted({s[:2] for s in spots})]))
    upto = F.sum("n").over(Window.partitionBy("c", "part").orderBy("zone", "v"))
    hits = (held.withColumn("upto", upto)
            .withColumn("hit", F.explode(F.filter(asked, lambda s: (
                (s["c"] == F.col("c")) & (s["part"] == F.col("part")) & (s["rank"] < F.col("upto"))
                & (s["rank"] >= F.col("upto") - F.col("n"))))))
            .select("hit.*", "v").collect())
    return {(r["c"], r["part"], r["rank"]): r["v"] for r in hits}


def _between(low: float, high: float, weight: float) -> float:
    gap = high - low
    return high - gap * (1 - weight) if weight >= 0.5 else low + gap * weight
