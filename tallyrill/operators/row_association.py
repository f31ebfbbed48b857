"""Rank correlations between two columns of facts, without a series key and without a window over the rows.

Rows are counted by their pair of values first. Ranks come from counted values and running totals over
written stretches. Kendall's discordant pairs are inversions: along (x, y), a row before another with the
larger y. They are counted in three places, each exact:

* inside a stretch of the order (x, y), which one task holds;
* between stretches, among rows that fall into one stretch of the order (y, stretch of x), which again one
  task holds;
* between stretches of both orders, from the table that counts rows by both numbers. This is the same
  question about fewer points, so it is asked again until one task can hold them.

A stretch has about ``STRETCH`` points, so rounds end after the second for up to ``STRETCH`` squared points.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrill.functions.stats import kendall_p, normal_two_sided_p, pearson_p, significant
from tallyrill.operators.ordered import value_ranks
from tallyrill.scratch import write_once

STRETCH = 500_000
METHODS = ("pearson", "spearman", "kendall")
_BY_STRETCH = "part long, y double, n long, found string"


def inversions(y: np.ndarray, n: np.ndarray) -> int:
    """Weighted pairs of points in their order where the first has the larger ``y``.

    Two values differ first at some bit of their rank. Level by level, points that agree on all higher bits stay
    together in their order, and every point without the bit meets those before it that have it.
    """
    if len(y) < 2:
        return 0
    code = np.unique(y, return_inverse=True)[1].astype(np.int64)
    whole = int(n.sum())
    if whole >= 1 << 31:  # products no longer fit 64 bits
        n = n.astype(object)
    total = 0
    for level in reversed(range(int(code.max()).bit_length())):
        bit, group = code >> level & 1, code >> level + 1
        upto = np.cumsum(n * bit)
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        before = np.concatenate([[0], upto])[heads]
        size = np.diff(np.concatenate([heads, [len(code)]]))
        zero = bit == 0
        total += int(((upto - np.repeat(before, size))[zero] * n[zero]).sum())
        order = np.argsort(code >> level, kind="stable")
        code, n = code[order], n[order]
    return total


def _read(batches: Iterator[pa.RecordBatch], *names: str) -> list[np.ndarray]:
    held = [b for b in batches if b.num_rows]
    if not held:
        return [np.zeros(0)] * len(names)
    whole = pa.Table.from_batches(held)
    return [whole[c].to_numpy() for c in names]


def _grouped(*keys: np.ndarray, n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys and the sum of ``n`` of each."""
    order = np.lexsort(keys[::-1])
    keys, n = tuple(k[order] for k in keys), n[order]
    new = np.ones(len(n), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    heads = np.flatnonzero(new)
    return [k[heads] for k in keys], np.add.reduceat(n, heads) if len(heads) else n


def _along_x(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Inversions of one stretch, and its points counted by ``y``."""
    part, y, n = _read(batches, "part", "y", "n")
    if len(part):
        (values,), sums = _grouped(y, n=n)
        yield pa.record_batch({"part": pa.array(np.full(len(values), part[0], np.int64)), "y": pa.array(values, pa.float64()),
                               "n": pa.array(sums, pa.int64()), "found": pa.nulls(len(values), pa.string())})
        yield pa.record_batch({"part": pa.array([part[0]], pa.int64()), "y": pa.array([None], pa.float64()),
                               "n": pa.array([None], pa.int64()), "found": pa.array([str(inversions(y, n))])})


def _along_y(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Inversions between stretches of x inside one stretch of y, and the points of each pair of stretches."""
    part, y, n, place = _read(batches, "part", "y", "n", "place")
    if len(part):
        order = np.lexsort((y, part))
        (parts,), sums = _grouped(part, n=n)
        yield pa.record_batch({"part": pa.array(parts, pa.int64()), "y": pa.array(np.full(len(parts), place[0], float)),
                               "n": pa.array(sums, pa.int64()), "found": pa.nulls(len(parts), pa.string())})
        yield pa.record_batch({"part": pa.array([None], pa.int64()), "y": pa.array([None], pa.float64()),
                               "n": pa.array([None], pa.int64()), "found": pa.array([str(inversions(y[order], n[order]))])})


def _sum_of(counted: DataFrame) -> int:
    total = counted.agg(F.sum(F.col("found").cast("decimal(38,0)"))).first()[0]
    return int(total or 0)


def discordant_pairs(points: DataFrame, stretch: int = STRETCH) -> int:
    """Pairs of rows with the larger x and the smaller y, from distinct, written points (x double, y double, n long)."""
    total = 0
    while True:
        parts = -(-points.count() // stretch)
        if parts <= 1:
            last = points.repartition(1).sortWithinPartitions("x", "y").withColumn("part", F.lit(0).cast("long"))
            return total + _sum_of(last.mapInArrow(_along_x, _BY_STRETCH))
        along_x = (points.repartitionByRange(parts, "x", "y").sortWithinPartitions("x", "y")
                   .withColumn("part", F.spark_partition_id().cast("long")).select("part", "y", "n"))
        by_x = write_once(along_x.mapInArrow(_along_x, _BY_STRETCH), "by-x")
        cells = by_x.filter(F.col("found").isNull()).drop("found")
        along_y = cells.repartitionByRange(parts, "y", "part").withColumn("place", F.spark_partition_id().cast("long"))
        by_y = write_once(along_y.mapInArrow(_along_y, _BY_STRETCH), "by-y")
        total += _sum_of(by_x) + _sum_of(by_y)
        points = write_once(by_y.filter(F.col("found").isNull()).select(
            F.col("part").cast("double").alias("x"), "y", "n"), "by-both")


def _ties(n: str) -> dict[str, object]:
    """Pairs of equal rows and the two further sums of the tie-corrected variance."""
    t = F.col(n).cast("decimal(19,0)")
    one = F.lit(1).cast("decimal(1,0)")
    x = F.col(n).cast("double")
    return {"pairs": F.sum(t * (t - one)).cast("decimal(38,0)"), "t0": F.sum(x * (x - 1) * (x - 2)),
            "t1": F.sum(x * (x - 1) * (2 * x + 5))}


def _ranked(points: DataFrame, side: str) -> tuple[DataFrame, dict]:
    counts = write_once(points.groupBy(side).agg(F.sum("n").alias("m")), "value-counts")
    ties = counts.agg(*[c.alias(k) for k, c in _ties("m").items()]).first().asDict()
    return value_ranks(counts, side, "m", f"r{side}").drop("m"), ties


def row_association(df: DataFrame, x: str, y: str, methods: tuple[str, ...] = METHODS, stretch: int = STRETCH) -> DataFrame:
    """(method, r, p_value, significant, n_samples) of two columns over all rows that have both; NaN is missing.

    No rows where a side is constant or nothing is left. Kendall's tau is tau-b.
    """
    spark = df.sparkSession
    both = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(n) for c, n in ((x, "x"), (y, "y"))]).dropna()
    points = write_once(both.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")), "points")
    whole = points.agg(F.sum("n").alias("n"), *[(F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c) for c in "xy"],
                       _ties("n")["pairs"].alias("pairs")).first()
    n = whole["n"] or 0
    by_x, x_ties = _ranked(points, "x")
    by_y, y_ties = _ranked(points, "y")
    middle = (n + 1) / 2
    ranked = points.join(by_x, "x").join(by_y, "y")
    centred = {"x": F.col("x") - F.lit(whole["x"]), "y": F.col("y") - F.lit(whole["y"]),
               "rx": F.col("rx") - F.lit(middle), "ry": F.col("ry") - F.lit(middle)}
    moments = ranked.agg(*[F.sum(F.col("n") * centred[a] * centred[b]).alias(a + b) for a, b in
                           (("x", "x"), ("y", "y"), ("x", "y"), ("rx", "rx"), ("ry", "ry"), ("rx", "ry"))]).first()
    if not n or not moments["rxrx"] or not moments["ryry"]:
        return spark.createDataFrame([], "method string, r double, p_value double, significant boolean, n_samples bigint")
    pairs = n * (n - 1) // 2
    x_pairs, y_pairs, same = (int(v) // 2 for v in (x_ties["pairs"], y_ties["pairs"], whole["pairs"]))
    dis = discordant_pairs(points, stretch) if "kendall" in methods else 0
    s = pairs - x_pairs - y_pairs + same - 2 * dis
    rows = [("pearson", moments["xy"] / sqrt(moments["xx"] * moments["yy"])),
            ("spearman", moments["rxry"] / sqrt(moments["rxrx"] * moments["ryry"])),
            ("kendall", s / (sqrt(pairs - x_pairs) * sqrt(pairs - y_pairs)))]
    fields = {"n": n, "s": float(s), "dis": dis if n <= 33 else 0, "xtie": float(x_pairs), "ytie": float(y_pairs),
              "x0": x_ties["t0"], "x1": x_ties["t1"], "y0": y_ties["t0"], "y1": y_ties["t1"]}
    one = spark.createDataFrame([(m, r, *fields.values()) for m, r in rows if m in methods], "method string, r double, n bigint, s double, "
                                "dis bigint, xtie double, ytie double, x0 double, x1 double, y0 double, y1 double")
    if n <= 33:
        rank_p = kendall_p(*("n", "dis", "s", "xtie", "ytie", "x0", "x1", "y0", "y1"))
    else:
        m = f"({n}D * {n - 1}D)"
        var = (f"(({m} * {2 * n + 5}D - x1 - y1) / 18D + 2D * xtie * ytie / {m} + x0 * y0 / (9D * {m} * {n - 2}D))")
        rank_p = F.expr(normal_two_sided_p(f"(s / sqrt({var}))"))
    p = F.when(F.col("method") == "kendall", rank_p).otherwise(pearson_p("r", "n"))
    return one.withColumn("p_value", p).select("method", "r", "p_value", significant("p_value").alias("significant"),
                                               F.col("n").alias("n_samples"))
