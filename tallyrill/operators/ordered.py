"""Work along one total order of any length, without a window over the whole of it.

Rows are shuffled by range, sorted inside each part and written, so a part is a stretch of the order
and the order of the parts is that of their numbers. What one part must know of the others is
one small row each: how much came before it, or what value stood last. Frames that reach over the edge
of a stretch get copies of the few rows they reach.

Order keys should be distinct enough to split: a range shuffle keeps equal keys together.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tallyrill.operators.index import contiguous_index, running_totals, stretches
from tallyrill.scratch import write_once

CHUNK_ROWS = 200_000  # rows of one stretch in ``along_windows``
STRETCH_ROWS = 500_000  # rows of one stretch in ``nearest_in_order``, about: a range shuffle cuts by a sample


def value_ranks(counts: DataFrame, value: str, n: str, rank: str) -> DataFrame:
    """Written (value, n, rank) from counted values: ties share the mean of the ranks they take up."""
    totals = running_totals(counts, [value], n, "_before")
    return write_once(totals.select(value, n, (F.col("_before") + (F.col(n) + 1) / 2.0).alias(rank)), "value-ranks")


def average_ranks(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with the rank of ``column`` among all rows, ties sharing their mean rank; null where it is null.

    Equal values are counted before they move, so a value that a third of the rows hold is one row. The table
    of ranks has one row per distinct value; its stored size decides the join.
    """
    value = f"_{out}_value"
    counts = (df.groupBy(F.col(column).alias(value)).agg(F.count(F.lit(1)).alias("_n"))
              .filter(F.col(value).isNotNull()))
    ranks = value_ranks(counts, value, "_n", out).drop("_n")
    return df.join(ranks, F.col(column) == F.col(value), "left").drop(value)


def along_windows(df: DataFrame, order_by: list[str | Column], columns: dict[str, Callable[[WindowSpec], Column]],
                  behind: int, ahead: int = 0, position: str = "position", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Window columns over one series of any length: ``columns`` map a name to an expression over the given window.

    Frames may reach ``behind`` rows back and ``ahead`` rows on. The series is cut into stretches of
    ``chunk_rows``; the last ``behind`` rows of a stretch are also given to the next and the first ``ahead`` to the one
    before, so each stretch is worked out alone. ``position`` counts from 0.
    """
    if max(behind, ahead) > chunk_rows:
        raise ValueError("a frame may not be longer than a stretch")
    rows = contiguous_index(df, order_by, position)
    home, at = F.expr(f"{position} DIV {chunk_rows}"), F.col(position) % chunk_rows
    places = F.array_compact(F.array(
        home, F.when(at >= chunk_rows - behind, home + 1), F.when(at < ahead, home - 1)))
    dealt = rows.withColumn("_home", home).withColumn("_stretch", F.explode(places))
    along = Window.partitionBy("_stretch").orderBy(position)
    made = dealt.withColumns({name: make(along) for name, make in columns.items()})
    return made.filter(F.col("_stretch") == F.col("_home")).drop("_stretch", "_home")


def nearest_in_order(wanted: DataFrame, at: str, known: DataFrame, known_at: str, value: str, out: str,
                     direction: str = "nearest", stretch_rows: int = STRETCH_ROWS) -> DataFrame:
    """``wanted`` with the value of ``known`` whose time is nearest, the earlier one on ties; null without any.

    ``direction`` is ``nearest``, ``backward`` (the last one not after) or ``forward`` (the first one not before). Times
    are dates, timestamps or numbers. Of several values at one time
    the least counts; rows without a time find nothing. There is no key: the stretches of the merged order are
    filled alone, and each learns the last known value before it and the first one after it. Stretches keep their
    length of about ``stretch_rows`` however many rows there are, and a task fills one or two of them, so its memory does
    not grow with the tables.
    """
    if direction not in ("nearest", "backward", "forward"):
        raise ValueError(direction)
    kind = known.schema[known_at].dataType
    # written: both are counted, sampled for the order and moved
    wanted = write_once(wanted, "wanted")
    held = write_once(known.filter(F.col(known_at).isNotNull() & F.col(value).isNotNull()).groupBy(
        F.col(known_at).alias("_at")).agg(F.min(value).alias("_value")), "known")
    n_parts = max(2, math.ceil((wanted.count() + held.count()) / stretch_rows))
    asked = wanted.select(F.col(at).cast(kind).alias("_at"), F.struct(*[F.col(f"`{c}`") for c in wanted.columns]).alias("_row"))
    # Rows at one time may be cut anywhere, so that a time which many share is no single stretch.
    both = held.select("_at", F.struct("_at", "_value").alias("_known"), F.lit(0).cast("bigint").alias("_tie")).unionByName(
        asked.withColumn("_tie", F.monotonically_increasing_id() + 1), allowMissingColumns=True)
    parts = stretches(both.filter(F.col("_at").isNotNull()), ["_at", "_tie"], "merged-order", n_parts)

    # one row per written part: the known values at its two ends
    ends = sorted(parts.filter(F.col("_known").isNotNull()).groupBy("_part").agg(
        F.max("_known").alias("last"), F.min("_known").alias("first")).collect(), key=lambda r: r["_part"])
    held_by = {r["_part"]: r for r in ends}
    every = sorted(r["_part"] for r in parts.select("_part").distinct().collect())
    before, after, seen = {}, {}, None
    for p in every:
        before[p] = seen
        seen = held_by[p]["last"] if p in held_by else seen
    seen = None
    for p in reversed(every):
        after[p] = seen
        seen = held_by[p]["first"] if p in held_by else seen
    pair = parts.schema["_known"].dataType.simpleString()
    edges = parts.sparkSession.createDataFrame([(p, before[p], after[p]) for p in every], f"_part int, _b {pair}, _a {pair}")

    # two growing frames, one per direction; a known value at a row's own time counts for both
    grown = {"_back": F.col("_at").asc(), "_ahead": F.col("_at").desc()}
    filled = parts.repartitionByRange(n_parts, "_part").withColumns({
        name: F.last("_known", ignorenulls=True).over(
            Window.partitionBy("_part").orderBy(order).rangeBetween(Window.unboundedPreceding, 0))
        for name, order in grown.items()}).filter(F.col("_row").isNotNull())
    filled = filled.join(F.broadcast(edges), "_part").withColumns({
        "_back": F.coalesce("_back", "_b"), "_ahead": F.coalesce("_ahead", "_a")})
    # a known value at the same time may stand at the end of the stretch before
    filled = filled.withColumn("_ahead", F.when(F.col("_back._at") == F.col("_at"), F.col("_back")).otherwise(F.col("_ahead")))
    number = {"date": F.unix_date, "timestamp": F.unix_micros}.get(kind.simpleString(), F.col)
    to_back = number("_at") - number("_back._at")
    to_ahead = number("_ahead._at") - number("_at")
    picked = {
        "backward": F.col("_back._value"), "forward": F.col("_ahead._value"),
        "nearest": (F.when(F.col("_back").isNull(), F.col("_ahead._value")).when(F.col("_ahead").isNull(), F.col("_back._value"))
                    .when(to_back <= to_ahead, F.col("_back._value")).otherwise(F.col("_ahead._value"))),
    }[direction]
    found = filled.select("_row.*", picked.alias(out))
    without = wanted.filter(F.col(at).isNull()).withColumn(out, F.lit(None).cast(known.schema[value].dataType))
    return found.unionByName(without)
