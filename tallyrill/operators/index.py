"""Contiguous row numbers, running totals and first-appearance codes without a single-partition window."""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrill.scratch import write_once
from tallyrill.sources.scan import SCAN_ORDER

_SEQ_BITS = 33  # monotonically_increasing_id: partition above, position in partition below


def from_list(values: list, at: Column, kind: str = "bigint") -> Column:
    """The entry of a driver-side list at position ``at`` (from 0), as part of the expression: rows meet no join.

    The list is folded to one literal when the plan is made. Lists here have one entry per written partition or
    input split, as many as there are tasks.
    """
    return F.element_at(F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), f"array<{kind}>"), (at + 1).cast("int"))


def starts_of(sizes: list[tuple[int, int]]) -> list[int]:
    """Total of all partitions before each one, from (partition, size) of those that hold rows."""
    held = dict(sizes)
    return list(accumulate((held.get(p, 0) for p in range(max(held, default=0))), initial=0))


def contiguous_index(df: DataFrame, order_by: list[str | Column], out: str = "row_idx") -> DataFrame:
    """0, 1, 2, ... along ``order_by``.

    One range shuffle on the order key (a composite, total order spreads any hot leading value),
    a local sort, and a written copy that fixes each row's partition and position. The sizes of
    the written partitions, one row each, give the offsets.
    """
    return numbered_in_place(df.repartitionByRange(*order_by).sortWithinPartitions(*order_by), out)


def numbered_in_place(df: DataFrame, out: str = "row_idx") -> DataFrame:
    """0, 1, 2, ... in the order in which ``df`` yields its rows, as after ``orderBy``."""
    kept = write_once(df.withColumn("_seq", F.monotonically_increasing_id()), "ordered-rows")
    part = F.shiftright("_seq", _SEQ_BITS)
    # one row per shuffle partition of the ordered copy: read off once, so that no later use of
    # the numbered rows counts them again
    sizes = [tuple(r) for r in kept.groupBy(part).agg(F.count(F.lit(1))).collect()]
    local = F.col("_seq").bitwiseAND(F.lit((1 << _SEQ_BITS) - 1))
    return kept.withColumn(out, from_list(starts_of(sizes), part) + local).drop("_seq")


def stretches(df: DataFrame, order_by: list[str | Column], label: str, parts: int | None = None) -> DataFrame:
    """The written rows with ``_part``, the number of their stretch of the order.

    Without ``parts`` the session decides how long a stretch is.
    """
    dealt = df.repartitionByRange(*order_by) if parts is None else df.repartitionByRange(parts, *order_by)
    ordered = dealt.sortWithinPartitions(*order_by)
    return write_once(ordered.withColumn("_part", F.spark_partition_id()), label)


def running_totals(df: DataFrame, order_by: list[str], amount: str, out: str) -> DataFrame:
    """``out``: the sum of the whole-number column ``amount`` over all rows before this one.

    Rows must differ in ``order_by``.
    """
    parts = stretches(df, order_by, "running-totals")
    # one row per written part
    sums = [tuple(r) for r in parts.groupBy("_part").agg(F.sum(amount)).collect()]
    inside = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    before = from_list(starts_of(sums), F.col("_part")) + F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return parts.withColumn(out, before).drop("_part")


def by_number(name: str) -> Column:
    """Text whose order is that of ``name`` with its numbers compared by value: each padded to 20 digits."""
    padded = F.regexp_replace(name, r"(\d+)", "0" * 20 + "$1")
    return F.regexp_replace(padded, r"\d*(\d{20})", "$1")


def index_by_scan_order(df: DataFrame, out: str = "row_idx") -> DataFrame:
    """0, 1, 2, ... along the source position of ``with_scan_order``.

    Splits of the input are counted and summed up in file order, numbers in file names by their value; the sums run
    over stretches of the splits, not in one task. A row carries the task that scanned it and its place there, so
    what its split adds is looked up by the task: rows are neither shuffled nor joined, however many splits there are.
    """
    file_, block, seq = SCAN_ORDER
    kept = write_once(df, "scanned-rows")
    splits = kept.groupBy(file_, block).agg(F.count(F.lit(1)).alias("_size"), F.min(seq).alias("_first"))
    named = splits.withColumn("_name", by_number(file_))
    totals = running_totals(named, ["_name", file_, block], "_size", "_offset")
    # a task reads one large split or some small files one after the other: (place of the first row, what to add)
    by_task: dict[int, list[dict[str, int]]] = {}
    for first, offset in sorted(tuple(r) for r in totals.select("_first", "_offset").collect()):
        task, place = first >> _SEQ_BITS, first & ((1 << _SEQ_BITS) - 1)
        by_task.setdefault(task, []).append({"p": place, "d": offset - place})
    runs = from_list([by_task.get(t, []) for t in range(max(by_task, default=-1) + 1)], F.shiftright(seq, _SEQ_BITS),
                     "array<struct<p: bigint, d: bigint>>")
    local = F.col(seq).bitwiseAND(F.lit((1 << _SEQ_BITS) - 1))
    added = F.element_at(F.filter(runs, lambda r: r["p"] <= local), -1)["d"]
    return kept.withColumn(out, local + added).drop(*SCAN_ORDER)


def first_appearance_codes(df: DataFrame, value: str, order_by: list[str]) -> DataFrame:
    """(value, code): distinct non-null values numbered from 0 by their first row along ``order_by``."""
    # the minimum of one number is a hash aggregate; that of a struct sorts every row
    first = F.min(order_by[0]) if len(order_by) == 1 else F.min(F.struct(*order_by))
    firsts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(first.alias("_first"))
    return write_once(contiguous_index(firsts, ["_first"], "code").drop("_first"), "codes")


def factorize(df: DataFrame, value: str, order_by: list[str], out: str, seen: DataFrame | None = None) -> DataFrame:
    """Attach the first-appearance code of ``value``, as found in ``seen`` where given; null gets -1.

    The code table holds one row per distinct value, collapsed before the shuffle. It is a written
    table whose stored size decides the join, with adaptive splitting of hot values.
    """
    codes = first_appearance_codes(df if seen is None else seen, value, order_by).withColumnRenamed("code", out)
    return (df.join(codes, value, "left")
            .withColumn(out, F.coalesce(out, F.lit(-1).cast("bigint"))))
