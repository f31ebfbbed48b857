"""Identifiers for sales rows that arrive without them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrill.functions.scalar import numbered_id
from tallyrill.operators.index import contiguous_index, factorize, index_by_scan_order, running_totals
from tallyrill.sources.scan import SCAN_ORDER

POSITION = "_position"
LOCATION_BUCKET = 10
PLAIN_BUCKET = 5
CHUNK_ROWS = 20_000  # rows of one running count; a multiple of the location bucket
_POSITION_BITS, _UNDATED = 40, 1 << 22  # of ``date_key``: rows of a table, and a day later than any date


def with_position(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Input position; source order needs no shuffle."""
    if list(order_by) == list(SCAN_ORDER):
        return index_by_scan_order(df, POSITION)
    return contiguous_index(df, list(order_by), POSITION)


def with_transaction_id(df: DataFrame, position: str = POSITION) -> DataFrame:
    return df.withColumn("transaction_id", numbered_id("TXN", position))


def with_product_id(df: DataFrame, order_by: list[str], seen: DataFrame | None = None) -> DataFrame:
    """Numbered from 1 by first appearance of the name; rows without a name get 0.

    ``seen`` may name a written table of the same names and order, which is cheaper to look through.
    """
    return factorize(df, "product_name", order_by, "product_id", seen).withColumn(
        "product_id", F.col("product_id") + 1)


def by_date(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Number the rows along the date as ``_dated``, undated rows last, ties in the given order."""
    return contiguous_index(df, [F.col("date").asc_nulls_last(), *order_by], "_dated")


def customer_id_from_location(dated: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Numbered from 1 by first appearance of (location, block of ten rows along the date).

    Blocks are consecutive positions, so a code is the number of pairs that first appeared
    earlier: whole pairs before the row's chunk of positions, plus a running count inside it.
    No group is larger than one chunk, whatever the dates and locations.
    """
    rows = dated.withColumns({
        "_place": _place(),
        "_block": F.expr(f"_dated DIV {LOCATION_BUCKET}"),
        "_chunk": F.expr(f"_dated DIV {chunk_rows}"),
    })
    offsets = _pairs_before(rows)

    # both windows run on one sort: blocks follow each other along the date
    in_block = Window.partitionBy("_chunk", "_block").orderBy("_dated").rowsBetween(Window.unboundedPreceding, 0)
    in_chunk = Window.partitionBy("_chunk").orderBy("_block", "_dated").rowsBetween(Window.unboundedPreceding, 0)
    listed = rows.repartition("_chunk").withColumn("_places", F.collect_list("_place").over(in_block))
    first_at = F.array_position("_places", F.col("_place")).cast("int")
    opened = listed.withColumn("_seen", F.sum((first_at == F.size("_places")).cast("bigint")).over(in_chunk))
    before_block = F.col("_seen") - F.size(F.array_distinct("_places"))
    local = before_block + F.size(F.array_distinct(F.slice("_places", F.lit(1), first_at)))
    return (opened.join(offsets, "_chunk")
            .withColumn("customer_id", F.col("_offset") + local)
            .drop("_place", "_block", "_chunk", "_places", "_seen", "_offset"))


def _place() -> Column:
    return F.coalesce(F.col("location").cast("string"), F.lit("nan"))


def _pairs_before(rows: DataFrame) -> DataFrame:
    """(_chunk, _offset): distinct pairs of block and place in all earlier chunks."""
    # a block lies in one or two written files, so most of the distinct happens before the shuffle
    pairs = rows.select("_chunk", "_block", "_place").distinct()
    per_chunk = pairs.groupBy("_chunk").agg(F.count(F.lit(1)).alias("_pairs"))
    return running_totals(per_chunk, ["_chunk"], "_pairs", "_offset").select("_chunk", "_offset")


def customer_id_from_order(dated: DataFrame) -> DataFrame:
    """Five consecutive rows along the date share a customer."""
    return dated.withColumn("customer_id", F.expr(f"_dated DIV {PLAIN_BUCKET} + 1"))


def date_key(position: str = POSITION) -> Column:
    """One number that orders rows by date, undated ones last, and by position inside a date."""
    day = F.coalesce(F.unix_date("date"), F.lit(_UNDATED)).cast("bigint")
    return day * F.lit(1 << _POSITION_BITS) + F.col(position)


def customer_id_by_position(placed: DataFrame, position: str = POSITION, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``with_customer_id`` of rows numbered by ``position``, along the date and that position.

    Whole rows move once. Only their keys and places are ordered, written and numbered; the key of every
    ``chunk_rows``-th row, one number per chunk, tells each row its chunk, and as a chunk is so many rows exactly, a
    row's number along the date is its place in the chunk added to those before.
    """
    if chunk_rows % LOCATION_BUCKET:
        raise ValueError("a chunk holds whole blocks")
    located = "location" in placed.columns
    slim = contiguous_index(placed.select(date_key(position).alias("_key"), *([_place().alias("_place")] if located else [])),
                            ["_key"], "_dated")
    starts = np.array(sorted(r["_key"] for r in slim.filter(
        (F.col("_dated") % chunk_rows == 0) & (F.col("_dated") > 0)).select("_key").collect()), dtype="int64")

    @F.pandas_udf("bigint")
    def chunk_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, key.to_numpy(), side="right"))

    # the key holds the position, so that does not move beside it
    dealt = placed.withColumn("_key", date_key(position)).drop(position).withColumn("_chunk", chunk_of("_key"))

    def complete(numbered: DataFrame) -> DataFrame:
        return (numbered.withColumn(position, F.col("_key").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
                .select(*placed.columns, "customer_id"))

    if not located:
        at = F.row_number().over(Window.partitionBy("_chunk").orderBy("_key")) - 1
        numbered = dealt.withColumn("_dated", F.col("_chunk") * chunk_rows + at)
        return complete(customer_id_from_order(numbered))

    offsets = _pairs_before(slim.select("_place", F.expr(f"_dated DIV {LOCATION_BUCKET}").alias("_block"),
                                        F.expr(f"_dated DIV {chunk_rows}").alias("_chunk")))
    # the sum runs along the rows as they are sorted; it is marked as depending on that, so the sort is kept
    local = F.pandas_udf(_places_so_far, "bigint").asNondeterministic()
    counted = (dealt.repartition("_chunk").sortWithinPartitions("_chunk", "_key")
               .withColumn("_local", local("_chunk", _place())))
    return complete(counted.join(offsets, "_chunk").withColumn("customer_id", F.col("_offset") + F.col("_local")))


def _places_so_far(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Of sorted rows (chunk, place): places opened in the chunk when the row's place was first in its block of ten."""
    reach = LOCATION_BUCKET - 1
    chunks, places, seen = np.full(reach, -1), np.full(reach, "", dtype=object), np.zeros(reach, dtype="int64")
    last_at = -1  # place of the last row in its chunk
    for chunk, place in batches:
        # the last rows before the batch stand in front of it: no block reaches further back
        n = len(chunk)
        chunks = np.concatenate([chunks[-reach:], chunk.to_numpy()])
        places = np.concatenate([places[-reach:], place.to_numpy(dtype=object)])
        row = np.arange(n)
        opens = chunks[reach:] != chunks[reach - 1:-1]
        start = np.maximum.accumulate(np.where(opens, row, -1 - last_at))
        at = row - start
        code = pd.factorize(places)[0]
        back = np.zeros(n, dtype="int64")  # how far back in its block a place stood first, 0 where it opens
        for j in range(1, LOCATION_BUCKET):
            back[(at % LOCATION_BUCKET >= j) & (code[reach:] == code[reach - j:len(code) - j])] = j
        total = np.cumsum(back == 0)
        base = np.where(start < 0, -seen[-1], np.concatenate([[0], total])[np.maximum(start, 0)])
        seen = np.concatenate([seen[-reach:], total - base])
        last_at = int(at[-1]) if n else last_at
        yield pd.Series(seen[reach + row - back])


def with_customer_id(dated: DataFrame) -> DataFrame:
    if "location" in dated.columns:
        return customer_id_from_location(dated)
    return customer_id_from_order(dated)


def with_row_keys(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Transaction and product ids where absent, and the order that decides which row is first.

    Without customer ids the rows end up numbered along the date as ``_dated``. Rows are numbered,
    and the result reads from a written copy, only where an id asks for it.
    """
    have, out, order = set(df.columns), df, list(order_by)
    if "transaction_id" not in have:
        out, order = with_transaction_id(with_position(df, order_by)), [POSITION]
    if "product_id" not in have and "product_name" in have:
        out = with_product_id(out, order)
    return out if "customer_id" in have else by_date(out, order)


def first_row_order(columns: list[str], order_by: list[str]) -> list[str]:
    return next(([c] for c in ("_dated", POSITION) if c in columns), list(order_by))


def all_by_position(df: DataFrame) -> bool:
    """Whether transactions and customers are both to be numbered, the latter along days."""
    return not {"transaction_id", "customer_id"} & set(df.columns) and dict(df.dtypes).get("date") == "date"


def with_ids_by_position(placed: DataFrame) -> DataFrame:
    """Absent ids of rows with ``POSITION`` for which ``all_by_position`` holds; ids are added once the rows have moved."""
    rows = with_transaction_id(customer_id_by_position(placed))
    if "product_id" not in placed.columns and "product_name" in placed.columns:
        rows = with_product_id(rows, [POSITION], placed)
    return rows.select(*[c for c in rows.columns if c != "customer_id"], "customer_id")


def with_sales_keys(df: DataFrame, order_by: list[str]) -> DataFrame:
    """Add whichever of the three ids is absent."""
    if all_by_position(df):
        return with_ids_by_position(with_position(df, order_by)).drop(POSITION)
    rows = with_row_keys(df, order_by)
    rows = rows if "customer_id" in rows.columns else with_customer_id(rows)
    return rows.drop("_dated", POSITION)
