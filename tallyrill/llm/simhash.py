"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits; two fingerprints are linked when at most ``radius`` bits differ. Every
bit position gets a non-zero code of ``radius + 1`` bits, and every non-zero vector v of that length
gives one table: its mask keeps the positions whose code has an odd product with v. Any ``radius``
codes are annihilated by some v, so two fingerprints within the radius agree under at least one of
the ``2^(radius+1) - 1`` masks: no link is lost, whatever the data.

Work is done per distinct fingerprint, so copies cost one row. Buckets of two are compared where
they are counted. Larger buckets are cut by a hash into chunks of about ``CHUNK`` fingerprints, and
every pair of chunks is one task's work; it returns a spanning forest of its links, never all pairs.
All buckets are compared whole.

Defined cases: a null or empty text, or one without words, has fingerprint zero, which is linked
like any other. Null ids get the component of their fingerprint (null where no row reachable from
it has an id). Repeated rows give repeated results. Other columns are ignored. Very long texts are
hashed whole, a bounded number of shingles at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyrill.llm.common import text_batches, words_of, write_once
from tallyrill.llm.components import components

SHINGLE = 4
RADIUS = 4
CHUNK = 4096
_STEP = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of a whole text: a bit is 1 where over half of the shingle hashes have it."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()
    if len(words) < shingle:
        spans = [(0, len(joined))]
    else:
        spans = list(zip(starts, ends[shingle - 1:]))
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(spans), _STEP):
        h = np.array([digest(joined[a:b], 42) for a, b in spans[i:i + _STEP]], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * ones > len(spans))
    return sum(1 << int(b) for b in set_bits)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                 row_key: str | None = None) -> DataFrame:
    """``doc_id``, ``fp``, and the column ``row_key``: one row per document, the fingerprint as a signed long."""
    text_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t if isinstance(t, str) else None, shingle) for t in texts],
                                  np.uint64).astype(np.int64))

    own = [F.col(f"`{row_key}`")] if row_key else []
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("t"), *own)
    return rows.select("doc_id", of("t").alias("fp"), *own)


def masks(radius: int = RADIUS) -> list[int]:
    """One 64-bit mask per table."""
    vectors = range(1, 1 << (radius + 1))
    codes = [i % len(vectors) + 1 for i in range(64)]
    return [sum(1 << i for i, c in enumerate(codes) if (c & v).bit_count() % 2) for v in vectors]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(group: np.ndarray, side: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join whatever is linked between the two sides, at most one less than there are members."""
    first, second = group[side != 1], group[side != 0]
    values = np.unique(group)
    root = np.arange(len(values))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    out = []
    where = np.searchsorted(values, second)
    for x in first:
        near = where[np.bitwise_count(second ^ x) <= radius]
        i = find(int(np.searchsorted(values, x)))
        for j in near.tolist():
            k = find(j)
            if k != i:
                root[k] = i
                out.append((int(values[j]), int(x)))
    return out


def _groups(parts: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Walk rows sorted by group; a group may reach over several batches."""
    held: pd.DataFrame | None = None

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        g = part["g"].to_numpy()
        fp = part["fp"].to_numpy().view(np.uint64)
        side = part["side"].to_numpy()
        cuts = np.flatnonzero(np.diff(g)) + 1
        links = []
        for a, b in zip([0, *cuts], [*cuts, len(g)]):
            links += _forest(fp[a:b], side[a:b], radius)
        return pd.DataFrame(np.array(links, np.uint64).astype(np.int64).reshape(-1, 2), columns=["a", "b"])

    for part in parts:
        held = part if held is None else pd.concat([held, part], ignore_index=True)
        last = held["g"].iloc[-1]
        done = held["g"].to_numpy() != last
        if done.any():
            yield solve(held[done])
            held = held[~done]
    if held is not None and len(held):
        yield solve(held)


def links(distinct: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Links ``a``, ``b`` between fingerprints: a spanning set of all pairs within the radius.

    ``distinct`` holds every fingerprint once, in column ``fp``.
    """
    keys = F.explode(F.array(*[F.struct(F.lit(t).cast("short").alias("t"),
                                        F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("k"))
                               for t, m in enumerate(masks(radius))])).alias("e")
    dealt = distinct.select("fp", keys).select("fp", "e.t", "e.k")
    buckets = write_once(dealt.groupBy("t", "k").agg(F.count("*").alias("n"), F.min("fp").alias("a"),
                                                    F.max("fp").alias("b")).where("n > 1"), "buckets")
    pairs = (buckets.where("n = 2").select("a", "b").distinct()
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
    large = buckets.where("n > 2").select("t", "k", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    member = dealt.join(large, ["t", "k"]).withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    # Side 0 meets side 1; side 2 is a chunk compared within itself.
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("o")
    member = member.select("fp", "t", "k", "c", other).select(
        "fp", F.xxhash64("t", "k", F.least("c", "o"), F.greatest("c", "o")).alias("g"),
        F.when(F.col("c") == F.col("o"), 2).when(F.col("c") < F.col("o"), 0).otherwise(1).alias("side"))
    # Two groups that share a hash would only be compared with each other as well: links stay right.
    near = (member.repartition("g").sortWithinPartitions("g")
            .mapInPandas(lambda parts: _groups(parts, radius), "a long, b long"))
    return pairs.unionAll(near).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, row_key: str | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    With ``row_key``, a column of ``docs``, that column and ``root``: the same number for all rows of a
    component, also where none of them has an id.
    """
    rows = write_once(fingerprints(docs, doc_id, text, shingle, row_key), "fingerprints")
    classes = write_once(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    reached = components(links(classes.select("fp"), radius))
    # The least fingerprint stands for a component; its least document is the component's id.
    grouped = classes.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = write_once(grouped.join(ids, "root").select("fp", "component_id", "root"), "classes")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        *([F.col(f"`{row_key}`"), F.col("root")] if row_key else []))

