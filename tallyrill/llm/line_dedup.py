"""Line de-duplication with a suffix array over line ids, built by distributed prefix doubling.

A line's id is a hash of its text without surrounding blanks; blank lines have no id and always
stay. A suffix is the rest of a document from one line on. Only lines that occur twice or more can
start a repeat, so suffixes are sorted within the stretches of such lines ("islands"), which are a
small part of a corpus. Round k sorts suffixes by their first 2^k lines: the pair (rank here, rank
2^(k-1) lines on) is counted, the distinct pairs are sorted over the whole cluster, and a running
count of suffixes gives the next rank. A hot pair is one row of that sort, however many suffixes
share it.

A repeat counts when its lines hold at least ``min_chars`` characters. For a suffix that is its
first ``need`` lines, the fewest that hold so many, and suffixes whose longest common prefix reaches
that far form one interval of the sorted array: they share ``need`` and the ranks of the two
(overlapping) powers of two that cover it. Sorting deeper would not change these intervals, so the
doubling ends at the largest ``need``. Within an interval the first suffix in document order stays;
the first ``need`` lines of every other are deleted. Overlapping deletions merge. Alone, this leaves the end of a
maximal repeated run in place where the last lines hold under ``min_chars`` characters.

With ``whole_runs`` the mirrored windows count too: for every line the fewest lines that end at it and
hold ``min_chars``. A line of a repeated run of ``min_chars`` characters or more lies in a window that
starts or in one that ends within the run, so maximal repeated runs of any length go as a whole;
the registered query and the pipeline ask for that. A
mirrored window is a run like any other, and the ranks at hand tell it apart without more sorting.

Defined cases: a null text has no lines and stays null. Documents that share id and text are one
document and are cleaned alike. Null ids come last in document order. A one-line repeat inside a
document counts. Empty tables give empty results. Other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyrill.llm.common import unused, write_once

MIN_CHARS = 20


def _line_hash(c: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes."""
    return F.xxhash64(c), F.xxhash64(F.lit(7), c, F.lit(11))


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``d``, ``v`` (document), ``i`` (line, from 0), ``p`` (number among lines with text), ``h1``, ``h2``, ``size``."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("d"), F.xxhash64(F.col(f"`{text}`")).alias("v"),
                       F.split(F.col(f"`{text}`").cast("string"), "\n").alias("lines"))
    trimmed = F.transform("lines", lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(" \t\r")).alias("line")))
    rows = rows.select("d", "v", F.posexplode(F.filter(trimmed, lambda s: s["line"] != "")).alias("p", "s"))
    h1, h2 = _line_hash(F.col("s.line"))
    return rows.select("d", "v", "s.i", "p", h1.alias("h1"), h2.alias("h2"), F.length("s.line").alias("size"))


def _ranked(pairs: DataFrame) -> DataFrame:
    """``a``, ``b``, ``rank``: one more than the number of suffixes whose pair sorts before.

    Pairs are sorted by range over the cluster and written; a running sum within each written range
    and the sums of the ranges before it make the rank.
    """
    cut = write_once(pairs.repartitionByRange("a", "b").sortWithinPartitions("a", "b")
                     .withColumn("part", F.spark_partition_id()), "pairs")
    totals = cut.groupBy("part").agg(F.sum("n").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per written range
    totals = totals.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("part").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    return (cut.withColumn("own", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(totals, "part")
            .select("a", "b", (F.col("ahead") + F.col("own") + 1).alias("rank")))


def _fewest(sizes: str, min_chars: int) -> Column:
    """How many of the first sizes make ``min_chars`` (``n``) and their sum (``sum``); all where they do not."""
    return F.aggregate(sizes, F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum")),
                       lambda s, x: F.when(s["sum"] >= min_chars, s).otherwise(
                           F.struct((s["n"] + 1).alias("n"), (s["sum"] + x).alias("sum"))))


def _ranks_of(size: str, top: int, at: Callable[[str, int], Column], steps: Callable[[int, int], tuple[int, int]]):
    """Ranks of the two powers of two lines that cover a window of ``size`` lines, each so many ``steps`` away."""
    first, second = F.lit(None).cast("long"), F.lit(None).cast("long")
    for n in range(1, max(top, 1) + 1):
        k = n.bit_length() - 1
        one, two = (at(f"rank{k}", s) if s else F.col(f"rank{k}") for s in steps(n, 1 << k))
        first, second = F.when(F.col(size) == n, one).otherwise(first), F.when(F.col(size) == n, two).otherwise(second)
    return first, second


def intervals(lines: DataFrame, min_chars: int = MIN_CHARS, whole_runs: bool = False) -> DataFrame:
    """Suffixes that can start a repeat: ``d``, ``v``, ``i``, ``need``, ``own`` (their first lines), ``r1``, ``r2``.

    Equal (need, r1, r2) means a longest common prefix of at least ``need`` lines. With ``whole_runs`` there is
    another row for every line at which a window ends that is not the shortest from its start.
    """
    placed = lines.withColumn("at", F.xxhash64("d", "v", "i"))
    repeated = (placed.groupBy("h1", "h2").agg(F.min("at").alias("x"), F.max("at").alias("y"))
                .where("x <> y").select("h1", "h2"))
    live = lines.join(repeated, ["h1", "h2"], "left_semi").dropDuplicates(["d", "v", "i"])
    # Islands: live lines that follow each other without another line of text between them.
    live = live.withColumn("island", F.col("p") - F.row_number().over(Window.partitionBy("d", "v").orderBy("p")))
    island = Window.partitionBy("d", "v", "island").orderBy("p")
    ahead = island.rowsBetween(Window.currentRow, min_chars - 1)  # a line has one character at least
    rows = live.withColumn("sizes", F.collect_list("size").over(ahead)).withColumn("own", F.collect_list("i").over(ahead))
    kept = ["d", "v", "i", "p", "island", "h1", "h2", F.col("fill.n").alias("need"),
            F.slice("own", 1, F.col("fill.n")).alias("own"), (F.col("fill.sum") >= min_chars).alias("whole")]
    if whole_runs:
        behind = island.rowsBetween(1 - min_chars, Window.currentRow)
        rows = (rows.withColumn("back_sizes", F.reverse(F.collect_list("size").over(behind)))
                .withColumn("back_own", F.reverse(F.collect_list("i").over(behind)))
                .withColumn("back", _fewest("back_sizes", min_chars)))
        # Without its last line it must still hold ``min_chars``, or it is the shortest from its start, too.
        ends = (F.col("back.sum") - F.col("size") >= min_chars).alias("ends")
        kept += [F.col("back.n").alias("back"), F.when(ends, F.slice("back_own", 1, F.col("back.n"))).alias("back_own"), ends]
    rows = write_once(rows.withColumn("fill", _fewest("sizes", min_chars)).select(*kept), "suffixes")
    top = rows.where("whole").agg(F.max("need").alias("n")).first()["n"] or 0
    if whole_runs:
        top = max(top, rows.where("ends").agg(F.max("back").alias("n")).first()["n"] or 0)
    ranks = _ranked(rows.groupBy(F.col("h1").alias("a"), F.col("h2").alias("b")).agg(F.count("*").alias("n")))
    now = rows.join(ranks.withColumnsRenamed({"a": "h1", "b": "h2", "rank": "rank0"}), ["h1", "h2"]).drop("h1", "h2")
    k = 0
    while 2 << k <= top:  # until two powers of two cover the largest ``need``
        now = write_once(now, "ranks")
        follow = F.coalesce(F.lead(f"rank{k}", 1 << k).over(island), F.lit(0))  # 0: the island ends
        pairs = now.withColumn("a", F.col(f"rank{k}")).withColumn("b", follow)
        ranks = _ranked(pairs.groupBy("a", "b").agg(F.count("*").alias("n")))
        now = pairs.join(ranks, ["a", "b"]).drop("a", "b").withColumnRenamed("rank", f"rank{k + 1}")
        k += 1
    forward = _ranks_of("need", top, lambda rank, n: F.lead(rank, n).over(island), lambda n, span: (0, n - span))
    now = now.withColumn("r1", forward[0]).withColumn("r2", forward[1])
    if not whole_runs:
        return write_once(now.where("whole").select("d", "v", "i", "need", "own", "r1", "r2"), "intervals")
    back = _ranks_of("back", top, lambda rank, n: F.lag(rank, n).over(island), lambda n, span: (n - 1, span - 1))
    now = now.withColumn("b1", back[0]).withColumn("b2", back[1])
    windows = F.filter(F.array(
        F.when(F.col("whole"), F.struct("i", "need", "own", "r1", "r2")),
        F.when(F.col("ends"), F.struct(F.element_at("back_own", -1).alias("i"), F.col("back").alias("need"),
                                       F.col("back_own").alias("own"), F.col("b1").alias("r1"), F.col("b2").alias("r2")))),
        lambda w: w.isNotNull())
    return write_once(now.select("d", "v", F.explode(windows).alias("w")).select("d", "v", "w.*"), "intervals")


def later_copies(lines: DataFrame, min_chars: int = MIN_CHARS, whole_runs: bool = False) -> DataFrame:
    """``d``, ``v``, ``gone``: the line numbers to delete from each document that loses any."""
    found = intervals(lines, min_chars, whole_runs)
    key = ["need", "r1", "r2"]
    last = (1 << 63) - 1
    # The first suffix of an interval: least document, then least line, then least text hash.
    found = found.withColumn("o", F.coalesce("d", F.lit(last)))
    least = found.groupBy(*key).agg(F.min("o").alias("o"), F.count("*").alias("n")).where("n > 1").drop("n")
    # Line and text hash as one number, so that its minimum needs no sorting of rows.
    spot = found.withColumn("spot", F.expr(
        "cast(i as decimal(11,0)) * cast(20000000000000000000 as decimal(20,0)) + cast(v as decimal(20,0))"))
    first = spot.join(least, [*key, "o"]).groupBy(*key).agg(F.min("o").alias("o1"), F.min("spot").alias("spot1"))
    later = spot.join(first, key).where("o <> o1 or spot <> spot1")
    return later.select("d", "v", F.explode("own").alias("line")).groupBy("d", "v").agg(F.collect_set("line").alias("gone"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                whole_runs: bool = False) -> DataFrame:
    """``docs`` with later copies of repeated runs cut from ``text``; adds ``n_lines`` and ``removed`` (line numbers)."""
    gone = later_copies(_lines(docs, doc_id, text), min_chars, whole_runs)
    names = docs.columns
    d, v, d2, v2, lost = (unused(docs, n) for n in ("_d", "_v", "_d2", "_v2", "_gone"))
    whole = docs.withColumns({d: F.col(f"`{doc_id}`").cast("long"), v: F.xxhash64(F.col(f"`{text}`"))})
    gone = gone.select(F.col("d").alias(d2), F.col("v").alias(v2), F.array_sort("gone").alias(lost))
    whole = whole.join(gone, F.col(d).eqNullSafe(F.col(d2)) & (F.col(v) == F.col(v2)), "left")
    lines = F.split(F.col(f"`{text}`").cast("string"), "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost))
    cut = F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")
    cells = [F.when(F.col(lost).isNull(), F.col(f"`{text}`")).otherwise(cut).alias(text) if c == text
             else F.col(f"`{c}`") for c in names if c not in ("n_lines", "removed")]
    count = F.when(F.col(f"`{text}`").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines")
    return whole.select(*cells, count, F.coalesce(lost, F.array().cast("array<int>")).alias("removed"))
