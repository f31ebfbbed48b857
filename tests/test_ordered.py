"""Work along one order of facts, against plain Python over the whole series."""

import bisect
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyrill.operators import index, ordered, row_association
from tallyrill.sources import scan


def ranks_of(values):
    s = sorted(values)
    return [(bisect.bisect_left(s, v) + bisect.bisect_right(s, v) + 1) / 2 for v in values]


def test_average_ranks_of_rows(spark):
    rng = random.Random(1)
    values = [rng.choice([0.0, 7.5, float(rng.randrange(40)), None]) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(values)), "i long, v double").repartition(6)
    got = {r.i: r.rank for r in ordered.average_ranks(df, "v", "rank").collect()}
    known = [i for i, v in enumerate(values) if v is not None]
    want = dict(zip(known, ranks_of([values[i] for i in known])))
    assert got == {i: want.get(i) for i in range(3000)}


def test_running_totals(spark):
    df = spark.range(1, 2000).select((F.col("id") * 7919 % 2003).alias("k"), (F.col("id") % 5).alias("n")).repartition(5)
    rows = sorted(df.collect())
    want = dict(zip((r.k for r in rows), np.cumsum([0] + [r.n for r in rows])[:-1].tolist()))
    assert {r.k: r.before for r in ordered.running_totals(df, ["k"], "n", "before").collect()} == want


@pytest.mark.parametrize("chunk", [7, 50, 100_000])
def test_windows_reach_over_stretches(spark, chunk):
    rng = random.Random(2)
    values = [rng.random() for _ in range(301)]
    df = spark.createDataFrame([(i * 3 % 301, v) for i, v in enumerate(values)], "k long, v double").repartition(4)
    out = ordered.along_windows(df, ["k"], {
        "lag3": lambda w: F.lag("v", 3).over(w), "next2": lambda w: F.lead("v", 2).over(w),
        "sum7": lambda w: F.sum("v").over(w.rowsBetween(-6, 0))}, behind=6, ahead=2, chunk_rows=chunk)
    rows = sorted(out.collect(), key=lambda r: r.position)
    line = [r.v for r in sorted(df.collect())]
    assert [r.position for r in rows] == list(range(301)) and [r.v for r in rows] == line
    for i, r in enumerate(rows):
        assert r.lag3 == (line[i - 3] if i >= 3 else None) and r.next2 == (line[i + 2] if i + 2 < 301 else None)
        assert r.sum7 == pytest.approx(sum(line[max(0, i - 6):i + 1]))


def test_no_task_sorts_a_whole_series(spark):
    df = spark.range(50).selectExpr("id AS k", "cast(id % 7 AS double) AS v", "timestamp_seconds(id) AS at")
    frames = [ordered.average_ranks(df, "v", "rank"), ordered.running_totals(df, ["k"], "k", "before"),
              ordered.along_windows(df, ["k"], {"l": lambda w: F.lag("v").over(w)}, behind=1),
              ordered.nearest_in_order(df, "at", df, "at", "v", "out")]
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan


def test_a_frame_fits_its_stretch(spark):
    with pytest.raises(ValueError):
        ordered.along_windows(spark.range(5), ["id"], {}, behind=10, chunk_rows=9)


@pytest.mark.parametrize("direction", ["nearest", "backward", "forward"])
@pytest.mark.parametrize("known_times", [[], [50], sorted(random.Random(3).sample(range(0, 4000, 3), 200)), [10] * 5 + [3000]])
def test_nearest_in_order(spark, direction, known_times):
    rng = random.Random(4)
    asked = [rng.choice([10, 10, 10, rng.randrange(-50, 4050)]) for _ in range(900)] + [None]
    start = dt.datetime(2024, 1, 1)
    left = spark.createDataFrame([(i, None if t is None else start + dt.timedelta(seconds=t)) for i, t in enumerate(asked)],
                                 "i long, at timestamp").repartition(5)
    right = spark.createDataFrame([(start + dt.timedelta(seconds=t), float(t)) for t in known_times], "t timestamp, v double")
    got = {r.i: r.v for r in ordered.nearest_in_order(left, "at", right, "t", "v", "v", direction).collect()}
    for i, t in enumerate(asked):
        back = max((k for k in known_times if t is not None and k <= t), default=None)
        ahead = min((k for k in known_times if t is not None and k >= t), default=None)
        if direction == "nearest":
            both = [k for k in (back, ahead) if k is not None]
            want = min(both, key=lambda k: (abs(k - t), k)) if both else None
        else:
            want = back if direction == "backward" else ahead
        assert got[i] == want, (t, want)
    assert len(got) == 901


def test_stretches_of_nearest_times_keep_their_length(spark):
    """More rows make more stretches, not longer ones, in the written order and in the tasks that fill it."""
    left = spark.range(6000).select("id", F.timestamp_seconds(F.col("id") % 900).alias("at"))
    right = spark.range(600).select(F.timestamp_seconds(F.col("id") * 7).alias("t"), "id")
    out = ordered.nearest_in_order(left, "at", right.withColumnRenamed("id", "v"), "t", "v", "v", stretch_rows=300)
    parts = next(spark.read.parquet(f.rsplit("/", 1)[0]) for f in out.inputFiles() if "merged-order" in f)
    sizes = [r["count"] for r in parts.groupBy("_part").count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 900 and sum(sizes) == 6600
    tasks = out.filter("v IS NOT NULL").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(tasks) >= 8 and max(r["count"] for r in tasks) <= 1800


def plain_kendall(x, y):
    dis = sum((x[i] - x[j]) * (y[i] - y[j]) < 0 for i in range(len(x)) for j in range(i))
    con = sum((x[i] - x[j]) * (y[i] - y[j]) > 0 for i in range(len(x)) for j in range(i))
    ties = [sum(v[i] == v[j] for i in range(len(x)) for j in range(i)) for v in (x, y)]
    pairs = len(x) * (len(x) - 1) // 2
    return dis, (con - dis) / ((pairs - ties[0]) * (pairs - ties[1])) ** 0.5


@pytest.mark.parametrize("stretch", [40, 500_000])
@pytest.mark.parametrize("shape", ["apart", "ties", "hot", "opposed"])
def test_kendall_and_spearman_of_rows(spark, stretch, shape):
    rng = random.Random(5)
    x = [rng.random() for _ in range(260)]
    y = [v + rng.random() for v in x]
    if shape == "ties":
        x, y = [round(v * 9) for v in x], [round(v * 4) for v in y]
    if shape == "hot":
        x = [0.5 if i % 3 else v for i, v in enumerate(x)]
        y = [1.0 if i % 5 < 2 else v for i, v in enumerate(y)]
    if shape == "opposed":
        y = [-v for v in x]
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (float("nan"), 2.0)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(4)
    points = df.dropna().filter(~F.isnan("a")).groupBy("a", "b").count().toDF("x", "y", "n")
    dis, tau = plain_kendall(x, y)
    assert row_association.discordant_pairs(points, stretch) == dis
    got = {r.method: r for r in row_association.row_association(df, "a", "b", stretch=stretch).collect()}
    assert got["kendall"].r == pytest.approx(tau)
    assert got["pearson"].r == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert got["spearman"].r == pytest.approx(np.corrcoef(ranks_of(x), ranks_of(y))[0, 1])
    assert {r.n_samples for r in got.values()} == {260}


def test_inversions_with_great_weights():
    y, n = np.array([3.0, 1.0, 2.0, 1.0]), np.array([10 ** 12, 2, 10 ** 11, 10 ** 12])
    assert row_association.inversions(y, n) == 10 ** 12 * (2 + 10 ** 11 + 10 ** 12) + 10 ** 11 * 10 ** 12


def test_a_constant_side_has_no_association(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(20)], "a double, b double")
    assert row_association.row_association(df, "a", "b").count() == 0
    assert row_association.row_association(df.limit(0), "a", "b").count() == 0


@pytest.mark.parametrize("split_bytes", [200, 1 << 27])
def test_scan_order_without_moving_rows(spark, tmp_path, split_bytes):
    """Large files in many splits and small ones together in one task, numbered by the numbers in their names."""
    n = 0
    for k, lines in ((2, 300), (10, 4), (1, 3), (11, 1), (3, 90)):
        (tmp_path / f"part-{k}.txt").write_text("".join(f"{k}:{i}\n" for i in range(lines)))
        n += lines
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", 50)
    try:
        scanned = scan.with_scan_order(spark.read.text(str(tmp_path)))
        assert split_bytes > 200 or scanned.rdd.getNumPartitions() > 8
        out = index.index_by_scan_order(scanned)
        got = [r.value for r in sorted(out.collect(), key=lambda r: r.row_idx)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [f"{k}:{i}" for k, lines in ((1, 3), (2, 300), (3, 90), (10, 4), (11, 1)) for i in range(lines)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Exchange", "Join", "from_json"))
    numbered = index.contiguous_index(scanned, ["value"])
    assert not any(word in numbered._jdf.queryExecution().executedPlan().toString() for word in ("Exchange", "Join"))
