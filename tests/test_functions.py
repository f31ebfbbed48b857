"""Scalar and statistical expressions."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tallyrill.functions import scalar, stats
from tallyrill.operators import association

CATEGORIES = {
    "Whey Protein": "Protein", "whey isolate": "Protein", "CASEIN POWDER": "Protein", "protein bar": "Protein",
    "BCAA": "Amino Acids", "Creatine Monohydrate": "Amino Acids", "L-Glutamine": "Amino Acids",
    "Vitamin D3": "Vitamins", "Multivitamin Pack": "Vitamins", "Omega-3 Fish Oil": "Vitamins",
    "Pre-Workout": "Performance", "Energy Booster": "Performance", "Caffeine Pills": "Performance",
    "Granola Bar": "Snacks", "Random Product": "Other", "Creatina": "Other", "": "Other", None: "Other",
}


def test_categories(spark):
    df = spark.createDataFrame([(k,) for k in CATEGORIES], "name string")
    got = {r["name"]: r["c"] for r in df.select("name", scalar.category_of("name").alias("c")).collect()}
    assert got == CATEGORIES


def test_round_even_halves(spark):
    row = spark.range(1).select(*[scalar.round_even(F.lit(v), 0).alias(f"v{i}")
                                  for i, v in enumerate((0.5, 1.5, 2.5, -0.5))]).first()
    assert list(row) == [0.0, 2.0, 2.0, 0.0]


def test_calendar(spark):
    df = spark.createDataFrame([("2021-01-01",), ("2024-01-06",), ("2024-01-07",), ("2024-01-08",)], "d string")
    rows = df.select(F.col("d").cast("date").alias("d")).withColumns(scalar.calendar_columns("d", True)).collect()
    assert [(r.year, r.quarter, r.week, r.day_of_week, r.day_name, r.is_weekend) for r in rows] == [
        (2021, 1, 53, 4, "Friday", 0), (2024, 1, 1, 5, "Saturday", 1), (2024, 1, 1, 6, "Sunday", 1),
        (2024, 1, 2, 0, "Monday", 0)]


def test_to_day_reads_or_nulls(spark):
    df = spark.createDataFrame([("2024-02-03",), ("2024-02-03 10:11:12",), ("2024-02-30",), ("soon",), (None,)], "t string")
    got = [str(r.d) if r.d else None for r in df.select(scalar.to_day("t").alias("d")).collect()]
    assert got == ["2024-02-03", "2024-02-03", None, None, None]


def test_labels(spark):
    df = spark.createDataFrame([(0.7,), (-0.5,), (0.3,), (-0.1,), (0.0,)], "r double")
    rows = df.select(scalar.strength_label("r"), scalar.direction_label("r"), scalar.influence_label("r"),
                     scalar.sign_band("r"), scalar.segment_band("r")).collect()
    assert [tuple(r) for r in rows] == [
        ("fuerte", "positiva", "influyen", "green", "strong"),
        ("moderada-fuerte", "negativa", "influyen", "red", "weak"),
        ("moderada", "positiva", "influencia limitada", "green", "moderate"),
        ("debil", "negativa", "influencia muy debil o inexistente", "red", "weak"),
        ("muy debil", "negativa", "influencia muy debil o inexistente", "red", "weak")]


def test_weights_horizons_and_ages(spark):
    names = spark.createDataFrame([("VIP",), ("Leal",), ("Ocasional",), ("Dormido",), ("new",), (None,)], "s string")
    assert [r[0] for r in names.select(scalar.segment_weight("s")).collect()] == [1.3, 1.1, 0.9, 0.7, 1.0, 1.0]
    lags = spark.createDataFrame([(0,), (1,), (3,), (4,)], "k int")
    assert [r[0] for r in lags.select(scalar.horizon_label("k")).collect()] == [
        "inmediato", "corto plazo", "corto plazo", "mediano plazo"]
    ages = spark.createDataFrame([(59,), (3599,), (3600,), (90000,)], "s long")
    assert [r[0] for r in ages.select(scalar.age_text(F.col("s"))).collect()] == ["0m", "59m", "1h", "25h"]


# Published r, n and p of lagged series.
PUBLISHED_P = [
    (0.09136342099940484, 274, 0.1314070068935296), (0.045465107390479986, 273, 0.45437151523246194),
    (-0.07905248774377177, 272, 0.19367028488873214), (-0.001221904414583183, 265, 0.9842051997688092),
    (0.11348288679331128, 261, 0.06717672586542703), (0.16784748606526304, 274, 0.005345236481245322),
    (0.10818652197483059, 140, 0.20325175985267444),
]


def test_pearson_p_published(spark):
    df = spark.createDataFrame(PUBLISHED_P, "r double, n long, p double")
    for r in df.withColumn("got", stats.pearson_p("r", "n")).collect():
        assert abs(r.got - r.p) < 1e-12


@pytest.mark.parametrize("n", [3, 4, 5, 6, 9, 10, 31])
def test_pearson_p_against_integration(spark, n):
    """Tail of Student's t by numeric integration."""
    r, nu = 0.37, n - 2
    t = r * math.sqrt(nu / (1 - r * r))
    # substitute x = sqrt(nu) tan(a): the density becomes proportional to cos(a)^(nu-1)
    a0, steps = math.atan(t / math.sqrt(nu)), 20000
    def area(lo, hi):
        h = (hi - lo) / steps
        return h * sum(math.cos(lo + (i + 0.5) * h) ** (nu - 1) for i in range(steps))
    want = area(a0, math.pi / 2) / area(0, math.pi / 2)
    got = spark.createDataFrame([(r, n)], "r double, n long").select(stats.pearson_p("r", "n")).first()[0]
    assert abs(got - want) < 1e-7


def test_pearson_p_edges(spark):
    df = spark.createDataFrame([(1.0, 10), (-1.0, 9), (0.5, 2), (0.5, 1), (None, 10), (0.0, 12)], "r double, n long")
    assert [r[0] for r in df.select(stats.pearson_p("r", "n")).collect()] == [0.0, 0.0, 1.0, None, None, 1.0]


def test_pearson_p_far_out(spark):
    """Exact for three degrees of freedom or five: p in closed form, in whole-number arithmetic."""
    from decimal import Decimal, getcontext
    getcontext().prec = 60
    cases = [(r, n) for r in (0.1, 0.9, 0.99, 0.999999, 0.9999999999) for n in (4, 6)]
    df = spark.createDataFrame(cases, "r double, n long").select("r", "n", stats.pearson_p("r", "n").alias("p"),
                                                                 stats.log10_p("r", "n").alias("l"))
    for row in df.collect():
        s = Decimal(row.r)
        want = 1 - s if row.n == 4 else 1 - s * (1 + (1 - s * s) / 2)
        assert abs(Decimal(row.p) / want - 1) < Decimal("1e-12")
        assert abs(row.l - float(want.log10())) < 1e-12
    far = spark.createDataFrame([(0.99, 2400), (0.5, 10 ** 7)], "r double, n long").select(stats.log10_p("r", "n")).collect()
    assert far[0][0] < -2000 and far[1][0] < -600_000


def test_normal_tail(spark):
    zs = [0.0, 0.3, 1.0, 1.96, 2.7, 2.9, 4.0, 8.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double").selectExpr(stats.normal_two_sided_p("z") + " AS p")
    for z, r in zip(zs, df.collect()):
        want = math.erfc(z / math.sqrt(2))
        assert abs(r.p - want) <= 1e-12 + 1e-9 * want


def test_constant_side_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert df.agg(stats.pearson("x", "y")).first()[0] is None


def _tau_b(xs, ys):
    s = tx = ty = 0
    for (a, b), (c, d) in itertools.combinations(zip(xs, ys), 2):
        s += ((a > c) - (a < c)) * ((b > d) - (b < d))
        tx += a == c
        ty += b == d
    n0 = len(xs) * (len(xs) - 1) / 2
    return s / math.sqrt((n0 - tx) * (n0 - ty))


def _ranks(v):
    return [sum(a < b for a in v) + (sum(a == b for a in v) + 1) / 2 for b in v]


def _pearson(x, y):
    mx, my = sum(x) / len(x), sum(y) / len(y)
    sxy = sum((a - mx) * (b - my) for a, b in zip(x, y))
    return sxy / math.sqrt(sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y))


def test_rank_correlations_against_pairs(spark):
    rng, series = random.Random(3), {}
    for key, n, kinds in (("free", 40, 10 ** 9), ("few", 57, 4), ("some", 80, 25), ("two", 12, 2)):
        series[key] = [(float(rng.randrange(kinds)), float(rng.randrange(kinds))) for _ in range(n)]
    rows = [(k, i, x, y) for k, v in series.items() for i, (x, y) in enumerate(v)]
    df = spark.createDataFrame(rows, "k string, i int, x double, y double")
    for r in association.association(df, "x", "y", ["k"]).collect():
        xs, ys = zip(*series[r.k])
        assert r.n == len(xs)
        assert abs(r.kendall_tau - _tau_b(xs, ys)) < 1e-12
        assert abs(r.spearman_r - _pearson(_ranks(xs), _ranks(ys))) < 1e-12


def test_kendall_exact_p_against_all_orderings(spark):
    n, ys = 6, [2, 0, 1, 5, 3, 4]
    def discordant(p):
        return sum(a > b for a, b in itertools.combinations(p, 2))
    pairs = n * (n - 1) // 2
    low = min(discordant(ys), pairs - discordant(ys))
    every = [discordant(p) for p in itertools.permutations(range(n))]
    want = min(1.0, 2 * sum(d <= low for d in every) / len(every))
    df = spark.createDataFrame([(float(i), float(y)) for i, y in enumerate(ys)], "x double, y double")
    got = {r.method: r for r in association.association_tests(df, "x", "y").collect()}
    assert abs(got["kendall"].p_value - want) < 1e-12


def test_constant_series_gives_no_row(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(12)], "x double, y double")
    assert association.association_tests(df, "x", "y").count() == 0
