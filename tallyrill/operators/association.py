"""Rank correlations of day-grain series: Spearman and Kendall next to Pearson.

Input is one row per (series key, day), so a series is at most a calendar long, while any number
of series runs in parallel. Kendall's discordant pairs are counted without forming pairs: two
values differ first at some bit of their rank, and among rows that agree on all higher bits a
pair is discordant when the earlier row has that bit set and the later one has not. Each row is
therefore counted once per bit with a running sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tallyrill.functions.stats import kendall_p, pearson, pearson_p, significant


def average_rank(value: str, keys: list[str]):
    """Rank with ties sharing their mean rank."""
    ordered = Window.partitionBy(*keys).orderBy(value)
    same = Window.partitionBy(*keys, value)
    return F.rank().over(ordered) + (F.count(F.lit(1)).over(same) - 1) / 2.0


def association(series: DataFrame, x: str, y: str, keys: list[str] | None = None) -> DataFrame:
    """One row per series: n, Pearson r, Spearman rho, Kendall tau-b and what its test needs.

    Series with a constant side give no row.
    """
    keys = keys or []
    pairs = series.select(*keys, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    pairs = pairs.dropna(subset=["_x", "_y"])
    whole = Window.partitionBy(*keys)

    def tied(*cols):
        return F.count(F.lit(1)).over(Window.partitionBy(*keys, *cols))

    ranked = pairs.withColumns({
        "_rx": average_rank("_x", keys),
        "_ry": average_rank("_y", keys),
        "_code": F.dense_rank().over(Window.partitionBy(*keys).orderBy("_y")) - 1,
        "_pos": F.row_number().over(Window.partitionBy(*keys).orderBy("_x", "_y")),
        "_tx": tied("_x"), "_ty": tied("_y"), "_txy": tied("_x", "_y"),
    })
    bits = F.greatest(F.ceil(F.log2(F.max("_code").over(whole) + F.lit(1.0))), F.lit(1)).cast("int")
    leveled = ranked.withColumn("_bits", bits).withColumn(
        "_level", F.explode(F.sequence(F.lit(0), F.col("_bits") - 1)))
    leveled = leveled.withColumns({
        "_bit": F.expr("shiftright(_code, _level) & 1"),
        "_prefix": F.expr("shiftright(_code, _level + 1)"),
    })
    earlier = (Window.partitionBy(*keys, "_level", "_prefix").orderBy("_pos")
               .rowsBetween(Window.unboundedPreceding, -1))
    counted = leveled.withColumn("_disc", F.when(
        F.col("_bit") == 0, F.coalesce(F.sum(F.col("_bit").cast("bigint")).over(earlier), F.lit(0))))

    once = F.col("_level") == 0

    def total(expr):
        return F.coalesce(F.sum(F.when(once, expr)), F.lit(0)).cast("double")

    tx, ty, txy = (F.col(c).cast("double") for c in ("_tx", "_ty", "_txy"))
    at = {c: F.when(once, F.col(c)) for c in ("_x", "_y", "_rx", "_ry")}
    out = counted.groupBy(*keys).agg(
        F.count(F.when(once, 1)).alias("n"),
        pearson(at["_x"], at["_y"]).alias("pearson_r"),
        pearson(at["_rx"], at["_ry"]).alias("spearman_r"),
        F.coalesce(F.sum("_disc"), F.lit(0)).alias("_dis"),
        total((tx - 1) / 2).alias("_xtie"), total((ty - 1) / 2).alias("_ytie"),
        total((txy - 1) / 2).alias("_both"),
        total((tx - 1) * (tx - 2)).alias("_x0"), total((tx - 1) * (2 * tx + 5)).alias("_x1"),
        total((ty - 1) * (ty - 2)).alias("_y0"), total((ty - 1) * (2 * ty + 5)).alias("_y1"),
    ).filter(F.col("pearson_r").isNotNull())
    all_pairs = F.col("n") * (F.col("n") - 1) / 2.0
    out = out.withColumn("_s", all_pairs - F.col("_xtie") - F.col("_ytie") + F.col("_both") - 2.0 * F.col("_dis"))
    spread = F.sqrt(all_pairs - F.col("_xtie")) * F.sqrt(all_pairs - F.col("_ytie"))
    return out.withColumn("kendall_tau", F.try_divide(F.col("_s"), spread))


def association_tests(series: DataFrame, x: str, y: str, keys: list[str] | None = None) -> DataFrame:
    """Long form: (series key, method, r, p_value, significant, n_samples)."""
    keys = keys or []
    one = association(series, x, y, keys)
    tests = one.select(
        *keys, "n", "pearson_r", "spearman_r", "kendall_tau",
        pearson_p("pearson_r", "n").alias("pearson_p"),
        pearson_p("spearman_r", "n").alias("spearman_p"),
        kendall_p("n", "_dis", "_s", "_xtie", "_ytie", "_x0", "_x1", "_y0", "_y1").alias("kendall_p"),
    )
    methods = F.explode(F.array(*[
        F.struct(F.lit(m).alias("method"), F.col(r).alias("r"), F.col(p).alias("p_value"))
        for m, r, p in (("pearson", "pearson_r", "pearson_p"), ("spearman", "spearman_r", "spearman_p"),
                        ("kendall", "kendall_tau", "kendall_p"))]))
    long = tests.select(*keys, methods.alias("t"), F.col("n").alias("n_samples"))
    return long.select(*keys, "t.method", "t.r", "t.p_value", significant("t.p_value").alias("significant"),
                       "n_samples")
