"""Approximate quantiles and distinct counts from mergeable sketches, an option beside the exact ones.

One sketch per part (a day, a month, a source) is a few kilobytes whatever the part holds. Sketches are kept as a
table; those of any set of parts merge into that of their union without another look at the rows.

Quantiles come from a KLL sketch: with ``k`` = 800 the rank of an answer is off by at most 0.5 % of the
rows (at 99 % confidence). Distinct counts come from a HyperLogLog sketch: with 2^14 registers the standard
error is 0.8 %.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

QUANTILE_K = 800
DISTINCT_BITS = 14


def part_sketches(df: DataFrame, parts: list[str], quantiles: list[str], distincts: list[str],
                  k: int = QUANTILE_K, bits: int = DISTINCT_BITS) -> DataFrame:
    """One row per part with ``{column}_kll`` and ``{column}_hll``; nulls and NaN are not counted."""
    numbers = [F.kll_sketch_agg_double(F.nanvl(F.col(c).cast("double"), F.lit(None)), k).alias(f"{c}_kll") for c in quantiles]
    return df.groupBy(*parts).agg(*numbers, *[F.hll_sketch_agg(c, bits).alias(f"{c}_hll") for c in distincts])


def merged_sketches(sketches: DataFrame, keys: list[str] | None = None, k: int = QUANTILE_K) -> DataFrame:
    """The sketches of all parts together, or of those that share ``keys``."""
    held = [c for c in sketches.columns if c.endswith(("_kll", "_hll"))]
    return sketches.groupBy(*(keys or [])).agg(*[
        (F.kll_merge_agg_double(c, k) if c.endswith("_kll") else F.hll_union_agg(c)).alias(c) for c in held])


def sketch_answers(sketches: DataFrame, quantiles: dict[str, list[float]], distincts: list[str],
                   keys: list[str] | None = None) -> DataFrame:
    """(keys, metric, value): one row per wanted quantile (``amount_p25``) and distinct count (``distinct_customer_id``)."""
    answers = [F.struct(F.lit(f"{c}_p{round(p * 100)}").alias("metric"),
                        F.kll_sketch_get_quantile_double(f"{c}_kll", F.lit(p)).alias("value"))
               for c, probs in quantiles.items() for p in probs]
    answers += [F.struct(F.lit(f"distinct_{c}").alias("metric"), F.hll_sketch_estimate(f"{c}_hll").cast("double").alias("value"))
                for c in distincts]
    return sketches.select(*(keys or []), F.explode(F.array(*answers)).alias("a")).select(*(keys or []), "a.*")
