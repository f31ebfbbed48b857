"""Customer value metrics, clusters, labels and principal components."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from tallyrill import schemas
from tallyrill.functions.scalar import round_even
from tallyrill.operators.quantiles import exact_quantiles
from tallyrill.scratch import write_once

FEATURES = ("recency", "frequency", "monetary")
N_CLUSTERS = 4
FIRST_SEED = 42
N_INIT = 10
PARALLEL_FITS = 5
CACHED_ROWS = 32_000_000  # each fit caches all vectors, some 100 bytes a row in memory: so many rows at a time in all fits
# A fit ends when no center moves further; four such moves together stay within the squared
# shift of 1e-4 (in units of the features' variance) at which the usual Lloyd loop stops.
CENTER_SHIFT = 0.005


def rfm(sales: DataFrame) -> DataFrame:
    """One row per customer: recency in days, frequency, monetary and three more measures.

    The facts are read once. Their per-customer aggregate is written, and the reference date, the
    latest over all customers, is a scalar taken from that much smaller table.
    """
    grouped = write_once(sales.groupBy("customer_id").agg(
        F.max("date").alias("_last"),
        F.count("transaction_id").alias("frequency"),
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("monetary"),
        F.avg("amount").alias("avg_order_value"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_quantity"),
        F.countDistinct("product_id").alias("product_diversity"),
    ), "customers")
    latest = grouped.agg(F.max("_last")).scalar()
    return grouped.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", F.datediff(latest, "_last").cast("bigint").alias("recency"),
        "frequency", "monetary", "avg_order_value", "total_quantity", "product_diversity")


def standardized(customers: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Population z-scores as ``z_<feature>``; a constant feature becomes zero."""
    row = customers.agg(*[f(c).alias(f"{tag}_{c}") for c in features
                          for f, tag in ((F.avg, "m"), (F.stddev_pop, "s"))]).first()
    out = {}
    for c in features:
        mean, spread = row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0
        out[f"z_{c}"] = (F.col(c) - F.lit(float(mean))) / F.lit(float(spread))
    return customers.withColumns(out)


def feature_vectors(customers: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    scaled = standardized(customers, features)
    return VectorAssembler(inputCols=[f"z_{c}" for c in features], outputCol="features").transform(scaled)


@dataclass
class Clustering:
    assigned: DataFrame
    cost: float
    seed: int
    costs: dict[int, float]


def fits_at_once(rows: int, fits: int) -> int:
    """Fits that run side by side: one where two would cache more than ``CACHED_ROWS`` vectors, which then go to disk."""
    return max(1, min(fits, PARALLEL_FITS, CACHED_ROWS // max(rows, 1)))


def cluster(customers: DataFrame, k: int = N_CLUSTERS, seeds: tuple[int, ...] | None = None) -> Clustering:
    """Best of several seeded K-means runs on the z-scores; adds ``segment``."""
    seeds = seeds or tuple(range(FIRST_SEED, FIRST_SEED + N_INIT))
    vectors = feature_vectors(customers)
    narrow = write_once(vectors.select("features"), "features")  # on shared storage: a lost executor costs no recomputation

    @inheritable_thread_target(customers.sparkSession)
    def fit(seed: int):
        return KMeans(k=k, seed=seed, maxIter=300, tol=CENTER_SHIFT, featuresCol="features",
                      predictionCol="segment").fit(narrow)

    # independent fits share the written vectors; side by side they hide each other's job latency
    with ThreadPoolExecutor(max_workers=fits_at_once(narrow.count(), len(seeds))) as pool:
        models = dict(zip(seeds, pool.map(fit, seeds)))
    costs = {seed: model.summary.trainingCost for seed, model in models.items()}
    best = min(seeds, key=lambda seed: (costs[seed], seed))
    assigned = models[best].transform(vectors).drop("features", *[f"z_{c}" for c in FEATURES])
    return Clustering(assigned, costs[best], best, costs)


def segment_profiles(segments: DataFrame, by: str = "segment", digits: int | None = 2) -> DataFrame:
    """Mean recency, frequency and monetary per group, rounded where asked."""
    def mean(c):
        return (F.avg(c) if digits is None else round_even(F.avg(c), digits)).alias(c)

    return segments.groupBy(by).agg(*[mean(c) for c in FEATURES])


def rfm_quantiles(customers: DataFrame) -> dict[tuple[str, float], float | None]:
    return exact_quantiles(customers, {"frequency": [0.5, 0.75], "monetary": [0.75], "recency": [0.5, 0.75]})


def label_rules(profiles: DataFrame, q: dict[tuple[str, float], float | None]) -> DataFrame:
    """Label per cluster from its rounded means and the customers' quantiles; first rule wins."""
    f, m, r = (F.col(c) for c in ("frequency", "monetary", "recency"))

    def at(name, prob):
        return F.lit(q[(name, prob)]).cast("double")

    label = (F.when((f >= at("frequency", 0.75)) & (m >= at("monetary", 0.75)), "VIP")
             .when((f >= at("frequency", 0.5)) & (r <= at("recency", 0.5)), "Leal")
             .when(r >= at("recency", 0.75), "Dormido")
             .otherwise("Ocasional"))
    return profiles.withColumn("segment_name", label)


def label_segments(assigned: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Add ``segment_name``; several clusters may share a label. One label row per cluster.

    ``customers`` may name the stored table the clusters were assigned to, which is cheaper to
    take quantiles from.
    """
    cuts = rfm_quantiles(assigned if customers is None else customers)
    labels = label_rules(segment_profiles(assigned), cuts).select("segment", "segment_name")
    return assigned.join(F.broadcast(labels), "segment", "left")


def principal_components(customers: DataFrame, n: int = 2) -> tuple[DataFrame, list[float]]:
    """Columns pc1..pcn on the z-scores and the explained variance ratios.

    The model is fitted on the distributed covariance; the largest loading of each component is
    made positive, and projections are plain column arithmetic.
    """
    vectors = feature_vectors(customers)
    model = PCA(k=n, inputCol="features", outputCol="pc").fit(vectors)
    loadings = model.pc.toArray()
    out = vectors
    for j in range(n):
        weights = [float(w) for w in loadings[:, j]]
        if max(weights, key=abs) < 0:
            weights = [-w for w in weights]
        score = sum((F.col(f"z_{c}") * F.lit(w) for c, w in zip(FEATURES, weights)), F.lit(0.0))
        out = out.withColumn(f"pc{j + 1}", score)
    return out.drop("features", *[f"z_{c}" for c in FEATURES]), [float(v) for v in model.explainedVariance]


def segment_report(segments: DataFrame) -> DataFrame:
    """Size, share and averages per label; the share is taken over the few label rows."""
    out = segments.groupBy("segment_name").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("recency").alias("avg_recency"),
        F.avg("frequency").alias("avg_frequency"),
        F.avg("monetary").alias("avg_monetary"),
        F.avg("avg_order_value").alias("avg_order_value"),
        F.avg("product_diversity").alias("avg_product_diversity"),
        F.sum("monetary").alias("total_value"),
    )
    every = Window.partitionBy()
    return out.withColumn("share_pct", F.col("customers") * 100.0 / F.sum("customers").over(every))


def segment_strategies(spark) -> DataFrame:
    rows = list(schemas.SEGMENT_ACTIONS.items())
    return spark.createDataFrame(rows, "segment_name string, actions array<string>")


def with_strategies(report: DataFrame) -> DataFrame:
    """Recommended actions per label; the strategy table is fixed at four rows."""
    return report.join(F.broadcast(segment_strategies(report.sparkSession)), "segment_name", "left")


def _segments_once(customers: DataFrame, segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    return customers, write_once(segments, "segments")


def segment_customers(sales: DataFrame, k: int = N_CLUSTERS, seeds: tuple[int, ...] | None = None,
                      store: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]] = _segments_once) -> dict:
    """Customer metrics, labelled clusters, components and report.

    ``store`` writes the metrics and the clusters and returns their stored form.
    """
    customers = rfm(sales)
    clustering = cluster(customers, k, seeds)
    stored, segments = store(customers, label_segments(clustering.assigned, customers))
    components, ratios = principal_components(customers)
    return {
        "rfm": stored,
        "segments": segments,
        "pca": components,
        "explained_variance": ratios,
        "cost": clustering.cost,
        "report": with_strategies(segment_report(segments)),
    }
