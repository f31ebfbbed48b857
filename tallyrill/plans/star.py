"""Sales and posts derived from the given star schema and event tables.

``sales`` joins only the dimensions the wanted columns need, so a query on amounts and dates
reads two tables. Joins are plain equi-joins: the optimizer broadcasts a dimension while its
stored size is below the session's limit and shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Total order of line items, standing for their input order.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]

SALES_COLUMNS = ["date", "customer_id", "product_id", "product_name", "category", "location", "quantity",
                 "unit_price", "discount", "amount", "transaction_id"]

_POSTS = {"view": "instagram", "click": "tiktok", "signup": "youtube"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str, columns: list[str] | None = None,
          keep_order: bool = False) -> DataFrame:
    """Line items as sales rows."""
    wanted = columns or SALES_COLUMNS
    df = table(spark, sf_dir, "lineitem")
    if {"date", "customer_id", "location"} & set(wanted):
        orders = table(spark, sf_dir, "orders")
        if "location" in wanted:  # orders, not their lines, move to the customers
            orders = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            orders = orders.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if {"product_name", "category"} & set(wanted):
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    source = {
        "date": lambda: F.to_date("o_orderdate"),
        "customer_id": lambda: F.col("o_custkey"),
        "product_id": lambda: F.col("l_partkey"),
        "product_name": lambda: F.col("p_name"),
        "category": lambda: F.col("p_type"),
        "location": lambda: F.col("n_name"),
        "quantity": lambda: F.col("l_quantity").cast("bigint"),
        "unit_price": lambda: F.col("l_extendedprice") / F.col("l_quantity"),
        "discount": lambda: F.col("l_discount") * 100,
        "amount": lambda: F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "transaction_id": lambda: F.concat_ws("-", "l_orderkey", "l_linenumber"),
    }
    return df.select(*[source[c]().alias(c) for c in wanted], *(LINE_ORDER if keep_order else []))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as sales rows."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(F.col("event_id").alias("transaction_id"), F.to_date("ts").alias("date"),
                    F.col("user_id").alias("customer_id"), F.length("props").cast("bigint").alias("product_id"),
                    _k().alias("quantity"), F.col("value").alias("amount"))


def _k():
    return F.get_json_object("props", "$.k").cast("bigint")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View, click and signup events as posts of three platforms."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type").isin(*_POSTS))
    name = F.create_map(*[F.lit(x) for kv in _POSTS.items() for x in kv])
    return e.select(F.col("event_id").alias("post_id"), F.to_date("ts").alias("date"),
                    name[F.col("event_type")].alias("platform"), F.col("value").alias("engagement_rate"),
                    _k().alias("likes"), (F.col("user_id") % 10).alias("comments"))


def raw_posts(spark: SparkSession, sf_dir: str, platform: str) -> DataFrame:
    """Posts of one platform without an engagement rate, with its own audience column."""
    event_type = next(k for k, v in _POSTS.items() if v == platform)
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == event_type)
    ident = "post_id" if platform == "instagram" else "video_id"
    audience = "followers" if platform == "instagram" else "views"
    return e.select(F.concat(F.lit(platform[:2].upper()), F.col("event_id")).alias(ident),
                    F.to_date("ts").alias("date"), _k().alias("likes"), (F.col("user_id") % 10).alias("comments"),
                    F.length("event_type").cast("bigint").alias("shares"), F.col("user_id").alias(audience))


def long_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales by order date with the mean discount of the goods shipped that day."""
    lines = table(spark, sf_dir, "lineitem")
    sold = (lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.to_date("o_orderdate").alias("date"))
            .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_sales")))
    shipped = lines.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.avg("l_discount").alias("avg_engagement"))
    return sold.join(shipped, "date", "left").fillna(0, subset=["avg_engagement"])


def keyed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily series per product category."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    sold = (lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.col("p_type").alias("series"), F.to_date("o_orderdate").alias("date"))
            .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_sales")))
    shipped = (lines.groupBy(F.col("p_type").alias("series"), F.to_date("l_shipdate").alias("date"))
               .agg(F.avg("l_discount").alias("avg_engagement")))
    return sold.join(shipped, ["series", "date"], "left").fillna(0, subset=["avg_engagement"])
