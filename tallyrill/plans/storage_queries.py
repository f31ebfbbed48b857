"""Queries on stored layouts, histories on disk, records of runs, written date forms and sketches."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyrill.operators import quality, reporting, sketches
from tallyrill.plans import job, star
from tallyrill.plans.analysis_queries import _ALL_CHECKS, _RFM_OUT, _all_tables, _rfm
from tallyrill.plans.registry import add, day, rnd, sql, tidy
from tallyrill.plans.rollup_queries import _HOLES, _merged, runs
from tallyrill.plans.source_queries import _config
from tallyrill.scratch import new_folder, write_once
from tallyrill.sources import scan, sinks

# -- layout by month ----------------------------------------------------------------------------

_REWRITTEN = {"year": 1997, "month": 3}


def _monthly(s: SparkSession, d: str) -> DataFrame:
    """Write all months, write one again with doubled amounts, and say of every month what became of its files."""
    path = new_folder(s, "monthly")
    sales = star.sales(s, d, ["date", "quantity", "amount"]).withColumns({"year": F.year("date"), "month": F.month("date")})
    sinks.write_months(sales, path)
    files = scan.file_inventory(s, path).filter(F.col("path").endswith(".parquet")).select("path")
    before = write_once(files, "files-before")
    one = sales.filter((F.col("year") == _REWRITTEN["year"]) & (F.col("month") == _REWRITTEN["month"]))
    sinks.write_months(one.withColumn("amount", F.col("amount") * 2), path)
    after = scan.file_inventory(s, path).select("path", F.lit(True).alias("there"))
    place = [F.regexp_extract("path", rf"{c}=(\d+)", 1).cast("bigint").alias(c) for c in sinks.MONTHS]
    fate = before.join(after, "path", "left").groupBy(*place).agg(
        F.every(F.coalesce("there", F.lit(False))).alias("untouched"))
    read = sinks.read_months(s, path, **_REWRITTEN).select("_metadata.file_path").distinct()
    strange = read.filter(~F.col("file_path").contains(f"year={_REWRITTEN['year']}/month={_REWRITTEN['month']}/"))
    totals = sinks.read_months(s, path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").alias("amount"))
    return tidy(totals.join(fate, ["year", "month"]).withColumn("pruned", strange.agg(F.count(F.lit(1)) == 0).scalar()), 3)


add("s8_monthly_layout", _monthly,
    sql(f"""SELECT year(date) AS year, month(date) AS month, count(*) AS n_rows,
        {rnd(f"sum(amount) * CASE WHEN year(date) = {_REWRITTEN['year']} AND month(date) = {_REWRITTEN['month']} THEN 2 ELSE 1 END",
             3, 'amount')}, NOT (year(date) = {_REWRITTEN['year']} AND month(date) = {_REWRITTEN['month']}) AS untouched,
        true AS pruned FROM sales GROUP BY year(date), month(date)""", "sales"))

# -- histories on disk ----------------------------------------------------------------------------

_FIRST_RUN, _REPORTS = datetime(2024, 2, 1), 60


def _check_history(s: SparkSession, d: str) -> DataFrame:
    path = new_folder(s, "check-history")
    details = write_once(quality.validate_tables(_all_tables(s, d)), "checks")
    for k in range(_REPORTS):
        sinks.append_checks(details, path, _FIRST_RUN + timedelta(days=k))
    return s.read.parquet(path)


add("s12_check_history", _check_history,
    sql(f"""SELECT strftime(TIMESTAMP '2024-02-01' + to_days(CAST(k AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS run, dataset,
        "check", passed FROM c, (SELECT unnest(range({_REPORTS})) AS k)""", "purchases", "posts", "merged", h=_HOLES,
        c=_ALL_CHECKS))


def _retained(s: SparkSession, d: str) -> DataFrame:
    """All records on disk after runs came in three lots, each followed by retention."""
    path, history = new_folder(s, "retained"), runs(s, d)
    for k in range(3):
        lot = history.filter(F.pmod(F.xxhash64("timestamp"), F.lit(3)) == k)
        lot.write.mode("append").option("ignoreNullFields", False).json(path)
        sinks.retain_runs(s, path, grace_seconds=0)
    return tidy(scan.read_run_history(s, path))


add("s13_retention_on_disk", _retained,
    sql(f"""SELECT timestamp, status, {rnd('duration_seconds', 6, 'duration_seconds')}, error FROM runs
        ORDER BY timestamp DESC LIMIT 50""", "runs"))


def _records(s: SparkSession, d: str) -> DataFrame:
    """One run without its last two stages, and one without its sales file: what the records of both say."""
    conf = _config(s, d)
    short = {**conf, "pipeline": {"skip_stages": ["segmentation", "correlation"]}}
    done = job.run_job(s, short)
    if done is None:
        raise RuntimeError("the job failed")
    lost = {**conf, "data_sources": {"sales": {"path": new_folder(s, "nowhere")}}}
    if job.run_job(s, lost) is not None:
        raise RuntimeError("the job ran without sales")
    records = s.read.schema(job.schemas.RUN_RECORD_SCHEMA).json(f"{conf['output']['clean_data_path']}/run_records")
    said = records.select("status", F.array_join("stages_completed", ",").alias("completed"),
                          F.array_join("stages_failed", ",").alias("failed"), F.size("errors").cast("bigint").alias("errors"),
                          (F.col("end_time") >= F.col("start_time")).alias("timed"))
    rest = done["completeness"].select(F.lit("outputs").alias("status"), F.concat_ws("/", "found", "expected").alias("completed"),
                                       F.lit(",".join(done["missing_outputs"])).alias("failed"),
                                       F.lit(len(done["absent_sources"])).cast("bigint").alias("errors"),
                                       (F.col("status") == "Parcial").alias("timed"))
    return said.unionByName(rest)


add("r8_q14_q16_run_records", _records,
    """SELECT 'completed' AS status, 'ingestion,transformation,validation' AS completed, '' AS failed,
       CAST(0 AS BIGINT) AS errors, true AS timed
       UNION ALL SELECT 'failed', '', 'ingestion', CAST(1 AS BIGINT), true
       UNION ALL SELECT 'outputs', '3/5', '', CAST(0 AS BIGINT), true""")


def _segment_tables(s: SparkSession, d: str) -> DataFrame:
    rfm = _rfm(s, d)
    stored, _ = sinks.write_segmentation(rfm, rfm.select("customer_id"), new_folder(s, "segments"))
    return tidy(stored, 4)


add("s9_segment_tables", _segment_tables, sql(f"SELECT {_RFM_OUT} FROM rfm", "rfm"))


def _outputs(s: SparkSession, d: str) -> DataFrame:
    """Size and age of every written file, told per table."""
    folder = new_folder(s, "outputs")
    sinks.write_processed({"posts": star.posts(s, d), "daily_aggregates": _merged(s, d)}, folder)
    files = scan.file_inventory(s, folder).filter(F.col("path").endswith(".parquet"))
    told = reporting.output_files(files, F.current_timestamp())
    return told.groupBy(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("table_name")).agg(
        F.every(F.col("size_kb") > 0).alias("sized"), F.every(F.col("age").rlike("^[0-9]m$")).alias("fresh"))


add("r2_output_inventory", _outputs,
    """SELECT unnest(['posts_processed', 'daily_aggregates_processed']) AS table_name, true AS sized, true AS fresh""")

# -- written date forms ----------------------------------------------------------------------------


def _day_first(s: SparkSession, d: str) -> DataFrame:
    """A file whose dates are written day before month, most of which could be read either way."""
    path = new_folder(s, "day-first") + "/sales.csv"
    orders = star.table(s, d, "orders").select(F.col("o_orderkey").alias("Order Key"),
                                               F.date_format("o_orderdate", "d/M/yyyy").alias("Date"))
    sinks.write_table(orders, path, "csv")
    return tidy(scan.read_sales_csv(s, path, multi_line=False).select(F.col("order_key").cast("bigint").alias("order_key"), "date"))


add("p1_day_first", _day_first, f"SELECT o_orderkey AS order_key, {day('o_orderdate')} FROM orders")

# -- sketches --------------------------------------------------------------------------------------

_PROBS, _IDS = [0.25, 0.5, 0.75], ["customer_id", "product_id"]


def _sketched(s: SparkSession, d: str) -> DataFrame:
    """Answers of merged yearly sketches, held against the rows: ranks within 0.01, counts within 0.03."""
    sales = star.sales(s, d, ["date", "customer_id", "product_id", "amount"])
    parts = write_once(sketches.part_sketches(sales.withColumn("year", F.year("date")), ["year"], ["amount"], _IDS), "sketches")
    merged = sketches.merged_sketches(parts)
    said = {r["metric"]: r["value"] for r in sketches.sketch_answers(merged, {"amount": _PROBS}, _IDS).collect()}
    rows, checks = F.count(F.lit(1)), []
    for p in _PROBS:
        name = f"amount_p{round(p * 100)}"
        below, upto = (F.count(F.when(c, 1)) / rows for c in (F.col("amount") < said[name], F.col("amount") <= said[name]))
        checks.append(F.struct(F.lit(name).alias("metric"), rows.alias("exact"),
                               ((below <= p + 0.01) & (upto >= p - 0.01)).alias("within")))
    for c in _IDS:
        n, name = F.countDistinct(c), f"distinct_{c}"
        checks.append(F.struct(F.lit(name).alias("metric"), n.alias("exact"), (F.abs(n - said[name]) <= n * 0.03).alias("within")))
    return sales.agg(F.array(*checks).alias("c")).select(F.explode("c").alias("c")).select("c.*")


add("a13_a14_sketches", _sketched,
    sql("""SELECT 'amount_p' || p AS metric, count(*) AS exact, true AS within FROM sales, (SELECT unnest([25, 50, 75]) AS p) GROUP BY p
        UNION ALL SELECT 'distinct_customer_id', count(DISTINCT customer_id), true FROM sales
        UNION ALL SELECT 'distinct_product_id', count(DISTINCT product_id), true FROM sales""", "sales"))
