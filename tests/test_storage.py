"""Histories and layouts on disk, written date forms, first rows, sketches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyrill.functions import scalar
from tallyrill.operators import cleaning, sketches
from tallyrill.plans import job
from tallyrill.sources import scan, sinks

START = dt.datetime(2024, 1, 1)


def files_of(path):
    return sorted(f for f in os.listdir(path) if f.endswith(".json"))


def test_retention_keeps_the_newest_and_what_others_append(spark, tmp_path):
    path = str(tmp_path / "history")
    for i in range(7):
        sinks.append_run(spark, path, "success", float(i), None, START + dt.timedelta(days=i))
    sinks.retain_runs(spark, path, keep=3)  # all files are young: they stay until readers have finished
    assert len(files_of(path)) == 8
    assert sorted(r.duration_seconds for r in sinks.read_kept_runs(spark, path, keep=9).collect()) == list(range(7))
    sinks.retain_runs(spark, path, keep=3, grace_seconds=0)
    assert len(files_of(path)) == 1 and scan.read_run_history(spark, path).count() == 3
    sinks.append_run(spark, path, "error", 9.0, "x", START + dt.timedelta(days=9))
    sinks.retain_runs(spark, path, keep=5, grace_seconds=0)  # nothing to drop: nothing is rewritten
    assert len(files_of(path)) == 2
    assert sorted(r.duration_seconds for r in sinks.read_kept_runs(spark, path, keep=3).collect()) == [5, 6, 9]


def test_a_reader_survives_retention_within_its_grace(spark, tmp_path):
    path = str(tmp_path / "history")
    for i in range(4):
        sinks.append_run(spark, path, "success", float(i), None, START + dt.timedelta(days=i))
    reader = scan.read_run_history(spark, path)  # has listed its files
    sinks.retain_runs(spark, path, keep=2)
    assert reader.count() == 4 and sinks.read_kept_runs(spark, path, keep=2).count() == 2


def test_checks_are_appended_per_run(spark, tmp_path):
    details = spark.createDataFrame([("sales", "nulls", True, 0), ("sales", "dates", False, 2)],
                                    "dataset string, check string, passed boolean, observed long")
    for k in range(3):
        sinks.append_checks(details, str(tmp_path / "checks"), START + dt.timedelta(days=k))
    back = spark.read.parquet(str(tmp_path / "checks"))
    assert back.columns == ["run", "dataset", "check", "passed"] and back.groupBy("run").count().count() == 3


def test_one_month_is_rewritten_and_read_alone(spark, tmp_path):
    path = str(tmp_path / "sales")
    df = spark.createDataFrame([(2024, m, float(i)) for m in (1, 2, 3) for i in range(20)], "year int, month int, amount double")
    sinks.write_months(df, path)
    names = {m: set(os.listdir(f"{path}/year=2024/month={m}")) for m in (1, 2, 3)}
    sinks.write_months(df.filter("month = 2").withColumn("amount", F.col("amount") + 100), path)
    now = {m: set(os.listdir(f"{path}/year=2024/month={m}")) for m in (1, 2, 3)}
    assert now[1] == names[1] and now[3] == names[3] and not now[2] & names[2]
    one = sinks.read_months(spark, path, year=2024, month=2)
    assert one.agg(F.min("amount")).first()[0] == 100 and one.count() == 20
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(month" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("dates, want", [
    (["12/02/2024", "13/02/2024", "01/03/2024"], ["2024-02-12", "2024-02-13", "2024-03-01"]),
    (["02/12/2024", "02/13/2024", "03/01/2024"], ["2024-02-12", "2024-02-13", "2024-03-01"]),
    (["02/03/2024", "2024-05-06", "7 May 2024"], ["2024-02-03", "2024-05-06", "2024-05-07"]),
    (["12/02/2024", "13/02/2024", "14/02/2024", "02/20/2024"], ["2024-02-12", "2024-02-13", "2024-02-14", "None"]),
])
def test_one_order_of_day_and_month_for_a_column(spark, tmp_path, dates, want):
    path = tmp_path / "sales.csv"
    path.write_text("Date,Product Name\n" + "".join(f"{d},p{i}\n" for i, d in enumerate(dates)))
    got = [str(r.date) for r in scan.read_sales_csv(spark, str(path)).orderBy("product_name").collect()]
    assert got == want
    other = scan.read_sales_csv(spark, str(path), day_first=True).orderBy("product_name").first()
    assert str(other.date) == scalar_day_first(dates[0])
    said = spark.createDataFrame([(d,) for d in dates], "d string").agg(*[c.alias(n) for n, c in scalar.date_reading("d").items()]).first()
    assert said["values"] == len(dates) and max(said.month_first, said.day_first) == sum(w != "None" for w in want)


def scalar_day_first(text):
    return str(dt.datetime.strptime(text, "%d/%m/%Y").date()) if int(text.split("/")[1]) <= 12 else "None"


def test_the_first_post_of_an_id_without_a_given_order(spark):
    rows = [("a", "2024-01-01", 9, 1), ("b", "2024-01-01", 3, 1), ("a", "2024-01-01", 1, 1)]
    df = spark.createDataFrame(rows, "post_id string, date string, likes long, comments long").coalesce(1)
    out = cleaning.clean_social(df.withColumn("date", F.to_date("date")), "instagram")
    assert {r.post_id: r.likes for r in out.collect()} == {"a": 9, "b": 3} and "_input" not in out.columns


def test_absent_sources_are_named(spark, tmp_path):
    (tmp_path / "i.json").write_text('[{"post_id": "p"}]')
    conf = {"data_sources": {"sales": {"path": "x"}, "social_media": {
        "instagram": {"path": str(tmp_path / "i.json")}, "tiktok": {"path": str(tmp_path / "none.json")},
        "youtube": {"enabled": False, "path": "none"}}}}
    assert scan.absent_sources(spark, conf) == ["tiktok"]


def test_rows_are_counted_while_written(spark, tmp_path):
    df = spark.range(37).repartition(5)
    stored, n = sinks.write_counted(df, str(tmp_path / "t"))
    assert n == 37 == stored.count()
    assert sinks.write_counted(df.filter("id < 0"), str(tmp_path / "e")) == (None, 0)
    assert not (tmp_path / "e").exists()


def test_only_late_stages_can_be_skipped(spark, tmp_path):
    with pytest.raises(ValueError):
        job.run_job(spark, {"pipeline": {"skip_stages": ["ingestion"]}, "output": {"clean_data_path": str(tmp_path)}})


def test_sketches_of_parts_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 6).alias("part"), (F.col("id") * 7919 % 60_013).cast("double").alias("v"),
                                    (F.col("id") % 5000).alias("who"))
    df = df.unionByName(spark.createDataFrame([(0, None, None), (1, float("nan"), 3)], "part long, v double, who long"))
    parts = sketches.part_sketches(df, ["part"], ["v"], ["who"])
    assert parts.count() == 6
    got = {r.metric: r.value for r in sketches.sketch_answers(
        sketches.merged_sketches(parts), {"v": [0.1, 0.5, 0.99]}, ["who"]).collect()}
    assert all(abs(got[f"v_p{round(p * 100)}"] / 60_013 - p) < 0.01 for p in (0.1, 0.5, 0.99))
    assert abs(got["distinct_who"] / 5000 - 1) < 0.03
    by_part = sketches.sketch_answers(sketches.merged_sketches(parts, ["part"]), {"v": [0.5]}, [], ["part"])
    assert by_part.count() == 6
