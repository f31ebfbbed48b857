"""File scans: sales CSV, social JSON, processed tables, run history, logs, file inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyrill import schemas
from tallyrill.functions.scalar import date_reading, to_day

# Position of a row in its source: file, split of the file, order inside the split.
SCAN_ORDER = ("_src_file", "_src_block", "_src_seq")


class DuplicateColumn(ValueError):
    """Two source columns map to the same canonical name."""


def located(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = located(spark, path)
    return fs.exists(hadoop_path)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = located(spark, path)
    fs.delete(hadoop_path, True)


def with_scan_order(df: DataFrame) -> DataFrame:
    """Add the source position; call it on the scan itself, before any shuffle."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_src_file"),
        F.col("_metadata.file_block_start").alias("_src_block"),
        F.monotonically_increasing_id().alias("_src_seq"),
    )


def normalized_header(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def canonical_sales_names(columns: list[str]) -> list[str]:
    names = [normalized_header(c) for c in columns]
    names = [schemas.SALES_RENAMES.get(c, c) for c in names]
    twice = sorted({c for c in names if names.count(c) > 1})
    if twice:
        raise DuplicateColumn(f"several source columns map to {twice}")
    return names


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(*schemas.MISSING_TOKENS), c)


def _has_line_breaks_in_quotes(spark: SparkSession, path: str) -> bool:
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not lines.filter(quotes % 2 == 1).isEmpty()


def read_sales_csv(spark: SparkSession, path: str, multi_line: bool | None = None,
                   keep_order: bool = False, day_first: bool | None = None) -> DataFrame:
    """Sales CSV with free-form headers, typed by canonical name, dates coerced to days.

    ``day_first=None`` reads the whole date column in the order of day and month that reads more of it, month first on
    ties.

    ``multi_line=None`` looks once for quoted line breaks: without them the file stays
    splittable, with them one task reads each file whole, as the format demands. State True or
    False for large inputs to save that look.
    """
    if multi_line is None:
        multi_line = _has_line_breaks_in_quotes(spark, path)
    raw = (spark.read.option("header", True).option("encoding", "UTF-8")
           .option("multiLine", multi_line).option("escape", '"').csv(path))
    if keep_order:
        raw = with_scan_order(raw)
    data_columns = [c for c in raw.columns if c not in SCAN_ORDER]
    named = raw.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(data_columns, canonical_sales_names(data_columns))],
        *[c for c in raw.columns if c in SCAN_ORDER])
    fractional, found = column_traits(named)
    return typed_sales(named, fractional, found if day_first is None else day_first)


def column_traits(df: DataFrame) -> tuple[set[str], bool]:
    """Columns meant for whole numbers that hold fractions, and whether dates are written day first; one look at both."""
    names = [c for c in df.columns if schemas.SALES_TYPES.get(c) == "bigint"]
    value = {c: missing_to_null(F.trim(F.col(f"`{c}`"))).try_cast("double") for c in names}
    looks = {f"_{c}": F.bool_or(v != F.floor(v)) for c, v in value.items()}
    if "date" in df.columns:
        looks |= date_reading(missing_to_null(F.col("date")))
    if not looks:
        return set(), False
    found = df.agg(*[c.alias(n) for n, c in looks.items()]).first().asDict()
    return {c for c in names if found[f"_{c}"]}, found.get("day_first", 0) > found.get("month_first", 0)


def typed_sales(df: DataFrame, fractional: set[str] = frozenset(), day_first: bool = False) -> DataFrame:
    out = []
    for name in df.columns:
        c = F.col(f"`{name}`")
        if name in SCAN_ORDER:
            out.append(c)
        elif name == "date":
            out.append(to_day(missing_to_null(c), day_first).alias(name))
        elif name in fractional:
            out.append(missing_to_null(F.trim(c)).try_cast("double").alias(name))
        elif schemas.SALES_TYPES.get(name) == "bigint":
            # whole numbers may be written "3.0"
            number = missing_to_null(F.trim(c))
            out.append(F.coalesce(number.try_cast("bigint"),
                                  number.try_cast("double").try_cast("bigint")).alias(name))
        else:
            kind = schemas.SALES_TYPES.get(name, "string")
            out.append(missing_to_null(c).try_cast(kind).alias(name))
    return df.select(*out)


def read_social_json(spark: SparkSession, path: str, platform: str, enabled: bool = True,
                     json_lines: bool = False, schema: T.StructType | None = None,
                     keep_order: bool = False) -> DataFrame | None:
    """Posts of one platform with the columns its file has; None where the source is disabled.

    Known columns get their known types, further ones keep what the file holds, and absent ones stay
    absent: later steps derive what is missing and checks report it.

    A record array is one JSON document, so each file is read by one task: spread large inputs
    over files, or hand them over as JSON lines, which stay splittable.
    """
    if not enabled:
        return None
    reader = spark.read.option("multiLine", not json_lines)
    df = (reader.schema(schema) if schema else reader).json(path)
    if keep_order:
        df = with_scan_order(df)
    if not schema:
        kinds = {f.name: f.dataType for f in schemas.SOCIAL_SCHEMAS[platform].fields}
        df = df.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])
    return df.withColumn("date", to_day("date")) if "date" in df.columns else df


def absent_sources(spark: SparkSession, config: dict) -> list[str]:
    """Enabled social sources whose path is not there: they are left out of a run, and reported."""
    social = config["data_sources"].get("social_media", {})
    given = {p: social[p] for p in schemas.PLATFORMS if social.get(p) and social[p].get("enabled", True)}
    return [p for p, conf in given.items() if not path_exists(spark, conf["path"])]


def read_all_sources(spark: SparkSession, config: dict, keep_order: bool = False) -> dict[str, DataFrame]:
    """Every enabled source; a social source whose path is absent is left out (``absent_sources`` names it)."""
    sources = config["data_sources"]
    sales = sources["sales"]
    tables = {"sales": read_sales_csv(spark, sales["path"], sales.get("multi_line"), keep_order,
                                       sales.get("day_first"))}
    absent = absent_sources(spark, config)
    for platform in schemas.PLATFORMS:
        conf = sources.get("social_media", {}).get(platform)
        if not conf or not conf.get("enabled", True) or platform in absent:
            continue
        tables[platform] = read_social_json(
            spark, conf["path"], platform, json_lines=conf.get("json_lines", False),
            keep_order=keep_order)
    return tables


def read_processed(spark: SparkSession, folder: str, name: str, required: bool = True,
                   fmt: str = "parquet") -> DataFrame | None:
    """A processed table by name; absent tables are fatal or skipped."""
    path = f"{folder}/{name}_processed"
    if not path_exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return None
    if fmt == "parquet":
        return spark.read.parquet(path)
    df = spark.read.option("header", True).csv(path, inferSchema=True)
    return df.withColumn("date", to_day("date")) if "date" in df.columns else df


def load_by_extension(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """CSV or JSON chosen by the file name; None where the path is absent."""
    if not path_exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    if path.rstrip("/").endswith(".csv"):
        return reader.option("header", True).csv(path, inferSchema=schema is None)
    if path.rstrip("/").endswith(".json"):
        return reader.option("multiLine", True).json(path)
    return None


def read_run_history(spark: SparkSession, path: str, json_lines: bool = True) -> DataFrame:
    """Run records; an absent file gives an empty table of the same schema."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.RUN_HISTORY_SCHEMA)
    return (spark.read.schema(schemas.RUN_HISTORY_SCHEMA).option("multiLine", not json_lines)
            .json(path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with their position."""
    return with_scan_order(spark.read.text(path)).withColumnRenamed("value", "line")


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files below a path with size and modification time; contents are never read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", F.col("length").alias("size_bytes"),
                    F.col("modificationTime").alias("modified_at")))
