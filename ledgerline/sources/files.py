"""Landed files and the bronze layer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ledgerline.schemas import strings
from ledgerline.session import discard, settle


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV with a header, every column text: leading zeros stay, an empty field is the empty string.

    ``columns`` are the names of the header, in its order; a file that says otherwise is refused.
    """
    reader = spark.read.schema(strings(list(columns))).option("header", True)
    raw = reader.option("enforceSchema", False).option("escape", '"').csv(path)
    return raw.select([F.coalesce(c, F.lit("")).alias(c) for c in raw.columns])


#: Column that holds a line which could not be read as it should.
CORRUPT = "_corrupt_record"


def split_lines(raw: DataFrame, reason: str) -> tuple[DataFrame, DataFrame]:
    """Rows that were read whole, and the lines of all others as ``row``, with a ``reject_reason``.

    Broken lines are stored with what could be read of them: a line alone cannot be asked for.
    """
    broken = F.col(CORRUPT).isNotNull()
    lost = settle(raw.filter(broken))
    rejects = lost.select(F.col(CORRUPT).alias("row"), F.lit(reason).alias("reject_reason"))
    return raw.filter(~broken).drop(CORRUPT), rejects


def split_csv(
    spark: SparkSession, path: str, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """As ``read_csv_strings``, with lines that have too few or too many fields set apart; together they are all lines."""
    layout = StructType([*strings(list(columns)).fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(layout).option("header", True).option("enforceSchema", False)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("mode", "PERMISSIVE")
    # All fields are parsed whatever a query asks for, else their number would not be known.
    raw = reader.option("columnPruning", False).option("escape", '"').csv(path)
    good, rejects = split_lines(raw, "not as many fields as columns")
    return good.select([F.coalesce(c, F.lit("")).alias(c) for c in good.columns]), rejects


def split_json(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """As ``read_json_raw``, with lines set apart that are no record, or hold a value of another type."""
    layout = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(layout).option("columnNameOfCorruptRecord", CORRUPT)
    return split_lines(reader.option("mode", "PERMISSIVE").json(path), "not a record of the layout")


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of a landed CSV."""
    return spark.read.option("header", True).csv(path).columns


def read_json_raw(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON record per line, read with a declared schema."""
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def bronze_root(root: str, source: str, run_type: str | None = None) -> str:
    """``<root>/bronze/<source>[/<run_type>]``; partitions follow below it."""
    return "/".join(part for part in (root.rstrip("/"), "bronze", source, run_type) if part)


def write_bronze(
    df: DataFrame,
    root: str,
    source: str,
    ingestion_date: dt.date,
    *,
    run_type: str | None = None,
    department: str | None = None,
    columns: Sequence[str] | None = None,
) -> str:
    """Write one run under ``[department=..]/ingestion_date=..``; a rerun replaces its own partition.

    ``columns`` fixes names, order and text type of the stored rows; without them the rows keep the
    types they come with.
    """
    stored = df if columns is None else df.select([F.col(c).cast("string") for c in columns])
    partitions = {"department": department} if department else {}
    partitions["ingestion_date"] = ingestion_date.isoformat()
    path = bronze_root(root, source, run_type)
    # The run's own folder is replaced, also by no rows at all.
    own = "/".join([path, *(f"{name}={value}" for name, value in partitions.items())])
    stored.write.mode("overwrite").parquet(own)
    return path


def write_by_department(
    df: DataFrame,
    root: str,
    source: str,
    ingestion_date: dt.date,
    department: Column,
    columns: Sequence[str],
) -> str:
    """Write one run of all departments in one pass, each under its ``department=../ingestion_date=..``.

    A rerun replaces its day everywhere, also where a department has no rows any more. Rows without a department
    are left out.
    """
    path, day = bronze_root(root, source), ingestion_date.isoformat()
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    rows = df.select(*texts, department.alias("department"), F.lit(day).alias("ingestion_date"))
    rows = rows.filter("department <> ''")
    places = ["department", "ingestion_date"]
    # A department's rows lie together, unless they are too many for one task.
    dealt = rows.hint("rebalance", "department").write.mode("overwrite").partitionBy(*places)
    dealt.option("partitionOverwriteMode", "dynamic").parquet(path)
    spark = df.sparkSession
    layout = StructType([StructField(p, StringType()) for p in places])
    stored = spark.read.schema(layout).parquet(path).filter(F.col("ingestion_date") == day)
    gone = stored.select("department").distinct().join(
        rows.select("department").distinct(), "department", "left_anti"
    )
    for (name,) in gone.collect():
        discard(spark, f"{path}/department={name}/ingestion_date={day}")
    return path


def bronze_schema(columns: StructType, by_department: bool = False) -> StructType:
    """Schema of a bronze folder with its partition columns, typed so that ``08`` stays text."""
    extra = [StructField("department", StringType())] if by_department else []
    return StructType([*columns.fields, *extra, StructField("ingestion_date", DateType())])


def read_bronze(
    spark: SparkSession,
    path: str,
    columns: StructType,
    *,
    by_department: bool = False,
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> DataFrame:
    """Bronze rows of the runs in ``[since, until)``; other partitions are not read."""
    df = spark.read.schema(bronze_schema(columns, by_department)).parquet(path)
    if since is not None:
        df = df.filter(F.col("ingestion_date") >= F.lit(since))
    if until is not None:
        df = df.filter(F.col("ingestion_date") < F.lit(until))
    return df
