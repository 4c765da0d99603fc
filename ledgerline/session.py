"""Spark sessions and the shared folder that jobs may write intermediate tables to."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # '08' is a department, not the number eight.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def object_store_options(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """S3A options for a self-hosted object store; empty when no endpoint is configured."""
    if "S3_ENDPOINT_URL" not in env:
        return {}
    secure = str(env["S3_ENDPOINT_URL"].startswith("https")).lower()
    # Option names of the public S3A connector.
    return {
        "spark.hadoop.fs.s3a.access.key": env["S3_ACCESS_KEY"],
        "spark.hadoop.fs.s3a.connection.ssl.enabled": secure,
        "spark.hadoop.fs.s3a.endpoint": env["S3_ENDPOINT_URL"],
        "spark.hadoop.fs.s3a.endpoint.region": env.get("S3_REGION", "us-east-1"),
        "spark.hadoop.fs.s3a.multiobjectdelete.enable": "false",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.secret.key": env["S3_SECRET_KEY"],
    }


def catalog_options(catalog: str, warehouse: str) -> dict[str, str]:
    """Options for an Iceberg catalog; its jar has to be on the classpath already."""
    return {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        f"spark.sql.catalog.{catalog}": "org.apache.iceberg.spark.SparkCatalog",
        f"spark.sql.catalog.{catalog}.type": "hadoop",
        f"spark.sql.catalog.{catalog}.warehouse": warehouse,
    }


def build_session(
    app: str = "ledgerline",
    provider: str = "parquet",
    conf: Mapping[str, str] | None = None,
    env: Mapping[str, str] = os.environ,
) -> SparkSession:
    """Session for the given table provider; ``conf`` wins over everything else."""
    options = {**DEFAULTS, **object_store_options(env)}
    if provider == "iceberg":
        options |= catalog_options("lakehouse", f"s3a://{env['LAKEHOUSE_BUCKET']}/warehouse")
    options |= conf or {}
    spark = SparkSession.builder.appName(app).config(map=options).getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: functions in tasks import it."""
    context = spark.sparkContext
    if getattr(context, "_ledgerline_shipped", False):
        return
    archive = f"{tempfile.mkdtemp(prefix='ledgerline-code-')}/ledgerline_code"
    root = Path(__file__).parents[1]
    context.addPyFile(shutil.make_archive(archive, "zip", root_dir=root, base_dir="ledgerline"))
    context._ledgerline_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: what the cluster names in ``spark.checkpoint.dir``.

    Where nothing is named, a local session gets a folder of its own; a cluster session is refused,
    because a path on one machine would not be visible to the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="ledgerline-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """Fresh path in the shared folder, never used before."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a path of ``scratch_path``, on whatever file system it lies."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read it back from a table in the shared folder.

    Later jobs neither repeat the work nor depend on the executors that did it, and they read only
    the columns they need.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
