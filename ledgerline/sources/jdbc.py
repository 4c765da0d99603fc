"""Serving store over JDBC."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from ledgerline.operators.quality import not_null, unique_version
from ledgerline.session import settle

DRIVER = "org.postgresql.Driver"


def jdbc_url(env: Mapping[str, str] = os.environ) -> str:
    host, port = env.get("POSTGRES_HOST", "localhost"), env.get("POSTGRES_PORT", "5432")
    return f"jdbc:postgresql://{host}:{port}/{env['POSTGRES_SERVING_DB']}"


def jdbc_properties(env: Mapping[str, str] = os.environ, driver: str = DRIVER) -> dict[str, str]:
    return {
        "user": env["POSTGRES_USER"],
        "password": env["POSTGRES_PASSWORD"],
        "driver": driver,
    }


def column_types(layout: StructType) -> str:
    """Types for creating the serving table where Spark's own choice would differ from the contract."""
    names = {StringType: "TEXT", DoubleType: "DOUBLE PRECISION"}
    return ", ".join(
        f"{f.name} {names[type(f.dataType)]}" for f in layout.fields if type(f.dataType) in names
    )


def replace_served(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    keys: Sequence[str],
    required: Sequence[str] = (),
    connections: int = 16,
) -> int:
    """Empty the serving table, keeping it and its indexes, write ``df`` into it, return the row count.

    The rows must be unique per key and start day, which the serving table's index demands, and fill
    the ``required`` columns; that is checked before anything is emptied. The rows are counted while
    they are written. ``connections`` bounds how many tasks read the settled rows and write them to the
    database at once.
    """
    df = settle(df)  # what is checked is what is written
    if not unique_version(df, keys).isEmpty():
        raise ValueError(f"several rows share {[*keys, 'valid_from']}")
    if required and not (gaps := not_null(df, required)).isEmpty():
        raise ValueError(f"required columns hold NULL: {[r['column'] for r in gaps.collect()]}")
    written = Observation(f"served-{uuid.uuid4().hex}")
    (
        df.coalesce(connections)
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.option("truncate", "true")
        .option("createTableColumnTypes", column_types(df.schema))
        .jdbc(url=url, table=table, mode="overwrite", properties=dict(properties))
    )
    return written.get["rows"]
