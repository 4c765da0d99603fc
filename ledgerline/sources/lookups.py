"""Tables laid out for lookups by value: one folder per bucket of the value, files sorted by it, with Bloom filters.

A lookup lists the folder of its value and nothing else, whatever the size of the table; inside, statistics and filters tell
which row groups may have it. A value that many rows have fills several files of its folder, so no task writes or reads all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

BUCKETS = 64
#: Folder columns: how many buckets the table was written with, and which one the rows are in.
OF, BUCKET = "lookup_buckets", "lookup_bucket"


def bucket_of(values: Sequence[Column], buckets: Column | int) -> Column:
    """Bucket of some values; NULL and the empty text share one."""
    texts = [F.coalesce(v.cast("string"), F.lit("")) for v in values]
    of = buckets if isinstance(buckets, Column) else F.lit(buckets)
    return F.pmod(F.xxhash64(*texts), of.cast("long")).cast("int")


def write_lookup(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    *,
    order: Sequence[str] = (),
    filters: Sequence[str] = (),
    buckets: int = BUCKETS,
) -> None:
    """Write ``df`` to a new ``path`` for lookups by the columns ``by``.

    Files are sorted by these and ``order``, and have Bloom filters on these and ``filters``. All rows are kept, repeated ones
    and ones without a value too; an empty table has no files.
    """
    taken = {OF, BUCKET} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"names of folder columns are taken: {sorted(taken)}")
    dealt = df.withColumns({OF: F.lit(buckets), BUCKET: bucket_of([F.col(c) for c in by], buckets)})
    ordered = dealt.hint("rebalance", BUCKET).sortWithinPartitions(OF, BUCKET, *by, *order)
    writer = ordered.write.partitionBy(OF, BUCKET)
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in dict.fromkeys([*by, *filters]):
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def read_lookup(spark: SparkSession, path: str, layout: StructType) -> DataFrame:
    """All rows with their folder columns."""
    folders = [StructField(OF, IntegerType()), StructField(BUCKET, IntegerType())]
    return spark.read.schema(StructType([*layout.fields, *folders])).parquet(path)


def lookup(spark: SparkSession, path: str, layout: StructType, **values) -> DataFrame:
    """Rows with the given values (None finds NULL), which name all columns that the table was written ``by``, in their order."""
    rows = read_lookup(spark, path, layout)
    wanted = [F.lit(v) for v in values.values()]
    rows = rows.filter(F.col(BUCKET) == bucket_of(wanted, F.col(OF)))
    for column, value in values.items():
        rows = rows.filter(F.col(column).isNull() if value is None else F.col(column) == value)
    return rows.select(layout.fieldNames())
