"""Gold tables in versions: a run stages what it changes, audits it, and publishes it by redefining one view.

``name`` is a view over the newest version, which is a catalog table ``name__v<n>`` whose partitions have folders
of their own. A run writes new folders for the partitions that it replaces; the next version lists those and, for
all others, the folders of the version before. Nothing is copied, readers of the view see a run whole or not at
all, and a run that fails or is refused by its audit leaves nothing behind that a reader could see.

Current rows are cut into buckets by their key, so a run rewrites only buckets that it has keys for. Closed versions
are partitioned by the day they ended.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ledgerline.operators.keys import key_columns, with_key
from ledgerline.operators.quality import audit
from ledgerline.operators.scd2 import current, scd2_apply, scd2_rebuild, scd2_replay, undo_day
from ledgerline.session import discard, settle

#: Buckets of the current rows; a table keeps the number that it was created with.
BUCKETS = 64
#: Bucket of closed versions.
CLOSED = -1
#: Versions that stay readable: the newest, and those that a reader may still be at.
KEPT = 2
#: Partitions named in one statement.
PARTITIONS_A_STATEMENT = 500

NO_DAY = "__HIVE_DEFAULT_PARTITION__"

#: A partition: the day its versions ended (None if current), and its bucket.
Part = tuple[str | None, int]


@dataclass(frozen=True)
class State:
    """What the view says about its newest version."""

    name: str
    number: int
    root: str
    keys: tuple[str, ...]
    buckets: int
    marks: Mapping[str, str]

    @property
    def table(self) -> str:
        return f"{self.name}__v{self.number}"


def is_versioned(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def state(spark: SparkSession, name: str) -> State:
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    marks = {k.removeprefix("mark."): v for k, v in found.items() if k.startswith("mark.")}
    keys = tuple(json.loads(found["keys"]))
    return State(name, int(found["version"]), found["root"], keys, int(found["buckets"]), marks)


def create(
    spark: SparkSession,
    name: str,
    layout: StructType,
    keys: Sequence[str],
    *,
    buckets: int = BUCKETS,
    root: str | None = None,
) -> None:
    """An empty versioned table, unless ``name`` exists. Its files lie below ``root``, by default in the warehouse."""
    if spark.catalog.tableExists(name):
        return
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    root = root or f"{warehouse}/{name}-{uuid.uuid4().hex}"
    _publish(spark, State(name, 0, root, tuple(keys), buckets, {}), layout, [])


def drop(spark: SparkSession, name: str) -> None:
    """Remove a table, versioned or not, with its files."""
    if not is_versioned(spark, name):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        return
    at = state(spark, name)
    spark.sql(f"DROP VIEW {name}")
    for number in range(max(0, at.number - KEPT), at.number + 1):
        spark.sql(f"DROP TABLE IF EXISTS {name}__v{number}")
    discard(spark, at.root)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    values = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.pmod(F.xxhash64(*values), F.lit(buckets)).cast("int")


def parts_of(spark: SparkSession, at: State) -> DataFrame:
    """Rows of the newest version with their bucket; filters on it and ``valid_to`` choose the folders that are read."""
    return spark.table(at.table)


def of_key(spark: SparkSession, name: str, layout: StructType, **key) -> DataFrame:
    """All versions of one key: one bucket of current rows, and closed ones whose files may have it."""
    at = state(spark, name)
    values = [F.coalesce(F.lit(key[k]).cast("string"), F.lit("")) for k in at.keys]
    bucket = F.pmod(F.xxhash64(*values), F.lit(at.buckets)).cast("int")
    rows = parts_of(spark, at).filter((F.col("bucket") == CLOSED) | (F.col("bucket") == bucket))
    for k in at.keys:
        rows = rows.filter(F.col(k).eqNullSafe(F.lit(key[k])))
    return rows.select(layout.fieldNames())


# --- publishing ------------------------------------------------------------------------------------


def _folder(root: str, part: Part, run: str) -> str:
    day, bucket = part
    return f"{root}/run={run}/valid_to={day or NO_DAY}/bucket={bucket}"


def _manifest(spark: SparkSession, at: State) -> dict[Part, str]:
    """The run that wrote each partition of a version; as many entries as partitions."""
    lines = spark.read.text(f"{at.root}/manifests/{at.number}").collect()
    entries = [json.loads(r["value"]) for r in lines]
    return {(day, bucket): run for day, bucket, run in entries}


def _publish(
    spark: SparkSession, at: State, layout: StructType, entries: Iterable[tuple[Part, str]]
) -> None:
    """Make ``at`` the newest version. The last statement is what readers notice."""
    entries = sorted(entries, key=repr)
    lines = [(json.dumps([day, bucket, run]),) for (day, bucket), run in entries]
    frame = spark.createDataFrame(lines, "value string").coalesce(1)
    frame.write.mode("overwrite").text(f"{at.root}/manifests/{at.number}")
    spark.sql(f"DROP TABLE IF EXISTS {at.table}")  # of a run that ended before publishing
    stored = [*[f for f in layout.fields if f.name != "valid_to"], layout["valid_to"]]
    stored = [*stored, StructField("bucket", IntegerType())]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored)
    spark.sql(
        f"CREATE TABLE {at.table} ({columns}) USING parquet "
        f"PARTITIONED BY (valid_to, bucket) LOCATION '{at.root}/tables/{at.number}'"
    )
    for i in range(0, len(entries), PARTITIONS_A_STATEMENT):
        clauses = []
        for (day, bucket), run in entries[i : i + PARTITIONS_A_STATEMENT]:
            value = f"'{day}'" if day else "null"
            place = _folder(at.root, (day, bucket), run)
            clauses.append(f"PARTITION (valid_to={value}, bucket={bucket}) LOCATION '{place}'")
        spark.sql(f"ALTER TABLE {at.table} ADD {' '.join(clauses)}")
    facts = {
        "version": str(at.number),
        "root": at.root,
        "keys": json.dumps(list(at.keys)),
        "buckets": str(at.buckets),
        **{f"mark.{k}": v for k, v in at.marks.items()},
    }
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in facts.items())
    shown = ", ".join(f"`{f.name}`" for f in layout.fields)
    spark.sql(
        f"CREATE OR REPLACE VIEW {at.name} TBLPROPERTIES ({properties}) "
        f"AS SELECT {shown} FROM {at.table}"
    )


def replace_parts(
    spark: SparkSession,
    name: str,
    layout: StructType,
    rows: DataFrame,
    replaced: Iterable[Part],
    *,
    required: Sequence[str] = (),
    marks: Mapping[str, str] | None = None,
) -> None:
    """Publish a version in which the partitions ``replaced`` hold ``rows``, once these pass the audit.

    ``rows`` may read the table. A partition of ``replaced`` without rows is gone; rows of any other partition
    are an error. ``marks`` become facts of the version, together with its rows.
    """
    at, replaced = state(spark, name), set(replaced)
    run = uuid.uuid4().hex
    path = f"{at.root}/run={run}"
    bucket = F.when(F.col("valid_to").isNull(), bucket_of(at.keys, at.buckets)).otherwise(CLOSED)
    dealt = rows.select(*layout.fieldNames(), bucket.alias("bucket"))
    # Rows of a partition lie together, unless they are too many for one task; sorted by key, a file's
    # statistics and filters tell whether it has a key.
    ordered = dealt.hint("rebalance", "valid_to", "bucket").sortWithinPartitions(
        "valid_to", "bucket", *at.keys
    )
    writer = ordered.write.partitionBy("valid_to", "bucket")
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for k in at.keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    try:
        writer.parquet(path)
        schema = StructType([*layout.fields, StructField("bucket", IntegerType())])
        staged = spark.read.schema(schema).parquet(path)
        audit(staged, at.keys, required)
        found = staged.select(F.col("valid_to").cast("string"), "bucket").distinct().collect()
        came = {tuple(r) for r in found}
        if not came <= replaced:
            raise ValueError(f"rows of partitions that are not replaced: {sorted(came - replaced)}")
    except Exception:
        discard(spark, path)
        raise
    before = _manifest(spark, at)
    entries = {part: of for part, of in before.items() if part not in replaced}
    entries |= dict.fromkeys(came, run)
    after = State(name, at.number + 1, at.root, at.keys, at.buckets, {**at.marks, **(marks or {})})
    _publish(spark, after, layout, entries.items())
    _vacuum(spark, after)


def _vacuum(spark: SparkSession, at: State) -> None:
    """Remove the version that nobody is expected to read any more, and the folders that only it had."""
    old = at.number - KEPT
    if old < 0:
        return

    def manifest(number: int) -> dict[Part, str]:
        return _manifest(spark, State(at.name, number, at.root, at.keys, at.buckets, {}))

    kept = set().union(*(manifest(n).items() for n in range(old + 1, at.number + 1)))
    for part, run in set(manifest(old).items()) - kept:
        discard(spark, _folder(at.root, part, run))
    spark.sql(f"DROP TABLE IF EXISTS {at.name}__v{old}")
    discard(spark, f"{at.root}/manifests/{old}")


# --- runs ------------------------------------------------------------------------------------------


def _buckets(rows: DataFrame, at: State) -> set[int]:
    """Buckets that the keys of ``rows`` fall into: as many numbers as buckets at most."""
    return {r[0] for r in rows.select(bucket_of(at.keys, at.buckets)).distinct().collect()}


def historize(
    name: str,
    layout: StructType,
    incoming: DataFrame,
    tracked: Sequence[str],
    run_date: dt.date,
    *,
    same_day: str = "redo",
    required: Sequence[str] = (),
    marks: Mapping[str, str] | None = None,
) -> None:
    """Apply one run to a versioned table: the buckets of its keys, and the versions closed on its day.

    ``same_day`` says what a second run of a day does: ``redo`` takes the first one back, so that the table is as
    if only the second had run; ``replace`` overwrites versions opened that day where the second differs; ``strict``
    closes them. ``redo`` is refused once a later day was applied (see ``insert_days``).
    """
    spark = incoming.sparkSession
    at = state(spark, name)
    gold, today = parts_of(spark, at), F.lit(run_date)
    touched = _buckets(incoming, at)
    if same_day == "redo":
        later = any(day and day > run_date.isoformat() for day, _ in _manifest(spark, at))
        open_rows = gold.filter(F.col("valid_to").isNull())
        if later or not open_rows.filter(F.col("valid_from") > today).isEmpty():
            raise ValueError(f"{name} has runs after {run_date}; its day cannot be redone")
        touched |= _buckets(open_rows.filter(F.col("valid_from") == today), at)
        touched |= _buckets(gold.filter(F.col("valid_to") == today), at)
    affected = F.col("valid_to").isNull() & F.col("bucket").isin(sorted(touched))
    part = gold.filter(affected | (F.col("valid_to") == today)).select(layout.fieldNames())
    if same_day == "redo":
        part = undo_day(part, run_date)
    rule = "replace" if same_day == "replace" else "strict"
    after = scd2_apply(part, incoming, at.keys, tracked, run_date, same_day=rule, touched_only=True)
    replaced = {(None, b) for b in touched} | {(run_date.isoformat(), CLOSED)}
    replace_parts(spark, name, layout, after, replaced, required=required, marks=marks)


def historize_days(
    name: str,
    layout: StructType,
    incoming: DataFrame,
    tracked: Sequence[str],
    day: str,
    *,
    required: Sequence[str] = (),
    marks: Mapping[str, str] | None = None,
) -> None:
    """Apply several days of input in one pass; rows older than their key's current version change nothing."""
    spark = incoming.sparkSession
    at = state(spark, name)
    gold, touched = parts_of(spark, at), _buckets(incoming, at)
    # No more days than bronze partitions in the batch.
    days = [r[0] for r in incoming.select(day).distinct().collect()]
    open_rows = gold.filter(F.col("valid_to").isNull() & F.col("bucket").isin(sorted(touched)))
    open_rows = open_rows.select(layout.fieldNames())
    after = scd2_replay(current(open_rows), incoming, at.keys, tracked, day)
    past = gold.filter(F.col("valid_to").isin(days)).select(after.columns)
    replaced = {(None, b) for b in touched} | {(d.isoformat(), CLOSED) for d in days}
    rows = after.unionByName(past)
    replace_parts(spark, name, layout, rows, replaced, required=required, marks=marks)


def insert_days(
    name: str,
    layout: StructType,
    observed: DataFrame,
    tracked: Sequence[str],
    day: str,
    *,
    required: Sequence[str] = (),
    marks: Mapping[str, str] | None = None,
) -> None:
    """Enter rows of any days into the timelines of their keys, as if all days had come in order.

    ``observed`` has every row of those keys from its first day on, not only the late ones: a version stands for all
    days that said the same, so what lies between two versions is not in the table.
    """
    spark = observed.sparkSession
    at = state(spark, name)
    gold, names = parts_of(spark, at), key_columns(at.keys)
    keys = with_key(observed.select(*at.keys), at.keys).select(*names).distinct()
    keyed = with_key(gold, at.keys)
    mine = keyed.join(keys, names, "left_semi").select(layout.fieldNames())
    # Its days are asked for before it is written.
    versions = settle(scd2_rebuild(mine, observed, at.keys, tracked, day))
    # Days on which versions of these keys end, before or after: at most the table's and the batch's.
    ends = mine.select("valid_to").unionByName(versions.select("valid_to")).distinct().dropna()
    days = [r[0] for r in ends.collect()]
    touched = _buckets(observed, at)
    open_rows = F.col("valid_to").isNull() & F.col("bucket").isin(sorted(touched))
    part = keyed.filter(open_rows | F.col("valid_to").isin(days))
    others = part.join(keys, names, "left_anti").select(layout.fieldNames())
    replaced = {(None, b) for b in touched} | {(d.isoformat(), CLOSED) for d in days}
    rows = others.unionByName(versions.select(layout.fieldNames()))
    replace_parts(spark, name, layout, rows, replaced, required=required, marks=marks)
