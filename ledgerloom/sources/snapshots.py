"""Dated snapshots: loading one, replacing one, choosing one."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.nested import has_member
from ledgerloom.schemas import RAW, SNAPSHOT
from ledgerloom.sources import releases

#: Folder in a table's own where the versions of its partitions are.
VERSIONS = "_versions"


class EmptyPartition(ValueError):
    """The asked load does not exist."""


def extract_snapshot(
    source: DataFrame, load_date: dt.date, tag: str | None, loaded_at: dt.datetime
) -> DataFrame:
    """Rows whose country list holds ``tag``, in the snapshot layout.

    ``code`` is renamed, ``loaded_at`` is one value for the whole load. Only the
    listed columns reach the scan. Fields of nested values are taken by name,
    whatever else the source has beside them; text that is no number is NULL.
    """
    types = {f.name: f.dataType for f in source.schema}
    names = {f.name: "code" if f.name == "barcode" else f.name for f in SNAPSHOT}
    if lacking := sorted(set(names.values()) - set(types)):
        raise ValueError(f"the source lacks {', '.join(lacking)}")
    wanted = source.where(has_member("countries_tags", tag)) if tag else source
    columns = [
        by_name(F.col(names[f.name]), types[names[f.name]], f.dataType).alias(f.name) for f in SNAPSHOT
    ]
    return wanted.select(
        *columns,
        F.lit(load_date).cast("date").alias("load_date"),
        F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
    )


def by_name(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` in another type: nested fields by name, those it lacks NULL, bad numbers NULL."""
    if have == want:
        return column
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda e: by_name(e, have.elementType, want.elementType))
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        fields = [
            (by_name(column[f.name], have[f.name].dataType, f.dataType) if f.name in have.names
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want
        ]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column.try_cast(want)


def replace_partition(
    df: DataFrame, table: str, load_date: dt.date, column: str = "load_date"
) -> None:
    """Make ``df`` the whole content of one partition; a second run changes nothing.

    The rows are written beside the partition, which then gets another location: readers see the
    load before until that one write, and after it the new one, also when that is empty.
    """
    switch_partition(df.sparkSession, table, load_date, write_partition(df, table, load_date, column), column)


def write_partition(
    df: DataFrame, table: str, load_date: dt.date, column: str = "load_date"
) -> str:
    """Write a version of one partition where no reader looks, and return its folder.

    Rows are evened out first, since a selective extract leaves a sliver in each of its tasks
    and would store one tiny file per task.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.limit(0).write.partitionBy(column).format("parquet").saveAsTable(table)
    known = set(spark.table(table).columns)
    added = [f for f in df.schema if f.name not in known]
    if added:
        types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({types})")
    # Columns the load lacks become NULL, those in the table keep their order.
    columns = [
        (F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in spark.table(table).schema
        if f.name != column
    ]
    # Names that begin with an underscore are hidden from listings of the table's folder.
    path = f"{_location(spark, table)}/{VERSIONS}/{column}={load_date.isoformat()}/version={uuid.uuid4().hex}"
    df.select(*columns).hint("rebalance").write.parquet(path)
    return path


def switch_partition(
    spark: SparkSession, table: str, load_date: dt.date, path: str, column: str = "load_date"
) -> None:
    """Point one partition at a finished version; the version before stays for readers that have it open."""
    named = f"PARTITION ({column} = DATE'{load_date.isoformat()}')"
    if spark.sql(f"SHOW PARTITIONS {table} {named}").isEmpty():
        spark.sql(f"ALTER TABLE {table} ADD {named} LOCATION '{path}'")
    else:
        spark.sql(f"ALTER TABLE {table} {named} SET LOCATION '{path}'")


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[-1].data_type.rstrip("/")


def partition_location(
    spark: SparkSession, table: str, load_date: dt.date, column: str = "load_date"
) -> str | None:
    """Folder of the version of one partition that readers see, None without the partition."""
    named = f"PARTITION ({column} = DATE'{load_date.isoformat()}')"
    if spark.sql(f"SHOW PARTITIONS {table} {named}").isEmpty():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {named}").where("col_name = 'Location'")
    return described.first().data_type.rstrip("/")


def version_name(path: str) -> str:
    """What tells a version's folder from all others, however the store spells its path."""
    return path.rstrip("/").rsplit("/", 1)[-1]


def expire_partition_versions(
    spark: SparkSession, table: str, keep_since: dt.datetime, column: str = "load_date"
) -> list[tuple[str, bool]]:
    """Remove the versions of partitions that are not in force and older than ``keep_since``.

    Returns every version's folder and whether it was kept. ``keep_since`` is in UTC.
    """
    out = []
    for partition, _ in releases.folders(spark, f"{_location(spark, table)}/{VERSIONS}"):
        date = partition.rstrip("/").rsplit("=", 1)[-1]
        named = f"PARTITION ({column} = DATE'{date}')"
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {named}").where("col_name = 'Location'")
        in_force = {r.data_type.rsplit("=", 1)[-1] for r in described.collect()}
        for path, old in releases.folders(spark, partition, keep_since):
            kept = not old or path.rsplit("=", 1)[-1] in in_force
            if not kept:
                releases.remove_folder(spark, path)
            out.append((path, kept))
    return out


def latest_partition(df: DataFrame, column: str = "load_date") -> DataFrame:
    """Rows of the newest load.

    The newest date is a scalar subquery, which Spark turns into a partition
    filter; joining the table with its own maximum would read every partition.
    """
    return df.where(F.col(column) == newest(df, column))


def newest(df: DataFrame, column: str = "load_date") -> Column:
    return df.agg(F.max(column)).scalar()


def chosen_partition(
    df: DataFrame, load_date: dt.date | str, column: str = "load_date", required: bool = True
) -> DataFrame:
    """Rows of one named load; an error if there are none and ``required`` is set."""
    chosen = df.where(F.col(column) == F.lit(str(load_date)).cast("date"))
    if required and chosen.isEmpty():
        raise EmptyPartition(f"no rows with {column} = {load_date}; leave the date out for the newest")
    return chosen


def previous_partition(df: DataFrame, load_date: dt.date | str, column: str = "load_date") -> Column:
    """Newest load before ``load_date`` as a scalar, NULL if it is the first."""
    earlier = df.where(F.col(column) < F.lit(str(load_date)).cast("date"))
    return earlier.agg(F.max(column)).scalar()


def newest_load_date(spark: SparkSession, table: str, column: str = "load_date") -> dt.date | None:
    """Newest load of a catalogue table that has rows, from its list of partitions."""
    return load_date_before(spark, table, None, column)


def load_date_before(
    spark: SparkSession, table: str, load_date: dt.date | None, column: str = "load_date"
) -> dt.date | None:
    """Newest load with rows before ``load_date``, or of all, from the list of partitions.

    Reads no data beyond one row per partition tried: with millions of files
    the list is far cheaper than a maximum over their footers.
    """
    listed = spark.sql(f"SHOW PARTITIONS {table}").collect()  # one entry per load
    dates = (dt.date.fromisoformat(row.partition.split("=", 1)[1]) for row in listed)
    for date in sorted((d for d in dates if load_date is None or d < load_date), reverse=True):
        if not spark.table(table).where(F.col(column) == F.lit(date)).isEmpty():
            return date
    return None


def conform_to_raw(df: DataFrame) -> DataFrame:
    """Columns of the raw layout; those an older load lacks are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in RAW
        ]
    )
