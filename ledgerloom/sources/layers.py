"""Layers of tables and views."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import DESCRIPTIONS
from ledgerloom.sources.files import write_complete

# Fixed values.
LAYERS = ("raw", "staging", "intermediate", "marts", "audit")
#: Catalogue entries of keyed versions that a run works on.
WORK = "work"
#: A table in buckets of the key is read bucket by bucket, so a task writes one bucket.
KEYED_WRITE = {
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}


def create_layers(spark: SparkSession) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """The same columns, described; the description is stored with a saved table."""
    return df.select(
        *[
            F.col(f"`{name}`").alias(name, metadata={"comment": comments[name]})
            if name in comments
            else F.col(f"`{name}`")
            for name in df.columns
        ]
    )


def save_view(df: DataFrame, name: str) -> DataFrame:
    """Session view: staging and intermediate results that are not kept."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_version(df: DataFrame, root: str, layer: str, name: str) -> tuple[DataFrame, str]:
    """Write a new version of a table next to the published one, without touching that."""
    path = new_version(root, layer, name)
    return write_complete(df, path), path


def write_keyed_version(
    df: DataFrame, root: str, layer: str, name: str, key: str
) -> tuple[DataFrame, str]:
    """As ``write_version``, with all rows of a key in one of as many buckets as a shuffle has partitions.

    Grouping the returned table by the key, alone or with more columns, or joining it on the key
    needs no shuffle. Rows that a shuffle by the key has dealt come as one file per bucket. Only
    the catalogue can tell Spark of buckets, so the version has an entry there until ``end_work``.
    """
    spark, path = df.sparkSession, new_version(root, layer, name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {WORK}")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = _work_entry(name, path)
    with _set(spark, KEYED_WRITE):
        df.write.bucketBy(buckets, key).format("parquet").option("path", path).saveAsTable(table)
    return spark.table(table), path


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for a while."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def end_work(spark: SparkSession, name: str, path: str) -> None:
    """Take a keyed version's entry out of the catalogue. Its files stay, and so do tables read from it."""
    spark.sql(f"DROP TABLE IF EXISTS {_work_entry(name, path)}")


def _work_entry(name: str, path: str) -> str:
    return f"{WORK}.{name}_{path.rsplit('=', 1)[-1]}"


def new_version(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}/version={uuid.uuid4().hex}"


def publish(spark: SparkSession, layer: str, name: str, path: str) -> DataFrame:
    """Point the catalogue table at a finished version.

    Rows are neither copied nor moved, and older versions stay on disk for
    readers that still have them open. A table whose columns stay as they are
    only gets a new location, so it is there at every moment.
    """
    comments = DESCRIPTIONS.get(name, {})
    version = with_comments(spark.read.parquet(path), comments)
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + quoted(f.metadata.get("comment"))
        for f in version.schema
    )
    _point(spark, f"{layer}.{name}", version, path, f" ({columns})", quoted(comments.get("")))
    return spark.table(f"{layer}.{name}")


def _point(
    spark: SparkSession, table: str, version: DataFrame, path: str, columns: str = "", comment: str = ""
) -> None:
    """Switch ``table`` to the rows at ``path``; it is made anew only if its layout changed."""

    def layout(df: DataFrame) -> list[tuple]:
        return [(f.name, f.dataType, f.metadata) for f in df.schema]

    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "VIEW":  # of a release
            spark.sql(f"DROP VIEW {table}")
        elif layout(spark.table(table)) == layout(version):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            return
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table}{columns} USING parquet LOCATION '{path}'{comment}")


def quoted(text: str | None) -> str:
    """A comment clause, or nothing."""
    return " COMMENT '" + text.replace("'", "\\'") + "'" if text else ""
