"""Statistics of loads that add up: stored with each load, merged for totals, compared instead of the rows.

Counts add, newest times take the maximum, distinct values are sketches that unite. A total over all
loads, a comparison of two and the size of the load before read one short row per metric and load,
however long the history is.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources import snapshots

#: 2^14 registers: estimates of distinct values are within 2.5 % in 99.8 % of cases.
PRECISION = 14
COUNT, SHARE, DISTINCT, NEWEST = "count", "share", "distinct", "newest"


def describe(
    df: DataFrame,
    table: str,
    *,
    by: Sequence[str] = (),
    distinct: Sequence[str] = (),
    missing: Mapping[str, Column] | None = None,
    rules: Mapping[str, tuple[Column, Column]] | None = None,
    newest: str | None = None,
) -> DataFrame:
    """Statistics as (``by``, table, metric, kind, part, whole, sketch), from one aggregation.

    The arguments are those of ``operators.profiling.profile``. Without ``by`` an empty table has
    statistics too (all zero, newest NULL); with it, each group of rows has its own.
    """
    n = F.count(F.lit(1))
    stats: list[tuple[str, str, Column, Column | None, Column | None]] = [("row_count", COUNT, n, None, None)]
    for column in distinct:
        sketch = F.hll_sketch_agg(F.col(column).cast("string"), PRECISION)
        stats.append((column, DISTINCT, F.count(column), None, sketch))
    for column, absent in (missing or {}).items():
        stats.append((f"complete_pct_{column}", SHARE, F.count_if(~absent), n, None))
    for name, (scope, broken) in (rules or {}).items():
        stats.append((f"failed_pct_{name}", SHARE, F.count_if(scope & broken), F.count_if(scope), None))
    if newest:
        stats.append((f"newest_{newest}", NEWEST, F.unix_timestamp(F.max(newest)), None, None))
    empty = {"part": F.lit(None).cast("bigint"), "sketch": F.lit(None).cast("binary")}
    rows = [
        F.struct(
            F.lit(metric).alias("metric"), F.lit(kind).alias("kind"), part.alias("part"),
            (empty["part"] if whole is None else whole).alias("whole"),
            (empty["sketch"] if sketch is None else sketch).alias("sketch"),
        )
        for metric, kind, part, whole, sketch in stats
    ]
    wide = df.groupBy(*by).agg(F.array(*rows).alias("__rows"))
    return wide.select(*by, F.lit(table).alias("table"), F.inline("__rows"))


def merge(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Statistics of all loads in ``stats`` together, or of those that share ``by``."""
    return stats.groupBy(*by, "table", "metric", "kind").agg(
        F.when(F.col("kind") == NEWEST, F.max("part")).otherwise(F.sum("part")).alias("part"),
        F.sum("whole").alias("whole"),
        F.hll_union_agg("sketch").alias("sketch"),
    )


def as_profile(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(``by``, table, metric, value) with the names of ``profile``; distinct values are estimates.

    A share of nothing is 0, as it is there.
    """
    part = F.col("part").cast("double")
    share = F.when(F.col("whole") > 0, F.round(part * F.lit(100.0) / F.col("whole"), 2)).otherwise(0.0)
    # More distinct values than values can't be, whatever the sketch says.
    estimate = F.least(F.hll_sketch_estimate("sketch").cast("double"), part)

    def row(metric: Column, value: Column) -> Column:
        return F.struct(metric.alias("metric"), value.alias("value"))

    kind, name = F.col("kind"), F.col("metric")
    values = (
        F.when(kind == DISTINCT, F.array(
            row(F.concat(F.lit("distinct_"), name), estimate),
            row(F.concat(F.lit("surplus_rows_"), name), part - estimate)))
        .when(kind == SHARE, F.array(row(name, share)))
        .otherwise(F.array(row(name, part)))
    )
    return stats.select(*by, "table", F.inline(values))


def store(
    stats: DataFrame, table: str, load_date: dt.date, version: str, column: str = "load_date"
) -> None:
    """Make ``stats`` what is known of one load; ``version`` names the folder of rows they describe."""
    rows = stats.withColumns({"version": F.lit(version), column: F.lit(load_date)})
    snapshots.replace_partition(rows, table, load_date, column)


def stored_rows(
    spark: SparkSession, table: str, stats_table: str, load_date: dt.date, column: str = "load_date"
) -> int | None:
    """Number of rows of one load by its statistics; None if they describe another version than that in force.

    A run that stops between switching the load and its statistics leaves statistics of the version
    before; those are never taken for the new load's.
    """
    if not spark.catalog.tableExists(stats_table):
        return None
    in_force = snapshots.partition_location(spark, table, load_date, column)
    known = spark.table(stats_table).where(
        (F.col(column) == F.lit(load_date)) & (F.col("metric") == "row_count")
    )
    rows = known.select("version", "part").collect()  # one row a load
    same = [r.part for r in rows if in_force and snapshots.version_name(r.version) == snapshots.version_name(in_force)]
    return same[0] if same else None
