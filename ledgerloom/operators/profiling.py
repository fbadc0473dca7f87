"""Profile metrics of a table, and their comparison between two loads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(
    df: DataFrame,
    table: str,
    *,
    distinct: Sequence[str] = (),
    missing: Mapping[str, Column] | None = None,
    rules: Mapping[str, tuple[Column, Column]] | None = None,
    newest: str | None = None,
) -> DataFrame:
    """Metrics as (table, metric, value), from one aggregation.

    Row count; distinct values and surplus rows per key column; percentage of
    complete rows per column of ``missing``; percentage of rows in scope that
    break each rule, given as (in scope, broken); newest time as epoch seconds.
    """
    n = F.count(F.lit(1)).cast("double")
    metrics: dict[str, Column] = {"row_count": n}
    for column in distinct:
        values = F.countDistinct(column).cast("double")
        metrics[f"distinct_{column}"] = values
        metrics[f"surplus_rows_{column}"] = F.count(column).cast("double") - values
    for column, absent in (missing or {}).items():
        metrics[f"complete_pct_{column}"] = _percent(F.count_if(~absent), n)
    for name, (scope, broken) in (rules or {}).items():
        metrics[f"failed_pct_{name}"] = _percent(F.count_if(scope & broken), F.count_if(scope))
    if newest:
        metrics[f"newest_{newest}"] = F.unix_timestamp(F.max(newest)).cast("double")
    wide = df.agg(*[column.alias(name) for name, column in metrics.items()])
    rows = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics]
    return wide.select(F.lit(table).alias("table"), F.inline(F.array(*rows)))


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * F.lit(100.0) / whole, 2)).otherwise(0.0)


def compare_profiles(before: DataFrame, after: DataFrame) -> DataFrame:
    """Metrics side by side; a metric that one side lacks differs."""
    keys = ["table", "metric"]
    joined = before.select(*keys, F.col("value").alias("before")).join(
        after.select(*keys, F.col("value").alias("after")), keys, "full"
    )
    return joined.withColumn("same", F.col("before").eqNullSafe(F.col("after")))
