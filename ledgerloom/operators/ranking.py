"""Keeping the first rows of each group.

Spark puts a group limit in front of the shuffle for every ``row_number() <= n``
filter, so of a group that holds a third of all rows each task sends on at most
``n`` rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.nested import nested_columns

_RANK = "__rank"
_BEST = "__best"


def total_order(df: DataFrame, placed: Sequence[str], order: Sequence[Column]) -> list[Column]:
    """``order`` followed by every column that isn't ``placed``, plain ones before nested ones.

    Rows that still tie are equal, so the result does not depend on how the
    input is split. Columns are named, not packed: nothing is added to the rows.
    """
    nested = nested_columns(df.schema)
    plain = [c for c in df.columns if c not in nested and c not in placed]
    return [*order, *[F.col(c).asc_nulls_first() for c in [*plain, *nested]]]


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, ordered: Sequence[str] = ()
) -> DataFrame:
    """First ``n`` rows of every group; NULL keys form one group.

    Columns that ``order`` sorts as they are may be named in ``ordered``: they are not compared twice.
    """
    window = Window.partitionBy(*keys).orderBy(*total_order(df, [*keys, *ordered], order))
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK)


def latest_per_key(df: DataFrame, keys: Sequence[str], *times: str) -> DataFrame:
    """Newest row per key. A row without a time counts as newest, NULL sorting as the largest value."""
    return top_per_group(df, keys, [F.col(t).desc_nulls_first() for t in times], ordered=times)


def latest_then_built(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], times: Sequence[str], built: Mapping[str, Column]
) -> DataFrame:
    """As ``latest_per_key`` of ``columns`` and ``built``, which are made after the rows have moved.

    ``built`` are columns computed from others of ``df``, which may be fewer and narrower. Only those others
    and the keys are shuffled, and only they and the times are sorted, once for each key's task: a sort in
    front of the shuffle would hold a whole input split and spill it. So keys should have few versions; all
    rows of a key reach its task. Rows that tie in all times are built, and the smallest of them is kept, plain
    columns before nested ones.
    """
    names = [*columns, *[c for c in built if c not in columns]]
    made = {c: built.get(c, F.col(c)).alias(c) for c in names}
    nested = nested_columns(df.select(*made.values()).schema)
    placed = {*keys, *times}
    rest = [*[c for c in names if c not in nested and c not in placed], *nested]
    moved = df.repartition(*keys).withColumns({t: built[t] for t in times if t in built})
    window = Window.partitionBy(*keys).orderBy(*[F.col(t).desc_nulls_first() for t in times])
    tied = moved.withColumn(_RANK, F.rank().over(window)).where(F.col(_RANK) == 1)
    best = F.struct(*[made[c] for c in rest], *times)
    newest = tied.select(*keys, best.alias(_BEST)).groupBy(*keys).agg(F.min(_BEST).alias(_BEST))
    return newest.select(*keys, *[F.col(f"{_BEST}.{c}").alias(c) for c in [*times, *rest]])


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def most_common_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per key: the most frequent value (ties in binary order) and the number of rows.

    Rows are counted per (key, value) before anything is grouped by key alone,
    so a key that most rows share arrives as one count per value and task.
    """
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col(value).alias("value")))
    return (
        count_by(df, key, value)
        .groupBy(key)
        .agg(best.alias("best"), F.sum("n").alias("n_rows"))
        .select(key, F.col("best.value").alias(value), "n_rows")
    )
