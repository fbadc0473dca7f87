"""Resolving a list of tags against a priority-ranked mapping, and key matching."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# A mapping up to this many rows is put into the plan itself.
MAPPING_ROWS_IN_PLAN = 500


def small_rows(df: DataFrame, cap: int) -> list[Row] | None:
    """All rows if there are at most ``cap``, else None. Never fetches more than ``cap + 1``."""
    rows = df.limit(cap + 1).collect()
    return rows if len(rows) <= cap else None


def best_tag(
    df: DataFrame,
    key: str,
    tags: str,
    mapping: DataFrame,
    *,
    tag: str,
    target: str,
    priority: str = "priority",
    cap: int = MAPPING_ROWS_IN_PLAN,
) -> DataFrame:
    """Add ``matched_tag`` and ``matched_target``: lowest priority wins, then the first tag.

    Tags match regardless of case. ``key`` identifies a row of ``df``; rows with
    a NULL key stay unmatched, as they would in a join on the key.

    With a mapping of checked small size each row is resolved on its own, without
    any shuffle. Beyond the cap each distinct list of tags is resolved by a join, the candidates
    reduced per list before and after the shuffle, and the winners joined back on the list. Both
    ways give every row the winner of its own tags, so the cap changes the plan alone.
    """
    mapping = mapping.select(
        F.lower(tag).alias("tag"), F.col(target).alias("target"), F.col(priority).alias("priority")
    ).where(F.col("tag").isNotNull())
    rows = small_rows(mapping, cap)
    if rows is None:
        return _best_tag_by_join(df, key, tags, mapping)
    return _best_tag_in_plan(df, key, tags, rows)


def _best_tag_in_plan(df: DataFrame, key: str, tags: str, rows: list[Row]) -> DataFrame:
    ordered = sorted(
        rows,
        key=lambda r: (r.priority is None, r.priority or 0, r.tag, r.target is not None, r.target or ""),
    )
    if not ordered:
        nothing = F.lit(None).cast("string")
        return df.withColumns({"matched_tag": nothing, "matched_target": nothing})
    # Sorted by (priority, tag): the winner is the tag with the lowest position.
    names = _constant_list([row.tag for row in ordered])
    targets = _constant_list([row.target for row in ordered])
    # Membership is a hash probe; only the few tags that pass are looked up in the list.
    listed = sorted({row.tag for row in ordered})
    known = F.filter(F.transform(tags, F.lower), lambda t: t.isin(listed))
    position = F.array_min(F.transform(known, lambda t: F.array_position(names, t)))
    index = F.when(F.col(key).isNotNull(), (position - 1).cast("int"))
    return (
        df.withColumn("__index", index)
        .withColumns(
            {
                "matched_tag": F.get(names, F.col("__index")),
                "matched_target": F.get(targets, F.col("__index")),
            }
        )
        .drop("__index")
    )


def _constant_list(texts: list[str | None]) -> Column:
    """An array that Spark folds into one constant, instead of one Column per element."""
    return F.from_json(F.lit(json.dumps(texts)), "array<string>")


def _best_tag_by_join(df: DataFrame, key: str, tags: str, mapping: DataFrame) -> DataFrame:
    lists = df.where(F.col(key).isNotNull()).select(F.col(tags).alias("__tags")).distinct()
    candidates = (
        lists.select("__tags", F.explode("__tags").alias("tag"))
        .withColumn("tag", F.lower("tag"))
        .join(mapping, "tag")
    )
    # NULL priorities rank last, as they do in an ascending sort.
    rank = F.struct(F.col("priority").isNull().alias("no_priority"), "priority", "tag", "target")
    winners = candidates.groupBy("__tags").agg(F.min(rank).alias("best"))
    return (
        df.join(winners, (F.col(tags) == F.col("__tags")) & F.col(key).isNotNull(), "left")
        .withColumns({"matched_tag": F.col("best.tag"), "matched_target": F.col("best.target")})
        .drop("__tags", "best")
    )


def with_parent(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child rows whose key occurs in the parent."""
    keys = parent.select(F.col(parent_key).alias(key))
    return child.join(keys, key, "left_semi")


def without_parent(
    child: DataFrame, parent: DataFrame, key: str, parent_key: str, null_is_orphan: bool = False
) -> DataFrame:
    """Child rows whose key does not occur in the parent.

    A NULL key passes a foreign-key test but breaks a contract, hence the flag.
    """
    if not null_is_orphan:
        child = child.where(F.col(key).isNotNull())
    keys = parent.select(F.col(parent_key).alias(key))
    return child.join(keys, key, "left_anti")
