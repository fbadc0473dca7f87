"""Releases of several tables, expiry of versions, stored descriptions, errors and samples."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import checks as c
from ledgerloom.plans import products as p
from ledgerloom.queries.basics import _EVENT_DAYS, _events_by_day
from ledgerloom.queries.models import Models, model_sql
from ledgerloom.queries.registry import query, table
from ledgerloom.schemas import DESCRIPTIONS
from ledgerloom.session import materialise, scratch_path
from ledgerloom.sources import layers, releases
from ledgerloom.sources.snapshots import EmptyPartition, chosen_partition, newest

_MARTS = {"by_flag": "l_returnflag", "by_status": "l_linestatus"}
#: Later than any file, so that age keeps no version.
_END = dt.datetime(2200, 1, 1)


def _trial(spark: SparkSession) -> tuple[str, str]:
    """A folder and a layer that no other call uses."""
    root = scratch_path(spark, "releases")
    return root, "trial_" + root.rsplit("-", 1)[1]


def _versions(spark: SparkSession, sf_dir: str, root: str, layer: str, lines: int) -> dict:
    """Versions of both marts from the first ``lines`` lines of each order; path by (layer, name)."""
    items = table(spark, sf_dir, "lineitem").where(F.col("l_linenumber") <= lines)
    out = {}
    for name, column in _MARTS.items():
        mart = items.groupBy(F.col(column).alias("code")).agg(F.count(F.lit(1)).alias("n"))
        out[layer, name] = layers.write_version(mart, root, layer, name)[1]
    return out


def _seen(spark: SparkSession, layer: str, step: str) -> DataFrame:
    """What readers of both marts find now."""
    parts = [spark.table(f"{layer}.{m}").select(F.lit(step).alias("step"), F.lit(m).alias("mart"), "code", "n")
             for m in _MARTS]
    return materialise(reduce(DataFrame.unionByName, parts), "seen")


def _marts_sql(step: str, lines: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{step}' AS step, '{name}' AS mart, {column} AS code, count(*) AS n FROM lineitem "
        f"WHERE l_linenumber <= {lines} GROUP BY ALL"
        for name, column in _MARTS.items()
    )


@query(" UNION ALL ".join([_marts_sql("first", 3), _marts_sql("between", 3), _marts_sql("second", 7)]))
def released_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two marts before, during and after a release.

    The run that makes the second release is stopped when both versions are written and one is in
    the store: readers find the first release whole.
    """
    root, layer = _trial(spark)
    releases.release(spark, root, _versions(spark, sf_dir, root, layer, 3))
    seen = [_seen(spark, layer, "first")]
    later = _versions(spark, sf_dir, root, layer, 7)
    releases.add_version(spark, layer, "by_flag", later[layer, "by_flag"])
    seen.append(_seen(spark, layer, "between"))
    releases.release(spark, root, later)
    seen.append(_seen(spark, layer, "second"))
    return reduce(DataFrame.unionByName, seen)


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS mart, {lines} AS lines, {'true' if kept else 'false'} AS kept, "
    + (f"(SELECT count(DISTINCT {column}) FROM lineitem WHERE l_linenumber <= {lines})" if kept else "NULL")
    + " AS n_rows"
    for name, column in _MARTS.items() for lines, kept in ((1, False), (3, True), (5, False), (7, True))
))
def expired_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions kept and removed: of three releases the two newest stay, of a run without a release nothing."""
    root, layer = _trial(spark)
    lines = {}
    for n in (1, 3, 5, 7):
        paths = _versions(spark, sf_dir, root, layer, n)
        lines |= {path.rsplit("=", 1)[-1]: n for path in paths.values()}
        if n != 5:
            releases.release(spark, root, paths)
    found = releases.expire(spark, root, _END, keep_newest=2, layers=(layer,)).collect()  # a row per version
    rows = []
    for r in found:
        there = [path for path, _ in releases.folders(spark, r.path.rsplit("/", 1)[0]) if path.endswith(r.version)]
        n = spark.read.parquet(there[0]).count() if there else None
        rows.append((r.name, lines[r.version], r.kept, n))
    return spark.createDataFrame(rows, "mart string, lines int, kept boolean, n_rows long")


def _described_sql() -> str:
    comments = {k: v.replace("'", "''") for k, v in DESCRIPTIONS["fct_nutrition"].items() if k}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS col_name, '{text}' AS comment, count({name}) AS n_filled FROM fct_nutrition"
        for name, text in comments.items()
    )


@query(model_sql(_described_sql()))
def stored_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the released fact as the catalogue describes them, and how many rows fill each."""
    models = Models(spark, sf_dir)
    root, layer = _trial(spark)
    _, path = layers.write_version(p.fct_nutrition(models.keyed, models.seeds), root, layer, "fct_nutrition")
    releases.release(spark, root, {(layer, "fct_nutrition"): path})
    fact = spark.table(f"{layer}.fct_nutrition")
    described = spark.sql(f"DESCRIBE {layer}.fct_nutrition").select("col_name", "comment")
    counts = fact.agg(*[F.count(name).alias(name) for name in fact.columns])
    cells = ", ".join(f"'{name}', {name}" for name in fact.columns)
    filled = counts.selectExpr(f"stack({len(fact.columns)}, {cells}) AS (col_name, n_filled)")
    return described.join(filled, "col_name")


@query(f"""
WITH days AS ({_EVENT_DAYS}), ends AS (SELECT max(load_date) AS d FROM days)
SELECT CAST(d AS VARCHAR) AS asked, false AS is_error, (SELECT count(*) FROM days WHERE load_date = d) AS n FROM ends
UNION ALL SELECT CAST(d + 1 AS VARCHAR), true, 0 FROM ends
""")
def absent_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest load and the day after it, which has none: asking for that is an error."""
    days = _events_by_day(spark, sf_dir)
    last = days.select(newest(days).alias("d")).first().d
    rows = []
    for date in (last, last + dt.timedelta(days=1)):
        try:
            rows.append((str(date), False, chosen_partition(days, date).count()))
        except EmptyPartition:
            rows.append((str(date), True, 0))
    return spark.createDataFrame(rows, "asked string, is_error boolean, n long")


@query("""
SELECT least(count(*), 5) AS n_shown, least(count(*), 5) AS n_failing, count(*) AS n_failed FROM (
  SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1 AND o_custkey IS NOT NULL)
""")
def few_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five failing keys to look at: customers with several orders, under a rule that forbids it."""
    orders = table(spark, sf_dir, "orders")
    rule = c.unique("trial", "orders", "o_custkey")
    shown = materialise(c.sample_failures(rule, {"orders": orders}, 5), "few")
    counts = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    right = shown.join(counts, "o_custkey").agg(
        F.count(F.lit(1)).alias("n_shown"), F.count_if(F.col("n_orders") > 1).alias("n_failing")
    )
    n_failed = c.evaluate([rule], {"orders": orders}).select("n_failed")
    return right.crossJoin(n_failed)
