"""Statistics stored with each load: per load, merged over the history, compared."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import checks as c
from ledgerloom.operators import profiling
from ledgerloom.plans import suites
from ledgerloom.queries import check_sql as sql
from ledgerloom.queries.feed import LOAD_DATE, PREVIOUS_DATE, one_load, raw_products
from ledgerloom.queries.models import model_sql
from ledgerloom.queries.quality import _metrics_sql, _pct, _raw_metrics
from ledgerloom.queries.registry import query, table
from ledgerloom.session import materialise
from ledgerloom.sources import statistics

#: Estimates of distinct values are compared up to this share.
TOLERANCE = 0.04
_APART = "(metric LIKE 'distinct%' OR metric LIKE 'surplus%')"

_LINES = {
    "row_count": "count(*)",
    "complete_pct_l_linestatus": _pct("count(*) FILTER (l_linestatus <> 'F')", "count(*)"),
    "failed_pct_discount": _pct("count(*) FILTER (l_returnflag = 'A' AND l_discount > 0.05)",
                                "count(*) FILTER (l_returnflag = 'A')"),
    "newest_shipped": "epoch(max(CAST(l_shipdate AS TIMESTAMP)))",
}


def _lines_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of ``lineitem``, a load being the lines shipped in one month; stored, then read back."""
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {"shipped": F.col("l_shipdate").cast("timestamp"), "month": F.date_format("l_shipdate", "yyyy-MM")}
    )
    flagged = F.col("l_returnflag") == "A"
    stats = statistics.describe(
        lines, "lineitem", by=["month"], distinct=["l_partkey"],
        missing={"l_linestatus": F.col("l_linestatus") == "F"},
        rules={"discount": (flagged, F.col("l_discount") > 0.05)}, newest="shipped",
    )
    return materialise(stats, "statistics")


@query(" UNION ALL ".join(
    f"SELECT strftime(l_shipdate, '%Y-%m') AS month, 'lineitem' AS \"table\", '{metric}' AS metric, "
    f"CAST({value} AS DOUBLE) AS value FROM lineitem GROUP BY 1"
    for metric, value in _LINES.items()
))
def statistics_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored of every load, as a profile; estimates are left to ``merged_statistics``."""
    profiles = statistics.as_profile(_lines_by_month(spark, sf_dir), ["month"])
    return profiles.where(f"NOT {_APART}")


@query(sql.union_all([
    "SELECT *, true AS near FROM (" + _metrics_sql("lineitem", "lineitem", _LINES) + ")",
    """SELECT 'lineitem' AS "table", unnest(['distinct_l_partkey', 'surplus_rows_l_partkey']) AS metric,
CAST(NULL AS DOUBLE) AS value, true AS near""",
]))
def merged_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table's profile, merged from the loads' statistics alone.

    Counts, shares and times are exact. Distinct values are estimates, so only ``near`` is shown: whether the
    estimate and the exact number, counted here from the rows, are within ``TOLERANCE`` of the rows' number
    of values.
    """
    merged = statistics.as_profile(statistics.merge(_lines_by_month(spark, sf_dir)))
    lines = table(spark, sf_dir, "lineitem")
    exact = profiling.profile(lines, "lineitem", distinct=["l_partkey"]).select(
        "metric", F.col("value").alias("exact")
    )
    n_distinct = lines.agg(F.countDistinct("l_partkey")).scalar()
    estimated = F.expr(_APART)
    return merged.join(exact.where(_APART), "metric", "left").select(
        "table", "metric",
        F.when(~estimated, F.col("value")).alias("value"),
        F.when(estimated, F.abs(F.col("value") - F.col("exact")) <= n_distinct * TOLERANCE)
        .otherwise(True).alias("near"),
    )


def _stored_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of both product loads in one pass, as the daily run stores them load by load."""
    raw = raw_products(spark, sf_dir)
    stats = statistics.describe(raw, "raw", by=["load_date"], **suites.raw_metrics())
    return materialise(stats, "statistics")


@query(model_sql(f""", earlier AS (SELECT * FROM raw_products WHERE load_date = DATE '{PREVIOUS_DATE}'),
before AS ({_raw_metrics("earlier")}), after AS ({_raw_metrics("one_load")})
SELECT "table", metric, before.value AS before, after.value AS after,
  before.value IS NOT DISTINCT FROM after.value AS same
FROM before FULL JOIN after USING ("table", metric) WHERE NOT {_APART}
"""))
def compare_stored_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads side by side, from their statistics: no product row is read again."""
    stats = _stored_loads(spark, sf_dir)
    before, after = (
        statistics.as_profile(stats.where(F.col("load_date") == F.lit(day))) for day in (PREVIOUS_DATE, LOAD_DATE)
    )
    return profiling.compare_profiles(before, after).where(f"NOT {_APART}")


@query(model_sql(", verdicts AS (" + sql.union_all([
    sql.line(f"not_dropped_{ratio}", "raw", "not_dropped", "consistency",
             f"(SELECT (SELECT count(*) FROM one_load) AS now, (SELECT count(*) FROM raw_products"
             f" WHERE load_date = DATE '{PREVIOUS_DATE}') AS before)",
             "now", f"CASE WHEN before > 0 AND now < before * {ratio} THEN 1 ELSE 0 END")
    for ratio in ("0.7", "100.0")
]) + ") SELECT \"check\", n_failed FROM verdicts"))
def not_dropped_by_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check of the load's size, the size before taken from stored statistics; it passes and fails once."""
    stats = _stored_loads(spark, sf_dir).where(F.col("load_date") == F.lit(PREVIOUS_DATE))
    n_before = stats.where("metric = 'row_count'").agg(F.max("part")).scalar()
    checks = [c.not_dropped("raw", "raw", n_before, r).named(f"not_dropped_{r}") for r in ("0.7", "100.0")]
    return c.evaluate(checks, {"raw": one_load(spark, sf_dir)}).select("check", "n_failed")
