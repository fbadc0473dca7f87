"""Every kind of check on the given tables, with parameters that make some rows fail."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import checks as c
from ledgerloom.operators.checks import Limits
from ledgerloom.queries import check_sql as sql
from ledgerloom.queries.registry import query, table
from ledgerloom.sources.snapshots import chosen_partition

LAYER = "source"
LAST_DAY = "2024-01-30"
AS_OF = dt.datetime(2024, 2, 1, 3, 0, tzinfo=dt.timezone.utc)


@query(sql.union_all([
    sql.unique(LAYER, "lineitem", "l_orderkey"),
    sql.unique(LAYER, "lineitem", "l_partkey", "coalesce(sum(n) FILTER (n > 1), 0)"),
]))
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicated values, and rows that carry them."""
    checks = [
        c.unique(LAYER, "lineitem", "l_orderkey"),
        c.unique(LAYER, "lineitem", "l_partkey", count_rows=True),
    ]
    return c.evaluate(checks, {"lineitem": table(spark, sf_dir, "lineitem")})


@query(sql.unique_combination(LAYER, "lineitem", "l_orderkey", "l_linenumber"))
def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = c.unique_combination(LAYER, "lineitem", "l_orderkey", "l_linenumber")
    return c.evaluate([check], {"lineitem": table(spark, sf_dir, "lineitem")})


_EVENTS_WITH_GAPS = (
    "WITH gaps AS (SELECT event_id, nullif(event_type, 'error') AS event_type,"
    " CASE WHEN value < 100 THEN value END AS value FROM events)\n"
)


def _events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.when(F.col("value") < 100, F.col("value")).alias("value"),
    )


@query(_EVENTS_WITH_GAPS + sql.union_all([
    sql.not_null(LAYER, "gaps", "event_id"),
    sql.not_null(LAYER, "gaps", "event_type"),
    sql.not_null(LAYER, "gaps", "value", **sql.share_limit("0.10")),
]))
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        c.not_null(LAYER, "gaps", "event_id"),
        c.not_null(LAYER, "gaps", "event_type"),
        c.not_null(LAYER, "gaps", "value", share="0.10"),
    ]
    return c.evaluate(checks, {"gaps": _events_with_gaps(spark, sf_dir)})


@query(_EVENTS_WITH_GAPS + sql.union_all([
    sql.accepted(LAYER, "gaps", "event_type", ("view", "click")),
    sql.accepted(LAYER, "gaps", "event_id", ("0", "1")).replace(
        "NOT IN ('0', '1')", "NOT IN (0, 1)"),
]))
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        c.accepted_values(LAYER, "gaps", "event_type", ("view", "click")),
        c.accepted_values(LAYER, "gaps", "event_id", (0, 1)),
    ]
    return c.evaluate(checks, {"gaps": _events_with_gaps(spark, sf_dir)})


@query("""
WITH bought AS (SELECT o_orderkey, nullif(o_custkey, 7) AS o_custkey FROM orders),
solvent AS (SELECT * FROM customer WHERE c_acctbal >= 0)
""" + sql.union_all([
    sql.relationship(LAYER, "bought", "o_custkey", "solvent", "c_custkey"),
    sql.relationship(LAYER, "bought", "o_custkey", "solvent", "c_custkey", True, "null_is_orphan"),
]))
def dq_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan keys; a NULL key counts in the second check only."""
    bought = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_custkey", F.lit(7)).alias("o_custkey")
    )
    keys = (LAYER, "bought", "o_custkey", "solvent", "c_custkey")
    checks = [c.relationship(*keys), c.relationship(*keys, null_is_orphan=True).named("null_is_orphan")]
    solvent = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    return c.evaluate(checks, {"bought": bought, "solvent": solvent})


@query(sql.union_all([
    sql.expression(LAYER, "customer", "balance", "c_acctbal >= 0", **sql.over(1000)),
    sql.expression(LAYER, "customer", "segment", "c_mktsegment <> 'NONE'"),
]))
def dq_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        c.expression_is_true(
            LAYER, "customer", "balance", F.col("c_acctbal") >= 0, Limits(warn_above=0, error_above=1000)
        ),
        c.expression_is_true(LAYER, "customer", "segment", F.col("c_mktsegment") != "NONE"),
    ]
    return c.evaluate(checks, {"customer": table(spark, sf_dir, "customer")})


@query(sql.union_all([
    sql.between("value_between_lineitem_l_quantity_5_45", LAYER, "lineitem", "l_returnflag = 'A'",
                "l_quantity", 5, 45, **sql.over(100)),
    sql.between("value_between_lineitem_l_discount_0_1", LAYER, "lineitem", "true", "l_discount", 0, 1),
]))
def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        c.value_between(
            LAYER, "lineitem", "l_quantity", 5, 45, Limits(warn_above=0, error_above=100),
            only=F.col("l_returnflag") == "A",
        ),
        c.value_between(LAYER, "lineitem", "l_discount", 0, 1),
    ]
    return c.evaluate(checks, {"lineitem": table(spark, sf_dir, "lineitem")})


_LONG_SQL = """
WITH long AS (
  SELECT l_orderkey, unnest(['quantity', 'discount', 'tax']) AS measure,
    unnest([CAST(l_quantity AS DECIMAL(15,2)), CAST(l_discount AS DECIMAL(15,2)) * 100,
      CASE WHEN l_returnflag = 'A' THEN CAST(l_tax AS DECIMAL(15,2)) * 100 END]) AS amount
  FROM lineitem),
present AS (SELECT * FROM long WHERE amount IS NOT NULL)
"""


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    def entry(name: str, amount):
        return F.struct(F.lit(name).alias("measure"), amount.cast("decimal(19,2)").alias("amount"))

    tax = F.when(F.col("l_returnflag") == "A", F.col("l_tax").cast("decimal(15,2)") * 100)
    entries = F.array(
        entry("quantity", F.col("l_quantity").cast("decimal(15,2)")),
        entry("discount", F.col("l_discount").cast("decimal(15,2)") * 100),
        entry("tax", tax),
    )
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", F.inline(entries)).where(F.col("amount").isNotNull())


@query(_LONG_SQL + sql.component_sum(
    LAYER, "present", "l_orderkey", "measure", "amount", ("quantity", "discount", "tax"), 60, **sql.over(10)))
def dq_component_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that have all three measures, and whose measures sum to more than 60."""
    check = c.component_sum_at_most(
        LAYER, "present", "l_orderkey", "measure", "amount", ("quantity", "discount", "tax"), 60,
        Limits(warn_above=0, error_above=10),
    )
    return c.evaluate([check], {"present": _long(spark, sf_dir)})


@query(_LONG_SQL + sql.ratio(
    LAYER, "present", "l_orderkey", "measure", "amount", "quantity", "discount", "5.5", "0.25", "2",
    **sql.over(100_000)))
def dq_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    check = c.ratio_consistent(
        LAYER, "present", "l_orderkey", "measure", "amount", "quantity", "discount", "5.5", "0.25", "2",
        Limits(warn_above=0, error_above=100_000),
    )
    return c.evaluate([check], {"present": _long(spark, sf_dir)})


_DAY_SQL = f"""
WITH days AS (SELECT *, CAST(ts AS DATE) AS load_date FROM events),
today AS (SELECT * FROM days WHERE load_date = DATE '{LAST_DAY}'),
sizes AS (SELECT (SELECT count(*) FROM today) AS now, (SELECT count(*) FROM days WHERE load_date =
  (SELECT max(load_date) FROM days WHERE load_date < DATE '{LAST_DAY}')) AS before)
"""


@query(_DAY_SQL + sql.union_all([
    sql.line("row_count_today", LAYER, "row_count", "completeness", "today", sql.ROWS,
             "CASE WHEN count(*) BETWEEN 50 AND 1000 THEN 0 ELSE 1 END"),
    *[
        sql.line(f"not_dropped_{ratio}", LAYER, "not_dropped", "consistency", "sizes", "now",
                 f"CASE WHEN before > 0 AND now < before * {ratio} THEN 1 ELSE 0 END")
        for ratio in ("0.7", "1.5")
    ],
    sql.line("fresh_today_ts", LAYER, "fresh", "timeliness", "today", sql.ROWS,
             "CASE WHEN max(ts) < TIMESTAMP '2024-02-01 03:00:00' - INTERVAL 26 HOURS THEN 1 ELSE 0 END"),
    sql.line("fresh_two_limits", LAYER, "fresh", "timeliness", "today", sql.ROWS,
             "CASE WHEN max(ts) < TIMESTAMP '2024-02-01 03:00:00' - INTERVAL 26 HOURS THEN 1 ELSE 0 END",
             **sql.over(1)),
]))
def dq_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of one day, its drop against the day before, and its age."""
    days = table(spark, sf_dir, "events").withColumns(
        {"ts": F.col("ts").cast("timestamp"), "load_date": F.to_date("ts")}
    )
    earlier = days.where(F.col("load_date") < F.lit(LAST_DAY).cast("date"))
    previous = days.where(F.col("load_date") == earlier.agg(F.max("load_date")).scalar())
    n_previous = previous.agg(F.count(F.lit(1))).scalar()
    checks = [
        c.row_count_between(LAYER, "today", 50, 1000),
        c.not_dropped(LAYER, "today", n_previous, "0.7").named("not_dropped_0.7"),
        c.not_dropped(LAYER, "today", n_previous, "1.5").named("not_dropped_1.5"),
        c.fresh(LAYER, "today", "ts", AS_OF, 26),
        c.fresh(LAYER, "today", "ts", AS_OF, 48, 26).named("fresh_two_limits"),
    ]
    return c.evaluate(checks, {"today": chosen_partition(days, LAST_DAY)})


@query("""
SELECT count(*) AS n_total, CAST(1 AS BIGINT) AS n_failed FROM events
HAVING max(ts) < TIMESTAMP '2024-02-01 03:00:00' - INTERVAL 26 HOURS
""")
def stale_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row if the newest event is too old, else none."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    stale = c.fresh(LAYER, "events", "ts", AS_OF, 26).failing({"events": events})
    return stale.withColumn("n_failed", F.col("n_failed").cast("bigint"))


@query(sql.line("matches_documents_text", LAYER, "matches", "validity", "documents", "count(text)",
                "count(*) FILTER (NOT regexp_matches(text, '[0-9]{3}'))", **sql.share_limit("0.50")))
def dq_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of texts with three digits in a row."""
    has_digits = F.col("text").rlike("[0-9]{3}")
    check = c.matches_mostly(LAYER, "documents", "text", has_digits, "0.50")
    return c.evaluate([check], {"documents": table(spark, sf_dir, "documents")})


@query(sql.union_all([
    sql.complete(LAYER, "documents", "text", "text IS NULL OR n_chars < 200", "0.05"),
    sql.complete(LAYER, "documents", "lang", "lang IS NULL OR lang = 'en'", "0.80"),
]))
def dq_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = F.col("text").isNull() | (F.col("n_chars") < 200)
    english = F.col("lang").isNull() | (F.col("lang") == "en")
    checks = [
        c.complete_mostly(LAYER, "documents", "text", short, "0.05"),
        c.complete_mostly(LAYER, "documents", "lang", english, "0.80"),
    ]
    return c.evaluate(checks, {"documents": table(spark, sf_dir, "documents")})


@query(sql.line("required_columns_pages", LAYER, "required_columns", "validity",
                "(SELECT count(*) AS n FROM pages)", "4 + 0 * n", "1 + 0 * n"))
def dq_required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of the four columns exist."""
    check = c.required_columns(LAYER, "pages", ("page_id", "url", "html", "fetched_at"))
    return c.evaluate([check], {"pages": table(spark, sf_dir, "pages")})
