from __future__ import annotations

import datetime as dt

import pytest
from fixture_rows import LOAD_DATE, LOADED_AT, SHELF, Product, raw
from pyspark.sql import functions as F

from ledgerloom.operators import profiling
from ledgerloom.plans import daily, suites
from ledgerloom.sources import statistics
from ledgerloom.sources.snapshots import switch_partition, write_partition


def values(profile):
    return {r.metric: r.value for r in profile.collect()}


def test_one_load_has_the_values_of_its_profile(spark):
    load = raw(spark, SHELF)
    got = values(statistics.as_profile(suites.raw_statistics(load)))
    assert got == values(profiling.profile(load, "raw", **suites.raw_metrics()))


def test_an_empty_load_has_statistics(spark):
    load = raw(spark, SHELF).limit(0)
    got = values(statistics.as_profile(suites.raw_statistics(load)))
    assert got == values(profiling.profile(load, "raw", **suites.raw_metrics()))
    assert got["row_count"] == 0 and got["newest_loaded_at"] is None


def test_merged_loads_have_the_values_of_all_rows(spark):
    df = spark.range(3000).select(
        (F.col("id") % 7).alias("day"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 400).alias("k"),
        F.timestamp_seconds(F.col("id")).alias("at"),
    )
    what = {"distinct": ["k"], "missing": {"k": F.col("k").isNull()},
            "rules": {"big": (F.col("k") > 10, F.col("k") > 300), "none": (F.col("k") < 0, F.lit(True))},
            "newest": "at"}
    stats = statistics.describe(df, "t", by=["day"], **what)
    assert stats.select("day").distinct().count() == 7
    merged = values(statistics.as_profile(statistics.merge(stats)))
    exact = values(profiling.profile(df, "t", **what))
    assert set(merged) == set(exact)
    for name, value in exact.items():
        loose = name in ("distinct_k", "surplus_rows_k")
        assert merged[name] == (pytest.approx(value, abs=13) if loose else value), name
    # Merging in two steps is the same: sums, maxima and unions don't depend on the order.
    halves = [statistics.merge(stats.where(c)) for c in ("day < 3", "day >= 3")]
    assert values(statistics.as_profile(statistics.merge(halves[0].unionByName(halves[1])))) == merged


def test_a_comparison_reads_statistics_alone(spark, tmp_path):
    path = str(tmp_path / "statistics")
    suites.raw_statistics(raw(spark, SHELF)).write.parquet(path)
    stored = statistics.as_profile(spark.read.parquet(path))
    plan = profiling.compare_profiles(stored, stored)._jdf.queryExecution().executedPlan().toString()
    assert "barcode" not in plan.replace("raw", "") and plan.count("FileScan") == 2


@pytest.fixture
def loaded(spark):
    for database in ("raw", "marts", "audit"):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    source = raw(spark, SHELF).withColumnRenamed("barcode", "code").drop("load_date", "loaded_at")
    daily.load(spark, source, LOAD_DATE, LOADED_AT)
    yield source
    for database in ("raw", "marts", "audit"):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def known(spark, day=LOAD_DATE):
    return statistics.stored_rows(spark, daily.RAW_TABLE, daily.RAW_STATISTICS, day)


def test_each_load_stores_its_statistics(spark, loaded):
    assert known(spark) == spark.table(daily.RAW_TABLE).count() == 18
    assert known(spark, LOAD_DATE - dt.timedelta(days=1)) is None
    daily.load(spark, loaded.limit(0), LOAD_DATE, LOADED_AT)
    assert known(spark) == 0
    daily.load(spark, loaded, LOAD_DATE, LOADED_AT)
    daily.load(spark, loaded, LOAD_DATE, LOADED_AT)
    assert known(spark) == 18
    assert spark.table(daily.RAW_STATISTICS).where("metric = 'row_count'").count() == 1


def test_statistics_of_another_version_are_not_taken(spark, loaded):
    """As after a run that stopped between the two switches."""
    rows = spark.table(daily.RAW_TABLE).limit(3)
    path = write_partition(rows, daily.RAW_TABLE, LOAD_DATE)
    switch_partition(spark, daily.RAW_TABLE, LOAD_DATE, path)
    assert known(spark) is None


def test_the_gate_takes_the_size_before_from_the_statistics(spark, loaded):
    day = LOAD_DATE + dt.timedelta(days=1)
    few = raw(spark, [Product("10000001")]).withColumnRenamed("barcode", "code").drop("load_date", "loaded_at")
    daily.load(spark, few, day, LOADED_AT)
    checks = suites.raw_checks(spark.table(daily.RAW_TABLE), day, LOADED_AT, previous_rows=known(spark))
    from ledgerloom.operators import checks as c

    load = spark.table(daily.RAW_TABLE).where(F.col("load_date") == F.lit(day))
    failed = {r.check: r.n_failed for r in c.evaluate(checks, {"raw": load}).collect()}
    assert failed["not_dropped_raw"] == 1
