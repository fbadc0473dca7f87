from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import ranking


def test_null_time_counts_as_newest(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", None, "undated"), ("b", 2, "new")], "k string, t int, v string")
    assert sorted(r.v for r in ranking.latest_per_key(df, ["k"], "t").collect()) == ["new", "undated"]


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, t int")
    assert sorted(map(str, ranking.latest_per_key(df, ["k"], "t").collect())) == [
        "Row(k='a', t=1)", "Row(k=None, t=2)",
    ]


def test_ties_do_not_depend_on_the_split(spark):
    rows = [("a", 1, v, [v]) for v in ("y", "x", "z")]
    df = spark.createDataFrame(rows, "k string, t int, v string, nested array<string>")
    for parts in (1, 3):
        assert ranking.latest_per_key(df.repartition(parts), ["k"], "t").first().v == "x"


def test_most_common_value_ties_in_binary_order(spark):
    rows = [("a", v) for v in ("b-a", "B", "b-a", "B", "a")]
    df = spark.createDataFrame(rows, "k string, v string")
    assert ranking.most_common_value(df, "k", "v").first() == ("a", "B", 5)


def test_top_per_group(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    top = ranking.top_per_group(df, ["g"], [F.asc("id")], 13)
    assert {r.g: r.m for r in top.groupBy("g").agg(F.max("id").alias("m")).collect()} == {0: 36, 1: 37, 2: 38}


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    latest = ranking.latest_per_key(df, ["k"], "t")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle
    assert latest.where("k = 0").first().t == 29_997
    assert latest.count() == 20_001


def test_counts_are_combined_before_the_key_alone_is_grouped(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), (F.col("id") % 7).cast("string").alias("v"))
    plan = ranking.most_common_value(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") == 1 and "partial_min" in plan
    assert ranking.most_common_value(df, "k", "v").first().n_rows == 1000
