from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import checks as c
from ledgerloom.operators import ranking
from ledgerloom.plans import products as p
from ledgerloom.plans import suites
from ledgerloom.queries import quality
from ledgerloom.queries.feed import one_load
from ledgerloom.queries.models import Models
from ledgerloom.sources.seeds import built_in_seeds

DAY = dt.datetime(1997, 5, 1)
LINE = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)
PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Versions of few barcodes that tie in all plain columns and differ in nested ones, or not at all."""
    parts = [
        (1, "red bolt", "Brand#1", "STANDARD", 30, 1.0), (2, "red gear", "Brand#1", "LARGE", 50, 1.0),
        (3, "old ring", None, "LARGE", 24, 1.0), (4, "new rod", "Brand#2", "PROMO", 1, 1.0),
        (5, None, "Brand#3", "SMALL", 10, 1.0), (6, "hot rod", "Brand#1", "STANDARD", 22, 1.0),
    ]
    lines = [
        (order, part, 1, line, quantity, price, off, 0.0, flag, status, day)
        for order in (1, 2) for part in range(1, 7) for line in (1, 5) for quantity in (1.0, 50.0)
        for price in (None, 10.5, 20.0) for off in (0.0, 0.04) for flag in ("N", "A", "R", None)
        for status, day in (("O", DAY), ("F", DAY), (None, None))
    ]
    root = str(tmp_path_factory.mktemp("feed"))
    spark.createDataFrame(lines * 2, LINE).write.parquet(f"{root}/lineitem.parquet")
    spark.createDataFrame(parts, PART).write.parquet(f"{root}/part.parquet")
    return root


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nested_columns_are_built_after_the_newest_version_is_chosen(spark, folder):
    models = Models(spark, folder)
    built, whole = models.stg_products, p.stg_products(one_load(spark, folder))
    assert built.schema.simpleString() == whole.schema.simpleString()
    assert built.exceptAll(whole).isEmpty() and whole.exceptAll(built).isEmpty() and built.count() == 9
    for df in (built, p.fct_nutrition(models.keyed, models.seeds)):
        text = plan(df)
        shuffled = text[text.index("Exchange hashpartitioning(barcode"):]
        assert text.count("Exchange hashpartitioning") == 1
        assert "energy-kcal" in text and "energy-kcal" not in shuffled


def test_built_columns_decide_ties_like_sorted_ones(spark):
    rows = [("a", 1, x, y) for x in (None, 2.0, 1.0) for y in (3, 1)] + [("b", None, 5.0, 1), ("b", 7, 0.0, 1)]
    rows += [(None, 1, 4.0, 2), (None, 1, 4.0, 2)]
    df = spark.createDataFrame(rows, "k string, t long, x double, y int").repartition(3)
    list_of = F.array("x", F.col("y").cast("double"))
    built = ranking.latest_then_built(df, ["k", "t"], ["k"], ["t"], {"l": list_of})
    sorted_by = ranking.latest_per_key(df.select("k", "t", list_of.alias("l")), ["k"], "t")
    assert sorted(map(str, built.collect())) == sorted(map(str, sorted_by.collect()))
    assert ("a", 1, [None, 1.0]) in [tuple(r) for r in built.collect()]


def test_versions_move_unsorted_and_without_what_is_built_from_them(spark, folder):
    text = plan(Models(spark, folder).stg_products)
    shuffled = text[text.index("Exchange hashpartitioning(barcode"):]
    assert "upper(p_brand" in text and "upper(p_brand" not in shuffled
    assert "aBcDe" in text and "aBcDe" not in shuffled
    assert "Sort" not in shuffled and "WindowGroupLimit" not in shuffled


def test_built_times_and_texts_choose_like_given_ones(spark):
    rows = [(k, d, x, y) for k in ("a", "b", None) for d in (1, 2, None) for x in ("z", None, "é") for y in (2, 1)]
    df = spark.createDataFrame(rows * 2, "k string, d int, x string, y int").where("k <> 'b' OR d = 1 OR k IS NULL")
    built = {"v": F.array("y"), "u": F.upper("x"), "t": F.col("d") * 10, "w": F.col("d").cast("string")}
    made = df.select("k", *[column.alias(name) for name, column in built.items()])
    chosen = ranking.latest_then_built(df.repartition(3), ["k", "v", "u", "t", "w"], ["k"], ["t"], built)
    given = ranking.latest_per_key(made, ["k"], "t")
    assert sorted(map(str, chosen.select(given.columns).collect())) == sorted(map(str, given.collect()))
    assert chosen.count() == 3


def test_only_products_that_can_repeat_a_nutrient_are_looked_through(spark):
    def entries(*names, unit="g"):
        return [(name, 1.0, unit) for name in names]

    rows = [
        ("a", entries("fat", "salt")), ("b", entries("fat", "salt", "fat")), ("c", entries("fat")), ("c", entries("fat", "iron")),
        ("d", entries(None, None)), ("e", None), ("f", []), ("g", [None, None]), ("h", entries("fat", "fat", unit="")),
        (None, entries("fat")), (None, entries("fat", "salt")), ("i", [("fat", 1.0, "g"), ("fat", None, "g")]),
    ]
    products = spark.createDataFrame(rows, "barcode string, nutriments array<struct<name:string,`100g`:double,unit:string>>")
    kept = p.with_repeated_nutrients(products)
    assert kept.columns == products.columns
    assert {r.barcode for r in kept.collect()} == {"b", "c", "d", "g", "h", "i", None} and kept.count() == 9
    check = c.unique_combination("staging", "stg_product_nutrients", "barcode", "nutrient")
    found, every = (check.failing({check.table: p.stg_product_nutrients(df)}) for df in (kept, products))
    assert found.exceptAll(every).isEmpty() and every.exceptAll(found).isEmpty()
    assert {tuple(r) for r in found.collect()} == {("b", "fat", 2), ("c", "fat", 2), ("d", None, 2), (None, "fat", 2)}


def test_duplicate_measures_neither_sorts_products_again_nor_explodes_all(spark, folder):
    text = plan(quality.duplicate_measures(spark, folder))
    exploded = text[text.index("Generate explode"):]
    assert "array_distinct" in exploded
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1


def test_sample_does_not_shuffle_the_load(spark, folder):
    models = Models(spark, folder)
    keys = models.keyed.select("product_key", "category_key").where("product_key IS NOT NULL")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(p.stratified_sample(models.one_load, keys, p.dim_category(models.seeds), 2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    semi = [line for line in text.splitlines() if "LeftSemi" in line]
    assert len(semi) == 1 and "BroadcastHashJoin" in semi[0]


def test_checks_by_product_shuffle_nothing_and_match_no_tags(spark, folder):
    tables = Models(spark, folder).stored_tables()
    flagged = {**tables, "fct_nutrition": suites.with_mass_flag(tables["fct_nutrition"], built_in_seeds(spark))}
    checks = [k for k in suites.model_checks() if getattr(k, "keys", ("",))[0] in ("barcode", "product_key")]
    text = plan(c.evaluate(checks, flagged))
    matching = plan(tables["int_products_categorised"]) + plan(tables["dim_product"])
    assert "HashAggregate" in text
    assert "Exchange hashpartitioning(barcode" not in text and "Exchange hashpartitioning(product_key" not in text
    assert "array_position" not in matching


def test_checks_make_no_brand_keys_again(spark, folder):
    tables = Models(spark, folder).stored_tables()
    assert "regexp_replace" not in plan(tables["dim_product"]) + plan(tables["fct_nutrition"])
    brands = tables["dim_product"].select("brand_key").distinct()
    assert brands.join(tables["dim_brand"], "brand_key", "left_anti").isEmpty()


def test_raw_gate_reads_what_it_checks(spark, folder):
    text = plan(quality._raw_results(spark, folder))
    assert "lineitem" in text and "l_suppkey" not in text and "raw_products" not in text
