from __future__ import annotations

import datetime as dt

import pytest
from fixture_rows import AS_OF, LOAD_DATE, LOADED_AT, SHELF, Product, source

from ledgerloom.operators import checks as c
from ledgerloom.operators.checks import GateFailed
from ledgerloom.plans import daily, suites
from ledgerloom.schemas import FACT
from ledgerloom.session import scratch_path
from ledgerloom.sources import layers

MARTS = {"dim_product": 16, "dim_brand": 3, "dim_category": 48, "fct_nutrition": 69}


@pytest.fixture()
def root(spark):
    spark.sql("DROP TABLE IF EXISTS raw.products")
    return scratch_path(spark, "warehouse")


def sizes(spark):
    return {name: spark.table(f"marts.{name}").count() for name in MARTS}


def test_build_publishes_and_can_be_run_again(spark, root):
    daily.load(spark, source(spark, SHELF), LOAD_DATE, LOADED_AT)
    first = daily.build(spark, root, AS_OF)
    assert sizes(spark) == MARTS
    assert len(first.results) == 1 + 1 + 45 + 14
    assert len(first.audit) == 5
    assert spark.table("audit.ratio_fct_nutrition_salt_sodium").count() == 1
    assert spark.table("marts.fct_nutrition").schema.names == FACT.names
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE marts.fct_nutrition").collect()}
    assert comments["basis"] == "100g or 100ml."
    assert spark.table("int_products_categorised").count() == 16

    later = LOADED_AT + dt.timedelta(hours=1)
    daily.load(spark, source(spark, SHELF), LOAD_DATE, later)
    before = sorted(spark.table("marts.fct_nutrition").collect())
    daily.build(spark, root, AS_OF, LOAD_DATE)
    assert sizes(spark) == MARTS
    assert sorted(spark.table("marts.fct_nutrition").collect()) == before


def test_gate_stops_the_run_before_anything_is_built(spark, root):
    rows = [Product(f"{i:08d}") for i in range(20)]
    day = LOAD_DATE + dt.timedelta(days=1)
    with pytest.raises(GateFailed, match="row_count_raw"):
        daily.run(spark, source(spark, rows), root, day, LOADED_AT, AS_OF)
    daily.run(spark, source(spark, rows), root, day, LOADED_AT, AS_OF, row_count_range=(20, 30))
    assert spark.table("marts.dim_product").count() == 20


def test_failing_checks_leave_the_published_tables_alone(spark, root):
    daily.load(spark, source(spark, SHELF), LOAD_DATE, LOADED_AT)
    daily.build(spark, root, AS_OF)
    day = LOAD_DATE + dt.timedelta(days=1)
    twice = Product("10000001", nutriments=[("fat", 1.0, "g"), ("fat", 2.0, "g")])
    daily.load(spark, source(spark, [twice]), day, LOADED_AT)
    with pytest.raises(GateFailed, match="unique_fct_nutrition_product_key_nutrient"):
        daily.build(spark, root, AS_OF)
    assert sizes(spark) == MARTS
    kept = spark.table("audit.unique_stg_product_nutrients_barcode_nutrient")
    assert kept.collect() == [("10000001", "fat", 2)]
    assert not spark.catalog.tableExists("audit.ratio_fct_nutrition_salt_sodium")  # no longer fails


def test_an_older_load_can_be_built_beside_a_fresh_one(spark, root):
    old = LOAD_DATE - dt.timedelta(days=40)
    daily.load(spark, source(spark, SHELF), old, LOADED_AT - dt.timedelta(days=40))
    daily.load(spark, source(spark, SHELF), LOAD_DATE, LOADED_AT)
    daily.build(spark, root, AS_OF, old)
    assert sizes(spark) == MARTS


def test_a_stored_table_without_a_column_stops_the_gate(spark, root):
    daily.load(spark, source(spark, SHELF), LOAD_DATE, LOADED_AT)
    lacking = spark.table("raw.products").drop("labels_tags").collect()
    fields = [f for f in spark.table("raw.products").schema if f.name != "labels_tags"]
    stored = spark.createDataFrame(lacking, type(spark.table("raw.products").schema)(fields))
    spark.sql("DROP TABLE raw.products")
    stored.write.partitionBy("load_date").saveAsTable("raw.products")
    with pytest.raises(GateFailed, match="required_columns_raw"):
        daily.check_load(spark, LOAD_DATE, AS_OF)


def hash_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_checks_by_product_shuffle_neither_staging_nor_the_fact(spark, root, seeds):
    daily.load(spark, source(spark, SHELF), LOAD_DATE, LOADED_AT)
    built = daily.build(spark, root, AS_OF)
    tables = dict(built.tables)  # can still be read, though their entries are gone
    assert not [t for t in spark.catalog.listTables(layers.WORK) if not t.isTemporary]
    tables["fct_nutrition"] = suites.with_mass_flag(tables["fct_nutrition"], seeds)
    by_product = ("barcode", "product_key")
    checks = [
        k for k in suites.model_checks()
        if isinstance(k, c.KeyCheck) and k.keys[0] in by_product
        or isinstance(k, c.ParentCheck) and k.key in by_product
    ]
    assert len(checks) == 8
    found = c.evaluate(checks, tables)
    keys = [line.split("hashpartitioning(")[1].split("#")[0] for line in hash_exchanges(found)]
    assert not {"barcode", "product_key"} & set(keys), keys
    before = {r.check: r.n_failed for r in built.results}
    assert {r.check: r.n_failed for r in found.collect()} == {k.name: before[k.name] for k in checks}
    # The foreign keys that aren't the product's are counted per task before anything is shuffled.
    others = [k for k in suites.model_checks() if isinstance(k, c.ParentCheck) and k.table == "fct_nutrition"]
    shuffled = [line for line in hash_exchanges(c.evaluate(others, tables)) if "product_key" in line]
    assert shuffled == []


def test_a_keyed_version_is_plain_files_beside_the_others(spark, root):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS v").union(spark.sql("SELECT NULL, -1L"))
    table, path = layers.write_keyed_version(df, root, "marts", "numbers", "k")
    grouped = table.groupBy("k", "v").count()
    assert hash_exchanges(grouped) == [] and grouped.count() == 101
    layers.end_work(spark, "numbers", path)
    assert sorted(spark.read.parquet(path).collect(), key=str) == sorted(df.collect(), key=str)
    assert table.where("k IS NULL").first().v == -1
    empty, path = layers.write_keyed_version(df.limit(0), root, "marts", "numbers", "k")
    assert empty.count() == 0 and empty.columns == ["k", "v"]
    layers.end_work(spark, "numbers", path)
