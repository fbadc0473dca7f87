from __future__ import annotations

import datetime as dt

import pytest
from fixture_rows import LOADED_AT, SHELF, Product, raw
from pyspark.sql import functions as F

from ledgerloom.schemas import RAW, SNAPSHOT
from ledgerloom.session import scratch_path
from ledgerloom.sources import files, layers
from ledgerloom.sources.seeds import built_in_seeds, read_seeds
from ledgerloom.sources.snapshots import (
    EmptyPartition,
    chosen_partition,
    conform_to_raw,
    latest_partition,
    load_date_before,
    newest_load_date,
    previous_partition,
    replace_partition,
)

DAY1, DAY2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


@pytest.fixture()
def table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw")
    name = f"raw.t_{scratch_path(spark, 't').rsplit('-', 1)[1]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_extract_filters_renames_and_stamps(spark):
    rows = [*SHELF[:2], Product("1", countries_tags=["en:france"]), Product("2", countries_tags=None)]
    load = raw(spark, rows)
    assert load.schema.names == RAW.names
    assert [(r.barcode, r.load_date) for r in load.collect()] == [("40000017", DAY1)] * 2
    assert load.select("loaded_at").distinct().count() == 1


def test_replace_is_idempotent_and_leaves_other_loads(spark, table):
    replace_partition(raw(spark, SHELF, DAY1), table, DAY1)
    for _ in range(2):
        replace_partition(raw(spark, SHELF[:5], DAY2), table, DAY2)
    counts = {r.load_date: r["count"] for r in spark.table(table).groupBy("load_date").count().collect()}
    assert counts == {DAY1: 18, DAY2: 5}


def test_replacing_with_nothing_empties_the_load(spark, table):
    for rows in (SHELF, []):
        replace_partition(raw(spark, rows, DAY2), table, DAY2)
    assert spark.table(table).isEmpty()
    replace_partition(raw(spark, SHELF[:1], DAY1), table, DAY1)
    assert newest_load_date(spark, table) == DAY1  # the empty newer load does not count


def test_a_new_column_is_null_in_older_loads(spark, table):
    old = raw(spark, SHELF[:1], DAY1).drop("nutrition_data_per")
    replace_partition(old, table, DAY1)
    replace_partition(raw(spark, SHELF[:1], DAY2), table, DAY2)
    replace_partition(old, table, DAY1)  # a load without the column still fits
    stored = conform_to_raw(spark.table(table)).select("load_date", "nutrition_data_per")
    assert sorted(stored.collect()) == [(DAY1, None), (DAY2, "100g")]


def test_choosing_loads(spark, table):
    for day, n in ((DAY1, 3), (DAY2, 2)):
        replace_partition(raw(spark, SHELF[:n], day), table, day)
    loads = spark.table(table)
    assert latest_partition(loads).count() == 2
    assert chosen_partition(loads, DAY1).count() == 3
    with pytest.raises(EmptyPartition, match="2020-01-01"):
        chosen_partition(loads, "2020-01-01")
    previous = loads.select(previous_partition(loads, DAY2).alias("p"), previous_partition(loads, DAY1).alias("q"))
    assert previous.first() == (DAY1, None)
    assert load_date_before(spark, table, DAY2) == DAY1
    assert load_date_before(spark, table, DAY1) is None


def test_latest_load_is_a_partition_filter(spark, table):
    replace_partition(raw(spark, SHELF, DAY1), table, DAY1)

    def scan(df):
        plan = df.select("barcode")._jdf.queryExecution().executedPlan().toString()
        return next(line for line in plan.splitlines() if "FileScan" in line)

    latest = scan(latest_partition(spark.table(table)))
    assert "PartitionFilters: [isnotnull(load_date" in latest and "ubquery" in latest
    named = scan(chosen_partition(conform_to_raw(spark.table(table)), DAY1))
    assert "PartitionFilters: [isnotnull(load_date" in named and "= 2024-01-01" in named
    assert "ReadSchema: struct<barcode:string>" in named


def test_csv_round_trip_keeps_nested_values_and_leading_zeros(spark):
    rows = [*SHELF, Product("007", product_name=[("nl", 'say "hi", you\nthere')], nutriments=None)]
    load = raw(spark, rows).select(*SNAPSHOT.names)
    path = scratch_path(spark, "csv")
    files.write_csv(load, path)
    back = files.read_csv(spark, path, SNAPSHOT)
    assert back.schema == SNAPSHOT
    no_blanks = load.withColumn("brands", F.nullif("brands", F.lit("")))  # CSV has one empty cell
    key = ["barcode", "last_modified_t"]
    assert back.orderBy(key).collect() == no_blanks.orderBy(key).collect()


def test_write_complete_never_overwrites(spark):
    path = scratch_path(spark, "once")
    df = spark.range(3)
    assert files.write_complete(df, path).count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_complete(df, path)


def test_seeds(spark, tmp_path):
    seeds = built_in_seeds(spark)
    assert seeds.category_taxonomy.count() == 48
    priorities = dict(seeds.category_mapping.groupBy("priority").count().collect())
    assert priorities == {1: 19, 2: 82, 3: 48, 4: 23}
    reference = seeds.nutrient_reference
    assert reference.count() == 72 and reference.where("NOT is_mass").count() == 3
    folder = scratch_path(spark, "seeds")
    for name in ("category_taxonomy", "category_mapping", "nutrient_reference"):
        getattr(seeds, name).write.csv(f"{folder}/{name}.csv", header=True)
    again = read_seeds(spark, folder)
    assert sorted(again.category_mapping.collect()) == sorted(seeds.category_mapping.collect())
    assert again.nutrient_reference.schema["is_mass"].dataType.simpleString() == "boolean"


def test_published_table_shows_comments_and_switches_versions(spark):
    layers.create_layers(spark)
    root = scratch_path(spark, "root")
    for n in (2, 3):
        brands = spark.range(n).selectExpr("string(id) brand_key", "'x' brand_name", "1L product_count")
        _, path = layers.write_version(brands, root, "marts", "dim_brand")
        published = layers.publish(spark, "marts", "dim_brand", path)
        assert published.count() == n
        if n == 2:
            spark.sql("ALTER TABLE marts.dim_brand SET TBLPROPERTIES ('kept' = 'yes')")
    # The same table points at the new version; it was not dropped in between.
    kept = spark.sql("SHOW TBLPROPERTIES marts.dim_brand ('kept')").first()
    assert kept.value == "yes"
    wider = brands.selectExpr("*", "1 AS extra")
    _, path = layers.write_version(wider, root, "marts", "dim_brand")
    assert "extra" in layers.publish(spark, "marts", "dim_brand", path).columns
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE marts.dim_brand").collect()}
    assert described["brand_key"] == "Hash of the case-folded brand."
    spark.sql("DROP TABLE marts.dim_brand")


def test_loaded_at_is_utc(spark):
    load = raw(spark, SHELF[:1])
    assert load.select(F.unix_seconds("loaded_at")).first()[0] == int(LOADED_AT.timestamp())


def test_nested_fields_are_taken_by_name(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from ledgerloom.sources.snapshots import by_name

    have = "array<struct<unit:string,extra:int,`100g`:string,name:string>>"
    want = "array<struct<name:string,`100g`:double,unit:string>>"
    df = spark.createDataFrame([([("g", 1, "2.5", "fat"), ("g", 2, "n/a", "salt")],)], f"n {have}")
    types = [T._parse_datatype_string(t) for t in (have, want)]
    row = df.select(by_name(F.col("n"), *types).alias("n")).first()
    assert [tuple(e) for e in row.n] == [("fat", 2.5, "g"), ("salt", None, "g")]


def test_csv_keeps_outer_spaces_and_microseconds(spark, tmp_path):
    import datetime as dt

    from ledgerloom.sources import files

    at = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    df = spark.createDataFrame([(" lead ", at)], "s string, t timestamp")
    files.write_csv(df, str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"), df.schema).first()
    assert (back.s, back.t) == (" lead ", at)
