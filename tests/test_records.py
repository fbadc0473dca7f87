from __future__ import annotations

import csv
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import files
from ledgerloom.sources import records as r

SCHEMA = "a string, b int, c string, t timestamp"


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def use(n):
        for name in names:
            spark.conf.set(name, str(n))

    yield use
    for name, value in before.items():
        spark.conf.set(name, value)


def cells(seed, n):
    """Rows with breaks, quotes, commas, blanks and missing cells."""
    rnd = random.Random(seed)
    parts = ["x", "word ", '"', ",", "\n", "\n\n", "\r\n", "é€", '""', "0"]
    text = lambda: "".join(rnd.choice(parts) for _ in range(rnd.randrange(7))) or None
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    return [(f"k{i}", rnd.choice([i, None]), text(), rnd.choice([at, None])) for i in range(n)]


def tidy(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("size", [16, 57, 300, 4096])
def test_many_tasks_find_what_was_written(spark, tmp_path, small_splits, size):
    rows = cells(size, 300)
    path = str(tmp_path / "csv")
    files.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(2), path)
    small_splits(size)
    back = files.read_csv(spark, path, spark.createDataFrame([], SCHEMA).schema)
    assert spark.read.text(path).rdd.getNumPartitions() > (8 if size < 4096 else 2)
    assert tidy(back.collect()) == tidy(rows)


def test_same_as_whole_files(spark, tmp_path, small_splits):
    """A file of another writer, with carriage returns, a cell over many splits and a blank line."""
    long = "\n".join(f'line "{i}", of a long cell' for i in range(200))
    rows = [("k", "1", long, ""), ("é", "", "a,b", ""), ("z", "3", "plain", "")]
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in/one.csv", "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file)
        writer.writerow(["a", "b", "c", "t"])
        writer.writerows(rows)
        file.write("\r\n")
        writer.writerow(("last", "4", "no break at the end", ""))
    schema = spark.createDataFrame([], SCHEMA).schema
    whole = files.read_csv(spark, str(tmp_path / "in"), schema, whole_files=True).collect()
    small_splits(64)
    many = files.read_csv(spark, str(tmp_path / "in"), schema).collect()
    assert tidy(many) == tidy(whole) and len(many) == 4
    assert {row.a: row.c for row in many}["k"] == long


def test_a_header_with_line_breaks_goes(spark, tmp_path, small_splits):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/one.csv").write_text('"a\nlong\n\nhead",b\nx,1\n"y\n",2')
    small_splits(4)
    got = files.read_csv(spark, str(tmp_path / "in"), spark.createDataFrame([], "a string, b int").schema)
    assert tidy(got.collect()) == [("x", 1), ("y\n", 2)]


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("empty", ""), ("head", "a,b\n"), ("blank", "a,b\n\n\n")):
        (tmp_path / f"in/{name}.csv").write_text(text)
    schema = spark.createDataFrame([], "a string, b int").schema
    assert files.read_csv(spark, str(tmp_path / "in"), schema).collect() == []


def test_an_open_cell_reaches_to_the_end_of_its_own_file(spark, tmp_path, small_splits):
    (tmp_path / "in").mkdir()
    for name in ("one", "two"):
        (tmp_path / f"in/{name}.csv").write_text(f'a\nfine {name}\n"open\nto\nthe end of {name}')
    small_splits(5)
    found = {row.record for row in r.records(spark, str(tmp_path / "in")).collect()}
    assert found == {f"fine {n}" for n in ("one", "two")} | {f'"open\nto\nthe end of {n}' for n in ("one", "two")}


def test_too_many_splits_are_left_to_whole_files(spark, tmp_path, small_splits, monkeypatch):
    path = str(tmp_path / "csv")
    rows = cells(1, 50)
    files.write_csv(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    small_splits(50)
    monkeypatch.setattr(r, "MOST_SPLITS", 3)
    assert r.records(spark, path) is None
    back = files.read_csv(spark, path, spark.createDataFrame([], SCHEMA).schema)
    assert back.count() == 50


def test_text_is_not_shuffled(spark, tmp_path, small_splits):
    path = str(tmp_path / "csv")
    spark.range(2000).select(F.concat(F.lit("a\n"), "id").alias("s")).coalesce(1).write.csv(path)
    small_splits(512)
    plan = r.records(spark, path, header=False)._jdf.queryExecution().executedPlan().toString()
    whole, crossing = plan[: plan.index("Exchange")], plan[plan.index("Exchange") :]
    assert "MapInArrow" in whole and plan.count("Exchange") == 1 and "MapInArrow" in crossing
    assert r.records(spark, path, header=False).count() == 2000
