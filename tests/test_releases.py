"""Releases, versions of partitions, and what expires."""

from __future__ import annotations

import datetime as dt

import pytest
from fixture_rows import LOAD_DATE, SHELF, Product, raw, source

from ledgerloom.functions import measures as m
from ledgerloom.operators import checks as c
from ledgerloom.plans import daily
from ledgerloom.plans import products as p
from ledgerloom.session import scratch_path
from ledgerloom.sources import layers, releases
from ledgerloom.sources.snapshots import (
    expire_partition_versions,
    replace_partition,
    switch_partition,
    write_partition,
)

END = dt.datetime(2200, 1, 1)


@pytest.fixture()
def trial(spark):
    root = scratch_path(spark, "trial")
    return root, "t" + root.rsplit("-", 1)[1]


def version(spark, root, layer, name, n, select="id"):
    return layers.write_version(spark.range(n).selectExpr(*select.split(", ")), root, layer, name)[1]


def seen(spark, layer, *names):
    return [spark.table(f"{layer}.{n}").count() for n in names]


def test_a_run_that_stops_leaves_the_release_before(spark, trial, monkeypatch):
    root, layer = trial
    both = {(layer, n): version(spark, root, layer, n, 2) for n in ("a", "b")}
    releases.release(spark, root, both)
    assert seen(spark, layer, "a", "b") == [2, 2]
    more = {(layer, n): version(spark, root, layer, n, 5, "id, id AS extra") for n in ("a", "b")}
    switch = releases._switch

    def stop(spark, root, table, rows):
        if table == "current":
            raise RuntimeError("stopped")
        switch(spark, root, table, rows)

    monkeypatch.setattr(releases, "_switch", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        releases.release(spark, root, more)
    assert seen(spark, layer, "a", "b") == [2, 2]
    assert spark.table(f"{layer}.a").where("extra IS NOT NULL").isEmpty()
    monkeypatch.setattr(releases, "_switch", switch)
    releases.release(spark, root, more)
    assert seen(spark, layer, "a", "b") == [5, 5]
    # A table that isn't given stays, a column that goes away goes.
    releases.release(spark, root, {(layer, "a"): version(spark, root, layer, "a", 7)})
    assert seen(spark, layer, "a", "b") == [7, 5] and spark.table(f"{layer}.a").columns == ["id"]
    with pytest.raises(releases.LayoutChanged, match="id"):
        releases.release(spark, root, {(layer, "a"): version(spark, root, layer, "a", 1, "string(id) AS id")})
    assert seen(spark, layer, "a", "b") == [7, 5]
    releases.release(spark, root, {(layer, "b"): version(spark, root, layer, "b", 1)}, whole_layers=(layer,))
    assert not spark.catalog.tableExists(f"{layer}.a") and seen(spark, layer, "b") == [1]


def test_expiry_counts_references(spark, trial):
    root, layer = trial
    paths = {}
    for n in range(4):
        paths["a", n] = version(spark, root, layer, "a", n)
        if n == 0:
            paths["b", 0] = version(spark, root, layer, "b", 9)
            releases.release(spark, root, {(layer, "b"): paths["b", 0]})
        if n != 2:  # the third never gets to a release
            releases.release(spark, root, {(layer, "a"): paths["a", n]})
    early = dt.datetime(2000, 1, 1)
    assert releases.expire(spark, root, early, layers=(layer,)).where("NOT kept").isEmpty()
    found = {r.path.rsplit("=", 1)[-1]: r.kept for r in releases.expire(spark, root, END, layers=(layer,)).collect()}
    kept = {key: found[path.rsplit("=", 1)[-1]] for key, path in paths.items()}
    assert kept == {("a", 0): False, ("b", 0): True, ("a", 1): False, ("a", 2): False, ("a", 3): True}
    assert seen(spark, layer, "a", "b") == [3, 9]
    folders = [path.rsplit("=", 1)[-1] for path, _ in releases.folders(spark, f"{root}/{layer}/a")]
    assert folders == [paths["a", 3].rsplit("=", 1)[-1]]


def test_readers_see_the_load_before_until_the_switch(spark, trial):
    _, name = trial
    replace_partition(raw(spark, SHELF), name, LOAD_DATE)
    path = write_partition(raw(spark, SHELF[:3]), name, LOAD_DATE)
    assert spark.table(name).count() == 18
    switch_partition(spark, name, LOAD_DATE, path)
    assert spark.table(name).count() == 3
    versions = expire_partition_versions(spark, name, END)
    assert sorted(kept for _, kept in versions) == [False, True] and spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_failing_rows_of_a_pass_are_written_once(spark, trial):
    root, _ = trial
    df = spark.createDataFrame([(1, None, -1), (2, "x", -2), (2, "y", 5), (3, "z", 6)], "k int, t string, v int")
    checks = [
        c.not_null("l", "d", "t"), c.value_between("l", "d", "v", 0, 5), c.not_null("l", "d", "k"),
        c.unique("l", "d", "k"), c.accepted_values("l", "d", "t", ["x", "y"]),
    ]
    paths = c.write_audit(checks, {"d": df}, c.evaluate(checks, {"d": df}).collect(), lambda n: f"{root}/{n}")
    got = {name: sorted(map(tuple, spark.read.parquet(path).collect())) for name, path in paths.items()}
    assert got == {
        "not_null_d_t": [(1, None, -1)], "value_between_d_v_0_5": [(1, None, -1), (2, "x", -2), (3, "z", 6)],
        "unique_d_k": [(2, 2)], "accepted_values_d_t": [("z", 1)],
    }
    assert paths["not_null_d_t"].rsplit("/", 1)[0] == paths["value_between_d_v_0_5"].rsplit("/", 1)[0]


def test_amounts_of_any_size(spark, seeds):
    rows = [Product("10000001", nutriments=[("water", 1e15, "g"), ("fat", 2e20, "g"), ("energy", 1e20, "kcal"),
                                            ("salt", -3e30, "g"), ("starch", float("nan"), "g"), ("sugars", None, "g")]),
            Product("10000002", nutriments=[("salt", 5e20, "g"), ("sodium", 2e20, "g")]),
            Product("10000003", nutriments=[("salt", 5e20, "g"), ("sodium", 1.0, "g")])]
    stg = p.stg_products(raw(spark, rows))
    long = {(r.barcode[-1], r.nutrient): (r.value_per_100, r.value_large) for r in p.stg_product_nutrients(stg).collect()}
    assert long["1", "water"] == (None, 1e15) and long["1", "fat"] == (None, 2e20) and long["1", "salt"] == (None, -3e30)
    assert {(r.nutrient, r.amount, r.reason) for r in p.rejected_amounts(stg).collect()} == {
        ("starch", "NaN", "no number"), ("sugars", None, "missing"),
    }
    keyed = p.products_with_keys(stg, seeds)
    fact = p.fct_nutrition(keyed, seeds)
    got = {(r.product_key[-1], r.nutrient): r.value_large for r in fact.collect()}
    assert got["1", "energy"] == pytest.approx(4.184e20) and ("1", "salt") not in got
    from ledgerloom.plans import suites

    tables = {"fct_nutrition": suites.with_mass_flag(fact, seeds), "stg_product_nutrients": p.stg_product_nutrients(stg),
              "rejected_amounts": p.rejected_amounts(stg)}
    chosen = [k for k in suites.model_checks() if k.kind not in ("relationship", "accepted_values")]
    results = {r.check: (r.n_failed, r.verdict) for r in c.evaluate(suites.checks_on(chosen, *tables), tables).collect()}
    assert results["expression_stg_product_nutrients_amount_size"] == (7, "warn")
    assert results["expression_rejected_amounts_number"] == (1, "error")
    assert results["not_null_fct_nutrition_value_per_100"] == (0, "pass")
    assert results["value_between_fct_nutrition_mass"] == (5, "warn")
    assert results["ratio_fct_nutrition_salt_sodium"] == (1, "warn")  # 5e20 is 2.5 times 2e20, but not 1


def test_text_amounts(spark):
    texts = spark.createDataFrame([("1e15",), ("200000000000000000000",), ("trace",), ("",), (None,), ("Infinity",)], "t string")
    got = texts.select(m.to_amount("t"), m.large_amount("t"), m.finite("t")).collect()
    assert [r[1] for r in got] == [1e15, 2e20, None, None, None, None]
    assert [r[0] for r in got] == [None] * 6 and [r[2] is None for r in got] == [False, False, True, True, True, True]


def test_a_failed_build_releases_its_audit_alone(spark, trial):
    root, _ = trial
    spark.sql("DROP TABLE IF EXISTS raw.products")
    daily.load(spark, source(spark, SHELF), LOAD_DATE, dt.datetime(2024, 1, 2, 6, tzinfo=dt.timezone.utc))
    daily.build(spark, root, dt.datetime(2024, 1, 2, 7, tzinfo=dt.timezone.utc))
    marts = releases.versions_in_force(spark).where("layer = 'marts'").count()
    assert marts == 4
    kinds = {r.tableType for r in spark.catalog.listTables("marts") if not r.isTemporary}
    assert kinds == {"VIEW"}
