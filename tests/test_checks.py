from __future__ import annotations

import datetime as dt

import pytest
from fixture_rows import AS_OF, LOAD_DATE, LOADED_AT, SHELF, Product, raw
from pyspark.sql import functions as F

from ledgerloom.operators import checks as c
from ledgerloom.operators import profiling
from ledgerloom.operators.checks import Limits
from ledgerloom.plans import products as p
from ledgerloom.plans import suites
from ledgerloom.plans.contracts import ContractBroken, fact_contract
from ledgerloom.session import scratch_path


def run(checks, tables):
    checks = checks if isinstance(checks, list) else [checks]
    return {r.check: (r.n_total, r.n_failed, r.verdict) for r in c.evaluate(checks, tables).collect()}


def one(check, df, **others):
    (result,) = run(check, {"t": df, **others}).values()
    return result


def values(spark, items, kind="string"):
    return spark.createDataFrame([(v,) for v in items], f"x {kind}")


def test_null_passes_everything_but_not_null(spark):
    df = values(spark, ["a", "a", "a", None, None, "b"])
    parent = values(spark, ["b"])
    assert one(c.unique("l", "t", "x"), df) == (4, 1, "error")
    assert one(c.unique("l", "t", "x", count_rows=True), df) == (4, 3, "error")
    assert one(c.not_null("l", "t", "x"), df) == (6, 2, "error")
    assert one(c.accepted_values("l", "t", "x", ["b"]), df) == (6, 1, "error")
    assert one(c.expression_is_true("l", "t", "e", F.col("x") == "a"), df) == (6, 1, "error")
    assert one(c.relationship("l", "t", "x", "p", "x"), df, p=parent) == (4, 3, "error")
    assert one(c.relationship("l", "t", "x", "p", "x", True), df, p=parent) == (6, 5, "error")


def test_accepted_values_group_bad_values_alone(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("c", 2), ("d", 3), (None, None)], "x string, y int")
    checks = [c.accepted_values("l", "t", "x", ["a"]), c.accepted_values("l", "t", "y", [1, 3])]
    assert run(checks, {"t": df}) == {
        "accepted_values_t_x": (5, 2, "error"),
        "accepted_values_t_y": (5, 1, "error"),
    }
    assert one(checks[0], df.limit(0)) == (0, 0, "pass")
    plan = c.evaluate(checks, {"t": df})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Scan ExistingRDD") == 1


def test_combination_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    assert one(c.unique_combination("l", "t", "x", "y"), df) == (3, 1, "error")


def test_empty_tables_pass_where_nothing_can_fail(spark):
    df = values(spark, [])
    assert one(c.unique("l", "t", "x"), df) == (0, 0, "pass")
    assert one(c.complete_mostly("l", "t", "x", F.col("x").isNull(), "0.05"), df) == (0, 0, "pass")
    assert one(c.relationship("l", "t", "x", "p", "x"), df, p=df) == (0, 0, "pass")


@pytest.mark.parametrize("n, verdict", [(0, "pass"), (1, "warn"), (3, "warn"), (4, "error")])
def test_two_thresholds(spark, n, verdict):
    df = values(spark, [1] * n + [0] * 5, "int")
    check = c.value_between("l", "t", "x", 0, 0, Limits(warn_above=0, error_above=3))
    assert one(check, df) == (n + 5, n, verdict)


@pytest.mark.parametrize("missing, verdict", [(4, "pass"), (5, "error")])
def test_share_is_exact_at_the_limit(spark, missing, verdict):
    # 4 of 20 is exactly a fifth; with the binary 1 - 0.8 it would be too many.
    df = values(spark, [None] * missing + ["a"] * (20 - missing))
    assert one(c.complete_mostly("l", "t", "x", F.col("x").isNull(), "0.20"), df)[2] == verdict
    assert one(c.not_null("l", "t", "x", share="0.20"), df)[2] == verdict


def test_range_applies_to_its_scope_only(spark):
    df = spark.createDataFrame([("m", 150), ("m", 100), ("k", 150), ("m", None)], "s string, x int")
    check = c.value_between("l", "t", "x", 0, 100, only=F.col("s") == "m")
    assert one(check, df) == (3, 1, "error")
    assert [r.x for r in check.failing({"t": df}).collect()] == [150]


def test_freshness(spark):
    as_of = dt.datetime(2024, 1, 3, 8, tzinfo=dt.timezone.utc)
    times = {
        "2024-01-02 06:00:00": (0, "pass"),
        "2024-01-02 05:59:59": (1, "warn"),
        "2024-01-01 07:59:59": (2, "error"),
    }
    for time, expected in times.items():
        df = values(spark, ["2023-01-01 00:00:00", time]).select(F.col("x").cast("timestamp"))
        assert one(c.fresh("l", "t", "x", as_of, 48, 26), df)[1:] == expected
    empty = values(spark, []).select(F.col("x").cast("timestamp"))
    assert one(c.fresh("l", "t", "x", as_of, 26), empty) == (0, 0, "pass")
    assert one(c.fresh("l", "t", "x", as_of, 48, 26, empty_is_stale=True), empty) == (0, 2, "error")


def test_row_counts(spark):
    df = spark.range(7)
    assert one(c.row_count_between("l", "t", 7, 7), df) == (7, 0, "pass")
    assert one(c.row_count_between("l", "t", 8, 9), df) == (7, 1, "error")
    for before, failed in ((10, 0), (11, 1), (0, 0), (None, 0)):
        assert one(c.not_dropped("l", "t", F.lit(before), "0.7"), df)[1] == failed


def test_required_columns(spark):
    check = c.required_columns("l", "t", ["id", "other"])
    assert one(check, spark.range(3)) == (2, 1, "error")
    assert check.failing({"t": spark.range(3)}).collect() == [("other",)]


def test_checks_on_one_table_and_key_share_a_pass(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "a int, b int")
    checks = [c.not_null("l", "t", "a"), c.not_null("l", "t", "b"), c.value_between("l", "t", "b", 0, 2)]
    plan = c.evaluate(checks, {"t": df})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_hot_foreign_key_is_counted_before_the_join(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("x"))
    check = c.relationship("l", "t", "x", "p", "x")
    parent = spark.range(1, 9000).toDF("x")
    assert one(check, df, p=parent) == (9000, 3000, "error")
    plan = check.keyed({"t": df, "p": parent})._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan[plan.index("Join") :]


@pytest.fixture(scope="module")
def tables(spark, seeds):
    load = raw(spark, SHELF)
    stg = p.stg_products(load).cache()
    keyed = p.products_with_keys(stg, seeds)
    return {
        "raw": load,
        "stg_products": stg,
        "stg_product_nutrients": p.stg_product_nutrients(stg),
        "rejected_amounts": p.rejected_amounts(stg),
        "int_products_categorised": p.int_products_categorised(stg, seeds),
        "dim_category": p.dim_category(seeds),
        "dim_brand": p.dim_brand(stg),
        "dim_product": p.dim_product(keyed),
        "fct_nutrition": suites.with_mass_flag(p.fct_nutrition(keyed, seeds), seeds),
        "category_taxonomy": seeds.category_taxonomy,
        "category_mapping": seeds.category_mapping,
        "nutrient_reference": seeds.nutrient_reference,
    }


def test_suite_sizes(spark, tables):
    models = suites.model_checks()
    gate = suites.raw_checks(tables["raw"], LOAD_DATE, AS_OF)
    assert (len(models), len(gate)) == (45, 12)
    names = [check.name for check in [*models, *gate, suites.source_freshness(AS_OF)]]
    assert len(set(names)) == 58
    kinds = {}
    for check in models:
        kinds[check.kind] = kinds.get(check.kind, 0) + 1
    assert kinds == {
        "unique": 8, "not_null": 15, "accepted_values": 7, "relationship": 6, "unique_combination": 2,
        "value_between": 2, "expression_is_true": 3, "component_sum": 1, "ratio": 1,
    }


def test_only_the_five_plausibility_checks_warn(tables):
    results = run(suites.model_checks(), tables)
    assert {name: r[1:] for name, r in results.items() if r[2] != "pass"} == {
        "expression_stg_products_barcode_format": (1, "warn"),
        "value_between_fct_nutrition_mass": (1, "warn"),
        "value_between_fct_nutrition_kcal": (1, "warn"),
        "component_sum_fct_nutrition_value_per_100": (1, "warn"),
        "ratio_fct_nutrition_salt_sodium": (1, "warn"),
    }


def test_audit_keeps_failing_rows_only_where_there_are_any(spark, tables):
    checks = suites.model_checks()
    results = c.evaluate(checks, tables).collect()
    root = scratch_path(spark, "audit")
    paths = c.write_audit(checks, tables, results, lambda name: f"{root}/{name}")
    assert len(paths) == 5
    (row_,) = spark.read.parquet(paths["ratio_fct_nutrition_salt_sodium"]).collect()
    assert (row_.product_key, row_.salt, row_.sodium) == ("40000161", 2, 2)
    ratio = next(check for check in checks if check.kind == "ratio")
    assert c.sample_failures(ratio, tables, 10).count() == 1


def test_no_entry_is_made_for_rows_without_a_bad_value(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", None), (None, "z"), ("c", "y")], "k string, v string")
    checks = [c.accepted_values("l", "t", "k", ["a"]), c.accepted_values("l", "t", "v", ["x", "y"])]
    out = c.evaluate(checks, {"t": df})
    assert {r.check: (r.n_total, r.n_failed) for r in out.collect()} == {
        "accepted_values_t_k": (5, 2), "accepted_values_t_v": (5, 1)
    }
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[: plan.index("Scan ExistingRDD")]
    assert "partial_count" in plan[plan.rindex("Generate explode"):]


def test_rows_that_fail_nothing_are_dropped_before_they_are_named(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (7, None), (None, None)], "n int, k string")
    checks = [c.not_null("l", "t", "n"), c.not_null("l", "t", "k"), c.value_between("l", "t", "n", 0, 5)]
    failing = c.failing_by_check(checks, {"t": df})
    assert sorted((r.n or 0, r.k or "", r.failed_check) for r in failing.collect()) == [
        (0, "", "not_null_t_k"), (0, "", "not_null_t_n"), (0, "b", "not_null_t_n"),
        (7, "", "not_null_t_k"), (7, "", "value_between_t_n_0_5"),
    ]
    plan = failing._jdf.queryExecution().executedPlan().toString()
    assert "OR" in plan[plan.index("Generate explode"):]


def test_raw_gate(spark):
    # 100 clean codes: on the shelf the repeated barcode and the odd code fail.
    good = [Product(f"{i:08d}") for i in range(100)]
    checks, tables = suites.raw_gate(raw(spark, good), LOAD_DATE, AS_OF, row_count_range=(100, 200))
    results = c.evaluate(checks, tables).collect()
    c.gate(results)
    assert len(results) == 12 and {r.verdict for r in results} == {"pass"}

    checks, tables = suites.raw_gate(raw(spark, SHELF), LOAD_DATE, AS_OF)
    results = c.evaluate(checks, tables).collect()
    failed = {r.check: r.n_failed for r in results if r.verdict == "error"}
    assert failed == {"row_count_raw": 1, "unique_raw_barcode": 3, "matches_raw_barcode": 1}
    with pytest.raises(c.GateFailed, match="3 of 12 checks failed"):
        c.gate(results)


def test_raw_gate_on_a_missing_load_fails_by_its_size(spark):
    checks, tables = suites.raw_gate(raw(spark, SHELF), "2030-01-01", AS_OF)
    failed = {r.check for r in c.evaluate(checks, tables).collect() if r.verdict == "error"}
    assert failed == {"row_count_raw", "not_dropped_raw"}


def test_contract(spark, seeds, tables):
    contract = fact_contract()
    fact = tables["fct_nutrition"].drop("is_mass")
    contract.require_layout(fact)
    with pytest.raises(ContractBroken, match="value_per_100 is double"):
        contract.require_layout(fact.withColumn("value_per_100", F.col("value_per_100").cast("double")))
    assert contract.layout_problems(fact.drop("basis").withColumn("extra", F.lit(1))) == [
        "column basis is missing", "column extra is not agreed",
    ]
    verdicts = {r.check: r.verdict for r in contract.evaluate(tables).collect()}
    assert sorted(set(verdicts.values())) == ["pass", "warn"] and len(verdicts) == 14

    broken = tables["fct_nutrition"].withColumn(
        "brand_key", F.when(F.col("nutrient") != "fat", F.col("brand_key"))
    ).withColumn("value_per_100", -F.col("value_per_100"))
    results = {r.check: r for r in contract.evaluate({**tables, "fct_nutrition": broken}).collect()}
    assert results["contract_not_null_fct_nutrition_brand_key"].n_failed == 13
    assert results["contract_relationship_fct_nutrition_brand_key"].n_failed == 13
    assert results["contract_expression_fct_nutrition_not_negative"].n_failed == 69
    assert results["contract_unique_fct_nutrition_product_key_nutrient"].n_failed == 0


def test_sla(tables):
    late = fact_contract().age_check(AS_OF + dt.timedelta(hours=30))
    assert run(late, tables) == {"contract_max_age_fct_nutrition": (18, 1, "error")}
    assert run(fact_contract().age_check(LOADED_AT), tables)["contract_max_age_fct_nutrition"][2] == "pass"


def test_profile_and_comparison(spark, tables):
    def profile(load):
        return profiling.profile(
            load, "raw", distinct=["barcode"], missing=suites.missing_rules(), newest="loaded_at",
            rules={"fr": (F.col("barcode").isNotNull(), ~F.col("barcode").rlike(r"^[0-9]{8,14}\z"))},
        )

    metrics = {r.metric: r.value for r in profile(tables["raw"]).collect()}
    assert metrics["row_count"] == 18 and metrics["distinct_barcode"] == 16
    assert metrics["surplus_rows_barcode"] == 2
    assert metrics["complete_pct_brands"] == 94.44 and metrics["failed_pct_fr"] == 5.56
    again = raw(spark, SHELF, loaded_at=LOADED_AT + dt.timedelta(minutes=1))
    differing = profiling.compare_profiles(profile(tables["raw"]), profile(again)).where("NOT same")
    assert [r.metric for r in differing.collect()] == ["newest_loaded_at"]
