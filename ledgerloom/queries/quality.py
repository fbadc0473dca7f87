"""Checks, verdicts, failing rows, contract and profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import checks as c
from ledgerloom.operators import profiling
from ledgerloom.plans import products as p
from ledgerloom.plans import suites
from ledgerloom.plans.contracts import fact_contract
from ledgerloom.queries import check_sql as sql
from ledgerloom.queries.feed import AS_OF, LOAD_DATE, PREVIOUS_DATE, one_load, raw_products
from ledgerloom.queries.models import Models, as_double, model_sql
from ledgerloom.queries.registry import query, table
from ledgerloom.session import scratch_path
from ledgerloom.sources import layers
from ledgerloom.sources.snapshots import chosen_partition

# --- the checks of the product datasets ----------------------------------------

_BARCODE_OK = "regexp_full_match(barcode, '[0-9]{8,14}')"
_FIRST = "TIMESTAMP '2024-01-03 07:00:00'"
_EMPTY = "{0} IS NULL OR len({0}) = 0"
_N_RAW_COLUMNS = 22

RAW_LINES = [
    sql.line("row_count_raw", "raw", "row_count", "completeness", "one_load", sql.ROWS,
          "CASE WHEN count(*) BETWEEN 50000 AND 200000 THEN 0 ELSE 1 END"),
    sql.line("not_dropped_raw", "raw", "not_dropped", "consistency",
          "(SELECT (SELECT count(*) FROM one_load) AS now, (SELECT count(*) FROM raw_products"
          f" WHERE load_date = (SELECT max(load_date) FROM raw_products WHERE load_date < DATE '{LOAD_DATE}'))"
          " AS before)", "now", "CASE WHEN before > 0 AND now < before * 0.7 THEN 1 ELSE 0 END"),
    sql.not_null("raw", "one_load", "barcode").replace("one_load_barcode", "raw_barcode"),
    sql.unique("raw", "one_load", "barcode", "coalesce(sum(n) FILTER (n > 1), 0)").replace(
        "one_load_barcode", "raw_barcode"),
    sql.line("matches_raw_barcode", "raw", "matches", "validity", "one_load", "count(barcode)",
          f"count(*) FILTER (NOT {_BARCODE_OK})", **sql.share_limit("0.01")),
    *[
        sql.complete("raw", "one_load", col, missing, share).replace(f"one_load_{col}", f"raw_{col}")
        for col, missing, share in [
            ("product_name", _EMPTY.format("product_name"), "0.05"),
            ("brands", "brands IS NULL OR trim(brands) = ''", "0.20"),
            ("categories_tags", _EMPTY.format("categories_tags"), "0.65"),
            ("nutriments", _EMPTY.format("nutriments"), "0.45"),
        ]
    ],
    sql.not_null("raw", "one_load", "nutriscore_grade", **sql.share_limit("0.005")).replace(
        "one_load_nutriscore", "raw_nutriscore"),
    sql.line("fresh_raw_loaded_at", "raw", "fresh", "timeliness", "one_load", sql.ROWS,
          f"CASE WHEN max(loaded_at) < {_FIRST} - INTERVAL 26 HOURS THEN 1 ELSE 0 END"),
    sql.line("required_columns_raw", "raw", "required_columns", "validity",
          "(SELECT count(*) AS n FROM one_load)", f"{_N_RAW_COLUMNS} + 0 * n", "0 * n"),
]

FRESHNESS_LINE = sql.line(
    "source_freshness_raw_loaded_at", "raw", "fresh", "timeliness", "raw_products", sql.ROWS,
    f"CASE WHEN max(loaded_at) < {_FIRST} - INTERVAL 48 HOURS THEN 2"
    f" WHEN max(loaded_at) < {_FIRST} - INTERVAL 26 HOURS THEN 1 ELSE 0 END", **sql.over(1),
)

_FACT, _NUTRIENTS, _CATEGORISED = "fct_nutrition", "stg_product_nutrients", "int_products_categorised"
_MASS = "nutrient IN (SELECT nutrient FROM nutrient_reference WHERE is_mass)"
_KCAL = "nutrient = 'energy-kcal'"
_LARGE = "value_large"
_MACROS = ("fat", "carbohydrates", "proteins", "fiber", "salt")
_STATUSES = ("mapped", "unmapped", "no_categories")
_GROUPS = (
    "dairy", "meat_fish_protein", "plant_protein", "vegetables", "fruit", "grains_bread_pasta",
    "snacks_sweets", "beverages", "sauces_condiments", "fats_oils", "ready_meals", "non_food", "other",
)

MODEL_LINES = [
    sql.unique("staging", "stg_products", "barcode"),
    sql.not_null("staging", "stg_products", "barcode"),
    sql.expression("staging", "stg_products", "barcode_format", _BARCODE_OK, **sql.over(1000)),
    sql.accepted("staging", "stg_products", "nutriscore_grade", "abcde"),
    *[sql.not_null("staging", _NUTRIENTS, col) for col in ("barcode", "nutrient")],
    sql.not_null("staging", _NUTRIENTS, "value_per_100", _LARGE),
    sql.expression("staging", _NUTRIENTS, "amount_size", f"{_LARGE} IS NULL", **sql.told()),
    sql.expression("staging", "rejected_amounts", "number", "reason = 'missing'"),
    sql.unique_combination("staging", _NUTRIENTS, "barcode", "nutrient"),
    sql.unique("intermediate", _CATEGORISED, "barcode"),
    sql.not_null("intermediate", _CATEGORISED, "barcode"),
    sql.accepted("intermediate", _CATEGORISED, "mapping_status", _STATUSES),
    sql.unique("marts", "dim_category", "category_key"),
    sql.not_null("marts", "dim_category", "category_key"),
    sql.accepted("marts", "dim_category", "category_l1", _GROUPS),
    sql.unique("marts", "dim_brand", "brand_key"),
    sql.not_null("marts", "dim_brand", "brand_key"),
    sql.unique("marts", "dim_product", "product_key"),
    sql.not_null("marts", "dim_product", "product_key"),
    sql.accepted("marts", "dim_product", "nutriscore_grade", "abcde"),
    sql.accepted("marts", "dim_product", "nutrition_basis", ("100g", "100ml")),
    sql.relationship("marts", "dim_product", "brand_key", "dim_brand", "brand_key"),
    sql.relationship("marts", "dim_product", "category_key", "dim_category", "category_key"),
    sql.accepted("marts", "dim_product", "mapping_status", _STATUSES),
    *[sql.not_null("marts", _FACT, col) for col in ("product_key", "nutrient")],
    sql.not_null("marts", _FACT, "value_per_100", _LARGE),
    sql.relationship("marts", _FACT, "product_key", "dim_product", "product_key"),
    sql.between(f"value_between_{_FACT}_mass", "marts", _FACT, _MASS, "value_per_100", 0, 100, _LARGE, **sql.over(800)),
    sql.between(f"value_between_{_FACT}_kcal", "marts", _FACT, _KCAL, "value_per_100", 0, 900, _LARGE, **sql.over(200)),
    sql.accepted("marts", _FACT, "unit", ("g", "kcal", "kJ")),
    sql.relationship("marts", _FACT, "category_key", "dim_category", "category_key"),
    sql.relationship("marts", _FACT, "brand_key", "dim_brand", "brand_key"),
    sql.unique_combination("marts", _FACT, "product_key", "nutrient"),
    sql.component_sum("marts", _FACT, "product_key", "nutrient", "value_per_100", _MACROS, 105, **sql.over(600)),
    sql.ratio("marts", _FACT, "product_key", "nutrient", "value_per_100", "salt", "sodium", "2.5", "0.15", "0.02",
           **sql.over(2000)),
    sql.unique("seed", "category_taxonomy", "category_l2"),
    sql.not_null("seed", "category_taxonomy", "category_l2"),
    sql.unique("seed", "category_mapping", "off_category_tag"),
    sql.not_null("seed", "category_mapping", "off_category_tag"),
    sql.not_null("seed", "category_mapping", "category_l2"),
    sql.relationship("seed", "category_mapping", "category_l2", "category_taxonomy", "category_l2"),
    sql.unique("seed", "nutrient_reference", "nutrient"),
    sql.not_null("seed", "nutrient_reference", "nutrient"),
]

_FACT_COLUMNS = ("product_key", "nutrient", "value_per_100", "unit", "basis", "category_key", "brand_key")
CONTRACT_LINES = [
    *[
        sql.not_null("contract", _FACT, col, _LARGE if col == "value_per_100" else "NULL").replace("'not_null_", "'contract_not_null_", 1)
        for col in _FACT_COLUMNS
    ],
    sql.expression("contract", _FACT, "", "coalesce(value_per_100 >= 0, value_large >= 0)", f"contract_expression_{_FACT}_not_negative"),
    sql.unique_combination("contract", _FACT, "product_key", "nutrient",
                        name=f"contract_unique_{_FACT}_product_key_nutrient"),
    sql.between(f"contract_value_between_{_FACT}_mass", "contract", _FACT, _MASS, "value_per_100", 0, 100,
             _LARGE, **sql.over(800)),
    sql.between(f"contract_value_between_{_FACT}_kcal", "contract", _FACT, _KCAL, "value_per_100", 0, 900,
             _LARGE, **sql.over(200)),
    sql.expression("contract", _FACT, "", "unit IN ('g', 'kcal', 'kJ')", f"contract_expression_{_FACT}_unit"),
    sql.relationship("contract", _FACT, "category_key", "dim_category", "category_key", True,
                  f"contract_relationship_{_FACT}_category_key"),
    sql.relationship("contract", _FACT, "brand_key", "dim_brand", "brand_key", True,
                  f"contract_relationship_{_FACT}_brand_key"),
    sql.line(f"contract_max_age_{_FACT}", "contract", "fresh", "timeliness", "one_load", sql.ROWS,
          f"CASE WHEN max(loaded_at) < {_FIRST} - INTERVAL 26 HOURS THEN 1 ELSE 0 END"),
]


def _model_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    models = Models(spark, sf_dir)
    tables = models.stored_tables()
    flagged = suites.with_mass_flag(tables[_FACT], models.seeds)
    return {**tables, _FACT: flagged, "raw": models.one_load}


def _raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Not stored: the checks read a few columns of one load, in two passes, and a count of the other.
    checks, tables = suites.raw_gate(raw_products(spark, sf_dir), LOAD_DATE, AS_OF)
    return c.evaluate(checks, tables)


@query(model_sql(sql.union_all(RAW_LINES)))
def raw_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 12 checks on a raw load."""
    return _raw_results(spark, sf_dir)


@query(model_sql(FRESHNESS_LINE))
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.evaluate([suites.source_freshness(AS_OF)], {"raw": raw_products(spark, sf_dir)})


@query(model_sql(sql.union_all(MODEL_LINES)))
def model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 45 checks on seeds, staging, intermediate and marts, in one query."""
    return c.evaluate(suites.model_checks(), _model_tables(spark, sf_dir))


@query(model_sql(sql.union_all(CONTRACT_LINES)))
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints, quality rules and age limit agreed for the fact."""
    contract = fact_contract()
    checks = [*contract.checks(), contract.age_check(AS_OF)]
    return c.evaluate(checks, _model_tables(spark, sf_dir))


@query(model_sql(f"""
SELECT layer, dimension, severity, verdict, count(*) AS n_checks, CAST(sum(n_failed) AS BIGINT) AS n_failed
FROM ({sql.union_all([*RAW_LINES, *MODEL_LINES])}) GROUP BY ALL
"""))
def check_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks per layer, quality dimension and verdict."""
    models = c.evaluate(suites.model_checks(), _model_tables(spark, sf_dir))
    results = models.unionByName(_raw_results(spark, sf_dir))
    return results.groupBy("layer", "dimension", "severity", "verdict").agg(
        F.count(F.lit(1)).alias("n_checks"), F.sum("n_failed").alias("n_failed")
    )


@query(model_sql(f"""
SELECT count(*) AS n_checks, count(*) FILTER (verdict = 'error') AS n_errors,
  count(*) FILTER (verdict = 'error') > 0 AS stopped FROM ({sql.union_all(RAW_LINES)})
"""))
def gate_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the gate lets the load through."""
    results = _raw_results(spark, sf_dir).collect()  # one row per check
    try:
        c.gate(results)
        stopped = False
    except c.GateFailed:
        stopped = True
    errors = sum(r.verdict == "error" for r in results)
    return spark.createDataFrame(
        [(len(results), errors, stopped)], "n_checks long, n_errors long, stopped boolean"
    )


@query(model_sql(f"""
SELECT "check", n_failed AS n_rows FROM ({sql.union_all(MODEL_LINES)}) WHERE n_failed > 0
"""))
def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the audit stores for each check of the models with failures."""
    checks, tables = suites.model_checks(), _model_tables(spark, sf_dir)
    results = c.evaluate(checks, tables).collect()  # one row per check
    root = scratch_path(spark, "audit")
    paths = c.write_audit(checks, tables, results, lambda name: layers.new_version(root, "audit", name))
    parts = [
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("check", F.lit(name))
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], "check string, n_rows long"))


_AMOUNT = "CAST(CAST(value_per_100 AS DECIMAL(24,7)) AS DOUBLE) AS value_per_100"


@query(model_sql(f"SELECT * REPLACE ({_AMOUNT}) FROM {_FACT}"))
def published_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as readers find it after an empty version was published and then switched.

    The table is in a database of its own, so published marts of this session stay as they are.
    """
    models = Models(spark, sf_dir)
    fact = p.fct_nutrition(models.keyed, models.seeds)
    root = scratch_path(spark, "published")
    spark.sql("CREATE DATABASE IF NOT EXISTS published_trial")
    for version in (fact.limit(0), fact):
        _, path = layers.write_version(version, root, "published_trial", _FACT)
        shown = layers.publish(spark, "published_trial", _FACT, path)
    return shown.withColumn("value_per_100", as_double("value_per_100"))


# --- failing rows ----------------------------------------------------------------


def _failing(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """What the audit keeps for one model check."""
    models = Models(spark, sf_dir)
    fact = p.fct_nutrition(models.keyed, models.seeds)
    tables = {
        "stg_products": models.stg_products,
        "stg_product_nutrients": p.stg_product_nutrients(models.stg_products),
        "rejected_amounts": p.rejected_amounts(models.stg_products),
        _FACT: suites.with_mass_flag(fact, models.seeds),
    }
    return _model_check(name).failing(tables)


def _model_check(name: str) -> c.Check:
    (check,) = [check for check in suites.model_checks() if check.name == name]
    return check


@query(model_sql(f"""
SELECT barcode, product_name FROM stg_products WHERE NOT {_BARCODE_OK}
"""))
def failing_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _failing(spark, sf_dir, "expression_stg_products_barcode_format")
    return rows.select("barcode", "product_name")


@query(model_sql(f"""
SELECT product_key, nutrient, {_AMOUNT}, value_large, unit FROM {_FACT}
WHERE {_MASS} AND coalesce(value_per_100, value_large) NOT BETWEEN 0 AND 100
"""))
def failing_mass_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _failing(spark, sf_dir, f"value_between_{_FACT}_mass")
    return rows.select("product_key", "nutrient", as_double("value_per_100"), "value_large", "unit")


@query(model_sql(f"""
SELECT product_key, CAST(CAST(component_sum AS DECIMAL(24,7)) AS DOUBLE) AS component_sum FROM (
  SELECT product_key, sum(value_per_100) AS component_sum, count(DISTINCT nutrient) AS k FROM {_FACT}
  WHERE nutrient IN {_MACROS} GROUP BY product_key) WHERE k = 5 AND component_sum > 105
"""))
def failing_component_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _failing(spark, sf_dir, f"component_sum_{_FACT}_value_per_100")
    (total,) = [name for name in rows.columns if name.startswith("value_per_100_")]
    return rows.select("product_key", as_double(total).alias("component_sum"))


@query(model_sql(f"""
SELECT product_key, CAST(CAST(salt AS DECIMAL(24,7)) AS DOUBLE) AS salt,
  CAST(CAST(sodium AS DECIMAL(24,7)) AS DOUBLE) AS sodium FROM (
  SELECT product_key, max(value_per_100) FILTER (nutrient = 'salt') AS salt,
    max(value_per_100) FILTER (nutrient = 'sodium') AS sodium FROM {_FACT} GROUP BY product_key)
WHERE abs(salt - sodium * 2.5) > greatest(0.15 * salt, 0.02)
"""))
def failing_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _failing(spark, sf_dir, f"ratio_{_FACT}_salt_sodium")
    return rows.select("product_key", as_double("salt"), as_double("sodium"))


@query(model_sql(f"""
SELECT barcode, nutrient, count(*) AS n_records FROM {_NUTRIENTS} GROUP BY ALL HAVING count(*) > 1
"""))
def duplicate_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products that can't repeat a nutrient are passed by: a task can't hold all entries of its products grouped."""
    products = p.with_repeated_nutrients(Models(spark, sf_dir).stg_products)
    check = _model_check(f"unique_{_NUTRIENTS}_barcode_nutrient")
    return check.failing({_NUTRIENTS: p.stg_product_nutrients(products)})


# --- profiles ----------------------------------------------------------------------


def _metrics_sql(table_name: str, source: str, metrics: dict[str, str]) -> str:
    return sql.union_all(
        [
            f"""SELECT '{table_name}' AS "table", '{metric}' AS metric, CAST({value} AS DOUBLE) AS value
FROM {source}"""
            for metric, value in metrics.items()
        ]
    )


def _pct(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN round({part} * CAST(100 AS DOUBLE) / {whole}, 2) ELSE 0 END"


def _raw_metrics(source: str) -> str:
    complete = {
        "product_name": "len(product_name) > 0",
        "brands": "trim(brands) <> ''",
        "categories_tags": "len(categories_tags) > 0",
        "nutriments": "len(nutriments) > 0",
        "nutriscore_grade": "nutriscore_grade IS NOT NULL",
    }
    return _metrics_sql("raw", source, {
        "row_count": "count(*)",
        "distinct_barcode": "count(DISTINCT barcode)",
        "surplus_rows_barcode": "count(barcode) - count(DISTINCT barcode)",
        **{f"complete_pct_{k}": _pct(f"count(*) FILTER ({v})", "count(*)") for k, v in complete.items()},
        "failed_pct_barcode_format": _pct(f"count(*) FILTER (NOT {_BARCODE_OK})", "count(barcode)"),
        "newest_loaded_at": "epoch(max(loaded_at))",
    })


def _raw_profile(load: DataFrame) -> DataFrame:
    return profiling.profile(load, "raw", **suites.raw_metrics())


@query(model_sql(_raw_metrics("one_load")))
def profile_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, completeness and format failures of one load."""
    return _raw_profile(one_load(spark, sf_dir))


@query(model_sql(sql.union_all([
    _metrics_sql("int_products_categorised", _CATEGORISED, {
        "row_count": "count(*)",
        "failed_pct_coverage": _pct("count(*) FILTER (mapping_status = 'unmapped')",
                                    "count(*) FILTER (mapping_status <> 'no_categories')"),
    }),
    _metrics_sql("dim_brand", "dim_brand", {"row_count": "count(*)"}),
    _metrics_sql("dim_product", "dim_product", {
        "row_count": "count(*)", "distinct_product_key": "count(DISTINCT product_key)",
        "surplus_rows_product_key": "count(product_key) - count(DISTINCT product_key)"}),
    _metrics_sql(_FACT, _FACT, {"row_count": "count(*)"}),
])))
def profile_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the models and the share of tagged products that no category covers."""
    tables = Models(spark, sf_dir).stored_tables(store_fact=False)
    status = F.col("mapping_status")
    coverage = {"coverage": (status != "no_categories", status == "unmapped")}
    parts = [
        profiling.profile(tables[_CATEGORISED], _CATEGORISED, rules=coverage),
        profiling.profile(tables["dim_brand"], "dim_brand"),
        profiling.profile(tables["dim_product"], "dim_product", distinct=["product_key"]),
        profiling.profile(tables[_FACT], _FACT),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(model_sql(f""", earlier AS (SELECT * FROM raw_products WHERE load_date = DATE '{PREVIOUS_DATE}'),
before AS ({_raw_metrics("earlier")}), after AS ({_raw_metrics("one_load")})
SELECT "table", metric, before.value AS before, after.value AS after,
  before.value IS NOT DISTINCT FROM after.value AS same
FROM before FULL JOIN after USING ("table", metric)
"""))
def compare_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of two loads side by side."""
    raw = raw_products(spark, sf_dir)
    before = _raw_profile(chosen_partition(raw, PREVIOUS_DATE, required=False))
    after = _raw_profile(chosen_partition(raw, LOAD_DATE, required=False))
    return profiling.compare_profiles(before, after)


@query(sql.union_all([
    _metrics_sql("documents", "documents", {
        "row_count": "count(*)", "distinct_source": "count(DISTINCT source)",
        "surplus_rows_source": "count(source) - count(DISTINCT source)",
        "complete_pct_text": _pct("count(*) FILTER (n_chars >= 100)", "count(*)")}),
    _metrics_sql("lineitem", "lineitem", {
        "row_count": "count(*)",
        "failed_pct_discount": _pct("count(*) FILTER (l_returnflag = 'A' AND l_discount > 0.05)",
                                    "count(*) FILTER (l_returnflag = 'A')"),
        "newest_l_shipdate": "epoch(max(l_shipdate))"}),
]))
def profile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = profiling.profile(
        table(spark, sf_dir, "documents"), "documents", distinct=["source"],
        missing={"text": F.col("n_chars") < 100},
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    rule = (F.col("l_returnflag") == "A", F.col("l_discount") > 0.05)
    return documents.unionByName(
        profiling.profile(lines, "lineitem", rules={"discount": rule}, newest="l_shipdate")
    )
