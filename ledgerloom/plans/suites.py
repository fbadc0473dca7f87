"""The checks of the product datasets: 12 on the raw load, 45 on the models, freshness of the source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.nested import is_missing_list
from ledgerloom.functions.text import matches
from ledgerloom.operators import checks as c
from ledgerloom.operators.checks import Check, Limits
from ledgerloom.plans.products import GRADES, STATUSES
from ledgerloom.schemas import RAW
from ledgerloom.sources import statistics
from ledgerloom.sources.seeds import Seeds
from ledgerloom.sources.snapshots import chosen_partition, previous_partition

# Fixed values.
ROW_COUNT_RANGE = (50_000, 200_000)
DROP_RATIO = "0.7"
MISSING_SHARES = {  # highest share of incomplete rows
    "product_name": "0.05",
    "brands": "0.20",
    "categories_tags": "0.65",
    "nutriments": "0.45",
}
GRADE_MISSING_SHARE = "0.005"
BARCODE_MISMATCH_SHARE = "0.01"
WARN_HOURS, ERROR_HOURS = 26, 48
CATEGORY_GROUPS = (
    "dairy", "meat_fish_protein", "plant_protein", "vegetables", "fruit", "grains_bread_pasta",
    "snacks_sweets", "beverages", "sauces_condiments", "fats_oils", "ready_meals", "non_food",
    "other",
)
BASES = ("100g", "100ml")
UNITS = ("g", "kcal", "kJ")
MACRONUTRIENTS = ("fat", "carbohydrates", "proteins", "fiber", "salt")
MACRO_BOUND = 105
SALT_PER_SODIUM, RELATIVE_TOLERANCE, ABSOLUTE_TOLERANCE = "2.5", "0.15", "0.02"
#: Where an amount is that the exact decimal can't hold; any is told.
LARGE = "value_large"
ANY_LIMITS = Limits(warn_above=0, error_above=None)
BARCODE_LIMITS = Limits(warn_above=0, error_above=1000)
MASS_LIMITS = Limits(warn_above=0, error_above=800)
KCAL_LIMITS = Limits(warn_above=0, error_above=200)
MACRO_LIMITS = Limits(warn_above=0, error_above=600)
SALT_LIMITS = Limits(warn_above=0, error_above=2000)


def missing_rules() -> dict[str, Column]:
    """When a raw row counts as incomplete: NULL, blank or an empty list."""
    return {
        "product_name": is_missing_list("product_name"),
        "brands": F.col("brands").isNull() | (F.trim("brands") == ""),
        "categories_tags": is_missing_list("categories_tags"),
        "nutriments": is_missing_list("nutriments"),
    }


def previous_count(
    raw: DataFrame, load_date: dt.date | str, previous: dt.date | None = None
) -> Column:
    """Rows of the load before ``load_date`` as a scalar, 0 if there is none.

    A caller that knows the ``previous`` date spares the search for it in the table.
    """
    before = previous_partition(raw, load_date) if previous is None else F.lit(previous)
    earlier = raw.where(F.col("load_date") == before)
    return earlier.agg(F.count(F.lit(1))).scalar()


def raw_checks(
    raw: DataFrame,
    load_date: dt.date | str,
    as_of: dt.datetime,
    row_count_range: tuple[int, int] = ROW_COUNT_RANGE,
    previous: dt.date | None = None,
    previous_rows: int | None = None,
) -> list[Check]:
    """The 12 checks that one load must pass before anything is built from it.

    A caller that has the load before's statistics gives its ``previous_rows``, and that load isn't read.
    """
    layer = table = "raw"
    missing = missing_rules()
    if previous_rows is None:
        before = previous_count(raw, load_date, previous)
    else:
        before = F.lit(previous_rows)
    return [
        c.row_count_between(layer, table, *row_count_range),
        c.not_dropped(layer, table, before, DROP_RATIO),
        c.not_null(layer, table, "barcode"),
        c.unique(layer, table, "barcode", count_rows=True),
        c.matches_mostly(layer, table, "barcode", matches("barcode"), BARCODE_MISMATCH_SHARE),
        *[
            c.complete_mostly(layer, table, column, missing[column], share)
            for column, share in MISSING_SHARES.items()
        ],
        c.not_null(layer, table, "nutriscore_grade", GRADE_MISSING_SHARE),
        c.fresh(layer, table, "loaded_at", as_of, WARN_HOURS),
        c.required_columns(layer, table, RAW.names),
    ]


def raw_statistics(load: DataFrame) -> DataFrame:
    """What is stored with every raw load: size, keys, completeness, broken barcodes, newest time."""
    return statistics.describe(load, "raw", **raw_metrics())


def raw_metrics() -> dict:
    """Arguments of a profile, or of statistics, of raw loads."""
    return {
        "distinct": ["barcode"],
        "missing": {**missing_rules(), "nutriscore_grade": F.col("nutriscore_grade").isNull()},
        "rules": {"barcode_format": (F.col("barcode").isNotNull(), ~matches("barcode"))},
        "newest": "loaded_at",
    }


def raw_gate(
    raw: DataFrame, load_date: dt.date | str, as_of: dt.datetime, **options
) -> tuple[list[Check], dict[str, DataFrame]]:
    """The raw checks and the table they run on: the one load, not the history."""
    load = chosen_partition(raw, load_date, required=False)
    return raw_checks(raw, load_date, as_of, **options), {"raw": load}


def source_freshness(as_of: dt.datetime) -> Check:
    """Three-way verdict on the newest load; a source without rows is stale."""
    check = c.fresh("raw", "raw", "loaded_at", as_of, ERROR_HOURS, WARN_HOURS, empty_is_stale=True)
    return check.named("source_freshness_raw_loaded_at")


def with_mass_flag(fact: DataFrame, seeds: Seeds) -> DataFrame:
    """The fact with ``is_mass`` of its nutrient, so range rules need no join of their own."""
    flags = seeds.nutrient_reference.where("is_mass").select("nutrient", "is_mass").distinct()
    return fact.join(flags, "nutrient", "left")


def model_checks() -> list[Check]:
    """The 45 checks on seeds, staging, intermediate and marts.

    ``fct_nutrition`` must carry ``is_mass``, see ``with_mass_flag``.
    """
    stg, nutrients = "stg_products", "stg_product_nutrients"
    categorised, product, fact = "int_products_categorised", "dim_product", "fct_nutrition"
    return [
        c.unique("staging", stg, "barcode"),
        c.not_null("staging", stg, "barcode"),
        c.expression_is_true("staging", stg, "barcode_format", matches("barcode"), BARCODE_LIMITS),
        c.accepted_values("staging", stg, "nutriscore_grade", GRADES),
        c.not_null("staging", nutrients, "barcode"),
        c.not_null("staging", nutrients, "nutrient"),
        c.not_null("staging", nutrients, "value_per_100", instead=LARGE),
        c.expression_is_true("staging", nutrients, "amount_size", F.col(LARGE).isNull(), ANY_LIMITS),
        c.expression_is_true("staging", "rejected_amounts", "number", F.col("reason") == "missing"),
        c.unique_combination("staging", nutrients, "barcode", "nutrient"),
        c.unique("intermediate", categorised, "barcode"),
        c.not_null("intermediate", categorised, "barcode"),
        c.accepted_values("intermediate", categorised, "mapping_status", STATUSES),
        c.unique("marts", "dim_category", "category_key"),
        c.not_null("marts", "dim_category", "category_key"),
        c.accepted_values("marts", "dim_category", "category_l1", CATEGORY_GROUPS),
        c.unique("marts", "dim_brand", "brand_key"),
        c.not_null("marts", "dim_brand", "brand_key"),
        c.unique("marts", product, "product_key"),
        c.not_null("marts", product, "product_key"),
        c.accepted_values("marts", product, "nutriscore_grade", GRADES),
        c.accepted_values("marts", product, "nutrition_basis", BASES),
        c.relationship("marts", product, "brand_key", "dim_brand", "brand_key"),
        c.relationship("marts", product, "category_key", "dim_category", "category_key"),
        c.accepted_values("marts", product, "mapping_status", STATUSES),
        c.not_null("marts", fact, "product_key"),
        c.relationship("marts", fact, "product_key", product, "product_key"),
        c.not_null("marts", fact, "nutrient"),
        c.not_null("marts", fact, "value_per_100", instead=LARGE),
        mass_range(MASS_LIMITS),
        kcal_range(KCAL_LIMITS),
        c.accepted_values("marts", fact, "unit", UNITS),
        c.relationship("marts", fact, "category_key", "dim_category", "category_key"),
        c.relationship("marts", fact, "brand_key", "dim_brand", "brand_key"),
        c.unique_combination("marts", fact, "product_key", "nutrient"),
        c.component_sum_at_most(
            "marts", fact, "product_key", "nutrient", "value_per_100",
            MACRONUTRIENTS, MACRO_BOUND, MACRO_LIMITS, instead=LARGE,
        ),
        c.ratio_consistent(
            "marts", fact, "product_key", "nutrient", "value_per_100", "salt", "sodium",
            SALT_PER_SODIUM, RELATIVE_TOLERANCE, ABSOLUTE_TOLERANCE, SALT_LIMITS, instead=LARGE,
        ),
        c.unique("seed", "category_taxonomy", "category_l2"),
        c.not_null("seed", "category_taxonomy", "category_l2"),
        c.unique("seed", "category_mapping", "off_category_tag"),
        c.not_null("seed", "category_mapping", "off_category_tag"),
        c.not_null("seed", "category_mapping", "category_l2"),
        c.relationship("seed", "category_mapping", "category_l2", "category_taxonomy", "category_l2"),
        c.unique("seed", "nutrient_reference", "nutrient"),
        c.not_null("seed", "nutrient_reference", "nutrient"),
    ]


def mass_range(limits: Limits, layer: str = "marts") -> Check:
    """Amounts of mass nutrients lie within 0 and 100."""
    return c.value_between(
        layer, "fct_nutrition", "value_per_100", 0, 100, limits,
        only=F.col("is_mass"), name="value_between_fct_nutrition_mass", instead=LARGE,
    )


def kcal_range(limits: Limits, layer: str = "marts") -> Check:
    """Energy in kcal lies within 0 and 900."""
    return c.value_between(
        layer, "fct_nutrition", "value_per_100", 0, 900, limits,
        only=F.col("nutrient") == "energy-kcal", name="value_between_fct_nutrition_kcal", instead=LARGE,
    )


def checks_on(checks: Sequence[Check], *tables: str) -> list[Check]:
    return [check for check in checks if check.table in tables]
