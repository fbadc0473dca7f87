"""The product datasets, from the raw snapshot to the star schema.

One shuffle, the newest-version choice, carries the whole build. Everything a
product row needs later (brand, category, basis) is computed on that row, so the
product dimension and the fact are projections of one table instead of joins of
several on the barcode. Only the brand dimension groups again, on counts.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.measures import (
    energy_in_kj,
    epoch_to_timestamp,
    finite,
    large_amount,
    large_energy_in_kj,
    nutrition_basis,
    surrogate_key,
    to_amount,
)
from ledgerloom.functions.nested import is_missing_list, pick_by_preference
from ledgerloom.functions.text import (
    blank_to_null,
    label_key,
    label_or_unknown,
    restrict_domain,
    unit_label,
)
from ledgerloom.operators.matching import best_tag, with_parent
from ledgerloom.operators.ranking import latest_per_key, latest_then_built, most_common_value, top_per_group
from ledgerloom.sources.seeds import Seeds

# Fixed values.
LANGUAGES = ("nl", "en")
GRADES = ("a", "b", "c", "d", "e")
MEASURE_UNITS = ("g", "mg", "kcal", "kj")
STATUSES = ("mapped", "unmapped", "no_categories")
FALLBACK_CATEGORY = "other"
SAMPLE_PER_CATEGORY = 13

CATEGORISED_COLUMNS = ("barcode", "matched_tag", "category_l2", "category_l1", "mapping_status")

# The raw columns that staging reads; the others never leave the scan.
STAGED_COLUMNS = (
    "barcode", "product_name", "brands", "categories_tags", "nutriments", "quantity",
    "product_quantity_unit", "nutrition_data_per", "nutriscore_grade", "last_modified_t",
    "load_date", "loaded_at",
)


def stg_products(raw: DataFrame, built: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per barcode of the given load: the newest version, cleaned.

    Columns that ``raw`` holds only what is needed for are given as ``built``, and made after the shuffle.
    """
    keys, times = ["barcode"], ["last_modified_t", "loaded_at"]
    if built:
        newest = latest_then_built(raw, STAGED_COLUMNS, keys, times, built)
    else:
        newest = latest_per_key(raw.select(*STAGED_COLUMNS), keys, *times)
    return newest.select(
        "barcode",
        blank_to_null(pick_by_preference("product_name", LANGUAGES)).alias("product_name"),
        blank_to_null("brands").alias("brands"),
        "categories_tags",
        "nutriments",
        blank_to_null("quantity").alias("quantity"),
        blank_to_null("product_quantity_unit").alias("product_quantity_unit"),
        "nutrition_data_per",
        restrict_domain("nutriscore_grade", GRADES).alias("nutriscore_grade"),
        epoch_to_timestamp("last_modified_t").alias("last_modified_at"),
        "load_date",
    )


def _measures(df: DataFrame, *keep: str, lowest: float | None = None) -> DataFrame:
    """Entries of ``nutriments`` that hold an amount in a mass or energy unit.

    Whether an amount is usable is decided on the number as it came, so the
    exact decimal is made once, and only for the entries that stay. An amount
    beyond the decimal's digits is in ``value_large`` instead.
    """
    entry = F.col("entry")
    number = finite(entry["100g"])
    usable = number.isNotNull() & F.lower(entry["unit"]).isin(*MEASURE_UNITS)
    if lowest is not None:
        usable = usable & (number >= lowest)
    entries = df.select(*keep, F.explode("nutriments").alias("entry")).where(usable)
    return entries.select(
        *keep,
        entry["name"].alias("nutrient"),
        to_amount(entry["100g"]).alias("value_per_100"),
        large_amount(entry["100g"]).alias("value_large"),
        unit_label(entry["unit"]).alias("unit"),
    )


def stg_product_nutrients(products: DataFrame) -> DataFrame:
    """Long form: one row per barcode and usable nutrient entry."""
    return _measures(products, "barcode")


def with_repeated_nutrients(products: DataFrame) -> DataFrame:
    """The products that a repeated (barcode, nutrient) can come from: one names a nutrient twice, or its barcode recurs.

    All rows of such a key are kept, so duplicates can be looked for in these alone. Staged products leave
    the newest-version choice in the order of the barcode, and are neither shuffled nor sorted for this.
    """
    names = F.transform("nutriments", lambda e: e["name"])
    copies = F.count(F.lit(1)).over(Window.partitionBy("barcode"))
    repeated = (F.col("__copies") > 1) | (F.size(F.array_distinct(names)) < F.size(names))
    return products.withColumn("__copies", copies).where(repeated).drop("__copies")


def rejected_amounts(products: DataFrame) -> DataFrame:
    """Entries in a measure unit without an amount that staging can carry, with the reason."""
    entry = F.col("entry")
    reason = F.when(entry["100g"].isNull(), "missing").when(finite(entry["100g"]).isNull(), "no number")
    entries = products.select("barcode", F.explode("nutriments").alias("entry"))
    return entries.where(F.lower(entry["unit"]).isin(*MEASURE_UNITS) & reason.isNotNull()).select(
        "barcode", entry["name"].alias("nutrient"), entry["100g"].cast("string").alias("amount"),
        entry["unit"].alias("unit"), reason.alias("reason"),
    )


def categorised(products: DataFrame, seeds: Seeds) -> DataFrame:
    """Staged products with the winning tag, the category and how it was reached."""
    matched = best_tag(
        products, "barcode", "categories_tags", seeds.category_mapping,
        tag="off_category_tag", target="category_l2",
    )
    known = seeds.category_taxonomy.select(
        F.col("category_l2").alias("matched_target"), F.col("category_l1").alias("known_l1")
    )
    known_l2 = F.when(F.col("known_l1").isNotNull(), F.col("matched_target"))
    return (
        matched.join(known, "matched_target", "left")
        .withColumns(
            {
                "category_l2": F.coalesce(known_l2, F.lit(FALLBACK_CATEGORY)),
                "category_l1": F.coalesce("known_l1", F.lit(FALLBACK_CATEGORY)),
                "mapping_status": F.when(is_missing_list("categories_tags"), "no_categories")
                .when(F.col("matched_tag").isNotNull(), "mapped")
                .otherwise("unmapped"),
            }
        )
        .drop("matched_target", "known_l1")
    )


def int_products_categorised(products: DataFrame, seeds: Seeds) -> DataFrame:
    """One row per barcode: winning tag, category and how it was reached."""
    return categorised(products, seeds).select(*CATEGORISED_COLUMNS)


def dim_category(seeds: Seeds) -> DataFrame:
    return seeds.category_taxonomy.select(
        surrogate_key("category_l2").alias("category_key"),
        "category_l2",
        "category_l1",
        "description",
    )


def dim_brand(products: DataFrame) -> DataFrame:
    """One row per case-folded primary brand with its most common spelling and size."""
    brands = products.select(
        label_key("brands").alias("brand_key_source"), label_or_unknown("brands").alias("brand_name")
    )
    return most_common_value(brands, "brand_key_source", "brand_name").select(
        surrogate_key("brand_key_source").alias("brand_key"),
        "brand_name",
        F.col("n_rows").alias("product_count"),
    )


def products_with_keys(products: DataFrame, seeds: Seeds) -> DataFrame:
    """Staged products that have a barcode, with every dimension key on the row."""
    return with_keys(categorised(products, seeds), seeds)


def with_brand_key(products: DataFrame) -> DataFrame:
    return products.withColumn("brand_key", surrogate_key(label_key("brands")))


def with_keys(categorised: DataFrame, seeds: Seeds) -> DataFrame:
    """The same of products that are categorised already, and may have their brand's key."""
    if "brand_key" not in categorised.columns:
        categorised = with_brand_key(categorised)
    categories = dim_category(seeds).select("category_key", "category_l2")
    return (
        categorised.where(F.col("barcode").isNotNull())
        .join(categories, "category_l2", "left")
        .select(
            F.col("barcode").alias("product_key"),
            "product_name",
            "quantity",
            "nutriscore_grade",
            nutrition_basis("nutrition_data_per", "product_quantity_unit").alias("nutrition_basis"),
            "last_modified_at",
            "brand_key",
            "category_key",
            "mapping_status",
            "nutriments",
        )
    )


def dim_product(keyed: DataFrame) -> DataFrame:
    return keyed.drop("nutriments")


def fct_nutrition(keyed: DataFrame, seeds: Seeds) -> DataFrame:
    """One row per product and nutrient, in the nutrient's standard unit.

    Mass amounts are in grams whatever their label says, so they are only
    relabelled; the generic energy entry is the one that is converted. Unlisted
    nutrients and negative amounts are left out.
    """
    reference = seeds.nutrient_reference.select(
        F.lower("nutrient").alias("nutrient_key"), "standard_unit"
    )
    measures = _measures(
        keyed.withColumnRenamed("nutrition_basis", "basis"),
        "product_key", "basis", "category_key", "brand_key", lowest=0.0,
    )
    return (
        measures.withColumn("nutrient_key", F.lower("nutrient"))
        .join(reference, "nutrient_key")
        .select(
            "product_key",
            "nutrient",
            energy_in_kj("nutrient", "unit", "value_per_100").alias("value_per_100"),
            large_energy_in_kj("nutrient", "unit", "value_large").alias("value_large"),
            F.col("standard_unit").alias("unit"),
            "basis",
            "category_key",
            "brand_key",
        )
    )


def sample_keys(products: DataFrame, categories: DataFrame, n: int = SAMPLE_PER_CATEGORY) -> DataFrame:
    """First ``n`` product keys, in key order, of every top-level category."""
    keys = products.join(categories, "category_key").select("category_l1", "product_key")
    return top_per_group(keys, ["category_l1"], [F.col("product_key").asc()], n)


def stratified_sample(
    raw: DataFrame, products: DataFrame, categories: DataFrame, n: int = SAMPLE_PER_CATEGORY
) -> DataFrame:
    """Raw rows of the sampled products, in key order.

    The keys are at most ``n`` for each top-level category, so they go to the rows; Spark can't tell
    how few they are, and would shuffle the whole load to them.
    """
    keys = F.broadcast(sample_keys(products, categories, n))
    return with_parent(raw, keys, "barcode", "product_key").orderBy("barcode")
