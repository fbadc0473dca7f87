"""Table layouts."""

from __future__ import annotations

from pyspark.sql import types as T

from ledgerloom.functions.measures import CONVERTED

LIST = T.ArrayType(T.StringType())
NAMES = T.ArrayType(
    T.StructType([T.StructField("lang", T.StringType()), T.StructField("text", T.StringType())])
)
# Amounts arrive as floats. A double keeps their digits and, unlike a wide decimal,
# reads fast inside an array; staging turns it into an exact decimal by its text.
NUTRIMENTS = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", T.StringType()),
            T.StructField("100g", T.DoubleType()),
            T.StructField("unit", T.StringType()),
        ]
    )
)

# Names, order and types of the snapshot columns.
SNAPSHOT = T.StructType(
    [
        T.StructField("barcode", T.StringType()),
        T.StructField("product_name", NAMES),
        T.StructField("brands", T.StringType()),
        T.StructField("categories_tags", LIST),
        T.StructField("nutriments", NUTRIMENTS),
        T.StructField("quantity", T.StringType()),
        T.StructField("nutriscore_grade", T.StringType()),
        T.StructField("last_modified_t", T.LongType()),
        T.StructField("countries_tags", LIST),
        T.StructField("product_quantity", T.StringType()),
        T.StructField("product_quantity_unit", T.StringType()),
        T.StructField("brands_tags", LIST),
        T.StructField("nova_group", T.IntegerType()),
        T.StructField("environmental_score_grade", T.StringType()),
        T.StructField("completeness", T.FloatType()),
        T.StructField("created_t", T.LongType()),
        T.StructField("labels_tags", LIST),
        T.StructField("data_quality_warnings_tags", LIST),
        T.StructField("unique_scans_n", T.IntegerType()),
        T.StructField("nutrition_data_per", T.StringType()),
    ]
)
RAW = T.StructType(
    [
        *SNAPSHOT.fields,
        T.StructField("load_date", T.DateType(), False),
        T.StructField("loaded_at", T.TimestampType(), False),
    ]
)

CATEGORY_TAXONOMY = T.StructType(
    [
        T.StructField("category_l2", T.StringType()),
        T.StructField("category_l1", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)
CATEGORY_MAPPING = T.StructType(
    [
        T.StructField("off_category_tag", T.StringType()),
        T.StructField("category_l2", T.StringType()),
        T.StructField("priority", T.IntegerType()),
    ]
)
NUTRIENT_REFERENCE = T.StructType(
    [
        T.StructField("nutrient", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("standard_unit", T.StringType()),
        T.StructField("nutrient_group", T.StringType()),
        T.StructField("is_mass", T.BooleanType()),
    ]
)

FACT = T.StructType(
    [
        T.StructField("product_key", T.StringType()),
        T.StructField("nutrient", T.StringType()),
        T.StructField("value_per_100", CONVERTED),
        T.StructField("value_large", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("basis", T.StringType()),
        T.StructField("category_key", T.StringType()),
        T.StructField("brand_key", T.StringType()),
    ]
)

# Shown by DESCRIBE once a table is saved with them.
DESCRIPTIONS = {
    "stg_products": {
        "": "One row per barcode: the newest version within the chosen load.",
        "barcode": "Product code, kept as text because leading zeros count.",
        "product_name": "Dutch name, else English, else the first one given.",
        "brands": "Comma list of brands as reported.",
        "nutriscore_grade": "a to e, anything else is NULL.",
        "last_modified_at": "When the source last changed the product.",
        "load_date": "Load the row was taken from.",
    },
    "stg_product_nutrients": {
        "": "One row per barcode and nutrient entry with a mass or energy unit.",
        "value_per_100": "Amount per 100 g or ml, as reported; NULL if it has over 15 whole digits.",
        "value_large": "That amount as a double if it has over 15 whole digits.",
        "unit": "Unit as reported, kJ spelled uniformly.",
    },
    "int_products_categorised": {
        "": "One row per barcode with the category its tags resolve to.",
        "matched_tag": "Tag that won: lowest priority number, then alphabetical.",
        "mapping_status": "mapped, unmapped or no_categories.",
    },
    "dim_category": {
        "": "One row per second-level category.",
        "category_key": "Hash of category_l2.",
    },
    "dim_brand": {
        "": "One row per primary brand, and one for products without a brand.",
        "brand_key": "Hash of the case-folded brand.",
        "brand_name": "Most common spelling, ties by binary order.",
        "product_count": "Products with this primary brand.",
    },
    "dim_product": {
        "": "One row per product.",
        "product_key": "The barcode.",
        "nutrition_basis": "100g or 100ml; stated by the source or inferred from a liquid unit.",
        "brand_key": "Key into dim_brand.",
        "category_key": "Key into dim_category.",
        "mapping_status": "mapped, unmapped or no_categories.",
    },
    "fct_nutrition": {
        "": "One row per product and nutrient, in the nutrient's standard unit.",
        "product_key": "Key into dim_product.",
        "nutrient": "Nutrient name as reported.",
        "value_per_100": "Amount per 100 g or ml in the standard unit, never negative; NULL if too large.",
        "value_large": "The amount as a double if it has over 15 whole digits.",
        "unit": "g, kcal or kJ.",
        "basis": "100g or 100ml.",
        "category_key": "Key into dim_category.",
        "brand_key": "Key into dim_brand.",
    },
}
