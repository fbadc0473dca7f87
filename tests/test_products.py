from __future__ import annotations

from decimal import Decimal

import pytest
from fixture_rows import SHELF, Product, raw

from ledgerloom.functions.measures import CONVERTED
from ledgerloom.plans import products as p


class Built:
    def __init__(self, spark, seeds, rows):
        self.raw = raw(spark, rows)
        self.stg = p.stg_products(self.raw).cache()
        self.nutrients = p.stg_product_nutrients(self.stg)
        self.categorised = p.int_products_categorised(self.stg, seeds)
        self.brands = p.dim_brand(self.stg)
        keyed = p.products_with_keys(self.stg, seeds)
        self.products = p.dim_product(keyed)
        self.fact = p.fct_nutrition(keyed, seeds)


@pytest.fixture(scope="module")
def shelf(spark, seeds):
    return Built(spark, seeds, SHELF)


def by(df, key, *columns):
    return {r[key]: r[columns[0]] if len(columns) == 1 else tuple(r[c] for c in columns) for r in df.collect()}


def test_staging_keeps_one_row_per_barcode(shelf):
    assert (shelf.raw.count(), shelf.stg.count()) == (18, 16)
    brands = by(shelf.stg, "barcode", "brands")
    assert len(brands) == 16
    assert brands["40000017"] == "Third"
    assert brands["40000048"] is None
    assert "00400116" in brands  # a code is text


def test_grades(shelf):
    grades = by(shelf.stg, "barcode", "nutriscore_grade")
    assert (grades.pop("40000024"), grades.pop("40000031")) == ("b", None)
    assert set(grades.values()) == {"d"}


def test_categories(shelf):
    got = by(shelf.categorised, "barcode", "matched_tag", "category_l2", "category_l1", "mapping_status")
    assert got.pop("40000055") == (None, "other", "other", "no_categories")
    assert got.pop("40000062") == (None, "other", "other", "unmapped")
    assert got.pop("40000079") == ("en:breads", "bread", "grains_bread_pasta", "mapped")
    assert set(got.values()) == {("en:gouda", "cheese", "dairy", "mapped")}


def test_dimensions(shelf, seeds):
    basis = by(shelf.products, "product_key", "nutrition_basis")
    assert {code for code, given in basis.items() if given == "100ml"} == {"40000086", "40000093"}
    assert by(shelf.brands, "brand_name", "product_count") == {"Polder": 14, "Third": 1, "unknown": 1}
    categories = p.dim_category(seeds)
    assert categories.count() == 48
    assert shelf.products.join(shelf.brands, "brand_key", "left_anti").isEmpty()
    assert shelf.products.join(categories, "category_key", "left_anti").isEmpty()


def test_fact(shelf):
    sizes = by(shelf.fact.groupBy("product_key").count(), "product_key", "count")
    own = {code: sizes.pop(code) for code in ("40000130", "40000147", "40000154", "40000161")}
    assert list(own.values()) == [5, 1, 1, 2]
    assert set(sizes.values()) == {5} and len(sizes) == 12
    assert shelf.fact.schema["value_per_100"].dataType == CONVERTED
    assert shelf.fact.groupBy("product_key", "nutrient").count().where("count > 1").isEmpty()


EDGE_ROWS = [
    Product("10000001", last_modified_t=1700000000, brands="Dated"),
    Product("10000001", last_modified_t=None, brands="Undated"),
    Product(None, brands="Nobody"),
    Product(None, brands="Nothing"),
    Product("10000002", product_name=[("nl", "  "), ("en", "English")]),
    Product("10000003", product_name=[("fr", "Nom"), ("en", "English")]),
    Product("10000004", product_name=[]),
    Product("10000005", categories_tags=["en:sodas", "EN:BREADS", "en:snacks"]),  # two of priority 2
    Product("10000006", categories_tags=["en:groceries"]),  # mapped to other on purpose
    Product("10000007", categories_tags=["en:dairies", "en:gouda"]),
    Product("10000008", brands=", Foo"),
    Product("10000009", brands="Big\t  Co, Other"),
    Product("10000010", brands="BIG CO"),
    Product("10000011", brands="Unknown"),
    Product("10000012", brands=None),
    Product("10000013", nutriments=[("energy", 100.0, "kcal")]),
    Product("10000014", nutriments=[("energy", 100.0, "KJ")]),
    Product("10000015", nutriments=[("Energy", 100.0, "kcal"), ("FAT", 1.5, "G")]),
    Product("10000016", nutriments=[
        ("fat", 1.0, "%"), ("salt", 1.0, None), ("fiber", None, "g"), ("proteins", -1.0, "g"),
        ("sugars", 0.0, "g"), ("sodium", 0.30000001192092896, "mg"), ("nova-group", 4.0, "g"),
        ("starch", 1e15, "g"), ("water", float("nan"), "g"),
    ]),
    Product("10000017", nutriments=[("fat", 1.0, "g"), ("fat", 2.0, "g")]),
    Product("10000018", nutriments=None),
    Product("10000019", categories_tags=None),
]


@pytest.fixture(scope="module")
def edge(spark, seeds):
    return Built(spark, seeds, EDGE_ROWS)


def test_undated_version_wins_and_missing_barcodes_collapse(edge):
    brands = by(edge.stg, "barcode", "brands")
    assert brands["10000001"] == "Undated"
    assert edge.stg.where("barcode IS NULL").count() == 1
    assert edge.products.where("product_key IS NULL").isEmpty()
    assert edge.products.count() == edge.stg.count() - 1


def test_names(edge):
    names = by(edge.stg, "barcode", "product_name")
    assert (names["10000002"], names["10000003"], names["10000004"]) == (None, "English", None)


def test_tag_rules(edge):
    got = by(edge.categorised, "barcode", "matched_tag", "category_l2", "mapping_status")
    assert got["10000005"] == ("en:breads", "bread", "mapped")
    assert got["10000006"] == ("en:groceries", "other", "mapped")
    assert got["10000007"] == ("en:gouda", "cheese", "mapped")
    assert got["10000019"] == (None, "other", "no_categories")
    assert got[None][2] == "unmapped"  # a missing barcode joins nothing


def test_brand_rules(edge):
    sizes = by(edge.brands, "brand_name", "product_count")
    assert sizes["BIG CO"] == 2  # two spellings once each, the first in binary order is shown
    assert sizes["unknown"] == 3  # no brand, a blank first entry, and a brand spelled Unknown
    assert not {"Foo", "Unknown"} & set(sizes)


def test_measure_rules(edge):
    facts = {}
    for r in edge.fact.collect():
        facts.setdefault(r.product_key, []).append((r.nutrient, r.value_per_100, r.unit))
    assert facts["10000013"] == [("energy", Decimal("418.4"), "kJ")]
    assert facts["10000014"] == [("energy", Decimal(100), "kJ")]
    assert sorted(facts["10000015"]) == [("Energy", Decimal(100), "kJ"), ("FAT", Decimal("1.5"), "g")]
    assert sorted(facts["10000016"], key=lambda f: f[0]) == [
        ("sodium", Decimal("0.30000001192092896"), "g"), ("starch", None, "g"), ("sugars", Decimal(0), "g"),
    ]
    assert len(facts["10000017"]) == 2
    assert "10000018" not in facts
    units = {r.unit for r in edge.nutrients.where("nutrient = 'energy'").collect()}
    assert units == {"kcal", "kJ"}


def test_sample_is_the_first_keys_of_each_category(spark, seeds):
    rows = [Product(f"{i:08d}", categories_tags=[tag]) for i in range(40) for tag in ["en:gouda", "en:waters"][i % 2 :][:1]]
    built = Built(spark, seeds, rows)
    sample = p.stratified_sample(built.raw, built.products, p.dim_category(seeds))
    assert [r.barcode for r in sample.collect()] == [f"{i:08d}" for i in range(26)]


def test_build_shuffles_once(spark, seeds):
    """Newest-version choice aside, keys, product dimension and fact need no exchange."""
    built = Built(spark, seeds, SHELF)
    stg = p.stg_products(built.raw)
    fact = p.fct_nutrition(p.products_with_keys(stg, seeds), seeds)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan
