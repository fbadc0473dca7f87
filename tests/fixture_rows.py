"""A small shop's shelf: complete products, and some that each break one rule."""

from __future__ import annotations

import datetime as dt
from dataclasses import astuple, dataclass, field

from ledgerloom.schemas import SNAPSHOT
from ledgerloom.sources.snapshots import extract_snapshot

LOAD_DATE = dt.date(2024, 1, 1)
LOADED_AT = dt.datetime(2024, 1, 1, 6, tzinfo=dt.timezone.utc)
AS_OF = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)

Entry = tuple[str, float | None, str | None]


def grams(**amounts: float) -> list[Entry]:
    return [(name, float(amount), "g") for name, amount in amounts.items()]


def cheese() -> list[Entry]:
    return [("energy-kcal", 380.0, "kcal"), *grams(fat=31, proteins=24, salt=1.5, sodium=0.6)]


@dataclass(frozen=True)
class Product:
    """A raw row in the order of the snapshot's columns; a young cheese unless told otherwise."""

    barcode: str | None
    product_name: list | None = field(default_factory=lambda: [("en", "Young cheese"), ("nl", "Jonge kaas")])
    brands: str | None = "Polder, Polder Farms"
    categories_tags: list | None = field(default_factory=lambda: ["en:gouda"])
    nutriments: list | None = field(default_factory=cheese)
    quantity: str | None = "1 piece"
    nutriscore_grade: str | None = "d"
    last_modified_t: int | None = 1_600_000_000
    countries_tags: list | None = field(default_factory=lambda: ["en:belgium", "en:netherlands"])
    product_quantity: str | None = None
    product_quantity_unit: str | None = None
    brands_tags: list | None = None
    nova_group: int | None = None
    environmental_score_grade: str | None = None
    completeness: float | None = None
    created_t: int | None = None
    labels_tags: list | None = None
    data_quality_warnings_tags: list | None = None
    unique_scans_n: int | None = None
    nutrition_data_per: str | None = "100g"


SHELVES = {
    "three versions": [
        Product("40000017", last_modified_t=20, brands="Second"),
        Product("40000017", last_modified_t=30, brands="Third"),
        Product("40000017", last_modified_t=10, brands="First"),
    ],
    "codes": [Product("00400116"), Product("4000-123")],
    "basis": [
        Product("40000086", nutrition_data_per="100ml"),
        Product("40000093", nutrition_data_per=None, product_quantity_unit="CL"),
        Product("40000109", nutrition_data_per="serving", product_quantity_unit="kg"),
    ],
    "categories": [
        Product("40000055", categories_tags=[]),
        Product("40000062", categories_tags=["en:moon-rocks"]),
        Product("40000079", categories_tags=["EN:BREADS"]),
    ],
    "grades and brands": [
        Product("40000024", nutriscore_grade=" B "),
        Product("40000031", nutriscore_grade="exempt"),
        Product("40000048", brands=""),
    ],
    "amounts that can't be": [
        Product("40000161", nutriments=grams(salt=2, sodium=2)),
        Product("40000154", nutriments=[("energy-kcal", 1200.0, "kcal")]),
        Product("40000147", nutriments=grams(sugars=130)),
        Product("40000130", nutriments=grams(fat=60, carbohydrates=30, proteins=10, fiber=3, salt=4)),
    ],
}
SHELF = [product for products in SHELVES.values() for product in products]


def source(spark, products):
    """Rows as the source delivers them, with ``code`` as the key."""
    rows = [astuple(product) for product in products]
    return spark.createDataFrame(rows, SNAPSHOT).withColumnRenamed("barcode", "code")


def raw(spark, products, load_date=LOAD_DATE, loaded_at=LOADED_AT):
    return extract_snapshot(source(spark, products), load_date, "en:netherlands", loaded_at)
