"""The agreement on the fact table: layout, keys, quality rules and age."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.operators import checks as c
from ledgerloom.operators.checks import Check, Limits
from ledgerloom.plans import suites


class ContractBroken(RuntimeError):
    """The table may not be published."""


@dataclass(frozen=True)
class Contract:
    table: str
    schema: T.StructType
    constraints: tuple[Check, ...]
    quality: tuple[Check, ...]
    max_age_hours: int

    def layout_problems(self, df: DataFrame) -> list[str]:
        """Missing, surplus or differently typed columns; order does not matter."""
        agreed = {f.name: f.dataType.simpleString() for f in self.schema}
        actual = {f.name: f.dataType.simpleString() for f in df.schema}
        problems = [f"column {n} is missing" for n in agreed if n not in actual]
        problems += [f"column {n} is not agreed" for n in actual if n not in agreed]
        problems += [
            f"column {n} is {actual[n]}, agreed is {agreed[n]}"
            for n in agreed
            if n in actual and actual[n] != agreed[n]
        ]
        return problems

    def require_layout(self, df: DataFrame) -> None:
        problems = self.layout_problems(df)
        if problems:
            raise ContractBroken(f"{self.table}: " + "; ".join(problems))

    def checks(self) -> list[Check]:
        return [*self.constraints, *self.quality]

    def evaluate(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return c.evaluate(self.checks(), tables)

    def age_check(self, as_of: dt.datetime, table: str = "raw", column: str = "loaded_at") -> Check:
        """The table can be no fresher than its source, so the source's age decides."""
        check = c.fresh("contract", table, column, as_of, self.max_age_hours)
        return check.named(f"contract_max_age_{self.table}")


def fact_contract() -> Contract:
    """Layout, key, limits and age of the published fact.

    NULL keys are orphans here, unlike in the foreign-key tests of the models.
    """
    layer, fact = "contract", "fct_nutrition"

    def at_most(n: int) -> Limits:
        return Limits(warn_above=0, error_above=n)

    def own(check: Check) -> Check:
        return check.named(f"contract_{check.name}")

    constraints = [
        *[
            c.not_null(layer, fact, name, instead=suites.LARGE if name == "value_per_100" else None)
            for name in schemas.FACT.names
            if name != suites.LARGE
        ],
        c.expression_is_true(
            layer, fact, "not_negative", F.coalesce(F.col("value_per_100") >= 0, F.col(suites.LARGE) >= 0)
        ),
        # The primary key and the grain rule are one and the same.
        c.unique_combination(layer, fact, "product_key", "nutrient"),
    ]
    quality = [
        suites.mass_range(at_most(800), layer),
        suites.kcal_range(at_most(200), layer),
        c.expression_is_true(layer, fact, "unit", F.col("unit").isin(*suites.UNITS)),
        c.relationship(layer, fact, "category_key", "dim_category", "category_key", True),
        c.relationship(layer, fact, "brand_key", "dim_brand", "brand_key", True),
    ]
    return Contract(
        table=fact,
        schema=schemas.FACT,
        constraints=tuple(own(check) for check in constraints),
        quality=tuple(own(check) for check in quality),
        max_age_hours=suites.WARN_HOURS,
    )
