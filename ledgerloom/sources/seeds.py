"""The three small reference tables with declared types."""

from __future__ import annotations

import csv
import io
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.sources import fixed_values

_PARSERS = {T.IntegerType(): int, T.BooleanType(): lambda v: v == "true"}


@dataclass(frozen=True)
class Seeds:
    """Joins with them carry no broadcast hint: Spark sees their size and decides."""

    category_taxonomy: DataFrame
    category_mapping: DataFrame
    nutrient_reference: DataFrame


def seed_rows(text: str, schema: T.StructType) -> list[tuple]:
    parsers = [_PARSERS.get(f.dataType, str) for f in schema]
    rows = csv.reader(io.StringIO(text))
    next(rows)
    return [tuple(p(v) if v else None for p, v in zip(parsers, row, strict=True)) for row in rows]


def values(rows: list[tuple]) -> str:
    """Rows as a SQL ``VALUES`` list."""
    return "VALUES " + ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def in_plan_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small table inside the plan. Spark knows its exact size, so it may broadcast it.

    A DataFrame made from a Python list is an RDD of unknown size to the planner,
    and joins with it would sort and shuffle the large side.
    """
    inline = spark.sql(f"SELECT * FROM ({values(rows)}) AS seed({', '.join(schema.names)})")
    return inline.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def built_in_seeds(spark: SparkSession) -> Seeds:
    """Seeds of the package; the rows travel inside the plan, no file is read."""

    def table(text: str, schema: T.StructType) -> DataFrame:
        return in_plan_table(spark, seed_rows(text, schema), schema)

    return Seeds(
        table(fixed_values.CATEGORY_TAXONOMY, schemas.CATEGORY_TAXONOMY),
        table(fixed_values.CATEGORY_MAPPING, schemas.CATEGORY_MAPPING),
        table(fixed_values.NUTRIENT_REFERENCE, schemas.NUTRIENT_REFERENCE),
    )


def read_seeds(spark: SparkSession, folder: str) -> Seeds:
    """Seeds from ``<name>.csv`` files in a folder the cluster can read."""

    def table(name: str, schema: T.StructType) -> DataFrame:
        return spark.read.csv(f"{folder}/{name}.csv", schema=schema, header=True, escape='"')

    return Seeds(
        table("category_taxonomy", schemas.CATEGORY_TAXONOMY),
        table("category_mapping", schemas.CATEGORY_MAPPING),
        table("nutrient_reference", schemas.NUTRIENT_REFERENCE),
    )
