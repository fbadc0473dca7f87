"""Arrays, structs and JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import _col


def has_member(column: Column | str, member: str) -> Column:
    return F.array_contains(_col(column), member)


def is_missing_list(column: Column | str) -> Column:
    """True for a NULL or an empty array, never NULL itself."""
    column = _col(column)
    return column.isNull() | (F.size(column) == 0)


def pick_by_preference(
    column: Column | str, preferred: Sequence[str], kind: str = "lang", text: str = "text"
) -> Column:
    """Text of the first element of the most preferred kind, else of the first element.

    Only a NULL falls through to the next choice, an empty text does not.
    """
    column = _col(column)

    def first_of(wanted: str) -> Column:
        return F.get(F.filter(column, lambda e: e[kind] == wanted), F.lit(0))[text]

    return F.coalesce(*map(first_of, preferred), F.get(column, F.lit(0))[text])


def json_text(column: Column | str) -> Column:
    """JSON text that keeps NULL fields; for file boundaries only."""
    return F.to_json(_col(column), {"ignoreNullFields": "false"})


def nested_columns(schema: T.StructType) -> list[str]:
    kinds = (T.ArrayType, T.StructType, T.MapType)
    return [field.name for field in schema if isinstance(field.dataType, kinds)]


def with_json_text(df: DataFrame) -> DataFrame:
    """Every nested column as JSON text, the others unchanged."""
    return df.withColumns({name: json_text(name) for name in nested_columns(df.schema)})


def with_parsed_json(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema``; nested ones are parsed from JSON text, bad fields become NULL."""
    nested = set(nested_columns(schema))
    return df.select(
        *[
            F.from_json(f.name, f.dataType).alias(f.name) if f.name in nested else F.col(f.name)
            for f in schema
        ]
    )


def explode_rows(df: DataFrame, column: str, alias: str) -> DataFrame:
    """One row per array element; rows with a NULL or empty array disappear."""
    return df.withColumn(alias, F.explode(column)).drop(column)
