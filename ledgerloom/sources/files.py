"""CSV and Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.nested import nested_columns, with_json_text, with_parsed_json
from ledgerloom.sources.records import records

#: Outer spaces are part of a cell, and times have six digits, on writing and on reading.
CELLS = {
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}
READ = {"nullValue": "", "quote": '"', "escape": '"', **CELLS}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, line_breaks: bool = True, whole_files: bool = False
) -> DataFrame:
    """Typed CSV with a header: an empty cell is NULL, nested columns are cells of JSON text.

    Cells may hold line breaks; large files are read by many tasks all the same, which takes two or
    three passes over the text. Say that there are no ``line_breaks`` to have it read once. With
    ``whole_files`` each file is read by one task, which also copes with stray quotes inside a cell.
    """
    nested = set(nested_columns(schema))
    flat = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in nested else f.dataType) for f in schema]
    )
    found = records(spark, path) if line_breaks and not whole_files else None
    if found is None:
        cells = spark.read.csv(path, schema=flat, header=True, multiLine=line_breaks, **READ)
    else:
        layout = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in flat)
        options = {k: str(v) for k, v in {**READ, "multiLine": True, "lineSep": "\n"}.items()}
        cells = found.select(F.from_csv("record", layout, options).alias("cells")).select("cells.*")
    return with_parsed_json(cells, schema)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, nested columns as JSON text and NULL as an empty cell.

    CSV has one kind of empty cell, so an empty text is written as NULL too.
    """
    with_json_text(df).write.csv(path, header=True, nullValue="", emptyValue="", escape='"', **CELLS)


def write_complete(df: DataFrame, path: str) -> DataFrame:
    """Write Parquet to a path that must not exist yet, and return it as a table.

    Task output stays in a hidden folder until the job commits, so readers see
    either nothing or the whole result.
    """
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_evolved(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet in the target layout; columns that older files lack read as NULL."""
    return spark.read.schema(schema).parquet(path)


def append_rows(df: DataFrame, more: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing on one side is NULL there."""
    return df.unionByName(more, allowMissingColumns=True)
