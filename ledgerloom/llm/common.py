"""What several operators share: reading, words as bytes, and batches of rows."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of lower-cased UTF-8: ASCII letters and digits, and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: What stands between words, as a pattern on text.
GAP_PATTERN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes | None) -> list[bytes]:
    """Words of a text after lower-casing A-Z; none of a null."""
    return WORD.findall(text.lower()) if text else []


def utf8(column: Column) -> Column:
    """The bytes of a text, so that Python need not decode and encode it; null stays null."""
    return column.cast("string").cast("binary")


def lower_ascii(column: Column) -> Column:
    """Lower-cases A-Z alone, as the contracts have it; ``lower`` would fold other scripts too."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, most: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``most`` bytes of column ``text``, or one row, so memory stays bounded."""
    for batch in batches:
        sizes = batch.column(text).cast(pa.large_binary()) if batch.num_rows else None
        start = size = 0
        for i in range(batch.num_rows):
            n = len(sizes[i].as_buffer()) if sizes[i].is_valid else 0
            if i > start and size + n > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if batch.num_rows > start:
            yield batch.slice(start)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0
