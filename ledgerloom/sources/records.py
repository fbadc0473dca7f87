"""Records of CSV files whose cells hold line breaks, cut by many tasks per file.

Whether a line begins a record depends on the number of quotes before it in the file, as a line break
inside a cell follows an odd number of them. Three passes over the text, none of which shuffles it:

1. Lines with an odd number of quotes are counted per split of a file.
2. A running sum over the splits of a file, one row each, tells the parity at the start of each split, and
   which split holds the beginning of a record that crosses its start.
3. Each task cuts the records that lie within its splits. Pieces of records that cross splits, two a split at
   most, are read by a pass of their own and put together by the split where the record begins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Splits known to every task, 24 bytes each; 512 TB of text in splits of 128 MB.
MOST_SPLITS = 4_000_000


class UnknownSplit(RuntimeError):
    """The files were split differently when their quotes were counted."""


def _split() -> Column:
    return F.xxhash64("_metadata.file_path", "_metadata.file_block_start")


def records(spark: SparkSession, path: str, header: bool = True) -> DataFrame | None:
    """One row per record (``record``), of all files at ``path``, without each file's header.

    A record ends at a line feed outside quotes, and a carriage return before it is cut off; empty records are
    left out. A quote inside a cell is doubled, and only quoted cells hold quotes, as the standard says; a
    cell that is never closed reaches to the end of its file. None is returned beyond ``MOST_SPLITS`` splits.
    """
    lines = spark.read.text(path, lineSep="\n")
    splits = _splits(lines)
    known = splits.limit(MOST_SPLITS + 1).collect()  # checked, 24 bytes a split
    if len(known) > MOST_SPLITS or len({r.split for r in known}) < len(known):
        return None
    known.sort(key=lambda r: r.split)
    table = spark.sparkContext.broadcast(
        (np.array([r.split for r in known], "int64"), np.array([r.odd for r in known], "int8"),
         np.array([r.owner or 0 for r in known], "int64"))
    )
    text = lines.select(
        F.col("value").cast("binary").alias("line"), _split().alias("split"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    whole = text.mapInArrow(_cutter(table, header, False), "owner long, start long, first boolean, piece binary")
    found = whole.select(F.col("piece").cast("string").alias("record"))
    if not any(r.odd for r in known):
        return found
    pieces = text.mapInArrow(_cutter(table, header, True), "owner long, start long, first boolean, piece binary")
    ordered = F.array_sort(F.collect_list(F.struct("start", F.col("piece").cast("string").alias("text"))))
    crossing = (
        pieces.groupBy("owner")
        .agg(F.bool_or("first").alias("first"), F.array_join(ordered["text"], "\n").alias("record"))
        .where(~(F.col("first") & F.lit(header)))
        .select(F.regexp_replace("record", r"\r\z", "").alias("record"))
    )
    return found.unionAll(crossing)


def _splits(lines: DataFrame) -> DataFrame:
    """(split, odd, owner): parity of quotes before the split, and the split where the record open there began."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = (
        lines.select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
            _split().alias("split"), (quotes % 2).cast("bigint").alias("odd_line"),
        )
        .groupBy("file", "start", "split")
        .agg(F.sum("odd_line").alias("n_odd"))
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("n_odd").over(before), F.lit(0)) % 2
    with_parity = counted.withColumn("odd", odd.cast("int"))
    # The last record that begins in a split is open at its end: it began after the last odd line but one.
    opens = (F.col("n_odd") > 0) & ((F.col("odd") + F.col("n_odd")) % 2 == 1)
    owner = F.last(F.when(opens, F.col("split")), ignorenulls=True).over(before)
    return with_parity.select("split", "odd", owner.alias("owner"))


def _cutter(table, header: bool, crossing: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts the lines of each split: into whole records, or with ``crossing`` into the pieces at its ends."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits, odds, owners = table.value
        now = None  # split whose lines are read; rows of a split follow each other
        inside = first = False
        owner = 0
        held: list[bytes] = []
        out: list[tuple[int, int, bool, bytes]] = []

        def close(start: int, ends: bool) -> None:
            """The record or piece in ``held`` is over, by its last line or by the end of the split."""
            whole = ends and owner == now
            if whole and not crossing and not (first and header):
                record = b"\n".join(held).removesuffix(b"\r")
                if record:
                    out.append((now, start, first, record))
            elif not whole and crossing:
                out.append((owner, start, first, b"\n".join(held)))
            held.clear()

        start_now = 0
        for batch in batches:
            line, split, start = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            odd = pc.count_substring(line, b'"').to_numpy() % 2 == 1
            edges = np.flatnonzero(split[1:] != split[:-1]) + 1
            for low, high in zip([0, *edges], [*edges, len(split)]):
                if high == low:
                    continue
                if split[low] != now:
                    if held:
                        close(start_now, False)
                    at = int(np.searchsorted(splits, split[low]))
                    if at == len(splits) or splits[at] != split[low]:
                        raise UnknownSplit("files or splits changed between two passes; read them again")
                    now, start_now = int(split[low]), int(start[low])
                    inside = bool(odds[at])
                    owner = int(owners[at]) if inside else now
                    first = start_now == 0
                texts = line.slice(low, high - low).to_pylist()
                for text, flips in zip(texts, odd[low:high].tolist()):
                    held.append(text)
                    inside ^= flips
                    if not inside:
                        close(start_now, True)
                        owner, first = now, False
            if out:
                yield _batch(out)
                out.clear()
        if held:
            close(start_now, False)
        if out:
            yield _batch(out)

    return cut


def _batch(rows: list[tuple[int, int, bool, bytes]]) -> pa.RecordBatch:
    kinds = {"owner": pa.int64(), "start": pa.int64(), "first": pa.bool_(), "piece": pa.binary()}
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds.values())]
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))
