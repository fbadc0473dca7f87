"""Benchmark decontamination by a positional inverted index over the training documents.

The index is a table of postings: one row per segment and term with the sorted positions of
the term in the segment. A segment is a run of whole documents of one input partition, about
four million words; positions count on through a segment, with a gap between documents that no
match can bridge. A search reads only the lists of test terms, and intersects, per window of
test words, the lists shifted by the word's offset, rarest term of the corpus first.

Nulls and texts without words have no words and are never hit; a repeated row is a document of
its own; an empty table gives an empty result. Test items without words have no windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import chunks, fresh, utf8, words
from ledgerloom.session import materialise

#: Words after which a segment is closed; a longer document has a segment of its own.
SEGMENT_WORDS = 1 << 22
#: Positions left free between two documents: more than any window and its slop.
GAP = 256
#: Test words that one pass over the lists takes at most; more are searched in blocks.
BLOCK_WORDS = 1 << 20
MAX_SLOP = 16

INDEX_SCHEMA = "segment long, term binary, n long, postings binary, ids array<long>, hashes array<long>"
MATCH_SCHEMA = "segment long, ordinal int, item_id long, start int, end int, exact boolean"


class _Segment:
    """Codes of the words of some documents, and where each document starts."""

    def __init__(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.starts: list[int] = []
        self.sizes: list[int] = []
        self.ids: list[int | None] = []
        self.hashes: list[int] = []
        self.next = 0

    def add(self, doc_id: int | None, text_hash: int, text: bytes | None) -> None:
        codes, found = self.codes, words(text)
        self.parts.append(
            np.fromiter((codes.setdefault(w, len(codes)) for w in found), np.int32, len(found))
        )
        self.ids.append(doc_id)
        self.hashes.append(text_hash)
        self.starts.append(self.next)
        self.sizes.append(len(found))
        self.next += len(found) + GAP

    def rows(self, segment: int) -> pa.RecordBatch:
        """The row of the documents, under the empty term, and a row for each term.

        Positions are stored as differences to the one before, which compress well.
        """
        starts, sizes = np.array(self.starts, np.int32), np.array(self.sizes, np.int32)
        position = np.arange(sizes.sum(dtype=np.int64), dtype=np.int32) + np.repeat(
            np.arange(len(sizes), dtype=np.int32) * GAP, sizes
        )
        code = np.concatenate(self.parts)
        order = np.argsort(code, kind="stable")
        counts = np.bincount(code, minlength=len(self.codes))
        first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        position = position[order]
        step = np.diff(position, prepend=np.int32(0)).astype(np.int32)
        step[first[:-1]] = position[first[:-1]]
        documents = np.stack([starts, sizes]).tobytes()
        offsets = np.concatenate([[0], first * 4 + len(documents)]).astype(np.int64)
        postings = pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1,
            [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(documents + step.tobytes())],
        ).cast(pa.binary())
        n = len(postings)
        lists = [
            pa.array([x] + [None] * (n - 1), pa.list_(pa.int64())) for x in (self.ids, self.hashes)
        ]
        terms = pa.array([b"", *self.codes], pa.binary())
        ns = pa.array(np.concatenate([[len(self.ids)], counts]).astype(np.int64))
        names = ["segment", "term", "n", "postings", "ids", "hashes"]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, segment, np.int64)), terms, ns, postings, *lists], names
        )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, segment = TaskContext.get().partitionId() << 32, _Segment()
    for batch in chunks(batches, "text"):
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            segment.add(*row)
            if segment.next >= SEGMENT_WORDS:
                yield segment.rows(number)
                number, segment = number + 1, _Segment()
    if segment.ids:
        yield segment.rows(number)


def build_index(docs: DataFrame) -> DataFrame:
    """The postings of all words of ``text``, written once; searches read the lists they need."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), utf8(text).alias("text")
    )
    return materialise(rows.mapInArrow(_segments, INDEX_SCHEMA), "postings")


def documents(index: DataFrame) -> DataFrame:
    """(segment, ordinal, doc_id, text_hash, n_words) of every indexed document."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for segment, postings, ids, hashes in rows:
                sizes = np.frombuffer(postings, np.int32)[len(ids) :]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment] * len(ids), pa.int64()),
                        pa.array(np.arange(len(ids), dtype=np.int32)),
                        pa.array(ids, pa.int64()),
                        pa.array(hashes, pa.int64()),
                        pa.array(sizes.astype(np.int64)),
                    ],
                    ["segment", "ordinal", "doc_id", "text_hash", "n_words"],
                )

    maps = index.where(F.col("term") == F.lit(b"")).select("segment", "postings", "ids", "hashes")
    schema = "segment long, ordinal int, doc_id long, text_hash long, n_words long"
    return maps.mapInArrow(unpack, schema)


def _windows(items: list[tuple[int, list[bytes]]], df: dict[bytes, int], width: int) -> list[tuple]:
    """Each distinct window with its items and its offsets, the corpus's rarest term first."""
    owners: dict[tuple[bytes, ...], set[int]] = {}
    for item, found in items:
        for i in range(max(1, len(found) - width + 1)):
            owners.setdefault(tuple(found[i : i + width]), set()).add(item)
    return [
        (terms, sorted(owner), sorted(range(len(terms)), key=lambda j: (df[terms[j]], j)))
        for terms, owner in owners.items()
        if all(t in df for t in terms)
    ]


def _intersect(lists: dict[bytes, np.ndarray], window: tuple, slop: int) -> np.ndarray:
    """Starts of the window: each term stands within ``slop`` words of its place."""
    terms, _, order = window
    starts = None
    for j in order:
        found = lists.get(terms[j])
        if found is None:
            return np.zeros(0, np.int64)
        if starts is None:
            starts = found - j
        else:
            low = np.searchsorted(found, starts + (j - slop))
            high = np.searchsorted(found, starts + (j + slop), "right") if slop else None
            if slop:
                starts = starts[high > low]
            else:
                starts = starts[found[np.minimum(low, len(found) - 1)] == starts + j]
        if not len(starts):
            break
    return starts


def _searcher(plan: Broadcast, slop: int) -> Callable[[pa.Table], pa.Table]:
    """Finds the windows of a plan in the lists of one segment."""

    def search(group: pa.Table) -> pa.Table:
        segment = group.column("segment")[0].as_py()
        raw = dict(
            zip(group.column("term").to_pylist(), group.column("postings").to_pylist(), strict=True)
        )
        starts = np.frombuffer(raw.pop(b""), np.int32).reshape(2, -1)[0].astype(np.int64)
        lists = {t: np.cumsum(np.frombuffer(p, np.int32), dtype=np.int64) for t, p in raw.items()}
        by_item: dict[tuple[int, bool], list[tuple[np.ndarray, int]]] = {}
        for window in plan.value:
            for near in (0, slop) if slop else (0,):
                at = _intersect(lists, window, near)
                for item in window[1] if len(at) else ():
                    by_item.setdefault((item, near == 0), []).append((at, len(window[0])))
        columns: list[list] = [[], [], [], [], []]
        for (item, exact), found in by_item.items():
            start = np.concatenate([a for a, _ in found])
            end = np.concatenate([a + n for a, n in found])
            order = np.lexsort((end, start))
            start, reach = start[order], np.maximum.accumulate(end[order])
            new = np.concatenate([[True], start[1:] > reach[:-1]])
            first = np.flatnonzero(new)
            start, end = start[first], reach[np.append(first[1:], len(new)) - 1]
            doc = np.searchsorted(starts, start + MAX_SLOP, "right") - 1 if not exact else (
                np.searchsorted(starts, start, "right") - 1
            )
            columns[0].append(doc)
            columns[1].append(np.full(len(doc), item, np.int64))
            columns[2].append(start - starts[doc])
            columns[3].append(end - starts[doc])
            columns[4].append(np.full(len(doc), exact))
        kinds = (np.int32, np.int64, np.int32, np.int32, bool)
        arrays = [
            np.concatenate(c).astype(k) if c else np.zeros(0, k)
            for c, k in zip(columns, kinds, strict=True)
        ]
        arrays.insert(0, np.full(len(arrays[0]), segment, np.int64))
        names = ["segment", "ordinal", "item_id", "start", "end", "exact"]
        return pa.table(dict(zip(names, arrays, strict=True)))

    return search


def find_matches(index: DataFrame, tests: DataFrame, width: int = 13, slop: int = 0) -> DataFrame:
    """Places where test windows occur in the indexed documents.

    ``tests``: (item_id, text). A window is ``width`` consecutive words of an item, or all words
    of a shorter one. Returns MATCH_SCHEMA: word ranges of a document covered by occurrences of
    the windows of an item, touching ones joined. With ``slop`` over 0 there are rows that are not
    ``exact`` too: ranges of windows whose terms each stand at most ``slop`` words off the place
    that the window's rarest term gives them.

    Test words reach the tasks in blocks of bounded size, however many there are.
    """
    if not 0 <= slop <= MAX_SLOP or width + MAX_SLOP >= GAP:
        raise ValueError(f"slop is 0 to {MAX_SLOP}, a width less than {GAP - MAX_SLOP}")
    spark = index.sparkSession
    postings = index.where(F.col("term") != F.lit(b""))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.binary()))], ["item_id", "words"]
            )

    items = tests.select(F.col("item_id").cast("long"), utf8(F.col("text")).alias("text"))
    items = items.mapInArrow(split, "item_id long, words array<binary>")
    items = materialise(items.where((F.size("words") > 0) & F.col("item_id").isNotNull()), "items")
    n_words = items.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-n_words // BLOCK_WORDS)
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))))
    result = spark.createDataFrame([], MATCH_SCHEMA)
    for block in range(blocks):
        part = items.where(F.col("block") == block)
        terms = part.select(F.explode("words").alias("term")).distinct()
        wanted = postings.join(terms, "term", "left_semi")
        df = {bytes(r.term): r.n for r in wanted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        found = [(r.item_id, [bytes(w) for w in r.words]) for r in part.collect()]
        plan = spark.sparkContext.broadcast(_windows(found, df, width))
        maps = index.where(F.col("term") == F.lit(b""))
        lists = wanted.unionByName(maps).select("segment", "term", "postings")

        result = result.unionByName(lists.groupBy("segment").applyInArrow(_searcher(plan, slop), MATCH_SCHEMA))
    return result


def contamination(index: DataFrame, tests: DataFrame, width: int = 13, share: int = 20) -> DataFrame:
    """One row per indexed document: its words, those hit, and the items that hit it.

    ``contaminated``: at least one word in ``share`` is hit. The ids of items are listed in the
    order of their text.
    """
    spans = find_matches(index, tests, width).where("exact")
    covered = F.aggregate(
        F.sort_array(F.collect_set(F.struct("start", "end"))),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["reach"]), F.lit(0))).alias("n"),
            F.greatest(a["reach"], s["end"]).alias("reach"),
        ),
    )["n"]
    hits = spans.groupBy("segment", "ordinal").agg(
        covered.cast("long").alias("n_hit"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return (
        documents(index)
        .join(hits, ["segment", "ordinal"], "left")
        .select(
            "segment", "ordinal", "doc_id", "text_hash", "n_words",
            n_hit.alias("n_hit"),
            F.size(items).cast("long").alias("n_items"),
            F.concat_ws(",", items).alias("items"),
            ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
        )
    )


def decontaminate(docs: DataFrame, tests: DataFrame, width: int = 13, share: int = 20) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated."""
    found = contamination(build_index(docs), tests, width, share).where("contaminated")
    bad = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    (own,) = fresh(docs, "own_hash")
    keyed = docs.withColumn(own, F.xxhash64(F.col("text").cast("string")))
    same = keyed["doc_id"].cast("long").eqNullSafe(bad["_id"]) & (keyed[own] == bad["_hash"])
    return keyed.join(bad, same, "left_anti").drop(own)
