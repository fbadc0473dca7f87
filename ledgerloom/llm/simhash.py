"""SimHash near-duplicates by a self-join of binary tries.

A fingerprint is the bitwise majority of the hashes of a text's word shingles. All fingerprints
make up a binary trie; the join starts with the pair (root, root), goes down both nodes of a pair
together, adds up the bits in which they differ and drops a pair once there are more than allowed.
The upper levels are a join of node tables. Node pairs that are small enough are work units, each
finished by one task on the fingerprints below both nodes; larger ones go down further first, so a
crowded part of the trie never lands in one task. A unit returns the edges of a spanning forest
of its links, so a group of copies never becomes all its pairs.

Exact copies have one fingerprint and enter the join once. Texts without words, and nulls, have
the fingerprint zero and are linked like any other. Repeated rows are documents of their own; a
null id counts as no id when the smallest of a component is chosen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import chunks, empty, fresh, utf8
from ledgerloom.llm.graph import components
from ledgerloom.session import materialise

#: Fingerprints below a node of the level at which the task-side join starts, on average; and the
#: least such level, so that a small input too gives work units for every core.
CELL, LEAST_DEPTH = 1 << 14, 4
#: Product of both sides, and size of one, above which a node pair goes down further before a task
#: takes it: the one bounds a task's work, the other its memory.
UNIT_PAIRS, UNIT_SIDE = 1 << 31, 1 << 20
#: Levels that such a pair goes down at once.
STEP = 4
#: Node pairs that a task keeps at a time.
FRONTIER = 1 << 18


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """64 bits: 1 where more than half of the shingles' hashes, repeats included, have a 1."""
    found = text.lower().split() if text else []
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(found))
    spans = list(zip(starts[: len(found) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True))
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(spans), 1 << 14):
        part = spans[i : i + (1 << 14)]
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in part), np.uint64, len(part))
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64
        )
    return int.from_bytes(np.packbits(2 * ones > len(spans)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; ``fp`` holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            fps = [fingerprint(t, shingle, seed) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(fps, np.uint64).view(np.int64))],
                ["doc_id", "text_hash", "fp"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        utf8(F.col("text")).alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def _prefix(depth: int, column: str = "fp") -> Column:
    return F.shiftrightunsigned(F.col(column), 64 - depth) if depth else F.lit(0).cast("long")


def _node_pairs(fps: DataFrame, n: int, most: int) -> Iterator[tuple[int, DataFrame]]:
    """Work units (p, q) by depth: pairs of trie nodes, p <= q, differing in at most ``most`` bits."""
    depth = min(64 - STEP, max(LEAST_DEPTH, (n // CELL).bit_length()))

    def nodes(depth: int) -> DataFrame:
        return fps.groupBy(_prefix(depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))

    # Each bit mask with at most ``most`` bits leads from a node to one it is compared with.
    masks = [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(depth), k)]
    top = nodes(depth)
    p = top.select(F.col("node").alias("p"), F.col("n").alias("np"))
    q = top.select(F.col("node").alias("q"), F.col("n").alias("nq"))
    pairs = (
        p.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
        .withColumn("q", F.col("p").bitwiseXOR(F.col("mask")))
        .where("p <= q")
        .join(q, "q")
        .select("p", "q", "np", "nq", F.bit_count("mask").alias("err"))
    )
    while True:
        pairs = materialise(pairs, "nodes")
        heavy = F.col("np").cast("double") * F.col("nq") > UNIT_PAIRS
        heavy = heavy | (F.greatest("np", "nq") > UNIT_SIDE)
        yield depth, pairs.where(~heavy | F.lit(depth >= 64)).select("p", "q")
        if depth >= 64 or empty(pairs.where(heavy)):
            return
        step = min(STEP, 64 - depth)
        depth += step
        below = nodes(depth).withColumn("up", F.shiftrightunsigned("node", step))
        p = below.select(F.col("up").alias("p"), F.col("node").alias("p2"), F.col("n").alias("np"))
        q = below.select(F.col("up").alias("q"), F.col("node").alias("q2"), F.col("n").alias("nq"))
        pairs = (
            pairs.where(heavy)
            .select("p", "q")
            .join(p, "p")
            .join(q, "q")
            .where("p2 <= q2")
            .withColumn("err", F.bit_count(F.col("p2").bitwiseXOR(F.col("q2"))))
            .where(F.col("err") <= most)
            .select(F.col("p2").alias("p"), F.col("q2").alias("q"), "np", "nq", "err")
        )


class _Forest:
    """Union-find over positions, by arrays."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            self.roots()
            i, j = self.parent[i], self.parent[j]
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(self.parent, np.maximum(i, j), np.minimum(i, j))


def join_tries(a: np.ndarray, b: np.ndarray | None, depth: int, most: int) -> Iterator[tuple]:
    """Positions (i, j) with at most ``most`` differing bits, of sorted distinct fingerprints.

    All of ``a`` share their first ``depth`` bits, and so do all of ``b``; None: ``a`` with itself,
    each pair once. A node is a range of positions. Both nodes of a pair are split by the next
    bit; the four pairs of their halves go on unless they differ in too many bits.
    """
    same, b = b is None, a if b is None else b
    err = int(np.bitwise_count(a[0] ^ b[0] if not depth else (a[0] ^ b[0]) >> np.uint64(64 - depth)))
    err = err if depth else 0
    stack = [(depth, np.array([[0, len(a), 0, len(b), err]], np.int32))]
    ones: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    while stack:
        level, pairs = stack.pop()
        single = (pairs[:, 1] - pairs[:, 0] == 1) & (pairs[:, 3] - pairs[:, 2] == 1)
        if single.any():
            i, j = pairs[single, 0], pairs[single, 2]
            near = np.bitwise_count(a[i] ^ b[j]) <= most
            if same:
                near &= i != j
            yield i[near], j[near]
            pairs = pairs[~single]
        if not len(pairs) or level == 64:
            continue
        if len(pairs) > FRONTIER:
            stack += [(level, part) for part in np.array_split(pairs, -(-len(pairs) // FRONTIER))]
            continue
        if level not in ones:
            bit = np.uint64(63 - level)
            ones[level] = tuple(
                np.concatenate([[0], np.cumsum((x >> bit) & np.uint64(1))]).astype(np.int32)
                for x in ((a,) if same else (a, b))
            )
        up, right = ones[level][0], ones[level][-1]
        lo1, hi1, lo2, hi2, err = pairs.T
        mid1, mid2 = hi1 - (up[hi1] - up[lo1]), hi2 - (right[hi2] - right[lo2])
        mirrored = (lo1 == lo2) if same else np.zeros(len(pairs), bool)
        children = [
            np.stack(x, axis=1)
            for x in (
                (lo1, mid1, lo2, mid2, err),
                (mid1, hi1, mid2, hi2, err),
                (lo1, mid1, mid2, hi2, err + 1),
                (np.where(mirrored, hi1, mid1), hi1, lo2, mid2, err + 1),
            )
        ]
        children = np.concatenate(children)
        alive = (children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3])
        stack.append((level + 1, children[alive & (children[:, 4] <= most)]))


def _unit(depth: int, most: int) -> Callable[[pa.Table], pa.Table]:
    """Spanning forest of the links between the fingerprints of both sides of a node pair."""

    def unit(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        fp = group.column("fp").to_numpy().view(np.uint64)
        a, b = np.sort(fp[side == 0]), np.sort(fp[side == 1])
        both = np.concatenate([a, b])
        forest = _Forest(len(both))
        for i, j in join_tries(a, b if len(b) else None, depth, most):
            forest.link(i, j + len(a) if len(b) else j)
        root = forest.roots()
        tied = np.flatnonzero(root != np.arange(len(both)))
        return pa.table({
            "a": both[tied].view(np.int64), "b": both[root[tied]].view(np.int64)
        })

    return unit


def near_links(fps: DataFrame, most: int = 2) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``most`` bits of each other.

    ``fps``: distinct values in column ``fp``. Every pair within the distance is found; returned
    is a spanning forest of them per work unit, so linked values stay linked.
    """
    n = fps.count()
    result = None
    for depth, units in _node_pairs(fps, n, most):

        keyed = fps.select("fp", _prefix(depth).alias("node"))
        left = keyed.join(units.withColumn("node", F.col("p")), "node")
        right = keyed.join(units.where("p < q").withColumn("node", F.col("q")), "node")
        rows = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
        found = rows.select("p", "q", "side", "fp").groupBy("p", "q").applyInArrow(_unit(depth, most), "a long, b long")
        result = found if result is None else result.unionByName(found)
    return result


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row.

    ``root`` names the component, ``component_id`` is the smallest doc_id in it.
    """
    prints = materialise(fingerprints(docs, shingle, seed), "fingerprints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    tree = components(near_links(distinct.select("fp"), most))
    # Only linked fingerprints have a root; the smallest id is taken over all below a root.
    labelled = distinct.join(tree.withColumnRenamed("node", "fp"), "fp", "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "fp"))
    smallest = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = labelled.join(smallest, "root").select("fp", "root", "component_id")
    return prints.join(by_fp, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 2) -> DataFrame:
    """One row of each component stays: the one with the smallest id, then the smallest hash."""
    found = near_duplicates(docs, shingle, most)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    best = found.groupBy("root").agg(first.alias("best"))
    best = best.select(F.col("best.doc_id").alias("_id"), F.col("best.text_hash").alias("_hash"))
    (own,) = fresh(docs, "own_hash")
    keyed = docs.withColumn(own, F.xxhash64(F.col("text").cast("string")))
    same = keyed["doc_id"].cast("long").eqNullSafe(best["_id"]) & (keyed[own] == best["_hash"])
    return keyed.join(best, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
