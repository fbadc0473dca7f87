"""Merkle manifest of a table, by self-joins on sibling indices.

Each row is a leaf, the digest of its encoded columns. Leaves are numbered within their group, and
every level of a group's tree is one table: a node joins the nodes at the indices of its siblings
(index XOR 1 in a binary tree, otherwise index plus the offset of the other slots), and the node in
slot zero emits their parent. A group ends with one node; those nodes, in the order of their
groups, are the leaves of the tree above, which ends with the root.

What a level's join has found, the siblings to the left and right of a node, is kept. Going down
again, a node's path is its own siblings followed by the path of its parent, so no leaf looks for
its ancestors. A level is written to the shared folder, so that a lost executor costs one level;
levels halve, so all together hold as many nodes again as there are leaves.

Nodes are numbered without a window over a group: rows are sorted over all tasks by range, and a
row's number is its place in its task plus the group's rows in the tasks before. Rows that are
alike in the sort columns follow each other by digest, and equal ones anyhow: exchanging them
changes no digest. Nulls sort first, a null group is a group. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialise

#: Columns of a document that its leaf covers, in this order.
COVERED = ("doc_id", "source", "lang", "n_chars", "text")
#: A level of a path: the digests left and right of the node, end to end.
_STEP = "struct<left:binary,right:binary>"


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _digest(hexadecimal: Column) -> Column:
    """SHA-256, as bytes, of digests written as lower-case hex digits end to end."""
    return F.unhex(F.sha2(hexadecimal, 256))


def encoded(column: Column) -> Column:
    """A value that can't be mistaken for two: ``-`` if null, else its UTF-8 length, ``:``, itself."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[encoded(c) for c in columns]), 256))


def _bytes(digests: Sequence[Column]) -> Column:
    """Digests end to end; a sibling that isn't there adds nothing."""
    none = F.lit("").cast("binary")
    return F.concat(*[F.coalesce(d, none) for d in digests]) if digests else none


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``i``, the place from 0 in the group by ``order``, and ``n``, the group's rows.

    Also the rows of the largest group. Rows are sorted by range and written; how many rows of the
    group came in earlier tasks is then a sum over one row per group and task.
    """
    # Equal rows are told apart too, so that a value that most rows have is split over tasks.
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_tie")]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    # The upper bits number the task, the lower ones the row in it.
    placed = materialise(placed.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    placed = placed.withColumn("_task", F.shiftright("_at", 33))
    parts = placed.groupBy(group, "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    of_group = Window.partitionBy(group)
    before = of_group.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        group, "_task", "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(of_group).alias("n"),
    )
    offsets = materialise(offsets, "offsets")
    place = F.col("_before") + F.col("_at") - F.col("_first")
    out = placed.join(offsets, [group, "_task"]).withColumn("i", place)
    most = offsets.agg(F.max("n")).first()[0] or 0
    return out.drop("_at", "_task", "_first", "_before"), most


def with_siblings(nodes: DataFrame, fanout: int, name: str) -> DataFrame:
    """``nodes`` (g, i, n, digest, ...) with the ``step`` of each: its siblings left and right.

    One equijoin per other slot; the join of a binary tree is the one on ``i XOR 1``.
    """
    slot = F.col("i") % fanout
    out = nodes
    for k in range(1, fanout):
        # The k-th slot after this one, beginning anew after the last.
        other = F.col("i").bitwiseXOR(F.lit(1)) if fanout == 2 else F.col("i") - slot + (slot + k) % fanout
        out = out.withColumn(f"_at{k}", other)
        sibling = nodes.select(F.col("g"), F.col("i").alias(f"_at{k}"), F.col("digest").alias(f"_d{k}"))
        out = out.join(sibling, ["g", f"_at{k}"], "left").drop(f"_at{k}")
    # By slot: of slot s, this node knows the digest as the (s - slot) mod fanout next one.
    def at(s: int) -> Column:
        turned = (F.lit(s) - slot + fanout) % fanout
        return reduce(lambda c, k: F.when(turned == k, F.col(f"_d{k}")).otherwise(c), range(1, fanout), F.lit(None))

    left = _bytes([F.when(F.lit(s) < slot, at(s)) for s in range(fanout)])
    right = _bytes([F.when(F.lit(s) > slot, at(s)) for s in range(fanout)])
    step = F.struct(left.alias("left"), right.alias("right")).cast(_STEP)
    out = out.withColumn("step", step).drop(*[f"_d{k}" for k in range(1, fanout)])
    return materialise(out, name)


def climb(leaves: DataFrame, most: int, fanout: int, name: str) -> list[DataFrame]:
    """The levels of every group's tree, leaves first: g, i, n, digest, step, and the columns of the leaves.

    ``n`` is the number of the group's nodes on the level, ``most`` that of the largest group. A
    group whose tree ends has its last node, alone, on its last level and none above.
    """
    levels = []
    nodes = leaves
    while most > 0:
        levels.append(with_siblings(nodes, fanout, name))
        if most == 1:
            break
        whole = F.concat(_hex(F.col("step.left")), _hex(F.col("digest")), _hex(F.col("step.right")))
        # Slot zero emits the parent.
        nodes = levels[-1].where((F.col("n") > 1) & (F.col("i") % fanout == 0)).select(
            "g",
            F.expr(f"i div {fanout}").alias("i"),
            F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
            _digest(whole).alias("digest"),
        )
        most = -(-most // fanout)
    return levels


def paths(levels: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """The leaves with ``path``, the steps from the leaf to the root.

    ``above``: group ``g`` and ``path`` of its last node in the tree above, with more columns to
    hand down.
    """
    more = [c for c in above.columns if c not in ("g", "path")]
    down = None
    for level in reversed(levels):
        own = ["g", "i", *[c for c in level.columns if c not in ("g", "i", "n", "digest", "step")]]
        lasts = level.where("n = 1").join(above, "g").select(*own, "n", "digest", "path", *more)
        if down is not None:
            up = down.select("g", F.col("i").alias("_up"), F.col("path").alias("_path"), *more)
            inner = level.where("n > 1").withColumn("_up", F.expr(f"i div {fanout}")).join(up, ["g", "_up"])
            inner = inner.select(
                *own, "n", "digest", F.concat(F.array("step"), "_path").alias("path"), *more
            )
            lasts = lasts.unionByName(inner)
        down = lasts
    return down


def folded(leaf: Column, path: Column) -> Column:
    """The root, in hex, that ``leaf`` (hex) gives with the siblings of its path."""
    return F.aggregate(
        path, leaf, lambda acc, s: F.sha2(F.concat(_hex(s["left"]), acc, _hex(s["right"])), 256)
    )


def proof_digest(path: Column) -> Column:
    """SHA-256 over all siblings of a path, level by level, left to right, as hex text."""
    joined = F.aggregate(
        path, F.lit(""), lambda acc, s: F.concat(acc, _hex(s["left"]), _hex(s["right"]))
    )
    return F.sha2(joined, 256)


def manifest(leaves: DataFrame, order: Sequence[str], fanout: int = 2) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` (hex) and ``path``, the steps from leaf to root.

    ``leaves``: ``g`` (group, not null, trees ordered by it bytewise), ``digest`` and more narrow
    columns, the ones in ``order`` giving the place within the group. The names i, n, step, path,
    subroot, root and those that begin with ``_`` are taken.
    """
    rows, most = numbered(leaves, "g", [*order, "digest"])
    levels = climb(rows, most, fanout, "nodes")
    if not levels:
        return leaves.limit(0).select(
            "*", F.lit("").alias("subroot"), F.lit("").alias("root"),
            F.array().cast(f"array<{_STEP}>").alias("path"),
        )
    ends = [level.where("n = 1").select("g", "digest") for level in levels]
    ends = reduce(DataFrame.unionByName, ends).withColumnRenamed("g", "of").withColumn("g", F.lit(""))
    upper = climb(*numbered(ends, "g", ["of"]), fanout, "subroots")
    root = upper[-1].select("g", F.array().cast(f"array<{_STEP}>").alias("path"), _hex(F.col("digest")).alias("root"))
    above = paths(upper, root, fanout).select(
        F.col("of").alias("g"), "path", _hex(F.col("digest")).alias("subroot"), "root"
    )
    above = materialise(above, "subroot-paths")
    return paths(levels, above, fanout).drop("i", "n")


def verified_manifest(docs: DataFrame, fanout: int = 2, tampered_by: int = 7) -> DataFrame:
    """Leaf, subroot, root and proof of every document, and the root folded from a tampered copy.

    Documents are grouped by ``lang`` (null is a group of its own), their leaves ordered by
    ``doc_id``, nulls first, equal ids by digest. Where ``tampered_by`` divides the crc32 of the
    id as decimal text, 1 is added to ``n_chars`` before the leaf is made anew; a null stays, so
    such a row, and one with a null id, is verified. Other columns of ``docs`` are not covered
    and may have any name; repeated rows are leaves of their own.
    """
    columns = [F.col(c) for c in COVERED]
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % tampered_by == 0, F.lit(False))
    # One more than the largest bigint is no bigint.
    higher = [F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in COVERED]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("g"),
        F.col("doc_id"),
        leaf_digest(columns).alias("digest"),
        F.when(chosen & F.col("n_chars").isNotNull(), leaf_digest(higher)).alias("changed"),
    )
    # Texts are read once; from here on rows are narrow.
    leaves = materialise(leaves, "leaves")
    found = manifest(leaves, ["doc_id"], fanout)
    given = _hex(F.coalesce("changed", "digest"))
    return found.select(
        "doc_id", _hex(F.col("digest")).alias("leaf"), "subroot", "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(given, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
