"""Codes for vectors by product quantisation in whole numbers, the nearest entry found by Orchard's search.

A vector's components become integers and are cut into equal parts; every part position has a
codebook. Codebooks start from the vectors of the smallest ids and are moved to the means of what
they were assigned, round by round. A round is one pass over all vectors: tasks keep sums per
entry, Spark adds them up, and what reaches the driver is one row per entry and component.

Orchard's search finds the entry nearest to a part. Each entry has the list of the others sorted by
distance. From a first guess on, the list of the best entry so far is walked; a nearer entry is
jumped to and its list walked from the start; entries seen are marked; the walk ends beyond
twice the distance to the best one, since what is farther from that can't be nearer to the part.
Distances are squared, so that is four times; on a tie the lower index wins, which the walk can't
miss, because it ends only where every entry left is strictly farther. A batch of parts walks in
step.

Rows whose vector is null or holds a null, a NaN or an infinity are dropped. The vector length is
that of the first kept row by id; vectors of another length keep their row and get a null code and
error. A length that isn't a multiple of the parts makes the first parts one longer, parts of no
component match entry 0. Null ids count as largest; rows with the same id are put in order by their
vectors. With fewer vectors than entries a codebook has as many entries as there are vectors. An
empty table gives no rows. Components of any size are exact: where 64 bits don't hold the squared
distances the search works on Python integers; an error beyond 64 bits is given as the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import fresh
from ledgerloom.session import materialise

_LONGEST = (1 << 63) - 1
#: Vectors that walk in step.
BATCH = 4096
#: Bits of a limb, in which sums beyond 64 bits are added up.
_LIMB = 31


@dataclass
class Codebook:
    """Entries of one part position, and for each entry the others by distance from it."""

    entries: np.ndarray
    order: np.ndarray
    away: np.ndarray
    first: np.ndarray
    first_of: np.ndarray


def _exact(numbers: np.ndarray) -> np.ndarray:
    """64-bit integers where four times a squared distance of such rows fits, else Python integers."""
    most = max(abs(int(numbers.min())), abs(int(numbers.max()))) if numbers.size else 0
    return numbers.astype(object if 4 * numbers.shape[-1] * (2 * most) ** 2 > _LONGEST else np.int64)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances along the last axis."""
    if not a.shape[-1]:
        return np.zeros(np.broadcast_shapes(a.shape, b.shape)[:-1], np.int64)
    return ((a - b) ** 2).sum(axis=-1)


def codebook(entries: np.ndarray) -> Codebook:
    entries = _exact(entries)
    n = len(entries)
    distance = _squared(entries[:, None, :], entries[None, :, :])
    others = np.array([[j for j in range(n) if j != i] for i in range(n)], np.int64).reshape(n, n - 1)
    order = np.empty_like(others)
    for i in range(n):
        order[i] = others[i][np.argsort(distance[i][others[i]], kind="stable")]
    away = np.take_along_axis(distance, order, axis=1)
    lead = entries[:, 0] if entries.shape[1] else np.zeros(n, np.int64)
    first_of = np.argsort(lead, kind="stable")
    return Codebook(entries, order, away, lead[first_of], first_of)


def nearest(parts: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry for each row of ``parts``, the lowest on a tie, and its squared distance."""
    parts, n = _exact(parts), len(parts)
    entries = book.entries
    if parts.dtype != entries.dtype:
        parts, entries = parts.astype(object), entries.astype(object)
    # The first guess: the entry whose first component comes next to the part's.
    lead = parts[:, 0] if parts.shape[1] else np.zeros(n, np.int64)
    best = book.first_of[np.minimum(np.searchsorted(book.first, lead), len(entries) - 1)]
    d = _squared(parts, entries[best])
    seen = np.zeros((n, len(entries)), bool)
    seen[np.arange(n), best] = True
    at = np.zeros(n, np.int64)
    going = np.arange(n) if len(entries) > 1 else np.arange(0)
    while len(going):
        here, place = best[going], at[going]
        # Beyond twice the distance to the best entry there is nothing nearer.
        on = (book.away[here, place] <= 4 * d[going]).astype(bool)
        going, here, place = going[on], here[on], place[on]
        other = book.order[here, place]
        at[going] += 1
        new = ~seen[going, other]
        rows, other = going[new], other[new]
        seen[rows, other] = True
        found = _squared(parts[rows], entries[other])
        won = ((found < d[rows]) | ((found == d[rows]) & (other < best[rows]))).astype(bool)
        rows = rows[won]
        best[rows], d[rows], at[rows] = other[won], found[won], 0
        going = going[at[going] < len(entries) - 1]
    return best, d


def _integers(vectors: pa.Array, length: int, scale: int) -> np.ndarray:
    """floor(scale * x) of lists of this length, as 64-bit or Python integers."""
    values = vectors.flatten().to_numpy(zero_copy_only=False)
    whole = np.floor(values.astype(np.float64) * scale) if values.dtype.kind == "f" else values.astype(object) * scale
    if whole.dtype == object or not np.all(np.abs(whole) < 2.0**50):
        exact = (x.as_integer_ratio() for x in values.tolist())
        whole = np.array([a * scale // b for a, b in exact], object)
    else:
        whole = whole.astype(np.int64)
    return whole.reshape(len(vectors), length)


def _cuts(length: int, parts: int) -> list[slice]:
    """Where a vector is cut; the first parts are one longer if it can't be cut equally."""
    short, longer = divmod(length, parts)
    ends = np.cumsum([short + (p < longer) for p in range(parts)]).tolist()
    return [slice(a, b) for a, b in zip([0, *ends], ends, strict=False)]


def whole_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector is there and holds finite numbers alone."""
    def odd(x):
        y = x.cast("double")
        return x.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))

    return df.where(F.col(vector).isNotNull() & ~F.exists(vector, odd))


def _assign(
    batch: pa.RecordBatch, vector: str, books: list[Codebook], length: int, scale: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By slices of a batch: numbers of its rows of the right length, their integers, indexes and errors by part."""
    column = batch.column(vector)
    right = np.flatnonzero(column.value_lengths().to_numpy(zero_copy_only=False) == length)
    for start in range(0, len(right), BATCH):
        rows = right[start : start + BATCH]
        x = _integers(column.take(pa.array(rows)), length, scale)
        found = [nearest(x[:, cut], book) for cut, book in zip(_cuts(length, len(books)), books, strict=True)]
        yield rows, x, np.stack([i for i, _ in found], 1), np.stack([d for _, d in found], 1)


def _limbs(number: int, n: int) -> list[int]:
    """``n`` limbs whose sums can be added up apart; the last one has the sign."""
    mask = (1 << _LIMB) - 1
    return [(number >> (_LIMB * i)) & mask for i in range(n - 1)] + [number >> (_LIMB * (n - 1))]


def _moved(df: DataFrame, vector: str, entries: list[np.ndarray], length: int, scale: int, limbs: int) -> list[np.ndarray]:
    """The codebooks after one round: each entry is the floored mean of the parts assigned to it."""
    parts, n = len(entries), len(entries[0])
    shared = df.sparkSession.sparkContext.broadcast([codebook(e) for e in entries])
    cuts = _cuts(length, parts)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            for _, x, index, _ in _assign(batch, vector, shared.value, length, scale):
                for p, cut in enumerate(cuts):
                    for e in np.unique(index[:, p]).tolist():
                        hit = index[:, p] == e
                        own = total.setdefault((p, e), [0, [0] * (cut.stop - cut.start)])
                        own[0] += int(hit.sum())
                        own[1] = [a + int(b) for a, b in zip(own[1], x[hit][:, cut].sum(axis=0), strict=True)]
        rows = [(p, e, j, c, _limbs(s, limbs)) for (p, e), (c, own) in total.items() for j, s in enumerate(own)]
        columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
        columns += [pa.array([r[4][k] for r in rows], pa.int64()) for k in range(limbs)]
        yield pa.RecordBatch.from_arrays(columns, names)

    names = ["part", "entry", "place", "n", *[f"s{k}" for k in range(limbs)]]
    found = df.select(vector).mapInArrow(sums, ", ".join(f"{c} long" for c in names))
    found = found.groupBy("part", "entry", "place").agg(*[F.sum(c).alias(c) for c in names[3:]])
    out = [np.array(e, object) for e in entries]
    for r in found.collect():  # entries times components of a vector, at most
        total = sum(r[f"s{k}"] << (_LIMB * k) for k in range(limbs))
        out[r.part][r.entry, r.place] = total // r.n
    return out


def train(
    df: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256,
    vector: str = "embedding", key: str = "vec_id",
) -> list[np.ndarray]:
    """Codebooks (entry x component, Python integers) of the kept vectors; none if there is no vector."""
    kept = whole_vectors(df, vector).select(key, vector)
    start = kept.orderBy(F.col(key).asc_nulls_last(), F.col(vector).asc())
    first = start.limit(1).collect()
    if not first:
        return []
    length = len(first[0][1])
    alike = kept.where(F.size(vector) == length)
    start = alike.orderBy(F.col(key).asc_nulls_last(), F.col(vector).asc()).limit(entries)
    ratios = [[v.as_integer_ratio() for v in r[1]] for r in start.collect()]
    x = np.array([[a * scale // b for a, b in r] for r in ratios], object).reshape(len(ratios), length)
    books = [x[:, cut] for cut in _cuts(length, parts)]
    size = alike.agg(F.max(F.array_max(F.transform(vector, lambda v: F.abs(v.cast("double"))))), F.count(F.lit(1))).first()
    bits = (int(size[0] or 0) * scale + scale).bit_length() + int(size[1]).bit_length() + 1
    # One number per sum unless sums of so large components could leave 64 bits.
    limbs = 1 if bits < 63 else -(-bits // _LIMB) + 1
    for _ in range(rounds):
        books = _moved(alike, vector, books, length, scale, limbs)
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()


def encode(
    df: DataFrame, books: list[np.ndarray], scale: int = 256, vector: str = "embedding",
    code: str = "code", error: str = "error",
) -> DataFrame:
    """The rows of ``df`` with a whole vector, with ``code`` (two hex digits per part) and ``error``.

    Columns of those names are replaced.
    """
    kept = whole_vectors(df, vector).drop(code, error)
    if not books:
        return kept.withColumns({code: F.lit(None).cast("string"), error: F.lit(None).cast("long")})
    schema = T.StructType([*kept.schema, T.StructField(code, T.StringType()), T.StructField(error, T.LongType())])
    length = sum(b.shape[1] for b in books)
    shared = df.sparkSession.sparkContext.broadcast([codebook(b) for b in books])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes: list[str | None] = [None] * batch.num_rows
            errors: list[int | None] = [None] * batch.num_rows
            for rows, _, index, distance in _assign(batch, vector, shared.value, length, scale):
                written = index.astype(np.uint8)
                for row, own, d in zip(rows.tolist(), written, distance.sum(axis=1).tolist(), strict=True):
                    codes[row], errors[row] = own.tobytes().hex(), min(int(d), _LONGEST)
            columns = [*batch.columns, pa.array(codes, pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, code, error])

    return kept.mapInArrow(run, schema)


def with_label_error(coded: DataFrame, label: str = "label", error: str = "error", total: str = "label_error") -> DataFrame:
    """``coded`` with the errors of all rows of the same label added up; null is a label.

    One row per label is joined back, so Spark can split a label that most rows have. ``coded`` is
    written once, since it is read twice. A label without any error gets a null.
    """
    coded = materialise(coded.drop(total), "codes")
    (own,) = fresh(coded, "_label")
    most = F.lit(_LONGEST).cast("decimal(38,0)")
    summed = F.sum(F.col(error).cast("decimal(20,0)"))
    sums = coded.groupBy(F.col(label).alias(own)).agg(
        F.when(summed > most, most).otherwise(summed).cast("long").alias(total)
    )
    return coded.join(sums, coded[label].eqNullSafe(sums[own])).drop(own)
