"""Document fingerprints by consistent weighted sampling.

A text is a set of terms (its lower-cased words) weighted by their counts. For each of ``samples``
positions and each term there are two Gamma(2, 1) variables and a uniform one, all derived from a
hash of the term. They give every (term, weight) a rank; the smallest rank of a text is its sample.
Two texts agree at a position with a probability equal to the generalised Jaccard similarity of
their weights, sum of minima over sum of maxima.

Ranks depend on term and weight alone, so each distinct pair of a batch is computed once. Equal
texts have equal fingerprints. A text without terms, or null, has an empty fingerprint: two such
are alike (1), one such and another are not (0). Repeated rows are documents of their own.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLES = 64
#: (term, count) pairs whose ranks are kept at once and worked on at once, and characters of text.
PAIRS, BLOCK, BYTES = 1 << 18, 1 << 12, 4 << 20
#: Ranges of ids that documents are dealt into to find each one's next: at least so many, and more
#: where a range would hold more rows than this.
RANGES, RANGE_ROWS = 256, 250_000
#: Rows, one per range, that are broadcast; 24 MB.
MOST_SENT = 1_000_000
_SMALLEST = -(2**63)
_U = np.uint64


def _hashes(keys: np.ndarray, samples: int, salt: int) -> np.ndarray:
    step = (np.arange(samples, dtype=np.uint64) * _U(3) + _U(salt)) * _U(0x9E3779B97F4A7C15)
    h = keys[:, None] + step[None, :]
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _gamma(h: np.ndarray) -> np.ndarray:
    """Gamma(2, 1): minus the logarithm of the product of two uniform numbers, a half of h each."""
    first, second = (h >> _U(32)) + 0.5, (h & _U(0xFFFFFFFF)) + 0.5
    return 64 * np.log(2) - np.log(first * second)


def _ranks(keys: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """ln of the rank of each weighted term at each position; equal only for equal samples."""
    out = np.empty((len(keys), samples), np.float32)
    for i in range(0, len(keys), BLOCK):
        part, weight = keys[i : i + BLOCK], np.log(weights[i : i + BLOCK])[:, None]
        r = _gamma(_hashes(part, samples, 0))
        beta = (_hashes(part, samples, 1) >> _U(11)) * 2.0**-53
        t = np.floor(weight / r + beta)
        out[i : i + BLOCK] = np.log(_gamma(_hashes(part, samples, 2))) - r * (t - beta + 1)
    return out


def signatures(texts: list[str], samples: int = SAMPLES) -> np.ndarray:
    """A row of 16-bit samples for each text; zeros for one without terms."""
    keys: dict[str, int] = {}
    sizes, codes = [], []
    for text in texts:
        found = text.lower().split()
        codes.append(np.fromiter((keys.setdefault(w, len(keys)) for w in found), np.int64, len(found)))
        sizes.append(len(found))
    out = np.zeros((len(texts), samples), np.uint16)
    if not keys:
        return out
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(k, 1) for k in keys), np.uint64, len(keys))
    owner = np.repeat(np.arange(len(texts)), sizes)
    pairs, counts = np.unique(owner * len(keys) + np.concatenate(codes), return_counts=True)
    owner, term = np.divmod(pairs, len(keys))
    least = np.full((len(texts), samples), np.inf, np.float32)
    for i in range(0, len(owner), PAIRS):
        kinds, kind = np.unique(counts[i : i + PAIRS] * len(keys) + term[i : i + PAIRS], return_inverse=True)
        weight, name = np.divmod(kinds, len(keys))
        ranks = _ranks(hashed[name], weight.astype(np.float64), samples)
        for j in range(0, len(kind), BLOCK):
            of = owner[i + j : i + min(j + BLOCK, len(kind))]
            first = np.append(0, np.flatnonzero(np.diff(of)) + 1)
            some = np.minimum.reduceat(ranks[kind[j : j + BLOCK]], first, axis=0)
            least[of[first]] = np.minimum(least[of[first]], some)
    bits = least.view(np.uint32).astype(np.uint64)
    bits = (bits ^ (bits >> _U(15))) * _U(0xBF58476D1CE4E5B9)
    full = np.array(sizes) > 0
    out[full] = (bits[full] >> _U(48)).astype(np.uint16) | np.uint16(1)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples of two signatures, row by row."""
    return (a == b).mean(axis=1)


def as_text(signature: np.ndarray) -> str:
    """Hexadecimal; empty for a text without terms."""
    return signature.astype(">u2").tobytes().hex() if signature.any() else ""


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as many first code points of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(samples: int):
    """Rows come in order: a document, then its next one. A guest only closes its range."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint"]
    names += ["near_edited", "near_next"]

    def rows(held: list[tuple]) -> pa.RecordBatch:
        texts = [t for _, _, t in held]
        changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
        n = len(changed)
        # A text and its edited text share half of their terms, so they stand side by side.
        both = [t for pair in zip(texts, [*changed, ""], strict=True) for t in pair]
        found = signatures(both, samples)
        own, new = found[::2], found[1:-1:2]
        columns = [
            pa.array([i for i, _, _ in held[:n]], pa.int64()),
            pa.array([len(t) for t in texts[:n]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed]),
            pa.array([as_text(s) for s in own[:n]]),
            pa.array([as_text(s) for s in new]),
            pa.array(likeness(own[:n], new)),
            pa.array(likeness(own[:n], own[1:])),
        ]
        keep = pa.array([not g for _, g, _ in held[:n]], pa.bool_())
        return pa.RecordBatch.from_arrays(columns, names).filter(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, now = 0, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("range", "doc_id", "guest", "text"))
            for part, doc_id, guest, text in zip(*columns, strict=True):
                if held and (part != now or size > BYTES):
                    if len(held) > 1:
                        yield rows(held)
                    held = held[-1:] if part == now else []
                    size = len(held[0][2]) if held else 0
                now = part
                held.append((doc_id, guest, text or ""))
                size += len(text or "")
        if len(held) > 1:
            yield rows(held)

    return run


def _range_of(cuts: list[int]) -> Column:
    """The range of a row with the order's columns ``k`` and ``h``; it grows with (k, h).

    A cut that comes ``n`` times is an id that fills whole ranges by itself. Its rows are spread over
    ``n`` ranges by the hash of their text. Entries are looked up in blocks, by some square root of
    their number of comparisons.
    """
    if not cuts:
        return F.lit(0)
    entries, start = [], 1
    for cut, n in sorted(Counter(cuts).items()):
        slices = n if n > 1 else 0
        entries.append({"cut": cut, "start": start, "slices": slices})
        start += slices + 1
    step = math.isqrt(len(entries) - 1) + 1
    blocks = [entries[i : i + step] for i in range(0, len(entries), step)]
    k, h = F.col("k"), F.col("h")
    firsts = F.from_json(F.lit(json.dumps([b[0]["cut"] for b in blocks])), "array<bigint>")
    table = F.from_json(
        F.lit(json.dumps(blocks)), "array<array<struct<cut: bigint, start: int, slices: int>>>"
    )
    block = F.get(table, F.array_size(F.filter(firsts, lambda c: c <= k)) - 1)
    entry = F.element_at(F.filter(block, lambda e: e["cut"] <= k), -1)
    share = F.floor((h / F.lit(2.0**64) + 0.5) * entry["slices"]).cast("int")
    within = F.when(entry["cut"] < k, entry["slices"]).when(
        entry["slices"] > 0, F.greatest(F.lit(0), F.least(share, entry["slices"] - 1))
    )
    return F.coalesce(entry["start"] + F.coalesce(within, F.lit(0)), F.lit(0))


def against_next(docs: DataFrame, samples: int = SAMPLES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next one's are.

    The next document has the next smaller doc_id; after the last comes the first. A null id is the
    smallest; rows of one id stand in the order of their text's hash. Ids are dealt into ranges of
    some ``range_rows`` rows at most, each sorted by one task; the first row of a range is also sent,
    as a guest, to the one before. A missing or repeated id with more rows is split by the hash, so only
    copies of one text under one id must stay together. An empty table gives no rows; other columns
    of ``docs`` are not looked at, whatever their names.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.withColumns(
        {"k": F.coalesce("doc_id", F.lit(_SMALLEST)), "h": F.xxhash64("text")}
    )
    n = max(RANGES, math.ceil(rows.count() / range_rows))
    cuts = rows.approxQuantile("k", [i / n for i in range(1, n)], 1 / (8 * n))
    keyed = rows.withColumn("range", _range_of([int(c) for c in cuts]))
    # The largest row of each range, so a row per range reaches the driver.
    heads = keyed.groupBy("range").agg(F.max(F.struct("k", "h")).alias("o")).collect()
    heads = sorted(((r["range"], r.o.k, r.o.h) for r in heads), reverse=True)
    guests = [(heads[i - 1][0], *heads[i]) for i in range(1, len(heads))]
    guests += [(heads[-1][0], *heads[0])] if heads else []
    asked = docs.sparkSession.createDataFrame(guests, "host int, range int, k long, h long")
    # A row of 24 bytes per range: sent to every task, or joined by a shuffle beyond the bound.
    asked = F.broadcast(asked) if len(guests) <= MOST_SENT else asked
    guest = keyed.join(asked, ["range", "k", "h"]).dropDuplicates(["host"])
    both = keyed.withColumn("guest", F.lit(False)).unionByName(
        guest.drop("range").withColumnRenamed("host", "range").withColumn("guest", F.lit(True))
    )
    sorted_ = both.repartition("range").sortWithinPartitions(
        "range", F.asc("guest"), F.desc("k"), F.desc("h"), F.desc("text")
    )
    schema = """doc_id long, n_chars long, edited_sha256 string, fingerprint string,
    edited_fingerprint string, near_edited double, near_next double"""
    return sorted_.select("range", "doc_id", "guest", "text").mapInArrow(_pairs(samples), schema)
