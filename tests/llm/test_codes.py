"""Vector codes against a search of every entry in plain Python."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from ledgerloom.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label string, code string, error double, _label int"


def test_nearest_finds_the_lowest_of_the_nearest_entries():
    rng = np.random.default_rng(1)
    for width, spread in ((1, 3), (2, 4), (4, 30), (7, 1000), (3, 1 << 40)):
        entries = rng.integers(-spread, spread, (37, width))
        entries[5], entries[30] = entries[9], entries[2]
        parts = rng.integers(-spread, spread, (500, width))
        best, d = codes.nearest(parts, codes.codebook(entries.astype(object)))
        wide = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e, strict=True)) for e in entries] for p in parts]
        assert best.tolist() == [min(range(37), key=lambda j: (w[j], j)) for w in wide]
        assert [int(x) for x in d] == [min(w) for w in wide]


def expected(rows, parts, entries, rounds, scale=256):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(kept[0][1])

    def whole(v):
        return [n * scale // d for n, d in (x.as_integer_ratio() for x in v)]

    def cut(v):
        short, longer = divmod(length, parts)
        out, at = [], 0
        for p in range(parts):
            out.append(v[at : at + short + (p < longer)])
            at += short + (p < longer)
        return out

    alike = [cut(whole(r[1])) for r in kept if len(r[1]) == length]
    books = [[v[p] for v in alike[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            hit = [[] for _ in book]
            for v in alike:
                hit[nearest(v[p], book)[1]].append(v[p])
            books[p] = [[sum(c) // len(h) for c in zip(*h, strict=True)] if h else e for h, e in zip(hit, book, strict=True)]
    out, sums = [], {}
    for r in kept:
        code = error = None
        if len(r[1]) == length:
            found = [nearest(x, b) for x, b in zip(cut(whole(r[1])), books, strict=True)]
            code, error = "".join(f"{j:02x}" for _, j in found), min(sum(d for d, _ in found), 2**63 - 1)
            sums[r[2]] = sums.get(r[2], 0) + error
        out.append((r[0], r[2], code, error))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(*r, min(sums[r[1]], 2**63 - 1) if r[1] in sums else None) for r in out], digest


def vectors(rng, n, width, size=1.0):
    rows = [(i, [rng.gauss(0, size) for _ in range(width)], rng.choice(["a", "b", None])) for i in range(n)]
    rows += [(n, None, "a"), (n + 1, [None] + [1.0] * (width - 1), "b"), (n + 2, [math.nan] * width, None)]
    rows += [(n + 3, [math.inf] + [0.0] * (width - 1), "a"), rows[4], rows[4], (None, [0.5] * width, "c")]
    return [*rows, (n + 4, [0.25] * (width + 1), "a"), (n + 5, [], "a"), (2, [0.5] * width, "b")]


@pytest.mark.parametrize(("width", "size", "n"), [(8, 1.0, 90), (6, 1e7, 40), (4, 1e30, 30), (3, 1.0, 3)])
def test_codes(spark, width, size, n):
    rows = vectors(random.Random(width), n, width, size)
    df = spark.createDataFrame([(*r, "old", 0.0, 1) for r in rows], SCHEMA).repartition(4)
    books = codes.train(df, parts=4, entries=16, rounds=2)
    coded = codes.with_label_error(codes.encode(df, books))
    got = sorted((tuple(r) for r in coded.select("vec_id", "label", "code", "error", "label_error").collect()), key=str)
    want, digest = expected(rows, 4, 16, 2)
    assert codes.digest(books) == digest
    assert got == sorted(want, key=str)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert codes.train(df) == []
    assert codes.with_label_error(codes.encode(df, [])).collect() == []
    none = spark.createDataFrame([(1, None, "a", None, None, 1)], SCHEMA)
    assert codes.train(none) == [] and codes.encode(none, []).collect() == []
    flat = spark.createDataFrame([(1, [], "a", None, None, 1), (2, [], "a", None, None, 1)], SCHEMA)
    found = codes.encode(flat, codes.train(flat, parts=4)).select("code", "error").collect()
    assert [tuple(r) for r in found] == [("00000000", 0)] * 2
