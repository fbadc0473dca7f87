"""Manifest against a tree built in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from ledgerloom.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, i int, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(nodes, fanout):
    """Root, and for each leaf the siblings level by level as (left, right)."""
    paths = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for p, j in enumerate(at):
            run = j // fanout * fanout
            paths[p].append(("".join(nodes[run:j]), "".join(nodes[j + 1 : run + fanout])))
        nodes = [sha("".join(nodes[j : j + fanout])) for j in range(0, len(nodes), fanout)]
        at = [j // fanout for j in at]
    return nodes[0], paths


def expected(rows, fanout):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    subroots, lower, out = [], {}, []
    for lang in order:
        own = [(r, leaf(r[0], r[3], r[2], r[4], r[1])) for r in groups[lang]]
        own.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        root, paths = tree([h for _, h in own], fanout)
        subroots.append(root)
        lower[lang] = (own, paths)
    root, upper = tree(subroots, fanout)
    for k, lang in enumerate(order):
        for (r, h), path in zip(*lower[lang], strict=True):
            steps = path + upper[k]
            acc = h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                acc = leaf(r[0], r[3], r[2], r[4] + 1, r[1])
            for left, right in steps:
                acc = sha(left + acc + right)
            out.append((r[0], h, subroots[k], root, sha("".join(a + b for a, b in steps)), acc, acc == root))
    return out


def rows():
    out = [(i, f"text {i} é", ("en", "de", "fr", None, "z:")[i % 5 if i % 3 else 0], f"s{i % 4}", i) for i in range(53)]
    out += [(5, None, None, None, None), (7, "", "", "", 0), (None, "x", "en", None, 1), (None, None, None, None, None)]
    return [*out, out[3], out[3], (14, "y" * 100_000, "alone", "s", 2**63 - 1)]


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest(spark, fanout):
    given = rows()
    docs = spark.createDataFrame([(*r, "g", 1, "d") for r in given], SCHEMA).repartition(4)
    got = [tuple(r) for r in manifest.verified_manifest(docs, fanout).collect()]
    assert sorted(got, key=str) == sorted(expected(given, fanout), key=str)
    assert {r[-1] for r in got} == {True, False}


def test_few_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert manifest.verified_manifest(docs).collect() == []
    one = [(3, "a", "en", "s", 1)]
    docs = spark.createDataFrame([(*one[0], "g", 1, "d")], SCHEMA)
    assert [tuple(r) for r in manifest.verified_manifest(docs).collect()] == expected(one, 2)


def test_equal_rows_are_dealt_to_several_tasks(spark):
    df = spark.range(0, 4000, 1, 4).selectExpr("'' AS g", "1 AS k")
    found, most = manifest.numbered(df, "g", ["k"])
    assert most == 4000
    assert sorted(r.i for r in found.collect()) == list(range(4000))
