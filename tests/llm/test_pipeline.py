"""The pipeline's stages, one by one, against brute force on a given table."""

from __future__ import annotations

import os
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parents[2]), str(Path(__file__).parent)]
import corpus_pipeline  # noqa: E402
import test_operators as brute  # noqa: E402

from ledgerloom.llm import mixing, secrets  # noqa: E402
from ledgerloom.llm.queries import MIX_SEED, WEIGHTS  # noqa: E402
from ledgerloom.session import materialise  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = [(10**6, None, "en", "src0", 0), (10**6 + 1, "...", "en", "src1", 3), (None, "?", None, None, None)]
    docs = materialise(docs.unionByName(spark.createDataFrame(odd, docs.schema)), "docs")
    columns = docs.columns
    tests = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    states = [[tuple(r) for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_DIR), name)
        states.append([tuple(r) for r in docs.collect()])
        assert docs.columns == columns or name == names[-1]
    start, known, single, clean, redacted, mixed = states

    assert {r[0] for r in start} - {r[0] for r in known} == {10**6, 10**6 + 1, None}

    prints = [(r[0], brute.simhash_of(r[1])) for r in sorted(known)]
    group = list(range(len(prints)))
    for _ in range(3):
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if bin(a[1] ^ b[1]).count("1") <= 2:
                    group[i] = group[j] = min(group[i], group[j])
    assert sorted(r[0] for r in single) == sorted({prints[g][0] for g in group})

    bad = {i for i, *_, b in brute.contaminated(single, tests) if b}
    assert bad and sorted(r[0] for r in clean) == sorted(r[0] for r in single if r[0] not in bad)

    by_id = {r[0]: r for r in redacted}
    assert len(redacted) == len(clean)
    for row in clean:
        if list(brute.base_spans(row[1])):
            assert secrets.MARK in by_id[row[0]][1] and by_id[row[0]][4] == len(by_id[row[0]][1])
            assert not list(brute.base_spans(by_id[row[0]][1]))

    rates = {}
    sizes = Counter(r[3] for r in redacted)
    for source, n in sizes.items():
        named = sum(v for s, v in sizes.items() if s in WEIGHTS)
        rates[source] = named * (WEIGHTS[source] / sum(WEIGHTS.values())) / n
    copies = Counter(r[0] for r in mixed)
    for row in redacted:
        u = int(brute.hashlib.md5(f"{MIX_SEED}:{row[0]}".encode()).hexdigest()[:13], 16) / 2**52
        assert copies[row[0]] == sum(c <= u for c in mixing.poisson_steps(rates[row[3]]))
    assert len(corpus_pipeline.run(spark, SF_DIR).collect()) == len(mixed)


def test_an_empty_table_stays_empty(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_DIR), name)
        assert docs.isEmpty() and set(docs.columns) >= {"doc_id", "text", "lang", "source", "n_chars"}


def test_columns_with_clashing_names_go_through(spark):
    """The names that the stages use themselves, as columns of the documents."""
    names = ["lang_pred", "lang_score", "lang_ambiguous", "fingerprint", "component_id", "contaminated", "n_hit",
             "n_words", "item_id", "key", "rank", "id", "row", "n", "copy", "spans", "start", "kind", "share"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(40)
    plain, named = docs, docs.select("*", *[docs.doc_id.cast("string").alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = materialise(stage(spark, plain, SF_DIR), name)
        named = materialise(stage(spark, named, SF_DIR), name)
        assert named.columns == [*docs.columns, *names], name
        rows = [tuple(r) for r in named.collect()]
        assert sorted(r[:5] for r in rows) == sorted(tuple(r) for r in plain.collect())
        assert all(set(r[5:]) == {str(r[0])} for r in rows)
    mixed = corpus_pipeline.STAGES[-1][1]
    ids = [Counter(r.doc_id for r in mixed(spark, d, SF_DIR).collect()) for d in (plain, named)]
    assert ids[0] == ids[1]
