"""Very long texts, numerals, and labels of several types."""

from __future__ import annotations

import base64
import random

import pytest
from test_operators import base_spans

from ledgerloom.llm import language, quality, secrets

SCHEMA = "doc_id long, text string, n_chars long"


def test_secrets_of_long_texts(spark):
    rng = random.Random(1)
    run = base64.b64encode(rng.randbytes(750_000)).decode()
    runs = " ".join(base64.b64encode(rng.randbytes(18)).decode() for _ in range(100_000))
    assigned = "é " + " ".join(f"token = 'hunter{i}x' AKIAABCDEFGHIJKLMNO{i % 10}P" for i in range(8_000))
    texts = [run, runs, assigned, "a" * 3_000_000 + " secret=abcdefg " + "é" * 100]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], SCHEMA).repartition(4)
    rows = sorted(secrets.with_spans(docs).collect(), key=lambda r: r.doc_id)
    assert [tuple(s) for s in rows[2].base_spans] == sorted(base_spans(assigned))
    assert [(s.start, s.end) for s in rows[0].random_spans] == [(0, len(run))]
    assert len(rows[1].random_spans) > 90_000
    cut = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact(docs).collect()}
    for r in rows:
        out, at, text = [], 0, texts[r.doc_id]
        for s in sorted((s.start, s.end) for s in [*r.base_spans, *r.random_spans]):
            if s[0] >= at:
                out += [text[at : s[0]], secrets.MARK]
            at = max(at, s[1])
        out = "".join([*out, text[at:]])
        assert cut[r.doc_id] == (out, len(out))


def test_numerals_are_no_letters(spark):
    rows = [(i, f"the cat and {i} dogs", "en") for i in range(8)] + [(i, f"der Hund und {i} Katzen", "de") for i in range(8, 16)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    odd = spark.createDataFrame([(i, t, None) for i, t in enumerate(["½", "²³ 12", "Ⅷ", "٣", "_", None, "", "x"])], docs.schema)
    found = {r.doc_id: r.lang_pred for r in language.predict(odd, model).collect()}
    assert [found[i] for i in range(7)] == ["und"] * 7 and found[7] in ("en", "de")
    unknown = language.train(docs.limit(0))
    assert [r.doc_id for r in language.identified(odd, unknown).collect()] == [7]


@pytest.mark.parametrize("kind", ["bigint", "string", "double", "smallint"])
def test_quality_labels_of_any_type(spark, kind):
    texts = ["A good line of prose, with words.\nAnd another one.", "xx xx xx !!! 1234 %%%%"]
    docs = spark.createDataFrame([(i, texts[i % 2], 0) for i in range(60)], SCHEMA)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)] + [(3, None), (5, 7)], "doc_id long, y int")
    model = quality.train(docs, labels.selectExpr("doc_id", f"CAST(y AS {kind}) AS quality"))
    found = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert found[0] > 0.8 and found[1] < 0.2
