"""Voters, the model of their votes, and scores of texts that were not learnt from."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerloom.llm import toxicity

SCHEMA = "doc_id long, text string, score string, votes int"
BAD = ["grubolo", "grubent", "skarn", "idiot"]


def texts(n, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(rng.randint(5, 200))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ",", ".", "!"]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_reader():
    words = toxicity.vocabulary(["grub*", "skarn"])
    read = words.reader()

    def fires(text):
        mask, found = read(text)
        names = {t for t, i in words.number.items() if i in found}
        return {v for i, v in enumerate(toxicity.VOTERS) if mask >> i & 1}, names

    assert fires(None) == fires("") == fires("...") == (set(), set())
    assert fires("You IDIOT!") == ({"mind"}, {"idiot"})
    assert fires("x (idiot) idiot,moron") == ({"mind"}, {"idiot", "moron"})
    assert fires("grubbing") == ({v for v in toxicity.VOTERS if v == toxicity.VOTERS[words.voter[words.number["grub*"]]]}, {"grub*"})
    assert "masked" in fires("an id*ot here")[0] and "shout" in fires("no!!!")[0]
    assert fires("Shut up")[0] == {"threat"} and fires("shut upward")[0] == set()
    assert fires("you're a fine one")[0] == {"address"}
    long = "z" * 100_000 + " idiot " + "ä" * 100_000
    assert fires(long) == ({"mind"}, {"idiot"})
    assert fires("idiot") == ({"mind"}, {"idiot"})


def test_label_model_finds_accuracies_and_ties():
    rng = np.random.default_rng(2)
    n, m = 40_000, len(toxicity.VOTERS)
    y = rng.random(n) < 0.15
    right = np.linspace(0.4, 0.7, m)
    votes = rng.random((n, m)) < np.where(y[:, None], right, 0.02)
    votes[:, 9] = np.where(rng.random(n) < 0.95, votes[:, 3], votes[:, 9])  # voter 9 repeats voter 3
    bits = (votes << np.arange(m)).sum(axis=1)
    counts = {int(k): float(c) for k, c in zip(*np.unique(bits, return_counts=True), strict=True)}
    gold = {}
    for b, label in zip(bits[:1500].tolist(), y[:1500].astype(int).tolist(), strict=True):
        gold[b, label] = gold.get((b, label), 0.0) + 1
    model = toxicity.fit_labels(counts, gold)
    assert abs(model.share - 0.15) < 0.01
    found = list(model.accuracies().values())
    for j in range(m):
        assert abs(found[j][0] - votes[y, j].mean()) < 0.04 and abs(found[j][1] - votes[~y, j].mean()) < 0.02
    assert model.parent[9] == 3 or model.parent[3] == 9
    # Exact: against the sums of the joint distribution over two voters and the class.
    posterior = model.posterior(bits)
    assert np.mean((posterior > 0.5) == y) > 0.98
    assert abs(posterior[posterior > 0.9].mean() - y[posterior > 0.9].mean()) < 0.03


@pytest.mark.parametrize("kind", ["int", "long", "string", "double"])
def test_texts_not_learnt_from(spark, kind, tmp_path):
    rows = texts(600)
    odd = [(1000, None, 1), (1001, "", 0), (None, "skarn " * 5, 1), (rows[3][0], rows[3][1], rows[3][2])]
    docs = spark.createDataFrame([(i, t, "old", 7) for i, t, _ in rows + odd], SCHEMA).repartition(4)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:400] + odd] + [(1, None), (1, 5)], "doc_id long, y int")
    labels = labels.selectExpr("doc_id", f"CAST(y AS {kind}) AS toxic")
    model = toxicity.train(docs.where("doc_id < 400 OR doc_id >= 1000"), labels, most_docs=300)
    found = toxicity.score(docs, model)
    assert found.columns == ["doc_id", "text", "votes", "score"]
    got = {r.doc_id: r.score for r in found.collect()}
    assert found.count() == len(rows) + len(odd) and all(0 <= s <= 1 for s in got.values())
    held = rows[400:]
    assert sum((got[i] >= 0.5) == y for i, _, y in held) >= 0.99 * len(held)
    assert got[1000] == got[1001] < 0.5 < got[None]


def test_without_labels_and_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(none, toxicity.train(none, labels)).collect() == []
    docs = spark.createDataFrame([(i, t, None, 0) for i, t, _ in texts(50)] + [(99, "you idiot", None, 0)], SCHEMA)
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert len(got) == 51 and got[99] > 0.5
