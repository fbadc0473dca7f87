"""Toxicity by weak supervision: many voters, a generative model of their votes, a linear classifier.

Voters are lexicons and patterns. A voter fires on a text that holds one of its words, word stems or
patterns. Some lexicons are given, the others are learnt: words and stems that are far more common
in texts labelled toxic are dealt to voters by hash. How often each set of voters fires is
counted over all texts, and a generative model explains the counts: a text is toxic or not; given
that, a voter fires with its own probability, depending on the one voter it is tied to most. The
ties are the maximum spanning tree of the voters' mutual information given the class, so voters
that fire together don't count twice. Accuracies, ties and the share of toxic texts are found by
expectation maximisation over all counts, with the labelled texts counted under their label.

The model gives each text of a sample the probability of being toxic. A logistic regression on the
words and stems of the sample's texts learns those posterior labels, and scores every text.

Fitting takes a bounded sample: of each label the ``most_docs`` ids with the smallest hash, texts
of at most ``most_bytes`` bytes; what reaches the driver are counts of at most 2^16 sets of voters,
``most_words`` words, and the numbers of the words that each text of the sample has. Counting and
scoring read every text whole.

Null and empty texts have no word and get the score of a text on which no voter fires. Repeated
labels of an id count once, toxic winning; of an id with several texts the smallest text is learnt
from. Null ids are never learnt from. Labels are numbers or digits; others are no label. Without
labels the given lexicons alone vote, each taken to be right five times to begin with. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import chunks
from ledgerloom.session import materialise

# Insults, by what they say about somebody.
LEXICONS = {
    "mind": "idiot idiots moron morons stupid dumb imbecile fool idiota imbécil estúpido tonto dumm "
    "dummkopf trottel blöd imbécile crétin débile",
    "worth": "worthless loser losers pathetic useless nobody wertlos versager erbärmlich minable "
    "pitoyable inútil patético perdedor",
    "filth": "scum trash garbage disgusting filth vermin abschaum ekelhaft ordure dégoûtant basura asqueroso",
    "mockery": "clown clowns buffoon ridiculous lächerlich bouffon payaso ridículo",
}
#: Phrases, and what may stand inside a word or at its end.
PHRASES = {
    "threat": ("kill yourself", "drop dead", "shut up", "get lost", "hate you", "go to hell"),
    "address": ("you are a ", "you are an ", "you are such ", "you're a ", "you're an ", "you're such "),
}
MARKS = {"masked": r"[^\W\d_][*@$#]+[^\W\d_]", "shout": r"!{3,}|\?!|!\?"}
#: Voters with learnt words, and with learnt stems.
WORD_VOTERS, STEM_VOTERS = 4, 4
VOTERS = [
    *LEXICONS, *PHRASES, *MARKS,
    *[f"words{i}" for i in range(WORD_VOTERS)], *[f"stems{i}" for i in range(STEM_VOTERS)],
]
#: Lengths of stems; a stem is written with a star.
STEMS = (4, 5)
MOST_DOCS, MOST_BYTES, MOST_WORDS = 4000, 1 << 16, 1024
#: Words that a task remembers, and distinct words that it counts before it hands them on.
REMEMBERED, COUNTED = 1 << 18, 1 << 18
_WORD = re.compile(r"[^\W\d_]+")
_PHRASES = [
    (VOTERS.index(v), p, re.compile(r"(?<!\w)" + re.escape(p) + r"(?!\w)" * p[-1].isalpha()))
    for v, phrases in PHRASES.items() for p in phrases
]
_MARKS = [(VOTERS.index(v), re.compile(p)) for v, p in MARKS.items()]
_LONGEST = 64


def terms(word: str) -> list[str]:
    """A word and its stems; beyond 64 letters a word has its stems only."""
    out = [word] if len(word) <= _LONGEST else []
    return out + [word[:k] + "*" for k in STEMS if len(word) >= k]


@dataclass
class Vocabulary:
    """Number of each term, and the voter it belongs to."""

    number: dict[str, int]
    voter: list[int]

    def _hit(self, token: str) -> tuple[int, tuple[int, ...]]:
        """Voters that fire on what stands between two spaces, and its terms."""
        own = {self.number[t] for w in _WORD.findall(token) for t in terms(w) if t in self.number}
        mask = 0
        for i in own:
            mask |= 1 << self.voter[i]
        for voter, pattern in _MARKS:
            if pattern.search(token):
                mask |= 1 << voter
        return mask, tuple(sorted(own))

    def reader(self):
        """A function from a text to the set of voters that fire on it and the numbers of its terms.

        It remembers what stands between two spaces: in one set what nothing fires on, so that
        most of a text is done by the difference of two sets.
        """
        known: dict[str, tuple[int, tuple[int, ...]]] = {}
        nothing: set[str] = set()

        def read(text: str | None) -> tuple[int, set[int]]:
            low = (text or "").lower()
            mask, found = 0, set()
            for token in set(low.split()) - nothing:
                hit = known.get(token)
                if hit is None:
                    hit = self._hit(token)
                    if len(known) + len(nothing) >= REMEMBERED:
                        known.clear()
                        nothing.clear()
                    if len(token) <= _LONGEST:
                        if hit[0] or hit[1]:
                            known[token] = hit
                        else:
                            nothing.add(token)
                mask |= hit[0]
                found.update(hit[1])
            for voter, phrase, pattern in _PHRASES:
                if phrase in low and pattern.search(low):
                    mask |= 1 << voter
            return mask, found

        return read


@dataclass
class LabelModel:
    """Of ``toxic`` and of the voters: table[y, j, a, b] is P(voter j votes b | class y, its parent votes a)."""

    share: float
    parent: list[int]
    table: np.ndarray
    ties: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of toxic for each set of voters, given as bits."""
        votes = _bits(patterns, self.table.shape[1])
        logs = np.log(np.array([1 - self.share, self.share]))[:, None] + np.zeros((2, len(patterns)))
        for j, up in enumerate(self.parent):
            given = votes[:, up] if up >= 0 else np.zeros(len(patterns), np.int64)
            logs += np.log(self.table[:, j, given, votes[:, j]])
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """How often each voter fires on toxic texts and on others, ties left out."""
        out = {}
        for j in range(len(VOTERS)):
            fires = []
            for y in (1, 0):
                chain, at = [], j
                while at >= 0:
                    chain.append(at)
                    at = self.parent[at]
                p = 0.0
                for at in reversed(chain):
                    p = (1 - p) * self.table[y, at, 0, 1] + p * self.table[y, at, 1, 1]
                fires.append(float(p))
            out[VOTERS[j]] = (fires[0], fires[1])
        return out


def _bits(patterns: np.ndarray, m: int) -> np.ndarray:
    return (patterns[:, None] >> np.arange(m)) & 1


def _spanning_tree(ties: np.ndarray) -> list[int]:
    """Parent of each voter in the maximum spanning tree; -1 where nothing ties a voter."""
    m = len(ties)
    parent, reach = [-1] * m, np.full(m, -np.inf)
    reach[0] = 0.0
    left, by = set(range(m)), [-1] * m
    while left:
        j = max(left, key=lambda x: (reach[x], -x))
        left.remove(j)
        parent[j] = by[j] if by[j] >= 0 and ties[j, by[j]] > 1e-6 else -1
        for k in left:
            if ties[j, k] > reach[k]:
                reach[k], by[k] = ties[j, k], j
    return parent


def fit_labels(counts: dict[int, float], gold: dict[tuple[int, int], float], rounds: int = 25) -> LabelModel:
    """Expectation maximisation over ``counts`` of sets of voters; ``gold`` counts sets by label."""
    m = len(VOTERS)
    every = np.array(sorted(set(counts) | {p for p, _ in gold}), np.int64)
    if not len(every):
        every = np.zeros(1, np.int64)
    votes = _bits(every, m).astype(np.float64)
    seen = np.array([counts.get(int(p), 0.0) for p in every])
    known = np.array([[gold.get((int(p), y), 0.0) for p in every] for y in (0, 1)])
    # To begin with, a voter on a text with a label is what it is; a given one else is assumed to be right.
    toxic = 0.02 + 0.9 * (votes[:, : len(LEXICONS)].sum(axis=1) > 0)
    both = known.sum(axis=0)
    if known.sum(axis=1).min() > 0:
        # By Bayes from the labels of the set, else from those of its voters.
        rate = [(known[y] @ votes + 0.5) / (known[y].sum() + 1.0) for y in (0, 1)]
        prior = known[1].sum() / both.sum()
        logs = [votes @ np.log(r) + (1 - votes) @ np.log(1 - r) for r in rate]
        odds = logs[1] - logs[0] + math.log(prior / (1 - prior))
        toxic = 1 / (1 + np.exp(np.clip(-odds, -60, 60)))
    model = None
    for _ in range(rounds):
        weight = np.stack([seen * (1 - toxic), seen * toxic]) + known
        total = weight.sum()
        share = float((weight[1].sum() + 0.5) / (total + 1.0))
        table = np.zeros((2, m, 2, 2))
        ties = np.zeros((m, m))
        joint = np.zeros((2, m, m, 2, 2))
        for y in (0, 1):
            n = weight[y].sum()
            fires = votes.T @ weight[y]
            pair = (votes * weight[y][:, None]).T @ votes
            cells = np.stack([n - fires[:, None] - fires[None, :] + pair, fires[None, :] - pair, fires[:, None] - pair, pair], -1)
            joint[y] = np.clip(cells, 0, None).reshape(m, m, 2, 2) + 0.25
            p = joint[y] / joint[y].sum(axis=(2, 3), keepdims=True)
            own = p.sum(axis=3, keepdims=True) * p.sum(axis=2, keepdims=True)
            ties += weight[y].sum() / max(total, 1e-9) * (p * np.log(p / own)).sum(axis=(2, 3))
        np.fill_diagonal(ties, 0.0)
        parent = _spanning_tree(ties)
        for y in (0, 1):
            for j, up in enumerate(parent):
                # joint[y, up, j, a, b]: the parent votes a, the voter b.
                cells = joint[y, up, j] if up >= 0 else np.tile(joint[y, j, (j + 1) % m].sum(axis=1), (2, 1))
                table[y, j] = cells / cells.sum(axis=1, keepdims=True)
        model = LabelModel(share, parent, table, ties)
        toxic = model.posterior(every)
    return model


@dataclass
class ToxicityModel:
    vocabulary: Vocabulary
    weights: np.ndarray
    bias: float
    labels: LabelModel

    def scores(self, texts: list[str | None], read) -> list[float]:
        out = []
        for text in texts:
            _, found = read(text)
            odds = self.bias + float(sum(self.weights[i] for i in sorted(found)))
            out.append(1 / (1 + math.exp(-max(-60.0, min(60.0, odds)))))
        return out


def fit_linear(rows: list[tuple[list[int], float, float]], n: int, rounds: int = 400, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression of (numbers of terms, probability of toxic, weight of the row), by Adam."""
    x = np.zeros((len(rows), n), np.float32)
    for r, (found, _, _) in enumerate(rows):
        x[r, found] = 1.0
    label = np.array([y for _, y, _ in rows])
    weight = np.array([w for _, _, w in rows])
    weight = weight / weight.sum()
    share = float(np.clip(weight @ label, 1e-4, 1 - 1e-4))
    theta = np.zeros(n + 1)
    theta[-1] = math.log(share / (1 - share))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        odds = x @ theta[:-1].astype(np.float32) + theta[-1]
        pull = weight * (label - 1 / (1 + np.exp(np.clip(-odds, -60, 60))))
        grad = np.append(pull.astype(np.float32) @ x - l2 * theta[:-1], pull.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _sample(docs: DataFrame, labels: DataFrame, most_docs: int, most_bytes: int) -> tuple[DataFrame, list[int]]:
    """Texts with their label, at most ``most_docs`` ids of each, and how many ids have each label."""
    given = F.col("toxic").try_cast("double")
    labels = labels.where(given.isin(0.0, 1.0) & F.col("doc_id").isNotNull())
    labels = labels.groupBy("doc_id").agg(F.max(given.cast("int")).alias("y"))
    found = {r.y: r.n for r in labels.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [found.get(y, 0) for y in (0, 1)]
    # Chosen among the labels by hash, so that no text is shuffled to choose it.
    key = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    parts = []
    for y, n in enumerate(sizes):
        few = labels.where((F.col("y") == y) & (key * n < 2 * most_docs * (1 << 30)))
        parts.append(few.orderBy(key, "doc_id").limit(most_docs))
    few = F.broadcast(parts[0].unionByName(parts[1]))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(few, "doc_id")
    rows = rows.where(F.octet_length("text") <= most_bytes)
    return rows.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", "y"), sizes


def _drawn(sample: DataFrame) -> list[int]:
    """Texts of either label."""
    found = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [found.get(y, 0) for y in (0, 1)]


def _without_copies(sample: DataFrame) -> DataFrame:
    """One text of those with the same label whose two smallest word hashes are the same.

    Else the words of a text that was copied often would look like words of its label.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            least = []
            for text in batch.column(0).to_pylist():
                hashes = sorted({zlib.crc32(w.encode("utf-8", "replace")) for w in _WORD.findall((text or "").lower())})
                least.append(hashes[:2])
            columns = [*batch.columns, pa.array(least, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["text", "y", "sketch"])

    found = sample.mapInArrow(sketch, "text string, y int, sketch array<long>")
    return found.groupBy("sketch", "y").agg(F.min("text").alias("text")).select("text", "y")


def _learnt_terms(sample: DataFrame, most: int) -> list[str]:
    """Terms whose share of toxic texts is far above that of the others, the surest first."""
    sample = materialise(_without_copies(sample), "toxicity-terms")
    drawn = _drawn(sample)
    if not min(drawn):
        return []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())

        def rows() -> pa.RecordBatch:
            names = list(seen[0] | seen[1])
            columns = [pa.array(names, pa.string()), *[pa.array([c[t] for t in names], pa.int64()) for c in seen]]
            for c in seen:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, ["term", "n0", "n1"])

        for batch in chunks(batches, "text"):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = set(_WORD.findall((text or "").lower()))
                seen[y].update({t for w in words for t in terms(w)})
                if len(seen[0]) + len(seen[1]) > COUNTED:
                    yield rows()
        yield rows()

    found = sample.mapInArrow(count, "term string, n0 long, n1 long")
    found = found.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    found = found.where(F.col("n1") >= max(3, drawn[1] // 500))

    def share(y: int) -> Column:
        return (F.col(f"n{y}") + 0.5) / F.lit(drawn[y] + 1.0)

    p0, p1 = share(0), share(1)
    spread = F.sqrt(p1 * (1 - p1) / F.lit(float(drawn[1])) + p0 * (1 - p0) / F.lit(float(drawn[0])))
    sure = ((p1 - p0) / F.greatest(spread, F.lit(1e-9))).alias("sure")
    found = found.select("term", "n0", "n1", sure, (p1 / p0).alias("lift"))
    found = found.where("sure >= 3 AND lift >= 10").orderBy(F.col("sure").desc(), "term").limit(most)
    return [r.term for r in found.collect()]


def vocabulary(learnt: list[str]) -> Vocabulary:
    """Learnt terms, dealt to voters by hash, and the given words."""
    number: dict[str, int] = {}
    voter: list[int] = []
    for v, text in enumerate(LEXICONS.values()):
        for word in text.split():
            if word not in number:
                number[word] = len(voter)
                voter.append(v)
    first = len(LEXICONS) + len(PHRASES) + len(MARKS)
    for term in learnt:
        if term not in number:
            stem, dealt = term.endswith("*"), zlib.crc32(term.rstrip("*").encode())
            number[term] = len(voter)
            voter.append(first + (WORD_VOTERS + dealt % STEM_VOTERS if stem else dealt % WORD_VOTERS))
    return Vocabulary(number, voter)


def count_votes(docs: DataFrame, words: Vocabulary) -> dict[int, float]:
    """Number of texts by the set of voters that fire, over all rows; at most 2^16 sets."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, seen = shared.value.reader(), Counter()
        for batch in chunks(batches, "text"):
            seen.update(read(t)[0] for t in batch.column(0).to_pylist())
        columns = [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["votes", "n"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "votes long, n long")
    return {r.votes: float(r.n) for r in found.groupBy("votes").agg(F.sum("n").alias("n")).collect()}


def train(
    docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS, most_bytes: int = MOST_BYTES,
    most_words: int = MOST_WORDS,
) -> ToxicityModel:
    """Votes are counted over all rows of ``docs``; labels are those in ``toxic`` of their ids."""
    sample, sizes = _sample(docs, labels, most_docs, most_bytes)
    sample = materialise(sample, "toxicity-sample")  # two passes; bounded
    drawn = _drawn(sample)
    words = vocabulary(_learnt_terms(sample, most_words))
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = shared.value.reader()
        for batch in chunks(batches, "text"):
            found = [read(t) for t in batch.column(0).to_pylist()]
            columns = [
                pa.array([v for v, _ in found], pa.int64()),
                pa.array([sorted(f) for _, f in found], pa.list_(pa.int32())),
                batch.column(1),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["votes", "found", "y"])

    rows = sample.mapInArrow(measure, "votes long, found array<int>, y int").collect()
    rows = sorted((r.votes, list(r.found), r.y) for r in rows)
    # A text of the sample stands for as many as its label was thinned by.
    stands = [sizes[y] / drawn[y] if drawn[y] else 0.0 for y in (0, 1)]
    gold: dict[tuple[int, int], float] = {}
    for votes, _, y in rows:
        gold[votes, y] = gold.get((votes, y), 0.0) + stands[y]
    if not gold:  # a given voter alone is taken to be right
        gold = {(1 << v, 1): 5.0 for v in range(len(LEXICONS))} | {(0, 0): 20.0}
    model = fit_labels(count_votes(docs, words), gold)
    n = len(words.voter)
    if not rows:  # each given word is taken for what its voter says of it
        rows = [(1 << v, [i], 1) for i, v in enumerate(words.voter)] + [(0, [], 0)]
        stands = [float(n), 1.0]
    toxic = model.posterior(np.array([v for v, _, _ in rows], np.int64))
    weights, bias = fit_linear([(f, float(q), stands[y]) for (_, f, y), q in zip(rows, toxic, strict=True)], n)
    return ToxicityModel(words, weights, bias, model)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """All rows of ``docs`` with ``score``, 0 to 1, higher for toxic; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = shared.value.vocabulary.reader()
        for batch in chunks(batches, "text"):
            found = shared.value.scores(batch.column("text").to_pylist(), read)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"])

    kept = docs.drop("score")
    return kept.mapInArrow(run, T.StructType([*kept.schema, T.StructField("score", T.DoubleType())]))
