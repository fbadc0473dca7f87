"""Document quality by a linear-chain conditional random field over lines.

Each line of a text is labelled good or bad. A line's features are counts and shares of its
characters and words, put into bins, and those of the line before and after it. Transition weights
tie neighbouring labels. Forward and backward passes give each line the probability that it is
good; a document's score is their mean, weighted by the lines' lengths.

Training takes a bounded sample: the ``most_docs`` labelled rows with the smallest hashed ids among
texts of at most ``most_bytes`` bytes; every line of one has its document's label. What reaches the
driver are the line features of the sample. Scoring reads every line of every text.

Null, empty and blank texts have one empty line and get its score. Without labels all
scores are the share 0.5. Labels may be numbers of any type or digits. A row repeated in the labels counts once, the smallest label winning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import chunks

#: Line measures, and the bins each is put into.
MEASURES, BINS = 14, 8
MOST_DOCS, MOST_BYTES = 4000, 1 << 16
#: Lines of a batch of chains.
LINES = 1 << 14
_CLASS = np.zeros(256, np.int64)
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c] = (
        7 if _c >= 128 else 0 if _ch.islower() else 1 if _ch.isupper() else 2 if _ch.isdigit()
        else 3 if _ch.isspace() else 4 if _ch in "!?" else 5 if _ch in ".,;:'\"()-" else 6
    )


def line_measures(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """For each line of a text: MEASURES numbers, and its length in characters."""
    lines = (text or "").split("\n")
    out = np.zeros((len(lines), MEASURES), np.float32)
    lengths = np.array([len(x) for x in lines], np.float64)
    seen: dict[str, int] = {}
    for i, line in enumerate(lines):
        words = line.split()
        seen[line] = seen.get(line, 0) + 1
        if not words:
            continue
        kinds = np.bincount(
            _CLASS[np.frombuffer(line.encode("utf-8", "replace"), np.uint8)], minlength=8
        )
        n, distinct = len(words), len(set(words))
        again = sum(a == b for a, b in zip(words, words[1:], strict=False))
        out[i, :7] = kinds[[1, 2, 3, 4, 5, 6, 7]] / kinds.sum()
        out[i, 7:] = (
            np.log1p(n), distinct / n, again / n, (kinds[0] + kinds[1] + kinds[7]) / n / 16,
            float(line[-1:] in ".!?"), sum(len(w) == 1 for w in words) / n, float(line[:1].isupper()),
        )
    out[:, 8] += [min(seen[x], 4) - 1 for x in lines] if len(lines) > 1 else 0
    return out, lengths


def features(measures: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Numbers of the features that each line has: a bin per measure, own, before and after.

    Bin 0 of the neighbours means that there is none.
    """
    bins = np.stack(
        [np.searchsorted(edges[m], measures[:, m], "right") for m in range(MEASURES)], axis=1
    ).astype(np.int64)
    wide = BINS + 1
    offset = np.arange(MEASURES) * wide
    before = np.zeros_like(bins)
    after = np.zeros_like(bins)
    before[1:], after[:-1] = bins[:-1] + 1, bins[1:] + 1
    block = MEASURES * wide
    return np.concatenate([bins + offset, before + offset + block, after + offset + 2 * block], axis=1)


N_FEATURES = 3 * MEASURES * (BINS + 1)


@dataclass
class ChainModel:
    """``weights``: log-odds of good per feature; ``moves[a, b]``: weight of label b after a."""

    edges: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def marginals(self, chains: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of good for each line of each document, given the lines' log-odds."""
        alpha, beta, _ = forward_backward(chains, self.moves)
        return [1 / (1 + np.exp(np.clip((a + b)[:, 0] - (a + b)[:, 1], -60, 60))) for a, b in zip(alpha, beta, strict=True)]


def forward_backward(chains: list[np.ndarray], moves: np.ndarray) -> tuple:
    """Log forward and backward values of chains of log-odds, and the log normalisers.

    Chains are stepped through together, the longest first, so a step works on those that go on.
    """
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    sizes = np.array([len(chains[i]) for i in order])
    start = np.append(0, np.cumsum(sizes))[:-1]
    odds = np.concatenate([chains[i] for i in order])
    unary = np.stack([np.zeros(len(odds)), odds], axis=1)
    alpha, beta = unary.copy(), np.zeros_like(unary)
    for t in range(1, int(sizes[0])):
        at = start[: np.searchsorted(-sizes, -t)] + t
        last = alpha[at - 1]
        alpha[at] += np.logaddexp(last[:, :1] + moves[0], last[:, 1:] + moves[1])
    for t in range(int(sizes[0]) - 2, -1, -1):
        at = start[: np.searchsorted(-sizes, -t - 1)] + t
        after = beta[at + 1] + unary[at + 1]
        beta[at] = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
    norm = np.logaddexp(*alpha[start + sizes - 1].T)
    back = np.argsort(order)
    cut = [slice(s, s + n) for s, n in zip(start, sizes, strict=True)]
    return [alpha[cut[i]] for i in back], [beta[cut[i]] for i in back], norm[back]


def fit(documents: list[tuple[np.ndarray, int]], rounds: int = 150, l2: float = 2e-3) -> ChainModel:
    """Maximises the conditional likelihood of the labels of all lines, by Adam.

    ``documents``: line measures and label. A document counts as one, however many lines it has.
    """
    every = np.concatenate([m for m, _ in documents])
    share = np.arange(1, BINS) / BINS
    edges = np.stack([np.quantile(every[:, m], share) for m in range(MEASURES)])
    found = [features(m, edges) for m, _ in documents]
    index = np.concatenate(found)
    sizes = np.array([len(f) for f in found])
    owner = np.repeat(np.arange(len(found)), sizes)
    label = np.array([y for _, y in documents], np.float64)
    weight = 1 / np.sqrt(sizes)
    weight /= weight.sum()
    cuts = np.cumsum(sizes)[:-1]
    theta = np.zeros(N_FEATURES + 5)
    theta[N_FEATURES] = np.log((label.mean() + 1e-3) / (1 - label.mean() + 1e-3))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        moves = theta[-4:].reshape(2, 2)
        odds = theta[index].sum(axis=1) + theta[N_FEATURES]
        chains = np.split(odds, cuts)
        alpha, beta, norm = forward_backward(chains, moves)
        a, b = np.concatenate(alpha), np.concatenate(beta)
        good = np.exp((a + b)[:, 1] - norm[owner])
        pull = (label[owner] - good) * weight[owner]
        grad = np.zeros_like(theta)
        grad[:N_FEATURES] = np.bincount(index.ravel(), np.repeat(pull, index.shape[1]), N_FEATURES)
        grad[N_FEATURES] = pull.sum()
        inner = np.ones(len(owner), bool)
        inner[np.append(0, cuts)] = False
        at = np.flatnonzero(inner)
        unary = np.stack([np.zeros(len(odds)), odds], axis=1)
        joint = a[at - 1][:, :, None] + moves[None] + (unary[at] + b[at])[:, None, :]
        joint = np.exp(joint - norm[owner[at]][:, None, None]) * weight[owner[at]][:, None, None]
        truth = np.zeros((2, 2))
        np.add.at(truth, (label[owner[at]].astype(int),) * 2, weight[owner[at]])
        grad[-4:] = (truth - joint.sum(axis=0)).ravel()
        grad -= l2 * theta * (np.arange(len(theta)) != N_FEATURES) / 10
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return ChainModel(edges, theta[:N_FEATURES], float(theta[N_FEATURES]), theta[-4:].reshape(2, 2))


def train(
    docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS, most_bytes: int = MOST_BYTES
) -> ChainModel:
    """Learns from a bounded sample of the rows of ``docs`` that have a label 0 or 1."""
    # Labels may be numbers of any type, or digits.
    given = F.col("quality").try_cast("double")
    labels = labels.where(given.isin(0.0, 1.0)).groupBy("doc_id").agg(F.min(given.cast("int")).alias("quality"))
    # Chosen among the labels by hash, twice as many as wanted at most, so no text is shuffled.
    labels = labels.withColumn("key", F.xxhash64("doc_id"))
    n = labels.count()
    labels = labels.where(F.pmod("key", F.lit(1 << 30)) * n < 2 * most_docs * (1 << 30))
    labels = labels.orderBy(F.pmod("key", F.lit(1 << 30)), "doc_id").limit(2 * most_docs)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(labels), "doc_id").where(F.octet_length("text") <= most_bytes)
    rows = rows.orderBy("key", "doc_id", "text").limit(most_docs).select("text", "quality")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = [line_measures(t)[0].tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), batch.column(1)], ["x", "y"])

    sample = rows.mapInArrow(measure, "x binary, y int").collect()
    sample = sorted((bytes(r.x), r.y) for r in sample)
    if not sample:
        return ChainModel(np.zeros((MEASURES, BINS - 1)), np.zeros(N_FEATURES), 0.0)
    return fit([(np.frombuffer(x, np.float32).reshape(-1, MEASURES), y) for x, y in sample])


def score_lines(texts: list[str | None], model: ChainModel) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text: the probability of good of its lines, and the lines' lengths."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    chains: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        nonlocal chains, lengths, held
        if chains:
            out.extend(zip(model.marginals(chains), lengths, strict=True))
        chains, lengths, held = [], [], 0

    for text in texts:
        measures, size = line_measures(text)
        # A long text is turned into log-odds in parts that overlap by a line on either side.
        odds = []
        for i in range(0, len(measures), LINES):
            low = max(0, i - 1)
            part = model.weights[features(measures[low : i + LINES + 1], model.edges)].sum(axis=1)
            odds.append(part[i - low : i - low + LINES] + model.bias)
        chains.append(np.concatenate(odds))
        lengths.append(size)
        held += len(size)
        if held > LINES:
            flush()
    flush()
    return out


def score(docs: DataFrame, model: ChainModel) -> DataFrame:
    """All rows of ``docs`` with ``score``: the length-weighted share of good lines, 0 to 1.

    A column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = score_lines(batch.column("text").to_pylist(), shared.value)
            value = [float(p @ (n + 1) / (n + 1).sum()) for p, n in found]
            columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "score"]
            names = [n for n in batch.schema.names if n != "score"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(value, pa.float64())], [*names, "score"])

    kept = docs.drop("score")
    return kept.mapInArrow(run, T.StructType([*kept.schema, T.StructField("score", T.DoubleType())]))
