"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1. One linear classifier per position of the words, on
hashed byte n-grams, predicts that bit. A text is decoded to the language whose codeword has the
smallest loss against all bit margins, bits weighted by how well they were learnt. A text is
ambiguous if the second language is nearly as close.

Training takes a bounded sample (at most ``per_language`` rows of each language, ``most_rows`` in all,
chosen by their hashed ids); its n-gram counts, not its texts, reach the driver. Scoring
reads every whole text. Null texts and texts without a letter get ``und`` and score 0; so do all
if no language was learnt. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import chunks, fresh

#: Bins of two-byte and of three-byte strings.
BITS = 12
BINS = 2 << BITS
UNKNOWN = "und"
#: A letter, as Python's ``isalpha`` takes it: numerals such as the Roman ones and fractions are none.
LETTER_PATTERN = r"\p{L}"
_PIECE = 1 << 20


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed two- and three-byte strings of the lower-cased text, scaled to length 1."""
    data = np.frombuffer(b" " + text.encode("utf-8", "replace").lower() + b" ", np.uint8)
    counts = np.zeros(BINS, np.float32)
    for i in range(0, len(data) - 1, _PIECE):
        part = data[i : i + _PIECE + 2].astype(np.uint32)
        two = part[:-1] * np.uint32(0x9E3779B1) + part[1:] * np.uint32(0x85EBCA6B)
        three = two[:-1] + part[2:] * np.uint32(0xC2B2AE35)
        # The string of two bytes that the next piece begins with is counted there.
        two = two[:_PIECE]
        counts[: BINS // 2] += np.bincount(_bin(two), minlength=BINS // 2)
        counts[BINS // 2 :] += np.bincount(_bin(three), minlength=BINS // 2)
    counts = np.sqrt(counts)
    return counts / max(1.0, float(np.sqrt(counts @ counts)))


def _bin(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(32 - BITS)).astype(np.int64)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` classes, far apart from each other.

    Up to 5 classes: every way to part them once. More: the best of random matrices.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        splits = np.arange(1, 2 ** (n - 1))
        return np.where((splits >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    rng = np.random.default_rng(seed)
    width = int(np.ceil(10 * np.log2(n)))
    best, least = np.zeros((0, 0)), -1.0
    for _ in range(200):
        words = np.where(rng.random((n, width)) < 0.5, 1.0, -1.0)
        if (np.abs(words.sum(axis=0)) == n).any():
            continue
        apart = (width - words @ words.T) / 2 + width * np.eye(n)
        if apart.min() > least:
            best, least = words, apart.min()
    return best


@dataclass
class LanguageModel:
    languages: list[str]
    words: np.ndarray  # languages x bits
    weights: np.ndarray  # bins x bits
    bias: np.ndarray
    bit_weight: np.ndarray
    sharpness: float

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Position of the nearest language, its share, and the share of the second one."""
        margin = x @ self.weights + self.bias
        loss = np.logaddexp(0, -margin[:, None, :] * self.words[None]) @ self.bit_weight
        share = np.exp(-self.sharpness * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        order = np.argsort(-share, axis=1, kind="stable")
        rows = np.arange(len(x))
        second = share[rows, order[:, 1]] if share.shape[1] > 1 else np.zeros(len(x))
        return order[:, 0], share[rows, order[:, 0]], second


def _fit(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, rounds: int = 300) -> tuple:
    """Weights and biases of logistic regressions, a column of ``y`` each, by momentum descent."""
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    vw, vb, rate = np.zeros_like(w), np.zeros_like(b), np.float32(4.0)
    for _ in range(rounds):
        pull = -y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30))) / len(x)
        vw = 0.9 * vw - rate * (x.T @ pull + l2 * w)
        vb = 0.9 * vb - rate * pull.sum(axis=0)
        w, b = w + vw, b + vb
    return w, b


def train(docs: DataFrame, per_language: int = 500, most_rows: int = 4000) -> LanguageModel:
    """Learns from ``text`` and ``lang`` of a bounded sample of the given rows."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", "text", F.xxhash64(F.col("doc_id").cast("string")).alias("key")
    )
    # Twice the rows wanted of a language, by their hash, go on to be ranked, however many it has.
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang")
    sizes = {r.lang: r.n for r in sizes.limit(most_rows).collect()}
    if sizes:
        n = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])[F.col("lang")]
        rows = rows.where(F.pmod("key", F.lit(1 << 30)) * n < 2 * per_language * (1 << 30))
    ranked = Window.partitionBy("lang").orderBy("key", "text")
    rows = rows.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= per_language)
    rows = rows.orderBy("rank", "key", "lang").limit(most_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = [ngram_counts(t).astype(np.float16).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["lang", "x"])

    sample = rows.select("lang", "text").mapInArrow(count, "lang string, x binary").collect()
    sample = sorted(sample, key=lambda r: (r.lang, bytes(r.x)))
    languages = sorted({r.lang for r in sample})
    words = codewords(len(languages))
    if not languages:
        none = np.zeros((BINS, 0), np.float32)
        return LanguageModel([], words, none, np.zeros(0, np.float32), np.zeros(0), 1.0)
    x = np.stack([np.frombuffer(r.x, np.float16) for r in sample]).astype(np.float32)
    y = words[[languages.index(r.lang) for r in sample]].astype(np.float32)
    weights, bias = _fit(x, y)
    right = np.maximum(((x @ weights + bias) * y > 0).mean(axis=0) - 0.5, 1e-3)
    return LanguageModel(languages, words, weights, bias, right / right.mean(), 2.0)


def predict(
    docs: DataFrame,
    model: LanguageModel,
    ambiguous: float = 0.8,
    names: tuple[str, ...] = ("lang_pred", "lang_score", "lang_ambiguous"),
) -> DataFrame:
    """All rows of ``docs`` with prediction, score and ambiguity; columns of these names are replaced.

    Ambiguous: the second language's share is at least ``ambiguous`` of the first one's.
    A text without a letter is ``und``, with score 0, and not ambiguous.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in chunks(batches, "text"):
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = part.column("text").to_pylist()
                known = [bool(t) and bool(model.languages) and any(map(str.isalpha, t)) for t in texts]
                label, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                unsure = np.zeros(len(texts), bool)
                if any(known):
                    at = np.flatnonzero(known)
                    x = np.stack([ngram_counts(texts[j]) for j in at])
                    best, first, second = model.decode(x)
                    score[at], unsure[at] = first, second >= ambiguous * first
                    for j, b in zip(at, best, strict=True):
                        label[j] = model.languages[b]
                columns = [c for n, c in zip(part.schema.names, part.columns, strict=True) if n not in new]
                names = [n for n in part.schema.names if n not in new]
                columns += [pa.array(label, pa.string()), pa.array(score), pa.array(unsure)]
                yield pa.RecordBatch.from_arrays(columns, names + new)

    new = list(names)
    kept = docs.drop(*new)
    added = T.StructType().add(new[0], "string").add(new[1], "double").add(new[2], "boolean")
    return kept.mapInArrow(run, T.StructType([*kept.schema, *added]))


def identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows whose language is known: neither ``und`` nor ambiguous.

    If the model has no language, as no row learnt from had one, nothing tells the texts apart: all
    with a letter are kept.
    """
    if not model.languages:
        with_letter = F.col("text").cast("string").rlike(LETTER_PATTERN)
        return docs.where(F.coalesce(with_letter, F.lit(False)))
    names = fresh(docs, "lang_pred", "lang_score", "lang_ambiguous")
    found = predict(docs, model, names=tuple(names))
    found = found.where((F.col(names[0]) != UNKNOWN) & ~F.col(names[2]))
    return found.select(docs.columns)
