"""A training corpus from ``documents``: five stages, each on all that the one before it kept.

For every stage: an empty table stays empty, columns beside those of ``documents`` go through whatever
their names, repeated rows are judged alike, and each text is read whole, however long.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import inverted_index, language, mixing, secrets, simhash
from ledgerloom.llm.common import table
from ledgerloom.llm.queries import MIX_SEED, WEIGHTS
from ledgerloom.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, null and empty texts and texts between two languages go.

    A null ``lang`` or ``doc_id`` is not learnt from; its row is judged by its text like any other. Two
    languages that tie make a text ambiguous.
    """
    learnt = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(False))
    return language.identified(docs, language.train(docs.where(learnt)))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of 3-word shingles within 2 bits the one of smallest id stays.

    Null and empty texts have fingerprint zero and are linked like others.
    """
    return simhash.keep_one(docs, shingle=3, most=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words a twentieth or more are in 13-word windows of the benchmark go.

    A share of exactly a twentieth goes. Null and empty texts have no words and stay; items without words
    have no window.
    """
    return inverted_index.decontaminate(docs, table(spark, sf_dir, "benchmark"), width=13, share=20)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark, and n_chars follows.

    Null and empty texts stay as they are. A string whose p-value is at the threshold isn't taken for a secret.
    """
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents, each source as often as its target share asks, in shuffled order.

    A source without a weight, null too, is repeated once on average. Rows of one id have as many copies each;
    rows without an id go by their text.
    """
    return mixing.replicate(docs, WEIGHTS, MIX_SEED)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
]

#: Languages, links and tests of randomness are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what one returns is written, and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
