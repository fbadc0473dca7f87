"""The queries of the operators over the given tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    codes,
    fingerprints,
    inverted_index,
    language,
    licenses,
    manifest,
    mixing,
    quality,
    secrets,
    simhash,
    substrings,
    toxicity,
    wordpieces,
)
from ledgerloom.llm.codes_sql import CODES_SQL
from ledgerloom.llm.common import table
from ledgerloom.llm.manifest_sql import MANIFEST_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: SQL for those queries that another engine can express.
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document hit by 13-word windows of the benchmark."""
    index = inverted_index.build_index(table(spark, sf_dir, "documents"))
    found = inverted_index.contamination(index, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), "contaminated"
    )


@query
def op2_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document covered by 200-byte strings that also start anywhere else."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), length=200)


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of each text and of its edited text, compared."""
    return fingerprints.against_next(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of each text."""
    return wordpieces.count_tokens(table(spark, sf_dir, "documents"))


def _held_out(parts: int, out: int) -> Column:
    """The rows that a contract keeps from training: by crc32 of the id as text."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == out, F.lit(False))


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each text; labels of a fifth of the documents are never seen."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", _held_out(5, 0))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.train(docs.where("NOT held_out"), labels)
    return quality.score(docs, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


#: Target shares of the sources: the one that has a third of all documents gets a seventh.
WEIGHTS = {"src0": 3.0} | {f"src{i}": 1.0 for i in range(1, 20)}
MIX_SEED = 11


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, each source repeated to its target share, in shuffled order."""
    return mixing.replicate(table(spark, sf_dir, "documents"), WEIGHTS, MIX_SEED)


SQL["op6_mixing"] = mixing.replicate_sql(WEIGHTS, MIX_SEED)


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in each text, by pattern and by randomness."""
    found = secrets.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def number(kind: str) -> Column:
        at = secrets.KINDS.index(kind)
        return F.size(F.filter("base_spans", lambda s: s["kind"] == at)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(secrets.listed(F.col("base_spans")), 256).alias("base_sha256"),
        secrets.listed(F.concat("base_spans", "random_spans")).alias("spans"),
    )


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of 3-word shingles and the component of fingerprints within 2 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, most=2)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each text; a quarter of the documents is never learnt from."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", _held_out(4, 2))
    model = language.train(docs.where("NOT held_out"))
    found = language.predict(docs.select("doc_id", "text", "held_out"), model)
    return found.select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"), "lang_ambiguous"
    )


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses named in each text, by phrase and by template."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    starts = F.transform("places", lambda p: p["start"].cast("long"))
    base = F.transform("places", lambda p: p["label"])
    matched = F.concat(*[F.transform(c, lambda m: m["label"]) for c in ("matches", "notices")])
    best = F.array_max(
        F.concat(*[F.transform(c, lambda m: m["containment"]) for c in ("matches", "notices")])
    )
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct(base))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(base, matched)))).alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
    )


@query
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of each document; tampered ones don't fold to the root."""
    return manifest.verified_manifest(table(spark, sf_dir, "documents"), fanout=2)


SQL["op11_manifest"] = MANIFEST_SQL


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each text; labels of a fifth of the documents are never seen."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", _held_out(5, 0))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs.where("NOT held_out"), labels)
    return toxicity.score(docs, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of each vector, under codebooks of two rounds over all vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    books = codes.train(vectors, parts=16, entries=64, rounds=2, scale=256)
    coded = codes.encode(vectors, books, scale=256).select("vec_id", "code", "error", "label")
    return codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256")
    )


SQL["op13_codes"] = CODES_SQL
