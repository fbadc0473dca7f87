"""Mixing sources to target weights by Poisson replication.

A source with target share w of the result and n documents has the repetition rate
``size * w / n``. Each document gets as many copies as the Poisson distribution with that mean has
at the document's own hashed uniform number: the distribution function is inverted, so the same
seed gives the same copies however the rows are split. Copies are spread over the whole result by
sorting on a hash of document and copy.

A source without a target, null included, keeps its natural share: rate 1. Target shares are of
the documents of the named sources. Rows with one doc_id get equally many copies; a null doc_id is
replaced by the text. A null or empty text is a document like any other. An empty table gives an
empty result. A column ``copy`` or ``shuffle_key`` of the input is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh

#: Hexadecimal digits of a hash that make up a uniform number: 52 bits.
DIGITS = 13
#: Up to this mean the distribution function is a table in the plan; beyond it each row sums it up.
MOST_TABLED = 1000.0


def _key(seed: int) -> Column:
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("string")), F.lit(""))
    return F.concat(F.lit(f"{seed}:"), name)


def uniform(key: Column) -> Column:
    """In [0, 1), from the hash of a key."""
    return F.conv(F.substring(F.md5(key), 1, DIGITS), 16, 10).cast("double") / F.lit(2.0**52)


def poisson_steps(mean: float) -> list[float]:
    """The distribution function at 0, 1, ... up to where it can't be told from 1."""
    log_p, total = -mean, math.exp(-mean)
    steps = [total]
    for k in range(1, math.ceil(mean + 12 * math.sqrt(mean) + 30) + 1):
        log_p += math.log(mean) - math.log(k)
        total += math.exp(log_p)
        steps.append(total)
    return steps


def poisson_start(mean: float) -> tuple[int, int, float]:
    """(low, high, log of the probability of low): all but about e**-70 of the distribution.

    The probabilities from low to high add up to 1. About 24 * sqrt(mean) numbers are looked at.
    """
    reach = 12 * math.sqrt(mean) + 30
    low, high = max(0, math.floor(mean - reach)), math.ceil(mean + reach)
    logs = [0.0]
    for k in range(low + 1, high + 1):
        logs.append(logs[-1] + math.log(mean) - math.log(k))
    most = max(logs)
    return low, high, -most - math.log(math.fsum(math.exp(x - most) for x in logs))


def _summed(start: Column, u: Column) -> Column:
    """How many k have a distribution function of at most ``u``, summed up from ``low`` to ``high``."""

    def step(a: Column, k: Column) -> Column:
        total = a["total"] + F.exp(a["log_p"])
        return F.struct(
            (a["log_p"] + start["log_mean"] - F.log(k + F.lit(1.0))).alias("log_p"),
            total.alias("total"),
            (a["n"] + (total <= u).cast("int")).alias("n"),
        )

    first = F.struct(start["log_p"].alias("log_p"), F.lit(0.0).alias("total"), start["low"].alias("n"))
    return F.aggregate(F.sequence(start["low"], start["high"]), first, step)["n"]


def rates(docs: DataFrame, weights: Mapping[str, float], size: int | None = None) -> dict[str, float]:
    """The repetition rate of each named source that has documents.

    What is collected has a row for each weight given at most.
    """
    if any(w <= 0 for w in weights.values()):
        raise ValueError("a target weight is above 0")
    named = docs.where(F.col("source").isin(list(weights)))
    counts = named.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.source: r.n for r in counts.collect()}
    size = sum(counts.values()) if size is None else size
    total = sum(weights.values())
    return {s: size * (weights[s] / total) / n for s, n in sorted(counts.items())}


def replicate(
    docs: DataFrame, weights: Mapping[str, float], seed: int = 0, size: int | None = None
) -> DataFrame:
    """All columns of ``docs`` for every copy, with ``copy`` (from 0) and ``shuffle_key``, shuffled.

    ``size``: documents that the named sources shall have together; as many as now if not given.
    The table of rates has at most one row for each weight given, so it is broadcast. A row of it holds
    the steps of a mean up to MOST_TABLED; of a larger one only where to start, and each document sums
    up about 24 * sqrt(mean) steps, fewer than its copies.
    """
    docs = docs.drop("copy", "shuffle_key")
    found = rates(docs, weights, size)
    of, per, start, n = fresh(docs, "rate_source", "rate_steps", "rate_start", "n_copies")
    plain = F.array(*[F.lit(x) for x in poisson_steps(1.0)])
    kind = "struct<s:string,p:array<double>,t:struct<low:int,high:int,log_p:double,log_mean:double>>"

    def row(source: str, mean: float) -> Column:
        if mean <= MOST_TABLED:
            return F.struct(F.lit(source), F.array(*[F.lit(x) for x in poisson_steps(mean)]), F.lit(None)).cast(kind)
        values = F.struct(*[F.lit(x) for x in (*poisson_start(mean), math.log(mean))])
        return F.struct(F.lit(source), F.lit(None), values).cast(kind)

    rows = [row(s, r) for s, r in found.items()]
    none = F.array().cast(f"array<{kind}>")
    one = docs.sparkSession.range(1).select(F.inline(F.array(*rows) if rows else none).alias(of, per, start))
    steps, u = F.coalesce(F.col(per), plain), uniform(_key(seed))
    tabled = F.size(F.filter(steps, lambda c: c <= u))
    copies = F.when(F.col(start).isNotNull(), _summed(F.col(start), u)).otherwise(tabled)
    return (
        docs.join(F.broadcast(one), F.col("source") == F.col(of), "left")
        .withColumn(n, copies)
        .where(F.col(n) > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
        .withColumn("shuffle_key", F.md5(F.concat(_key(seed), F.lit(":"), F.col("copy"))))
        .drop(of, per, start, n)
        .orderBy("shuffle_key", "doc_id", "copy")
    )


def replicate_sql(weights: Mapping[str, float], seed: int = 0) -> str:
    """The same in SQL that DuckDB runs, on a table ``documents``."""
    total = sum(weights.values())
    named = ", ".join(f"('{s}', CAST({w / total!r} AS DOUBLE))" for s, w in sorted(weights.items()))
    name = "coalesce(CAST(doc_id AS VARCHAR), md5(text), '')"
    return f"""
    WITH share(source, w) AS (VALUES {named}),
    sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    named AS (SELECT source, w, n, sum(n) OVER () AS total FROM share JOIN sizes USING (source)),
    rate AS (
      SELECT source, total * w / n AS mean FROM named
      UNION ALL SELECT NULL, 1.0
    ),
    p AS (
      SELECT source, mean, k,
        exp(-mean + k * ln(mean) - CASE WHEN k = 0 THEN 0 ELSE lgamma(k + 1) END) AS p
      FROM rate, LATERAL (SELECT unnest(range(0, CAST(ceil(mean + 12 * sqrt(mean) + 30) AS BIGINT) + 1)) AS k)
    ),
    steps AS (
      SELECT source, list(c ORDER BY k) AS steps FROM (
        SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM p
      ) GROUP BY source
    ),
    drawn AS (
      SELECT d.*, CAST('0x' || substr(md5('{seed}:' || {name}), 1, {DIGITS}) AS BIGINT) / 4503599627370496.0 AS u,
        coalesce(s.steps, (SELECT steps FROM steps WHERE source IS NULL)) AS steps
      FROM documents d LEFT JOIN steps s ON s.source = d.source
    ),
    copied AS (
      SELECT * EXCLUDE (u, steps),
        unnest(range(0, len(list_filter(steps, lambda c: c <= u)))) AS copy
      FROM drawn
    )
    SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
      md5('{seed}:' || {name} || ':' || copy) AS shuffle_key
    FROM copied"""
