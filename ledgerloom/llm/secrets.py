"""Secrets found by patterns and by tests of randomness.

Three kinds are found by pattern: assignments of a secret, access keys, long hexadecimal strings. A
fourth kind, ``random``, is a long run of letters, digits and ``+/_-`` that looks like the text
form of random bytes; ``=`` belongs to it as padding at the end alone, so a value is apart from its
name. Every run with letters and digits has an encoding (hexadecimal, base 32, base 36, base 38 with
two marks, base 64; all but the last in either case); three tests then ask
whether its symbols are random: chi-squared for uniform use of the alphabet, runs above and below
the middle symbol, and correlation of neighbouring symbols. Together they give a p-value of a
random string being as odd. Over the corpus, strings that are not random are told by the
Benjamini-Hochberg rule, apart for each encoding and class of length, since the tests of longer
strings have more power; what isn't rejected is reported, unless a pattern's match covers it.

Time grows with the length of a text and of a run, and with n log n of the matches in it, not with
their squares. Positions are code points. Null and empty texts have no secrets; repeated rows are scanned alike and
count as often as they are there. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_HINT = r"(?i)password|passwd|secret|token|api_?key"
ASSIGN_LEAST = 6
# Of the runs that these patterns describe only the long ones count, so they ask for the length.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
# Of 16 symbols with the letter frequencies of prose the tests reject about half in base 32 and 36 and
# four fifths in base 64, so they still tell words from random text; of shorter ones ever fewer.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,6}"
#: Alphabets of the encodings, and classes of length: whole binary logarithms, the last one open;
#: lengths under 24 are a class of their own.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base38": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ+/",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
SHORT_CLASS, LONGEST_CLASS = 3, 16
FALSE_DISCOVERY = 0.05
#: P-values are rounded up to steps of a tenth of a decade, so their distribution is a small table.
STEPS, LAST_STEP = 10, 3000
MARK = "[secret]"
#: Code points of the blocks that a text is cut from.
BLOCK = 4096


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


#: Distances of running values: a value that has taken in the 2^k before it takes in as many more.
_POWERS = [1 << k for k in range(31)]


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running ``join`` of an array by doubling: n log n steps, where appending would copy n^2 / 2."""

    def double(a: Column, p: Column) -> Column:
        return F.transform(a, lambda x, i: F.coalesce(join(x, F.get(a, i - p)), x))

    return _let(
        values,
        lambda v: F.aggregate(
            F.filter(F.array(*[F.lit(p) for p in _POWERS]), lambda p: p < F.size(v)), v, double
        ),
    )


def _larger(x: Column, before: Column) -> Column:
    return F.when(before.isNotNull(), F.greatest(x, before))


def _places(text: Column, pattern: str) -> Column:
    """(start, end, match) of the matches, from the lengths of matches and of what stands between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def walk(matches: Column, gaps: Column) -> Column:
        steps = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))

        def place(m: Column, end: Column) -> Column:
            return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"))

        return F.zip_with(matches, _running(steps, lambda x, before: x + before), place)

    return _let(found, lambda m: _let(between, lambda g: walk(m, g)))


def _spans(kind: str, places: Column) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(
        places, lambda p: F.struct(p["start"].alias("start"), number.alias("kind"), p["end"].alias("end"))
    )


def _none() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int>>")


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, by start and kind."""
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    assigned = _let(
        values,
        lambda v: F.filter(
            _spans("assign", _places(text, ASSIGN)),
            lambda _, i: F.length(F.get(v, i)) >= ASSIGN_LEAST,
        ),
    )
    parts = [
        F.when(text.rlike(ASSIGN_HINT), assigned).otherwise(_none()),
        F.when(F.contains(text, F.lit("AKIA")), _spans("access", _places(text, ACCESS))).otherwise(_none()),
        F.when(text.rlike(HEX), _spans("hex", _places(text, HEX))).otherwise(_none()),
    ]
    return F.array_sort(F.concat(*parts))


def _encoding(run: Column) -> Column:
    body = F.rtrim(run, F.lit("="))
    letters, digits = r"[A-Za-z]", r"[0-9]"
    mixed = body.rlike(letters) & body.rlike(digits)
    both = body.rlike("[a-z]") & body.rlike("[A-Z]")
    return (
        F.when(mixed & body.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(mixed & body.rlike("^([A-Z2-7]+|[a-z2-7]+)$"), "base32")
        .when(mixed & body.rlike("^([A-Z0-9]+|[a-z0-9]+)$"), "base36")
        .when(mixed & both, "base64")
        .when(mixed, "base38")
    )


def _by_encoding(encoding: Column, values: dict[str, object]) -> Column:
    first, *others = values
    start = F.when(encoding == first, F.lit(values[first]))
    return reduce(lambda c, e: c.when(encoding == e, F.lit(values[e])), others, start)


def _plain(run: Column, encoding: Column) -> Column:
    """The symbols of a run as its alphabet writes them."""
    body = F.translate(F.rtrim(run, F.lit("=")), "-_", "+/")
    return F.when(encoding == "hex", F.lower(body)).when(encoding == "base64", body).otherwise(F.upper(body))


def _codes(plain: Column, encoding: Column) -> Column:
    """Places of the symbols in the alphabet, from 1."""
    alphabet = _by_encoding(encoding, ALPHABETS)
    return F.transform(F.split(plain, ""), lambda c: F.position(c, alphabet))


def _erfc(x: Column) -> Column:
    """The complementary error function of x >= 0 by the usual polynomial in 1 / (1 + cx)."""
    t = 1 / (1 + 0.3275911 * x)
    weights = (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592)
    poly = reduce(lambda a, w: a * t + F.lit(w), weights, F.lit(0.0))
    return poly * t * F.exp(-x * x)


def _p_value(plain: Column, codes: Column, encoding: Column) -> Column:
    """Of three tests together, each a standard normal under randomness: chi-squared of degree 3."""
    size = _by_encoding(encoding, {e: float(len(a)) for e, a in ALPHABETS.items()})
    n = F.size(codes).cast("double")
    # How often a symbol occurs is what goes with it.
    squares = _sum(
        F.transform(
            F.split(_by_encoding(encoding, ALPHABETS), ""),
            lambda a: F.pow((F.size(codes) - F.length(F.replace(plain, a, F.lit("")))).cast("double"), F.lit(2.0)),
        )
    )
    uniform = (squares * size / n - n - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
    uniform = F.greatest(uniform, F.lit(0.0))

    def runs(high: Column) -> Column:
        up = _sum(F.transform(high, lambda h: h.cast("double")))
        down = n - up
        least, mean = F.lit(1e-9), 2 * up * down / n
        changes = _sum(
            F.transform(
                F.sequence(F.lit(0), F.size(high) - 2),
                lambda i: (F.get(high, i) != F.get(high, i + 1)).cast("double"),
            )
        )
        return (changes - mean) / F.sqrt(F.greatest(mean * (mean - 1) / (n - 1), least))

    def serial(centred: Column) -> Column:
        spread = _sum(F.transform(centred, lambda x: x * x))
        products = _sum(
            F.transform(
                F.sequence(F.lit(0), F.size(centred) - 2), lambda i: F.get(centred, i) * F.get(centred, i + 1)
            )
        )
        return (products / F.greatest(spread, F.lit(1e-9)) + 1 / n) * F.sqrt(n)

    mean = _sum(F.transform(codes, lambda c: c.cast("double"))) / n
    centred = _let(mean, lambda m: F.transform(codes, lambda c: c - m))
    middle = (size / 2).cast("int")
    tests = F.array(
        uniform,
        _let(F.transform(codes, lambda c: c > middle), runs),
        _let(centred, serial),
    )
    total = _sum(F.transform(tests, lambda z: z * z))
    return _let(total, lambda x: _erfc(F.sqrt(x / 2)) + F.sqrt(2 * x / 3.141592653589793) * F.exp(-x / 2))


def random_runs(text: Column) -> Column:
    """(start, end, encoding, length class, step of the p-value) of every run with an encoding."""

    def tested(place: Column) -> Column:
        run = place["match"]

        def row(encoding: Column) -> Column:
            p = _let(
                _plain(run, encoding),
                lambda own: _let(_codes(own, encoding), lambda c: _p_value(own, c, encoding)),
            )
            step = F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * STEPS), F.lit(LAST_STEP))
            symbols = F.length(F.rtrim(run, F.lit("=")))
            length = F.least(F.floor(F.log2(symbols)), F.lit(LONGEST_CLASS))
            length = F.when(symbols < 24, F.lit(SHORT_CLASS)).otherwise(length)
            return F.struct(
                place["start"].alias("start"), place["end"].alias("end"), encoding.alias("encoding"),
                length.cast("int").alias("length"),
                F.when(encoding.isNotNull(), F.greatest(step, F.lit(0)).cast("int")).alias("step"),
            )

        return _let(_encoding(run), row)

    found = F.filter(F.transform(_places(text, RUN), tested), lambda r: r["encoding"].isNotNull())
    none = F.array().cast("array<struct<start:int,end:int,encoding:string,length:int,step:int>>")
    return F.when(text.rlike(RUN), found).otherwise(none)


def thresholds(docs: DataFrame, level: float = FALSE_DISCOVERY) -> dict[tuple[str, int], int]:
    """The least step at which a run of an encoding and length class is not random.

    The Benjamini-Hochberg rule: the largest p-value that is at most ``level`` times the share of
    runs up to it. What is collected has a row for each encoding, class and step at most, whatever
    the size of the corpus.
    """
    runs = docs.select(F.explode(random_runs(F.col("text").cast("string"))).alias("r"))
    counts = runs.groupBy("r.encoding", "r.length", "r.step").agg(F.count(F.lit(1)).alias("n"))
    by_class: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for r in counts.collect():
        by_class.setdefault((r.encoding, r.length), []).append((r.step, r.n))
    out = {}
    for kind, steps in by_class.items():
        total, below = sum(n for _, n in steps), 0
        for step, n in sorted(steps, reverse=True):
            below += n
            if 10.0 ** (-step / STEPS) <= level * below / total:
                out[kind] = step
    return out


def with_spans(
    docs: DataFrame,
    level: float = FALSE_DISCOVERY,
    names: tuple[str, str] = ("base_spans", "random_spans"),
) -> DataFrame:
    """All rows of ``docs`` with base and random spans; columns of these names are replaced.

    A span is (start, kind, end), the kind as its place in KINDS.
    """
    limits = thresholds(docs, level)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def rejected(run: Column) -> Column:
        found = F.lit(LAST_STEP + 1)
        for (encoding, length), step in sorted(limits.items()):
            found = F.when((run["encoding"] == encoding) & (run["length"] == length), F.lit(step)).otherwise(found)
        return run["step"] >= found

    number = F.lit(KINDS.index("random"))
    plain = docs.drop(*names).withColumn(names[0], base_spans(text))
    base = F.col(names[0])

    def kept_runs(starts: Column, tops: Column) -> Column:
        """Runs that no base span covers: of the spans that start before, one ends last."""
        def covered(r: Column) -> Column:
            before = F.aggregate(
                F.filter(F.array(*[F.lit(p) for p in reversed(_POWERS)]), lambda p: p <= F.size(starts)),
                F.lit(0),
                lambda a, p: F.when(F.get(starts, a + p - 1) <= r["start"], a + p).otherwise(a),
            )
            return F.coalesce(F.get(tops, before - 1) >= r["end"], F.lit(False))

        return F.filter(random_runs(text), lambda r: ~rejected(r) & ~covered(r))

    kept = _let(
        F.transform(base, lambda b: b["start"]),
        lambda starts: _let(
            _running(F.transform(base, lambda b: b["end"]), _larger), lambda tops: kept_runs(starts, tops)
        ),
    )
    spans = F.transform(
        kept, lambda r: F.struct(r["start"].alias("start"), number.alias("kind"), r["end"].alias("end"))
    )
    return plain.withColumn(names[1], spans)


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(
        ",",
        F.transform(
            F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
    )


def redact(docs: DataFrame, mark: str = MARK, level: float = FALSE_DISCOVERY) -> DataFrame:
    """``docs`` with every span replaced by ``mark``, overlapping ones by one; n_chars follows.

    Rows without a secret stay as they are, null texts too.
    """
    base, random, new = fresh(docs, "base_spans", "random_spans", "new_text")
    found = with_spans(docs, level, (base, random))
    spans = F.array_sort(F.concat(base, random))
    text = F.col("text")

    def piece(blocks: Column, start: Column, end: Column) -> Column:
        """Part of the text, without walking there from its beginning."""
        first = F.floor(start / BLOCK)
        joined = F.array_join(F.slice(blocks, first + 1, F.floor(end / BLOCK) - first + 1), "")
        return F.substr(joined, (start - first * BLOCK + 1).cast("int"), (end - start).cast("int"))

    def cut(own: Column, tops: Column, blocks: Column) -> Column:
        """What stands before each span that begins behind all spans before it, and after the last."""
        def before(s: Column, i: Column) -> Column:
            at = F.coalesce(F.get(tops, i - 1), F.lit(0))
            return F.when(s["start"] >= at, F.concat(piece(blocks, at, s["start"]), F.lit(mark)))

        parts = F.array_join(F.transform(own, before), "")
        return F.concat(parts, piece(blocks, F.get(tops, F.size(tops) - 1), F.length(text)))

    whole = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    redacted = _let(
        spans,
        lambda own: _let(
            _running(F.transform(own, lambda s: s["end"]), _larger),
            lambda tops: _let(whole, lambda blocks: cut(own, tops, blocks)),
        ),
    )
    found = found.withColumn(new, F.when(F.size(base) + F.size(random) > 0, redacted))
    columns = [
        F.coalesce(new, "text").alias(c) if c == "text"
        else F.coalesce(F.length(new).cast("long"), F.col(c)).alias(c) if c == "n_chars"
        else F.col(c)
        for c in docs.columns
    ]
    return found.select(*columns)
