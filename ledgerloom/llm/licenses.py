"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

A template is a license's notice, a set of words. A block is a line with the line after it, or a
window over the words of the whole text, across line breaks and blank lines: as many words as the
template has, repeats counted, divided by ``threshold``, and ``slack`` more for comment marks and
filled-in names. A block
matches a template if it holds at least ``threshold`` of the template's words. Words that no
template has can't count, so blocks are cut to template words; these are ordered by how many texts
of the corpus they are in, rarest first. If a block matches, then

* it shares a word of the template's prefix, the first ``size - needed + 1`` words (prefix filter);
* it has at least ``needed`` template words (length filter);
* after the first word they share, both have enough words left (positional filter).

Pairs that pass are verified. Only the join on prefix words makes pairs, never all blocks with all
templates. A text is cut into words once, and into blocks if it holds enough words of a template as a
whole, without which no block of it does; every block of such a text is looked at. Windows are looked
at in texts that match as a whole, which is a block of its own in the join: an occurrence of a word counts for the window starts from which it
is reached and no earlier occurrence is meant, so the running sum over the ends of these ranges is the
number of distinct words in every window.

Null and empty texts have no words. Repeated rows are scanned alike. An empty table gives an empty
result. Words beyond ASCII are folded to lower case too, which no phrase and no template has.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import GAP_PATTERN, WORD
from ledgerloom.session import materialise

#: Phrases and the labels they stand for.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Notices and their labels; a parameter of the scan.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "You can redistribute it under the terms of the GNU General Public License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "All rights reserved."),
)
THRESHOLD = 0.8
#: Words that a window has beside those of a template; and the line of a block that is a whole text.
SLACK = 16
WHOLE = -1


def words(text: Column) -> Column:
    """Cut at what is no word, which takes a third of the time of extracting words."""
    return F.array_remove(F.split(F.lower(text), GAP_PATTERN), "")


def _template_words(text: str) -> list[str]:
    return [w.decode() for w in WORD.findall(text.lower().encode())]


def _distinct(text: str) -> list[str]:
    return sorted(set(_template_words(text)))


def _needed(size: int, threshold: float) -> int:
    return math.ceil(threshold * size - 1e-9)


def _vocabulary(templates: Sequence[tuple[str, str]]) -> list[str]:
    return sorted({w for _, t in templates for w in _distinct(t)})


def word_ranks(parsed: DataFrame, templates: Sequence[tuple[str, str]]) -> dict[str, int]:
    """Template words by the number of texts that hold them (``known``), rarest first; ties by the word."""
    found = parsed.select(F.explode("known").alias("w"))
    known = {r.w: r.n for r in found.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: i for i, w in enumerate(sorted(_vocabulary(templates), key=lambda w: (known.get(w, 0), w)))}


def _enough(known: Column, templates: Sequence[tuple[str, str]], threshold: float) -> Column:
    """Whether a text that holds the template words ``known`` matches a template as a whole."""
    wanted = F.array(
        *[
            F.struct(F.lit(_needed(len(o), threshold)).alias("needed"), F.array(*map(F.lit, o)).alias("template"))
            for o in (_distinct(t) for _, t in templates)
            if o
        ]
    )
    return F.exists(wanted, lambda t: F.size(F.array_intersect(t["template"], known)) >= t["needed"])


def _blocks(text: Column, cut: Column, known: Column, vocabulary: Column) -> Column:
    """(blocks, hits) of a text, the words as places in ``vocabulary``, from 1.

    ``blocks``: words of the whole text and of each line and the next one; ``hits``: place of each template word.
    """

    def number(w: Column) -> Column:
        return F.array_position(vocabulary, w).cast("int")

    lines = F.transform(
        F.split(text, "\n"), lambda line: F.transform(F.array_intersect(words(line), known), number)
    )

    def both(ls: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(0), F.size(ls) - 1),
            lambda i: F.struct(
                i.alias("line"),
                F.array_union(F.get(ls, i), F.coalesce(F.get(ls, i + 1), F.array().cast("array<int>"))).alias("words"),
            ),
        )
        whole = F.struct(F.lit(WHOLE).alias("line"), F.transform(known, number).alias("words"))
        return F.concat(F.array(whole), pairs)

    hits = F.transform(
        cut, lambda w, i: F.struct(i.alias("at"), F.when(F.array_contains(known, w), number(w)).alias("word"))
    )
    return F.struct(
        F.transform(F.array(lines), both)[0].alias("blocks"),
        F.filter(hits, lambda h: h["word"].isNotNull()).alias("hits"),
    )


def _ranked(ranks: dict[str, int]) -> tuple[Column, Column]:
    """``blocks`` and ``hits`` with the ranks of their words; those of a block are sorted."""
    by_number = F.array(*[F.lit(ranks[w]) for w in sorted(ranks)])
    blocks = F.transform(
        "blocks",
        lambda b: F.struct(
            b["line"].alias("line"),
            F.array_sort(F.transform(b["words"], lambda w: F.element_at(by_number, w))).alias("ranks"),
        ),
    )
    hits = F.transform(
        "hits", lambda h: F.struct(h["at"].alias("at"), F.element_at(by_number, h["word"]).alias("rank"))
    )
    return blocks, hits


def _best_window(hits: Column, template: Column, width: Column) -> Column:
    """(best, word): the most distinct template words in ``width`` words, and the first such start."""
    mine = F.filter(hits, lambda h: F.array_contains(template, h["rank"]))
    by_word = F.array_sort(F.transform(mine, lambda h: F.struct(h["rank"].alias("rank"), h["at"].alias("at"))))

    def ends(found: Column) -> Column:
        def of(h: Column, i: Column) -> Column:
            before, reach = F.get(found, i - 1), h["at"] - width + 1
            start = F.when(before["rank"] == h["rank"], F.greatest(before["at"] + 1, reach)).otherwise(reach)
            return F.array(
                F.struct(start.alias("at"), F.lit(1).alias("by")),
                F.struct((h["at"] + 1).alias("at"), F.lit(-1).alias("by")),
            )

        return F.array_sort(F.flatten(F.transform(found, of)))

    def step(a: Column, e: Column) -> Column:
        now = a["now"] + e["by"]
        return F.struct(
            now.alias("now"),
            F.greatest(now, a["best"]).alias("best"),
            F.when(now > a["best"], F.greatest(e["at"], F.lit(0))).otherwise(a["word"]).alias("word"),
        )

    first = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"), F.lit(0).alias("word"))
    return F.transform(F.array(by_word), lambda found: F.aggregate(ends(found), first, step))[0]


def _phrase_places(text: Column, cut: Column) -> Column:
    """(start, label) of each place where a phrase's words stand consecutively in ``cut``, the text's words."""

    def places(found: Column) -> Column:
        def at(i: Column) -> Column:
            out = F.lit(None).cast("string")
            for phrase, label in PHRASES.items():
                same = [F.get(found, i + j) == w for j, w in enumerate(phrase.split())]
                hit = same[0]
                for s in same[1:]:
                    hit = hit & s
                out = F.when(hit, F.lit(label)).otherwise(out)
            return out

        starts = F.transform(
            F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.struct(i.alias("start"), at(i).alias("label"))
        )
        return F.filter(starts, lambda s: s["label"].isNotNull())

    none = F.array().cast("array<struct<start:int,label:string>>")
    phrase = "(?i)license"
    return F.when(text.rlike(phrase), places(cut)).otherwise(none)


def template_matches(
    parsed: DataFrame,
    templates: Sequence[tuple[str, str]],
    ranks: dict[str, int],
    threshold: float,
    slack: int = SLACK,
) -> DataFrame:
    """(row, line, label, containment, needed, width, template) of every block that matches a template.

    ``parsed``: row and blocks; ``width``: words of a window for the template. Of the words that a block shares with a template only the first one
    makes a pair, so each pair is made once.
    """
    rows = []
    for label, text in templates:
        order = sorted(ranks[w] for w in _distinct(text))
        needed = _needed(len(order), threshold)
        width = math.ceil(len(_template_words(text)) / threshold) + slack
        for place, rank in enumerate(order[: len(order) - needed + 1]):
            values = {"rank": rank, "label": label, "place": place, "needed": needed, "width": width}
            columns = [F.lit(v).alias(c) for c, v in values.items()]
            rows.append(F.struct(*columns, F.array(*[F.lit(r) for r in order]).alias("template")))
    # A row for each prefix word of each template given: small whatever the corpus.
    prefixes = parsed.sparkSession.range(1).select(F.inline(F.array(*rows)))
    blocks = parsed.select("row", F.explode("blocks").alias("b")).select("row", "b.line", "b.ranks")
    words_ = blocks.select("*", F.posexplode("ranks").alias("at", "rank"))
    left = F.least(F.size("template") - F.col("place"), F.size("ranks") - F.col("at"))
    shared = F.array_intersect("template", "ranks")
    return (
        words_.join(F.broadcast(prefixes), "rank")
        .where(F.size("ranks") >= F.col("needed"))
        .where(left >= F.col("needed"))
        .where((F.element_at(shared, 1) == F.col("rank")) & (F.size(shared) >= F.col("needed")))
        .select(
            "row", "line", "label", (F.size(shared) / F.size("template")).alias("containment"),
            "needed", "width", "template",
        )
    )


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    slack: int = SLACK,
) -> DataFrame:
    """(doc_id, n_words, places, matches, notices) of every row.

    ``places``: (start word, label) of phrases; ``matches``: (line, label, containment) of two-line
    blocks; ``notices``: (start word, label, containment) of each template's best window that matches.
    """
    if not 0 < threshold <= 1:
        raise ValueError("a threshold is above 0 and at most 1")
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    vocabulary = F.array(*[F.lit(w) for w in _vocabulary(templates)])
    text, cut, known = F.col("text"), F.col("cut"), F.col("known")
    parsed = docs.select(F.monotonically_increasing_id().alias("row"), "*", words(text).alias("cut"))
    parsed = parsed.select("*", F.array_intersect(cut, vocabulary).alias("known"))
    found = F.when(_enough(known, templates, threshold), _blocks(text, cut, known, vocabulary))
    parsed = parsed.select(
        "row", "doc_id", F.size(cut).alias("n_words"), "known",
        _phrase_places(text, cut).alias("places"), found.alias("found"),
    )
    parsed = materialise(parsed, "blocks")
    ranks = word_ranks(parsed, templates)
    blocks, hits = _ranked(ranks)
    parsed = parsed.select("row", "doc_id", "n_words", "places", "found.*").withColumns({"blocks": blocks, "hits": hits})
    pairs = template_matches(parsed, templates, ranks, threshold, slack)
    whole = F.col("line") == WHOLE
    found = pairs.groupBy("row").agg(
        F.sort_array(F.collect_set(F.when(~whole, F.struct("line", "label", "containment")))).alias("matches"),
        F.collect_set(F.when(whole, F.struct("label", "needed", "width", "template"))).alias("wanted"),
    )

    def notice(t: Column) -> Column:
        return F.transform(
            F.array(_best_window(F.col("hits"), t["template"], t["width"])),
            lambda b: F.when(
                b["best"] >= t["needed"],
                F.struct(
                    b["word"].alias("word"), t["label"].alias("label"),
                    (b["best"] / F.size(t["template"])).alias("containment"),
                ),
            ),
        )[0]

    notices = F.sort_array(F.filter(F.transform("wanted", notice), lambda n: n.isNotNull()))
    none = F.array().cast("array<struct<line:int,label:string,containment:double>>")
    nothing = F.array().cast("array<struct<word:int,label:string,containment:double>>")
    return parsed.join(found, "row", "left").select(
        "doc_id", F.col("n_words").cast("long"), "places", F.coalesce("matches", none).alias("matches"),
        F.coalesce(notices, nothing).alias("notices"),
    )
