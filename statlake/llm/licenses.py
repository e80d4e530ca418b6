"""Licence scan with a positional index of rare words, in DataFrame functions alone.

Each template is indexed by the words of it that the fewest documents hold, with their places in it. A
document's places of those words, less the places in the template, give the starts at which the template
can stand; starts at which enough of the rare words agree are candidates, and a candidate counts if all
its key phrases stand there. A phrase searched for as such is a template that is its own key phrase:
each of its occurrences holds its rare words, so none is missed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rare words of a template in the index.
RARE = 6
#: Words that a key phrase may stand before or after its place in the template.
SLACK = 8

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


@dataclass(frozen=True)
class Template:
    """A notice by its words, the phrases it must have, and whether it is a base phrase."""

    label: str
    words: tuple[str, ...]
    phrases: tuple[tuple[str, ...], ...]
    base: bool = False

    @property
    def slack(self) -> int:
        return 0 if self.base else SLACK


def _template(label: str, text: str, *phrases: str) -> Template:
    return Template(label, tuple(text.split()), tuple(tuple(p.split()) for p in phrases))


def _base(label: str, text: str) -> Template:
    return Template(label, tuple(text.split()), (tuple(text.split()),), True)


# Phrases of the base labels, then short notices of well-known licences and what each must say.
TEMPLATES = (
    _base("mit", "mit license"),
    _base("apache", "apache license"),
    _base("gpl", "general public license"),
    _template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    _template(
        "bsd-3-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        "redistribution and use in source and binary forms", "conditions are met",
    ),
    _template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    _template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    _template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    _template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    _template("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license", "version 3"),
    _template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        "permission to use copy modify", "is hereby granted",
    ),
    _template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge", "without restriction",
    ),
    _template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
)


def words(text: Column) -> Column:
    """Runs of digits, letters and what is beyond ASCII, A-Z lowered; none for a null text."""
    plain = F.trim(F.translate(F.coalesce(text, F.lit("")), _UPPER + _BETWEEN, _UPPER.lower() + " " * len(_BETWEEN)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def _literal(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def document_counts(texts: DataFrame, vocabulary: Sequence[str]) -> dict[str, int]:
    """Documents that hold each word of ``vocabulary``, over all documents; one number a word."""
    found = texts.select(F.explode(F.array_intersect(_literal(sorted(vocabulary)), F.col("words"))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}


def postings(template: Template, counts: dict[str, int], rare: int = RARE) -> list[tuple[str, int]]:
    """(word, place) of the words of the template with the highest inverse document frequency, ties by word.

    Words that no document holds are the rarest: a document agrees with the template only in the others.
    """
    held = sorted(set(template.words), key=lambda w: (counts.get(w, 0), w))[:rare]
    return [(w, place) for place, w in enumerate(template.words) if w in held]


def _starts(index: Sequence[tuple[str, int]]) -> Column:
    """Sorted starts that the document's rare words give the template, one for each posting met."""

    def given(word: str, place: int) -> Column:
        return F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["place"] - place)

    return F.when(F.size("hits") > 0, F.array_sort(F.concat(*[given(w, p) for w, p in index])))


def _agreed(starts: str, size: int) -> Column:
    """The starts that at least half of the postings give: equal ones stand side by side."""
    need = (size + 1) // 2
    return F.array_distinct(F.filter(starts, lambda start, i: F.get(F.col(starts), i + (need - 1)) == start))


def _near(start: Column, phrase: tuple[str, ...], at: int, slack: int) -> Column:
    """Whether the phrase stands at place ``at`` after the start, or ``slack`` words before or after."""

    def here(d: Column) -> Column:
        place = start + at + d
        return (place >= 0) & (F.slice("words", F.greatest(place, F.lit(0)) + 1, F.lit(len(phrase))) == _literal(phrase))

    return F.exists(F.sequence(F.lit(-slack), F.lit(slack)), here)


def _place(template: Template, phrase: tuple[str, ...]) -> int:
    ends = range(len(template.words) - len(phrase) + 1)
    place = next((i for i in ends if template.words[i : i + len(phrase)] == phrase), None)
    if place is None:
        raise ValueError(f"{template.label}: key phrase {' '.join(phrase)} is not in the template")
    return place


def _stands(template: Template, start: Column) -> Column:
    """Whether all key phrases stand near their places."""
    return reduce(Column.__and__, [_near(start, p, _place(template, p), template.slack) for p in template.phrases])


def _share(template: Template, start: Column) -> Column:
    """The part of the template's words that stand at their very places; it may begin before the text does."""
    held = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.lit(len(template.words)))
    own = F.slice(_literal(template.words), F.greatest(-start, F.lit(0)) + 1, F.lit(len(template.words)))
    same = F.filter(F.zip_with(held, own, lambda a, b: a == b), lambda x: x)
    return F.size(same) / F.lit(len(template.words))


def _match(template: Template, start: Column) -> Column:
    return F.struct(
        F.lit(template.label).alias("label"), F.lit(template.base).alias("base"), start.cast("bigint").alias("start"),
        F.lit(len(template.words)).alias("n_words"), _share(template, start).alias("share"),
    )


def _matches(template: Template, starts: str) -> Column:
    stood = F.filter(starts, lambda start: _stands(template, start))
    return F.transform(stood, lambda start: _match(template, start))


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words and matches of every row: label, base, start, n_words, share.

    One match for each place at which a template stands. The texts are read twice, once for the counts;
    after that a document is looked up, intersected and verified in its own row, without a shuffle.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words(F.col("`text`")).alias("words"))
    counts = document_counts(texts, {w for t in templates for w in t.words})
    index = [postings(t, counts) for t in templates]
    rare = sorted({w for own in index for w, _ in own if counts.get(w)})
    placed = F.transform("words", lambda w, i: F.struct(i.alias("place"), w.alias("word")))
    hits = F.filter(placed, lambda h: h["word"].isin(rare)) if rare else F.array().cast("array<struct<place:int,word:string>>")
    met = texts.withColumn("hits", hits)
    met = met.withColumns({f"s{t}": _starts(own) for t, own in enumerate(index)})
    met = met.withColumns({f"s{t}": _agreed(f"s{t}", len(own)) for t, own in enumerate(index)})
    found = [_matches(template, f"s{t}") for t, template in enumerate(templates)]
    none = F.array().cast("array<struct<label:string,base:boolean,start:bigint,n_words:int,share:double>>")
    return met.select("doc_id", F.size("words").cast("bigint").alias("n_words"), F.when(F.size("hits") > 0, F.concat(*found)).otherwise(none).alias("matches"))


def report(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row of ``docs``.

    A null or empty text has no words, no labels (empty texts) and score 0; rows without id and repeated
    rows each appear; an empty table gives an empty result, and other columns are ignored. The score is the
    largest share of a template's words that stand at their places, 1 for a base phrase.
    """
    def labels(of: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(of)), ",")

    found = scan(docs, templates).withColumn("places", F.filter("matches", lambda m: m["base"]))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(F.col("places.start")).alias("first_word"), F.array_max(F.col("places.start")).alias("last_word"),
        labels(F.col("places.label")).alias("base_labels"), labels(F.col("matches.label")).alias("labels"),
        F.coalesce(F.array_max(F.col("matches.share")), F.lit(0.0)).alias("score"),
    )
