"""Licence scan with DataFrame functions only, by a positional index of rare words.

The index holds the highest-IDF words of each template with their places. A
file's words that it holds are looked up; each posting says where in the file
the template would begin. Where enough of the template's rare words stand
around their places, and all its key phrases stand there word by word, the file
carries that licence.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefleet.llm.decontaminate import _once, words

#: Of a template's different words, so many of the highest IDF have to agree,
ANCHORS = 8
#: and one in so many of its words is looked up, at least one.
LOOKED_UP = 4
#: Agreeing words must make up this share of the IDF of all,
SHARE = 0.7
#: each at most so many words off its place.
DRIFT = 2


@dataclass(frozen=True)
class Template:
    """A licence notice as lower-case words, and the phrases that must be there word by word. A phrase template is its own only phrase and allows no drift: it's found wherever its words stand consecutively."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    phrase: bool = False

    @cached_property
    def all(self) -> list[str]:
        return self.text.split()

    @property
    def drift(self) -> int:
        return 0 if self.phrase else DRIFT

    @property
    def share(self) -> float:
        return 1.0 if self.phrase else SHARE

    @property
    def needed(self) -> tuple[str, ...]:
        return (self.text,) if self.phrase else self.keys

    @property
    def looked_up(self) -> int:
        return max(1, len(self.all) // LOOKED_UP)


#: The phrases whose places are counted, with their labels,
PHRASES = (
    Template("mit", "under the mit license", phrase=True),
    Template("apache-2", "apache license version 2", phrase=True),
    Template("cc-by-nc", "cc by nc", phrase=True),
)
#: and the usual notices of public licences.
NOTICES = (
    Template("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license", ("gnu affero general public license", "version 3")),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license version 2", "except in compliance with the license")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "conditions are met")),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Template("gpl-2", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license", ("gnu general public license", "version 2")),
    Template("gpl-3", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license", ("gnu general public license", "version 3")),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee is hereby granted")),
    Template("lgpl-3", "under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license", ("gnu lesser general public license", "version 3")),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge", "associated documentation files")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("subject to the terms of the mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)


def document_frequencies(docs: DataFrame, templates: tuple[Template, ...]) -> dict[str, int]:
    """In how many documents each of the templates' words stands, counted over all; the number of documents under the empty word. No more entries than the templates have words."""
    known = sorted({w for t in templates for w in t.all})
    found = F.array_distinct(F.filter(words(F.col("text")), lambda w: w.isin(known)))
    each = docs.select(F.explode(F.concat(F.array(F.lit("")), found)).alias("word"))
    return {r["word"]: r["n"] for r in each.groupBy("word").agg(F.count("*").alias("n")).collect()}


def index(templates: tuple[Template, ...], frequencies: dict[str, int]) -> tuple[dict, list]:
    """The postings of words that are looked up, word -> [(template, place)], and each template with its rare words."""
    n = frequencies.get("", 0)
    postings: dict[str, list] = {}
    listed = []
    for k, t in enumerate(templates):
        rare = sorted(dict.fromkeys(t.all), key=lambda w: (frequencies.get(w, 0), t.all.index(w)))[:ANCHORS]
        idf = [math.log((n + 1) / (frequencies.get(w, 0) + 1)) + 1 for w in rare]
        for w in rare[: t.looked_up]:
            postings.setdefault(w, []).extend({"template": k, "at": i} for i, x in enumerate(t.all) if x == w)
        anchors = [{"word": w, "at": t.all.index(w), "weight": x / sum(idf)} for w, x in zip(rare, idf, strict=True)]
        listed.append({"label": t.label, "phrase": t.phrase, "size": len(t.all), "drift": t.drift, "share": t.share - 1e-9, "keys": [f" {p} " for p in t.needed], "anchors": anchors})
    return postings, listed


_POSTINGS = "map<string, array<struct<template: bigint, at: int>>>"
_TEMPLATES = "array<struct<label: string, phrase: boolean, size: int, drift: int, share: double, keys: array<string>, anchors: array<struct<word: string, at: int, weight: double>>>>"
#: A candidate is one number: its template, and the place where it would begin, which may lie before the text.
_SPAN, _BEFORE = 1 << 32, 1 << 20


def _between(all_words: Column, first: Column, last: Column) -> Column:
    """Words from first to last, counted from 0; what lies outside the text is left out."""
    begin = F.greatest(first, F.lit(0))
    return F.slice(all_words, begin + 1, F.greatest(last - begin + 1, F.lit(0)))


def matches(all_words: Column, postings: dict, listed: list) -> Column:
    """Verified places of templates in a text: an array of (label, phrase, start, share)."""
    index_of = F.from_json(F.lit(json.dumps(postings)), _POSTINGS)
    templates = F.from_json(F.lit(json.dumps(listed)), _TEMPLATES)

    def candidates(hits: Column) -> Column:
        begins = lambda h: F.transform(F.element_at(index_of, h["word"]), lambda p: p["template"] * _SPAN + h["at"] - p["at"] + _BEFORE)
        return F.array_distinct(F.flatten(F.transform(hits, begins)))

    def verified(all_words: Column, t: Column, start: Column) -> Column:
        drift = t["drift"]
        there = lambda a: F.array_contains(_between(all_words, start + a["at"] - drift, start + a["at"] + drift), a["word"])
        share = F.aggregate(t["anchors"], F.lit(0.0), lambda sum, a: sum + F.when(there(a), a["weight"]).otherwise(0.0))
        around = F.concat(F.lit(" "), F.array_join(_between(all_words, start - drift, start + t["size"] - 1 + drift), " "), F.lit(" "))
        return _once(share, lambda s: F.when((s >= t["share"]) & F.forall(t["keys"], lambda k: around.contains(k)), F.struct(t["label"].alias("label"), t["phrase"].alias("phrase"), start.alias("start"), s.alias("share"))))

    def checked(all_words: Column, c: Column) -> Column:
        start = (F.pmod(c, F.lit(_SPAN)) - _BEFORE).cast("int")
        return verified(all_words, F.get(templates, F.floor(c / _SPAN).cast("int")), start)

    def scanned(w: Column) -> Column:
        rare = sorted(postings)
        hits = F.filter(F.transform(w, lambda x, i: F.when(x.isin(rare), F.struct(x.alias("word"), i.alias("at")))), lambda h: h.isNotNull())
        return F.filter(F.transform(candidates(hits), lambda c: checked(w, c)), lambda m: m.isNotNull())

    return _once(all_words, lambda w: F.struct(F.size(w).alias("n_words"), scanned(w).alias("found")))


def scan(docs: DataFrame, phrases: tuple[Template, ...] = PHRASES, notices: tuple[Template, ...] = NOTICES) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, and found, the verified places.

    Two scans, the first for the IDF of the templates' words over all documents;
    nothing but those counts is shuffled. n_base counts all places of phrases, of
    which first_word and last_word are the first and last (null: none). labels
    are those of phrases and notices; score is the greatest share of a template's
    IDF that agrees, 0 without any. Null and empty texts have no words and carry
    nothing; texts of any length are read whole; repeated rows and null ids get a
    row each; an empty table gives none; other columns aren't read. Templates are
    part of the plan: thousands at most.
    """
    templates = phrases + notices
    postings, listed = index(templates, document_frequencies(docs, templates))
    found = docs.select("doc_id", matches(words(F.col("text")), postings, listed).alias("m")).select("doc_id", F.col("m.n_words").alias("n_words"), F.col("m.found").alias("found"))
    base = F.transform(F.filter("found", lambda m: m["phrase"]), lambda m: m["start"].cast("long"))
    listed_labels = lambda kept: F.array_join(F.array_sort(F.array_distinct(F.transform(kept, lambda m: m["label"]))), ",")
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size(base).cast("long").alias("n_base"), F.array_min(base).alias("first_word"), F.array_max(base).alias("last_word"),
        listed_labels(F.filter("found", lambda m: m["phrase"])).alias("base_labels"), listed_labels(F.col("found")).alias("labels"), F.least(F.coalesce(F.array_max(F.transform("found", lambda m: m["share"])), F.lit(0.0)), F.lit(1.0)).alias("score"), "found",
    )
