"""Licence scan by a positional rare-token index, in JVM expressions only.

Base: places where the words of a phrase stand one after another. Method: the KEY_WORDS words of highest IDF (rarest among the
templates) of each template's mandatory key phrase are indexed with their positions. All of them that a file has are looked up,
wherever they stand; each occurrence votes for (template, file position - template position). Alignments with votes of two different
rare words are verified: the key phrase must stand there word for word, and the share of the template's IDF mass that stands in place
must be LEAST_COVERAGE or more. No alignment is lost: where a key phrase stands, all its rare words do, whatever else is in the file.

Everything happens inside a row: no key, group or file size gathers rows. Only texts with a marker (a substring that every template and
phrase contains one of) have their words compared; the others have no licence by construction.

Defined results: a null text is empty; a text without words has no label, score 0 and null positions; repeated rows are scanned one by one;
other columns of the input are kept, those with output names replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, lower_ascii, text_of

#: All ASCII but digits and lower-case letters parts words; here with A-Z allowed, for texts that aren't lower-cased yet.
PARTS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
KEY_WORDS = 2
LEAST_COVERAGE = 0.6

#: Label, mandatory key phrase, and notice. The usual short notices of these licences, lower-cased and without punctuation.
TEMPLATES = (
    ("gpl", "gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "gnu general public license", "this work is licensed under the gnu general public license version"),
    ("lgpl", "gnu lesser general public license", "redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "gnu affero general public license", "redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache", "apache license", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "mit license", "released under the mit license"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "with or without fee is hereby granted", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("mpl", "mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "creative commons attribution", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "cc by", "licensed under cc by 4 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("unlicense", "released into the public domain", "this is free and unencumbered software released into the public domain"),
    ("epl", "eclipse public license", "made available under the terms of the eclipse public license v 2 0"),
)
#: Every phrase, and every template's key phrase, has a word that contains one of these, or "cc" next to "by".
MARKERS = ("license", "hereby", "redistribution", "creative", "domain")
MARKER_PATTERN = r"(?i)cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by"


def file_words(text: Column) -> Column:
    return F.array_remove(F.split(text, PARTS), "")


def _index() -> tuple[dict[str, float], list[list[str]], list[tuple[int, int]]]:
    words = [t.split() for _, _, t in TEMPLATES]
    idf = {w: math.log((1 + len(words)) / (0.5 + sum(w in t for t in words))) for t in words for w in t}
    keys = []
    for t, (_, phrase, _) in zip(words, TEMPLATES, strict=True):
        key = phrase.split()
        keys.append((next(i for i in range(len(t)) if t[i : i + len(key)] == key), len(key)))
    return idf, words, keys


def _labels_of(w: Column) -> Column:
    """Array of struct(label, coverage) of the verified alignments of the words w."""
    idf, templates, keys = _index()
    # the rarest words of each key phrase, each at its first place there: a template has one posting a word, so votes are distinct
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, (ws, (first, n)) in enumerate(zip(templates, keys, strict=True)):
        for x in sorted(set(ws[first : first + n]), key=lambda x: (-idf[x], x))[:KEY_WORDS]:
            postings.setdefault(x, []).append((t, ws.index(x, first)))
    order = sorted(postings, key=lambda x: (-idf[x], x))
    table = F.array(*[F.struct(F.lit(x).alias("word"), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in postings[x]]).alias("at")) for x in order])
    texts = F.array(*[F.array(*[F.struct(F.lit(y).alias("word"), F.lit(idf[y]).alias("idf")) for y in t]) for t in templates])
    totals = F.array(*[F.lit(sum(idf[y] for y in t)) for t in templates])
    firsts, lengths = F.array(*[F.lit(k) for k, _ in keys]), F.array(*[F.lit(n) for _, n in keys])
    names = F.array(*[F.lit(label) for label, _, _ in TEMPLATES])

    own = F.array_intersect(F.array(*map(F.lit, order)), w)
    places = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("word"), i.alias("i"))), lambda h: h["word"].isin(order))

    def aligned(rare):
        entries = F.filter(table, lambda e: F.array_contains(rare, e["word"]))
        hits = F.filter(places, lambda h: F.array_contains(rare, h["word"]))
        return let(
            F.struct(entries.alias("entries"), hits.alias("hits")),
            lambda s: F.flatten(F.transform(s["entries"], lambda e: F.flatten(F.transform(F.filter(s["hits"], lambda h: h["word"] == e["word"]), lambda h: F.transform(e["at"], lambda q: F.struct(q["t"].alias("t"), (h["i"] - q["p"]).alias("d"), e["word"].alias("word"))))))),
        )

    def supported(votes):
        # two different words at one alignment: a neighbour in sorted order has the same template and offset but another word
        same = lambda s, v, k: F.coalesce((F.get(s, k)["t"] == v["t"]) & (F.get(s, k)["d"] == v["d"]), F.lit(False))
        return let(F.array_sort(votes), lambda s: F.transform(F.filter(s, lambda v, k: same(s, v, k + 1) & ~(F.when(k > 0, same(s, v, k - 1)).otherwise(False))), lambda v: F.struct(v["t"].alias("t"), v["d"].alias("d"))))

    def verified(alignments):
        def checked(a):
            text = F.get(texts, a["t"])
            in_place = lambda p, x: (a["d"] + p >= 0) & F.coalesce(F.get(w, F.greatest(a["d"] + p, F.lit(0))) == x, F.lit(False))
            mass = F.aggregate(F.transform(text, lambda e, p: F.when(in_place(p, e["word"]), e["idf"]).otherwise(0.0)), F.lit(0.0), lambda x, y: x + y)
            first = F.get(firsts, a["t"])
            key = F.forall(F.transform(text, lambda e, p: (p < first) | (p >= first + F.get(lengths, a["t"])) | in_place(p, e["word"])), lambda x: x)
            return F.struct(F.get(names, a["t"]).alias("label"), F.when(key, mass / F.get(totals, a["t"])).otherwise(0.0).alias("coverage"))

        return F.filter(F.transform(alignments, checked), lambda c: c["coverage"] >= LEAST_COVERAGE)

    return let(own, lambda rare: let(aligned(rare), lambda votes: let(supported(votes), verified)))


def _scan(w: Column) -> Column:
    def places(phrase):
        words = phrase.split()
        here = lambda i: reduce(lambda a, b: a & b, [F.coalesce(F.get(w, i + k) == x, F.lit(False)) for k, x in enumerate(words)])
        return F.filter(F.transform(w, lambda x, i: F.when(x == words[0], i)), lambda i: i.isNotNull() & here(i))

    base = F.array(*[places(p) for p, _ in PHRASES])

    def result(s):
        starts = F.flatten(s["base"])
        own = F.filter(F.array(*[F.when(F.size(s["base"][k]) > 0, F.lit(label)) for k, (_, label) in enumerate(PHRASES)]), lambda x: x.isNotNull())
        more = F.transform(s["found"], lambda c: c["label"])
        best = F.coalesce(F.array_max(F.transform(s["found"], lambda c: c["coverage"])), F.lit(0.0))
        return F.struct(
            F.size(starts).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
            F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_distinct(F.concat(own, more))), ",").alias("labels"),
            F.least(F.lit(1.0), F.greatest(best, F.when(F.size(starts) > 0, 0.5).otherwise(0.0))).alias("score"),
        )

    return let(F.struct(base.alias("base"), _labels_of(w).alias("found")), result)


OUTPUT = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with OUTPUT. score is the best verified template's coverage, and at least 0.5 where a base phrase stands."""
    t = text_of(text)
    lowered = F.lower(t)
    marked = reduce(lambda a, b: a | b, [lowered.contains(m) for m in MARKERS]) | t.rlike(MARKER_PATTERN)
    nothing = F.struct(F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"), F.lit(None).cast("long").alias("last_word"), F.lit("").alias("base_labels"), F.lit("").alias("labels"), F.lit(0.0).alias("score"))
    found = F.when(marked, let(file_words(lower_ascii(t)), _scan)).otherwise(nothing)
    out = docs.drop(*OUTPUT).withColumns({"n_words": F.size(file_words(t)).cast("long"), "__found": found})
    return out.withColumns({k: F.col(f"__found.{k}") for k in OUTPUT[1:]}).drop("__found")
