"""Licence notices by a positional index of rare template words. DataFrame and SQL only.

Every licence has a few notices (``TEMPLATES``), each with a key phrase that must stand in the text. The words
of the notices are weighed by their inverse document frequency over the whole corpus; a notice is indexed by
the ``RARE`` highest-IDF words of its key phrase, with their places. A text looks up the indexed words that it
holds; the places of each, less the word's place in a notice, are where that notice may start, and the starts
that all of the notice's indexed words agree on are verified: the key phrase must stand at its place, and the
share of notice words that stand at theirs must reach ``LEAST``. The best share is the score.

The base phrases are counted besides, in every text, and keep their labels. A text is one row throughout, so no
row moves; only the frequencies of the notices' words (at most as many as the notices have) reach the driver.
Null text counts as empty and has no labels; repeated rows are scanned each; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: base phrases and labels
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# fixed values: label, notice, key phrase
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby granted free of charge"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0-1.0", "released under cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "this program is licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license", "gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)

#: indexed words of a notice, the rarest of its key phrase
RARE = 3
#: least share of a notice's words that stand at their places
LEAST = 0.5
_LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text in lower case (A-Z only). Null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), *_LETTERS)
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def _words(docs: DataFrame) -> DataFrame:
    # exploding a one-element array keeps the optimiser from working the split out once per use
    return docs.select("doc_id", F.explode(F.array(words_of(F.col("text")))).alias("words"))


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(value) for value in values])


def word_weights(docs: DataFrame) -> dict[str, float]:
    """Inverse document frequency of every notice word, over all texts."""
    vocabulary = sorted({word for _, notice, _ in TEMPLATES for word in notice.split()})
    held = _words(docs).select(F.explode(F.array_append(F.array_intersect("words", _array(vocabulary)), F.lit(""))).alias("word"))
    counts = {row["word"]: row["n"] for row in held.groupBy("word").agg(F.count("*").alias("n")).collect()}  # as many as the vocabulary at most
    texts = counts.get("", 0)
    return {word: math.log((texts + 1) / (counts.get(word, 0) + 0.5)) for word in vocabulary}


def index(weights: dict[str, float]) -> list[dict]:
    """For every notice: its words, its key phrase with the phrase's place, and its rarest key words with their places."""
    out = []
    for label, notice, phrase in TEMPLATES:
        words, key = notice.split(), phrase.split()
        place = next(k for k in range(len(words)) if words[k : k + len(key)] == key)
        rarest = sorted(set(key), key=lambda word: (-weights[word], word))[:RARE]
        out.append({"label": label, "words": words, "key": key, "place": place, "rare": [(word, place + key.index(word)) for word in rarest]})
    return out


def _phrase_places(phrase: str) -> Column:
    """Starts of all places where the phrase's words stand consecutively."""
    parts = phrase.split()
    test = " and ".join(f"get(words, i + {k}) = '{word}'" for k, word in enumerate(parts))
    held = " and ".join(f"array_contains(words, '{word}')" for word in parts)
    return F.expr(f"if({held}, filter(sequence(0, size(words) - 1), i -> {test}), cast(array() as array<int>))")


def _quoted(words: list[str]) -> str:
    return f"array({', '.join(repr(word) for word in words)})"


def _one(name: str, value: str, body: str) -> str:
    """SQL for ``body`` where ``name`` stands for ``value``, worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _notices(weights: dict[str, float]) -> str:
    """SQL: (label, share) of every notice found in ``words``.

    The text's indexed words are looked up once each. A notice's starts are the intersection, over its rare
    words, of the word's places less its place in the notice.
    """
    entries = index(weights)
    ranked = sorted({word for entry in entries for word, _ in entry["rare"]}, key=lambda word: (-weights[word], word))
    places = f"map_from_entries(transform(array_intersect({_quoted(ranked)}, words), w -> struct(w, filter(sequence(0, size(words) - 1), i -> get(words, i) = w))))"
    rows = []
    for entry in entries:
        rare = ", ".join(f"named_struct('w', {word!r}, 'p', {place})" for word, place in entry["rare"])
        rows.append(f"named_struct('label', {entry['label']!r}, 'words', {_quoted(entry['words'])}, 'key', {_quoted(entry['key'])}, 'place', {entry['place']}, 'rare', array({rare}))")
    moved = "transform(coalesce(try_element_at(m, get(n.rare, k).w), cast(array() as array<int>)), i -> i - get(n.rare, k).p)"
    starts = f"aggregate(sequence(0, size(n.rare) - 1), cast(array() as array<int>), (a, k) -> if(k = 0, {moved}, array_intersect(a, {moved})))"
    share = "size(filter(sequence(0, size(n.words) - 1), k -> get(words, at + k) = get(n.words, k))) / cast(size(n.words) as double)"
    phrased = "at + n.place >= 0 and slice(words, at + n.place + 1, size(n.key)) = n.key"
    best = f"array_max(transform(filter({starts}, at -> {phrased}), at -> {share}))"
    found = f"transform(array({', '.join(rows)}), n -> named_struct('label', n.label, 'share', {best}))"
    matched = _one("m", places, f"filter({found}, v -> v.share >= {LEAST})")
    return f"if(arrays_overlap(words, {_quoted(ranked)}), {matched}, cast(array() as array<struct<label:string,share:double>>))"


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every text. Two passes, no shuffle of texts."""
    weights = word_weights(docs)
    places = [_phrase_places(phrase).alias(f"_p{k}") for k, phrase in enumerate(BASE)]
    found = _words(docs).select("doc_id", F.size("words").cast("long").alias("n_words"), *places, F.expr(_notices(weights)).alias("found"))
    every = F.array_sort(F.concat(*[f"_p{k}" for k in range(len(BASE))]))
    base = F.concat(*[F.when(F.size(f"_p{k}") > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>")) for k, label in enumerate(BASE.values())])
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    out = found.select("doc_id", "n_words", "found", every.alias("places"), base.alias("base"))
    return out.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.get("places", F.lit(0)).cast("long").alias("first_word"),
        F.when(F.size("places") > 0, F.element_at("places", -1)).cast("long").alias("last_word"),
        joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", F.col("found.label"))).alias("labels"),
        F.greatest(F.coalesce(F.array_max("found.share"), F.lit(0.0)), F.when(F.size("base") > 0, 1.0).otherwise(0.0)).alias("score"),
    )
