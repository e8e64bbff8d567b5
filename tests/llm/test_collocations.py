"""Collocations against a plain count of every phrase."""

import re
from collections import Counter

import pytest

from sentrail.llm import collocations


def _pieces(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def _counts(rows):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in _pieces(text):
            totals[lang] += len(words)
            counts.update((lang, tuple(words[k : k + size])) for size in range(1, 5) for k in range(len(words) - size + 1))
    return counts, totals


def _inside(phrase, longer):
    return any(longer[k : k + len(phrase)] == phrase for k in range(len(longer) - len(phrase) + 1))


def _brute_force(rows, top, least):
    counts, totals = _counts(rows)
    frequent = [(lang, words, n) for (lang, words), n in counts.items() if n >= least and len(words) > 1]
    out = []
    for lang in totals:
        mine = [(words, n) for of, words, n in frequent if of == lang]
        scored = []
        for words, a in mine:
            if any(len(longer) > len(words) and _inside(words, longer) and 100 * n >= 80 * a for longer, n in mine):
                continue
            cuts = [(2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(words).encode(), " ".join(words), a, counts[lang, words[:k]], counts[lang, words[k:]], totals[lang], score))
        out += [(lang, rank, *row[3:]) for rank, row in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


ODD = [
    ("en", "New York, new york. NEW YORK; of the of the of the"),
    ("en", "of the new york of the\nnew york of the new"),
    ("en", "of the of the"),
    ("en", "of the of the"),
    (None, "a b a b a b"),
    ("und", "a b! b a"),
    ("und", "a\tb  a b\x0ca b"),
    ("", "x x x x x"),
    ("fr", None),
    ("fr", ""),
    ("fr", ".,;:!?\r\n"),
    ("fr", "é日 本x é日 本x é日 本x é日 本x"),
    ("de", "w" * 5000 + " " + "w" * 5000),
    ("de", "lang prefix next n " * 30),
]


@pytest.mark.parametrize(("top", "least", "task_rows"), [(2000, 2, 300_000), (3, 2, 5), (2000, 4, 5)])
def test_odd_rows_equal_brute_force(spark, monkeypatch, top, least, task_rows):
    monkeypatch.setattr(collocations, "TASK_ROWS", task_rows)
    monkeypatch.setattr(collocations, "TASK_COUNTS", task_rows)
    docs = spark.createDataFrame([(lang, text, "x", 1) for lang, text in ODD * 2], "lang string, text string, prefix string, N long").repartition(4)
    found = collocations.collocations(docs, top, least).collect()
    assert sorted(map(tuple, found)) == _brute_force(ODD * 2, top, least)


def test_documents_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = collocations.collocations(docs, 300, 5).collect()
    assert sorted(map(tuple, found)) == _brute_force(docs.select("lang", "text").collect(), 300, 5)


def test_stripes_add_up(spark, sf):
    """Every counter is how often its phrase occurs, and the words of a language are all there."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts, totals = _counts(docs.select("lang", "text").collect())
    sums, found = Counter(), {}
    for row in collocations.stripes(docs, least=8).collect():
        if not row["prefix"]:
            sums[row["lang"]] += row["n"]
        if row["next"] is not None:
            words = (*row["prefix"].split(" "), row["next"]) if row["prefix"] else (row["next"],)
            assert len(words) == row["size"]
            found[row["lang"], words] = row["n"]
    assert dict(sums) == dict(totals)
    assert found == {key: n for key, n in counts.items() if n >= 8}


def test_a_phrase_is_not_sent_by_every_task_that_holds_it(spark, monkeypatch):
    """60 texts hold each phrase, dealt over 20 tasks: its words come from a few of them, its count from all."""
    rows = [("en", f"first{k % 100} second{k % 100} third{k % 100}, only{k}") for k in range(6000)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(20)
    sent, per_task = [], collocations._per_task
    monkeypatch.setattr(collocations, "_per_task", lambda *given: (sent.append(made := per_task(*given)), made)[1])
    found = collocations.stripes(docs, least=60).collect()
    assert {row["n"] for row in found if row["next"] is not None} == {60} and len(found) == 600 + 1
    (named,) = [made.count() for made in sent if "prefix" in made.columns]
    assert named < 4 * len(found)


def test_products_beyond_64_bits(spark):
    """Scores and cover tests of counts that no long holds once multiplied."""
    a, l, r = 4_000_000_000_000_000_000, 4_600_000_000_000_000_000, 4_000_000_000_000_000_003
    rows = [("en", "", "x", l, 1), ("en", "", "y", r, 1), ("en", "", "z", a, 1), ("en", "x", "y", a, 2), ("en", "y", "z", a, 2), ("en", "x y", "z", a // 5 * 4 - 1, 3)]
    table = spark.createDataFrame(rows, "lang string, prefix string, next string, n long, size int")
    found = {row["phrase"]: tuple(row)[2:] for row in collocations.scored(table).collect()}
    assert found["x y"] == (a, l, r, 2_000_000 * a // (l + r))
    table = spark.createDataFrame([(*row[:3], row[3] + 1, row[4]) if row[1:3] == ("x y", "z") else row for row in rows], table.schema)
    assert "x y" not in {row["phrase"] for row in collocations.scored(table).collect()}


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
