"""Brute force, invariants and edge cases of the corpus operators."""

import glob
import hashlib
import os
import re
import zlib
from collections import defaultdict
from itertools import combinations
from math import comb

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyarrow import orc
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sentrail import session
from sentrail.llm import arrow, automaton, components, decontamination, license_scan, packing, parity_join, quality_classifier, quality_rules, sharding, token_counts, token_files, toxicity
from sentrail.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, SCORE string, Kept string, shard string, n_words string"
ODD = [None, "", " \n\t ", "one", "the cat", "x" * 5000, "All rights reserved.", "a b c d e f g " * 400, "A b c\nA b c\n", "ünï çødé 日本 “x”"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, text, None if k % 3 else "en", None if k % 4 else "s", 0, "x", "y", "z", "w") for k, text in enumerate(ODD + ODD[3:6])]
    return spark.createDataFrame([*rows, rows[3], (None, "null id text", None, None, 0, "", "", "", "")], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_every_operator_takes_odd_and_empty_tables(spark, odd, empty):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "the cat")], "item_id long, text string")
    no_items = items.limit(0)
    path, word = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
    for docs in (odd, empty):
        n = docs.count()
        some = _labels(spark, [(k, k % 2, k % 2) for k in range(8)] + [(1, None, None), (2, 1, 1)])
        for labels in (_labels(spark), some):
            assert toxicity.toxicity_scores(docs, labels).count() == n
            assert quality_classifier.quality_scores(docs, labels).count() == n
        assert quality_rules.quality_report(docs).count() == n
        assert quality_rules.adaptive_filter(docs).count() == n
        assert parity_join.near_duplicates(docs).count() == n
        assert sharding.shuffle_shards(docs).count() == n
        assert license_scan.license_report(docs).count() == n
        for benchmark in (items, no_items):
            assert decontamination.contamination_report(docs, benchmark).count() == n
        assert packing.pack(docs, capacity=100).select("n_words").count() >= n
        assert token_counts.line_tokens(docs, path, public_tokenizers.PATTERN).select("doc_id").count() >= n
        assert token_files._encoded(docs, word, 2, True).count() == n


def test_pipeline_of_odd_rows(spark, odd, folder, sf):
    odd.write.parquet(f"{folder}/documents.parquet")
    _labels(spark).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(3, "the cat")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == odd.columns and kept.count() <= docs.count(), name
    assert corpus_pipeline.run(spark, folder).columns == packing.pack(odd).columns


def test_pipeline_keeps_the_columns_of_its_input(spark, sf):
    """Columns named like a stage's own come back as they went in."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "concat('s', doc_id) as SCORE", "concat('k', doc_id) as Kept", "concat('w', doc_id) as n_words", "concat('c', doc_id) as class")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns, name
        assert 0 < kept.join(docs, docs.columns).count() == kept.count() <= docs.count(), name


def test_pipeline_stages_carry_a_text_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("text", "Text")
    carried = corpus_pipeline._carried(docs, "text", "lang", "source")
    assert carried.columns == ["_doc", "text", "lang", "source"]
    assert not {"Text", "text", "lang", "source"} & set(carried.schema["_doc"].dataType.names)
    back = corpus_pipeline._restored(carried, docs, "text", "lang", "source")
    assert back.schema.names == docs.columns and back.exceptAll(docs).count() == 0 == docs.exceptAll(back).count()
    alone = docs.select("Text")
    assert corpus_pipeline._restored(corpus_pipeline._carried(alone, "text"), alone, "text").columns == ["Text"]


def test_decontamination_carries_a_text_once(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("text", "Text")
    sent, matches = [], decontamination.matches
    monkeypatch.setattr(decontamination, "matches", lambda rows, benchmark: (sent.append(rows), matches(rows, benchmark))[1])
    kept = decontamination.decontaminate(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert sent[0].columns == ["_doc", "text"] and "text" not in [name.lower() for name in sent[0].schema["_doc"].dataType.names]
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0 < kept.count()


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    """While near duplicates are looked for, a batch is limited by its bytes; the session's own limit holds again afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, sizes, sets = spark.conf.get(name), [], parity_join.class_table
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(999)), lambda k: F.concat(F.lit("w"), F.xxhash64("id", k).cast("string"))))
    docs = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))

    def measured(docs, shingle):
        def run(batches):
            yield from (pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"]) for batch in batches)

        sizes.extend(row["n"] for row in docs.select("text").mapInArrow(run, "n long").collect())
        return sets(docs, shingle)

    monkeypatch.setattr(parity_join, "class_table", measured)
    assert parity_join.keep_one(docs).count() == 600
    assert len(sizes) > 1 and max(sizes) <= 1.1 * arrow.BATCH_BYTES < sum(sizes)
    assert spark.conf.get(name) == before
    monkeypatch.setattr(parity_join, "class_table", None)
    with pytest.raises(TypeError):
        parity_join.keep_one(docs)
    assert spark.conf.get(name) == before


def test_stages_send_texts_in_small_batches(spark, sf):
    """Also when their rows are read after they returned; of what a stage wrote, only its rows stay."""
    name, most = "spark.sql.execution.arrow.maxBytesPerBatch", 1.1 * arrow.BATCH_BYTES
    before, shared = spark.conf.get(name), os.path.join(session.shared_dir(spark), spark.sparkContext.applicationId)
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(999)), lambda k: F.concat(F.lit("w"), F.xxhash64("id", k).cast("string"))))
    rows = spark.range(0, 600, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"))

    def small(batches):
        for batch in batches:
            assert batch.nbytes <= most
            yield batch

    docs = rows.mapInArrow(small, rows.schema)
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_low_quality, corpus_pipeline.drop_contaminated):
        old = set(os.listdir(shared)) if os.path.isdir(shared) else set()
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns and kept.count() == 600 and kept.select("text").distinct().count() == 600
        assert len(set(os.listdir(shared)) - old) == 1
        assert spark.conf.get(name) == before
    assert corpus_pipeline.pack_bins(spark, docs, sf).filter("n_words = 1000").count() == 600
    assert spark.conf.get(name) == before


def test_pipeline_keeps_what_its_stages_keep(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    last = {row[0] for row in corpus_pipeline.run(spark, sf).select("doc_id").collect()}
    texts = dict(docs.select("doc_id", "text").collect())
    verdict = {row["doc_id"]: row for row in quality_rules.quality_report(docs).collect()}
    bad = {row["doc_id"] for row in decontamination.contamination_report(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if row["contaminated"]}
    toxic = {row["doc_id"] for row in QUERIES["op1_toxicity"](spark, sf).collect() if row["predicted"]}
    assert last and not last & (bad | toxic) and not any(verdict[i]["base_failed"] for i in last)
    sets = {i: _shingles(texts[i]) for i in last}
    assert not any(100 * len(a & b) >= 85 * len(a | b) for a, b in combinations(sets.values(), 2) if a)


# ---- toxicity
def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, old = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[j] + 1, old[j + 1] + 1, old[j] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = ["idiot", "trash", "scum", "été", "pathetic"]
    words = ["idiot", "idi0t", "idot", "idioot", "xdiot", "diot", "idiots", "idi", "trash", "thrash", "scum", "scums", "scu", "eté", "été", "pathtic", "pthtic", "a", "zebra"]
    machine = automaton.build(terms)
    points, _ = toxicity._letters([" ".join(words)])
    letters = machine.classes[points]
    first, last = toxicity._spans(letters)
    found = {int(w): (machine.terms[t], int(e)) for w, t, e in zip(*machine.match(letters, first, last), strict=True)}
    for k, word in enumerate(words):
        near = sorted((_edits(word, t), t) for t in terms if _edits(word, t) <= (len(t) >= automaton.FUZZY_FROM))
        assert found.get(k) == ((near[0][1], near[0][0]) if near else None), word


def _factor(line, hit="idiot"):
    points, _ = toxicity._letters([line])
    low = line.index(hit)
    return toxicity.Context(points).factor(low, low + len(hit))


def test_quotation_counts_less():
    far = "x " * 60
    assert _factor("you are an idiot indeed") == 1.0
    assert _factor('the sign read "idiot" in red') == toxicity.QUOTED
    assert _factor("«idiot» a-t-il dit") == toxicity.QUOTED
    assert _factor("they called me idiot") == toxicity.REPORTED
    # inside a long quotation, and outside with quotations on both sides
    assert _factor(f'the sign read "{far} idiot {far}" in red') == toxicity.QUOTED
    assert _factor(f'"{far} a long quotation" you idiot and "another {far}"') == 1.0
    assert _factor(f"“{far}” you idiot “{far}”") == 1.0
    assert _factor(f"“{far} idiot {far}”") == toxicity.QUOTED
    # a line ends a quotation, and a mark that nothing closes opens none
    assert _factor('"open\nyou idiot" there') == 1.0
    assert _factor('"you idiot') == 1.0


def test_evidence_equals_brute_force(spark):
    """Hits by edit distance over every word, weights and contexts as the model has them."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.fit(docs, labels)
    assert model.automaton.terms
    docs = docs.filter("length(text) < 1500 and doc_id < 400").limit(80)
    found = {row["doc_id"]: (row["score"], row["n_hits"]) for row in toxicity.tag(docs, model).collect()}
    rows = docs.select("doc_id", "text").collect()
    seen = 0
    for doc, text in rows:
        lower, best, hits = text.lower(), {}, 0
        points, _ = toxicity._letters([text])
        for match in re.finditer(r"[^\W\d_]+", lower):
            near = sorted((_edits(match[0], t), k) for k, t in enumerate(model.automaton.terms) if abs(len(t) - len(match[0])) < 2 and _edits(match[0], t) <= (len(t) >= automaton.FUZZY_FROM))
            if near:
                edit, term = near[0][0], min((model.automaton.terms[k], k) for e, k in near if e == near[0][0])[1]
                if model.weights[term, edit] > 0:
                    hits += 1
                    best[term, edit] = max(best.get((term, edit), 0), toxicity.Context(points).factor(*match.span()))
        evidence = sum(model.weights[key] * factor for key, factor in best.items())
        score = 1 / (1 + np.exp(-np.clip(model.slope * evidence + model.offset, -500, 500)))
        assert found[doc] == (pytest.approx(score, abs=1e-9), hits), doc
        seen += hits
    assert seen


def test_other_labels_teach_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", "quality", "toxic")
    more = labels.union(spark.createDataFrame([(k, 7, -3) for k in range(100_000, 100_050)] + [(None, 1, 1)], "doc_id long, quality int, toxic int"))
    extra = docs.union(spark.createDataFrame([(k, "some more text here", "en", "s", 0) for k in range(100_000, 100_050)], docs.schema))
    for scores in (lambda d, l: toxicity.toxicity_scores(d, l), lambda d, l: quality_classifier.quality_scores(d, l)):
        assert sorted(scores(docs, labels).select("doc_id", "score").collect()) == sorted(scores(extra, more).filter("doc_id < 100000").select("doc_id", "score").collect())


def test_toxicity_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = {row["doc_id"]: row["toxic"] for row in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [row for row in QUERIES["op1_toxicity"](spark, folder).collect() if row["doc_id"] in labels]
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1) for row in rows)
    held = [row for row in rows if row["held_out"]]
    assert np.mean([row["predicted"] == labels[row["doc_id"]] for row in held]) > 0.97


def test_quality_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [row for row in QUERIES["op6_quality_classifier"](spark, folder).collect() if row["held_out"] and row["doc_id"] in labels]
    assert np.mean([row["predicted"] == labels[row["doc_id"]] for row in held]) > 0.98


def test_quality_weights_equal_brute_force(spark, sf):
    stats = quality_classifier.statistics(spark.read.parquet(f"{sf}/documents.parquet"))
    train = stats.join(spark.read.parquet(f"{sf}/labels.parquet").selectExpr("doc_id", "cast(quality as int) label"), "doc_id").cache()
    model = quality_classifier.fit(train)
    x = np.array([row["stats"] for row in train.orderBy("doc_id").collect()])
    y = np.array([row["label"] for row in train.orderBy("doc_id").collect()], float)
    np.testing.assert_allclose(model.centre, x.mean(0), atol=1e-5)
    np.testing.assert_allclose(model.scale, np.maximum(x.std(0), 1e-6), atol=1e-4)
    # the kernel's expansion, its ridge solution, and pools of equal raw scores
    z = np.column_stack([np.sqrt(2 / quality_classifier.COSINES) * np.cos(np.clip((x - model.centre) / model.scale, -6, 6) @ model.turns + model.phase), np.ones(len(x))])
    weights = np.linalg.solve(z.T @ z + quality_classifier.RIDGE * len(x) * 1e-2 * np.eye(z.shape[1]), z.T @ y)
    np.testing.assert_allclose(model.raw(x), np.clip(z @ weights, -0.5, 1.5), atol=2e-2)
    step = np.floor(model.raw(x) * quality_classifier.STEPS)
    levels = np.unique(step)
    expected = quality_classifier.isotonic(levels, np.array([y[step == s].sum() for s in levels]), np.array([(step == s).sum() for s in levels]))
    np.testing.assert_allclose(model.chances, expected)
    # a Gaussian kernel between documents
    gaps = ((x[:40, None] - x[None, :40]) / model.scale)
    kernel = np.exp(-(gaps**2).sum(-1) / (2 * quality_classifier.WIDTH**2 * x.shape[1] / 4))
    assert np.abs(z[:40, :-1] @ z[:40, :-1].T - kernel).mean() < 0.08


def test_quality_scores_do_not_depend_on_partitions(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    docs = docs.union(docs.withColumn("text", F.expr("concat(text, ' another ending')")).limit(40))  # ids of two texts
    one, two = (quality_classifier.quality_scores(docs.repartition(n), labels).orderBy("doc_id", "score").collect() for n in (3, 7))
    assert one == two


def test_isotonic():
    out = quality_classifier.isotonic(np.arange(4), np.array([1, 0, 5, 9]), np.array([10, 10, 10, 10]))
    assert (np.diff(out) >= 0).all() and out[0] == out[1]


# ---- quality rules
def test_quality_measures(spark, sf):
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    for row in QUERIES["op3_quality_rules"](spark, sf).collect():
        text = texts[row["doc_id"]]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        places = defaultdict(list)
        for k in range(len(words) - 2):
            places[tuple(words[k : k + 3])].append(k)
        repeated = {k + j for found in places.values() if len(found) > 1 for k in found for j in range(3)}
        lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert tuple(row[name] for name in quality_rules.BASE) == expected
        assert row["base_failed"] == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (row["kept"] and row["base_failed"])


def _low(value):
    shift = 2 ** max(0, value.bit_length() - 7)
    return value - value % shift


def test_quality_verdicts_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.withColumn("source", F.expr("if(doc_id % 5 = 0, null, source)")).withColumn("lang", F.expr("if(doc_id % 11 = 0, null, lang)"))
    rows = quality_rules.measure(docs).select("*", *[rate.alias(name) for name, rate in quality_rules.rates().items()]).collect()
    passed = [row for row in rows if not row["base_failed"]]

    def quartiles(group, name):
        values = sorted(_low(row[name]) for row in group)
        return [next(v for k, v in enumerate(values, 1) if 4 * k >= share * len(values)) for share in (1, 3)]

    def blend(group, name, above):
        n = len(group)
        return [(n * q + quality_rules.PRIOR * p) // (n + quality_rules.PRIOR) for q, p in zip(quartiles(group, name), above, strict=True)]

    langs, groups = defaultdict(list), defaultdict(list)
    for row in passed:
        langs[row["lang"]].append(row)
        groups[row["lang"], row["source"]].append(row)
    found = {row["doc_id"]: row["kept"] for row in quality_rules.quality_report(docs).collect()}
    rejected, own = 0, set()
    for row in rows:
        expected = not row["base_failed"]
        for name, spread in quality_rules.SPREAD.items():
            if expected:
                low, high = blend(groups[row["lang"], row["source"]], name, blend(langs[row["lang"]], name, quartiles(passed, name)))
                own.add((name, low, high))
                expected = row[name] <= high + quality_rules.REACH * max(high - low, spread)
                rejected += not expected
        assert found[row["doc_id"]] == expected, row["doc_id"]
    assert rejected and len(own) > 2 * len(quality_rules.SPREAD)


# ---- near duplicates
def _shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), word) for word in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return frozenset(tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))) if words else frozenset()


def _components(sets):
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in combinations(sorted(sets.items()), 2):
        if a and b and 100 * len(a & b) >= 85 * len(a | b):
            low, high = sorted((find(i), find(j)))
            parent[high] = low
    return {i: find(i) for i in sets}


def test_near_duplicates_equal_brute_force(spark, sf):
    random = np.random.default_rng(5)
    words = [f"w{k}" for k in range(3000)]
    base, rows = random.choice(words, 300).tolist(), []
    shared = random.choice(words, 60).tolist()
    for k in range(60):  # a drifting family: neighbours link, ends don't
        base = list(base)
        base[int(random.integers(300))] = f"n{k}"
        rows.append(" ".join(base))
    rows += [" ".join(shared + random.choice(words, int(random.integers(0, 120))).tolist()) for _ in range(120)]
    rows += ["", None, "one two", "one two", "One TWO", "a b c d e", "a b c d e f"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(rows)], "doc_id long, text string"))
    sets = {i: _shingles(text) for i, text in docs.collect()}
    expected = _components(sets)
    found = parity_join.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in found} == {i: (expected[i], len(sets[i])) for i in sets}


def test_only_texts_of_pairs_are_moved(spark, monkeypatch):
    """Classes that share keys but make no pair send no text, and repeated ids stand for all their texts."""
    random = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(random.choice(words, 9)) + " the same four words " + " ".join(random.choice(words, 9)) for _ in range(400)]
    base = " ".join(random.choice(words, 80))
    rows = [(k % 350, text) for k, text in enumerate(texts)] + [(3, base + " left"), (3, base + " right"), (None, base + " up")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    written = []
    materialise = parity_join.materialise
    monkeypatch.setattr(parity_join, "materialise", lambda df, name: (written.append((name, made := materialise(df, name))), made)[1])
    found = parity_join.near_duplicates(docs).collect()
    moved = {name: [{row[0] for row in table.select(*columns).collect()} for n, table in written if n == name] for name, columns in (("texts", ["class"]), ("holders", ["class"]))}
    pairs = [{name for row in table.collect() for name in row} for n, table in written if n == "pairs"]
    alive = next({row["class"] for row in table.collect()} for n, table in written if n == "keys")
    assert moved["texts"] == [classes for classes in pairs if classes] and len(set.union(*pairs)) < len(alive)
    assert {row["component_id"] for row in found if row["doc_id"] is None} == {3}


def test_shared_keys_are_counted_from_packed_ones(spark, monkeypatch):
    """Every key of two classes is found with its number, copies of a text count once, and a key takes few bytes."""
    random = np.random.default_rng(7)
    words = [f"w{k}" for k in range(900)]
    base = random.choice(words, 300)
    texts = [" ".join(random.choice(words, int(random.integers(1, 400)))) for _ in range(150)]
    texts += [" ".join([*base[:k], "x", *base[k + 1 :]]) for k in range(0, 300, 7)] + ["", None]
    copies = texts[::9]
    docs = spark.createDataFrame([(t,) for t in texts + copies * 2], "text string").repartition(4)
    monkeypatch.setattr(parity_join, "PACKED_KEYS", 3_000)
    holders, sent = {}, 0
    for named, _, _, text, key, up, above, key_above in parity_join._keyed(iter([pa.record_batch({"text": texts})]), 4, 85):
        for name, one in zip([*named[text].tolist(), *named[up][above].tolist()], [*key.tolist(), *key_above.tolist()], strict=True):
            holders.setdefault(one >> 16, set()).add(name)
            sent += 1
    expected = {one: min(len(names), parity_join.CROWDED) for one, names in holders.items() if len(names) > 1}
    repeated = np.zeros(1 << 19, dtype=np.uint64)
    classes = np.array([name for name in parity_join.shingle_sets(pa.array([t for t in copies if t]), 4).classes()]).view(np.uint64) << np.uint64(3)
    places = classes >> np.uint64(64 - 25)
    np.bitwise_or.at(repeated, (places >> np.uint64(6)).astype(int), np.uint64(1) << (places & np.uint64(63)))
    found = {(row["key"] & (2**64 - 1)) >> 16: min(row["n"], parity_join.CROWDED) for row in parity_join.shared_keys(docs, repeated, sent, 4, 85).collect()}
    assert found == expected and len(expected) > 100 and max(expected.values()) == parity_join.CROWDED
    single = spark.createDataFrame([(t,) for t in texts], "text string")
    size = single.transform(lambda df: parity_join.packed_keys(df, np.zeros(1 << 19, dtype=np.uint64), 8, 4, 85)).selectExpr("sum(length(alone) + length(several) + length(names))").first()[0]
    assert 4 * sent < size <= 5 * sent


def test_larger_of_two_sets_probes():
    """Linked sets share a probe of the larger one and as many segments as a class must have marked to send any."""
    random = np.random.default_rng(2)
    for size in (40, 90, 150, 216, 217, 700):
        one = np.unique(random.integers(0, 2**63, size, dtype=np.uint64))
        for two in (one[size * 15 // 100 :], np.unique(np.concatenate([one[size * 8 // 100 :], random.integers(0, 2**63, size * 8 // 100, dtype=np.uint64)]))):
            small, large = sorted((one, two), key=len)
            common = len(np.intersect1d(small, large))
            assert 100 * common >= 85 * (len(small) + len(large) - common)
            low, band = (int(np.searchsorted(parity_join.UPPER, len(s))) for s in (small, large))
            assert low == band or len(small) * 100 >= 85 * (parity_join.UPPER[low] + 1) and low + 1 == band
            keys = []
            for shingles in (small, large):
                sets, top = np.array([len(shingles)]), parity_join.UPPER[np.array([band])]
                text, key = parity_join.segment_keys(parity_join.Sets(shingles, np.array([0, len(shingles)])), np.array([band]), 85)
                keys.append(set(key.tolist()))
                must = parity_join.segments(85)[0][band] - parity_join.most_apart(sets, top, 85)[0]
            chosen = parity_join.probes(text, random.integers(0, 3, len(key)), parity_join.differences(np.array([len(large)]), 85) + 1)
            assert keys[0] & set(key[chosen].tolist()) and len(keys[0] & keys[1]) >= must


def test_keep_one_row_of_each_component(spark):
    a, near, other = "one two three four five six seven eight nine ten " * 3, "ONE two three four five six seven eight nine ten " * 3, "quite another text that nothing equals here"
    rows = [(1, a), (5, a), (5, "unique to five and to nobody else at all"), (7, near), (1, a), (None, a), (None, other), (None, other), (8, ""), (8, ""), (9, None), (None, ""), (6, other + " x y"), (6, "short")]
    docs = spark.createDataFrame([(i, t, "C", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, class string, N long").repartition(3)
    kept = parity_join.keep_one(docs)
    assert kept.columns == docs.columns
    found = sorted([tuple(row)[:2] for row in kept.collect()], key=str)
    expected = [(1, a), (5, rows[2][1]), (None, other), (8, ""), (8, ""), (9, None), (None, ""), (6, other + " x y"), (6, "short")]
    assert found == sorted(expected, key=str)
    assert {row["class"] for row in kept.collect()} == {"C"}


def test_linked_sets_share_a_probe():
    random = np.random.default_rng(1)
    for size in (7, 20, 57, 300):
        one = np.unique(random.integers(0, 2**63, size, dtype=np.uint64))
        lost = int(parity_join.differences(len(one), 85)) // 2
        two = np.unique(np.concatenate([one[lost:], random.integers(0, 2**63, lost, dtype=np.uint64)]))
        bands = [int(np.searchsorted(parity_join.UPPER, len(s))) for s in (one, two)]
        band = np.array([max(bands)])
        keys = []
        for shingles in (one, two):
            text, key = parity_join.segment_keys(parity_join.Sets(shingles, np.array([0, len(shingles)])), band, 85)
            chosen = parity_join.probes(text, random.integers(0, 3, len(key)), parity_join.segments(85)[1][band])
            keys.append((set(key.tolist()), set(key[chosen].tolist())))
        assert keys[0][1] & keys[1][0]
        total, wanted = (numbers[band[0]] for numbers in parity_join.segments(85))
        assert len(keys[0][0] & keys[1][0]) >= total - wanted + 1


def test_components(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, 101), (102, 101), (7, 7)]
    found = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(1, 41), 1), 100: 100, 101: 100, 102: 100}


# ---- sharding
def test_hypergeometric_law(spark):
    drawn = spark.range(20_000).selectExpr(f"{sharding.hypergeometric('60L', '25L', '17L', '(id + 0.5D) / 20000D')} as x").groupBy("x").count().collect()
    for x, n in drawn:
        assert abs(n / 20_000 - comb(25, x) * comb(35, 17 - x) / comb(60, 17)) < 2e-4


def test_shards(spark, sf):
    rows = QUERIES["op5_sharding"](spark, sf).collect()
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    slots = defaultdict(list)
    for row in rows:
        slots[row["shard"]].append(row["slot"])
        assert (row["size"], row["text_crc32"]) == (len(texts[row["doc_id"]].encode()) + 1, zlib.crc32(texts[row["doc_id"]].encode()))
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(rows) == len(texts)


def test_shard_report_shuffles_whole_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    whole = sharding.shuffle_shards(docs).select("doc_id", "shard", "slot")
    assert sorted(sharding.shard_report(docs).select("doc_id", "shard", "slot").collect()) == sorted(whole.collect())


# ---- licences
def test_licenses_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    more = ["Licensed under the Apache License, Version 2.0.", "MIT License", "cc-by cc by CC.BY", "the gnu General Public License", None, "Released under the MIT License. Released under the MIT License"]
    docs = docs.union(spark.createDataFrame([(10_000 + k, t) for k, t in enumerate(more)], "doc_id long, text string"))
    texts = dict(docs.collect())
    for row in license_scan.license_report(docs).collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[row["doc_id"]] or ""))
        starts = sorted((k, label) for phrase, label in license_scan.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())
        labels, best = {label for _, label in starts}, 1.0 if starts else 0.0
        base = ",".join(sorted(labels))
        for label, notice, phrase in license_scan.TEMPLATES:
            notice, key = notice.split(), phrase.split()
            place = next(k for k in range(len(notice)) if notice[k : k + len(key)] == key)
            for at in range(-place, len(words)):
                if words[at + place : at + place + len(key)] == key:
                    share = sum(0 <= at + k < len(words) and words[at + k] == word for k, word in enumerate(notice)) / len(notice)
                    if share >= license_scan.LEAST:
                        labels.add(label)
                        best = max(best, share)
        ends = (starts[0][0], starts[-1][0]) if starts else (None, None)
        assert tuple(row)[1:] == (len(words), len(starts), *ends, base, ",".join(sorted(labels)), best)


# ---- decontamination
def _contamination(docs, items):
    windows = defaultdict(set)
    split = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    for item, text in items:
        words = split(text)
        for k in range(max(1, len(words) - 12) if words else 0):
            windows[tuple(words[k : k + 13])].add(str(item))
    for doc, text in docs:
        words = split(text)
        hit, named = [False] * len(words), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in windows:
                    hit[k : k + size] = [True] * size
                    named |= windows[tuple(words[k : k + size])]
        sha = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        yield doc, (len(words), sum(hit), len(named), sha, sum(hit) > 0 and 20 * sum(hit) >= len(words))


@pytest.mark.parametrize("most", [16 << 20, 700])
def test_contamination_equals_brute_force(spark, sf, most):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    extra = [(9_001, "word"), (9_002, "two words"), (9_003, "aa aa aa aa aa aa aa aa aa aa aa aa aa"), (9_004, None), (9_005, "...")]
    items = spark.read.parquet(f"{sf}/benchmark.parquet").union(spark.createDataFrame(extra, "item_id long, text string"))
    more = [(9_001, "a Word here, two  WORDS there " + "aa " * 30), (9_002, None), (9_003, "two"), (9_004, "words two")]
    docs = docs.union(spark.createDataFrame(more, "doc_id long, text string"))
    judged = decontamination.judge(decontamination.matches(docs, items, most=most)).collect()
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], hashlib.sha256(",".join(sorted(r["items"])).encode()).hexdigest(), r["contaminated"]) for r in judged}
    assert found == dict(_contamination(docs.collect(), items.collect()))


def test_longest_matches(spark):
    docs = spark.createDataFrame([(2, "x a b c d y"), (1, "a b q"), (3, "A, b c d")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "k a b c d z"), (2, "q"), (3, "nothing here"), (4, "y nowhere")], "item_id long, text string")
    found = {row["item_id"]: (row["n_words"], row["doc_id"]) for row in decontamination.longest_matches(docs, items).collect()}
    assert found == {"1": (4, 2), "2": (1, 1), "4": (1, 2)}


def test_suffix_array():
    words = np.array([1, 2, 1, 2, 1, -1, 2, 1, 2, -1])
    order = decontamination.suffix_array(words, np.flatnonzero(words >= 0))
    assert [words[k:][: int(np.argmax(words[k:] < 0)) + 1].tolist() for k in order] == sorted(words[k:][: int(np.argmax(words[k:] < 0)) + 1].tolist() for k in order)


# ---- packing
def test_packing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.pack(docs, capacity=300, pool=64).collect()
    words = {row[0]: len(re.findall(r"[^\x20\x09-\x0D]+", row[1])) for row in docs.select("doc_id", "text").collect()}
    bins, placed = defaultdict(list), defaultdict(int)
    for row in rows:
        bins[row["pool"], row["bin"]].append(row)
        placed[row["doc_id"]] += row["n_words"]
    assert dict(placed) == words
    for held in bins.values():
        held.sort(key=lambda row: row["start"])
        assert all(a["start"] + a["n_words"] == b["start"] for a, b in zip(held, held[1:], strict=False) if a["n_words"])
        assert held[-1]["start"] + held[-1]["n_words"] <= 300
        assert len({row["source"] for row in held}) == len(held) == len({row["cluster"] for row in held})


def test_best_fit_takes_the_tightest_compatible_bin():
    random = np.random.default_rng(3)
    lengths, sources, clusters = (random.integers(low, high, 400).tolist() for low, high in ((1, 100), (-1, 6), (-1, 50)))
    bins, starts = packing.best_fit(lengths, sources, clusters, 100)
    free, held = [], []
    for k, length in enumerate(lengths):
        mine = {("s", sources[k]), ("c", clusters[k])} - {("s", -1), ("c", -1)}
        fitting = [(free[b], b) for b in range(len(free)) if free[b] >= length and not held[b] & mine]
        if fitting:
            at = min(fitting)[1]
        else:
            at = len(free)
            free.append(100)
            held.append(set())
        assert (bins[k], starts[k]) == (at, 100 - free[at])
        free[at] -= length
        held[at] |= mine


# ---- tokens
def test_section_tokens_add_up(spark, sf):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding, lengths = token_counts._encoding(path, public_tokenizers.PATTERN)
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = defaultdict(list)
    for row in QUERIES["op9_token_counts"](spark, sf).collect():
        rows[row["doc_id"]].append(row)
    for doc, text in texts.items():
        tokens, at, counts = encoding.encode_ordinary(text), 0, defaultdict(int)
        sections = sorted(rows[doc], key=lambda row: row["section"])
        assert [row["n_bytes"] for row in sections] == [len(line.encode()) for line in text.splitlines(keepends=True)] or "\r" in text or not text
        for token in tokens:
            shares = [min(at + int(lengths[token]), row["first_byte"] + row["n_bytes"]) - max(at, row["first_byte"]) for row in sections]
            counts[int(np.argmax(shares))] += 1
            at += int(lengths[token])
        assert [row["n_tokens"] for row in sections] == [counts[k] for k in range(len(sections))] and at == len(text.encode())


def test_field_tokens(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = spark.createDataFrame([(1, "user", "hello there"), (2, None, "")], "k long, role string, text string")
    found = token_counts.field_tokens(rows, "k", ["role", "text"], path, public_tokenizers.PATTERN).collect()
    assert [(r["k"], r["section"], r["n_bytes"]) for r in found] == [(1, 0, 5), (1, 1, 11), (2, 0, 1), (2, 1, 0)]


def test_word_encoder_equals_the_whole_text():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["<|endoftext|> a", "it's don't’s", "áb é é", "İstanbul ΣΑΣ ß", "x\x1cy z\x85w", "  two  blanks\n\n", "", "日本語。テスト", "A1b2 a.b ...", "é. É, ñ! µ º", "ﬁne ǅ.", "tab\tbed\r\nx", "Word., ,.", "ÅÅ"]
    texts += ["<|ENDOFTEXT|> b", "c <|EndOfText|>d", "<|STARTOFTEXT|><|startoftext|>", "é <|endoftext|>É", None, "THE The the", "plain words again"]
    expected = [item.ids for item in tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)]
    for most in (0, 1 << 20):
        encoder = token_files.WordEncoder(tokenizer, most=most)
        for _ in range(2):
            ids, counts = encoder.encode(pa.array(texts))
            assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == expected
        assert encoder.direct


def test_word_encoder_cuts_words_at_signs():
    """A word is learnt once, whatever signs and digits stand beside it, with the ids of the whole text."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["word word. word*** (Word) word, été! ÉTÉ*** !?été", "x-word 42word7 a@b.co", "don't 'll '.s ''s 7's é's", "a×b. c÷ é×- İ. i̇- ł, ñ́. a≮ 1⃣", "a\x0b-b c\x85. d\x00e"]
    expected = [item.ids for item in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encoder = token_files.WordEncoder(tokenizer)
    ids, counts = encoder.encode(pa.array(texts))
    assert [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])] == expected
    encoder = token_files.WordEncoder(tokenizer)
    encoder.encode(pa.array(texts[:1]))
    assert set(encoder.number) == {word.encode() for word in ("word", ".", "***", "(", ")", ",", "été", "ÉtÉ", "!", "!?")}


def test_looking_up_an_id_skips_stripes(spark, folder):
    rows = [(k, f"text number {k} " * 20) for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    settings = {"orc.row.index.stride": "1000", "orc.stripe.size": "65536", "orc.stripe.row.count": "1000"}
    token_files.write_tokens(docs, f"{folder}/t", public_tokenizers.path("word_bpe_49k.json"), **settings)
    files = glob.glob(f"{folder}/t/*.orc")
    assert len(files) == 1 and orc.ORCFile(files[0]).nstripes > 1

    found = spark.read.schema(token_files.ROW).orc(f"{folder}/t").filter(F.col("doc_id") == 4321)
    assert [row["doc_id"] for row in found.collect()] == [4321]
    plan = found._jdf.queryExecution().executedPlan()
    assert "doc_id" in plan.toString().split("PushedFilters: [")[1].split("]")[0]
    scanned = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    assert 0 < scanned <= 1000 < len(rows)
    # an id between those of a stripe is kept out by its Bloom filter
    absent = spark.createDataFrame([(2 * k, "even") for k in range(3000)], "doc_id long, text string")
    token_files.write_tokens(absent, f"{folder}/e", public_tokenizers.path("word_bpe_49k.json"), **settings)
    found = spark.read.schema(token_files.ROW).orc(f"{folder}/e").filter(F.col("doc_id") == 2001)
    assert found.collect() == []
    assert found._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value() == 0


def test_an_id_may_fill_several_files(spark, folder, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_ROWS", 5)
    rows = [(k, f"t{k}") for k in range(6)] + [(3, f"hot text {k} " * 3) for k in range(20)] + [(3, "same")] * 15
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), f"{folder}/t", public_tokenizers.path("word_bpe_49k.json"))
    found = token_files.read_tokens(spark, f"{folder}/t").orderBy("start").collect()
    assert [row["doc_id"] for row in found] == sorted(i for i, _ in rows)
    assert [row["start"] for row in found] == np.cumsum([0, *[row["n_tokens"] for row in found]])[:-1].tolist()
    assert len(glob.glob(f"{folder}/t/*.orc")) > 4


def test_token_files(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    found = {row["doc_id"]: tuple(row)[1:] for row in QUERIES["op10_token_files"](spark, sf).collect()}
    for doc, text in sorted(docs.select("doc_id", "text").collect()):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        assert found[doc] == (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)


def test_token_files_of_several_ranges(spark, folder, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_ROWS", 7)
    rows = [(k, f"text number {k} " * (k % 5)) for k in range(60)]
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), f"{folder}/t", public_tokenizers.path("word_bpe_49k.json"))
    found = sorted(token_files.read_tokens(spark, f"{folder}/t").collect())
    assert [row["doc_id"] for row in found] == list(range(60))
    assert [row["start"] for row in found] == np.cumsum([0, *[row["n_tokens"] for row in found]])[:-1].tolist()
