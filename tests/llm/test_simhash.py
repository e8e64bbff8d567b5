"""SimHash near duplicates and the components they are joined by, against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from sentrail.llm import components, simhash
from sentrail.llm.queries import QUERIES


def _fingerprint(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), word) for word in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    values = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(v >> bit & 1 for v in values) > len(values))


def _components(nodes, links):
    parent = {node: node for node in nodes}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {node: find(node) for node in nodes}


def _of_fingerprints(fps, distance):
    """The least fingerprint that each one reaches."""
    values = np.array(sorted(set(fps)), dtype=np.uint64)
    links = []
    for k, value in enumerate(values):
        links += [(int(value), int(other)) for other in values[k + 1 :][np.bitwise_count(values[k + 1 :] ^ value) <= distance]]
    return _components([int(v) for v in values], links)


def test_fingerprints_equal_brute_force(spark):
    texts = ["", None, " \n\t ", "one", "One TWO three", "a b c d", "a\x0bb\x0cc\rd e", "x" * 5000, "ünï çødé 日本 “x” A b", "a b c d e f g " * 400, "a\x1cb c\xa0d e f", "the end"]
    found = simhash.fingerprints(pa.array(texts))
    assert found.tolist() == [_fingerprint(text) for text in texts]
    one = spark.createDataFrame([("a b c d",)], "text string").selectExpr("lower(hex(xxhash64(text))) h").first()["h"]
    assert f"{_fingerprint('a b c d'):016x}" == one.zfill(16)


def test_documents_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    more = [(10_000, None), (10_001, ""), (10_002, "same words here now"), (10_002, "same words here now"), (10_003, "SAME words\nhere now"), (None, "same words here now"), (None, "no id here at all")]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    docs = docs.selectExpr("*", "'x' as fp", "1 as Component_ID", "2 as KEY")
    rows = docs.select("doc_id", "text").collect()
    root = _of_fingerprints([_fingerprint(text) for _, text in rows], simhash.DISTANCE)
    least = {}
    for doc, text in rows:
        if doc is not None:
            part = root[_fingerprint(text)]
            least[part] = min(doc, least.get(part, doc))
    expected = sorted((str(doc), f"{_fingerprint(text):016x}", least.get(root[_fingerprint(text)])) for doc, text in rows)
    found = simhash.near_duplicates(docs).collect()
    assert sorted(((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in found), key=str) == sorted(expected, key=str)
    assert {r["doc_id"]: r["fingerprint"] for r in QUERIES["op13_simhash"](spark, sf).collect()} == {d: f"{_fingerprint(t):016x}" for d, t in rows if d is not None and d < 10_000}


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def _balls(random):
    """Random fingerprints, a chain, and dense balls whose members are near their neighbours only."""
    fps = random.integers(0, 2**63, 300, dtype=np.uint64).tolist()
    for spread in (6, 12, 25):
        centre, bits = int(random.integers(0, 2**63)), random.choice(64, spread, replace=False)
        fps += [centre ^ sum(1 << int(bit) for bit in bits[random.random(spread) < 0.3]) for _ in range(400)]
    at = int(random.integers(0, 2**63))
    for bit in range(0, 60, 4):  # each four bits from the one before
        at ^= 0b1111 << bit
        fps.append(at)
    return fps


@pytest.mark.parametrize(("pair_rows", "parts"), [(2, (2,)), (16, (3, 4)), (128, (5,)), (5, (2, 3, 4, 5))])
def test_classes_equal_brute_force(spark, pair_rows, parts):
    fps = _balls(np.random.default_rng(pair_rows))
    classes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in set(fps)], "fp long").repartition(5)
    found = simhash.link_classes(classes, 4, parts, pair_rows).collect()
    groups, expected = {}, {}
    for node, part in found:
        groups.setdefault(part, set()).add(node & (2**64 - 1))
    for node, part in _of_fingerprints(fps, 4).items():
        expected.setdefault(part, set()).add(node)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_probes_and_keys_are_not_broadcast(spark, monkeypatch):
    """Few bytes of classes make many probes: the planner's size of them must not lead to a broadcast."""
    plans, materialise = {}, simhash.materialise
    monkeypatch.setattr(simhash, "materialise", lambda df, name: (plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString()), materialise(df, name))[1])
    fps = np.random.default_rng(8).integers(0, 2**63, 2000, dtype=np.uint64).tolist()
    classes = materialise(spark.createDataFrame([(fp ^ low,) for fp in fps for low in (0, 1, 3)], "fp long"), "classes")
    assert simhash.link_classes(classes).count() == 6000
    assert "SortMergeJoin" in plans["probes"] and "Broadcast" not in plans["probes"]
    semi = [line for line in plans["keys"].splitlines() if "LeftSemi" in line]
    assert semi and all("SortMergeJoin" in line for line in semi)


def test_thresholds_follow_the_estimates():
    """Units add up, cost is the least of all shares, and a crowded partition gets the smaller threshold."""
    random = np.random.default_rng(4)
    fps = random.integers(0, 2**63, 4000, dtype=np.uint64)
    grouped = simhash.group_bits(np.eye(64), 4)
    assert sorted(sum(grouped, [])) == list(range(64))
    crowded = fps.copy()
    crowded &= ~simhash._mask(grouped[0])  # all share the value of the first partition
    plan = simhash.Allocation(grouped, 4)
    plan.learn(plan.histograms(crowded))
    units, cost = plan.share(crowded[:50])
    assert (units.sum(axis=1) == 5).all() and (units[:, 0] == 0).all() and np.isfinite(cost).all()


def test_correlated_bits_share_a_partition():
    correlation = np.eye(64)
    for bits in ([1, 20, 40, 60], [3, 5, 50, 51]):
        correlation[np.ix_(bits, bits)] = 1.0
    grouped = simhash.group_bits(correlation, 16)
    assert [1, 20, 40, 60] in grouped and [3, 5, 50, 51] in grouped


@pytest.mark.parametrize(("task_links", "block"), [(0, 7), (0, 10**6), (25, 7), (10**6, 10**6)])
def test_components_by_star_steps_and_in_one_task(spark, task_links, block):
    random = np.random.default_rng(6)
    links = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (102, 101), (7, 7), (-5, 2**62)] + [(500, 500 + k) for k in range(1, 80)]
    links += [(int(a), int(b)) for a, b in random.integers(1000, 1300, (140, 2))]
    expected = _components({n for a, b in links for n in (a, b) if a != b}, links)
    table = spark.createDataFrame(links, "a long, b long").repartition(6)
    assert dict(components.components(table, task_links, block).collect()) == expected


def test_contract_keeps_a_forest():
    node, least = components.contract(np.array([5, 9, 2, 7]), np.array([9, 2, 5, 8]))
    assert sorted(zip(node.tolist(), least.tolist(), strict=True)) == [(5, 2), (8, 7), (9, 2)]
