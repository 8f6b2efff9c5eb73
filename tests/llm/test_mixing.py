from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from obslake.llm import mixing
from tests.conftest import SMALL
from tests.llm.conftest import DOCUMENTS, sentence


def brute_targets(sizes):
    """Targets by refilling: capped sources leave, the rest share what is left."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free and total:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            target.update(share)
            break
        target.update({s: 3.0 * sizes[s] for s in over})
        free -= over
    return {s: target.get(s, 0.0) for s in names}


def check(rows):
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
    expected = brute_targets(dict(sizes))
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - expected[r.source]) <= 1e-6 * max(1, r.target)
    for source in sizes:
        assert abs(taken[source] - expected[source]) <= largest[source]


def test_targets_are_met_to_one_document_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    check(rows)
    again = mixing.mix(docs.repartition(5, "lang")).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_capped_sources_hand_on_their_excess(spark):
    docs = [(k, sentence(k, 5 if s in ("a", "d") else 90), None, s, 1) for k, s in enumerate("abcdef" * 20)]
    docs += [(900 + k, sentence(k, 300), None, None, 1) for k in range(10)]
    rows = mixing.mix(spark.createDataFrame(docs, DOCUMENTS)).collect()
    check(rows)
    assert any(r.target == 3 * r.source_size for r in rows)


def test_thousands_of_sources_take_the_weights_in_the_order_of_their_names(spark):
    names = [f"{'aé😀Z_'[k % 5]}{k * 7919 % 2500}" for k in range(2500)] + [None, ""]
    docs = [(k, "w " * (1 + k % 23), None, name, 1) for k, name in enumerate(names)]
    sized = spark.createDataFrame(docs, DOCUMENTS).selectExpr("source", "length(text) div 2 AS size")
    rows = mixing.source_targets(sized).collect()
    expected = brute_targets({name: 1 + k % 23 for k, name in enumerate(names)})
    assert len(rows) == len(names)
    assert all(abs(r.target - expected[r.source]) <= 1e-6 * max(1, r.target) for r in rows)


def test_a_tree_of_leaves(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF_ROWS", 4)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    docs = [(k, sentence(k, 1 + k % 50), None, "ab"[k % 3 == 0], 1) for k in range(300)]
    rows = mixing.mix(spark.createDataFrame(docs, DOCUMENTS)).collect()
    assert len(rows) == 300
    check(rows)


def test_rounding_keeps_each_expectation():
    hits = defaultdict(int)
    sizes = [3, 10, 7, 30, 12, 5, 9, 2, 21, 14]
    for trial in range(4000):
        leaf = mixing._Leaf(0, (trial,))
        for k, size in enumerate(sizes):
            for done in leaf.add({"k": k, "size": size, "in_words": 0.3 * size}):
                hits[done["k"]] += done["in_words"] > 0
        if leaf.open:
            hits[leaf.open["k"]] += leaf.open["in_words"] / leaf.open["size"]
    assert all(abs(hits[k] / 4000 - 0.3) < 0.035 for k in range(len(sizes)))


def test_awkward_rows(awkward, clashing, nothing):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    check(rows)
    assert sorted(map(repr, mixing.mix(clashing).collect())) == sorted(map(repr, rows))
    assert mixing.mix(nothing).collect() == []
    drawn = mixing.draw(clashing)
    assert drawn.columns == clashing.columns
    counts = {r.doc_id: r.n for r in drawn.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    wanted = defaultdict(int)
    for r in rows:
        wanted[r.doc_id] += r.copies
    assert counts == {d: n for d, n in wanted.items() if n}
    assert mixing.draw(nothing).collect() == []
