from __future__ import annotations

import random

import numpy as np
import pytest

from obslake.llm import decontaminate
from obslake.llm.text import lower_words
from tests.llm.conftest import DOCUMENTS, sentence


def shingle_sets(text, width):
    words = lower_words((text or "").encode())
    n = min(width, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()


def brute(docs, items):
    out = []
    items = [(item, shingle_sets(text, 5)) for item, text in items]
    short = {len(one) for _, wanted in items for one in wanted if len(one) < 5}
    for doc, text in docs:
        whole = shingle_sets(text, 5).union(*(shingle_sets(text, k) for k in short))
        for item, wanted in items:
            if wanted and 100 * len(wanted & whole) >= 80 * len(wanted):
                out.append((doc, item, len(wanted & whole), len(wanted)))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(3)
    items = [(k, sentence(1000 + k, n, 5000)) for k, n in enumerate([3, 5, 6, 9, 12, 14, 20, 40, 60, 130, 260, 700])]
    items += [(50, items[4][1].upper()), (None, items[5][1]), (51, None), (52, "")]
    docs = []
    for k, (_, text) in enumerate(items[:12]):
        filler = sentence(2000 + k, 4000, 5000).split(" ")
        at = rng.randrange(4000)
        docs.append((10 * k, " ".join(filler[:at] + text.split(" ") + filler[at:])))
        words = text.split(" ")
        spoilt = " ".join("zz" if j == len(words) // 2 else w for j, w in enumerate(words))
        docs.append((10 * k + 1, " ".join(filler[:at] + [spoilt] + filler[at:])))
        half = len(words) // 2 + 2
        docs.append((10 * k + 2, " ".join(words[: half + 2] + filler + words[half - 2 :])))
        docs.append((10 * k + 3, text))
    return docs + [(900 + k, sentence(3000 + k, 900, 5000)) for k in range(20)], items


def found(spark, docs, items):
    df = spark.createDataFrame([(d, t, None, None, 1) for d, t in docs], DOCUMENTS)
    return sorted(map(tuple, decontaminate.links(df, spark.createDataFrame(items, "item_id long, text string")).collect()), key=repr)


def test_items_of_all_sizes_are_found_in_long_documents(spark):
    docs, items = corpus()
    expected = brute(docs, items)
    assert len(expected) > 30
    assert found(spark, docs, items) == expected


def test_items_in_filters_that_pass_nearly_all(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(decontaminate, "LEAST_FILTER_BITS", 8)
    monkeypatch.setattr(decontaminate, "MOST_FILTER_BITS", 8)
    assert found(spark, docs, items) == brute(docs, items)


def test_items_shorter_than_a_shingle_inside_long_documents(spark):
    items = [(1, "What is the capital"), (2, "x"), (3, "b c what"), (4, "is the"), (5, "the is"), (6, "capital x y z q r")]
    docs = [(1, "a b c what is the capital x y z"), (2, "x"), (3, "the is"), (4, "what is\nthe capital"), (5, ""), (6, None), (7, "c b"), (1, "x x")]
    docs += [(20, " ".join(["filler"] * 900 + ["is the"] + ["filler"] * 900))]
    expected = [(1, 1), (1, 2), (1, 2), (1, 3), (1, 4), (2, 2), (3, 5), (4, 1), (4, 4), (20, 4)]
    assert sorted(row[:2] for row in found(spark, docs, items)) == expected
    assert found(spark, docs, items) == brute(docs, items)


def test_one_document_and_one_item_in_many_copies(spark):
    text = sentence(5, 60)
    docs = [(k, sentence(6, 300) + " " + text) for k in range(40)] + [(100, sentence(7, 300))]
    items = [(k, text) for k in range(30)] + [(99, sentence(8, 20, 5000))]
    rows = found(spark, docs, items)
    assert len(rows) == 40 * 30
    assert rows == brute(docs, items)


def test_lists_of_items_beside_the_documents(spark, awkward, clashing, nothing):
    text = awkward.where("doc_id = 6").first().text
    items = spark.createDataFrame([(2, "one"), (1, text), (1, text), (None, "one")], "item_id long, text string")
    rows = decontaminate.with_matches(awkward, items).collect()
    assert len(rows) == awkward.count()
    one = [(None, 1, 1), (2, 1, 1)]
    own = {6: [(1, 116, 116)] * 2, 7: [(1, 115, 116)] * 2, 8: one, 9: one}
    for row in rows:
        assert [tuple(m) for m in row.benchmark_matches] == own.get(row.doc_id, [])
    replaced = decontaminate.with_matches(clashing, items)
    assert sorted(replaced.columns) == sorted(clashing.columns)
    assert replaced.where("size(benchmark_matches) > 0").count() == 5
    kept = [(c, "x") for c in clashing.columns if c not in awkward.columns and c != "benchmark_matches"]
    assert replaced.where(" AND ".join(f"`{c}` = '{x}'" for c, x in kept)).count() == awkward.count()
    assert decontaminate.with_matches(nothing, items).collect() == []
    assert all(r.benchmark_matches == [] for r in decontaminate.with_matches(awkward, items.limit(0)).collect())
    assert decontaminate.without_matches(awkward, items.limit(0)).count() == awkward.count()


def test_awkward_rows(spark, awkward, clashing, nothing):
    items = spark.createDataFrame([(1, awkward.where("doc_id = 6").first().text), (2, "one"), (3, None)], "item_id long, text string")
    expected = brute([(r.doc_id, r.text) for r in awkward.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert sorted(map(tuple, decontaminate.links(awkward, items).collect()), key=repr) == expected
    kept = decontaminate.without_matches(clashing, items)
    hit = {e[0] for e in expected}
    assert kept.columns == clashing.columns
    assert kept.count() == awkward.where(~awkward.doc_id.isin(*hit) | awkward.doc_id.isNull()).count()
    assert decontaminate.links(nothing, items).collect() == []
    assert decontaminate.links(awkward, items.limit(0)).collect() == []


@pytest.mark.parametrize("upper", [8, 32, 128, 512, 2048])
def test_bins_keep_the_promised_miss(upper):
    bins = decontaminate.bins_for(upper)
    if bins is None:
        return
    window, lower = 4 * upper, upper // 4 + 1
    shared = -(-80 * lower // 100)
    seen = (1 - np.exp(-window / bins)) * bins / window
    assert (1 - seen) ** shared <= decontaminate.MISS
