from __future__ import annotations

import random

import numpy as np

from obslake.llm import near_dedup, prefixes
from obslake.llm.components import components
from obslake.llm.sketch import sketches
from obslake.llm.text import WordHashes, lower_words, mix, shingle_set
from tests.llm.conftest import DOCUMENTS, sentence


def brute(docs, width, percent=80):
    """component_id by row, from all pairs of distinct sets."""
    sets = []
    for _, text in docs:
        words = tuple(lower_words((text or "").encode()))
        n = min(width, len(words))
        sets.append(frozenset(words[k : k + n] for k in range(len(words) - n + 1)) if n else frozenset())
    label = list(range(len(docs)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= percent * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    out = []
    for k, (doc, _) in enumerate(docs):
        ids = [d for j, (d, _) in enumerate(docs) if root(j) == root(k) and d is not None]
        component = (min(ids) if ids else None) if sets[k] else doc
        out.append((doc, len(sets[k]), component, component is not None and doc == component))
    return out


def found(df, width):
    return sorted(map(tuple, near_dedup.near_duplicates(df, width=width).collect()), key=repr)


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(f"x{rng.random()}" if rng.random() < share else w for w in text.split(" "))


def test_edited_copies_chains_and_large_groups(spark):
    base, other = sentence(1, 150), sentence(2, 40)
    docs = [(k, edited(base, k, 0.01 * (k % 9))) for k in range(120)]
    docs += [(200 + k, edited(other, k, 0.05)) for k in range(40)]
    chain = sentence(3, 100).split(" ")
    docs += [(300 + k, " ".join(chain[:-5 * k or None] + [f"c{j}" for j in range(5 * k)])) for k in range(8)]
    docs += [(400 + k, sentence(50 + k, 60)) for k in range(30)] + [(500, docs[0][1].upper())]
    df = spark.createDataFrame([(d, t, None, "s", 1) for d, t in docs], DOCUMENTS)
    for width in (2, 5):
        assert found(df, width) == sorted(brute(docs, width), key=repr)


def test_templates_that_are_not_similar_do_not_meet(spark):
    base = sentence(7, 300, 4000)
    docs = [(k, edited(base, k, 0.09)) for k in range(260)]
    docs += [(1000 + k, edited(docs[9 * k][1], 5000 + k, 0.02)) for k in range(20)]
    df = spark.createDataFrame([(d, t, None, "s", 1) for d, t in docs], DOCUMENTS)
    assert found(df, 2) == sorted(brute(docs, 2), key=repr)


def test_crowds_whose_rarest_words_are_shared(spark):
    """Families of variants of one text, with the parts they share in common with many others."""
    rng = random.Random(4)
    parts = [sentence(100 + k, 12, 5000) for k in range(24)]
    docs = []
    for k in range(300):
        left = sorted(rng.sample(range(24), rng.randrange(15, 22)))
        docs.append((k, " ".join(parts[j] for j in left)))
    df = spark.createDataFrame([(d, t, None, "s", 1) for d, t in docs], DOCUMENTS)
    assert found(df, 2) == sorted(brute(docs, 2), key=repr)


def test_similar_sets_share_a_prefix_key():
    rng = np.random.default_rng(11)
    pool = mix(np.arange(1, 900, dtype=np.uint64))
    for percent in (50, 80, 95, 100):
        for _ in range(300):
            base = rng.choice(pool, rng.integers(1, 300), replace=False)
            more = np.setdiff1d(pool, base)[: int(len(base) * rng.random() * 0.3)]
            sets = [np.unique(base), np.unique(np.concatenate([base[: max(1, int(len(base) * (0.8 + 0.2 * rng.random())))], more]))]
            counts = rng.integers(2, 5, 1 << prefixes.PLACE_BITS) if percent != 95 else np.full(1 << prefixes.PLACE_BITS, 2)
            keys, owners, home = prefixes.prefix_keys(sets, counts, percent)
            shared = len(np.intersect1d(*sets))
            if 100 * shared >= percent * len(np.union1d(*sets)):
                common = np.intersect1d(keys[owners == 0], keys[owners == 1])
                assert np.isin(common, keys[home]).any()


def test_prefixes_of_no_sets_and_of_elements_of_one_set():
    counts = np.ones(1 << prefixes.PLACE_BITS, np.int32)
    one = np.unique(mix(np.arange(1, 90, dtype=np.uint64)))
    for sets in ([], [np.empty(0, np.uint64)], [one]):
        assert len(prefixes.prefix_keys(sets, counts, 80)[0]) == 0


def test_awkward_rows(awkward, clashing, nothing):
    expected = sorted(brute([(r.doc_id, r.text) for r in awkward.collect()], 2), key=repr)
    assert found(awkward, 2) == expected
    assert found(clashing, 2) == expected
    assert found(nothing, 2) == []


def test_a_doc_id_with_two_texts_is_judged_by_each(spark):
    docs = [(1, sentence(1, 60)), (2, sentence(2, 60)), (2, sentence(1, 60) + " end"), (0, sentence(2, 60) + " end")]
    df = spark.createDataFrame([(d, t, None, None, 1) for d, t in docs], DOCUMENTS)
    assert found(df, 2) == sorted(brute(docs, 2), key=repr)


def test_sketches_fill_every_coordinate_and_estimate_similarity():
    rng = np.random.default_rng(5)
    pool = mix(np.arange(1, 4000, dtype=np.uint64))
    sets = [np.unique(rng.choice(pool, n)) for n in (1, 2, 7, 60, 3000)]
    table = sketches([*sets, np.empty(0, np.uint64)], 128)
    assert (table[:-1] != np.uint64(2**64 - 1)).all() and (table[-1] == np.uint64(2**64 - 1)).all()
    errors = []
    for _ in range(60):
        both = rng.choice(pool, 400, replace=False)
        a, b = both[:300], both[100:]
        one, other = sketches([a, b], 256)
        errors.append((one == other).mean() - 0.5)
    assert abs(np.mean(errors)) < 0.02 and np.max(np.abs(errors)) < 0.15


def test_sketch_does_not_depend_on_the_batch():
    hashes = WordHashes()
    sets = [shingle_set(hashes.of(lower_words(sentence(k, 5 + 40 * k).encode())), 2) for k in range(9)]
    whole = sketches(sets, 64)
    assert all((sketches([one], 64)[0] == row).all() for one, row in zip(sets, whole, strict=True))


def test_components_of_paths_and_stars(spark):
    path = [(k, k + 1) for k in range(200, 260)]
    links = [*path, *[(5, k) for k in range(6, 90)], (1, 90), (89, 90), (300, 301), (301, 300), (7, 7)]
    rows = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert {rows[k] for k in range(200, 261)} == {200}
    assert {rows[k] for k in [1, *range(5, 91)]} == {1}
    assert rows[301] == rows[300] == 300
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
