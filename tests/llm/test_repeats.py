from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from obslake.llm import repeats
from obslake.llm.text import WordHashes, lower_words
from tests.llm.conftest import DOCUMENTS, sentence

LEAST = repeats.LEAST_WORDS


def brute(docs):
    """Places of words in a row of LEAST words that another text has, by row."""
    words = [tuple(lower_words((t or "").encode())) for _, t in docs]
    holders = defaultdict(set)
    for w in words:
        for k in range(len(w) - LEAST + 1):
            holders[w[k : k + LEAST]].add(w)
    out = set()
    for row, w in enumerate(words):
        copies = words.count(w) > 1
        for k in range(len(w) - LEAST + 1):
            if copies or len(holders[w[k : k + LEAST]]) > 1:
                out.update((row, j) for j in range(k, k + LEAST))
    return out


def found(spark, docs):
    df = spark.createDataFrame([(k, t, None, None, 1) for k, (_, t) in enumerate(docs)], DOCUMENTS)
    return {(r.doc_id, j) for r in repeats.repeated_passages(df).collect() for j in range(r.start_word, r.end_word)}


def corpus():
    rng = random.Random(7)
    passages = [sentence(100 + k, n, 5000) for k, n in enumerate([49, 50, 51, 70, 130, 400])]
    docs = []
    for k in range(60):
        parts = [sentence(500 + k, rng.randrange(1, 200), 5000)]
        for passage in rng.sample(passages, rng.randrange(3)):
            parts += [passage, sentence(900 + k, rng.randrange(1, 60), 5000)]
        docs.append((k, " ".join(parts)))
    docs += [(100, docs[3][1]), (101, docs[3][1].upper()), (102, passages[1]), (103, passages[0]), (104, passages[0])]
    # Nested passages: what follows is shared by many, what stands before by two.
    head, tail = sentence(1, 30, 5000), sentence(2, 30, 5000)
    docs += [(200 + k, f"{sentence(3000 + k, 20, 5000)} {tail} {sentence(4000 + k, 70, 5000)}") for k in range(25)]
    docs += [(300 + k, f"{sentence(5000 + k, 20, 5000)} {head} {tail} {sentence(6000 + k, 70, 5000)}") for k in range(2)]
    return docs + [(400, "same words again " * 200), (401, "same words again " * 20), (402, "la " * 90), (403, "la " * 70)]


def test_passages_of_all_lengths(spark):
    docs = corpus()
    expected = brute(docs)
    assert len({row for row, _ in expected}) > 30
    assert found(spark, docs) == expected


def test_a_passage_in_very_many_documents(spark):
    passage = sentence(9, 60, 5000)
    docs = [(k, f"{sentence(k, 30 + k % 40, 5000)} {passage} {sentence(5000 + k, 40, 5000)}") for k in range(400)]
    assert found(spark, docs) == brute(docs)


def test_a_head_that_few_have_before_a_tail_that_all_have(spark):
    docs = []
    for case in range(36):  # which words are lost depends on the place of least hash
        head, tail = sentence(2 * case, 20, 5000), sentence(2 * case + 1, 52 + case % 9, 5000)
        for k in range(12):
            seed = 1000 + 30 * case + k
            before = head if k < 2 else sentence(seed + 10_000, 20, 5000)
            docs.append((len(docs), f"{sentence(seed, 20, 5000)} {before} {tail} {sentence(seed + 20_000, 70, 5000)}"))
    assert found(spark, docs) == brute(docs)


def rows_stored(monkeypatch):
    """Number of rows by purpose, of all that is stored from now on."""
    rows, stored = defaultdict(int), repeats.stored

    def counting(df, purpose):
        table = stored(df, purpose)
        rows[purpose] += table.count()
        return table

    monkeypatch.setattr(repeats, "stored", counting)
    return rows


def test_windows_are_stored_for_large_groups_only(spark, monkeypatch):
    docs = corpus()
    expected, rows = brute(docs), rows_stored(monkeypatch)
    assert found(spark, docs) == expected
    assert rows["shared-runs"] and not rows["windows"]
    monkeypatch.setattr(repeats, "LARGE", 0)
    assert found(spark, docs) == expected
    assert rows["windows"]
    monkeypatch.setattr(repeats, "LARGE", 10)
    assert found(spark, docs) == expected


def test_portions_end_where_a_key_does(monkeypatch):
    monkeypatch.setattr(repeats, "_PLACES_AT_ONCE", 5)
    keys = [1, 1, 2, 3, 3, 3, 3, 3, 3, 3, 3, 4, 5]
    batches = [pa.RecordBatch.from_pydict({"key": keys[k : k + 2]}) for k in range(0, len(keys), 2)]
    portions = [table.column("key").to_pylist() for table in repeats._whole_groups(iter(batches))]
    assert [key for portion in portions for key in portion] == keys
    assert len(portions) > 1 and all(a[-1] != b[0] for a, b in zip(portions, portions[1:], strict=False))
    assert list(repeats._whole_groups(iter([batches[0].slice(0, 0)]))) == []


def test_awkward_rows(spark, awkward, clashing, nothing):
    rows = sorted(map(repr, repeats.repeated_passages(awkward).collect()))
    assert rows and sorted(map(repr, repeats.repeated_passages(clashing).collect())) == rows
    assert {r.doc_id for r in repeats.repeated_passages(awkward).collect()} == {4, 5, 6, 7}
    assert repeats.repeated_passages(nothing).collect() == []


def test_kept_positions_cover_every_window():
    for seed, words in ((1, 400), (2, 3), (3, 1)):
        hashes = WordHashes().of(lower_words(sentence(seed, 500, words).encode()))
        runs, minima = repeats.window_minima(hashes)
        naive = np.array([runs[k : k + repeats.WINDOW].min() for k in range(len(runs) - repeats.WINDOW + 1)])
        assert (minima == naive).all()
        kept = repeats.anchors(runs, minima)
        assert sorted(kept) == [p for p in range(len(runs)) if (naive[max(0, p - repeats.WINDOW + 1) : p + 1] == runs[p]).any()]
        for p in kept[:20]:
            first, last = repeats.windows_of(int(p), runs, minima)
            assert (naive[first : last + 1] == runs[p]).all() and first <= p < last + repeats.WINDOW
