from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obslake.llm import runs
from obslake.llm.queries import op11_periodic_runs
from tests.conftest import MEDIUM, SMALL


def brute(words, least=24, periods=3):
    """Every period: stretches of places whose words are equal ``q`` apart."""
    found = {}
    n = len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= 2 * q and (start, length) not in found:
                found[start, length] = q
    return sorted(((s, n, q) for (s, n), q in found.items() if n >= max(least, periods * q)), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def periodic(seed, letters=3):
    """Random words with repeated stretches, nested and side by side."""
    rng = random.Random(seed)
    words = []
    while len(words) < 150:
        base = [f"w{rng.randrange(letters)}" for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.3:
            base = base * 3 + base[:1]
        words += (base * rng.randint(1, 9))[: rng.randint(1, 80)]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3, 30])
def test_runs_equal_brute_force(letters):
    texts = [periodic(seed, letters) for seed in range(60)] + [[], ["a"], ["a"] * 24, ["a"] * 23, ["a", "b"] * 12]
    for least, periods in ((24, 3), (1, 2), (10, 2), (6, 5)):
        got = runs.runs_of([[w.encode() for w in t] for t in texts], least, periods)
        assert got == [brute(t, least, periods) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=30), max_size=6))
def test_all_runs_of_short_strings(texts):
    words = [[c.encode() for c in t] for t in texts]
    got = runs.runs_of(words, 1, 2)
    assert got == [brute(list(t), 1, 2) for t in texts]
    for t, w, r in zip(texts, words, got, strict=True):
        assert runs.collapse(w, r).decode() == collapsed(list(t), r)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=25), min_size=1, max_size=5))
def test_ranks_order_the_suffixes(texts):
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    ranks = runs.Ranks(np.array(sum(texts, []), np.int64), bounds)
    while len(ranks.open):
        ranks.double()
    places = sorted(range(bounds[-1]), key=lambda i: (ranks.start[i], texts[np.searchsorted(bounds, i, side="right") - 1][i - ranks.start[i] :]))
    assert ranks.levels[-1][places].tolist() == list(range(bounds[-1]))


def test_a_long_text_takes_time_in_proportion():
    import time

    for words in (["a"] * 200_000, ["a", "b", "c"] * 60_000, [f"w{i % 7}{i % 11}" for i in range(150_000)]):
        began = time.time()
        (got,) = runs.runs_of([[w.encode() for w in words]])
        assert len(got) == 1 and got[0][1] == len(words)
        assert time.time() - began < 30


def expected(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words) if len(words) < 4000 else [tuple(r) for r in runs.runs_of([[w.encode() for w in words]])[0]]
    top = min(found, key=lambda r: (-1000000007 * r[1] / r[2], r[0], r[2]), default=None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (
        doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, found).encode()).hexdigest(),
    )


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_query_equals_brute_force(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    if folder == MEDIUM:  # brute force is quadratic: all with a planted tail, and some more
        docs = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 10 == 0 or d[0] % 7 == 0]
    wanted = {row[0]: row for row in (expected(*d) for d in docs)}
    got = op11_periodic_runs(spark, folder)
    assert got.columns == "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    rows = {r.doc_id: tuple(r) for r in got.collect()}
    assert {k: rows[k] for k in wanted} == wanted and any(row[1] for row in wanted.values())


def test_awkward_rows(spark, awkward, clashing, nothing):
    more = [(30, "a " * 100_000, "en", "a", 1), (31, "ab\x1ccd " * 30, "en", "a", 1), (32, "é ü é ü " * 12, "en", "a", 1), (33, "x y " * 12 + "x", "en", "a", 1)]
    given_rows = awkward.union(spark.createDataFrame(more, awkward.schema))
    for r in runs.with_runs(given_rows).collect():
        words = [w.decode() for w in (r.text or "").encode().split()]
        found = [(0, 100_000, 1)] if r.doc_id == 30 else brute(words)
        assert [tuple(x) for x in r.runs] == found
        assert r.collapsed == collapsed(words, found) and (r.best is None) == (not found)
    assert runs.with_runs(nothing).collect() == []
    clash = clashing.withColumn("best", F.lit("mine")).withColumn("made", F.lit("kept")).withColumn("row", F.lit("kept"))
    again = runs.with_runs(clash)
    assert again.columns == [c for c in clash.columns if c != "best"] + ["runs", "best", "collapsed"]
    assert {(r.made, r.row) for r in again.collect()} == {("kept", "kept")}


def test_planting_leaves_rows_without_id_and_text(spark):
    df = spark.createDataFrame([(None, "a b c"), (18, None), (18, " "), (None, None)], "doc_id long, text string")
    got = df.select(runs.with_planted_period(F.col("doc_id"), F.col("text")).alias("t")).collect()
    assert [r.t for r in got] == ["a b c", None, " ", None]
