from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslake.llm import lines

BLANK = " \t\n\x0b\x0c\r"


def brute(rows, least=10, minimum=2):
    """(doc_id, n_lines, n_dropped, kept) for each (doc_id, text), in order."""

    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(BLANK))

    holders = defaultdict(list)
    for doc, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            holders[k].append(doc)
    out = []
    for doc, text in rows:
        kept = []
        every = (text or "").split("\n")
        for line in every:
            docs = holders[key(line)]
            owner = min((d for d in docs if d is not None), default=None)
            if len(key(line)) < least or len(docs) < minimum or owner is None or owner == doc:
                kept.append(line)
        out.append((doc, len(every), len(every) - len(kept), "\n".join(kept)))
    return out


def got(df):
    return [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()]


def order(rows):
    return sorted(rows, key=repr)


def corpus(seed, count):
    """Lines of a few kinds, some in very many documents."""
    rng = random.Random(seed)
    common = [f"Common line number {k}" for k in range(30)]
    out = []
    for doc in range(count):
        text = []
        for _ in range(rng.randint(0, 12)):
            line = rng.choice([common[0], rng.choice(common), f"own line {rng.random()}", "short", "  É" + "é" * 8, "x" * rng.randint(8, 11), ""])
            text.append(rng.choice([line, line.upper(), " \t" + line + "\r", line]))
        out.append((doc * 3 % 1009, "\n".join(text)))
    return out


@pytest.mark.parametrize("count", [0, 1, 2, 63, 64, 65, 5000])
def test_perfect_hash_is_minimal(count):
    rng = np.random.default_rng(count)
    hashes = rng.integers(0, 2**63, (count, 2)).astype(np.uint64)
    hashes[: count // 2, 0] = 7  # told apart by the second number alone
    perfect = lines.PerfectHash.of(hashes)
    assert sorted(perfect.number(hashes).tolist()) == list(range(count))
    assert 64 * len(perfect.words) <= 5 * count + 64 * 40
    strange = rng.integers(0, 2**63, (1000, 2)).astype(np.uint64)
    answers = perfect.number(strange)
    assert ((answers >= -1) & (answers < max(1, count))).all()


@pytest.mark.parametrize(("least", "minimum"), [(10, 2), (1, 3), (10, 400)])
def test_equals_brute_force(spark, least, minimum):
    rows = corpus(least, 700)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert order(got(lines.dedup_lines(df, least_chars=least, min_documents=minimum))) == order(brute(rows, least, minimum))


def test_many_shards_and_a_line_in_all_documents(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_HASHES", 16)
    monkeypatch.setattr(lines, "SHARD_PROBES", 40)
    rows = [(d, "the line that everybody has\n" + t) for d, t in corpus(5, 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    assert order(got(lines.dedup_lines(df))) == order(brute(rows))


def test_index_answers_members_only(spark):
    keys = [f"key number {k}".encode() for k in range(3000)]
    hashes = lines._hashes(keys).view(np.int64)
    rows = [(int(a), int(b), -5 + k * 10**12, 2 + k % 700) for k, (a, b) in enumerate(hashes.tolist())]
    index = lines.build_index(spark.createDataFrame(rows, "h1 long, h2 long, owner long, n long"), 4).collect()
    assert sum(r.n for r in index) == 3000
    others = lines._hashes([f"other {k}".encode() for k in range(20000)])
    seen = 0
    for r in index:
        shard = lines.Shard(r.asDict())
        mine = np.mod(hashes[:, 0], 4) == r.shard
        count, owner = shard.look_up(lines._hashes(keys)[mine])
        at = np.flatnonzero(mine)
        assert (count == 2 + at % 700).all() and (owner == -5 + at * 10**12).all()
        assert not shard.look_up(others)[0].any()
        seen += mine.sum()
    assert seen == 3000


def test_awkward_rows(spark, awkward, clashing, nothing):
    line = "a line in several documents"
    more = [
        (40, f"{line}\nx\n{line}", "en", "a", 1),
        (41, f" {line.upper()} \n{line}\nmine alone, really", "en", "a", 1),
        (None, f"{line}\nonly without id", "en", "a", 1),
        (None, "only without id\nonly without id", "en", "a", 1),
        (40, f"another\n{line}", "en", "a", 1),
        (42, "\n".join([line] * 50_000), "en", "a", 1),
        (43, f"\x1c{line}\x85", "en", "a", 1),
        (44, f"\x1c{line}\x85\n\n", "en", "a", 1),
    ]
    given = awkward.union(spark.createDataFrame(more, awkward.schema))
    rows = [(r.doc_id, r.text) for r in given.collect()]
    assert order(got(lines.dedup_lines(given))) == order(brute(rows))
    assert got(lines.dedup_lines(nothing)) == []
    clash = clashing.withColumn("n_lines", F.lit("mine")).withColumn("row", F.lit("kept")).withColumn("lines", F.lit("kept"))
    again = lines.dedup_lines(clash)
    assert again.columns == [c for c in clash.columns if c != "n_lines"] + ["n_lines", "n_dropped", "kept_text"]
    assert order(got(again)) == order(brute([(r.doc_id, r.text) for r in awkward.collect()]))
    assert {(r.row, r["lines"], r.digest) for r in again.collect()} == {("kept", "kept", "x")}


def test_copies_without_number_stay_one_list(spark):
    """Rows repeated whole, a third of all, give one list of lines."""
    rows = [(5, "some line here\nsome other line")] * 3000 + [(1, "some line here")] + [(k, f"own text {k}") for k in range(100, 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = lines.dedup_lines(df).where("doc_id = 5").groupBy("n_dropped", "kept_text").count().collect()
    assert [tuple(r) for r in out] == [(1, "some other line", 3000)]


def test_documents_are_dealt_by_key_at_every_size(spark):
    docs = spark.createDataFrame([(1, "a line that two have\nx"), (2, "y\na line that two have")], "doc_id long, text string")
    deduped = lines.dedup_lines(docs)
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert sorted(r.kept_text for r in deduped.collect()) == ["a line that two have\nx", "y"]
