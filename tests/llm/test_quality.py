from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obslake.llm import quality
from tests.llm.conftest import DOCUMENTS, sentence

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """The measures by their definitions."""
    text = text or ""
    words = WORDS.findall(text)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    repeats = sum(line in lines[:k] for k, line in enumerate(lines))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines), repeats, len(covered))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \t\n\x0b\r\x1c é😀#|", max_size=80))
def test_measures_follow_their_definitions(text):
    assert quality.measure(text.encode()) == brute(text)


def verdicts(docs):
    """kept by row, from exact rates by host."""
    rows, hosts = [], defaultdict(lambda: [0, 0])
    for _, text, host in docs:
        n, chars, symbols, lines, dup, repeat = brute(text)
        base = n < 50 or 100 * repeat > 50 * n
        failed = base + (10 * symbols > n) + (10 * dup > 3 * lines) + (chars < 3 * n or chars > 10 * n) + (5 * repeat > n)
        rows.append((host, base, failed))
        hosts[host][0] += 1
        hosts[host][1] += failed > 0
    rates = [f / n for n, f in hosts.values()]
    mean = sum(rates) / len(rates)
    variance = sum((r - mean) ** 2 for r in rates) / len(rates)
    chance = sum(1 / n for n, _ in hosts.values()) / len(rates)
    own = (variance - mean * (1 - mean) * chance) / (1 - chance) if chance < 1 else 0
    weight = max(1.0, mean * (1 - mean) / own - 1) if own > 0 else None
    shrunk = {h: (f + weight * mean) / (n + weight) if weight else mean for h, (n, f) in hosts.items()}
    return [not base and failed < (1 if shrunk[host] > 0.5 else 2) for host, base, failed in rows]


def test_failed_documents_of_ill_reputed_hosts_go(spark):
    docs = []
    for k in range(40):
        host = ["good", "bad", "small", None][k % 4] if k % 7 else "good"
        text = sentence(k, 80)
        if host == "bad" and k % 3 or host == "small":
            text += " #" * 10
        docs.append((k, text + (" ##" * 30 if k == 11 else ""), host))
    df = spark.createDataFrame([(d, t, None, h, 1) for d, t, h in docs], DOCUMENTS)
    kept = {r.doc_id: r.kept for r in quality.assess(df).collect()}
    expected = verdicts(docs)
    assert [kept[k] for k in range(40)] == expected and 0 < sum(expected) < 40


def test_awkward_rows(awkward, clashing, nothing):
    docs = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    for df in (awkward, clashing):
        got = sorted(((r.doc_id, r.text, r.kept) for r in quality.assess(df).collect()), key=repr)
        assert got == sorted(((d, t, k) for (d, t, _), k in zip(docs, verdicts(docs), strict=True)), key=repr)
    assert quality.assess(nothing).collect() == []


@pytest.mark.parametrize("text", ["a " * 60, "x"])
def test_one_host_takes_the_mean(spark, text):
    df = spark.createDataFrame([(1, text, None, "s", 1)], DOCUMENTS)
    assert [r.kept for r in quality.assess(df).collect()] == verdicts([(1, text, "s")])


def test_hosts_that_differ_by_chance_only_are_not_judged(spark):
    failing = [0] * 34 + [1] * 52 + [2] * 14
    docs = [(f"h{h}", sentence(2 * h + k, 80) + " #" * 10 * (k < n)) for h, n in enumerate(failing) for k in range(2)]
    df = spark.createDataFrame([(k, text, None, host, 1) for k, (host, text) in enumerate(docs)], DOCUMENTS)
    rows = quality.assess(df).collect()
    assert sum(r.n_failed for r in rows) == 80 and all(r.kept for r in rows)
