from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obslake.llm import infill

MARKS = ("<P>", "<S>", "<M>")


def brute(doc_id, text, unit="line", seed=7, fim=100, spm=50):
    """By code points all through: no bytes, no index."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in MARKS) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\n éß€😀𐍈\u0000<PSM>", max_size=60))
def test_index_converts_every_boundary_both_ways(text):
    index = infill.ExceptionIndex(text.encode())
    places = np.array([len(text[:k].encode()) for k in range(len(text) + 1)], np.int64)
    points = np.arange(len(text) + 1)
    assert index.n_points == len(text)
    assert (index.to_bytes(points) == places).all() and (index.to_points(places) == points).all()
    assert len(index.starts) == sum(not c.isascii() for c in text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab\n é€😀<PSM>", max_size=60), st.integers(0, 10**6), st.sampled_from(infill.UNITS), st.integers(0, 100), st.integers(0, 100))
def test_transform_equals_cutting_by_code_points(text, doc_id, unit, fim, spm):
    *got, output = infill.transform(text.encode(), doc_id, 7, unit, fim, spm, tuple(m.encode() for m in MARKS))
    assert (*got, output.decode()) == brute(doc_id, text, unit, 7, fim, spm)


@pytest.mark.parametrize("unit", infill.UNITS)
def test_awkward_rows(spark, awkward, clashing, nothing, unit):
    long = "é€😀x\n" * 200_000
    more = spark.createDataFrame(
        [(20, long, "en", "a", 1), (21, "a <S> b\nc", "en", "a", 1), (22, "\n\n\n", "en", "a", 1), (23, "<P\n<S\n<M\nP>", "en", "a", 1), (24, "no end\nhere", "en", "a", 1)],
        awkward.schema,
    )
    given_rows = awkward.union(more)
    made = infill.infilled(given_rows, unit=unit).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert len(made) == given_rows.count()
    for r in made:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text, unit)
        assert r.back == (r.text or "")
    assert infill.infilled(nothing).collect() == []
    clash = clashing.withColumn("form", F.lit("mine")).withColumn("__infilled", F.lit("kept"))
    again = infill.infilled(clash)
    assert again.columns == [c for c in clash.columns if c not in ("n", "form")] + ["n", "form", "prefix_chars", "middle_chars", "output"]
    assert {r.form for r in again.collect()} <= {"plain", "psm", "spm"} and {r["__infilled"] for r in again.collect()} == {"kept"}


def test_other_sentinels_and_shares(spark):
    marks = ("[pre]", "[suf]", "[mid]")
    df = spark.createDataFrame([(k, f"line {k}\n<P> é {k}\nend") for k in range(200)], "doc_id long, text string")
    made = infill.infilled(df, unit="character", fim_percent=70, spm_percent=0, sentinels=marks)
    rows = made.withColumn("back", infill.restored(F.col("output"), F.col("form"), marks)).collect()
    assert all(r.back == r.text for r in rows) and {r.form for r in rows} == {"plain", "psm"}
    assert 100 < sum(r.form == "psm" for r in rows) < 175


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "bc", "xy"), ("aXa", "q", "w"), ("abc", "b", "w")])
def test_sentinels_that_could_be_read_across_a_cut_are_refused(marks):
    with pytest.raises(ValueError):
        infill.fill_in_middle(F.col("text"), F.col("doc_id"), sentinels=marks)
