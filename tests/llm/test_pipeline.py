from __future__ import annotations

from collections import Counter

import corpus_pipeline
from obslake.llm import near_dedup
from obslake.llm.queries import QUERIES
from obslake.llm.twins import TWINS
from tests.conftest import MEDIUM
from tests.llm.conftest import DOCUMENTS, sentence
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_mixing import brute_targets
from tests.llm.test_near_dedup import brute as near
from tests.llm.test_quality import verdicts


def rows_of(df):
    return df.collect()


def test_stages_one_by_one(spark):
    """Each stage against brute force over what the one before has kept."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    given = rows_of(docs)

    def stage(name, rows):
        return rows_of(stages[name](spark, spark.createDataFrame(rows, docs.schema), MEDIUM))

    good = stage(names[0], given)
    keeps = verdicts([(r.doc_id, r.text, r.source) for r in given])
    assert sorted(r.doc_id for r in good) == sorted(r.doc_id for r, k in zip(given, keeps, strict=True) if k)

    single = stage(names[1], good)
    assert sorted(r.doc_id for r in single) == sorted(d for d, _, _, kept in near([(r.doc_id, r.text) for r in good], 5) if kept)

    clean = stage(names[2], single)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{MEDIUM}/benchmark.parquet").collect()]
    spoilt = {doc for doc, *_ in leaks([(r.doc_id, r.text) for r in single], items)}
    assert spoilt and sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in single if r.doc_id not in spoilt)

    mixed = stage(names[3], clean)
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in clean:
        sizes[r.source] += len(r.text.split())
        largest[r.source] = max(largest[r.source], len(r.text.split()))
    for r in mixed:
        taken[r.source] += len(r.text.split())
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3 and {tuple(r) for r in mixed} <= {tuple(r) for r in clean}
    assert all(abs(taken[s] - t) <= largest[s] for s, t in brute_targets(sizes).items())

    sharded = stage(names[4], mixed)
    assert Counter(r[:5] for r in sharded) == Counter(tuple(r) for r in mixed)
    total, bytes_in = sum(len(r.text.encode()) + 1 for r in mixed), Counter()
    for r in sharded:
        bytes_in[r.shard] += len(r.text.encode()) + 1
    assert all(abs(bytes_in[k] - total / 16) <= max(len(r.text.encode()) for r in mixed) + 1 for k in range(16))


def test_whole_run(spark):
    rows = corpus_pipeline.run(spark, MEDIUM).collect()
    assert rows and {"doc_id", "text", "shard", "slot"} <= set(rows[0].asDict())


def test_near_duplicates_are_dropped_by_row(spark):
    a, b, c, d, e = (sentence(70 + k, 200, 5000) for k in range(5))
    given = [(1, a), (5, a), (5, b), (6, c), (6, c), (7, "x " + c), (None, d), (8, d + " x"), (None, e), (None, e + " x"), (None, "alone"), (None, ""), (9, None), (9, None)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in given], DOCUMENTS)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, MEDIUM).collect()]
    either = [row for row in kept if row in given[8:10]]
    assert len(either) == 1
    assert Counter(kept) == Counter([(1, a), (5, b), (6, c), (8, d + " x"), either[0], (None, "alone"), (None, ""), (9, None), (9, None)])
    found = near_dedup.near_duplicates(docs, width=5).collect()
    assert sorted(r.component_id for r in found if r.doc_id is None and r.component_id is not None) == [8]


def test_awkward_documents_pass_every_stage(spark, awkward, clashing, nothing):
    """Every stage but the last hands on rows of its input, whole and with their own values."""
    for df in (awkward, clashing, nothing):
        given = Counter(map(repr, df.collect()))
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, MEDIUM)
            if name == "sharding":
                others = [c for c in df.columns if c not in ("shard", "slot")]
                assert out.columns == [*others, "shard", "slot"]
                assert Counter(map(repr, out.select(*others).collect())) == Counter(map(repr, df.select(*others).collect()))
            else:
                assert out.columns == df.columns and set(map(repr, out.collect())) <= set(given), name


def test_queries_have_the_names_of_their_operators():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert set(TWINS) <= set(QUERIES)


def test_first_stages_take_documents_in_small_batches(spark):
    docs = spark.createDataFrame([(1, sentence(1, 100), "en", "a", 1)], DOCUMENTS)

    def rows_at_once():
        def run(batches):
            import pyarrow as pa

            for batch in batches:
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

        return max(r.n for r in spark.range(0, 5000, 1, 1).mapInArrow(run, "n long").collect())

    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.near_duplicates):
        docs = stage(spark, docs, MEDIUM)
        assert rows_at_once() == int(corpus_pipeline.DOCUMENTS_AT_ONCE)
    corpus_pipeline.benchmark_decontamination(spark, docs, MEDIUM)
    assert rows_at_once() == 5000
