"""Quality rules with verdicts by host.

Each document is measured and tested by rules of its own. The share of documents that fail is
estimated for each host, shrunk towards the mean of all hosts with a beta prior fitted to the
hosts by moments, so that a host with few documents is not judged by chance. A host whose
shrunk rate is above ``HOST_RATE`` is in ill repute: there one failed rule suffices to reject a
document, elsewhere it takes ``RULES_ELSEWHERE``. Documents that fail no rule are kept everywhere.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.llm.scratch import stored
from obslake.llm.text import to_bytes, words

HOST_RATE = 0.5
RULES_ELSEWHERE = 2
LEAST_WORDS = 50
SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_KIND = pa.struct([(name, pa.int64()) for name in MEASURES])


def repeat_words(tokens: list[bytes], width: int = 3) -> int:
    """Words that stand in a window of ``width`` words found at least twice."""
    windows = list(zip(*(tokens[k:] for k in range(width)), strict=False))
    seen, again = set(), set()
    if len(set(windows)) == len(windows):
        return 0
    for window in windows:
        (again if window in seen else seen).add(window)
    count, covered = 0, 0
    for k, window in enumerate(windows):
        if window in again:
            count += k + width - max(covered, k)
            covered = k + width
    return count


def measure(text: bytes) -> tuple[int, ...]:
    """The measures of one UTF-8 text, in the order of ``MEASURES``."""
    tokens = words(text)
    solid = b"".join(tokens)
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return (
        len(tokens),
        len(solid.decode("utf-8", "surrogatepass")),
        len(solid) - len(solid.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(tokens),
    )


def measures(text: Column) -> Column:
    @F.arrow_udf("struct<" + ",".join(f"{name}:bigint" for name in MEASURES) + ">")
    def run(texts: pa.Array) -> pa.Array:
        columns = list(zip(*map(measure, to_bytes(texts)), strict=True)) or [[]] * len(MEASURES)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_KIND))

    return run(text)


def _rules() -> dict[str, Column]:
    """Rules a document can fail, over the columns of ``MEASURES``; all in whole numbers."""
    n = F.col("n_words")
    return {
        "base_failed": (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * n),
        "symbols_failed": 10 * F.col("n_symbols") > n,
        "lines_failed": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "length_failed": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 10 * n),
        "repeats_failed": 5 * F.col("n_repeat_words") > n,
    }


def host_verdicts(tested: DataFrame) -> DataFrame:
    """(host, host_failed) from rows of host and n_failed.

    One row per host leaves the first aggregate, after a partial sum in every task. With f of n
    documents failing, m the mean of the hosts' rates, v their variance and a the mean of 1 / n, chance
    alone gives the rates a variance of m (1 - m) a; what the hosts themselves differ by is
    u = (v - m (1 - m) a) / (1 - a). The prior's weight is c = m (1 - m) / u - 1, at least one
    document, and the rate (f + c m) / (n + c); hosts that differ by no more than chance all get m.
    """
    hosts = tested.groupBy("host").agg(F.count("*").alias("n"), F.sum((F.col("n_failed") > 0).cast("long")).alias("f"))
    hosts = stored(hosts, "hosts")
    rates = F.col("f") / F.col("n")
    prior = hosts.agg(F.avg(rates).alias("m"), F.var_pop(rates).alias("v"), F.avg(1 / F.col("n")).alias("a")).first()
    mean, chance = prior.m or 0.0, prior.a or 0.0
    variance = (prior.v - mean * (1 - mean) * chance) / (1 - chance) if 0 < chance < 1 else 0.0
    if variance > 0:
        weight = max(1.0, mean * (1 - mean) / variance - 1)
        rate = (F.col("f") + weight * mean) / (F.col("n") + weight)
    else:
        rate = F.lit(mean)
    return hosts.select("host", (rate > HOST_RATE).alias("host_failed"))


def assess(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` with ``MEASURES``, the failed rules, host_failed and kept; all rows stay.

    Words are runs of anything but ASCII white space. A null text has no words and fails.
    Documents without host (null) are one host. Repeated rows count each and agree. An empty
    table gives an empty result; columns of ``docs`` with the added names are replaced. The texts
    are measured twice, before and after the hosts are known, which costs less than moving them.
    """
    rules = _rules()
    added = [*MEASURES, *rules, "n_failed", "host_failed", "kept"]
    plain = docs.drop(*(c for c in added if c not in (text, host)))

    def tested(df: DataFrame) -> DataFrame:
        with_measures = df.withColumn("__m", measures(F.col(text)))
        named = with_measures.withColumns({name: F.col(f"__m.{name}") for name in MEASURES}).drop("__m")
        failed = named.withColumns(rules)
        return failed.withColumn("n_failed", sum((F.col(r).cast("int") for r in rules), F.lit(0)))

    lean = plain.select(F.col(host).alias("__host"), F.col(text))
    verdicts = stored(host_verdicts(tested(lean).withColumnRenamed("__host", "host")), "verdicts")
    verdicts = verdicts.withColumnRenamed("host", "__host")
    joined = tested(plain).join(verdicts, F.col(host).eqNullSafe(F.col("__host"))).drop("__host")
    limit = F.when(F.col("host_failed"), 1).otherwise(RULES_ELSEWHERE)
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("n_failed") < limit))


def kept_documents(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, with all their own columns as they were."""
    lean = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text).alias("text"), F.col(host).alias("source"))
    return assess(lean).where("kept").select("row.*")
