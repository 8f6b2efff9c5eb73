"""Secret scans over an incremental blob ledger.

A version of a file is a path and a content; its blob is the content's SHA-256. The ledger says
which blobs were scanned by which version of which rule, and what was found. A scan looks up
the blobs of the versions it is given, reads each blob once and only for the rules whose
present version it has not seen, adds what it finds to the ledger, and joins the ledger's
findings back to all versions that hold the blob. Changing one rule's version scans all
blobs again for that rule alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.llm.scratch import stored

# The kinds asked for, in the order in which equal starts are listed.
BASE_KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ASSIGN_HINT = re.compile(r"[:=]")
# Leftmost runs of full length are the same as leftmost runs without the short ones.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")


def _assignments(text: str) -> list[tuple[int, int]]:
    if not _ASSIGN_HINT.search(text):
        return []
    return [m.span() for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]


def _pattern(expression: str, hint: str, flags: int = re.ASCII):
    compiled = re.compile(expression, flags)
    return lambda text: [m.span() for m in compiled.finditer(text)] if hint in text else []


def _first_at_boundary(text: str, low: int, high: int, wanted: re.Pattern) -> int:
    """The first place from ``low`` on where ``wanted`` matches before ``high`` and no word goes on; -1 if none."""
    for m in wanted.finditer(text, low, high):
        if m.start() == 0 or not _WORD.match(text[m.start() - 1]):
            return m.start()
    return -1


_WORD = re.compile(r"\w", re.ASCII)
_LETTER, _TOKEN_START = re.compile("[a-z]"), re.compile("eyJ(?=[A-Za-z0-9_-]{10})")
_SCHEME_BACK, _RUN_BACK = re.compile(r"[a-z0-9+.-]*+"), re.compile(r"[A-Za-z0-9_-]*+")
_CREDENTIALS = re.compile(r"[^\s/:@]++:[^\s/:@]++@", re.ASCII)
_TOKEN_REST = re.compile(r"\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+")


def _around(text: str, mark: str, back: re.Pattern, start: re.Pattern, rest: re.Pattern, skipped: int) -> list[tuple[int, int]]:
    """Leftmost spans that start with ``start`` at a word's edge, go on with characters of ``back`` up to a mark, and end with ``rest``.

    The marks are found first; from each the text is read forward once and back once, and neither
    reading goes beyond another mark, so the time is in proportion to the text's length.
    """
    found, at, before = [], 0, 0  # ends of the last span and of the last mark
    place = text.find(mark)
    while place >= 0:
        follow = rest.match(text, place + skipped)
        if follow:
            low = place - len(back.match(text[max(at, before) : place][::-1])[0])
            first = _first_at_boundary(text, low, place, start)
            if first >= 0:
                found.append((first, follow.end()))
                at = follow.end()
        before = place + 1
        place = text.find(mark, max(before, at))
    return found


def _url_passwords(text: str) -> list[tuple[int, int]]:
    r"""As ``\b[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@`` finds them."""
    return _around(text, "://", _SCHEME_BACK, _LETTER, _CREDENTIALS, 3)


def _web_tokens(text: str) -> list[tuple[int, int]]:
    r"""As ``\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}`` finds them."""
    return _around(text, ".eyJ", _RUN_BACK, _TOKEN_START, _TOKEN_REST, 0)


#: Finder of spans by kind; kinds after the base ones are the method's own.
FINDERS = {
    "assign": _assignments,
    "access": _pattern(_ACCESS.pattern, "AKIA"),
    "hex": lambda text: [m.span() for m in _HEX.finditer(text)],
    "private_key": _pattern(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]+-----END [A-Z ]*PRIVATE KEY-----)?", "PRIVATE KEY"),
    "jwt": _web_tokens,
    "forge_token": _pattern(r"\bgh[pousr]_[A-Za-z0-9]{36,}", "gh"),
    "chat_token": _pattern(r"\bxox[abprs]-[A-Za-z0-9-]{10,}", "xox"),
    "url_password": _url_passwords,
}
KINDS = tuple(FINDERS)
#: Present version of every rule. A change of a finder raises its number.
RULES = {kind: 1 for kind in KINDS}

_PAIR = "array<struct<rule:string,version:int>>"
_SPANS = "array<struct<kind:string,start:int,end:int>>"
_ENTRY = f"digest string, scanned {_PAIR}, spans {_SPANS}"


def _pairs(rules: dict[str, int]) -> Column:
    entries = [F.struct(F.lit(k).alias("rule"), F.lit(v).cast("int").alias("version")) for k, v in rules.items()]
    return F.array(*entries).cast(_PAIR)


def _scan(blobs: DataFrame) -> DataFrame:
    """Ledger entries of blobs (digest, content, pending): one for each blob."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, pending = batch.column("content").to_pylist(), batch.column("pending")
            wanted = pending.to_pylist()
            found = [
                [{"kind": p["rule"], "start": a, "end": b} for p in pairs for a, b in FINDERS[p["rule"]](text or "")]
                for text, pairs in zip(contents, wanted, strict=True)
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pending, pa.array(found, kind)], ["digest", "scanned", "spans"])

    return blobs.select("digest", "content", "pending").mapInArrow(run, _ENTRY)


def _in_order(spans: Column) -> Column:
    """By start, then kind as listed, then end."""
    listed = F.array(*map(F.lit, KINDS))

    def keyed(s: Column) -> Column:
        place = F.array_position(listed, s.kind)
        return F.struct(s.start.alias("start"), place.alias("place"), s.end.alias("end"), s.kind.alias("kind"))

    ordered = F.array_sort(F.transform(spans, keyed))
    return F.transform(ordered, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end")))


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """Entries that finished scans have left at ``path``; none if there is nothing yet."""
    try:
        return spark.read.schema(_ENTRY).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)


def scan(versions: DataFrame, ledger_path: str, rules: dict[str, int] | None = None) -> DataFrame:
    """``versions`` (path, content) with the blob's digest and spans, array of (kind, start, end).

    Starts and ends count code points, ends exclusive; spans of one kind are leftmost and do not
    overlap, and stand by start, then kind in the order of ``KINDS``. ``rules`` are the kinds to look
    for and their versions. What is not in the ledger is scanned and added there; repeated versions and
    equal contents are scanned once. A null content is an empty blob; a null path is a path
    like others. Columns besides these two are dropped. An empty table adds nothing.
    """
    spark, rules = versions.sparkSession, rules or RULES
    content = F.coalesce("content", F.lit(""))
    named = versions.select("path", content.alias("content"), F.sha2(content, 256).alias("digest"))
    keys = stored(named.select("path", "digest"), "blobs")

    # Of the versions with equal contents that of the least path is read. Rows that share it are
    # read each and entered once.
    readers = keys.groupBy("digest").agg(F.min(F.coalesce(F.col("path").cast("string"), F.lit(""))).alias("reader"))
    seen = _ledger(spark, ledger_path).groupBy("digest").agg(F.flatten(F.collect_list("scanned")).alias("seen"))
    pending = F.array_except(_pairs(rules), F.coalesce("seen", F.array().cast(_PAIR)))
    unseen = readers.join(seen, "digest", "left").select("digest", "reader", pending.alias("pending")).where(F.size("pending") > 0)
    blobs = named.withColumn("reader", F.coalesce(F.col("path").cast("string"), F.lit("")))
    entries = _scan(blobs.join(unseen, ["digest", "reader"]).select("digest", "content", "pending"))
    paths = keys.groupBy("path").count().where("count > 1")
    if not paths.isEmpty():
        entries = entries.dropDuplicates(["digest"])
    entries.write.mode("append").parquet(ledger_path)

    wanted = F.filter("spans", lambda s: s.kind.isin(*rules))
    latest = _pairs(rules)
    # Scans at the same time, and a repeated append, enter a blob more than once: equal spans are one.
    current = _ledger(spark, ledger_path).where(F.arrays_overlap("scanned", latest)).where(F.size("spans") > 0)
    # An entry counts for the rules it was made by in their present versions.
    by_rule = F.filter(wanted, lambda s: F.exists("scanned", lambda p: (p.rule == s.kind) & F.array_contains(latest, p)))
    found = current.select("digest", by_rule.alias("spans")).groupBy("digest").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))
    joined = keys.join(found, "digest", "left")
    return joined.select("path", "digest", _in_order(F.coalesce("spans", F.array().cast(_SPANS))).alias("spans"))
