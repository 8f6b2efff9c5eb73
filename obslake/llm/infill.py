"""Fill-in-the-middle documents, cut at code points by a sparse index of multibyte characters.

Texts stay UTF-8 bytes. Of each text only the characters of more than one byte are recorded: their
positions, and how many bytes beyond one per character lie before them. A cut between the two
measures is one binary search in these lists; between exceptions a code point is a byte, so
spans of ASCII cost arithmetic only, and an ASCII text has an empty index.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNITS = ("line", "character")

#: What ``fill_in_middle`` adds.
RESULT = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>"


class ExceptionIndex:
    """Where the bytes of a UTF-8 text run ahead of its code points."""

    def __init__(self, text: bytes):
        self.n_bytes = len(text)
        if text.isascii():
            self.starts = self.excess = self.points = np.empty(0, np.int64)
            self.n_points = self.n_bytes
            return
        data = np.frombuffer(text, np.uint8)
        self.starts = np.flatnonzero(data >= 0xC0)  # first bytes of multibyte characters
        lead = data[self.starts]
        # Bytes beyond one, of this character and those before it: 1 from C0, 2 from E0, 3 from F0.
        self.excess = np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0))
        before = np.concatenate(([0], self.excess[:-1]))
        self.points = self.starts - before
        self.n_points = self.n_bytes - int(self.excess[-1])

    def _excess_before(self, places: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Excess bytes of the characters that start before each of ``places``."""
        if not len(of):
            return np.zeros(len(places), np.int64)
        at = np.searchsorted(of, places)
        return np.where(at > 0, self.excess[np.maximum(at, 1) - 1], 0)

    def to_bytes(self, points: np.ndarray) -> np.ndarray:
        """Byte offsets of code point offsets, 0 to the length included."""
        return points + self._excess_before(points, self.points)

    def to_points(self, offsets: np.ndarray) -> np.ndarray:
        """Code point offsets of byte offsets that are character boundaries."""
        return offsets - self._excess_before(offsets, self.starts)


def _cut(text: bytes, unit: str, draws: tuple[int, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of units, and the two cuts as bytes and as code points."""
    index = ExceptionIndex(text)
    if unit == "character":
        count = index.n_points
        points = np.sort(np.array([d % (count + 1) for d in draws], np.int64))
        return count, index.to_bytes(points), points
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A) + 1
    if not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    if not text:
        ends = ends[:0]
    ends = np.concatenate(([0], ends))
    count = len(ends) - 1
    cuts = ends[np.sort(np.array([d % (count + 1) for d in draws], np.int64))]
    return count, cuts, index.to_points(cuts)


def draws_of(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the SHA-256 of ``seed:doc_id``; a missing id is empty."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def transform(
    text: bytes, doc_id: int | None, seed: int, unit: str, fim_percent: int, spm_percent: int, sentinels: tuple[bytes, bytes, bytes]
) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    one, other, form_draw, order_draw = draws_of(doc_id, seed)
    count, (start, end), (start_point, end_point) = _cut(text, unit, (one, other))
    if not text or any(s in text for s in sentinels) or form_draw % 100 >= fim_percent:
        return count, "plain", None, None, text
    p, s, m = sentinels
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if order_draw % 100 < spm_percent:
        form, output = "spm", b"".join((s, suffix, p, prefix, m, middle))
    else:
        form, output = "psm", b"".join((p, prefix, s, suffix, m, middle))
    return count, form, int(start_point), int(end_point - start_point), output


def fill_in_middle(
    text: Column,
    doc_id: Column,
    seed: int = 7,
    unit: str = "line",
    fim_percent: int = 100,
    spm_percent: int = 50,
    sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> Column:
    """A struct of n, form, prefix_chars, middle_chars and output, as ``RESULT`` says.

    The text is cut twice between its ``n`` units: lines with their line feed, or code points. Where the
    cuts fall, whether the text is moved at all (``fim_percent`` of all) and in which order
    (``spm_percent`` of those start with the suffix) depends on ``seed`` and ``doc_id`` alone, so
    equal rows get equal results. ``sentinels`` mark prefix, suffix and middle.

    A null text is empty. An empty text, and one that holds a sentinel, stays as it is: form plain, the
    two lengths null. A null doc_id is drawn for as an empty one. ``restored`` undoes it.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    marks = tuple(s.encode() for s in sentinels)
    _check_sentinels(sentinels)

    @F.arrow_udf(RESULT)
    def run(texts: pa.Array, ids: pa.Array) -> pa.Array:
        made = [
            transform(content or b"", key, seed, unit, fim_percent, spm_percent, marks)
            for content, key in zip(texts.cast(pa.binary()).to_pylist(), ids.to_pylist(), strict=True)
        ]
        n, form, prefix, middle, output = ([row[k] for row in made] for k in range(5))
        return pa.StructArray.from_arrays(
            [
                pa.array(n, pa.int64()),
                pa.array(form, pa.string()),
                pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()),
                pa.array(output, pa.binary()).cast(pa.string()),
            ],
            ["n", "form", "prefix_chars", "middle_chars", "output"],
        )

    return run(text, doc_id.cast("long"))


def _check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """No sentinel may begin as another one ends, or a mark could be read across a cut."""
    pairs = [(sentinels[i], sentinels[j], i == j) for i in range(3) for j in range(3)]
    for one, other, same in pairs:
        overlap = any(one.endswith(other[:k]) for k in range(1, min(len(one), len(other))))
        if not one or overlap or (not same and one in other):
            raise ValueError("sentinels must not be empty, equal, nested or overlap at their ends")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that ``fill_in_middle`` made ``output`` of; native."""
    p, s, m = (F.lit(one) for one in sentinels)

    def inner(first: Column, second: Column) -> tuple[Column, Column, Column]:
        """What follows each mark. No part holds a mark, so the first one found is the mark."""
        at, last = F.instr(output, second), F.instr(output, m)
        after_second, after_last = at + F.length(second), last + F.length(m)
        return (
            F.substring(output, F.length(first) + 1, at - F.length(first) - 1),
            F.substring(output, after_second, last - after_second),
            F.substring(output, after_last, F.length(output)),
        )

    prefix, suffix, middle = inner(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = inner(s, p)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def infilled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the fields of ``fill_in_middle``; columns of the same names are replaced, the rest stay."""
    names = ["n", "form", "prefix_chars", "middle_chars", "output"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    made = docs.select(F.struct(*kept).alias("row"), fill_in_middle(F.col(text), F.col(doc_id), **options).alias("made"))
    return made.select("row.*", *(F.col(f"made.{name}").alias(name) for name in names))
