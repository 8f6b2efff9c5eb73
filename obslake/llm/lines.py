"""Line dedup by a sharded minimal perfect hash.

Each line's key is hashed to 128 bits. Hashes are counted over all documents; those in fewer than
``min_documents`` are left out. The distinct hashes that stay are dealt to shards, and each shard
becomes one row: a minimal perfect hash, and arrays in its order with a fingerprint, the number of
documents and the smallest doc_id of each line. It takes some 17 bytes a line, and no line is stored.

Documents then probe the arrays instead of joining lines. A batch of documents packs the hashes of its lines
by shard into one row each, and those rows meet the shard's row in a stream: a task holds the arrays of
one shard and one packed row at a time. A shard that gets many probes, as that of a line which half of
all documents hold, is read by several tasks. What comes back for a document are the numbers of the lines
it loses.

A perfect hash gives some place to any hash whatever. The fingerprint there, the 64 bits of the hash
that do not choose the shard, tells whether it is the line's own: a line that is not in the index is
taken for one that is once in 2**64 looks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from obslake.llm.scratch import stored
from obslake.llm.text import mix, to_bytes

LEAST_CHARS, MIN_DOCUMENTS = 10, 2
#: Hashes of a shard at most, on average. Its arrays take about 17 bytes for each.
SHARD_HASHES = 1 << 18
#: Probes of a shard at most, on average; one with more, for its lines are common, is read by several tasks.
SHARD_PROBES = 1 << 19
#: Bits of the perfect hash's first level per hash.
_GAMMA = 2

_BLANK = b" \t\n\x0b\x0c\r"


# ---------------------------------------------------------------- keys


def line_key(line: bytes) -> bytes:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return line.strip(_BLANK).lower()


def long_keys(text: bytes, least_chars: int) -> tuple[list[bytes], list[int]]:
    """Keys of ``least_chars`` code points and more, in order, and the numbers of their lines."""
    keys, numbers = [], []
    for number, line in enumerate(text.split(b"\n")):
        if len(line) >= least_chars:
            key = line_key(line)
            if len(key) >= least_chars and (key.isascii() or len(key.decode()) >= least_chars):
                keys.append(key)
                numbers.append(number)
    return keys, numbers


def _hashes(keys: list[bytes]) -> np.ndarray:
    """Two 64-bit numbers for each key."""
    packed = b"".join(map(xxhash.xxh3_128_digest, keys))
    return np.frombuffer(packed, np.uint64).reshape(-1, 2)


def _distinct(keys: list[bytes], numbers: list[int]) -> tuple[list[bytes], list[int]]:
    """Each key once, with the first of its lines."""
    first: dict[bytes, int] = {}
    for key, number in zip(keys, numbers, strict=True):
        first.setdefault(key, number)
    return list(first), list(first.values())


# ---------------------------------------------------------------- minimal perfect hash


def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where a level of ``size`` bits has each hash."""
    seeded = mix(hashes[:, 0] ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) + hashes[:, 1]
    return (mix(seeded) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers distinct hashes 0 to n - 1 without storing them.

    A level is a bit array of twice as many bits as hashes are left. Hashes that have a bit to themselves
    stay there; the others go to the next level. A hash's number is that of the set bits
    before its own, over all levels one after another. It takes three to four bits a hash.
    """

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @classmethod
    def of(cls, hashes: np.ndarray) -> PerfectHash:
        sizes, parts = [], []
        while len(hashes):
            size = -(-_GAMMA * len(hashes) // 64) * 64
            place = _place(hashes, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            hashes = hashes[~alone[place]]
        return cls(sizes, np.concatenate(parts) if parts else np.empty(0, np.uint64))

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash; for one not among those given some number, or -1."""
        found = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            place = _place(hashes[left], level, size) + self.starts[level]
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            values = self.words[word]
            hit = (values >> bit) & np.uint64(1) == 1
            below = values & ((np.uint64(1) << bit) - np.uint64(1))
            found[left[hit]] = self.before[word[hit]] + np.bitwise_count(below[hit])
            left = left[~hit]
        return found


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest one needs."""
    most = int(values.max()) if len(values) else 0
    return values.astype(np.min_scalar_type(most)).tobytes()


def _unpacked(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // count}") if count else np.empty(0, np.uint64)


# ---------------------------------------------------------------- counting and the index


def _line_counts(docs: DataFrame, least_chars: int) -> DataFrame:
    """(h1, h2, owner, n): hashes of lines, the least doc_id and the number of documents with each.

    Lines that a batch has many times leave it as one row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list] = {}
            for doc, text in zip(batch.column("doc_id").to_pylist(), to_bytes(batch.column("text")), strict=True):
                for key in set(long_keys(text, least_chars)[0]):
                    entry = held.setdefault(key, [doc, 0])
                    entry[1] += 1
                    if entry[0] is None or (doc is not None and doc < entry[0]):
                        entry[0] = doc
            hashes = _hashes(list(held)).view(np.int64)
            owners, counts = [e[0] for e in held.values()], [e[1] for e in held.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), pa.array(owners, pa.int64()), pa.array(counts, pa.int64())],
                ["h1", "h2", "owner", "n"],
            )

    return docs.mapInArrow(run, "h1 long, h2 long, owner long, n long")


def shard_of(hash_column: Column, shards: int) -> Column:
    return F.pmod(hash_column, F.lit(shards)).cast("int")


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """(shard, n, sizes, words, fingerprints, counts, owners, lowest), one row per shard, of (h1, h2, owner, n).

    ``fingerprints``, ``counts`` and ``owners`` (less ``lowest``, the least of the shard) are in the order of
    the perfect hash that ``sizes`` and ``words`` make up.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_numpy() for c in ("h1", "h2", "owner", "n")]
        hashes = np.stack([c.astype(np.int64).view(np.uint64) for c in columns[:2]], axis=1)
        perfect = PerfectHash.of(hashes)
        order = np.argsort(perfect.number(hashes))
        owners, lowest = columns[2][order].astype(np.int64), int(columns[2].min())
        row = {
            "shard": [key[0].as_py()],
            "n": [len(order)],
            "sizes": [perfect.sizes],
            "words": [perfect.words.tobytes()],
            "fingerprints": [np.ascontiguousarray(hashes[order, 1]).tobytes()],
            "counts": [_packed(columns[3][order].astype(np.uint64))],
            "owners": [_packed((owners - lowest).view(np.uint64))],
            "lowest": [lowest],
        }
        return pa.table(row, schema=_INDEX_ARROW)

    named = counts.withColumn("shard", shard_of(F.col("h1"), shards))
    return named.groupBy("shard").applyInArrow(run, _INDEX)


_INDEX = "shard int, n long, sizes array<long>, words binary, fingerprints binary, counts binary, owners binary, lowest long"
_INDEX_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("n", pa.int64()),
        ("sizes", pa.list_(pa.int64())),
        ("words", pa.binary()),
        ("fingerprints", pa.binary()),
        ("counts", pa.binary()),
        ("owners", pa.binary()),
        ("lowest", pa.int64()),
    ]
)


class Shard:
    """One row of the index, ready to be probed."""

    def __init__(self, row: dict):
        count = row["n"]
        self.perfect = PerfectHash(row["sizes"], np.frombuffer(row["words"], np.uint64))
        self.fingerprints = np.frombuffer(row["fingerprints"], np.uint64)
        self.counts = _unpacked(row["counts"], count)
        self.owners, self.lowest = _unpacked(row["owners"], count), row["lowest"]

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, owner) of each hash; 0 documents for one that is not in the index."""
        number = self.perfect.number(hashes)
        place = np.maximum(number, 0)
        known = (number >= 0) & (self.fingerprints[place] == hashes[:, 1])
        owner = self.owners[place].astype(np.uint64).view(np.int64) + self.lowest
        return np.where(known, self.counts[place], 0), owner


# ---------------------------------------------------------------- probing

_PROBES = "shard int, part int, hashes binary, docs binary, named binary, texts binary, lines binary"


def _probes(docs: DataFrame, shards: int, least_chars: int) -> DataFrame:
    """For each batch of documents and each shard, the hashes of all lines there, packed.

    ``docs`` has doc_id, text and digest; rows equal in them are one. ``part`` deals the batches of a
    shard to tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            keys, lines, counts, seen = [], [], [], set()
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist(), to_bytes(batch.column("text")), strict=True)
            for doc, digest, text in rows:
                own, first = ([], []) if (doc, digest) in seen else _distinct(*long_keys(text, least_chars))
                seen.add((doc, digest))
                keys += own
                lines += first
                counts.append(len(own))
            hashes = _hashes(keys)
            shard = np.mod(hashes[:, 0].view(np.int64), shards)
            order = np.argsort(shard, kind="stable")
            ids = batch.column("doc_id")
            owner = np.repeat(np.arange(batch.num_rows), counts)[order]
            columns = (
                hashes[order],
                ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[owner],
                ids.is_valid().to_numpy(zero_copy_only=False)[owner],
                batch.column("digest").to_numpy(zero_copy_only=False).astype(np.int64)[owner],
                np.array(lines, np.int32)[order],
            )
            which, starts = np.unique(shard[order], return_index=True)
            ends = np.append(starts, len(order))[1:]
            spread = hash((int(columns[3][0]), number)) & 0x7FFFFFFF if len(order) else 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(which, pa.int32()),
                    pa.array(np.full(len(which), spread), pa.int32()),
                    *(pa.array([np.ascontiguousarray(c[a:b]).tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()) for c in columns),
                ],
                ["shard", "part", "hashes", "docs", "named", "texts", "lines"],
            )

    return docs.mapInArrow(run, _PROBES)


def _answers(index: DataFrame, probes: DataFrame, load: DataFrame, min_documents: int) -> DataFrame:
    """(doc_id, digest, lines): lines that lose to an earlier document, packed, from each shard.

    ``load`` has the shards that several tasks read, with the number of those ``parts``.
    """
    shared = F.coalesce("parts", F.lit(1))
    index = index.join(load, "shard", "left").withColumn("part", F.explode(F.sequence(F.lit(0), shared - 1))).drop("parts")
    probes = probes.join(load, "shard", "left").withColumn("part", F.pmod("part", shared)).drop("parts")
    met = index.withColumn("later", F.lit(False)).unionByName(probes.withColumn("later", F.lit(True)), allowMissingColumns=True)
    met = met.repartition("shard", "part").sortWithinPartitions("shard", "part", "later")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if not row["later"]:
                    place, held = (row["shard"], row["part"]), Shard(row)
                elif place == (row["shard"], row["part"]):
                    yield _lost(held, row, min_documents)

    return met.mapInArrow(run, "doc_id long, digest long, lines binary")


def _lost(shard: Shard, row: dict, min_documents: int) -> pa.RecordBatch:
    hashes = np.frombuffer(row["hashes"], np.uint64).reshape(-1, 2)
    docs, texts = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["texts"], np.int64)
    named, lines = np.frombuffer(row["named"], bool), np.frombuffer(row["lines"], np.int32)
    count, owner = shard.look_up(hashes)
    lost = np.flatnonzero((count >= min_documents) & ((owner != docs) | ~named))
    # Lines of a document stand together; one row for each.
    docs, texts, named, lines = docs[lost], texts[lost], named[lost], lines[lost]
    first = np.ones(len(lost), bool)
    first[1:] = (docs[1:] != docs[:-1]) | (texts[1:] != texts[:-1]) | (named[1:] != named[:-1])
    starts = np.flatnonzero(first)
    ends = np.append(starts, len(lost))[1:]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(docs[starts], pa.int64(), mask=~named[starts]),
            pa.array(texts[starts], pa.int64()),
            pa.array([lines[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary()),
        ],
        ["doc_id", "digest", "lines"],
    )


# ---------------------------------------------------------------- documents


def without_lines(text: bytes, numbers: np.ndarray) -> tuple[int, int, bytes]:
    """(lines, lines dropped, what is left): all lines with the key of one of ``numbers`` go."""
    lines = text.split(b"\n")
    if not len(numbers):
        return len(lines), 0, text
    keys = {line_key(lines[k]) for k in numbers.tolist()}
    kept = [line for line in lines if line_key(line) not in keys]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


_DEDUPED = "struct<n_lines:long,n_dropped:long,kept_text:string>"


def _dropped(text: Column, lost: Column) -> Column:
    @F.arrow_udf(_DEDUPED)
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        made = []
        for content, packed in zip(to_bytes(texts), lists.to_pylist(), strict=True):
            made.append(without_lines(content, np.frombuffer(b"".join(packed or ()), np.int32)))
        n_lines, n_dropped, kept = zip(*made, strict=True) if made else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["n_lines", "n_dropped", "kept_text"],
        )

    return run(text, lost)


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text; columns of the same names are replaced, the rest stay.

    Texts are cut at line feeds. A line's key is the line without ASCII white space at its ends, A-Z in lower
    case. Keys of at least ``least_chars`` code points that at least ``min_documents`` rows hold lose all
    their lines except in the rows with the smallest doc_id that holds the key. The other lines stay as they
    are, joined by line feeds.

    A null or empty text is one empty line. Rows that repeat a doc_id are each judged by their own text. A row
    without doc_id comes after all others, so it loses what any row with a doc_id holds; a line that
    only rows without doc_id hold stays in all of them.
    """
    lean = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counted = _line_counts(lean, least_chars).groupBy("h1", "h2").agg(F.min("owner").alias("owner"), F.sum("n").alias("n"))
    seen = Observation()
    counted = counted.observe(seen, F.coalesce(F.sum("n"), F.lit(0)).alias("looks"))
    counts = stored(counted.where((F.col("n") >= min_documents) & F.col("owner").isNotNull()), "line-counts")
    shards = max(1, -(-counts.count() // SHARD_HASHES), -(-seen.get["looks"] // SHARD_PROBES))
    index = stored(build_index(counts, shards), "line-index")
    of_shard = counts.groupBy(shard_of(F.col("h1"), shards).alias("shard")).agg(F.sum("n").alias("looks"))
    load = of_shard.select("shard", F.ceil(F.col("looks") / SHARD_PROBES).cast("int").alias("parts")).where("parts > 1")
    load = stored(load, "line-loads")

    marked = lean.withColumn("digest", F.xxhash64("text"))
    answers = _answers(index, _probes(marked, shards, least_chars), load, min_documents)
    lost = stored(answers, "lost-lines").groupBy("doc_id", "digest").agg(F.collect_set("lines").alias("lines"))

    names = ["n_lines", "n_dropped", "kept_text"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    held = docs.select(
        F.struct(*kept).alias("row"),
        F.col(doc_id).cast("long").alias("doc"),
        F.col(text).alias("content"),
        F.xxhash64(F.col(text)).alias("mark"),
    )
    same = F.col("doc").eqNullSafe(lost["doc_id"]) & (F.col("mark") == lost["digest"])
    # Dealt by key at every size: where the lists happen to be few enough to broadcast, cost would not say what it is for more.
    joined = held.hint("merge").join(lost, same, "left").select("row", _dropped(F.col("content"), F.col("lines")).alias("made"))
    return joined.select("row.*", *(F.col(f"made.{name}").alias(name) for name in names))
