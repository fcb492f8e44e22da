"""Operator 9: exact duplicates by composable polynomial fingerprints, then a chunkwise comparison.

A text is read as bytes, each run of ASCII white space as one space. Its fingerprint is the value of the
bytes as a polynomial at BASE modulo PRIME, with the length. Pieces of a text are hashed on their own and joined by
``H(A+B) = H(A) * BASE**len(B) + H(B)``, where a run of white space that a cut parts is mended by arithmetic too (``joined``).

Texts of more than HUGE bytes are cut into pieces, which any tasks hash in parallel; a text's fingerprint comes from its pieces' parts alone. Its
SHA-256, which can only be made in order, and its comparison read the pieces one after another, so no step but the cut holds a whole long text in Python.

Rows of equal fingerprint are compared chunk by chunk with one row of their
group before they count as equal; where that shows a collision, the rows are told apart by their SHA-256.

Hot groups: rows of one fingerprint are dealt into salted groups of about SALT_ROWS rows, each compared in
its own task with the row it starts with; those first rows, one per group, are compared the same way until one is left.
Rows have a number of their own, so repeats of one row are dealt like any others.

Defined results: null text is empty text. Rows of null doc_id come last; keep_id is null only if all doc_ids of the group
are. Of rows repeated with the same doc_id and text one is kept. An empty table gives an empty result.
Other columns, of any name, are ignored (``keep_first`` hands them through).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketloom.llm.common import SALT_ROWS, Tables, bounded, in_worker, join_unique, map_batches, only, texts_of

#: The smallest prime over sqrt(2) * 2**126: 127 bits, and no pattern in its bits that short edits could meet.
PRIME = isqrt(2 << 252) + 24
BASE = 256
CHUNK = 1 << 13
_POWER = pow(BASE, CHUNK, PRIME)
#: Bytes from which a text is cut into pieces, and of a piece.
HUGE = 1 << 20
PIECE = 1 << 18
#: Pieces that are held at once.
HELD_PIECES = 16


def chunk_hash(data: bytes) -> int:
    return int.from_bytes(data, "big") % PRIME


def combine(left: int, right: int, right_len: int) -> int:
    """The fingerprint of two texts put together, from theirs."""
    power = _POWER if right_len == CHUNK else pow(BASE, right_len, PRIME)
    return (left * power + right) % PRIME


def value_of(data: bytes) -> int:
    h = 0
    for i in range(0, len(data), CHUNK):
        part = data[i : i + CHUNK]
        h = combine(h, chunk_hash(part), len(part))
    return h


def fingerprint(data: bytes) -> bytes:
    """16 bytes of polynomial hash and 8 of length, of a normalised text."""
    return value_of(data).to_bytes(16, "big") + len(data).to_bytes(8, "big")


_WHITE = b" \t\n\x0b\x0c\r"


def normalised(data: bytes) -> bytes:
    words = data.split()
    if not words:
        return b" " if data else b""
    out = b" ".join(words)
    if data[0] in _WHITE:
        out = b" " + out
    return out + b" " if data[-1] in _WHITE else out


class Part(NamedTuple):
    """What is known of a stretch of a text: its normalised bytes' hash and length, and whether white space is at its ends."""

    value: int
    size: int
    lead: bool
    trail: bool

    def packed(self) -> bytes:
        return self.value.to_bytes(16, "big") + self.size.to_bytes(8, "big") + bytes([self.lead, self.trail])

    @classmethod
    def unpacked(cls, data: bytes) -> Part:
        return cls(int.from_bytes(data[:16], "big"), int.from_bytes(data[16:24], "big"), bool(data[24]), bool(data[25]))


def part_of(data: bytes) -> Part:
    norm = normalised(data)
    return Part(value_of(norm), len(norm), norm[:1] == b" ", norm[-1:] == b" ")


def joined(a: Part, b: Part) -> Part:
    """The part of two neighbouring stretches; associative. White space on both sides of the cut is one run."""
    if a.trail and b.lead:
        b = Part((b.value - 32 * pow(BASE, b.size - 1, PRIME)) % PRIME, b.size - 1, False, b.trail and b.size > 1)
    if not b.size:
        return a
    if not a.size:
        return b
    return Part(combine(a.value, b.value, b.size), a.size + b.size, a.lead, b.trail)


def same(a: bytes, b: bytes) -> bool:
    """Chunkwise comparison; ends at the first chunk that differs."""
    if len(a) != len(b):
        return False
    x, y = memoryview(a), memoryview(b)
    return all(x[i : i + CHUNK] == y[i : i + CHUNK] for i in range(0, len(a), CHUNK))


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, rid, pos, piece of the texts of more than HUGE bytes; rid, below 0, numbers the rows. To be written before it is read twice."""
    df = only(docs, doc_id=doc_id, text=text).withColumn("rid", -1 - F.monotonically_increasing_id()).where(F.octet_length("text") > HUGE)
    kind = df.schema["doc_id"].dataType.simpleString()

    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, x in enumerate(b.column("text").cast(pa.binary())):
                data, row = memoryview(x.as_buffer()), b.select(["doc_id", "rid"]).slice(i, 1)
                for begin in range(0, len(data), PIECE * HELD_PIECES):
                    cut = [bytes(data[j : j + PIECE]) for j in range(begin, min(begin + PIECE * HELD_PIECES, len(data)), PIECE)]
                    at = pa.array([begin // PIECE + k for k in range(len(cut))], pa.int64())
                    yield pa.RecordBatch.from_arrays([*row.take(pa.array([0] * len(cut))).columns, at, pa.array(cut, pa.binary())], names=["doc_id", "rid", "pos", "piece"])

    return df.mapInArrow(run, f"doc_id {kind}, rid long, pos long, piece binary")


def _long_fingerprints(cut: DataFrame) -> DataFrame:
    """rid, fp of cut texts: pieces are hashed wherever they lie, and a text's few parts joined in order."""

    def hashed():
        return lambda b: pa.RecordBatch.from_arrays(
            [b.column("rid"), b.column("pos"), pa.array([part_of(x).packed() for x in b.column("piece").to_pylist()], pa.binary())], names=["rid", "pos", "part"]
        )

    def whole(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = []
        for parts in b.column("parts").to_pylist():
            at = Part(0, 0, False, False)
            for x in parts:
                at = joined(at, Part.unpacked(x["part"]))
            fps.append(at.packed()[:24])
        return pa.RecordBatch.from_arrays([b.column("rid"), pa.array(fps, pa.binary())], names=["rid", "fp"])

    parts = map_batches(cut.select("rid", "pos", "piece").repartition("rid", "pos"), hashed, "rid long, pos long, part binary")
    texts = parts.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("pos", "part"))).alias("parts"))
    return map_batches(texts, lambda: whole, "rid long, fp binary")


def _streamed(cut: DataFrame, with_chunks: bool) -> DataFrame:
    """doc_id, rid, no, norm, text_sha256 of cut texts, read piece by piece: the normalised text in chunks of PIECE bytes, and at the last one its digest.

    Without ``with_chunks`` only the row of the digest, its norm null.
    """
    kind = cut.schema["doc_id"].dataType.simpleString()

    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = doc = digest = None
        held, no, white = b"", 0, False

        def row(norm: bytes, sha: str | None) -> pa.RecordBatch:
            cols = [pa.array([doc], doc.type), pa.array([rid], pa.int64()), pa.array([no], pa.int64()), pa.array([norm if with_chunks else None], pa.binary()), pa.array([sha], pa.string())]
            return pa.RecordBatch.from_arrays(cols, names=["doc_id", "rid", "no", "norm", "text_sha256"])

        for big in batches:
            for b in bounded(big):
                for d, r, x in zip(b.column("doc_id"), b.column("rid").to_pylist(), b.column("piece"), strict=True):
                    if r != rid:
                        if rid is not None:
                            yield row(held, digest.hexdigest())
                        rid, doc, digest, held, no, white = r, d, hashlib.sha256(), b"", 0, False
                    norm = normalised(x.as_py())
                    if white and norm[:1] == b" ":
                        norm = norm[1:]
                    white = norm[-1:] == b" " if norm else white
                    digest.update(norm)
                    if with_chunks:
                        held += norm
                        while len(held) > PIECE:
                            yield row(held[:PIECE], None)
                            held, no = held[PIECE:], no + 1
        if rid is not None:
            yield row(held, digest.hexdigest())

    ordered = cut.repartition("rid").sortWithinPartitions("rid", "pos")
    return ordered.mapInArrow(run, f"doc_id {kind}, rid long, no long, norm binary, text_sha256 string")


def _short(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return only(docs, doc_id=doc_id, text=text).withColumn("rid", F.monotonically_increasing_id()).where(f"text IS NULL OR octet_length(text) <= {HUGE}")


def fingerprints(docs: DataFrame, cut: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, rid, fp, text_sha256 of every row; ``cut`` has the pieces of long texts."""
    df = _short(docs, doc_id, text)
    kind = df.schema["doc_id"].dataType.simpleString()

    def make():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            norm = [normalised(x) for x in texts_of(b.column("text"))]
            return pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("rid"), pa.array([fingerprint(x) for x in norm], pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in norm], pa.string())],
                names=["doc_id", "rid", "fp", "text_sha256"],
            )

        return f

    short = map_batches(df, make, f"doc_id {kind}, rid long, fp binary, text_sha256 string")
    long = _streamed(cut, False).select("doc_id", "rid", "text_sha256").join(_long_fingerprints(cut), "rid")
    return short.unionByName(long)


def _texts(docs: DataFrame, cut: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, rid, fp, no, norm: every normalised text; long ones as chunks."""
    df = _short(docs, doc_id, text)
    kind = df.schema["doc_id"].dataType.simpleString()

    def make():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            norm = [normalised(x) for x in texts_of(b.column("text"))]
            cols = [b.column("doc_id"), b.column("rid"), pa.array([fingerprint(x) for x in norm], pa.binary()), pa.array([0] * len(norm), pa.int64()), pa.array(norm, pa.binary())]
            return pa.RecordBatch.from_arrays(cols, names=["doc_id", "rid", "fp", "no", "norm"])

        return f

    short = map_batches(df, make, f"doc_id {kind}, rid long, fp binary, no long, norm binary")
    long = _streamed(cut, True).drop("text_sha256").join(_long_fingerprints(cut), "rid")
    return short.unionByName(long)


@in_worker
def _compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (fp, no, salt): each chunk against the first of its group. Equal ones go, the first passes on, others are told."""
    at, first = None, b""
    for big in rows:
        for b in bounded(big):
            fp, no, salt, norm, differs = [], [], [], [], []
            for f, k, s, x in zip(b.column("fp").to_pylist(), b.column("no").to_pylist(), b.column("salt").to_pylist(), b.column("norm").to_pylist(), strict=True):
                new = (f, k, s) != at
                if new:
                    at, first = (f, k, s), x
                if new or not same(first, x):
                    fp.append(f)
                    no.append(k)
                    salt.append(s)
                    norm.append(x)
                    differs.append(not new)
            if fp:
                cols = [pa.array(fp, pa.binary()), pa.array(no, pa.int64()), pa.array(salt, pa.int64()), pa.array(norm, pa.binary()), pa.array(differs, pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, names=["fp", "no", "salt", "norm", "differs"])


def collisions(docs: DataFrame, cut: DataFrame, groups: DataFrame, total: int, tables: Tables, doc_id: str = "doc_id", text: str = "text") -> DataFrame | None:
    """Fingerprints under which unequal texts were found (one column, fp), or None.

    ``groups`` (fp, n) has the fingerprints of two rows or more. Texts of one fingerprint are equal if, at every number, their chunks are.
    """
    rows = join_unique(_texts(docs, cut, doc_id, text), groups, "fp", "n", total, ["doc_id", "rid", "no"]).where("n IS NOT NULL")
    parts = F.ceil(F.col("n") / SALT_ROWS)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "rid"), parts))
    found = None
    while True:
        done = (
            rows.select("fp", "no", "salt", "norm")
            .repartition("fp", "no", "salt")
            .sortWithinPartitions("fp", "no", "salt")
            .mapInArrow(_compare, "fp binary, no long, salt long, norm binary, differs boolean")
        )
        done = tables.cut(done)
        bad = done.where("differs").select("fp")
        if bad.limit(1).count():
            found = bad if found is None else found.unionByName(bad)
        left = done.where("NOT differs")
        more = left.groupBy("fp", "no").count().where("count > 1")
        hot = more.agg(F.max("count")).first()[0]
        if not hot:
            return None if found is None else found.distinct()
        # First rows of the salted groups: fewer by SALT_ROWS each time.
        rows = left.withColumn("salt", F.floor(F.col("salt") / SALT_ROWS)).join(more.select("fp", "no"), ["fp", "no"], "left_semi")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: a row for each row of ``docs``."""
    tables = Tables(docs.sparkSession)
    cut = tables.cut(pieces(docs, doc_id, text))
    rows = tables.cut(fingerprints(docs, cut, doc_id, text))
    total = rows.count()
    n_by_fp = rows.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1")
    found = collisions(docs, cut, tables.cut(n_by_fp), total, tables, doc_id, text) if total else None
    if found is not None:  # unequal texts under one fingerprint: their digests tell them apart
        bad = found.withColumn("n", F.lit(0).cast("long")).withColumn("bad", F.lit(True))
        rows = join_unique(rows, bad, "fp", "n", total, ["doc_id", "rid"])
        rows = tables.cut(rows.withColumn("fp", F.when(F.col("bad"), F.concat("fp", F.encode("text_sha256", "UTF-8"))).otherwise(F.col("fp"))).drop("n", "bad"))
    # The row that stays: the least doc_id, null last, and of its repeats the one of least number.
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("rid"))).alias("stays")
    groups = rows.groupBy("fp").agg(first, F.count("*").alias("group_size"))
    out = join_unique(rows, groups.withColumn("n", F.col("group_size")), "fp", "n", total, ["doc_id", "rid"])
    return out.select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("stays.rid")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` without rows whose text an equal one of smaller doc_id has; all columns as they are."""
    tables = Tables(docs.sparkSession)
    kept = tables.cut(exact_groups(docs).where("kept").select(F.col("doc_id").alias("__kept"), F.col("text_sha256").alias("__sha")))
    # Rows of a kept doc_id may differ in text or be repeated; only for those does the text decide.
    several = tables.cut(only(docs, doc_id="doc_id").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("__several")))
    single = docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")
    if not several.limit(1).count():
        return single
    alone = single.join(several, single["doc_id"].eqNullSafe(several["__several"]), "left_anti")
    among = single.join(several, single["doc_id"].eqNullSafe(several["__several"]), "left_semi")
    squeezed = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "[ \\t\\n\\x0B\\f\\r]+", " ")
    among = among.withColumn("__digest", F.sha2(squeezed.cast("binary"), 256))
    among = among.join(kept, among["doc_id"].eqNullSafe(kept["__kept"]) & (among["__digest"] == kept["__sha"]), "left_semi")
    return alone.unionByName(among.dropDuplicates(["doc_id", "__digest"]).drop("__digest"))


ORACLE = """
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g') AS norm,
                  row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) AS nth FROM documents),
g AS (SELECT *, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size FROM t WINDOW w AS (PARTITION BY norm))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND nth = 1 AS kept, sha256(norm) AS text_sha256 FROM g"""
