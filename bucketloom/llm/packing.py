"""Operator 6: hierarchical residual packing of token sequences.

Each task tokenizes its documents, cuts those over the capacity, and packs the pieces best-fit decreasing, a
chunk of LOCAL_PIECES at a time, into bins that stay open from chunk to chunk. Bins with less than SLACK
tokens left are final. The others, few, go up a tree: in each round a node takes the open bins of FAN_IN
nodes, at most about NODE_BINS of them, as items for another best-fit round, emits what has become nearly full and
hands the rest on. At the root, or when a round merges nothing, the rest is final too. A bin of capacity C
holds C pieces at most, so rows and nodes have bounded size, and no node sees more for a longer input.

A document is its ids, by the tokenizers library without special tokens, and then the end id. White space
separates words for this vocabulary, so a worker keeps the ids of words met before in a bounded table.

Defined results: null text is empty text, a piece with the end id alone. Repeated rows are packed each on their own.
An empty table gives an empty result. Other columns, of any name, are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketloom.llm.common import Recent, Tables, bounded, in_worker, kept, only, texts_of

CAPACITY, END_ID = 4096, 1
SLACK = 16
LOCAL_PIECES, NODE_BINS, FAN_IN = 32_768, 20_000, 8
#: Entries of each generation of a worker's table of words.
WORDS = 500_000


class BestFit:
    """Open bins by their room; an item goes where the least room is left that it fits in."""

    def __init__(self, capacity: int):
        self.capacity, self.mask = capacity, 0
        self.by_room: dict[int, list[list]] = {}
        self.n = 0

    def _open(self, room: int, items: list) -> None:
        self.by_room.setdefault(room, []).append(items)
        self.mask |= 1 << room
        self.n += 1

    def put(self, size: int, items: list[tuple]) -> None:
        """An item: the pieces that it consists of, with their offsets as their last field."""
        fit = self.mask >> size
        if not fit:
            self._open(self.capacity - size, list(items))
            return
        room = (fit & -fit).bit_length() - 1 + size
        found = self.by_room[room]
        into = found.pop()
        self.n -= 1
        if not found:
            self.mask ^= 1 << room
        base = self.capacity - room
        into.extend((*x[:-1], x[-1] + base) for x in items)
        self._open(room - size, into)

    def take(self, least_room: int, most_room: int) -> Iterator[tuple[int, list]]:
        for room in [r for r in self.by_room if least_room <= r <= most_room]:
            for items in self.by_room.pop(room):
                self.n -= 1
                yield room, items
            if self.mask >> room & 1:
                self.mask ^= 1 << room


#: A word and the punctuation after it, between which the vocabulary's split pattern always cuts.
_STEM = re.compile(rb"([A-Za-z\x80-\xff]*[A-Za-z])([,.;:!?|%&*#$]+)")


class Tokens:
    """Ids of whole texts by the library, with a table of words met before."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = Recent(WORDS)

    def _ids(self, words: list[bytes]) -> list[bytes]:
        out = []
        for i in range(0, len(words), 4096):
            part = self.tokenizer.encode_batch_fast([w.decode() for w in words[i : i + 4096]], add_special_tokens=False)
            out += [np.array(e.ids, "<u4").tobytes() for e in part]
        return out

    def _missing(self, words: set[bytes]) -> dict[bytes, bytes]:
        """Ids of words that aren't in the table, put together from their stems'. A stem alone is a word with the same ids, so one table holds both."""
        known: dict[bytes, bytes] = {}
        parts: dict[bytes, tuple[bytes, ...]] = {}
        for w in words:
            found = self.words.get(w)
            if found is not None:
                known[w] = found
                continue
            m = _STEM.fullmatch(w)
            # ASCII capitals are lower-cased by the vocabulary anyway; not where a special token could come of it.
            parts[w] = tuple(x if b"<" in w else x.lower() for x in (m.groups() if m else (w,)))
        stems = {x: known.get(x) or self.words.get(x) for ps in parts.values() for x in ps}
        todo = [x for x, ids in stems.items() if ids is None]
        for x, ids in zip(todo, self._ids(todo), strict=True):
            stems[x] = ids
            if len(x) <= 64:
                self.words.put(x, ids)
        for w, ps in parts.items():
            known[w] = b"".join(map(stems.__getitem__, ps))
            if len(w) <= 64 and ps != (w,):
                self.words.put(w, known[w])
        return known

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for text in texts:
            words = text.split()
            found = list(map(self.words.young.get, words))
            if None in found:
                missing = self._missing({w for w, x in zip(words, found, strict=True) if x is None})
                found = [missing[w] if x is None else x for w, x in zip(words, found, strict=True)]
            out.append(b"".join(found))
        return out


def tokens(vocabulary: str) -> Tokens:
    return kept(lambda: Tokens(vocabulary), hashlib.sha256(vocabulary.encode()).hexdigest())


def pieces_of(ids: bytes, capacity: int, end_id: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document; the end id is added here."""
    ids += end_id.to_bytes(4, "little")
    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
        part = ids[at : at + 4 * capacity]
        yield k, at // 4, len(part) // 4, zlib.crc32(part)


def _bins_schema(kind: str) -> str:
    return f"room int, pieces array<struct<doc_id: {kind}, piece: int, start: long, length: long, ids_crc32: long, offset: long>>"


def _batches(bins: Iterator[tuple[int, list]], doc_id_type: pa.DataType, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "offset"]
    kinds = [doc_id_type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    rooms: list[int] = []
    at, cols = [0], [[] for _ in names]

    def flush() -> pa.RecordBatch:
        inner = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
        out = pa.RecordBatch.from_arrays([pa.array(rooms, pa.int32()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), inner)], names=["room", "pieces"])
        rooms.clear()
        at[:] = [0]
        for c in cols:
            c.clear()
        return out

    for room, items in bins:
        rooms.append(room)
        for x in items:
            for c, v in zip(cols, x, strict=True):
                c.append(v)
        at.append(len(cols[0]))
        if len(rooms) >= rows or len(cols[0]) >= 100_000:
            yield flush()
    if rooms:
        yield flush()


def _local(vocabulary, capacity: int, end_id: int, slack: int):
    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, encode, kind = BestFit(capacity), tokens(vocabulary.value), None

        def bins() -> Iterator[tuple[int, list]]:
            nonlocal kind
            waiting: list[tuple] = []

            def pack() -> Iterator[tuple[int, list]]:
                waiting.sort(key=lambda x: -x[3])
                for x in waiting:
                    fit.put(x[3], [x])
                waiting.clear()
                yield from fit.take(0, slack)
                if fit.n > LOCAL_PIECES:  # nothing small comes along; the tree takes them
                    yield from fit.take(0, capacity)

            for big in batches:
                kind = big.schema.field("doc_id").type
                for b in bounded(big):
                    for doc, ids in zip(b.column("doc_id").to_pylist(), encode(texts_of(b.column("text"))), strict=True):
                        waiting += [(doc, *p, 0) for p in pieces_of(ids, capacity, end_id)]
                    if len(waiting) >= LOCAL_PIECES:
                        yield from pack()
            yield from pack()
            yield from fit.take(0, capacity)

        stream = bins()
        first = next(stream, None)
        if first is not None:
            yield from _batches((x for part in ([first], stream) for x in part), kind)

    return run


def _node(capacity: int):
    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def bins() -> Iterator[tuple[int, list]]:
            nonlocal kind
            fit, waiting = BestFit(capacity), []

            def pack() -> Iterator[tuple[int, list]]:
                waiting.sort(key=lambda x: x[0])
                for room, items in waiting:
                    fit.put(capacity - room, items)
                waiting.clear()
                yield from fit.take(0, capacity)

            for b in batches:
                kind = b.schema.field("pieces").type.value_type.field("doc_id").type
                for row in b.to_pylist():
                    waiting.append((row["room"], [tuple(p.values()) for p in row["pieces"]]))
                if len(waiting) >= 2 * NODE_BINS:
                    yield from pack()
            yield from pack()

        stream = bins()
        first = next(stream, None)
        if first is not None:
            yield from _batches((x for part in ([first], stream) for x in part), kind)

    return run


def pack(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID, slack: int = SLACK, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row."""
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    df = only(docs, doc_id=doc_id, text=text)
    schema = _bins_schema(df.schema["doc_id"].dataType.simpleString())
    tables = Tables(spark)
    made = tables.cut(df.mapInArrow(_local(vocabulary, capacity, end_id, slack), schema))
    done, left = [made.where(F.col("room") <= slack)], made.where(F.col("room") > slack)
    nodes, n = int(spark.conf.get("spark.sql.shuffle.partitions")), left.count()
    while n > 1:
        nodes = max(-(-n // NODE_BINS), -(-nodes // FAN_IN))
        made = tables.cut(left.repartition(nodes).mapInArrow(_node(capacity), schema))
        done.append(made.where(F.col("room") <= slack))
        left = made.where(F.col("room") > slack)
        before, n = n, left.count()
        if nodes == 1 or (n > 0.99 * before and nodes >= before / NODE_BINS > 1):
            break
    done.append(left)
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    out = out.withColumn("sequence_id", F.monotonically_increasing_id())
    out = out.select("sequence_id", F.explode("pieces").alias("p"))
    return out.select("p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32", "sequence_id", "p.offset")
