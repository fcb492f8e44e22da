"""Operator 7: exact n-gram Jaccard self-join by token-combination prefixes, and the groups that its links make.

A text's set holds the 64-bit hashes of its distinct shingles of K words. Texts with equal sets are one class, and only
classes are joined. Shingles are ordered: rare ones by hash, then frequent ones by hash; texts are counted in blocks of BLOCK shingles, and frequent ones
are those with the largest sums of counts of LOCAL_LEAST or more in a block (MAX_FREQUENT at most, so they are broadcast; any choice gives the same links). With
|x & y| >= 3/4 |x | y| two classes share

* a rare shingle among the first |x| - ceil(3/4 |x|) + 1 of each, or
* no rare shingle at all. Then the shingles that only one of them has, at most a third of those shared, can't part
  all neighbours among the shared ones, so within the first |x|/2 + 2 of each, two frequent shingles that follow each
  other in one do so in the other.

So each class is indexed by the rare shingles of its prefix and by the combinations of two successive frequent ones of its
extended prefix. Groups are wanted, so not every pair of a bucket is compared. First each member is compared with its bucket's first
one and with two that come shortly before it by size, inside blocks of the index and then between blocks, which leaves no bucket
in one task. What this links is contracted. Buckets that still hold several components are then compared completely, pair by pair across
components, in blocks and with no cap. Each class carries the parities of its shingles' hashes in cells, and |x & y| is at most
(|x| + |y| - cells that differ) / 2. Blocks hold a short form of these parities and give only the pairs that this exact bound
leaves over, and not where both classes' least open keys show that the pair meets under a lesser key as well. What is left is verified on
the whole sets.

Defined results: a text without words, or null, has an empty set, no links and itself as its component. Fewer than K words are one
shingle. Null doc_ids are reached but never name a component unless it has no other. Repeated rows get equal results. An empty table gives an
empty result. Other columns, of any name, are ignored (``keep_one`` hands them through).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketloom.llm.common import Tables, bounded, in_worker, join_unique, kept, only
from bucketloom.llm.components import components

K = 5
#: A link: LINK[1] * |x & y| >= LINK[0] * |x | y|.
LINK = (3, 4)
MAX_FREQUENT = 1 << 18
#: Texts are counted in blocks of so many shingles; a shingle's count in a block matters from LOCAL_LEAST on.
BLOCK, LOCAL_LEAST = 1 << 21, 3
#: Counts from which a shingle is frequent: LEAST, or this share of the texts.
LEAST, FREQUENT_SHARE = 24, 1 / 8000
#: A signature has 2**MIN_SIG_BITS cells at least and 2**MAX_SIG_BITS at most; sets of up to SHORT_MOST shingles carry one of the least size too.
MIN_SIG_BITS, MAX_SIG_BITS = 9, 20
SHORT_MOST = 1024
#: Open buckets are compared in blocks of about so many classes, by so many pairs at a time; LOW_KEYS least keys of a class go along.
OPEN_BLOCK, OPEN_PAIRS = 1024, 1 << 18
LOW_KEYS = 4
INDEX_BLOCK = 1 << 20
WORDS = 150_000
STEP = 7
BLOOM_BITS = 26
BATCH = 4 << 20

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def shingles(text: bytes, k: int = K) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    known = kept(dict, "words")
    if len(known) > WORDS:
        known.clear()
    found = list(map(known.get, words))
    if None in found:
        for i, x in enumerate(found):
            if x is None:
                found[i] = known[words[i]] = xxhash.xxh3_64_intdigest(words[i])
    w = np.array(found, np.uint64)
    m = min(k, n)
    with np.errstate(over="ignore"):
        h = np.full(n - m + 1, m, np.uint64)
        for i in range(m):
            h = h * _U(0x9E3779B97F4A7C15) + w[i : n - m + 1 + i]
    return np.unique(_mix(h))


def linked(x: int, y: int, both: int) -> bool:
    return LINK[1] * both >= LINK[0] * (x + y - both)


def signature(own: np.ndarray) -> bytes:
    """Parities of the hashes in cells, two or more cells a shingle; folding its halves together gives that of half as many cells."""
    cells = 1 << min(MAX_SIG_BITS, max(MIN_SIG_BITS, (2 * len(own) - 1).bit_length()))
    odd = np.bincount((own & _U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def short_form(sig: bytes, n: int) -> bytes:
    """The signature folded to its least size; nothing for sets so large that it would show nothing."""
    if n > SHORT_MOST:
        return b""
    x = np.frombuffer(sig, np.uint64)
    while len(x) * 64 > 1 << MIN_SIG_BITS:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x.tobytes()


def may_link(n: int, m: int, sig: bytes, other: bytes) -> bool:
    """False only where sizes and signatures show that two sets don't link."""
    x, y, p, q = int.from_bytes(sig, "little"), int.from_bytes(other, "little"), len(sig) * 8, len(other) * 8
    while p > q:
        p //= 2
        x = (x ^ (x >> p)) & ((1 << p) - 1)
    while q > p:
        q //= 2
        y = (y ^ (y >> q)) & ((1 << q) - 1)
    most = min(n, m, (n + m - (x ^ y).bit_count()) // 2)
    return linked(n, m, most)


def index_keys(own: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The keys under which a class is indexed; ``frequent`` is sorted."""
    n = len(own)
    first = n - -(-LINK[0] * n // LINK[1]) + 1
    often = np.zeros(n, bool)
    if len(frequent):
        often = frequent[np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)] == own
    rare = own[~often]
    keys = rare[:first]
    some = own[often][: max(0, n // 2 + 2 - len(rare))]
    if len(some) > 1:
        with np.errstate(over="ignore"):
            keys = np.concatenate([keys, _mix(some[:-1] * _U(0xC2B2AE3D27D4EB4F) + some[1:])])
    return keys


def first_pass(docs: DataFrame) -> DataFrame:
    """Rows of texts (h null): doc_id, row_hash, n, fp; and rows of shingles that are frequent in a block: h, n."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kinds = [], 0, None

        def rows(doc_id, row_hash, n, fp, h) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([doc_id, row_hash, n, fp, h], names=["doc_id", "row_hash", "n_shingles", "fp", "h"])

        def flush() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            often = np.flatnonzero(n >= LOCAL_LEAST)
            held.clear()
            k = len(often)
            return rows(pa.nulls(k, kinds), pa.nulls(k, pa.int64()), pa.array(n[often].astype(np.int64)), pa.nulls(k, pa.binary()), pa.array(keys[often].view(np.int64)))

        for big in batches:
            kinds = big.schema.field("doc_id").type
            for b in bounded(big, BATCH):
                own = [shingles(x or b"") for x in b.column("text").cast(pa.binary()).to_pylist()]
                fp = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in own]
                yield rows(b.column("doc_id"), b.column("row_hash"), pa.array([len(x) for x in own], pa.int64()), pa.array(fp, pa.binary()), pa.nulls(len(own), pa.int64()))
                held += [x for x in own if len(x)]
                size += sum(map(len, own))
                if size >= BLOCK:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return docs.mapInArrow(run, f"doc_id {kind}, row_hash long, n_shingles long, fp binary, h long")


def frequent_shingles(counted: DataFrame, total: int) -> np.ndarray:
    """The most frequent shingles of all texts, sorted; of bounded number."""
    top = counted.where("h IS NOT NULL").groupBy("h").agg(F.sum("n_shingles").alias("n")).where(F.col("n") >= max(LEAST, int(total * FREQUENT_SHARE)))
    found = top.orderBy(F.desc("n"), "h").limit(MAX_FREQUENT).select("h").toArrow()
    return np.sort(found.column("h").to_numpy().view(np.uint64)) if found.num_rows else np.zeros(0, np.uint64)


def classes_of(docs: DataFrame, carriers: DataFrame, frequent: np.ndarray) -> DataFrame:
    """node, row_hash, n_shingles, fp, keys, sig, short of one text of each set.

    The texts to take, ``carriers``, are known by a filter of fixed size; one taken beside them makes a second
    node of its set, which the join links to the first.
    """
    shared = docs.sparkSession.sparkContext.broadcast((frequent, _bloom(carriers.select(F.col("row_hash").alias("h")))))

    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, bloom = shared.value
        seen: set[bytes] = set()
        for big in batches:
            for b in bounded(big, BATCH):
                h = b.column("row_hash").to_numpy(zero_copy_only=False)
                at = np.flatnonzero(in_bloom(bloom, h))
                hashes, n, fps, keys, sigs, shorts = [], [], [], [], [], []
                for i, x in zip(at, b.column("text").cast(pa.binary()).take(pa.array(at)).to_pylist(), strict=True):
                    own = shingles(x or b"")
                    fp = xxhash.xxh3_128_digest(own.tobytes())
                    if not len(own) or fp in seen:
                        continue
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(fp)
                    hashes.append(h[i])
                    n.append(len(own))
                    fps.append(fp)
                    keys.append(index_keys(own, frequent).tobytes())
                    sigs.append(signature(own))
                    shorts.append(short_form(sigs[-1], len(own)))
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(n, pa.int64()), pa.array(fps, pa.binary()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), pa.array(shorts, pa.binary())], names=["row_hash", "n_shingles", "fp", "keys", "sig", "short"])

    made = docs.select("text", "row_hash").mapInArrow(run, "row_hash long, n_shingles long, fp binary, keys binary, sig binary, short binary")
    return made.withColumn("node", F.monotonically_increasing_id())


def _pairs_of_sorted(key: np.ndarray, node: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by (key, n, node): each with its bucket's first and with the rows 1 and STEP before, where sizes allow it."""
    at = np.arange(len(key))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    start = np.maximum.accumulate(np.where(new, at, 0))
    a, b = [], []
    for other in (start, np.maximum(at - 1, start), np.maximum(at - STEP, start)):
        ok = (other < at) & (LINK[1] * n[other] >= LINK[0] * n) & (node[other] != node)
        a.append(node[other][ok])
        b.append(node[ok])
    return np.concatenate(a), np.concatenate(b)


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(a):
        return a, b
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[keep], b[keep]


_ROW = "kind int, x long, y long, n long"


def _row_batch(kind: int, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y), pa.array(n)], names=["kind", "x", "y", "n"])


@in_worker
def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of a block of classes: pairs found inside it (kind 0), each key's first class (kind 1), and keys of several classes (kind 2)."""
    held: list[tuple[np.ndarray, int, int]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        lens = [len(k) for k, _, _ in held]
        key = np.concatenate([k for k, _, _ in held])
        node = np.repeat(np.array([x for _, x, _ in held], np.int64), lens)
        n = np.repeat(np.array([x for _, _, x in held], np.int64), lens)
        held.clear()
        order = np.lexsort((node, n, key))
        key, node, n = key[order], node[order], n[order]
        a, b = _distinct(*_pairs_of_sorted(key, node, n))
        yield _row_batch(0, a, b, np.zeros(len(a), np.int64))
        again = np.unique(key[1:][key[1:] == key[:-1]])
        yield _row_batch(2, again.view(np.int64), np.zeros(len(again), np.int64), np.zeros(len(again), np.int64))
        # Where sizes part a bucket, each part's first goes on.
        new = np.ones(len(key), bool)
        if len(key) > 1:
            new[1:] = (key[1:] != key[:-1]) | (LINK[1] * n[:-1] < LINK[0] * n[1:])
        yield _row_batch(1, key[new].view(np.int64), node[new], n[new])

    for b in batches:
        for k, node, n in zip(b.column("keys").to_pylist(), b.column("node").to_pylist(), b.column("n_shingles").to_pylist(), strict=True):
            own = np.frombuffer(k, np.uint64)
            held.append((own, node, n))
            size += len(own)
            if size >= INDEX_BLOCK:
                yield from flush()
                size = 0
    if held:
        yield from flush()


@in_worker
def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _blocks dealt by key and sorted by (kind, x, n, y): pairs and keys pass, buckets give pairs of their blocks' firsts and their key."""
    last: tuple | None = None

    def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], names=["kind", "a", "b"])

    for b in batches:
        kind, x, y, n = (b.column(i).to_numpy() for i in range(4))
        for k in (0, 2):
            own = kind == k
            if own.any():
                yield out(k, x[own], y[own])
        key, node, size = x[kind == 1], y[kind == 1], n[kind == 1]
        if last is not None and len(key):  # a bucket may reach over batches: its first and its latest row are handed on
            key, node, size = (np.concatenate(v) for v in zip(last, (key, node, size), strict=True))
        if len(key):
            pairs = _distinct(*_pairs_of_sorted(key, node, size))
            if len(pairs[0]):
                yield out(0, *pairs)
            again = np.unique(key[1:][key[1:] == key[:-1]])
            if len(again):
                yield out(2, again, np.zeros(len(again), np.int64))
            start = np.flatnonzero(key == key[-1])[0]
            keep = [start] if start == len(key) - 1 else [start, len(key) - 1]
            last = (key[keep], node[keep], size[keep])


def candidates(classes: DataFrame) -> DataFrame:
    """kind, a, b: distinct pairs of nodes to be compared first (0), and the keys under which there are several (2, in a)."""
    rows = classes.select("node", "n_shingles", "keys").mapInArrow(_blocks, _ROW)
    at = F.when(F.col("kind") == 0, F.xxhash64("x", "y")).otherwise(F.xxhash64("x"))
    return rows.repartition(at).sortWithinPartitions("kind", "x", "n", "y").mapInArrow(_heads, "kind int, a long, b long").distinct()


def _bloom(ids: DataFrame) -> np.ndarray:
    """A filter of fixed size over hashes: 2**BLOOM_BITS bits, two for each hash."""
    bit = F.explode(F.array(F.shiftrightunsigned("h", 64 - BLOOM_BITS), F.col("h").bitwiseAND((1 << BLOOM_BITS) - 1)))
    words = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 AS int)))").alias("w")).toArrow()
    out = np.zeros(1 << (BLOOM_BITS - 6), np.uint64)
    if words.num_rows:
        out[words.column("at").to_numpy()] = words.column("w").to_numpy().view(np.uint64)
    return out


def in_bloom(bloom: np.ndarray, h: np.ndarray) -> np.ndarray:
    h = h.view(np.uint64)
    out = np.ones(len(h), bool)
    for bit in (h >> _U(64 - BLOOM_BITS), h & _U((1 << BLOOM_BITS) - 1)):
        out &= (bloom[bit >> _U(6)] >> (bit & _U(63)) & _U(1)).astype(bool)
    return out


def _nodes_of(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes that are in pairs."""
    found = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    return classes.select("node", "row_hash", "fp").join(found.hint("merge"), "node", "left_semi")


def sets_of(docs: DataFrame, nodes: DataFrame, tables: Tables) -> DataFrame:
    """node, own: the whole sets of ``nodes`` (node, row_hash, fp), from their texts; a set is known by its 128-bit fingerprint."""
    nodes = tables.cut(nodes.select("node", "row_hash", "fp"))
    shared = docs.sparkSession.sparkContext.broadcast(_bloom(nodes.select(F.col("row_hash").alias("h"))))

    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for big in batches:
            for b in bounded(big, BATCH):
                h = b.column("row_hash").to_numpy(zero_copy_only=False)
                at = np.flatnonzero(in_bloom(shared.value, h))
                at = [i for i in at if h[i] not in done]
                if len(done) > 500_000:
                    done.clear()
                done.update(h[at].tolist())
                if len(at):
                    texts = b.column("text").cast(pa.binary()).take(pa.array(at, pa.int64())).to_pylist()
                    own = [shingles(x or b"").tobytes() for x in texts]
                    fp = [xxhash.xxh3_128_digest(x) for x in own]
                    yield pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array(fp, pa.binary()), pa.array(own, pa.large_binary()).cast(pa.binary())], names=["row_hash", "fp", "own"])

    made = docs.select("text", "row_hash").mapInArrow(run, "row_hash long, fp binary, own binary")
    return tables.cut(nodes.join(made.hint("merge"), ["row_hash", "fp"]).select("node", "own"))


def possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that their classes' sizes and signatures don't rule out."""
    own = classes.select("node", "n_shingles", "sig")
    both = pairs.hint("merge").join(own.toDF("a", "n", "sig"), "a").hint("merge").join(own.toDF("b", "m", "other"), "b")

    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = pa.array([may_link(*x) for x in zip(*(b.column(i).to_pylist() for i in range(2, 6)), strict=True)], pa.bool_())
            out = pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(keep)
            if out.num_rows:
                yield out

    return both.select("a", "b", "n", "m", "sig", "other").mapInArrow(run, "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b of the pairs that link. The adaptive skew join splits the pairs of a node that has many."""
    both = pairs.hint("merge").join(sets.toDF("a", "own_a"), "a").hint("merge").join(sets.toDF("b", "own_b"), "b")

    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in bounded(big, BATCH):
                keep = []
                for x, y in zip(b.column("own_a").to_pylist(), b.column("own_b").to_pylist(), strict=True):
                    p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    if len(p) > len(q):
                        p, q = q, p
                    ok = len(p) > 0 and LINK[1] * len(p) >= LINK[0] * len(q)
                    if ok:
                        shared = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
                        ok = linked(len(p), len(q), shared)
                    keep.append(ok)
                out = pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
                if out.num_rows:
                    yield out

    return both.select("a", "b", "own_a", "own_b").mapInArrow(run, "a long, b long")


def _exploded(classes: DataFrame, keys: DataFrame) -> DataFrame:
    """node, n, key: the index as rows, without most keys that only one class has (known by a filter of fixed size)."""
    shared = classes.sparkSession.sparkContext.broadcast(_bloom(keys.select(F.col("a").alias("h"))))

    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [np.frombuffer(k, np.int64) for k in b.column("keys").to_pylist()]
            lens = [len(k) for k in own]
            key = np.concatenate(own) if own else np.zeros(0, np.int64)
            keep = in_bloom(shared.value, key)
            node, n = (np.repeat(b.column(c).to_numpy(), lens)[keep] for c in ("node", "n_shingles"))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n), pa.array(key[keep])], names=["node", "n", "key"])

    return classes.select("node", "n_shingles", "keys").mapInArrow(run, "node long, n long, key long")


def _open_buckets(index: DataFrame, labels: DataFrame, tables: Tables) -> DataFrame:
    """Rows of the index (node, n, key) whose bucket holds several components, with their component and the bucket's rows."""
    named = index.join(labels.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = tables.cut(named.select("node", "n", "key", "component"))
    several = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("rows")).where("lo <> hi")
    return tables.cut(named.hint("merge").join(several.select("key", "rows"), "key"))


class _Open:
    """Rows of open buckets' cells, sorted by (key, lo, hi, n): columns as arrays, all of one length."""

    def __init__(self, b: pa.RecordBatch | None = None):
        if b is not None:
            self.cols = {c: b.column(c).to_numpy() for c in ("key", "lo", "hi", "own", "n", "node", "component")}
            self.cols["low"] = np.stack([b.column(f"low{i}").to_numpy() for i in range(LOW_KEYS)], 1)
            short = b.column("short").to_pylist()
            self.cols["has"] = np.array([len(x) > 0 for x in short], bool)
            none = bytes(1 << (MIN_SIG_BITS - 3))
            self.cols["short"] = np.frombuffer(b"".join(x or none for x in short), np.uint64).reshape(len(short), -1)

    def __getattr__(self, name: str) -> np.ndarray:
        return self.__dict__["cols"][name]

    def __len__(self) -> int:
        return len(self.cols["key"])

    def part(self, of: slice) -> _Open:
        out = _Open()
        out.cols = {k: v[of] for k, v in self.cols.items()}
        return out

    def then(self, other: _Open) -> _Open:
        out = _Open()
        out.cols = {k: np.concatenate([v, other.cols[k]]) for k, v in self.cols.items()}
        return out

    def starts(self) -> np.ndarray:
        """Where cells begin."""
        new = np.ones(len(self), bool)
        new[1:] = (self.key[1:] != self.key[:-1]) | (self.lo[1:] != self.lo[:-1]) | (self.hi[1:] != self.hi[:-1])
        return new

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs across components, inside whole cells, that sizes and short signatures don't rule out."""
        n, at = self.n, np.arange(len(self))
        cell = np.cumsum(self.starts()) - 1
        # Within a cell n rises, so the partners that a row's size allows are a range after it.
        top = int(n.max()) + 1
        order = cell * np.int64(top) + n
        end = np.searchsorted(order, cell * np.int64(top) + np.minimum(LINK[1] * n // LINK[0], top - 1), side="right")
        count = end - at - 1
        upto = np.cumsum(count)
        first = 0
        while first < len(at):
            done = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, done + OPEN_PAIRS, side="right")))
            c = count[first:last]
            i = np.repeat(at[first:last], c)
            j = i + 1 + np.arange(len(i)) - np.repeat(upto[first:last] - c - done, c)
            first = last
            ok = (self.component[i] != self.component[j]) & ((self.lo[i] == self.hi[i]) | (self.own[i] != self.own[j]))
            i, j = i[ok], j[ok]
            differ = np.bitwise_count(self.short[i] ^ self.short[j]).sum(1, dtype=np.int64)
            both = n[i] + n[j]
            most = np.minimum(n[i], (both - differ) // 2)
            ok = ~(self.has[i] & self.has[j]) | (LINK[1] * most >= LINK[0] * (both - most))
            i, j = i[ok], j[ok]
            lesser = (self.low[i][:, :, None] == self.low[j][:, None, :]) & (self.low[i] < self.key[i][:, None])[:, :, None]
            ok = ~lesser.any((1, 2))
            x, y = self.node[i[ok]], self.node[j[ok]]
            yield _distinct(np.minimum(x, y), np.maximum(x, y))


@in_worker
def _compare_open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: _Open | None = None

    def out(rows: _Open) -> Iterator[pa.RecordBatch]:
        if len(rows):
            for a, b in rows.pairs():
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for b in batches:
        if b.num_rows:
            rows = _Open(b) if held is None else held.then(_Open(b))
            last = int(np.flatnonzero(rows.starts())[-1])
            yield from out(rows.part(slice(0, last)))
            held = rows.part(slice(last, None))
    if held is not None:
        yield from out(held)


def _open_pairs(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: distinct pairs of open buckets across components that may link.

    A bucket of more than OPEN_BLOCK classes is dealt out in blocks; each two of them, and each with itself, meet in a cell of
    bounded size. A pair is left to a lesser key only where both classes' LOW_KEYS least keys have it, so none is lost.
    """
    low = rows.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("key")), 1, LOW_KEYS).alias("low"))
    none = F.lit(2**63 - 1)
    low = low.select("node", *[F.coalesce(F.get("low", F.lit(i)), none).alias(f"low{i}") for i in range(LOW_KEYS)])
    carried = classes.select("node", "short").hint("merge").join(low, "node")
    blocks = F.ceil(F.col("rows") / OPEN_BLOCK).cast("int")
    wide = rows.hint("merge").join(carried, "node").withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    wide = wide.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    wide = wide.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "n", "node", "component", "short", *[f"low{i}" for i in range(LOW_KEYS)])
    return wide.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "n", "node").mapInArrow(_compare_open, "a long, b long").distinct()


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and row_hash of every row."""
    tables = Tables(docs.sparkSession)
    df = only(docs, doc_id=doc_id, text=text).withColumn("row_hash", F.xxhash64("doc_id", "text"))
    first = tables.cut(first_pass(df))
    rows = first.where("h IS NULL").select("doc_id", "row_hash", "n_shingles", "fp")
    total = rows.count()
    groups = rows.where("fp IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least"), F.min("row_hash").alias("row_hash"), F.count("*").alias("n"))
    groups = tables.cut(groups)
    classes = tables.cut(classes_of(df, groups.select("row_hash"), frequent_shingles(first, total)))
    found = tables.cut(candidates(classes))
    likely = tables.cut(possible(found.where("kind = 0").select("a", "b"), classes))
    sets = sets_of(df, _nodes_of(likely, classes), tables)
    links = tables.cut(verify(likely, sets))
    tables.drop(sets)
    labels = tables.cut(components(links, tables))
    rest = _open_buckets(_exploded(classes, found.where("kind = 2")), labels, tables)
    more = tables.cut(possible(tables.cut(_open_pairs(rest, classes)), classes))
    tables.drop(rest)
    links = tables.cut(links.unionByName(verify(more, sets_of(df, _nodes_of(more, classes), tables))))
    labels = tables.cut(components(links, tables))
    named = classes.select("fp", "node").join(labels.hint("merge"), "node", "left").groupBy("fp").agg(F.min(F.coalesce("component", "node")).alias("component"))
    named = tables.cut(groups.select("fp", "least", "n").join(named.hint("merge"), "fp"))
    by_component = named.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("classes"))
    named = join_unique(named, by_component, "component", "classes", named.count(), ["fp"])
    out = join_unique(rows, named.select("fp", "n", "component_id"), "fp", "n", total, ["doc_id", "row_hash"])
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "row_hash")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs``, all columns as they are, with one document of each group: that of the smallest doc_id."""
    tables = Tables(docs.sparkSession)
    kept = near_groups(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = tables.cut(kept.select(F.col("doc_id").alias("__doc"), F.col("row_hash").alias("__hash")).distinct())
    return docs.join(kept.hint("merge"), docs["doc_id"].eqNullSafe(kept["__doc"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == kept["__hash"]), "left_semi")
