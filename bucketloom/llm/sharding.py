"""Operator 2: sharding by histogram sort, in DataFrame operations only.

Rows are ordered by a 63-bit key: the text's CRC-32, so that equal texts lie side by side, and below it 16 bits of
a hash of the doc_id and 15 bits of a hash of the row's number, so that a group of copies of any size, and rows repeated in full, can be cut. Splitters of the shards, and within the shards
of parts of about PART_ROWS rows, are searched for as in histogram sort: a round counts the exact bytes and rows
below all candidate boundaries in one aggregation over all partitions, first at 2**FIRST_BITS even boundaries, then
at finer ones inside the intervals that splitters fall into, until each interval holds less than the tolerance or is a
single key. What a round brings to the driver is bounded by MAX_CELLS counts. Then rows are exchanged once, by part.

The law is ``bytes``: shard sizes are near equal. A splitter misses its target by the tolerance or,
where a row or rows of one key are larger than that, by half of those.

Defined results: null text has no bytes (size 1, CRC-32 0); a null doc_id hashes as a missing value; rows repeated
with one doc_id and text lie side by side and may be cut like other copies. An empty table gives an empty result. Other columns, of any
name, are ignored.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bucketloom.llm.common import Tables, only

SHARDS = 8
#: Of a shard's bytes, by which a shard's splitter may miss; of a part's bytes, for a part's.
SHARD_TOLERANCE, PART_TOLERANCE = 1e-4, 0.1
PART_ROWS = 1 << 20
KEY_BITS, FIRST_BITS = 63, 13
MAX_CELLS = 1 << 17


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the sort key of every row."""
    df = only(docs, doc_id=doc_id, text=text)
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    out = df.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), crc.alias("text_crc32"))
    below = F.shiftleft(F.shiftrightunsigned(F.xxhash64("doc_id"), 48), 15).bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 49))
    return out.withColumn("key", F.shiftleft("text_crc32", 31).bitwiseOR(below))


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows known on the driver, as one literal: no Python or RDD is in the plan."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows_as_structs(rows, schema))), f"array<struct<{schema}>>")))


def rows_as_structs(rows: list[tuple], schema: str) -> list[dict]:
    names = [x.split(":")[0].strip() for x in schema.split(", ")]
    return [dict(zip(names, r, strict=True)) for r in rows]


@dataclass
class Splitter:
    """The boundary wanted where ``target`` bytes lie below; it is known to lie in [low, low + 2**bits]."""

    target: float
    tolerance: float
    low: int = 0
    bits: int = KEY_BITS
    below: tuple[int, int] = (0, 0)  # bytes, rows
    inside: tuple[int, int] = (0, 0)

    def settled(self) -> bool:
        return self.bits == 0 or self.inside[0] <= self.tolerance

    def nearest(self) -> tuple[int, int, int]:
        """key, bytes below, rows below, of the interval's end that is closer to the target."""
        over = self.below[0] + self.inside[0] - self.target
        if over < self.target - self.below[0]:
            return self.low + (1 << self.bits), self.below[0] + self.inside[0], self.below[1] + self.inside[1]
        return self.low, *self.below


def find_splitters(rows: DataFrame, splitters: list[Splitter]) -> None:
    """Histogram rounds: narrows each splitter until it is settled."""
    spark = rows.sparkSession
    while todo := [s for s in splitters if not s.settled()]:
        first = todo[0].bits == KEY_BITS
        bits = KEY_BITS if first else max(s.bits for s in todo)
        cells = {s.low >> s.bits for s in todo if s.bits == bits}
        step = FIRST_BITS if first else max(1, min(bits, (MAX_CELLS // len(cells)).bit_length() - 1, FIRST_BITS))
        fine = bits - step
        counted = rows
        if not first:
            wanted = small_table(spark, [(c,) for c in sorted(cells)], "cell: long")
            counted = rows.withColumn("cell", F.shiftright("key", bits)).join(F.broadcast(wanted), "cell", "left_semi")
        got = counted.groupBy(F.shiftright("key", fine).alias("at")).agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
        by_cell: dict[int, list[tuple[int, int, int]]] = {}
        for at, b, n in sorted(map(tuple, got)):
            by_cell.setdefault(at >> step if not first else 0, []).append((at, b, n))
        for s in todo:
            if s.bits != bits:
                continue
            b, n = s.below
            for at, db, dn in by_cell.get(s.low >> s.bits if not first else 0, []):
                if b + db >= s.target:
                    break
                b, n = b + db, n + dn
            s.low, s.bits, s.below, s.inside = at << fine, fine, (b, n), (db, dn)


def shard(docs: DataFrame, shards: int = SHARDS, shard_tolerance: float = SHARD_TOLERANCE, part_rows: int = PART_ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    spark = docs.sparkSession
    tables = Tables(spark)
    rows = tables.cut(keyed(docs, doc_id, text))
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    parts = max(-(-n_rows // (part_rows * shards)), -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    count = shards * parts
    wanted = []
    if total:
        for k in range(1, count):
            tolerance = shard_tolerance * total / shards if k % parts == 0 else PART_TOLERANCE * total / count
            wanted.append(Splitter(total * k / count, tolerance, inside=(total, n_rows)))
        find_splitters(rows, wanted)
    edges = [s.nearest() for s in wanted]
    for k in range(1, len(edges)):  # neighbours that chose different ends of one interval stay in order
        edges[k] = max(edges[k], edges[k - 1])
    # Edges by the first bits of the keys that they cut: (cell, parts that begin before it, edges inside).
    shift = KEY_BITS - FIRST_BITS
    cells, before = [], 0
    inside: dict[int, list[int]] = {}
    for key, _, _ in edges:
        inside.setdefault(min(key >> shift, (1 << FIRST_BITS) - 1), []).append(key)
    for c in range(1 << FIRST_BITS):
        own = inside.get(c, [])
        cells.append((c, before, own))
        before += len(own)
    lookup = small_table(spark, cells, "cell: long, base: int, edges: array<long>")
    starts = [0] + [n for _, _, n in edges] if edges else [0] * count
    of = small_table(spark, [(k, k // parts, starts[k] - starts[k // parts * parts]) for k in range(count)], "part: int, shard: int, first: long")
    placed = rows.withColumn("cell", F.shiftright("key", shift)).join(F.broadcast(lookup), "cell")
    part = F.col("base") + F.size(F.filter("edges", lambda e: e <= F.col("key")))
    placed = placed.select("doc_id", "size", "text_crc32", "key", part.alias("part"))
    order = Window.partitionBy("part").orderBy("key", "doc_id", "size")
    out = placed.withColumn("nth", F.row_number().over(order)).join(F.broadcast(of), "part")
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("nth") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
