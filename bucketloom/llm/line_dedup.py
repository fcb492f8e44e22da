"""Operator 3: repeated passages of lines, by winnowing over line hashes.

A text is its \n-split lines; lines without a word don't count and stay. A window is the shortest run of lines from one line on, or up to
one, that has MIN_WORDS words. Each window selects its leftmost least line hash; the selected places are the text's fingerprints, so two
texts that share a run of MIN_WORDS words in whole lines are sure to share a fingerprint inside it. One row is made for each selected place,
not for each window. Places are counted by line hash, and those whose line was selected nowhere else are dropped.

What is left is joined: a place with the first place (by doc_id, then position) that has an equal stretch around the same fingerprint. As
fingerprints of one line can stand in many contexts, the join's key is the hash of the stretch, one for each window that selected the place;
so every place meets one partner a window, and a group of n places costs n rows, not n * n. The stretches around a place reach both ways from it,
as far as its windows do; where the equal lines go on, the next selected place's stretches take over, since a run of equal lines is covered by the windows inside
it. So the union of the stretches is the match extended both ways to the whole run. Lines of matches after the first place are deleted.

Overlaps: where a match overlaps its partner in the same text, the partner's window stays whole and only lines beyond it go. So of equal lines in
a row as many stay as make up MIN_WORDS words, and every repeated run of MIN_WORDS words keeps its first occurrence, unless that is itself
part of another run's later copy.

Fingerprints and stretches are counted before they are joined, and hot ones are joined by a broadcast of bounded size; no
pairs within a group are made.

Defined results: null text has no lines and stays null. A line alone is a window if it has MIN_WORDS words. Within one text later repeats go as well.
Rows repeated with the same doc_id and text count as one text and get equal results. A null doc_id comes first. An empty
table gives an empty result. Other columns, of any name, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketloom.llm.common import Tables, bounded, in_worker, join_unique, only

MIN_WORDS = 50
BATCH = 4 << 20


def lines_of(text: str | None) -> list[tuple[int, str, int]]:
    """Number, line and words of each line with a word."""
    return [(i, x, n) for i, x in enumerate((text or "").split("\n")) if (n := len(x.encode().split()))]


def windows(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last lines of the windows reaching forwards from, and backwards to, each line; each once."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words)])
    last = np.searchsorted(total, total[:-1] + least)  # windows [i, last)
    ok = last <= n
    first = np.searchsorted(total, total[1:] - least, side="right") - 1  # windows [first, i + 1)
    ok2 = first >= 0
    begin = np.concatenate([np.flatnonzero(ok), first[ok2]])
    end = np.concatenate([last[ok], np.flatnonzero(ok2) + 1])
    if not len(begin):
        return begin, end
    both = np.unique(np.stack([begin, end]), axis=1)
    return both[0], both[1]


def selected(h: np.ndarray, words: np.ndarray, least: int) -> dict[int, list[tuple[int, int]]]:
    """The selected places of a text: the leftmost least hash of each window, with the windows (first, last) that select it."""
    out: dict[int, list[tuple[int, int]]] = {}
    begin, end = windows(words, least)
    for p, q in zip(begin.tolist(), end.tolist(), strict=True):
        out.setdefault(p + int(h[p:q].argmin()), []).append((p, q - 1))
    return out


def _places(docs: DataFrame, least: int) -> DataFrame:
    """doc_id, row_hash, mark, around: a row for each selected place; around has the stretches (content, first, last) of its windows."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    around = pa.list_(pa.struct([("content", pa.int64()), ("first", pa.int32()), ("last", pa.int32())]))

    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in bounded(big, BATCH):
                at, mark, sizes, content, first, last = [], [], [0], [], [], []
                for i, text in enumerate(b.column("text").to_pylist()):
                    lines = lines_of(text)
                    if not lines:
                        continue
                    h = np.array([xxhash.xxh3_64_intdigest(x) for _, x, _ in lines], np.uint64)
                    for place, found in selected(h, np.array([n for _, _, n in lines], np.int64), least).items():
                        at.append(i)
                        mark.append(int(h[place]))
                        for p, q in found:
                            content.append(xxhash.xxh3_64_intdigest(h[p : q + 1].tobytes(), 1))
                            first.append(p)
                            last.append(q)
                        sizes.append(len(content))
                if at:
                    rows = b.select(["doc_id", "row_hash"]).take(pa.array(at))
                    longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (content, mark)]
                    spans = pa.StructArray.from_arrays([longs[0], pa.array(first, pa.int32()), pa.array(last, pa.int32())], fields=list(around.value_type))
                    yield pa.RecordBatch.from_arrays([*rows.columns, longs[1], pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), spans)], names=["doc_id", "row_hash", "mark", "around"])

    return docs.mapInArrow(run, f"doc_id {kind}, row_hash long, mark long, around array<struct<content: long, first: int, last: int>>")


def repeats(docs: DataFrame, tables: Tables, least: int = MIN_WORDS) -> DataFrame:
    """doc_id, row_hash, runs: of each text with repeats, the lines (among those with words) to delete, as (first, last)."""
    places = tables.cut(_places(docs, least))
    # A fingerprint selected at one place only can't be a match.
    marks = places.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1")
    shared = join_unique(places, marks, "mark", "n", places.count(), ["row_hash", "around"]).where("n IS NOT NULL")
    stretches = tables.cut(shared.select("doc_id", "row_hash", F.inline("around")))
    place = F.struct("doc_id", "row_hash", "first", "last")
    firsts = stretches.groupBy("content").agg(F.min(place).alias("partner"), F.count("*").alias("n")).where("n > 1")
    matches = join_unique(stretches, firsts, "content", "n", stretches.count(), ["row_hash", "first", "last"]).where("partner IS NOT NULL")
    p = F.col("partner")
    own = F.col("doc_id").eqNullSafe(p["doc_id"]) & (F.col("row_hash") == p["row_hash"])
    later = matches.where(~(own & (F.col("first") == p["first"])))
    # In the partner's own text the partner's window stays whole.
    later = later.withColumn("first", F.when(own, F.greatest("first", p["last"] + 1)).otherwise(F.col("first")))
    return later.groupBy("doc_id", "row_hash").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("runs"))


def without_repeats(docs: DataFrame, least: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text without later repeated runs, n_lines, n_removed of every row."""
    tables = Tables(docs.sparkSession)
    df = only(docs, doc_id=doc_id, text=text).withColumn("row_hash", F.xxhash64("doc_id", "text"))
    kind = df.schema["doc_id"].dataType.simpleString()
    found = tables.cut(repeats(df, tables, least))
    runs = found.select(F.col("row_hash").alias("own"), "runs").groupBy("own").agg(F.first("runs").alias("runs"))
    joined = df.join(runs.hint("merge"), F.col("row_hash") == F.col("own"), "left").select("doc_id", "text", "runs")

    @in_worker
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in bounded(big, BATCH):
                out, n, gone = [], [], []
                for x, spans in zip(b.column("text").to_pylist(), b.column("runs").to_pylist(), strict=True):
                    lines = lines_of(x)
                    n.append(len(lines))
                    drop = {lines[i][0] for s in spans or () for i in range(s["first"], s["last"] + 1)}
                    gone.append(len(drop))
                    out.append("\n".join(y for i, y in enumerate(x.split("\n")) if i not in drop) if drop else x)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=["doc_id", "text", "n_lines", "n_removed"])

    return joined.mapInArrow(run, f"doc_id {kind}, text string, n_lines long, n_removed long")
