"""Operator 1: quality rules with n-gram perplexity by language.

The base rules look at words, symbols, repeated lines and repeated word windows of a text. The verdict on texts
that pass them comes from a character trigram model with modified Kneser-Ney smoothing, one for each language and one for rows
without. Spark counts the trigrams of all texts over the full alphabet (21 bits a character; white space and digits are one kind each),
and computes probabilities and back-off weights in joins and groupings, so a model grows with what the input holds and no process holds one whole.

Texts are dealt into blocks of about BLOCK characters. A block's distinct n-grams are joined with the models by hash, and what is found comes back to the block,
as sorted arrays that are searched by halves: a worker holds the part of the models that its block needs.

A text may hold passages in other languages. Where a stretch of STRETCH characters is worse by POOR than
its language's model is on average, and another language's model fits it better, it counts by that one.

Short texts scatter more, so a language's texts are parted by length, in classes of powers of two of LEAST texts at least. In a class a text's distance is its
log perplexity less the class's median, in robust standard deviations. A language's lower and upper limits are the least distances
beyond which normal tails would hold EXCESS of the texts that are there at most; where no tail is that heavy there is no limit. Texts outside are rejected. Each distinct text counts once in a band, so that copies of one text
can't move it; bands are read off a histogram of bounded size.

Defined results: null text has no words and fails the base rules, as does every text under MIN_WORDS words. A null language
is scored by the model of all such rows. Repeated rows give repeated results; an empty
table gives an empty result. Other columns, of any name, are ignored (``keep_good`` hands them through).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bucketloom.llm.common import Counts, Tables, be_lean, bounded, in_worker, only

MIN_WORDS, MOST_REPEATED = 50, 50
#: Bits of a character in an n-gram's code.
BITS = 21
MASK = (1 << BITS) - 1
EDGE, SPACE, DIGIT = 0, 32, 48
#: Characters of a block, and the fewest blocks.
BLOCK, LEAST_BLOCKS = 8 << 20, 12
#: Cells of a table of pairs of characters; larger alphabets are sorted instead.
TABLE = 1 << 22
#: Share of texts beyond a limit that normal tails would give at most, and the limit of languages of under LEAST texts.
EXCESS, WIDTH, LEAST = 0.1, 4.5, 50
STRETCH, POOR = 64, 0.15
#: Width of a histogram's cells, in log perplexity.
CELL = 0.005
#: Texts of a batch, in bytes, that are scored together.
BATCH = 2 << 20
REST = "*"
_SYMBOL_BYTES = b"#*$%&|<>"


# Base rules


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more, first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    m = len(number) + 1
    if m < 1 << 21:
        key = (ids[:-2] * m + ids[1:-1]) * m + ids[2:]
    else:
        pairs = np.unique(ids[:-1] * m + ids[1:], return_inverse=True)[1].astype(np.int64)
        key = pairs[:-1] * m + ids[2:]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    twice = np.zeros(len(key), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def base(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode()
    words = data.split()
    spaces = len(data) - sum(map(len, words))
    lines = [x for x in data.split(b"\n") if x.split(None, 1)]
    return (
        len(words),
        len(text) - spaces,
        len(data) - len(data.translate(None, _SYMBOL_BYTES)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MOST_REPEATED * n_words


# Symbols and the model


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts, each between two edges (0), with white space and digits as single kinds; the texts' lengths."""
    low = [f"\0{x.lower()}\0" if x else "" for x in texts]
    lens = np.fromiter(map(len, low), np.int64, len(low))
    return np.frombuffer("".join(low).encode("utf-32-le"), np.uint32), lens


def _numbered(s: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number of each trigram of ``s`` where ``own``, and the codes by number, ascending. Tables of characters, pairs and triples while they're small."""
    flags = np.zeros(int(s.max()) + 1, bool)
    flags[s] = True
    chars = np.flatnonzero(flags)
    a = len(chars)
    if a * a <= TABLE:
        lut = np.zeros(len(flags), np.int32)
        lut[chars] = np.arange(a, dtype=np.int32)
        d = lut[s]
        pairs, p = _ranked(d[:-1] * np.int32(a) + d[1:], a * a)
        if len(pairs) * a <= 4 * TABLE:
            triples, ids = _ranked((p[:-1] * np.int32(a) + d[2:])[own], len(pairs) * a)
            first = pairs[triples // a]
            return ids, (chars[first // a] << (2 * BITS)) | (chars[first % a] << BITS) | chars[triples % a]
    w = s.astype(np.int64)
    codes, ids = np.unique(((w[:-2] << (2 * BITS)) | (w[1:-1] << BITS) | w[2:])[own], return_inverse=True)
    return ids, codes


def _ranked(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of ``x``, all under ``size``, and each value's place among them."""
    flags = np.zeros(size, bool)
    flags[x] = True
    found = np.flatnonzero(flags)
    lut = np.zeros(size, np.int32)
    lut[found] = np.arange(len(found), dtype=np.int32)
    return found, lut[x]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number of each trigram inside the texts, one text after another; the codes by number; and how many trigrams each text has.

    An edge before a text's first character leaves it a bigram's context.
    """
    c, lens = code_points(texts)
    if not len(c):
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(len(lens), np.int64)
    s = c.copy()
    s[(s >= 9) & (s <= 13)] = SPACE
    s[(s >= 48) & (s < 58)] = DIGIT
    own = np.ones(len(s), bool)  # not where a trigram reaches into the next text
    end = np.cumsum(lens[lens > 0])
    own[end - 1] = own[end - 2] = False
    return *_numbered(s, own[:-2]), np.maximum(lens - 2, 0)


@dataclass(frozen=True)
class Models:
    """All languages' n-grams as a table: name, size (1 to 3), code, log_p, log_back. By name: log probability of a symbol that the
    language's texts don't hold, and mean negative log probability of a character of the counted texts."""

    table: DataFrame
    unseen: dict[str, float]
    entropy: dict[str, float]


class Slice:
    """What a block needs of a language's model, in sorted arrays."""

    def __init__(self, size: np.ndarray, code: np.ndarray, log_p: np.ndarray, log_back: np.ndarray, unseen: float):
        self.unseen = unseen
        self.by_size = {}
        for n in (1, 2, 3):
            at = np.flatnonzero(size == n)
            at = at[np.argsort(code[at], kind="stable")]
            self.by_size[n] = code[at], log_p[at], log_back[at]

    def find(self, n: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = self.by_size[n][0]
        if not len(keys):
            return np.zeros(len(code), bool), np.zeros(len(code), np.int64)
        at = np.minimum(np.searchsorted(keys, code), len(keys) - 1)
        return keys[at] == code, at

    def log_prob(self, code: np.ndarray) -> np.ndarray:
        """log p of trigrams, backing off to bigrams, single symbols and the unseen one."""
        out, back = np.zeros(len(code)), np.zeros(len(code))
        todo = np.arange(len(code))
        for n in (3, 2, 1):
            own = code[todo] & ((1 << n * BITS) - 1)
            has, at = self.find(n, own)
            p = self.by_size[n][1][at[has]] if has.any() else np.zeros(0)
            real = ~np.isnan(p)  # a bigram may only ever be a context
            has[np.flatnonzero(has)[~real]] = False
            out[todo[has]] = back[todo[has]] + p[real]
            todo, own = todo[~has], own[~has]
            if n > 1 and len(todo):
                known, at = self.find(n - 1, own >> BITS)
                back[todo[known]] += self.by_size[n - 1][2][at[known]]
        out[todo] = back[todo] + self.unseen
        return out


class _Scorer:
    """A block's texts by the slices of the models."""

    def __init__(self, by_lang: dict[str, Slice], entropy: dict[str, float]):
        self.by_lang, self.entropy = by_lang, entropy

    def name(self, lang: str | None) -> str:
        return lang if lang is not None and lang in self.entropy else REST

    def log_perplexity(self, texts: list[str | None], langs: list[str | None]) -> np.ndarray:
        """Mean negative log probability of a character of each text; NaN for empty ones."""
        out = np.full(len(texts), np.nan)
        by: dict[str, list[int]] = {}
        for i, x in enumerate(langs):
            if texts[i]:
                by.setdefault(self.name(x), []).append(i)
        for name, rows in by.items():
            if name not in self.by_lang:
                continue
            ids, codes, n = trigrams([texts[i] for i in rows])
            parts = -(-n // STRETCH)
            first = np.cumsum(parts) - parts
            nth = np.arange(parts.sum()) - np.repeat(first, parts)
            begin = np.repeat(np.cumsum(n) - n, parts) + nth * STRETCH
            size = np.diff(np.append(begin, len(ids)))
            nats = -np.add.reduceat(self.by_lang[name].log_prob(codes)[ids], begin, dtype=np.float64)
            usual = size * (self.entropy[name] + POOR)
            poor = np.flatnonzero(nats > usual)
            others = [x for x in self.by_lang if x not in (name, REST)]
            if len(poor) and others:
                at = np.repeat(begin[poor], size[poor]) + np.arange(size[poor].sum()) - np.repeat(np.cumsum(size[poor]) - size[poor], size[poor])
                seen, of = _ranked(ids[at], len(codes))
                edge = np.cumsum(size[poor]) - size[poor]
                for x in others:
                    nats[poor] = np.minimum(nats[poor], -np.add.reduceat(self.by_lang[x].log_prob(codes[seen])[of], edge, dtype=np.float64))
            doc = np.repeat(np.arange(len(rows)), parts)
            out[rows] = np.bincount(doc, nats, len(rows)) / np.bincount(doc, size, len(rows))
        return out


def _discounted(t: DataFrame) -> DataFrame:
    """``t`` (name, code, n) with each n-gram's discount d, from how many n-grams occur 1 to 4 times."""
    k = t.groupBy("name").agg(*[F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in range(1, 5)])
    y = F.expr("n1 / (n1 + 2 * n2)")
    whole = F.expr("n1 > 0 AND n2 > 0 AND n3 > 0 AND n4 > 0")

    def cut(x: Column, otherwise: float, low: float, high: float) -> Column:
        return F.when(whole, F.greatest(F.lit(low), F.least(F.lit(high), x))).otherwise(otherwise)

    k = k.withColumn("y", F.when(whole, y)).select(
        F.col("name"),
        cut(F.expr("1 - 2 * y * n2 / n1"), 0.5, 0.05, 0.95).alias("d1"),
        cut(F.expr("2 - 3 * y * n3 / n2"), 1.0, 0.1, 1.95).alias("d2"),
        cut(F.expr("3 - 4 * y * n4 / n3"), 1.5, 0.1, 2.95).alias("d3"),
    )
    return t.join(F.broadcast(k), "name").select("name", "code", "n", F.expr("CASE n WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END").alias("d"))


def _level(t: DataFrame, size: int, lower: DataFrame) -> tuple[DataFrame, DataFrame]:
    """name, code, n, p of the n-grams of a size from their counts and the lower order's p; name, code, back of their contexts."""
    x = _discounted(t).withColumn("context", F.shiftright("code", BITS)).withColumn("tail", F.col("code").bitwiseAND((1 << (size - 1) * BITS) - 1))
    contexts = x.groupBy("name", "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("back"))
    x = x.join(contexts, ["name", "context"]).join(lower.select("name", F.col("code").alias("tail"), F.col("p").alias("low")), ["name", "tail"])
    return x.select("name", "code", "n", ((F.col("n") - F.col("d")) / F.col("total") + F.col("back") * F.col("low")).alias("p")), contexts.select("name", F.col("context").alias("code"), "back")


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Models:
    """Counts the trigrams of all texts, and makes each language's model."""
    tables = Tables(docs.sparkSession)
    df = only(docs, text=text, lang=lang).where("text IS NOT NULL AND text <> ''")

    @in_worker
    def count(batches):
        held = Counts()

        def out():
            for name, code, n in held.take():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(code), pa.string()), pa.array(code), pa.array(n)], names=["name", "code", "n"])

        for big in batches:
            for b in bounded(big, BATCH):
                groups: dict[str, list[str]] = {}
                for t, x in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                    groups.setdefault(REST if x is None else x, []).append(t)
                for name, texts in groups.items():
                    ids, code, _ = trigrams(texts)
                    held.add(name, code, np.bincount(ids, minlength=len(code)))
                if held.many:
                    yield from out()
        yield from out()

    t3 = tables.cut(df.mapInArrow(count, "name string, code long, n long").groupBy("name", "code").agg(F.sum("n").alias("n")))
    # Lower orders count in how many contexts an n-gram occurs.
    t2 = t3.groupBy("name", F.col("code").bitwiseAND((1 << 2 * BITS) - 1).alias("code")).agg(F.count("*").alias("n"))
    t1 = t2.groupBy("name", F.col("code").bitwiseAND(MASK).alias("code")).agg(F.count("*").alias("n"))
    single = _discounted(t1)
    whole = single.groupBy("name").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n") / (F.count("*") + 1)).alias("unseen"))
    p1 = single.join(F.broadcast(whole), "name").select("name", "code", "n", ((F.col("n") - F.col("d")) / F.col("total") + F.col("unseen")).alias("p"), "unseen")
    p1 = tables.cut(p1)
    p2, back1 = _level(t2, 2, p1)
    p2 = tables.cut(p2)
    p3, back2 = _level(t3, 3, p2)
    p3 = tables.cut(p3)
    nothing = F.lit(None).cast("double")
    rows = [x.select("name", F.lit(i).alias("size"), "code", "p", nothing.alias("back")) for i, x in ((1, p1), (2, p2), (3, p3))]
    rows += [x.select("name", F.lit(i).alias("size"), "code", nothing.alias("p"), "back") for i, x in ((1, back1), (2, back2))]
    every = rows[0]
    for x in rows[1:]:
        every = every.unionByName(x)
    log = lambda c: F.log(F.max(c)).cast("float")
    table = tables.cut(every.groupBy("size", "code", "name").agg(log("p").alias("log_p"), log("back").alias("log_back")))
    # One row a language.
    unseen = {r["name"]: float(np.log(r["x"])) for r in p1.groupBy("name").agg(F.max("unseen").alias("x")).collect()}
    entropy = {r["name"]: r["x"] for r in p3.groupBy("name").agg((-F.sum(F.col("n") * F.log("p")) / F.sum("n")).alias("x")).collect()}
    return Models(table, unseen, entropy)


# Scores, bands and verdicts

_FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, model string, log_perplexity double, text_hash long"


def score(docs: DataFrame, models: Models, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, the base rules' counts, the model used and the log perplexity of a character, of every row."""
    return _scored(only(docs, doc_id=doc_id, text=text, lang=lang), models).drop("text", "lang")


def _scored(df: DataFrame, models: Models) -> DataFrame:
    """All rows of ``df`` with what ``_FIELDS`` names. ``df`` has text and lang, and none of those names."""
    columns = df.schema
    spark = df.sparkSession
    chars = df.agg(F.sum(F.length("text").cast("long")).alias("n")).first()["n"] or 0
    blocks = max(LEAST_BLOCKS, -(-chars // BLOCK))
    # One exchange serves both readers.
    dealt = df.withColumn("text_hash", F.xxhash64("text")).withColumn("block", F.pmod(F.xxhash64(*[F.col(c) for c in ("doc_id", "text") if c in df.columns]), F.lit(blocks)).cast("int")).repartition("block")
    shared = spark.sparkContext.broadcast((models.unseen, models.entropy))

    @in_worker
    def wanted(batches):
        held = Counts()

        def out():
            for (size, block), code, _ in held.take():
                n = len(code)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block, np.int32)), pa.array(np.full(n, size, np.int32)), pa.array(code)], names=["block", "size", "code"])

        for big in batches:
            for b in bounded(big, BATCH):
                block = b.column("block").to_numpy()
                texts = b.column("text")
                for k in np.unique(block).tolist():
                    code = trigrams(texts.take(pa.array(np.flatnonzero(block == k))).to_pylist())[1]
                    for size, own in ((3, code), (2, np.concatenate([code & ((1 << 2 * BITS) - 1), code >> BITS])), (1, np.concatenate([code & MASK, code >> BITS & MASK]))):
                        own = np.unique(own)
                        held.add((size, k), own, np.ones(len(own), np.int64))
                if held.many:
                    yield from out()
        yield from out()

    needs = dealt.mapInArrow(wanted, "block int, size int, code long")
    slices = needs.join(models.table.hint("merge"), ["size", "code"]).select("block", "name", "size", "code", "log_p", "log_back")
    names = [c for c in df.columns]

    def rate(rows: pa.Table, grams: pa.Table) -> pa.Table:
        be_lean()
        unseen, entropy = shared.value
        by_lang = {}
        found = grams.column("name").combine_chunks().dictionary_encode() if grams.num_rows else None
        if found is not None:
            found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
            of = found.indices.to_numpy(zero_copy_only=False)
            size, code, p, back = (grams.column(c).to_numpy() for c in ("size", "code", "log_p", "log_back"))
            for i, x in enumerate(found.dictionary.to_pylist()):
                at = of == i
                by_lang[x] = Slice(size[at], code[at], p[at].astype(np.float64), np.nan_to_num(back[at].astype(np.float64)), unseen[x])
        s = _Scorer(by_lang, entropy)
        parts = []
        for big in rows.combine_chunks().to_batches():
            for b in bounded(big, BATCH):
                texts, langs = b.column("text").to_pylist(), b.column("lang").to_pylist()
                counts = list(zip(*map(base, texts), strict=True))
                lp = s.log_perplexity(texts, langs)
                cols = [*(b.column(c) for c in names), *(pa.array(c, pa.int64()) for c in counts), pa.array([s.name(x) for x in langs], pa.string()), pa.array(lp, pa.float64(), mask=np.isnan(lp)), b.column("text_hash")]
                parts.append(pa.RecordBatch.from_arrays(cols, names=[*names, *(x.split()[0] for x in _FIELDS.split(", "))]))
        return pa.Table.from_batches(parts)

    out = T.StructType([*columns.fields, *T.StructType.fromDDL(_FIELDS).fields])
    return dealt.groupBy("block").cogroup(slices.groupBy("block")).applyInArrow(rate, out)


def _failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _tail(x: np.ndarray) -> np.ndarray:
    """The normal distribution's share beyond x."""
    return np.array([math.erfc(v / math.sqrt(2)) / 2 for v in x])


def _middle(values: np.ndarray, n: np.ndarray) -> float:
    o = np.argsort(values, kind="stable")
    c = np.cumsum(n[o])
    return float(values[o][np.searchsorted(c, c[-1] / 2)])


def _limit(z: np.ndarray, n: np.ndarray) -> float:
    """The least distance beyond which normal tails would hold EXCESS of the texts there."""
    if n.sum() < LEAST:
        return WIDTH
    at = np.arange(2, 12, 0.05)
    o = np.argsort(z, kind="stable")
    beyond = n.sum() - np.concatenate([[0], np.cumsum(n[o])])[np.searchsorted(z[o], at, side="right")]
    heavy = np.flatnonzero((beyond > 0) & (n.sum() * _tail(at) <= EXCESS * beyond))
    return float(at[heavy[0]]) if len(heavy) else math.inf


def bands(scores: DataFrame) -> list[tuple[str, int, int, float, float]]:
    """Model, fewest and most word characters, and the log perplexities between which such texts are kept. Over distinct texts that pass the base rules."""
    each = scores.where(~_failed() & F.col("log_perplexity").isNotNull()).groupBy("model", "text_hash").agg(F.min("log_perplexity").alias("x"), F.min("word_chars").alias("chars"))
    kinds = F.floor(F.log2(F.greatest(F.col("chars"), F.lit(1)))).cast("int").alias("kind"), F.floor(F.col("x") / CELL).alias("cell")
    by: dict[str, dict[int, list[tuple[int, int]]]] = {}
    for r in each.groupBy("model", *kinds).agg(F.count("*").alias("n")).collect():
        by.setdefault(r["model"], {}).setdefault(r["kind"], []).append((r["cell"], r["n"]))
    out = []
    for name, of in sorted(by.items()):
        classes: list[tuple[int, list[tuple[int, int]]]] = []  # first kind and histogram
        for kind in sorted(of):
            if classes and sum(n for _, n in classes[-1][1]) < LEAST:
                classes[-1][1].extend(of[kind])
            else:
                classes.append((kind, [*of[kind]]))
        if len(classes) > 1 and sum(n for _, n in classes[-1][1]) < LEAST:
            classes[-2][1].extend(classes.pop()[1])
        fits, z, texts = [], [], []
        for _, hist in classes:
            cell, n = np.array(sorted(hist)).T
            x = (cell + 0.5) * CELL
            centre = _middle(x, n)
            spread = max(CELL, _middle(np.abs(x - centre), n) * 1.4826)
            fits.append((centre, spread))
            z.append((x - centre) / spread)
            texts.append(n)
        every, count = np.concatenate(z), np.concatenate(texts)
        low, high = _limit(-every, count), _limit(every, count)
        begins = [0, *(1 << kind for kind, _ in classes[1:])]
        for begin, end, (centre, spread) in zip(begins, [*begins[1:], 1 << 62], fits, strict=True):
            out.append((name, begin, end - 1, centre - low * spread, centre + high * spread))
    return out


def _inside(scores: DataFrame, found: list[tuple[str, int, int, float, float]]) -> DataFrame:
    """``scores`` with inside, by the base rules and the bands."""
    limits = scores.sparkSession.createDataFrame(found, "band string, least long, most long, low double, high double")
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    fits = (F.col("model") == F.col("band")) & F.col("word_chars").between(F.col("least"), F.col("most"))
    return scores.join(F.broadcast(limits), fits, "left").withColumn("inside", ~_failed() & inside)


def verdicts(scores: DataFrame, found: list[tuple[str, int, int, float, float]]) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, perplexity."""
    return _inside(scores, found).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _failed().alias("base_failed"),
        F.col("inside").alias("kept"),
        "model",
        F.exp("log_perplexity").alias("perplexity"),
    )


def judge(docs: DataFrame) -> DataFrame:
    """Trains on all of ``docs`` and returns ``verdicts`` of every row."""
    tables = Tables(docs.sparkSession)
    scores = tables.cut(score(docs, train(docs)))
    return verdicts(scores, bands(scores))


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs``, all columns as they are, without the rows that ``judge`` rejects."""
    tables = Tables(docs.sparkSession)
    own = {c: c if c in ("doc_id", "text", "lang") else f"own_{i}" for i, c in enumerate(docs.columns)}
    scores = tables.cut(_scored(docs.select(*[F.col(f"`{c}`").alias(x) for c, x in own.items()]), train(docs)))
    kept = _inside(scores, bands(scores)).where("inside")
    return kept.select(*[F.col(x).alias(c, metadata=docs.schema[c].metadata) for c, x in own.items()]).to(docs.schema)
