"""Operator 5: language identification by multilingual mixture inference.

Learning: each language's distribution over hashed letter trigrams (BUCKETS of them), counted over every training
document. Prediction: a text is cut into windows of WINDOW trigrams, each taken to be in one language; expectation-
maximisation estimates the shares of the languages from the windows' likelihoods. The set of
languages starts as the best single one, and the next best joins as long as the likelihood gains more than a penalty for one
more share (PENALTY * log(1 + windows)). Where even the best language of every window on its own couldn't gain that, the best
single language stands without further iterations, which gives the same set.

The predicted language is the one with the largest share; its score is that share or, for a single language, its
posterior probability. Every language of the training rows is learned. The model is broadcast; its size depends on the number of languages, not of rows:
BUCKETS numbers a language, or, where there are more than DENSE languages, one for each trigram that a language's rows hold.

Defined results: null text, or text without a letter, is ``und`` with score 0; so is every text if nothing could be
learned. A null doc_id isn't held out. Repeated rows give repeated results; an empty table gives an empty result. Other
columns, of any name, are ignored (``keep_identified`` hands them through).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bucketloom.llm.common import Counts, bounded, in_worker, map_batches, only

BITS = 18
BUCKETS = 1 << BITS
WINDOW = 32
PENALTY = 3.0
SMOOTHING = 0.05
#: Languages up to which the model is one table of all buckets.
DENSE = 32
ITERATIONS = 25
#: Trigrams whose entries are added up at a time where the model isn't one table.
SPARSE_STEP = 1 << 14
#: Texts of a batch, in bytes, whose windows are computed together.
BATCH = 1 << 19
#: Numbers of the dense table that are added up at a time.
CELLS = 1 << 20

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of all texts, one after another, and how many each text has (0 without a letter)."""
    low = [f" {x.lower()} " if x else "" for x in texts]
    lens = np.fromiter(map(len, low), np.int64, len(low))
    c = np.frombuffer("".join(low).encode("utf-32-le"), np.uint32).copy()
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    letter = letters()[c]
    c[~letter] = 32
    doc = np.repeat(np.arange(len(low)), lens)
    keep = letter.copy()  # of runs of other characters one stays
    keep[0] = True
    keep[1:] |= letter[:-1] | (doc[1:] != doc[:-1])
    c, doc = c[keep], doc[keep]
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    with np.errstate(over="ignore"):
        h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
    # A text's end is a space and the next begins with one, so one-letter words give a trigram and boundaries none.
    own = (doc[:-2] == doc[2:]) & ((c[:-2] != 32) | (c[1:-1] != 32))
    return (h[own] >> np.uint32(32 - BITS)).astype(np.int64), np.bincount(doc[:-2][own], minlength=len(texts))


@dataclass(frozen=True)
class Model:
    """log p(bucket | language): for each language its value of buckets that it never saw, and what seen ones have beyond it, by bucket."""

    languages: tuple[str, ...]
    unseen: np.ndarray
    #: Where each bucket's entries begin; their languages and values.
    begin: np.ndarray
    lang: np.ndarray
    beyond: np.ndarray
    log_prior: np.ndarray

    @cached_property
    def dense(self) -> np.ndarray:
        out = np.zeros((BUCKETS, len(self.languages)), np.float32)
        out[np.repeat(np.arange(BUCKETS), np.diff(self.begin)), self.lang] = self.beyond
        return out + self.unseen.astype(np.float32)

    def likelihood(self, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Log likelihood of each window of trigrams, which begin at ``first``, by language."""
        n = len(self.languages)
        if n <= DENSE:
            step, out = max(1, CELLS // (n * WINDOW)), np.empty((len(first), n))
            for i in range(0, len(first), step):
                own = first[i : i + step]
                end = first[i + step] if i + step < len(first) else len(grams)
                np.add.reduceat(self.dense[grams[own[0] : end]], own - own[0], axis=0, dtype=np.float64, out=out[i : i + step])
            return out
        size = np.diff(np.append(first, len(grams)))
        out = size[:, None] * self.unseen
        of = np.repeat(np.arange(len(first)), size)
        entries = self.begin[grams + 1] - self.begin[grams]
        upto = np.cumsum(entries)
        for p in range(0, len(grams), SPARSE_STEP):
            e = entries[p : p + SPARSE_STEP]
            at = np.arange(e.sum()) + np.repeat(self.begin[grams[p : p + SPARSE_STEP]] - (upto[p : p + SPARSE_STEP] - e - (upto[p] - e[0])), e)
            w = np.repeat(of[p : p + SPARSE_STEP], e)
            low = int(of[p])
            some = np.bincount((w - low) * n + self.lang[at], self.beyond[at], (int(of[min(p + SPARSE_STEP, len(of)) - 1]) - low + 1) * n)
            out[low : low + len(some) // n] += some.reshape(-1, n)
        return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of all given documents with a language."""
    df = only(docs, text=text, lang=lang).where("lang IS NOT NULL AND text IS NOT NULL")
    rows = {r["lang"]: r["count"] for r in df.groupBy("lang").count().collect()}  # one row a language
    languages = tuple(sorted(rows))
    if not languages:
        return Model((), np.zeros(0), np.zeros(BUCKETS + 1, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    number = {x: i for i, x in enumerate(languages)}

    @in_worker
    def count(batches):
        held = Counts()

        def out():
            for _, k, n in held.take():
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], names=["k", "n"])

        for big in batches:
            for b in bounded(big, BATCH):
                pairs = [(t, number[x]) for t, x in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True)]
                grams, n = trigrams([t for t, _ in pairs])
                if len(grams):
                    held.add(None, *np.unique(grams * len(languages) + np.repeat(np.array([i for _, i in pairs]), n), return_counts=True))
                    if held.many:
                        yield from out()
        yield from out()

    counted = df.mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    k, n = counted.column("k").to_numpy(), counted.column("n").to_numpy().astype(float)
    order = np.argsort(k)
    k, n = k[order], n[order]
    bucket, lang = k // len(languages), k % len(languages)
    total = np.bincount(lang, n, len(languages)) + SMOOTHING * BUCKETS
    prior = np.array([rows[x] for x in languages], float)
    begin = np.searchsorted(bucket, np.arange(BUCKETS + 1))
    return Model(languages, np.log(SMOOTHING / total), begin, lang, np.log1p(n / SMOOTHING), np.log(prior / prior.sum()))


def em(likelihood: np.ndarray, languages: list[int]) -> tuple[float, np.ndarray]:
    """Log likelihood and shares of a mixture of the given languages over windows (log likelihoods)."""
    x = likelihood[:, languages]
    most = x.max(axis=1, keepdims=True)
    p = np.exp(x - most)
    share = np.full(len(languages), 1 / len(languages))
    value = -np.inf
    for _ in range(ITERATIONS):
        joint = p * share
        whole = joint.sum(axis=1, keepdims=True)
        now = float(np.log(whole).sum())
        share = (joint / whole).mean(axis=0)
        if now - value < 1e-3:
            break
        value = now
    return now + float(most.sum()), share


def mixture(likelihood: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray]:
    """The set of languages and their shares, by forward selection."""
    chosen = [int(likelihood.sum(axis=0).argmax())]
    value, share = float(likelihood[:, chosen[0]].sum()), np.ones(1)
    while len(chosen) < likelihood.shape[1]:
        tried = [(*em(likelihood, [*chosen, k]), k) for k in range(likelihood.shape[1]) if k not in chosen]
        best = max(tried, key=lambda x: x[0])
        if best[0] - value <= penalty:
            break
        value, share = best[0], best[1]
        chosen.append(best[2])
    return chosen, share


def predict(texts: list[str | None], model: Model) -> list[tuple[str, float, list[str], list[float]]]:
    """Language, score, set of languages and shares of each text."""
    out: list = [("und", 0.0, [], [])] * len(texts)
    grams, n = trigrams(texts)
    if not len(grams) or not model.languages:
        return out
    has = np.flatnonzero(n)
    n = n[has]
    begin = np.cumsum(n) - n
    windows = -(-n // WINDOW)
    first = np.cumsum(windows) - windows
    nth = np.arange(windows.sum()) - np.repeat(first, windows)
    likelihood = model.likelihood(grams, np.repeat(begin, windows) + nth * WINDOW)
    single = np.add.reduceat(likelihood, first, axis=0)
    bound = np.add.reduceat(likelihood.max(axis=1), first)
    posterior = single + model.log_prior
    best = posterior.argmax(axis=1)
    top = posterior.max(axis=1)
    score = 1 / np.exp(posterior - top[:, None]).sum(axis=1)
    penalty = PENALTY * np.log1p(windows)
    mixed = bound - single.max(axis=1) > penalty
    for i, d in enumerate(has):
        if mixed[i]:
            chosen, share = mixture(likelihood[first[i] : first[i] + windows[i]], float(penalty[i]))
            if len(chosen) > 1:
                order = np.argsort(-share, kind="stable")
                names = [model.languages[chosen[k]] for k in order]
                out[d] = (names[0], float(min(1.0, share[order[0]])), names, [float(share[k]) for k in order])
                continue
        x = model.languages[best[i]]
        out[d] = (x, float(score[i]), [x], [1.0])
    return out


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages, shares of every row."""
    df = only(docs, doc_id=doc_id, text=text).withColumn("held_out", held_out(F.col("doc_id")))
    kind = df.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def f(big: pa.RecordBatch) -> pa.RecordBatch:
            found = [x for b in bounded(big, BATCH) for x in predict(b.column("text").to_pylist(), shared.value)]
            kinds = (pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()))
            cols = [pa.array([x[i] for x in found], k) for i, k in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([b for b in (big.column("doc_id"), big.column("held_out"))] + cols, names=["doc_id", "held_out", "lang_pred", "score", "languages", "shares"])

        return f

    return map_batches(df, make, f"doc_id {kind}, held_out boolean, lang_pred string, score double, languages array<string>, shares array<double>")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.4, text: str = "text") -> DataFrame:
    """``docs``, all columns as they are, without rows that are ``und`` or whose main language's score is under ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def make():
        def f(big: pa.RecordBatch) -> pa.RecordBatch:
            found = [x for b in bounded(big.select([at]), BATCH) for x in predict(b.column(0).to_pylist(), shared.value)]
            return big.filter(pa.array([x[0] != "und" and x[1] >= least for x in found], pa.bool_()))

        return f

    return map_batches(docs, make, docs.schema)
