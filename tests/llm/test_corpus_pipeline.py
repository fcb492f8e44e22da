"""The pipeline's stages against plain Python, each on what the stage before it kept, edge rows included."""

import re
import time
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from bucketloom.llm import common, language_id, packing, quality
from tests.llm.test_edge_cases import DOCS, brute_components, rows

_RNG = np.random.default_rng(5)
_EN, _DE = ([f"{a}{b}" for a in x.split() for b in y.split()] for x, y in (("th st wh br cl fr", "ey ing ough ation ere ight own"), ("sch zw pf kn bl gr", "ung eit icht aum erg üste ößer")))


def prose(words, n=120):
    return " ".join(_RNG.choice(words, n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    made = [(1000 + i, prose(_EN if i % 2 else _DE), "en" if i % 2 else "de") for i in range(160)]
    made += [(2000 + i, t.replace(" ", "  ", 3), x) for i, (_, t, x) in enumerate(made[:10])]  # equal but for white space
    made += [(3000 + i, t + " tail", x) for i, (_, t, x) in enumerate(made[20:30])]  # near copies
    made += [(4000 + i, "".join(chr(33 + k) for k in _RNG.integers(0, 60, 500)) + " " + " ".join(chr(35 + k) * 3 for k in _RNG.integers(0, 60, 80)), "en") for i in range(3)]
    clash = ["x"] * (len(DOCS) - 4)
    all_ = [*rows(), *[(i, t, x, "s", *clash) for i, t, x in made], (1000, made[0][1], "de", "s", *clash)]
    at = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(all_, DOCS).repartition(4).write.parquet(f"{at}/documents.parquet")
    return str(at)


def key(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_every_stage_by_plain_python(spark, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "exact_dedup", "near_dedup", "best_fit_packing"]
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs.collect()

    model = language_id.learn(docs.where(~language_id.held_out(docs["doc_id"])))
    one = stage["language_id"](spark, docs, folder).cache()
    assert one.schema == docs.schema
    told = language_id.predict([r.text for r in before], model)
    assert key(one) == Counter((r.doc_id, r.text) for r, x in zip(before, told, strict=True) if x[0] != "und" and x[1] >= 0.4)

    two = stage["quality_rules"](spark, one, folder).cache()
    assert two.schema == docs.schema
    left = {(r.doc_id, r.text) for r in two.collect()}
    for r in one.collect():  # the base rules by plain words; the bands by the operator's own verdicts
        words = r.text.encode().split()
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        if len(words) < 50 or 100 * len(again) > 50 * len(words):
            assert (r.doc_id, r.text) not in left
    verdicts = Counter(r.doc_id for r in quality.judge(one).where("kept").collect())
    assert Counter(d for d, _ in key(two).elements()) == verdicts
    clean = {1000 + i for i in range(160)}
    assert len(clean & {d for d, _ in left}) >= 0.95 * len(clean & {r.doc_id for r in one.collect()})

    three = stage["exact_dedup"](spark, two, folder).cache()
    assert three.schema == docs.schema
    norm, kept = lambda t: re.sub(r"[ \t\n\x0b\f\r]+", " ", t or ""), {}
    order = lambda d: (d is None, d or 0)
    for d, t in key(two):
        kept[norm(t)] = min(kept.get(norm(t), (d, t)), (d, t), key=lambda x: order(x[0]))
    assert Counter(d for d, _ in key(three).elements()) == Counter(d for d, _ in kept.values())

    four = stage["near_dedup"](spark, three, folder).cache()
    assert four.schema == docs.schema
    assert Counter(d for d, _ in key(four).elements()) == Counter(d for (d, _, c) in brute_components(list(key(three))) if d == c)

    five = stage["best_fit_packing"](spark, four, folder).collect()
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    length = Counter()
    for p in five:
        length[p.doc_id] += p.length
    assert length == Counter({d: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for d, x in key(four)})

    whole = corpus_pipeline.run(spark, folder)
    pieces = lambda x: Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in x)
    assert pieces(whole.collect()) == pieces(five)


def test_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def held(spark, wrap):
    """Of each task on a worker: how often the worker took up an operator's task, and the tables that it has."""

    def look(batches):
        for _ in batches:
            pass
        time.sleep(0.3)  # so that every worker gets a task
        yield pa.RecordBatch.from_pylist([{"turn": common._turn, "tables": [k for k in common._kept if k]}])

    look.__module__ = "elsewhere"
    got = spark.range(4).repartition(4).mapInArrow(wrap(look), "turn long, tables array<string>").collect()
    return max(r.turn for r in got), [k for r in got for k in r.tables]


def test_workers_let_their_tables_go(spark, folder):
    common.ship(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    def pack():
        assert packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).count() >= docs.count()

    pack()
    turn, tables = held(spark, common.in_worker)  # a task of another module
    assert turn > 0 and not tables
    pack()
    time.sleep(common.IDLE + 1)
    turn, tables = held(spark, lambda look: look)  # no task since
    assert turn > 0 and not tables


def test_likelihood_takes_bounded_memory(monkeypatch):
    n, rng = language_id.DENSE, np.random.default_rng(3)
    begin = np.arange(language_id.BUCKETS + 1)
    model = language_id.Model(tuple(map(str, range(n))), rng.random(n), begin, rng.integers(0, n, language_id.BUCKETS), rng.random(language_id.BUCKETS), np.zeros(n))
    grams, first = rng.integers(0, language_id.BUCKETS, 400_007), np.arange(0, 400_007, language_id.WINDOW)
    plain = np.add.reduceat(model.dense[grams], first, axis=0, dtype=np.float64)
    tracemalloc.start()
    got = model.likelihood(grams, first)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(got, plain)
    assert peak < 20 << 20  # the table's rows of all trigrams at once would be 49 MB
    monkeypatch.setattr(language_id, "CELLS", 1)
    assert np.array_equal(model.likelihood(grams, first), plain)


def test_words_and_stems_share_a_table():
    vocabulary = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    plain, ours = Tokenizer.from_str(vocabulary), packing.Tokens(vocabulary)
    texts = ["stop", "Stop, stop. STOP!! stop", "x" * 80 + ", x" + " \u200b \u0301 <s> <S>, </s>; a<b", "stop, stop", "Äpfel, äpfel ÄPFEL. äpfel,"]
    for t in [*texts, *reversed(texts)]:
        assert np.frombuffer(ours([t.encode()])[0], "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids
    assert ours.words.get(b"stop,") and ours.words.get(b"stop") and not hasattr(ours, "stems")
