"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and columns with clashing names."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T
from tokenizers import Tokenizer

from bucketloom.llm import bpe_automaton, exact_dedup, html_text, language_id, line_dedup, near_dedup, packing, quality, sharding, url_filter

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
#: Names that the operators use inside.
CLASH = ("fp", "key", "n", "size", "node", "salt", "shard", "row_hash", "text_hash", "piece", "kept")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), *[T.StructField(c, T.StringType()) for c in CLASH]])

LONG = " ".join(f"w{i % 7919}x{i % 104729}" for i in range(30_000))
WORDS = "the quick brown fox jumps over a lazy dog and runs away from one hundred barking hounds in the dark".split()
PROSE = [" ".join(WORDS[(i * 7 + j * j) % len(WORDS)] + str((i * j) % 9) for j in range(120)) for i in range(6)]
PASSAGE = " ".join(f"passage{i}" for i in range(60))
TEXTS = [None, "", "   \n\t ", "a", "one two", "one  two", "A b c d", "a b c d", *PROSE, PROSE[0], PROSE[0] + " tail", PROSE[1].upper(), LONG, LONG + " end", f"{PASSAGE}\nmine", f"other\n{PASSAGE}\n{PASSAGE}", "äöü ß ñ 漢字 🙂 <|endoftext|> x"]


def rows(texts=TEXTS):
    out = [(i, t, ("en", "de", None)[i % 3], f"s{i % 2}", *["x"] * len(CLASH)) for i, t in enumerate(texts)]
    return [*out, out[8], out[8], (None, PROSE[2], None, None, *[None] * len(CLASH)), (None, None, None, None, *[None] * len(CLASH))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def ids_and_texts():
    return [(r[0], r[1]) for r in rows()]


# Brute force


def grams(text):
    w = (text or "").encode().lower().split()
    return set() if not w else {tuple(w)} if len(w) < 5 else set(zip(w, w[1:], w[2:], w[3:], w[4:]))


def brute_components(pairs):
    sets = [grams(t) for _, t in pairs]
    up = list(range(len(pairs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(pairs)):
        groups[root(i)].append(pairs[i][0])
    least = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    return Counter((p[0], len(sets[i]), least[root(i)] if sets[i] else p[0]) for i, p in enumerate(pairs))


def brute_lines(pairs, least=50):
    lines = lambda t: [(i, x) for i, x in enumerate((t or "").split("\n")) if x.encode().split()]
    first, out = {}, {}
    order = sorted({p for p in pairs if p[1] is not None}, key=lambda p: (p[0] is not None, p[0] or 0))
    for delete in (False, True):
        for doc, t in order:
            ls, drop = lines(t), set()
            for p in range(len(ls)):
                n = 0
                for q in range(p, len(ls)):
                    n += len(ls[q][1].encode().split())
                    if n >= least:
                        at = first.setdefault(tuple(x for _, x in ls[p : q + 1]), (doc, t, p))
                        if delete and at != (doc, t, p):
                            own = range(at[2], at[2] + q - p + 1) if at[:2] == (doc, t) else ()
                            drop |= {ls[i][0] for i in range(p, q + 1) if i not in own}
            out[doc, t] = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop)
    return Counter((doc, None if t is None else out[doc, t]) for doc, t in pairs)


# Tests


def test_quality(docs, none):
    got = quality.judge(docs).collect()
    assert len(got) == len(rows())
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for doc, t in ids_and_texts():
        if doc is None:
            continue
        w = [x for x in (t or "").encode().split()]
        counts = Counter(zip(w, w[1:], w[2:]))
        covered = {k + j for k, x in enumerate(zip(w, w[1:], w[2:])) if counts[x] > 1 for j in range(3)}
        r = by[doc]
        assert (r.n_words, r.n_repeat_words) == (len(w), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert quality.judge(none).count() == 0 and quality.keep_good(none).columns == none.columns
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema and Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)


def test_trigrams_are_numbered_alike_by_tables_and_by_sorting(monkeypatch):
    texts = ["Aab  b1\n2", None, "x", "", "\u6f22\u5b57 kana \u304b\u306a", "ab" * 300]
    want = []
    for t in texts:
        x = [0, *(32 if c.isspace() else 48 if c in "0123456789" else ord(c) for c in t.lower()), 0] if t else []
        want.append([p << 2 * quality.BITS | q << quality.BITS | r for p, q, r in zip(x, x[1:], x[2:])])
    for cells in (quality.TABLE, 20, 0):  # all tables, pairs sorted, everything sorted
        monkeypatch.setattr(quality, "TABLE", cells)
        ids, codes, n = quality.trigrams(texts)
        assert codes[ids].tolist() == sum(want, []) and n.tolist() == [len(x) for x in want] and (np.diff(codes) > 0).all()
        assert len(quality.trigrams([None, ""])[0]) == 0


def test_shards(docs, none):
    got = sharding.shard(docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in ids_and_texts())
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard(none).count() == 0


def test_shards_are_near_equal_with_a_hot_group(spark):
    texts = ["same text of some length"] * 3000 + [f"{i} " + "y" * (i % 50) for i in range(6000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    size = Counter()
    for r in sharding.shard(df).collect():
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) <= 2 * 64


def test_shards_cut_a_row_repeated_to_half_of_the_bytes(spark):
    texts = [(7, "same text of some length")] * 4000 + [(100 + i, f"{i} " + "y" * (i % 50)) for i in range(3500)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    got = sharding.shard(df).collect()
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert len(size) == 8 and max(size.values()) - min(size.values()) <= 2 * 64
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got))) for s in range(8))


def test_lines(docs, none):
    got = line_dedup.without_repeats(docs).collect()
    assert Counter((r.doc_id, r.text) for r in got) == brute_lines(ids_and_texts())
    assert line_dedup.without_repeats(none).count() == 0


def test_lines_that_overlap_their_first_place(spark):
    line = " ".join(f"x{i}" for i in range(30))
    other = line.replace("x", "y")
    texts = ["\n".join([line] * 3), "\n".join([other] * 10), "\n".join([line, other] * 4), "head\n" + "\n".join([other] * 3)]
    got = line_dedup.without_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {0: "\n".join([line] * 2), 1: "\n".join([other] * 2), 2: "\n".join([line, other]), 3: "head"}
    assert Counter((r.doc_id, r.text) for r in got) == brute_lines(list(enumerate(texts)))
    rng = np.random.default_rng(11)
    kinds = [" ".join(["ab"[k % 2]] * (1 + k % 3)) + f" {k}" for k in range(5)] + ["", " "]
    many = [(i, "\n".join(kinds[k] for k in rng.integers(0, len(kinds) if i % 3 else 3, rng.integers(0, 12)))) for i in range(120)]
    df = spark.createDataFrame(many, "doc_id long, text string").repartition(7)
    for least in (4, 9, 16):
        assert Counter((r.doc_id, r.text) for r in line_dedup.without_repeats(df, least).collect()) == brute_lines(many, least)


def test_one_row_for_each_selected_place(spark):
    lines = [" ".join(f"{chr(97 + k % 26)}{k}-{j}" for j in range(6)) for k in range(400)]
    df = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string").selectExpr("*", "xxhash64(doc_id, text) AS row_hash")
    rows_ = line_dedup._places(df, 50).collect()
    spans = {(a.first, a.last) for r in rows_ for a in r.around}
    begin, end = line_dedup.windows(np.full(400, 6), 50)
    assert spans == set(zip(begin.tolist(), (end - 1).tolist(), strict=True)) and len(rows_) < len(spans) / 3
    assert not line_dedup.repeats(df, line_dedup.Tables(spark)).count()


def test_encoding(docs, none):
    t = Tokenizer.from_file(BYTE)
    expect = Counter()
    for doc, x in ids_and_texts():
        ids = t.encode(x or "", add_special_tokens=False).ids
        expect[doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    got = bpe_automaton.round_trip(docs, BYTE)
    assert Counter(map(tuple, got.collect())) == expect
    assert bpe_automaton.encode(docs.where("doc_id = 4"), BYTE).first().ids == t.encode("one two").ids
    assert bpe_automaton.round_trip(none, BYTE).count() == 0


def test_languages(spark, docs, none):
    en = [f"the {w} and the {w}s of this house were there when we came {i}" for i, w in enumerate(WORDS * 6)]
    de = [f"der {w} und die {w}en von diesem Haus waren da als wir kamen {i}" for i, w in enumerate(WORDS * 6)]
    df = spark.createDataFrame([(i, t, "en" if i < len(en) else "de") for i, t in enumerate(en + de)], "doc_id long, text string, lang string")
    m = language_id.learn(df.where(~language_id.held_out(df["doc_id"])))
    got = {r.doc_id: r for r in language_id.identify(df, m).collect()}
    held = [r for r in got.values() if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert all(r.lang_pred == ("en" if r.doc_id < len(en) else "de") and 0 <= r.score <= 1 for r in held)
    two = language_id.predict([" ".join(en[:20]) + " " + " ".join(de[:10])], m)[0]
    assert two[0] == "en" and two[2] == ["en", "de"] and 0.5 < two[1] < 0.8
    for r in language_id.identify(docs, m).collect():
        assert r.lang_pred in ("en", "de", "und") and (r.lang_pred != "und" or r.score == 0)
    assert language_id.predict([None, "", "12 !?"], m) == [("und", 0.0, [], [])] * 3
    assert language_id.identify(none, language_id.learn(none)).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, language_id.learn(none)).collect()} == {"und"}
    assert language_id.keep_identified(docs, m).schema == docs.schema


def test_any_number_of_languages_is_learned_and_scored_alike(spark, monkeypatch):
    rng = np.random.default_rng(2)
    vocab = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 4)) for _ in range(30)] for _ in range(90)]
    texts = [(k, " ".join(rng.choice(vocab[k], 60))) for k in range(90) for _ in range(3)]
    m = language_id.learn(spark.createDataFrame([(t, f"l{k:02d}") for k, t in texts], "text string, lang string"))
    assert len(m.languages) == 90
    mixed = [t for _, t in texts] + [texts[0][1] + " " + texts[30][1], None, "x"]
    for step in (language_id.SPARSE_STEP, 7):
        monkeypatch.setattr(language_id, "SPARSE_STEP", step)
        sparse = language_id.predict(mixed, m)
        assert all(x[0] == f"l{k:02d}" for x, (k, _) in zip(sparse, texts, strict=False)) and set(sparse[-3][2]) == {"l00", "l10"}
    monkeypatch.setattr(language_id, "DENSE", 100)
    dense = language_id.predict(mixed, m)
    assert [x[0] for x in dense] == [x[0] for x in sparse] and np.allclose([x[1] for x in dense], [x[1] for x in sparse], atol=1e-3)


def test_packing(docs, none):
    t = Tokenizer.from_file(WORD)
    got = packing.pack(docs, WORD).collect()
    expect = Counter()
    for doc, x in ids_and_texts():
        ids = t.encode(x or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expect[doc, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == expect
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) <= -(-sum(r.length for r in got) // 4096) + 2
    assert packing.pack(none, WORD).count() == 0


def test_word_ids_equal_the_library():
    with open(WORD, encoding="utf-8") as f:
        mine = packing.Tokens(f.read())
    t = Tokenizer.from_file(WORD)
    texts = ["Don't STOP, it's 3.14!!", "<|ENDOFTEXT|> <|endoftext|>, x<|endoftext|>.", "ÉÅ, Ünïcödé; İI ΑΣ a\xa0b　c", "x,y ,, .;a.b:c? ---", "don't,we'll.They've"]
    for ids, x in zip(mine([x.encode() for x in texts] * 2), texts * 2, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(x, add_special_tokens=False).ids


def test_near_duplicates(docs, none):
    got = near_dedup.near_groups(docs).drop("row_hash").collect()
    assert Counter(map(tuple, got)) == brute_components(ids_and_texts())
    assert near_dedup.near_groups(none).count() == 0
    kept = near_dedup.keep_one(docs)
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == {d for d, _, c in brute_components(ids_and_texts()) if d is not None and d == c}


def test_near_duplicates_of_varied_edits_with_frequent_shingles(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEAST", 4)
    monkeypatch.setattr(near_dedup, "LOCAL_LEAST", 2)
    monkeypatch.setattr(near_dedup, "OPEN_BLOCK", 3)
    rng = np.random.default_rng(7)
    texts = []
    for g in range(12):
        base = [f"g{g % 5}w{x}" for x in rng.integers(0, 40, rng.integers(6, 90))]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.integers(0, 5)):
                w[rng.integers(0, len(w))] = f"edit{rng.integers(0, 6)}"
            texts.append(" ".join(w[: len(w) - rng.integers(0, 3)]))
    pairs = list(enumerate(texts))
    got = near_dedup.near_groups(spark.createDataFrame(pairs, "doc_id long, text string")).drop("row_hash").collect()
    assert Counter(map(tuple, got)) == brute_components(pairs)
    assert len({r.component_id for r in got}) < len(got)


def test_exact_of_texts_in_pieces(spark, monkeypatch):
    from pyspark.sql import functions as F

    base = " ".join(f"w{i % 7919}x{i}" for i in range(300_000))
    assert len(base) > 10 * exact_dedup.PIECE
    at = exact_dedup.PIECE
    texts = [base, base.replace(" ", "\n\t ", 60_000), base[:at] + ("  " if base[at - 1] == " " else "") + base[at:], base[:-1] + "#", base, "short", base + " ", base + " \n", None]
    pairs = [*enumerate(texts), (0, base), (0, base), (None, base)]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()
    groups = defaultdict(list)
    for d, t in pairs:
        groups[norm(t)].append(d)

    def check(got):
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter((d, min(x for x in groups[norm(t)] if x is not None), len(groups[norm(t)]), hashlib.sha256(norm(t)).hexdigest()) for d, t in pairs)
        assert Counter(r.text_sha256 for r in got if r.kept) == Counter(hashlib.sha256(t).hexdigest() for t in groups) and all(r.doc_id == r.keep_id for r in got if r.kept)

    check(exact_dedup.exact_groups(df).collect())
    # Small exchanges are merged into one task; with that off, the pieces of one text lie in several.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tasks = exact_dedup.pieces(df).repartition("rid", "pos").where("doc_id = 3").select(F.spark_partition_id()).distinct().count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 1
    rng = np.random.default_rng(3)
    small = ["".join(rng.choice(list("ab \n\t"), rng.integers(0, 60))) for _ in range(150)]
    pairs = [(i, t) for i, t in enumerate([*small, *[t.replace(" ", " \n") for t in small], " " * 50, " " * 99, "ab " * 30])]
    groups = defaultdict(list)
    for d, t in pairs:
        groups[norm(t)].append(d)
    monkeypatch.setattr(exact_dedup, "HUGE", 20)
    monkeypatch.setattr(exact_dedup, "PIECE", 7)
    check(exact_dedup.exact_groups(spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)).collect())
    for t in small:
        data, whole = t.encode(), exact_dedup.Part(0, 0, False, False)
        for i in range(0, len(data), 5):
            whole = exact_dedup.joined(whole, exact_dedup.part_of(data[i : i + 5]))
        assert whole.packed()[:24] == exact_dedup.fingerprint(exact_dedup.normalised(data))


def test_exact(docs, none):
    norm = lambda t: (b" " if t[:1].isspace() else b"") + b" ".join(t.split()) + (b" " if t[-1:].isspace() and t.split() else b"")
    pairs = [(d, norm((t or "").encode())) for d, t in ids_and_texts()]
    got = exact_dedup.exact_groups(docs).collect()
    groups = defaultdict(list)
    for d, t in pairs:
        groups[hashlib.sha256(t).hexdigest()].append(d)
    assert Counter((r.doc_id, r.text_sha256) for r in got) == Counter((d, hashlib.sha256(t).hexdigest()) for d, t in pairs)
    for r in got:
        g = groups[r.text_sha256]
        assert r.group_size == len(g) and r.keep_id == min((x for x in g if x is not None), default=None)
    assert all(sum(r.kept for r in got if r.text_sha256 == h) == 1 for h in groups)
    assert exact_dedup.exact_groups(none).count() == 0
    kept = exact_dedup.keep_first(docs)
    assert kept.schema == docs.schema and kept.count() == len(groups)


def test_fingerprints_compose_and_collisions_are_told_apart(docs, monkeypatch):
    data = LONG.encode()
    h, at = 0, 0
    for n in (1, 8191, 8192, 8193, len(data)):
        part = data[at : at + n]
        h = exact_dedup.combine(h, exact_dedup.chunk_hash(part), len(part))
        at += n
    assert exact_dedup.fingerprint(data)[:16] == h.to_bytes(16, "big") == (int.from_bytes(data, "big") % exact_dedup.PRIME).to_bytes(16, "big")
    right = {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.exact_groups(docs).collect()}
    from pyspark.sql import functions as F

    real, real_texts = exact_dedup.fingerprints, exact_dedup._texts
    monkeypatch.setattr(exact_dedup, "fingerprints", lambda *a: real(*a).withColumn("fp", F.lit(b"x").cast("binary")))
    monkeypatch.setattr(exact_dedup, "_texts", lambda *a: real_texts(*a).withColumn("fp", F.lit(b"x").cast("binary")))
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in exact_dedup.exact_groups(docs).collect()} == right


PAGES = "page_id long, url string, html string, host string, salt int"


def test_pages(spark):
    nav = "<nav><ul><li>Home</li><li>About</li></ul></nav>"
    page = lambda body: f"<html><head><title>t</title><script>if (a<b) '</p>'</script></head><body>{nav}{body}<footer>&copy; x</footer></body></html>"
    shared = "<div>this very long line of boilerplate words stands on every page of the host</div>"
    data = [
        (1, "http://a.b/1", page("<article><h1>Title &amp; more</h1><p>One   two<p>three<br>four<div class='ad'>buy</div><form>f</form><div id=comments><p>no</p></div></article>"), "x", 1),
        (2, None, None, None, None),
        (3, "http://a.b/3", "", "x", 1),
        *[(10 + i, f"http://plain.org/{i}", f"<body>{shared}<p>unique text number {i} with its own words w{i}a w{i}b w{i}c w{i}d w{i}e</p>", "x", 1) for i in range(5)],
        (20, "http://a.b/4", page("<main>kept <b>bold</b> text<aside>side</aside></main><p>outside</p>"), "x", 1),
        (21, "http://a.b/4", "<p>open <b>tags<p>twice</b></p></p></div> 5 &lt; 6 &#x41;", "x", 1),
    ]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(data, PAGES)).collect()}
    assert got[1].text == "Title & more\nOne two\nthree\nfour"
    assert got[2].text == got[3].text == "" and got[2].n_chars == 0
    assert all(got[10 + i].text.startswith("unique text number") and "\n" not in got[10 + i].text for i in range(5))
    assert got[20].text == "kept bold text" and got[21].text == "open tags\ntwice\n5 < 6 A" and got[1].n_chars == len(got[1].text)
    assert html_text.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_boilerplate_inside_marked_articles_goes_and_copied_articles_stay(spark):
    own = lambda i, n=40: " ".join(f"w{i}x{k}" for k in range(n))
    notice = "<p>please read these terms of use with care before you go on to read more</p>"
    page = lambda i, body: (i, "http://marked.org/", f"<body><article>{body}</article></body>", None, None)
    near = [own(99).replace("w99x7 ", f"edit{i} ") for i in range(4)]
    data = [page(i, f"<p>{own(i)}</p>{notice}") for i in range(5)]
    data += [page(10 + i, f"<p>{own(50)}</p>") for i in range(4)] + [page(20 + i, f"<p>{x}</p>{notice}") for i, x in enumerate(near)]
    data += [(30 + i, "http://plain.net/", f"<p>{own(60)}</p>", None, None) for i in range(4)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(data, PAGES)).collect()}
    assert got == {**{i: own(i) for i in range(5)}, **{10 + i: own(50) for i in range(4)}, **{20 + i: x for i, x in enumerate(near)}, **{30 + i: own(60) for i in range(4)}}


def test_a_notice_goes_wherever_its_pages_lie(spark, monkeypatch):
    monkeypatch.setattr(html_text, "GROUP_PAGES", 16)
    monkeypatch.setattr(html_text, "LEAST_PART", 64)
    notice = "<p>we take great care of what you read here and thank all who help us</p>"
    body = lambda i: f"<p>{' '.join(f'w{i}x{j}' for j in range(30))}</p><p>{' '.join(f'v{i}x{j}' for j in range(20))}</p>"
    many = [(i, "http://a.org/" + str(i), f"<html><body>{body(i)}{notice if i in (7, 150, 280) else ''}</body></html>") for i in range(300)]
    few = [(1000 + i, "http://b.org/", f"<article>{body(5000 + i)}{notice if i < 2 else ''}</article>") for i in range(4)]
    copies = [(2000 + i, "http://c.org/", f"<article>{body(9000)}</article>") for i in range(40)]
    got = []
    for parts in (1, 7):
        df = spark.createDataFrame(many + few + copies, "page_id long, url string, html string").repartition(parts)
        got.append({r.page_id: r.text for r in html_text.extract(df).collect()})
    assert got[0] == got[1] and len(got[0]) == 344
    assert not any("great care" in got[0][i] for i in (7, 150, 280)) and sum("great care" in x for x in got[0].values()) == 2
    assert all(got[0][i].split("\n")[0].startswith(f"w{i}x0 ") and got[0][i].count("\n") == 1 for i in range(300))
    assert len({got[0][2000 + i] for i in range(40)}) == 1 and got[0][2000].startswith("w9000x0")


def test_passages_inside_differing_blocks_go_wherever_their_pages_lie(spark, monkeypatch):
    monkeypatch.setattr(html_text, "GROUP_PAGES", 16)
    monkeypatch.setattr(html_text, "LEAST_PART", 64)
    words = lambda tag, i, n: " ".join(f"{tag}{i}x{j}" for j in range(n))
    passage = words("shared", 0, 40)
    data = [(i, "http://a.org/", f"<p>{words('w', i, 60)}</p>" + (f"<p>{words('v', i, 5)} {passage} {words('u', i, 5)}</p>" if i in (7, 150, 280) else "")) for i in range(300)]
    data += [(1000 + i, "http://b.org/", f"<p>{words('w', i, 60)}</p><p>{words('v', i, 5)} {passage}</p>") for i in range(2)]
    for parts in (1, 7):
        got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(data, "page_id long, url string, html string").repartition(parts)).collect()}
        assert got == {**{i: words("w", i, 60) for i in range(300)}, **{1000 + i: f"{words('w', i, 60)}\n{words('v', i, 5)} {passage}" for i in range(2)}}


def test_main_texts_by_brute_force_over_whole_hosts(spark, monkeypatch):
    rng = np.random.default_rng(11)
    passages = [" ".join(f"p{k}y{j}" for j in range(int(rng.integers(8, 30)))) for k in range(60)]
    own = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    data = []
    for i in range(400):
        some = [passages[k] for k in rng.integers(0, 60, rng.integers(0, 4))]
        html = "".join(f"<p>{own(f'{i}b{k}', int(rng.integers(0, 12)))} {x} {own(f'{i}c{k}', int(rng.integers(0, 6)))}</p>" for k, x in enumerate(some)) + f"<p>{own(i if i % 5 else i % 50, int(rng.integers(0, 30)))}</p>"
        data.append((i, f"http://h{i % 3 and 1}.org/{i}", f"<nav>{passages[i % 60]}</nav><article>{html}</article>" if i % 4 == 0 else html))
    data += [(400 + i, "http://h1.org/", data[i % 7][2]) for i in range(30)]

    def brute(htmls):
        pages = [html_text.blocks_of(h) for h in htmls]
        fits = [html_text.in_question(b) for b in pages]
        contents = [tuple(b.text for b, f in zip(p, fit) if f) for p, fit in zip(pages, fits)]
        tokens = [[(w, f, k) for k, (b, f) in enumerate(zip(p, fit)) for w in (f"<{b.never:d}{b.main:d}>", *b.text.split())] for p, fit in zip(pages, fits)]
        runs = [[tuple(w for w, _, _ in t[k : k + 8]) for k in range(len(t) - 7)] for t in tokens]

        def covered(on):
            places = defaultdict(set)
            for r, c, o in zip(runs, contents, on):
                for x in r if o else ():
                    places[x].add(c)
            return [[any(len(places[x]) >= 3 for x in r[max(0, k - 7) : k + 1]) for k in range(len(t))] for r, t in zip(runs, tokens)]

        first = covered([True] * len(pages))
        fit = [sum(f for _, f, _ in t) for t in tokens]
        free = [sum(f and not c for (_, f, _), c in zip(t, cover)) for t, cover in zip(tokens, first)]
        last = covered([n > 0 and m >= 0.2 * n for n, m in zip(fit, free)])

        def stays(t, cover, k):
            own = [c for (_, _, x), c in zip(t, cover) if x == k]
            return sum(own) < 0.7 * len(own)

        return ["\n".join(b.text for k, (b, f) in enumerate(zip(p, fit)) if f and stays(t, cover, k)) for p, fit, t, cover in zip(pages, fits, tokens, last)]

    expect = {}
    for url in ("http://h0", "http://h1"):
        mine = [(i, h) for i, u, h in data if u.startswith(url)]
        expect |= dict(zip([i for i, _ in mine], brute([h for _, h in mine])))
    for pages, parts in ((8, 5), (512, 3), (1, 2)):
        monkeypatch.setattr(html_text, "GROUP_PAGES", pages)
        monkeypatch.setattr(html_text, "LEAST_PART", 8 * pages)
        df = spark.createDataFrame(data, "page_id long, url string, html string").repartition(parts)
        assert {r.page_id: r.text for r in html_text.extract(df).collect()} == expect


def test_numbers_coded_by_gaps():
    rng = np.random.default_rng(5)
    for n, most in ((0, 10), (1, 1 << 63), (1000, 1000), (1000, 1 << 20), (500, 1 << 44), (300, 1 << 63)):
        x = np.unique(rng.integers(0, most, n).astype(np.uint64))
        assert html_text.decoded(html_text.coded(x)).tolist() == x.tolist()


def test_repeated_runs_by_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        pages = [rng.integers(0, 4, rng.integers(0, 40)).tolist() for _ in range(6)]
        tokens, page = np.array(sum(pages, []), np.int64), np.repeat(np.arange(6), [len(p) for p in pages])
        got = html_text.repeated(tokens, page, run=5, pages=3)
        places = defaultdict(set)
        for i, p in enumerate(pages):
            for k in range(len(p) - 4):
                places[tuple(p[k : k + 5])].add(i)
        expect = [any(len(places[tuple(p[k : k + 5])]) >= 3 for k in range(max(0, at - 4), min(at, len(p) - 5) + 1)) for p in pages for at in range(len(p))]
        assert got.tolist() == expect


def test_urls(spark):
    data = [
        (1, "http://x.com", "com", "allow"), (2, "HTTP://WWW.Example.COM/en/a?b#c", "www.example.com/en/", "allow"), (3, "http://m.example.com/en/", "example.com/en/", "block"),
        (4, "https://a.net/es/1", "net/es/", "block"), (5, "https://casino-win.org/", None, "block"), (6, "https://casinos.org/", None, "allow"), (7, "http://free.org/bets", None, "block"),
        (8, "http://free-free.org/", None, "allow"), (9, None, None, "allow"), (10, "no scheme adult", None, "allow"), (11, "http://net/fr/", "net/fr/", "block"), (12, "http://botnet/fr/", None, "allow"), (13, "", None, "allow"),
        (14, "http://x.org/s?q=PORN", None, "block"), (15, "http://x.org/#casino", None, "block"), (16, "http://x.org?free#bet", None, "block"), (17, "http://x.org/?q=popcorn&ad=free", None, "allow"),
        (18, "http://x.com/?q=porn", "com/", "allow"), (19, "http://y.org/" + "a/" * 200_000 + "?xxx", None, "block"), (20, "http://y.org/" + "a/" * 200_000, None, "allow"),
    ]
    df = spark.createDataFrame([(i, u, "h", "p", "r") for i, u, _, _ in data], "page_id long, url string, host string, path string, rule string")
    got = {r.page_id: r for r in url_filter.judge_urls(df).collect()}
    for i, _, rule, verdict in data:
        assert got[i].verdict == verdict and (got[i].rule == rule or i == 1), i
    assert (got[2].host, got[2].path) == ("www.example.com", "/en/a") and got[1].rule is None and got[9].host == got[9].path == ""
    assert url_filter.judge_urls(df.where("false")).count() == 0
    import duckdb

    pages = df.toPandas()  # noqa: F841
    assert Counter(duckdb.sql(url_filter.oracle()).fetchall()) == Counter(map(tuple, got.values()))


def test_vocabularies_are_read_with_weights(spark, tmp_path):
    (tmp_path / "v.txt").write_text("# terms\nBad\tstrict\nfree\tsoft\nwin\tsoft\t2\n\nbet\tsoft\n")
    strict, soft, weights = url_filter.read_vocabulary(spark, str(tmp_path / "v.txt"))
    assert strict == ("bad",) and soft == ("free", "win", "bet") and weights == (("win", 2),)
    spec = url_filter.UrlFilter(strict=strict, soft=soft, weights=weights, soft_weight=3)
    df = spark.createDataFrame([(1, "http://a.org/bad"), (2, "http://a.org/free/bet"), (3, "http://a.org/free/win"), (4, "http://a.org/win/win"), (5, "http://a.org/freewin")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(df, spec).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "allow", 5: "allow"}
    import duckdb

    pages = df.toPandas()  # noqa: F841
    assert {r[0]: r[4] for r in duckdb.sql(url_filter.oracle(spec)).fetchall()} == got
    (tmp_path / "w.txt").write_text("x\tmaybe\n")
    with pytest.raises(ValueError):
        url_filter.read_vocabulary(spark, str(tmp_path / "w.txt"))


def test_models_keep_every_character_and_language(spark):
    letters = [chr(0x4E00 + i) for i in range(300)]
    rng = np.random.default_rng(5)
    texts = ["".join(letters[i] for i in rng.integers(0, 300, 400)) for _ in range(12)]
    rows_ = [(i, t, "zh") for i, t in enumerate(texts)] + [(100 + i, " ".join(WORDS), f"l{i:02}") for i in range(20)]
    m = quality.train(spark.createDataFrame(rows_, "doc_id long, text string, lang string"))
    assert len(m.entropy) == 21
    t = m.table.where("name = 'zh'").toPandas()
    assert set(t[(t["size"] == 1) & t.log_p.notna()].code) == {0, *map(ord, set("".join(texts)))}
    s = quality.Slice(*(t[c].to_numpy() for c in ("size", "code", "log_p")), np.nan_to_num(t.log_back.to_numpy()), m.unseen["zh"])
    symbols = np.array(sorted(t[(t["size"] == 1) & t.log_p.notna()].code) + [ord("q")])
    for x, y in [(texts[0][4], texts[0][5]), (texts[3][0], "q"), ("q", texts[3][0]), ("\0", texts[7][0])]:
        p = np.exp(s.log_prob(ord(x) << 2 * quality.BITS | ord(y) << quality.BITS | symbols))
        assert abs(p.sum() - 1) < 1e-3
    assert {r.model for r in quality.score(spark.createDataFrame(rows_, "doc_id long, text string, lang string"), m).collect()} == set(m.entropy)


def test_bands_follow_the_scores(spark):
    rng = np.random.default_rng(11)
    fields = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, model string, log_perplexity double, text_hash long"
    clean = [(1.6 + s * x, n) for s, n in ((0.02, 4000), (0.005, 60000)) for x in rng.standard_normal(1000)]
    junk = [(1.6 + sign * d, n) for d, n in ((0.085, 4000), (0.04, 60000)) for sign in (-1, 1) for _ in range(30)]
    data = [(i, 500, n, 0, 0, 0, "en", float(x), i) for i, (x, n) in enumerate(clean + junk)]
    scores = spark.createDataFrame(data, fields)
    kept = {r.doc_id for r in quality.verdicts(scores, quality.bands(scores)).collect() if r.kept}
    assert not any(i in kept for i in range(len(clean), len(data)))
    assert sum(i in kept for i in range(len(clean))) >= 0.98 * len(clean)
    scores = scores.where(f"doc_id < {len(clean)}")
    assert quality.verdicts(scores, quality.bands(scores)).where("kept").count() >= 0.99 * len(clean)
