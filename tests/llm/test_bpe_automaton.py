import public_tokenizers
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bucketloom.llm.bpe_automaton import Automaton, Codec

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def pair():
    with open(PATH, encoding="utf-8") as f:
        return Codec(f.read()), Tokenizer.from_file(PATH)


def same(pair, text):
    codec, library = pair
    import numpy as np

    ids = library.encode(text, add_special_tokens=False).ids
    packed = codec.encode(text.encode())
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert codec.decode(packed).decode() == library.decode(ids, skip_special_tokens=False)


TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 'abstrevmldxyzéßñ019.,-!<|>漢字🙂"), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXT)
@example("")
@example("a<|endoftext|>b  <|endoftext|>")
@example("foo\n  bar\xa0 baz \xa0\n x  ")
@example("a" * 5000)
@example("ab" * 300 + " they'll we've I'D")
def test_same_as_the_library(pair, text):
    same(pair, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["the", "ing", "tion", "aa", "aaa", "er", "ou", "é", "=", "--", "0", "10"]), max_size=30).map("".join))
def test_words_of_common_pieces(pair, text):
    same(pair, text)


def merge_by_rank(word, merges):
    """Plain BPE: the lowest rank first, leftmost first."""
    parts = list(word)
    rank = {(a, b): (i, c) for i, (a, b, c) in enumerate(merges)}
    while True:
        found = min(((rank[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank), default=None)
        if found is None:
            return parts
        a, b, c = merges[found[0]]
        out, i = [], 0
        while i < len(parts):
            if i + 1 < len(parts) and (parts[i], parts[i + 1]) == (a, b):
                out.append(c)
                i += 2
            else:
                out.append(parts[i])
                i += 1
        parts = out


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_random_merges_by_brute_force(data):
    labels = {0: b"a", 1: b"b", 2: b"c"}
    merges = []
    for _ in range(data.draw(st.integers(0, 8))):
        a, b = data.draw(st.sampled_from(sorted(labels))), data.draw(st.sampled_from(sorted(labels)))
        if labels[a] + labels[b] in labels.values():
            continue
        # A merge is usable only if its own label is tokenized as the pair it merges.
        if merge_by_rank([b"abc".index(x) for x in labels[a] + labels[b]], merges) != [a, b]:
            continue
        c = len(labels)
        labels[c] = labels[a] + labels[b]
        merges.append((a, b, c))
    machine = Automaton(labels, merges)
    for word in data.draw(st.lists(st.text("abc", min_size=1, max_size=14), max_size=10)):
        assert machine.encode(word.encode()) == merge_by_rank([b"abc".index(x) for x in word.encode()], merges)
