"""Operator 4: byte-level BPE by a deterministic tokenization automaton.

The automaton reads tokens and accepts exactly the right tokenizations. It starts as one state per byte, each
followed by any byte. The merges are applied to it one after another as gadgets: the merge a + b -> c

* makes a state for c, a copy of b's state as it is at that moment,
* adds an arc c wherever an arc a leads into a state from which b goes on,
* takes the arc b out of a's state.

Copies are kept as references (state, time), so a merge costs constant room: an arc's presence is looked up by
walking back through the gadgets that made its state and its label, and the answers fill a table of arcs by
(state, label). A word is encoded by following arcs from each reached position: every prefix of a word has
one right tokenization, so every position is reached by one arc only. No rank is compared while encoding, and
a word of n bytes takes O(n) arcs, however long. Decoding emits the labels of the arcs.

Words are cut by the tokenizer's split pattern before encoding; their ids are kept in a bounded table per
worker, since most words come again.

Defined results: null text is empty text and has no ids; repeated rows give repeated results; an empty table
gives an empty result; other columns, of any name, are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from bucketloom.llm.common import Recent, kept, map_batches, only, texts_of

#: Entries of each generation of a worker's table of words, and of its table of arcs, which then starts anew.
WORDS, ARCS = 400_000, 1_000_000

#: The split pattern of byte-level vocabularies, with white space as Unicode defines it (a fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: White space that isn't ASCII's, after which a text can't be cut at ASCII white space.
_ODD_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Stretches that no word of SPLIT reaches over, and one's letters and the punctuation after them, which it always parts.
_UNIT = re.compile(rb"[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
_STEM = re.compile(rb"([\x20\x09-\x0d]*[A-Za-z\x80-\xff]*[A-Za-z])([,.;:!?|%&*#$]+)")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """States and labels are token ids; ``arc(p, c)`` tells whether c may follow p."""

    def __init__(self, labels: dict[int, bytes], merges: Iterable[tuple[int, int, int]]):
        self.labels = labels
        size = max(labels, default=-1) + 1
        self.left, self.right, self.born = [-1] * size, [-1] * size, [0] * size
        self.merged: dict[tuple[int, int], int] = {}
        for time, (a, b, c) in enumerate(merges, 1):
            self._gadget(a, b, c, time)
        self.arcs: dict[tuple[int, int], bool] = {}
        #: Every prefix of a label, with the token that it is or -1.
        self.prefixes: dict[bytes, int] = {}
        for label in labels.values():
            for i in range(1, len(label)):
                self.prefixes.setdefault(label[:i], -1)
        for t, label in labels.items():
            self.prefixes[label] = t

    def _gadget(self, a: int, b: int, c: int, time: int) -> None:
        if self.born[c]:
            raise ValueError(f"two merges make token {c}")
        self.born[c], self.left[c], self.right[c] = time, a, b
        self.merged[a, b] = time

    def arc(self, p: int, c: int) -> bool:
        key = (p, c)
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            found = self.arcs[key] = self._arc(p, c)
        return found

    def _arc(self, p: int, c: int) -> bool:
        born, merged, until = self.born, self.merged, 2 * len(self.merged) + 2
        while True:
            cut = merged.get((p, c))
            if cut is not None and 2 * cut <= until:
                return False
            kp, kc = born[p], born[c]
            if kp == kc:
                if not kp:
                    return True
                p, c, until = self.right[p], self.left[c], 2 * kp - 1  # c after itself
            elif kp > kc:
                p, until = self.right[p], 2 * kp - 1  # the state was copied before its gadget cut an arc
            else:
                c, until = self.left[c], 2 * kc + 1  # the arc was added after its gadget cut one

    def encode(self, word: bytes) -> list[int]:
        """The labels of the one path of arcs that spells the word.

        From each position the longest label that an arc allows is followed first. A position is only ever
        reached by the right tokenization of what lies before it, so one that leads nowhere is never tried again.
        """
        n, prefixes, arc = len(word), self.prefixes, self.arc
        path: list[int] = []
        at: list[int] = []  # where each label of the path begins
        dead: set[int] = set()
        i = 0
        while i < n:
            found, stop, shorter = -1, i, []
            for j in range(i + 1, n + 1):
                t = prefixes.get(word[i:j])
                if t is None:
                    break
                if t >= 0 and j not in dead:
                    if found >= 0:
                        shorter.append((found, stop))
                    found, stop = t, j
            if found >= 0 and path:
                p = path[-1]
                while not arc(p, found):
                    if not shorter:
                        found = -1
                        break
                    found, stop = shorter.pop()
            if found >= 0:
                path.append(found)
                at.append(i)
                i = stop
            else:
                dead.add(i)
                path.pop()
                i = at.pop()
        return path


class Codec:
    """A vocabulary file's automaton, split and special tokens."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        symbols, vocab = byte_symbols(), spec["model"]["vocab"]
        plain = {t: bytes(symbols[ch] for ch in s) for s, t in vocab.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.automaton = Automaton(plain, ((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.labels = plain | {t: s.encode() for s, t in self.special.items()}
        self.by_id = [self.labels.get(i, b"") for i in range(max(self.labels) + 1)]
        self.split = regex.compile(SPLIT)
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words, self.stems = Recent(WORDS), Recent(WORDS)

    def _unit(self, unit: bytes) -> bytes:
        """Packed ids of a stretch of text that no word reaches over."""
        m = _STEM.fullmatch(unit)
        found = b"".join(map(self._stem, m.groups())) if m else self._stem(unit)
        if len(unit) <= 64:
            self.words.put(unit, found)
        return found

    def _stem(self, unit: bytes) -> bytes:
        found = self.stems.get(unit)
        if found is None:
            ids = [t for w in self.split.findall(unit.decode()) for t in self.automaton.encode(w.encode())]
            found = struct.pack(f"<{len(ids)}I", *ids)
            if len(unit) <= 64:
                self.stems.put(unit, found)
        return found

    def _ordinary(self, text: bytes) -> bytes:
        if not text:
            return b""
        if not text.isascii() and _ODD_SPACE.search(text.decode()):
            return self._unit(text)
        units = _UNIT.findall(text)
        found = list(map(self.words.young.get, units))
        if None in found:
            for i, x in enumerate(found):
                if x is None:
                    found[i] = self.words.get(units[i]) or self._unit(units[i])
        return b"".join(found)

    def encode(self, text: bytes) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.specials and any(s.encode() in text for s in self.special):
            parts = self.specials.split(text.decode())
            return b"".join(struct.pack("<I", self.special[p]) if p in self.special else self._ordinary(p.encode()) for p in parts)
        return self._ordinary(text)

    def decode(self, ids: bytes) -> bytes:
        """Labels of the arcs, put together; what isn't UTF-8 shows as replacement characters."""
        out = b"".join(map(self.by_id.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        try:
            out.decode()
        except UnicodeDecodeError:
            return out.decode("utf-8", "replace").encode()
        return out


def codec(vocabulary: str) -> Codec:
    """One per worker and vocabulary, kept between tasks."""
    return kept(lambda: Codec(vocabulary), hashlib.sha256(vocabulary.encode()).hexdigest())


def _coded(docs: DataFrame, vocabulary_path: str, doc_id: str, text: str, fields: str, row) -> DataFrame:
    """``vocabulary_path`` is read on the driver and broadcast: a vocabulary file's size doesn't depend on the data."""
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    df = only(docs, doc_id=doc_id, text=text)
    kind = df.schema["doc_id"].dataType.simpleString()

    def make():
        c = codec(vocabulary.value)

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            cols = row(c, texts_of(b.column("text")))
            return pa.RecordBatch.from_arrays([b.column("doc_id"), *cols.values()], names=["doc_id", *cols])

        return f

    return map_batches(df, make, f"doc_id {kind}, {fields}")


def encode(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every row."""

    def row(c: Codec, texts: list[bytes]) -> dict[str, pa.Array]:
        packed = [c.encode(x) for x in texts]
        at = np.concatenate([[0], np.cumsum([len(x) // 4 for x in packed])]).astype(np.int32)
        flat = pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32))
        return {"ids": pa.ListArray.from_arrays(pa.array(at), flat)}

    return _coded(docs, vocabulary_path, doc_id, text, "ids array<int>", row)


def round_trip(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes every whole text."""

    def row(c: Codec, texts: list[bytes]) -> dict[str, pa.Array]:
        packed = [c.encode(x) for x in texts]
        return {
            "n_tokens": pa.array([len(x) // 4 for x in packed], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in packed], pa.string()),
        }

    return _coded(docs, vocabulary_path, doc_id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", row)
