"""Operator 8: main text of web pages, with boilerplate found by suffix arrays over a host's pages.

A page becomes a stream of tokens: the words of its text and the marks of its elements. Pages of one host are put together in
groups of at most GROUP_PAGES pages and GROUP_TOKENS tokens, whose suffix array, sorted by prefix doubling to MIN_RUN tokens, shows
every run of MIN_RUN tokens and the distinct contents it stands on; longer repeats are chains of such runs.
Groups only share out the work: every run is counted over its whole host, however many groups that has, so results are those of one suffix array over
all the host's pages. This goes in three exchanges of what groups found, never of the pages, which are read, dealt out and held as compressed packs:
a compressed set of each partition's runs by SLOTS hash places a token, which tells the places that may reach MIN_PAGES contents (contents are only ever counted too high
here, so none is missed); then the runs at these places by their 64-bit hashes, with their contents, at most MIN_PAGES a run and partition, which decides; then the same
over pages with text of their own.
Whole articles recur too, as copies and edited copies. So runs are counted once more over the pages alone that have text of their own,
OWN of their text outside such runs: a run on MIN_PAGES of these is boilerplate wherever it stands, while runs that only ever
recur together with the rest of their page are a copied article. A block that boilerplate covers to COVERED of its tokens
goes, on pages with and without a marked article.

An exact check on the markup follows: blocks of elements that never hold main text (menus, headers, footers, asides, forms, scripts,
styles, and elements whose class or id says notice, advert, comment and so on) go, and where a page marks its
article (``article``, ``main``), the blocks outside go.

Blocks are parted by block-level tags and ``br``. Character references are decoded, white space inside a block becomes one space.

A host with more than 1/MOST_HOT of the pages or bytes is dealt out in packs of its pages, so there are few such hosts; results don't depend on
how rows arrive.

Defined results: null html is empty, and gives an empty text. A null url's pages are a host of their own. Tags left open, or closed
twice, change nothing but nesting. Repeated rows get equal results. An empty table gives an empty
result. Other columns, of any name, are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bucketloom.llm.common import bounded, in_worker, only

MIN_RUN, MIN_PAGES, COVERED = 8, 3, 0.7
#: A page has a text of its own where this share of its text is outside runs that recur.
OWN = 0.2
GROUP_PAGES, GROUP_TOKENS = 512, 1 << 20
#: Hosts with more than this share of the pages, and of more pages than a part has at least, are dealt out in parts; likewise by bytes of html, with PART_BYTES, a partition's.
MOST_HOT, LEAST_PART, PART_BYTES = 4096, 256, 32 << 20
#: Characters of text in a pack of one host's pages, and in all that a task holds before it hands packs on.
PACK_CHARS, HELD_CHARS = 2 << 20, 16 << 20
#: Places a token in the first exchange.
SLOTS = 8

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
NEVER = frozenset("head nav header footer aside form menu dialog button select option datalist fieldset legend label".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
#: In a class, an id or a role: words that name what isn't main text.
NOT_MAIN = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adv|banner|sponsor\w*|promo\w*|comments?|commentlist|reply|replies|respond|disqus|cookie\w*|consent|gdpr|notice\w*|"
    r"alert|popup|modal|overlay|newsletter|subscribe|signup|sidebar|side|widget\w*|related|recommend\w*|share|sharing|social|breadcrumbs?|pagination|pager|"
    r"menu\w*|nav|navbar|navigation|header|masthead|footer|copyright|login|search\w*|tags?|toc|skip\w*|toolbar|contentinfo|complementary)(?:$|[\s_-])",
    re.I,
)
MAIN = frozenset(("article", "main"))

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_RAW_END = {x: re.compile(rf"</{x}\s*>", re.I) for x in RAW}


@dataclass
class Block:
    text: str
    #: Inside an element that never holds main text.
    never: bool
    #: Inside an article or main element.
    main: bool


def blocks_of(html: str | None) -> list[Block]:
    """The page's blocks of text in order, none empty."""
    out: list[Block] = []
    stack: list[tuple[str, bool, bool]] = []
    words: list[str] = []
    state = (False, False)

    def close() -> None:
        if words:
            text = " ".join(entities.unescape("".join(words)).split())
            words.clear()
            if text:
                out.append(Block(text, *state))

    source, at, n = html or "", 0, len(html or "")
    while at < n:
        m = _TAG.search(source, at)
        if m is None:
            words.append(source[at:])
            break
        words.append(source[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if any(x[0] == name for x in stack):
                close() if name in BLOCKS else None
                while stack.pop()[0] != name:
                    pass
                new = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                if new != state:
                    close()
                    state = new
            elif name in BLOCKS:
                close()
            continue
        if name in BLOCKS:
            close()
        if name in VOID or m[3].endswith("/") and name not in BLOCKS and name not in RAW:
            continue
        if name in RAW:
            end = _RAW_END[name].search(source, at)
            at = end.end() if end else n
            continue
        if name == "p" or name == "li":  # these end where the next begins
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    state = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                    break
                if stack[i][0] in BLOCKS and stack[i][0] not in ("p", "li"):
                    break
        attributes = m[3]
        never = state[0] or name in NEVER or (name not in ("html", "body") and attributes != "" and (any(NOT_MAIN.search(v.strip("\"'")) for v in _NAMED.findall(attributes)) or bool(_HIDDEN.search(attributes))))
        new = (never, state[1] or name in MAIN)
        if new != state:
            close()
            state = new
        stack.append((name, *new))
    close()
    return out


def run_ranks(tokens: np.ndarray, page: np.ndarray, run: int = MIN_RUN) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of ``run`` tokens begin (none reaches over pages), and a number of each, equal for equal runs.

    Prefix doubling: suffixes are told apart by 1, 2, 4, ... tokens until ``run``; those that one step tells from all others aren't sorted again.
    """
    n = len(tokens)
    if n < run:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    depth = 1
    while depth < run:
        step = min(depth, run - depth)
        behind = np.zeros(n, np.int64)
        behind[: n - step] = rank[step:]
        times = np.bincount(rank)
        again = np.flatnonzero(times[rank] > 1)  # what stands once already stays apart from all else
        rank[again] = len(times) + np.unique(rank[again] * len(times) + behind[again], return_inverse=True)[1]
        depth += step
    at = np.flatnonzero(page[: n - run + 1] == page[run - 1 :])
    return at, rank[at]


def recurring(rank: np.ndarray, content: np.ndarray, pages: int = MIN_PAGES) -> np.ndarray:
    """The ranks that stand in ``pages`` distinct contents, sorted."""
    if not len(rank):
        return rank
    order = np.lexsort((content, rank))
    r, c = rank[order], content[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
    found, n = np.unique(r[new], return_counts=True)
    return found[n >= pages]


def cover(n: int, begin: np.ndarray, run: int = MIN_RUN) -> np.ndarray:
    """Which of ``n`` tokens are in a run that begins at ``begin``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + run, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated(tokens: np.ndarray, page: np.ndarray, run: int = MIN_RUN, pages: int = MIN_PAGES) -> np.ndarray:
    """Which tokens are in a run of ``run`` tokens that occurs on ``pages`` distinct pages."""
    at, rank = run_ranks(tokens, page, run)
    return cover(len(tokens), at[np.isin(rank, recurring(rank, page[at], pages))], run)


def in_question(blocks: list[Block]) -> list[bool]:
    """Which blocks may be main text: by the markup, or all that aren't excluded where nothing marks it."""
    marked = any(b.main and not b.never for b in blocks)
    return [not b.never and (b.main or not marked) for b in blocks]


def content_of(blocks: list[Block], fits: list[bool]) -> int:
    """A hash of a page's text in question."""
    digest = xxhash.xxh3_64()
    for b, fit in zip(blocks, fits, strict=True):
        if fit:
            digest.update(b.text + "\n")
    return digest.intdigest()


class Numbers(dict):
    """Numbers of words, in the order they are met."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Pack:
    """Pages of one host as numbered words, to be sent."""

    def __init__(self, parts: int):
        self.parts, self.chars = parts, 0
        self.ids, self.urls, self.content = [], [], []
        self.numbers, self.tokens, self.ends = Numbers(), array("i"), [0]
        self.sizes, self.fit, self.blocks = array("i"), array("b"), [0]

    def add(self, page_id, url: str | None, html: str | None) -> int:
        """Characters of the page's text, and some for the page itself."""
        blocks = blocks_of(html)
        fits = in_question(blocks)
        chars = 200
        for b in blocks:
            words = b.text.split(" ")
            self.tokens.append(self.numbers[f"<{b.never:d}{b.main:d}>"])
            self.tokens.extend(map(self.numbers.__getitem__, words))
            self.sizes.append(len(words) + 1)
            chars += len(b.text)
        self.fit.extend(fits)
        self.ids.append(page_id)
        self.urls.append(url)
        self.content.append(content_of(blocks, fits))
        self.ends.append(len(self.tokens))
        self.blocks.append(len(self.sizes))
        self.chars += chars
        return chars

    def sent(self, kind: pa.DataType) -> bytes:
        zstd = pa.Codec("zstd", 3)
        words = " ".join(self.numbers).encode()
        lists = lambda at, x, t: pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), pa.array(np.frombuffer(x, t)))
        pages = pa.RecordBatch.from_arrays(
            [pa.array(self.ids, kind), pa.array(self.urls, pa.string()), pa.array(np.array(self.content, np.uint64)), lists(self.ends, self.tokens, np.int32), lists(self.blocks, self.sizes, np.int32), lists(self.blocks, self.fit, np.int8)],
            names=["page_id", "url", "content", "tokens", "sizes", "fit"],
        )
        small = zstd.compress(words, asbytes=True)
        return struct.pack("<QQ", len(words), len(small)) + small + stream(pages, zstd)


def received(pack: bytes) -> tuple[list[str], np.ndarray, pa.RecordBatch]:
    """Words, their hashes, and the pages."""
    n, m = struct.unpack_from("<QQ", pack)
    words = pa.Codec("zstd").decompress(memoryview(pack)[16 : 16 + m], n, asbytes=True).decode().split(" ") if n else []
    return words, np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), pa.ipc.open_stream(memoryview(pack)[16 + m :]).read_next_batch()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = mixed(np.arange(1, MIN_RUN + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


class Group:
    """The tokens of some pages of one host, numbered and by hash, and what of them is the text in question; ``content`` has a hash of that text by page."""

    def __init__(self, host: str, parts: list[tuple[list[str], np.ndarray, pa.RecordBatch]]):
        self.host, self.parts = host, parts
        column = lambda k: pa.concat_arrays([b.column(k) for _, _, b in parts])
        self.ids, self.urls, self.content = column("page_id"), column("url"), column("content").to_numpy()
        length = lambda k: column(k).value_lengths().to_numpy()
        sizes = column("sizes").flatten().to_numpy().astype(np.int64)
        self.blocks, self.fit = length("sizes"), column("fit").flatten().to_numpy() > 0
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        hashes, number = np.unique(np.concatenate([h for _, h, _ in parts]), return_inverse=True)
        self.local = [b.column("tokens").flatten().to_numpy() for _, _, b in parts]
        at = np.cumsum([0] + [len(h) for _, h, _ in parts])
        self.number = np.concatenate([number[k : k + len(h)][x] for k, (_, h, _), x in zip(at[:-1], parts, self.local, strict=True)])
        self.tokens = hashes[self.number]
        self.page, self.eligible = np.repeat(np.arange(len(self.ids)), length("tokens")), np.repeat(self.fit, sizes)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of MIN_RUN tokens begin (none reaches over pages), and their hashes with the host."""
        n = len(self.tokens) - MIN_RUN + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        key = np.full(n, xxhash.xxh3_64_intdigest(self.host), np.uint64)
        for j in range(MIN_RUN):
            key += self.tokens[j : j + n] * _FACTORS[j]
        at = np.flatnonzero(self.page[:n] == self.page[MIN_RUN - 1 :])
        return at, mixed(key[at])

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """The hash of each distinct run, and on how many contents it stands (MIN_PAGES: on so many at least), by suffix array."""
        at, rank = run_ranks(self.number, self.page)
        if not len(at):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        times = np.bincount(rank)
        first = np.zeros(len(times), np.int64)
        first[rank] = np.arange(len(rank))
        weight = np.minimum(times, 1)
        again = times[rank] > 1
        r, c = distinct(rank[again].astype(np.uint64), self.content[self.page[at[again]]])
        found, n = np.unique(r, return_counts=True)
        weight[found.astype(np.int64)] = n
        there = np.flatnonzero(times)
        return self.keys()[1][first[there]], weight[there]

    def hits(self, runs: np.ndarray, shift: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Where runs begin whose hashes, less ``shift`` bits, are in ``runs``, sorted; and their hashes."""
        at, key = self.keys()
        on = among(key >> np.uint64(shift), runs)
        return at[on], key[on]

    def with_own_text(self, at: np.ndarray) -> np.ndarray:
        """By page, whether OWN of its text in question is outside the runs that begin at ``at``."""
        fit = np.bincount(self.page[self.eligible], minlength=len(self.ids))
        own = np.bincount(self.page[self.eligible & ~cover(len(self.tokens), at)], minlength=len(self.ids))
        return (fit > 0) & (own >= OWN * fit)

    def texts(self, at: np.ndarray) -> list[str]:
        """The pages' texts without blocks that the runs that begin at ``at`` cover."""
        total = np.concatenate([[0], np.cumsum(cover(len(self.tokens), at))])
        stays = (self.fit & (total[self.ends] - total[self.begins] < COVERED * (self.ends - self.begins))).tolist()
        spans = zip(self.begins.tolist(), self.ends.tolist(), stays, strict=True)
        words = [w for (own, _, _), x in zip(self.parts, self.local, strict=True) for w in map(own.__getitem__, x.tolist())]
        return ["\n".join(" ".join(words[begin + 1 : end]) for begin, end, stay in islice(spans, n) if stay) for n in self.blocks.tolist()]


def among(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in ``found``, sorted."""
    if not len(found):
        return np.zeros(len(x), bool)
    return found[np.minimum(np.searchsorted(found, x), len(found) - 1)] == x


def distinct(key: np.ndarray, content: np.ndarray, most: int = MIN_PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted, and of each key the first ``most``: that many decide that it recurs."""
    order = np.lexsort((content, key))
    key, content = key[order], content[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (content[1:] != content[:-1])
    key, content = key[new], content[new]
    stays = np.ones(len(key), bool)
    stays[most:] = key[most:] != key[:-most]
    return key[stays], content[stays]


def joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def coded(x: np.ndarray) -> bytes:
    """Distinct sorted numbers by the gaps between them (Golomb and Rice's code)."""
    if not len(x):
        return b""
    gap = np.diff(x, prepend=x[:1])
    bits = max(0, (int(x[-1] - x[0]) // len(x)).bit_length() - 1)
    low = ((gap[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    ends = np.cumsum((gap >> np.uint64(bits)).astype(np.int64) + 1) - 1
    high = np.zeros(int(ends[-1]) + 1, np.uint8)
    high[ends] = 1
    return struct.pack("<QQBQ", int(x[0]), len(x), bits, len(high)) + np.packbits(low).tobytes() + np.packbits(high).tobytes()


def decoded(b: bytes) -> np.ndarray:
    if not b:
        return np.zeros(0, np.uint64)
    first, n, bits, m = struct.unpack_from("<QQBQ", b)
    at, size = struct.calcsize("<QQBQ"), (n * bits + 7) // 8
    low = np.unpackbits(np.frombuffer(b, np.uint8, size, at), count=n * bits).reshape(n, bits)
    gap = np.diff(np.flatnonzero(np.unpackbits(np.frombuffer(b, np.uint8, -1, at + size), count=m)), prepend=-1).astype(np.uint64) - np.uint64(1)
    gap <<= np.uint64(bits)
    for k in range(bits):
        gap |= low[:, k].astype(np.uint64) << np.uint64(k)
    return np.cumsum(gap, dtype=np.uint64) + np.uint64(first)


def same(k: int) -> int:
    return k


def spread_out(x: np.ndarray, bits: int, n: int) -> np.ndarray:
    """Where each of ``n`` equal stretches of numbers below 1 << ``bits`` begins in ``x``, sorted, and the end."""
    return np.searchsorted(x, np.array([-(-(q << bits) // n) for q in range(n)], np.uint64)).tolist() + [len(x)]


def stream(b: pa.RecordBatch, codec: pa.Codec | None = None) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, b.schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as w:
        w.write_batch(b)
    return out.getvalue().to_pybytes()


def groups_of(packs: list[tuple[str, int, bytes]], most_pages: int, most_tokens: int) -> Iterator[Group]:
    """A partition's packs (host, digest, pages) as groups, the same ones in each pass."""
    held: list[tuple[list[str], np.ndarray, pa.RecordBatch]] = []
    pages, size, last = 0, 0, None
    for host, _, pack in sorted(packs):
        if held and host != last:
            yield Group(last, held)
            held, pages, size = [], 0, 0
        last = host
        words, hashes, b = received(pack)
        begin = 0
        for i, n in enumerate(b.column("tokens").value_lengths().to_pylist()):
            if pages and (pages >= most_pages or size >= most_tokens):
                if begin < i:
                    held.append((words, hashes, b.slice(begin, i - begin)))
                begin = i
                yield Group(host, held)
                held, pages, size = [], 0, 0
            pages += 1
            size += n
        held.append((words, hashes, b.slice(begin)))
    if held:
        yield Group(last, held)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    df = only(pages, page_id=page_id, url=url, html=html)
    spark = df.sparkSession
    kind = df.schema["page_id"].dataType.simpleString()
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "://([^/?#]*)", 1))
    hosted = df.withColumn("host", host)
    size = F.coalesce(F.sum(F.octet_length("html")), F.lit(0))
    rows, total = df.agg(F.count("*"), size).first()
    part, part_bytes, most_pages, most_tokens = max(LEAST_PART, rows // MOST_HOT), max(PART_BYTES, total // MOST_HOT), GROUP_PAGES, GROUP_TOKENS
    hot = hosted.groupBy(F.col("host").alias("hot")).agg(F.greatest(F.ceil(F.count("*") / part), F.ceil(size / part_bytes)).cast("long").alias("parts")).where("parts > 1")
    dealt = hosted.join(F.broadcast(hot), F.col("host") == F.col("hot"), "left").select("page_id", "url", "html", "host", F.coalesce("parts", F.lit(1)).alias("parts"))

    @in_worker
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Pack] = {}
        all_chars, id_type = 0, None

        def hand_on(hosts: list[str]) -> Iterator[pa.RecordBatch]:
            for host in hosts:
                mine = held.pop(host)
                found = mine.sent(id_type)
                digest = xxhash.xxh3_64_intdigest(found) >> 1
                key = xxhash.xxh3_64_intdigest(f"{digest % mine.parts} {host}") >> 1
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([host]), pa.array([digest], pa.int64()), pa.array([found], pa.binary())], names=["key", "host", "digest", "pack"])

        for big in batches:
            id_type = big.schema.field("page_id").type
            for b in bounded(big):
                for i, u, h, host, parts in zip(*(b.column(k).to_pylist() for k in ("page_id", "url", "html", "host", "parts")), strict=True):
                    mine = held.get(host) or held.setdefault(host, Pack(parts))
                    all_chars += mine.add(i, u, h)
                    if mine.chars >= PACK_CHARS or len(mine.ids) >= most_pages:
                        all_chars -= mine.chars
                        yield from hand_on([host])
                if all_chars >= HELD_CHARS:
                    yield from hand_on(list(held))
                    all_chars = 0
        yield from hand_on(list(held))

    n = max(spark.sparkContext.defaultParallelism, total // PART_BYTES + 1)
    base = dealt.mapInArrow(pack, "key long, host string, digest long, pack binary").rdd.map(lambda r: (r[0], (r[1], r[2], bytes(r[3])))).partitionBy(n, same)
    n = base.getNumPartitions()
    bits = min(44, max(16, math.ceil(math.log2(SLOTS * (total / 6 + 1)))))

    def passed(replies: RDD | None, work: Callable) -> RDD:
        """``work`` of each partition's number, replies as one sorted array, and a function that gives its groups. A reply has no host."""
        both = base if replies is None else base.union(replies.partitionBy(n, same))
        if both.getNumPartitions() != n:
            raise ValueError("replies don't meet their pages")

        def run(p: int, records: Iterator) -> Iterator:
            def of(records: Iterator) -> Iterator:
                packs, found = [], []
                for _, value in records:
                    packs.append(value) if value[0] is not None else found.append(decoded(value[1]))
                yield from work(p, np.sort(joined(found)), lambda: groups_of(packs, most_pages, most_tokens))

            of.__module__ = __name__
            yield from in_worker(of)(records)

        return both.mapPartitionsWithIndex(run)

    def places(p: int, _: np.ndarray, groups: Callable) -> Iterator:
        """The partition's runs by place, apart by the contents they stand on."""
        found = [(key >> np.uint64(64 - bits)) << np.uint64(2) | weight.astype(np.uint64) for key, weight in (g.runs() for g in groups())]
        x = np.sort(joined(found))
        if not len(x):
            return
        slot = x >> np.uint64(2)
        begin = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        weight = np.minimum(np.add.reduceat(x & np.uint64(3), begin), np.uint64(MIN_PAGES))
        slot = slot[begin]
        lists = [slot[weight == w] for w in range(1, MIN_PAGES + 1)]
        cuts = [spread_out(x, bits, n) for x in lists]
        for q in range(n):
            yield q, (p, [coded(x[c[q] : c[q + 1]]) for x, c in zip(lists, cuts, strict=True)])

    def likely(q: int, records: Iterator) -> Iterator:
        """To each partition, those of its places that may have MIN_PAGES contents."""
        held = [value for _, value in records]
        begin, end = (np.uint64(-(-(k << bits) // n)) for k in (q, q + 1))
        count = np.zeros(int(end - begin), np.uint8)
        for _, lists in held:
            for w, x in enumerate(lists, 1):
                at = (decoded(x) - begin).astype(np.int64)
                count[at] = np.minimum(count[at] + w, MIN_PAGES)
        for p, lists in held:
            x = np.sort(joined([decoded(x) for x in lists]))
            yield p, (None, coded(x[count[(x - begin).astype(np.int64)] >= MIN_PAGES]))

    def hand_out(p: int, found: list[tuple[np.ndarray, np.ndarray]], asked: np.ndarray | None = None) -> Iterator:
        """Runs with contents, and the sorted runs that the partition wants to know of: those it found, or ``asked``."""
        key, content = distinct(joined([k for k, _ in found]), joined([c for _, c in found]))
        asked = np.unique(key) if asked is None else asked
        cut, ask = spread_out(key, 64, n), spread_out(asked, 64, n)
        for q in range(n):
            if ask[q] < ask[q + 1]:
                yield q, (p, key[cut[q] : cut[q + 1]].tobytes(), content[cut[q] : cut[q + 1]].tobytes(), coded(asked[ask[q] : ask[q + 1]]))

    def decide(q: int, records: Iterator) -> Iterator:
        """To each partition, those of the runs it asked for that have MIN_PAGES contents."""
        held = [value for _, value in records]
        key, _ = distinct(*(joined([np.frombuffer(x[i], np.uint64) for x in held]) for i in (1, 2)))
        found, times = np.unique(key, return_counts=True)
        found = found[times >= MIN_PAGES]
        for p, _, _, asked in held:
            x = decoded(asked)
            yield p, (None, coded(x[among(x, found)]))

    def candidates(p: int, slots: np.ndarray, groups: Callable) -> Iterator:
        found = []
        for g in groups():
            at, key = g.hits(slots, 64 - bits)
            found.append(distinct(key, g.content[g.page[at]]))
        yield from hand_out(p, found)

    def on_own(p: int, runs: np.ndarray, groups: Callable) -> Iterator:
        """Runs that recur, on the pages that have text of their own; all that the partition has are asked for, on other pages too."""
        found = []
        for g in groups():
            at, key = g.hits(runs)
            on = g.with_own_text(at)[g.page[at]]
            found.append(distinct(key[on], g.content[g.page[at[on]]]))
        yield from hand_out(p, found, runs)

    def texts(p: int, runs: np.ndarray, groups: Callable) -> Iterator:
        for g in groups():
            found = g.texts(g.hits(runs)[0])
            b = pa.RecordBatch.from_arrays([g.ids, g.urls, pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])
            for x in bounded(b):
                yield (stream(x),)

    def exchanged(sent: RDD, reduce: Callable) -> RDD:
        return sent.partitionBy(n, same).mapPartitionsWithIndex(reduce)

    maybe = exchanged(passed(None, places), likely)
    recurs = exchanged(passed(maybe, candidates), decide)
    boilerplate = exchanged(passed(recurs, on_own), decide)

    @in_worker
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column("found"):
                yield from pa.ipc.open_stream(x.as_buffer())

    return spark.createDataFrame(passed(boilerplate, texts), "found binary", verifySchema=False).mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")
