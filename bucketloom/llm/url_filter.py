"""Operator 10: URL filter with host/path rules and a weighted vocabulary found by an Aho-Corasick automaton.

A page's url is judged by the longest fitting rule; where none fits, by its words. Strict terms block alone,
soft terms only when SOFT_LEAST distinct ones or more appear whose weights together reach the filter's threshold. All of the url after
``://`` is scanned, query and fragment too. A term counts when no ASCII letter or digit touches it.
The vocabulary in this file is a small default; ``read_vocabulary`` reads one of any size from lines of term, class and weight.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule, holds no term
and is allowed. Repeated rows give repeated results. An empty table gives an empty result. Other columns, of
any name, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from bucketloom.llm.common import map_batches, only

STRICT = ("adult", "casino", "escort", "gambling", "malware", "phishing", "porn", "sex", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "bet", "bets", "bonus", "cheap", "clicks", "coupon", "dating", "deal", "farm", "free", "loan", "pills", "poker", "promo", "slots", "track", "tracker", "win")
SOFT_LEAST = 2

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


@dataclass(frozen=True)
class UrlFilter:
    rules: tuple[Rule, ...] = RULES
    strict: tuple[str, ...] = STRICT
    soft: tuple[str, ...] = SOFT
    #: Weights of soft terms other than 1, and the weight from which distinct soft terms block.
    weights: tuple[tuple[str, int], ...] = ()
    soft_weight: int = 2
    #: So many distinct soft terms at least.
    soft_least: int = SOFT_LEAST
    columns: dict[str, str] = field(default_factory=lambda: {"page_id": "page_id", "url": "url"})


def read_vocabulary(spark: SparkSession, path: str) -> tuple[tuple[str, ...], tuple[str, ...], tuple[tuple[str, int], ...]]:
    """Strict terms, soft terms and soft weights from lines ``term<TAB>strict|soft<TAB>weight`` (no weight: 1); blank lines and lines that begin with # don't count.

    A vocabulary is a curated list, whose size doesn't depend on the data; it is read by Spark, from wherever Spark can read.
    """
    strict, soft, weights = [], [], []
    for (line,) in spark.read.text(path).collect():
        if not line.strip() or line.startswith("#"):
            continue
        term, kind, *rest = line.split("\t")
        term, weight = term.strip().translate(_LOWER), int(rest[0]) if rest else 1
        if not term or kind not in ("strict", "soft") or weight < 1:
            raise ValueError(f"not a line of a vocabulary: {line!r}")
        (strict if kind == "strict" else soft).append(term)
        if kind == "soft" and weight != 1:
            weights.append((term, weight))
    return tuple(strict), tuple(soft), tuple(weights)


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host, path, and the whole text after the scheme."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", "", ""
    cut = len(rest)
    for c in "?#":
        i = rest.find(c)
        if 0 <= i < cut:
            cut = i
    host, slash, tail = rest[:cut].partition("/")
    return host.translate(_LOWER), slash + tail, rest


class Judge:
    """The automaton and the rules by host, built once per task."""

    def __init__(self, spec: UrlFilter):
        self.spec = spec
        self.terms = [*dict.fromkeys(t.lower() for t in (*spec.strict, *spec.soft))]
        self.strict = {i for i, t in enumerate(self.terms) if t in {s.lower() for s in spec.strict}}
        given = dict(spec.weights)
        self.weight = [given.get(t, 1) for t in self.terms]
        self.machine = ahocorasick.Automaton()
        for i, t in enumerate(self.terms):
            self.machine.add_word(t, i)
        if self.terms:
            self.machine.make_automaton()
        self.by_host: dict[str, list[Rule]] = {}
        for r in sorted(spec.rules, key=lambda r: -len(r.name)):
            self.by_host.setdefault(r.host, []).append(r)

    def rule(self, host: str, path: str) -> Rule | None:
        best: Rule | None = None
        name = host
        while name:
            for r in self.by_host.get(name, ()):
                if path.startswith(r.path):
                    if best is None or len(r.name) > len(best.name):
                        best = r
                    break
            _, _, name = name.partition(".")
        return best

    def hits(self, rest: str) -> tuple[int, int, int]:
        """How often strict terms occur, how many distinct soft ones do, and these ones' weight."""
        s = rest.translate(_LOWER)
        strict, soft = 0, set()
        if self.terms:
            for end, i in self.machine.iter(s):
                begin = end + 1 - len(self.terms[i])
                if (begin and s[begin - 1] in _WORD) or (end + 1 < len(s) and s[end + 1] in _WORD):
                    continue
                if i in self.strict:
                    strict += 1
                else:
                    soft.add(i)
        return strict, len(soft), sum(self.weight[i] for i in soft)

    def __call__(self, url: str | None) -> tuple[str, str, str | None, str, int, int]:
        host, path, rest = split_url(url)
        r = self.rule(host, path)
        strict, soft, weight = self.hits(rest)
        words = "block" if strict or soft >= self.spec.soft_least and weight >= self.spec.soft_weight else "allow"
        return host, path, r.name if r else None, r.verdict if r else words, strict, soft


def judge_urls(pages: DataFrame, spec: UrlFilter = UrlFilter()) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_terms of every row of ``pages``."""
    df = only(pages, page_id=spec.columns["page_id"], url=spec.columns["url"])
    kind = df.schema["page_id"].dataType.simpleString()

    def make():
        judge = Judge(spec)

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            rows = [judge(u) for u in b.column("url").to_pylist()]
            cols = list(zip(*rows, strict=True))
            kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            names = ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_terms"]
            return pa.RecordBatch.from_arrays([b.column("page_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=names)

        return f

    return map_batches(df, make, f"page_id {kind}, host string, path string, rule string, verdict string, strict_hits long, soft_terms long")


def oracle(spec: UrlFilter = UrlFilter()) -> str:
    """The same in DuckDB's SQL."""
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    has = lambda t: f"regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])')"
    # Boundaries may be shared by neighbours, so each boundary is doubled before occurrences are counted.
    count = lambda t: f"len(regexp_extract_all(regexp_replace(low, '([^a-z0-9])', '\\1\\1', 'g'), '(^|[^a-z0-9]){t}($|[^a-z0-9])'))"
    strict = " + ".join(count(t) for t in spec.strict) or "0"
    soft = " + ".join(f"({has(t)})::INT" for t in spec.soft) or "0"
    given = dict(spec.weights)
    weight = " + ".join(f"{given.get(t, 1)} * ({has(t)})::INT" for t in spec.soft) or "0"
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.name}', '{r.verdict}')" for r in spec.rules)
    return f"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest,
                  row_number() OVER () AS rid FROM pages),
h AS (SELECT page_id, rid, rest, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{up}', '{low}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rhost, rpath, rname, rverdict) AS (VALUES {rules}),
m AS (SELECT rid, arg_max(rname, length(rname)) AS rule, arg_max(rverdict, length(rname)) AS rverdict
      FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid),
t AS (SELECT *, translate(rest, '{up}', '{low}') AS low FROM h),
c AS (SELECT *, ({strict})::BIGINT AS strict_hits, ({soft})::BIGINT AS soft_terms, {weight} AS soft_weight FROM t)
SELECT page_id, host, path, rule,
       coalesce(rverdict, CASE WHEN strict_hits > 0 OR soft_terms >= {spec.soft_least} AND soft_weight >= {spec.soft_weight} THEN 'block' ELSE 'allow' END) AS verdict,
       strict_hits, soft_terms
FROM c LEFT JOIN m USING (rid)"""
