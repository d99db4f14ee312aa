"""Find secrets with regular expressions behind a trigram inverted index.

Each rule's expression is reduced to a Boolean query over trigrams that every match must contain. A task indexes the texts
it holds, shard by shard: one pass over the bytes yields the postings of the trigrams that the rules ask for, the queries
intersect and unite them, and only the texts that remain are searched by that rule. Rules without mandatory trigrams search
every text. The index is case-folded, so it never rules out a match that differs in case.

Null and empty texts have no secrets; long texts are searched whole; every row is searched, repeated ones as well. Spans of
several rules may overlap, and equal places are listed in the order of the rules. Other columns are carried, but give way to
a result of their name. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from re import _constants as sre  # the names of the parsed parts
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.llm.common import map_text

#: A query is None (any text), a trigram, or ("and" | "or", parts).
Query = None | bytes | tuple

#: So many literal strings of a part are followed at most; beyond, the part asks for nothing.
LITERALS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: an expression, and the least length of one of its groups (0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = re.ASCII

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Leftmost non-overlapping matches; those with too short a group are dropped afterwards."""
        return [m.span() for m in _compiled(self).finditer(text) if m.end(self.group) - m.start(self.group) >= self.least]


_known: dict[Rule, re.Pattern] = {}


def _compiled(rule: Rule) -> re.Pattern:
    if rule not in _known:
        _known[rule] = re.compile(rule.pattern, rule.flags)
    return _known[rule]


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Kinds beyond the base ones: key blocks, signed tokens, credentials in addresses, and tokens with a fixed prefix.
MORE = (
    # To its END line, whatever is between but another block's BEGIN; without one, header lines and the letters that follow.
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]*PRIVATE KEY-----|(?:\s*[A-Za-z-]+: [^\r\n]*)*[A-Za-z0-9+/=\s]*)"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url", r"://[^\s/:@]+:[^\s/:@]{3,}@[A-Za-z0-9.-]+"),
    Rule("bearer", r"Bearer [A-Za-z0-9._~+/-]{16,}=*"),
    Rule("prefixed", r"(ghp_|gho_|ghs_|github_pat_|glpat-|xoxb-|xoxp-|sk_live_|rk_live_|AIza|npm_)[A-Za-z0-9_-]{20,}"),
)
RULES = BASE + MORE


def _both(a: Query, b: Query) -> Query:
    return b if a is None or a == b else a if b is None else ("and", a, b)


def _either(parts: list[Query]) -> Query:
    kept = list(dict.fromkeys(parts))
    return None if not kept or None in kept else kept[0] if len(kept) == 1 else ("or", *kept)


def _of_strings(strings: set[str]) -> Query:
    """What a text must hold to hold one of the strings."""
    found = []
    for s in sorted(strings):
        data, query = s.lower().encode(), None
        for i in range(len(data) - 2):
            query = _both(query, data[i : i + 3])
        found.append(query)
    return _either(found)


def _read(parts) -> tuple[set[str] | None, Query]:
    """(all strings that the sequence can match, if they are few; what its matches must hold)."""
    exact: set[str] | None = {""}
    run: set[str] = {""}
    query: Query = None
    for op, arg in parts:
        strings, inner = _part(op, arg)
        if strings is not None and len(run) * len(strings) <= LITERALS:
            run = {a + b for a in run for b in strings}
            continue
        query, exact = _both(query, _both(_of_strings(run), inner)), None
        run = {""} if strings is None else strings
    if exact is not None:
        return run, _of_strings(run)
    return None, _both(query, _of_strings(run))


def _part(op, arg) -> tuple[set[str] | None, Query]:
    if op is sre.LITERAL:
        return {chr(arg)}, None
    if op is sre.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value))
            elif kind is sre.RANGE and value[1] - value[0] < 4:
                chars |= {chr(c) for c in range(value[0], value[1] + 1)}
            else:
                return None, None
        return (chars, None) if len(chars) <= 4 else (None, None)
    if op is sre.SUBPATTERN:
        return _read(arg[3])
    if op is sre.BRANCH:
        read = [_read(b) for b in arg[1]]
        if all(s is not None for s, _ in read):
            strings = set().union(*(s for s, _ in read))
            return strings, _of_strings(strings)
        return None, _either([q for _, q in read])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, inner = arg
        strings, query = _read(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, None
        return None, query if low else None
    if op is sre.AT:
        return {""}, None
    return None, None


def trigram_query(rule: Rule) -> Query:
    """Trigrams, in lower case, that every match of the rule holds; None if there are none."""
    return _read(parser.parse(rule.pattern, rule.flags))[1]


def _trigrams(query: Query) -> Iterator[bytes]:
    if isinstance(query, bytes):
        yield query
    elif query:
        for part in query[1:]:
            yield from _trigrams(part)


class TrigramIndex:
    """Postings of chosen trigrams over a shard of texts."""

    def __init__(self, wanted: set[bytes]):
        self.number = {t: i + 1 for i, t in enumerate(sorted(wanted))}
        self.lookup = np.zeros(1 << 24, dtype=np.uint16)
        for t, i in self.number.items():
            self.lookup[t[0] << 16 | t[1] << 8 | t[2]] = i
        self.fold = np.arange(256, dtype=np.uint32)
        self.fold[65:91] += 32

    def postings(self, texts: list[bytes]) -> dict[bytes, np.ndarray]:
        """Trigram to the sorted numbers of the texts that hold it."""
        # Two zero bytes part the texts; no wanted trigram holds one.
        data = self.fold[np.frombuffer(b"\0\0".join(texts) + b"\0\0", dtype=np.uint8)]
        ends = np.cumsum([len(t) + 2 for t in texts])
        hit = self.lookup[data[:-2] << 16 | data[1:-1] << 8 | data[2:]]
        places = np.flatnonzero(hit)
        pairs = np.unique(hit[places].astype(np.int64) * len(texts) + np.searchsorted(ends, places, side="right"))
        which, doc = pairs // len(texts), pairs % len(texts)
        cuts = np.searchsorted(which, np.arange(1, len(self.number) + 2))
        return {t: doc[cuts[i - 1] : cuts[i]] for t, i in self.number.items()}


def candidates(query: Query, postings: dict[bytes, np.ndarray], count: int) -> np.ndarray:
    """Numbers of the texts that satisfy the query."""
    if query is None:
        return np.arange(count)
    if isinstance(query, bytes):
        return postings[query]
    found = [candidates(part, postings, count) for part in query[1:]]
    out = found[0]
    for other in found[1:]:
        out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
    return out


#: Texts are indexed in shards of about so many bytes.
SHARD_BYTES = 2 << 20


def scan(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, keep_text: bool = False) -> DataFrame:
    """Replace the text (or, with ``keep_text``, follow it) by ``spans``: kind, start and end in code points, end exclusive.

    Spans are sorted by start, then by the order of the rules.
    """

    def make():
        queries = [trigram_query(r) for r in rules]
        index = TrigramIndex({t for q in queries for t in _trigrams(q)})
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

        def shard(texts: list[str]) -> list[list[dict]]:
            posted = index.postings([t.encode() for t in texts])
            found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for order, (rule, query) in enumerate(zip(rules, queries, strict=True)):
                for i in candidates(query, posted, len(texts)).tolist():
                    found[i].extend((start, order, end) for start, end in rule.spans(texts[i]))
            return [[{"kind": rules[o].kind, "start": s, "end": e} for s, o, e in sorted(f)] for f in found]

        def work(texts: list[str]) -> dict[str, pa.Array]:
            out, at = [], 0
            while at < len(texts):
                upto, size = at, 0
                while upto < len(texts) and (upto == at or size < SHARD_BYTES):
                    size += len(texts[upto])
                    upto += 1
                out.extend(shard(texts[at:upto]))
                at = upto
            return {"spans": pa.array(out, kind)}

        return work

    source = df.withColumn("_scanned", F.col(f"`{text}`")) if keep_text else df
    return map_text(source, "_scanned" if keep_text else text, "spans array<struct<kind:string,start:bigint,end:bigint>>", make)


def of_kind(kind: str) -> Callable[[Column], Column]:
    """Test of a span for its kind."""
    return lambda span: span["kind"] == kind


def told(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mask(text: Column, spans: Column) -> Column:
    """The text with every stretch that spans cover replaced by ``[kind]`` of the first span there."""
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        ahead = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(span["start"] - state["at"], F.lit(0)).cast("int"))
        mark = F.when(span["start"] >= state["at"], F.concat(ahead, F.lit("["), span["kind"], F.lit("]"))).otherwise(F.lit(""))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["out"], mark).alias("out"))

    masked = F.aggregate(spans, first, step, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(masked)
