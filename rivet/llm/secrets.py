"""Secret scans through a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived:
what every match must contain. Each block of texts gets an inverted index of
the trigrams that the rules ask for; the queries intersect and unite its
postings, and only the candidate texts are verified with the expression. A
rule without mandatory trigrams (a run of hex digits) scans all texts.

The scan is one map over the table: a block's index lives as long as its
block, so nothing is shuffled, and a lost task rebuilds its own blocks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _parser as sre

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 4 << 20
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has ``min_chars`` or more."""

    kind: str
    pattern: str
    min_chars: int = 1
    group: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.A | (re.I if self.ignore_case else 0))


# FIXED VALUES: the base rules. A run of 16 or more is the same as a run that
# fails when shorter.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         min_chars=12, group=2, ignore_case=True),
    Rule("access", r"AKIA[A-Z0-9]+", min_chars=18),
    Rule("hex", r"[0-9a-f]{16,}", min_chars=16),
)

# Further kinds whose fixed parts the index finds at no cost.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("map_key", r"AIza[0-9A-Za-z_-]{35}"),
)
RULES = BASE_RULES + MORE_RULES

# A query is True (any text), a trigram (bytes), or ("and" | "or", queries).


def _combine(kind: str, queries: list) -> object:
    parts = []
    for q in queries:
        if q is True:
            if kind == "or":
                return True
        elif q not in parts:
            parts.append(q)
    return (parts[0] if len(parts) == 1 else (kind, tuple(parts))) if parts else True


def _any_of(strings: set[str]) -> object:
    """At least one of the strings occurs; True if one is too short to tell."""
    def all_of(s: str) -> object:
        b = s.encode()
        return _combine("and", [b[i:i + 3] for i in range(len(b) - 2)])
    return _combine("or", [all_of(s) for s in sorted(strings)])


def _node(op, arg) -> tuple[set[str] | None, object]:
    """(all strings it can match, or None if too many; what a match contains)."""
    if op is sre.LITERAL and 0 < arg < 128:
        return {chr(arg).lower()}, True
    if op is sre.IN and all(o is sre.LITERAL and 0 < a < 128 for o, a in arg):
        return {chr(a).lower() for _, a in arg}, True
    if op is sre.AT or op is sre.ASSERT or op is sre.ASSERT_NOT:
        return {""}, True
    if op is sre.SUBPATTERN:
        return _sequence(arg[3])
    if op is sre.BRANCH:
        ways = [_sequence(way) for way in arg[1]]
        if all(strings is not None for strings, _ in ways):
            return set().union(*(strings for strings, _ in ways)), True
        return None, _combine("or", [q if s is None else _any_of(s) for s, q in ways])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        least, most, item = arg
        strings, query = _sequence(item)
        if least == 0:
            return (strings | {""}, True) if most == 1 and strings is not None else (None, True)
        if least == most == 1:
            return strings, query
        return None, query if strings is None else _any_of(strings)
    return None, True


def _sequence(items) -> tuple[set[str] | None, object]:
    strings, parts = {""}, []
    for op, arg in items:
        own, query = _node(op, arg)
        if own is not None and len(strings) * len(own) <= MAX_STRINGS:
            strings = {a + b for a in strings for b in own}
            continue
        parts += [_any_of(strings), query if own is None else _any_of(own)]
        strings = {""}
    return (None, _combine("and", [*parts, _any_of(strings)])) if parts else (strings, True)


def trigram_query(rule: Rule) -> object:
    """The trigrams (lower case, UTF-8) that every match of the rule contains."""
    strings, query = _sequence(sre.parse(rule.pattern, re.A))
    return query if strings is None else _any_of(strings)


def trigrams(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(trigrams(q) for q in query[1]))


class Index:
    """Postings of chosen trigrams over a block of lower-cased texts."""

    def __init__(self, terms: list[bytes]):
        self.terms = {t: i for i, t in enumerate(terms)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, i in self.terms.items():
            self.table[int.from_bytes(t, "big")] = i + 1
        self.postings: list[np.ndarray] = []
        self.n = 0

    def build(self, texts: list[bytes]) -> None:
        """Sorted row numbers by trigram. Two zero bytes keep texts apart."""
        self.n = len(texts)
        ends = np.cumsum([len(t) + 2 for t in texts], dtype=np.int64)
        buffer = np.frombuffer(b"\0\0".join([*texts, b""]), np.uint8)
        found = []
        for at in range(0, max(len(buffer) - 2, 0), BLOCK_BYTES):
            b = buffer[at:at + BLOCK_BYTES + 2].astype(np.uint32)
            term = self.table[(b[:-2] << 16) | (b[1:-1] << 8) | b[2:]]
            hit = np.flatnonzero(term)
            row = np.searchsorted(ends, hit + at, side="right")
            found.append(np.unique((term[hit].astype(np.int64) - 1) * self.n + row))
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        cuts = np.searchsorted(pairs, np.arange(len(self.terms) + 1) * self.n)
        self.postings = [pairs[a:b] - i * self.n for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]

    def rows(self, query) -> np.ndarray:
        if query is True:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings[self.terms[query]]
        out = self.rows(query[1][0])
        for q in query[1][1:]:
            other = self.rows(q)
            out = np.intersect1d(out, other, True) if query[0] == "and" else np.union1d(out, other)
        return out


def find_spans(texts: list[str], rules: tuple[Rule, ...], queries: list, index: Index) -> list[list[tuple]]:
    """(kind, start, end) of each text in code points, by start, then rule."""
    spans: list[list[tuple]] = [[] for _ in texts]
    index.build([t.encode("utf-8", "surrogatepass").lower() for t in texts])
    for place, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        pattern = rule.compiled()
        for row in index.rows(query).tolist():
            for m in pattern.finditer(texts[row]):
                if len(m.group(rule.group) or "") >= rule.min_chars:
                    spans[row].append((m.start(), place, m.end()))
    return [[(rules[p].kind, s, e) for s, p, e in sorted(found)] for found in spans]


def blocks(texts: list[str], block_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``block_bytes`` characters; at least one row each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > block_bytes:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: ``id_col`` and spans (kind, start, end).

    Spans are leftmost and non-overlapping within a kind, in code points, end
    exclusive, by start and then in the order of ``rules``. Null text is the
    empty text and has none. Ids may be null or repeat. Other columns are
    ignored, whatever their names. An empty table gives an empty result.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("spans", T.DataType.fromDDL(SPANS))])
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(r) for r in rules]
        index = Index(sorted(set().union(*(trigrams(q) for q in queries))))
        for batch in batches:
            for a, b in blocks(texts := [t or "" for t in batch.column(1).to_pylist()], BLOCK_BYTES):
                found = find_spans(texts[a:b], rules, queries, index)
                rows = [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in found]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, kinds)],
                                                 [id_col, "spans"])
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(scan, schema)
