"""Secret scans over a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived that every matching text
satisfies. Documents are indexed in segments: postings list the documents of a segment that hold a
trigram (letters folded to lower case), only for trigrams that some rule asks for. A query intersects
and unites postings, and only its candidates are searched with the expression. A rule without
mandatory trigrams, such as a long run of hex digits, is searched everywhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import product
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

# Text of a segment, in code points, and the most alternatives kept while a query is derived.
SEGMENT = 1 << 20
MAX_STRINGS = 96

# An OR of ANDs of trigrams; the empty AND holds for every text.
Query = frozenset[frozenset[bytes]]
ANY: Query = frozenset([frozenset()])


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least`` is the fewest code points that ``group`` must have."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The rest of a private key: all up to its own END line, which no other BEGIN or END comes before; if there
# is none, PEM headers and base64 lines. A line break may be written as an escape.
_BREAK = r"(?:[\x20\t]*(?:[\r\n]|\\[nr]))+[\x20\t]*"
_TO_END = r"[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END \1PRIVATE KEY-----"
_HEADERS = rf"(?:{_BREAK}(?:Proc-Type|DEK-Info):[^\r\n\\]*)*+"
_BODY = (
    rf"(?:(?:{_BREAK}|[\x20\t]*)[A-Za-z0-9+/]{{16,}}+={{0,2}}"
    rf"|{_BREAK}[A-Za-z0-9+/]++={{0,2}}(?=[\x20\t]*(?:[\r\n\"']|\\[nr]|$)))*+"
)
# The three base kinds, then public token formats that the index adds.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("pem", rf"-----BEGIN ([A-Z ]*)PRIVATE KEY-----(?:{_TO_END}|{_HEADERS}{_BODY})"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}"),
    Rule("login", r"://[^\s/:@]+:[^\s/:@]{3,}@"),
)
BASE = ("assign", "access", "hex")


def trigram_query(pattern: str) -> Query:
    """The trigrams that a text must hold to match ``pattern``, as an OR of ANDs."""
    strings, query = _walk(parser.parse(pattern, re.ASCII))
    return query if strings is None else _both(query, _of_strings(strings))


def _walk(items: Sequence) -> tuple[frozenset[bytes] | None, Query]:
    """(all strings that the items can be, None if too many; what else must hold)."""
    query, strings, exact = ANY, frozenset([b""]), True
    for item in items:
        found, more = _item(*item)
        query = _both(query, more)
        if found is not None and len(strings) * len(found) <= MAX_STRINGS:
            strings = frozenset(a + b for a, b in product(strings, found))
        else:
            # The chain breaks here: what was collected so far must appear as a whole.
            query = _both(query, _of_strings(strings))
            strings, exact = found or frozenset([b""]), False
    return (strings, query) if exact else (None, _both(query, _of_strings(strings)))


def _item(kind, value) -> tuple[frozenset[bytes] | None, Query]:
    if kind is op.LITERAL:
        return frozenset([chr(value).lower().encode()]), ANY
    if kind is op.IN:
        points = [v for k, v in value if k is op.LITERAL]
        if len(points) == len(value):
            return frozenset(chr(v).lower().encode() for v in points), ANY
        return None, ANY
    if kind is op.SUBPATTERN:
        return _walk(value[-1])
    if kind is op.BRANCH:
        parts = [_walk(branch) for branch in value[1]]
        if all(strings is not None for strings, _ in parts):
            return frozenset().union(*(s for s, _ in parts)), ANY
        queries = [q if s is None else _both(q, _of_strings(s)) for s, q in parts]
        return None, _either(queries)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        low, high, inner = value
        strings, query = _walk(inner)
        if (low, high) == (0, 1) and strings is not None and query == ANY:
            return strings | {b""}, ANY
        if low == 0:
            return None, ANY
        if strings is not None and low == high and len(strings) == 1:
            return frozenset(s * low for s in strings), query
        return None, query if strings is None else _both(query, _of_strings(strings))
    if kind is op.AT:
        return frozenset([b""]), ANY
    return None, ANY  # any character, negated classes, look-arounds and references ask for nothing


def _of_strings(strings: frozenset[bytes]) -> Query:
    """One of the strings appears, so all of its trigrams do."""
    return _either([frozenset([frozenset(s[i : i + 3] for i in range(len(s) - 2))]) for s in strings])


def _both(a: Query, b: Query) -> Query:
    out = frozenset(x | y for x, y in product(a, b))
    return out if len(out) <= MAX_STRINGS else a


def _either(queries: Sequence[Query]) -> Query:
    every = frozenset().union(*queries)
    # An AND that contains another one adds nothing.
    out = frozenset(x for x in every if not any(y < x for y in every))
    return out if len(out) <= MAX_STRINGS else ANY


@dataclass(frozen=True)
class Plan:
    """Compiled rules: expressions, queries over trigram numbers, and the number of each trigram."""

    rules: tuple[Rule, ...]
    patterns: tuple[re.Pattern, ...]
    queries: tuple[tuple[tuple[int, ...], ...] | None, ...]
    trigrams: tuple[bytes, ...]
    numbers: np.ndarray


@lru_cache(maxsize=4)
def plan(rules: tuple[Rule, ...]) -> Plan:
    queries = [trigram_query(r.pattern) for r in rules]
    trigrams = sorted(set().union(*(t for q in queries for t in q)))
    at = {t: i for i, t in enumerate(trigrams)}
    numbers = np.zeros(1 << 24, np.uint16)  # 0: no rule asks for it
    for t, i in at.items():
        numbers[t[0] << 16 | t[1] << 8 | t[2]] = i + 1
    return Plan(
        rules,
        tuple(re.compile(r.pattern, re.ASCII) for r in rules),
        tuple(
            None if frozenset() in q else tuple(tuple(at[t] for t in sorted(x)) for x in q)
            for q in queries
        ),
        tuple(trigrams),
        numbers,
    )


class Segment:
    """The inverted index of a list of texts: sorted document numbers for every trigram asked for."""

    def __init__(self, texts: list[str], plan: Plan) -> None:
        self.plan, self.n = plan, len(texts)
        coded = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(coded).lower(), np.uint8).astype(np.uint32)
        ends = np.cumsum([len(c) for c in coded])
        self.postings = [np.empty(0, np.int64)] * len(plan.trigrams)
        if len(data) < 3:
            return
        number = plan.numbers[data[:-2] << 16 | data[1:-1] << 8 | data[2:]]
        at = np.flatnonzero(number)
        document = np.searchsorted(ends, at, side="right")
        inside = at + 2 < ends[document]
        # Sorted by trigram, then document, without repeats.
        keys = np.unique((number[at[inside]].astype(np.int64) - 1) * self.n + document[inside])
        cuts = np.searchsorted(keys, np.arange(len(plan.trigrams) + 1) * self.n)
        self.postings = [keys[a:b] - i * self.n for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]

    def candidates(self, rule: int) -> np.ndarray:
        query = self.plan.queries[rule]
        if query is None:
            return np.arange(self.n)
        found = [np.empty(0, np.int64)]
        for conjunct in query:
            lists = sorted((self.postings[t] for t in conjunct), key=len)
            both = lists[0]
            for other in lists[1:]:
                both = np.intersect1d(both, other, assume_unique=True)
            found.append(both)
        return np.unique(np.concatenate(found))


Span = tuple[int, int, int]


def spans_of(texts: list[str], plan: Plan) -> list[list[Span]]:
    """For each text its (start, rule number, end) in order: leftmost matches of each rule that do not
    overlap, in code points, without those whose group is too short."""
    index = Segment(texts, plan)
    out: list[list[Span]] = [[] for _ in texts]
    for number, (rule, pattern) in enumerate(zip(plan.rules, plan.patterns, strict=True)):
        for document in index.candidates(number).tolist():
            out[document] += [
                (m.start(), number, m.end())
                for m in pattern.finditer(texts[document])
                if m.end(rule.group) - m.start(rule.group) >= rule.least
            ]
    for spans in out:
        spans.sort()
    return out


def _segments(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch whose texts stay near ``SEGMENT`` code points."""
    texts: list[str] = []
    start = size = 0
    for i, value in enumerate(batch.column(column)):
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= SEGMENT:
            yield batch.slice(start, len(texts)), texts
            texts, start, size = [], i + 1, 0
    if texts:
        yield batch.slice(start, len(texts)), texts


SPAN = StructType().add("kind", "string").add("start", "integer").add("end", "integer")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with ``spans``: kind, start and end (code points, end exclusive) of every secret,
    ordered by start, then by the rules' order.

    One pass without a shuffle. A null text counts as the empty one and has no spans. Other columns
    are kept, one called spans is replaced, and repeated rows stay repeated.
    """
    docs = docs.drop("spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = plan(rules)
        kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            for part, texts in _segments(batch, text_col):
                found = [
                    [{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in spans]
                    for spans in spans_of(texts, ready)
                ]
                arrays = [*part.columns, pa.array(found, pa.list_(kind))]
                yield pa.RecordBatch.from_arrays(arrays, [*part.schema.names, "spans"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("spans", ArrayType(SPAN))]))


def redact_secrets(
    docs: DataFrame, mark: str = "[secret]", rules: tuple[Rule, ...] = RULES, text_col: str = "text"
) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; touching spans become one mark.

    Columns and rows are those of ``docs``; a null text stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = plan(rules)
        for batch in batches:
            for part, texts in _segments(batch, text_col):
                clean = [_cut(t, s, mark) for t, s in zip(texts, spans_of(texts, ready), strict=True)]
                at = part.schema.names.index(text_col)
                null = part.column(at).is_null().to_numpy(zero_copy_only=False)
                arrays = list(part.columns)
                arrays[at] = pa.array(clean, pa.string(), mask=null)
                yield pa.RecordBatch.from_arrays(arrays, part.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _cut(text: str, spans: list[Span], mark: str) -> str:
    pieces, at = [], 0
    for start, _, end in spans:
        if start > at or not pieces:
            pieces += [text[at:start], mark]
        at = max(at, end)
    return "".join([*pieces, text[at:]]) if pieces else text


def digest(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans string) from the spans of ``find_secrets``."""
    found = find_secrets(docs.select(F.col(id_col), "text")).drop("text")
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    base = of(*BASE)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return found.select(
        id_col,
        *counts,
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
    )
