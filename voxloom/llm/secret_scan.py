"""Secrets in texts, found through a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived: whatever the expression matches
must contain the trigrams the query asks for. Texts are indexed block by block; in a block, the postings of the
queried trigrams are intersected and united as the query says, and only the texts left are searched with the
expression. A rule without mandatory trigrams searches every text.

Index blocks hold about a megabyte of text and never leave their task, so nothing is shuffled and no list of
postings grows with the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import product
from re import _constants as op
from re import _parser as parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import bound_batches, carry
from .hashing import lower_ascii, text_blocks


class Rule(NamedTuple):
    """A match counts if its ``group`` has ``least`` characters or more.

    ``tail``, an expression that may match nothing, is what belongs to the secret behind the match.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    tail: str = ""


# The three rules every scan has. The length of a run of one class is part of the expression for
# the third, where it selects the same runs.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)

# The rest of a PEM key: all up to its END line, or, if another key or the text ends before that, up to the last line
# of base64. A line break may be written as an escape, lines may be indented or quoted, and fields may stand first.
_BREAK, _LEAD, _TRAIL = r"""(?:\r?\n|\r|(?:\\r)?\\n)""", r"""[\x20\t>|#*"']*+""", r"""[\x20\t"',;]*+"""
_ENDS = rf"{_TRAIL}(?={_BREAK}|\Z)"
_KEY_BODY = (
    r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z ]{0,20}PRIVATE KEY-----"
    r"|(?:[\x20\t]*[A-Za-z0-9+/=]{16,})*+"
    rf"(?:{_TRAIL}{_BREAK}{_LEAD}(?:Proc-Type|DEK-Info|Comment|X-[A-Za-z-]+):[^\r\n]*)*+"
    rf"(?:{_TRAIL}(?:{_BREAK}{_LEAD})++[A-Za-z0-9+/=]++{_ENDS})*+)"
)

# Published layouts of well-known credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", tail=_KEY_BODY),
    Rule("code_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed_claims", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)

RULES = BASE_RULES + MORE_RULES

# A query is a trigram, or ("and" | "or", parts); an empty "and" is true.
TRUE = ("and", ())
_MOST_STRINGS, _LONGEST, _MOST_CHARS = 64, 32, 8


def _all_of(parts: Sequence) -> tuple:
    kept = [p for p in parts if p != TRUE]
    return kept[0] if len(kept) == 1 else ("and", tuple(dict.fromkeys(kept)))


def _any_of(parts: Sequence) -> tuple:
    if any(p == TRUE for p in parts):
        return TRUE
    unique = tuple(dict.fromkeys(parts))
    return unique[0] if len(unique) == 1 else ("or", unique)


def _grams(strings: set[str]) -> tuple:
    """One of the strings occurs: any of (all of its trigrams)."""

    def one(text: str) -> tuple:
        raw = text.encode().lower()
        return _all_of([raw[k : k + 3] for k in range(len(raw) - 2)])

    return _any_of([one(s) for s in sorted(strings)])


def _chars(items: Sequence) -> set[str] | None:
    """The characters of a small class, in lower case; None for a large or negated one."""
    out: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < _MOST_CHARS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= _MOST_CHARS else None


def _node(kind, value) -> tuple[set[str] | None, tuple]:
    """(all strings the node can match if they are few, the query its matches fulfil)."""
    if kind is op.LITERAL:
        return {chr(value).lower()}, TRUE
    if kind is op.IN:
        return _chars(value), TRUE
    if kind is op.SUBPATTERN:
        return _sequence(value[3])
    if kind is op.BRANCH:
        parts = [_sequence(part) for part in value[1]]
        if all(strings is not None for strings, _ in parts):
            joined = set().union(*[strings for strings, _ in parts])
            if len(joined) <= _MOST_STRINGS:
                return joined, TRUE
        return None, _any_of([query if strings is None else _grams(strings) for strings, query in parts])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        least, most, inner = value
        strings, query = _sequence(inner)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, TRUE
        if least == 0:
            return None, TRUE
        return None, query if strings is None else _grams(strings)
    if kind is op.AT or kind in (op.ASSERT, op.ASSERT_NOT):
        return {""}, TRUE
    return None, TRUE


def _sequence(nodes) -> tuple[set[str] | None, tuple]:
    """Strings of neighbouring nodes are joined while they stay few; where they end, their trigrams are asked for."""
    current, parts, whole = {""}, [], True
    for kind, value in nodes:
        strings, query = _node(kind, value)
        if strings is not None and len(current) * len(strings) <= _MOST_STRINGS:
            joined = {a + b for a, b in product(current, strings)}
            if max(map(len, joined), default=0) <= _LONGEST:
                current = joined
                continue
        parts.append(_grams(current))
        parts.append(query if strings is None else TRUE)
        current, whole = (strings if strings is not None else {""}), False
    if whole:
        return current, TRUE
    return None, _all_of([*parts, _grams(current)])


def trigram_query(pattern: str) -> tuple:
    """What every match of the expression must contain, as a Boolean query over lower-case byte trigrams."""
    strings, query = _sequence(parser.parse(pattern, re.ASCII))
    return query if strings is None else _grams(strings)


def query_trigrams(query) -> set[bytes]:
    return {query} if isinstance(query, bytes) else set().union(*[query_trigrams(q) for q in query[1]])


def _index(data: np.ndarray, offsets: np.ndarray, number: np.ndarray) -> dict[int, np.ndarray]:
    """Postings of a block: number of a queried trigram to the ascending rows that contain it."""
    if len(data) < 3:
        return {}
    low = lower_ascii(data).astype(np.int32)
    found = number[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
    at = np.flatnonzero(found)
    row = np.searchsorted(offsets, at, "right") - 1
    inside = at + 2 < offsets[row + 1]
    pairs = np.unique(found[at[inside]].astype(np.int64) << 32 | row[inside])
    grams, rows = pairs >> 32, pairs & 0xFFFFFFFF
    cuts = np.flatnonzero(np.diff(grams)) + 1
    return {int(g[0]): r for g, r in zip(np.split(grams, cuts), np.split(rows, cuts)) if len(g)}


def _candidates(query, postings: dict[int, np.ndarray], numbers: dict[bytes, int], rows: int) -> np.ndarray:
    if isinstance(query, bytes):
        return postings.get(numbers[query], np.zeros(0, np.int64))
    if query == TRUE:
        return np.arange(rows)
    lists = sorted((_candidates(q, postings, numbers, rows) for q in query[1]), key=len, reverse=query[0] == "or")
    out = lists[0]
    for other in lists[1:]:
        out = np.union1d(out, other) if query[0] == "or" else np.intersect1d(out, other, assume_unique=True)
    return out


def _scanner(rules: Sequence[Rule]):
    """A function from an array of texts to the list of (start, rule number, end, secret) of each."""
    expressions = [re.compile(r.pattern, re.ASCII) for r in rules]
    tails = [re.compile(r.tail, re.ASCII) if r.tail else None for r in rules]
    queries = [trigram_query(r.pattern) for r in rules]
    numbers = {g: k for k, g in enumerate(sorted(set().union(*map(query_trigrams, queries))), 1)}
    number = np.zeros(1 << 24, np.uint16)
    for gram, k in numbers.items():
        number[int.from_bytes(gram, "big")] = k

    def scan(texts: pa.Array) -> Iterator[tuple[str, list[tuple[int, int, int, str]]]]:
        for low, high, data, offsets in text_blocks(texts):
            postings = _index(data, offsets, number)
            found: list[list] = [[] for _ in range(high - low)]
            raw = data.tobytes()
            whole = [raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])]
            for k, (rule, expression) in enumerate(zip(rules, expressions)):
                for row in _candidates(queries[k], postings, numbers, high - low):
                    for m in expression.finditer(whole[row]):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            more = tails[k] and tails[k].match(whole[row], m.end())
                            rest = more.group() if more else ""
                            found[row].append((m.start(), k, m.end() + len(rest), m.group(rule.group) + rest))
            for text, spans in zip(whole, found):
                spans.sort()
                yield text, spans

    return scan


SECRETS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("secret", T.StringType()),
        ]
    )
)
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("secret", pa.string())]))


def find_secrets(
    df: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", rules: Sequence[Rule] = RULES, out: str = "secrets"
) -> DataFrame:
    """The columns ``keep`` of every row, with its secrets as ``out``: kind, start, end and the secret itself.

    Positions are code points of the whole text, the end exclusive. Secrets are in order of start, then of the
    rules. Per rule, matches are leftmost and do not overlap. A null or empty text has none. A column of ``keep``
    named like ``out`` is replaced.
    """
    rules = tuple(rules)
    keep = [c for c in keep if c != out]
    schema = T.StructType([*df.select(*keep).schema.fields, T.StructField(out, SECRETS)])
    texts, at = carry(df, keep, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(rules)
        for batch in batches:
            rows = [
                [{"kind": rules[k].kind, "start": a, "end": b, "secret": s} for a, k, b, s in spans]
                for _, spans in scan(batch.column(at))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(rows, _ARROW)], [*keep, out])

    return texts.mapInArrow(run, schema)


def redact(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """The same rows and columns, every secret of the text replaced by ``mark``; overlapping ones by a single mark.

    A null text stays null. Text outside secrets is untouched.
    """
    bound_batches(df.sparkSession)
    rules = tuple(rules)
    at = df.columns.index(text)
    names = df.columns

    def clean(whole: str, spans: list[tuple[int, int, int, str]]) -> str:
        pieces, reached = [], 0
        for start, _, end, _ in spans:
            if start >= reached:
                pieces += [whole[reached:start], mark]
            reached = max(reached, end)
        return "".join([*pieces, whole[reached:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _scanner(rules)
        for batch in batches:
            column = batch.column(at)
            cleaned = [clean(whole, spans) if spans else whole for whole, spans in scan(column)]
            known = column.is_valid().to_pylist()
            columns = list(batch.columns)
            columns[at] = pa.array([c if k else None for c, k in zip(cleaned, known)], column.type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return df.mapInArrow(run, df.schema)
