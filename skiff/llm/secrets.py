"""Secret scan: fixed patterns plus assignment-aware lexing.

The base spans are the matches of three patterns. The lexer then reads source and
configuration syntax into (name, literals) pairs - ``name = "a" + other``,
``key: value``, ``"key": "value"``, ``name => 'value'``, ``${other}`` inside a literal -,
propagates literals through names that are assigned once or more (the last assignment
before the use counts), and scores each literal by the most sensitive name it reaches
and by its look. Literals that reach THRESHOLD become spans of kind ``lexed``; the base
spans stay as they are.

Positions are code points, ends exclusive. Null or empty text: no spans, the digest of the
empty string. Rows are independent, so repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

# The base patterns, least lengths, and the order of kinds.
KINDS = ("assign", "access", "hex", "lexed")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

# Parts of names and how much they tell of a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "privatekey": 1.0, "accesskey": 0.9, "credential": 0.8, "credentials": 0.8,
    "bearer": 0.7, "auth": 0.5, "signature": 0.4, "key": 0.4, "dsn": 0.4, "salt": 0.4,
}
# Literals that stand for a secret without being one.
PLACEHOLDER = re.compile(
    r"(?i)^(changeme|change_me|example|sample|test|dummy|none|null|true|false|password|secret|token"
    r"|todo|redacted|your[-_ ].*|my[-_ ].*|x{3,}|\*+|<.*>|\.+|\{\{.*\}\})$")
THRESHOLD = 0.9

_STRING = r""""(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'"""
_NAME = r"[A-Za-z_$][\w$.-]*"
_PAIR = re.compile(
    rf"""(?<![\w$.-])(?P<q>["']?)(?P<name>{_NAME})(?P=q)[ \t]*(?P<op>:=|=>|=(?![=>~])|:(?![:/]))[ \t]*"""
    rf"""(?P<expr>(?:{_STRING}|[A-Za-z0-9_$][\w$.+/=-]*)(?:[ \t]*(?:\+|\.\.)[ \t]*(?:{_STRING}|{_NAME}))*)""", re.A)
_TERM = re.compile(rf"(?P<str>{_STRING})|(?P<bare>[A-Za-z0-9_$][\w$.+/=-]*)", re.A)
_INSIDE = re.compile(r"\$\{?([A-Za-z_]\w*)\}?", re.A)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", re.A)


def name_score(name: str) -> float:
    """How sensitive a name is: its camel, snake or dotted parts, alone or two joined."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    return max([SENSITIVE.get(p, 0.0) for p in [*parts, *map("".join, zip(parts, parts[1:]))]], default=0.0)


def literal_score(value: str) -> float:
    """How much a literal looks like a secret: length, entropy and mixture of characters."""
    if len(value) < 6 or PLACEHOLDER.match(value) or " " in value:
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    classes = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit)) + (not value.isalnum())
    return min(1.0, entropy / 4.0) * 0.7 + min(0.3, 0.1 * classes)


def lex(text: str) -> list[tuple[int, int]]:
    """Spans of literals that sensitive names receive, directly or through other names."""
    held: dict[str, list[tuple[int, int]]] = {}
    found: dict[tuple[int, int], float] = {}
    for m in _PAIR.finditer(text):
        spans: list[tuple[int, int]] = []
        for t in _TERM.finditer(text, m.start("expr"), m.end("expr")):
            a, b = t.span()
            if t["str"] is not None:
                spans.append((a + 1, b - 1))
                for v in _INSIDE.finditer(text, a + 1, b - 1):
                    spans += held.get(v[1], [])
            elif t["bare"] in held:
                spans += held[t["bare"]]
            else:
                spans.append((a, b))
        spans = list(dict.fromkeys(spans))
        held[m["name"]] = spans
        if score := name_score(m["name"]):
            for s in spans:
                found[s] = max(found.get(s, 0.0), score)
    return sorted(s for s, score in found.items()
                  if score + literal_score(text[s[0] : s[1]]) * 0.6 >= THRESHOLD and literal_score(text[s[0] : s[1]]) > 0)


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans) as (start, kind's number, end), in order."""
    base: list[tuple[int, int, int]] = []
    assigns = "=" in text or ":" in text
    if assigns:
        base += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    base += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    base.sort()
    more = [(a, 3, b) for a, b in lex(text)] if assigns else []
    return base, sorted(base + more) if more else base


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts, digest of the base spans, all spans."""

    def run(batches):
        for batch in batches:
            got = [scan(t or "") for t in batch.column(1).to_pylist()]
            count = lambda k: pa.array([sum(s[1] == k for s in b) for b, _ in got], pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_assign": count(0), "n_access": count(1), "n_hex": count(2),
                "base_sha256": pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b, _ in got]),
                "spans": pa.array([written(s) for _, s in got]),
            })

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def redact_text(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span (overlapping ones joined) replaced by ``mark``."""
    out, at, end = [], 0, -1
    for a, _, b in scan(text)[1]:
        if a >= end:
            if end >= 0:
                out.append(mark)
            out.append(text[at if end < 0 else end : a])
        end = max(end, b)
    if end < 0:
        return text
    return "".join([*out, mark, text[end:]])


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets in ``text`` replaced (and n_chars, where it is a column, counted
    anew for the texts that change); all other columns and null texts stay."""
    names = docs.columns
    at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(batches):
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [None if t is None else redact_text(t, mark) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.column(at).type)
            if size >= 0:
                counts = zip(batch.column(size).to_pylist(), old, new)
                columns[size] = pa.array([n if a == b else len(b) for n, a, b in counts], batch.column(size).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, docs.schema)
