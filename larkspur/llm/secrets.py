"""Secret scans by assignment-aware lexing, beside three fixed patterns.

The lexer reads the assignments of source code and configuration (`name = "literal"`,
`name: literal`, `"name": "literal"`, `name => 'literal'`, `table["name"] = ...`, joined literals)
into (name, literal) pairs, follows names that stand for literals assigned before, and scores each
literal by how sensitive its target's name is and by how little it looks like a word.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns of the contract.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "lexed", "flow")

#: Parts of a target's name and how sensitive they make it; a name takes the largest.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "accesskey": 0.9, "privatekey": 1.0, "credential": 0.9, "authkey": 0.9, "signingkey": 0.9,
}
_GATES = ("passw", "passphrase", "pwd", "secret", "token", "key", "credential")
_TOKEN = re.compile(
    r"""(?P<name>[A-Za-z_][\w-]*(?:\.[A-Za-z_][\w-]*)*)|(?P<quote>["'`])"""
    r"""|(?P<number>\d[\w+/.=-]*)|(?P<op>:=|=>|==|!=|<=|>=|=|:|\+)|(?P<end>[\n;,{}()])|(?P<bracket>[\[\]])|(?P<other>\S)""",
    re.A,
)
_STRINGS = {'"': re.compile(r'"(?:[^"\\\n]|\\.)*"'), "'": re.compile(r"'(?:[^'\\\n]|\\.)*'"), "`": re.compile(r"`[^`\n]*`")}
_WORD = re.compile(r"[A-Za-z0-9+/_.=-]+")
_PLACEHOLDER = re.compile(r"\s|\$\{|<[a-z_ ]+>|x{4,}|\*{3,}|example|changeme|placeholder", re.I)
_KINDS = tuple(map(re.compile, ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")))
#: Characters before a joint of literals that are looked at again for placeholders that run over it.
_JOINT = 64


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    name: str = ""
    score: float = 1.0


def sensitivity(name: str) -> float:
    flat = re.sub(r"[^a-z]", "", name.lower())
    return max((v for k, v in SENSITIVE.items() if k in flat), default=0.0)


class _Looks:
    """What a literal looks like; those of joined literals add up."""

    __slots__ = ("n", "counts", "kinds", "bad", "tail")

    def __init__(self, text: str = ""):
        self.n, self.counts, self.tail = len(text), Counter(text), text[-_JOINT:]
        self.kinds = frozenset(k for k, p in enumerate(_KINDS) if p.search(text))
        self.bad = bool(_PLACEHOLDER.search(text))

    def with_(self, text: str) -> "_Looks":
        out = _Looks.__new__(_Looks)
        out.n, out.counts = self.n + len(text), self.counts.copy()
        out.counts.update(text)
        out.kinds = self.kinds | {k for k, p in enumerate(_KINDS) if k not in self.kinds and p.search(text)}
        out.bad = self.bad or bool(_PLACEHOLDER.search(self.tail + text))
        out.tail = (self.tail + text)[-_JOINT:]
        return out

    def strength(self) -> float:
        """0 to 1: length, kinds of characters and entropy, against placeholders and words."""
        if self.n < 8 or self.bad:
            return 0.0
        entropy = -sum(c / self.n * math.log2(c / self.n) for c in self.counts.values())
        return min(1.0, 0.12 * entropy + 0.15 * len(self.kinds) + 0.01 * min(self.n, 20))


def strength(literal: str) -> float:
    return _Looks(literal).strength()


class _Log:
    """Literals in the order they were joined, on top of those of `base`.  Names stand for beginnings of it."""

    __slots__ = ("items", "at", "base", "given")

    def __init__(self, base: "_Value | None" = None):
        self.items: list[tuple[int, int, str]] = []
        self.at: dict[int, int] = {}
        self.base, self.given = base, 0


class _Value:
    """What a name stands for: the first n literals of a log.  A literal that is joined goes to the log itself, so
    a name that grows line by line copies nothing."""

    __slots__ = ("log", "n", "looks")

    def __init__(self, log: _Log, n: int, looks: _Looks):
        self.log, self.n, self.looks = log, n, looks

    def has(self, start: int) -> bool:
        value = self
        while value is not None:
            if value.log.at.get(start, value.n) < value.n:
                return True
            value = value.log.base
        return False

    def literals(self) -> list[tuple[int, int, str]]:
        parts, value = [], self
        while value is not None:
            parts.append(value.log.items[: value.n])
            value = value.log.base
        return [x for part in reversed(parts) for x in part]


def _with_literal(value: _Value | None, literal: tuple[int, int, str]) -> _Value:
    if value is None:
        log, looks = _Log(), _Looks(literal[2])
    else:
        log = value.log if len(value.log.items) == value.n else _Log(value)
        looks = value.looks.with_(literal[2])
    log.at[literal[0]] = len(log.items)
    log.items.append(literal)
    return _Value(log, len(log.items), looks)


def _joined(a: _Value, b: _Value) -> _Value:
    """The literals of a and then those of b that a has not."""
    if a.log is b.log:
        return a if a.n >= b.n else b
    for literal in b.literals():
        if not a.has(literal[0]):
            a = _with_literal(a, literal)
    return a


def base_spans(text: str) -> list[Span]:
    """Matches of the three fixed patterns; failing matches still take their characters."""
    low, out = text.lower(), []
    if any(g in low for g in ("passw", "secret", "token", "api")):
        out += [Span("assign", *m.span(), m[1]) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [Span("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    return out + [Span("hex", *m.span()) for m in _HEX.finditer(text)]


def _tokens(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(kind, text, start, end) by one pass.  A quote that its line does not close closes no later one of its
    kind either, as all of them are escaped; so a line is read for its end once."""
    at, open_until = 0, dict.fromkeys(_STRINGS, 0)
    while m := _TOKEN.search(text, at):
        kind, word, a, b = m.lastgroup, m[0], m.start(), m.end()
        if kind == "quote":
            kind = "other"
            if a >= open_until[word]:
                if string := _STRINGS[word].match(text, a):
                    kind, word, b = "string", string[0], string.end()
                else:
                    end = text.find("\n", a)
                    open_until[word] = len(text) if end < 0 else end
        yield kind, word, a, b
        at = b


def assignments(text: str) -> Iterator[tuple[str, list[tuple[str, str, int, int]]]]:
    """(name, values) of each assignment; a value is ("string" | "word", content, start, end).  Without
    values the name is given something that is no literal."""
    tokens = list(_tokens(text))
    k = 0
    while k < len(tokens):
        kind, word, _, _ = tokens[k]
        name = word if kind == "name" else word[1:-1] if kind == "string" else None
        k += 1
        if name is None or not name.strip():
            continue
        if k < len(tokens) and tokens[k][0] == "bracket" and tokens[k][1] == "]":  # table["name"]
            k += 1
        if k >= len(tokens) or tokens[k][0] != "op" or tokens[k][1] not in ("=", ":", ":=", "=>"):
            continue
        k += 1
        values, more = [], True
        while more and k < len(tokens) and tokens[k][0] in ("string", "name", "number"):
            kind, word, a, b = tokens[k]
            if kind == "string":
                values.append(("string", word[1:-1], a + 1, b - 1))
            else:  # a bare word runs on while nothing but word characters follow
                m = _WORD.match(text, a)
                b = m.end() if m else b
                values.append(("word", text[a:b], a, b))
                while k + 1 < len(tokens) and tokens[k + 1][2] < b:
                    k += 1
            k += 1
            more = k < len(tokens) and tokens[k][1] == "+" and tokens[k][0] == "op"
            k += more
        yield name, values


def lexed_spans(text: str, least: float = 0.75) -> list[Span]:
    """Literals that a sensitive name is given, directly or through names assigned before."""
    low = text.lower()
    if not any(g in low for g in _GATES):
        return []
    known: dict[str, _Value] = {}
    joins: dict[tuple[_Log, int, _Log, int], _Value] = {}
    given: list[tuple[_Value, str, str, float]] = []
    for name, values in assignments(text):
        value: _Value | None = None
        flow = False
        for kind, content, a, b in values:
            if kind == "word" and content in known:
                other = known[content]
                if value is not None:
                    key = (value.log, value.n, other.log, other.n)
                    other = joins[key] if key in joins else joins.setdefault(key, _joined(value, other))
                value, flow = other, True
            elif kind == "string" or re.search(r"\d", content):
                value = _with_literal(value, (a, b, content))
        known.pop(name, None)  # whatever the name stood for before
        if value is None:
            continue
        known[name] = value
        score = sensitivity(name) * value.looks.strength()
        if score >= least:
            given.append((value, "flow" if flow else "lexed", name, round(score, 4)))
    return _given_spans(given)


def _given_spans(given: list[tuple[_Value, str, str, float]]) -> list[Span]:
    """One span for each literal that a sensitive name was given, by the last time it was."""
    out: dict[tuple[int, int], Span] = {}
    for value, kind, name, score in reversed(given):
        at: _Value | None = value
        while at is not None and at.log.given < at.n:  # what a beginning of a log gave, it gave with all below
            for a, b, _ in at.log.items[at.log.given : at.n]:
                if b > a:
                    out.setdefault((a, b), Span(kind, a, b, name, score))
            at.log.given = at.n
            at = at.log.base
    return list(out.values())


def scan(text: str | None) -> list[Span]:
    """All spans of a text, by start and then kind; lexed spans that a base span covers are left out."""
    if not text:
        return []
    base = sorted(base_spans(text), key=lambda s: s.start)
    starts, ends = [s.start for s in base], list(accumulate((s.end for s in base), max))

    def covered(s: Span) -> bool:  # by one of the base spans that start no later
        k = bisect_right(starts, s.start)
        return k > 0 and ends[k - 1] >= s.end

    more = [s for s in lexed_spans(text) if not covered(s)]
    return sorted(base + more, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each run of overlapping spans replaced by a mark that names its first kind."""
    if not spans:
        return text
    out, at, k = [], 0, 0
    while k < len(spans):
        run = spans[k]
        while k < len(spans) and spans[k].start < max(run.end, run.start + 1):
            run = replace(run, end=max(run.end, spans[k].end))
            k += 1
        out += [text[at : run.start], f"[{run.kind} removed]"]
        at = run.end
    return "".join([*out, text[at:]])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])
SPANS = "array<struct<kind:string,start:bigint,end:bigint,name:string,score:double>>"


def found_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id and spans (kind, start, end in code points, name, score).

    Null and empty texts have no spans; each row stands by itself, so repeated rows and null ids
    are kept.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [[vars(s) for s in scan(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(_SPAN))], ["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_col)


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with its secrets replaced in the text; all rows and columns stay."""
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([redact(t, scan(t)) for t in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:at], texts, *b.columns[at + 1 :]], names)

    return docs.mapInArrow(run, docs.schema)


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin("assign", "access", "hex"))
