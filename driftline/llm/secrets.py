"""Secret scan: one minimised automaton for all rules, one pass over the bytes.

The rule expressions are turned into one nondeterministic automaton, made
deterministic by subset construction, minimised, and stored as a flat transition
array over byte classes. ``Automaton.scan`` reads each byte of a text once and
learns for every rule at once where a match ends. A hit's start is found by the
rule's reversed automaton, its longest end by the rule's anchored one, both
walking only the bytes of that match.

Matches of a rule are leftmost, longest and non-overlapping; a match that the
rule's ``keep`` expression refuses is dropped, and still uses up its bytes. That
equals a backtracking search where an expression has one way to match a string
and an earlier start never ends later than a nested match begins to; the rules
below are of that kind, and the tests hold them against ``re``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _parser as sre

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import held, utf8_values

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """``scan`` finds a match, ``tail`` is added to it where it follows, and ``keep``
    must match the whole of it (None: always).

    Both are byte expressions: ASCII letters fold, nothing else does.
    """

    kind: str
    scan: bytes
    keep: bytes | None = None
    tail: bytes = b""


_ASSIGN = rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""

_PEM = rb"(?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"

# The three base rules, then well-known public key formats.
BASE_RULES = (
    Rule("assign", _ASSIGN + rb"+", _ASSIGN + rb"{8,}"),
    Rule("access", rb"AKIA[A-Z0-9]+", rb".{16,}"),
    Rule("hex", rb"[0-9a-f]{32,}"),
)
FORMAT_RULES = (
    Rule("github", rb"gh[pousr]_[A-Za-z0-9]+", rb".{40,}"),
    Rule("slack", rb"xox[abprs]-[A-Za-z0-9-]+", rb".{15,}"),
    Rule("google", rb"AIza[A-Za-z0-9_-]+", rb".{39,}"),
    # To the END line over base64, white space, its escapes and the two header lines of
    # an encrypted key; the BEGIN line alone if the block is cut off.
    Rule("pem", rb"-----BEGIN " + _PEM, tail=rb"(?:[A-Za-z0-9+/=\x20\x09-\x0D\\]|Proc-Type:\x20[A-Z0-9,]+"
         rb"|DEK-Info:\x20[A-Z0-9,-]+[\x0D\x0A\\])*-----END " + _PEM),
)
RULES = BASE_RULES + FORMAT_RULES


class _Nfa:
    """Thompson automaton over bytes: edges[state] = [(byte set or None, target)]."""

    def __init__(self) -> None:
        self.edges: list[list[tuple[frozenset[int] | None, int]]] = []

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def edge(self, a: int, chars: frozenset[int] | None, b: int) -> None:
        self.edges[a].append((chars, b))

    def add(self, items, start: int, fold: bool) -> int:
        for op, arg in items:
            start = self._one(str(op), arg, start, fold)
        return start

    def _one(self, op: str, arg, a: int, fold: bool) -> int:
        if op in ("LITERAL", "IN", "ANY", "NOT_LITERAL"):
            b = self.state()
            self.edge(a, _chars(op, arg, fold), b)
            return b
        if op == "SUBPATTERN":
            _, on, off, inner = arg
            return self.add(inner, a, (fold or bool(on & re.I)) and not off & re.I)
        if op == "BRANCH":
            b = self.state()
            for inner in arg[1]:
                self.edge(self.add(inner, a, fold), None, b)
            return b
        if op == "MAX_REPEAT":
            low, high, inner = arg
            for _ in range(low):
                a = self.add(inner, a, fold)
            if high is sre.MAXREPEAT:
                loop, out = self.state(), self.state()
                self.edge(a, None, loop)
                self.edge(self.add(inner, loop, fold), None, loop)
                self.edge(loop, None, out)
                return out
            out = self.state()
            for _ in range(high - low):
                self.edge(a, None, out)
                a = self.add(inner, a, fold)
            self.edge(a, None, out)
            return out
        raise ValueError(f"rules do not support {op}")

    def reversed(self) -> _Nfa:
        back = _Nfa()
        back.edges = [[] for _ in self.edges]
        for a, out in enumerate(self.edges):
            for chars, b in out:
                back.edge(b, chars, a)
        return back


def _chars(op: str, arg, fold: bool) -> frozenset[int]:
    if op == "ANY":
        return frozenset(range(256)) - {10}
    items = [("LITERAL", arg)] if op == "LITERAL" else [("NEGATE", None), ("LITERAL", arg)] \
        if op == "NOT_LITERAL" else [(str(o), x) for o, x in arg]
    got: set[int] = set()
    for o, x in items:
        if o == "LITERAL":
            got.add(x)
        elif o == "RANGE":
            got.update(range(x[0], x[1] + 1))
        elif o != "NEGATE":
            raise ValueError(f"rules do not support {o}")
    if fold:
        got |= {c ^ 32 for c in got if chr(c).isascii() and chr(c).isalpha()}
    return frozenset(range(256)) - got if items[0][0] == "NEGATE" else frozenset(got)


@dataclass(frozen=True)
class _Dfa:
    """Transition array: next state = table[state + class of byte]; states are
    multiples of ``width``; 0 is the start; ``accepts[state // width]`` is the set
    of rules that end there; ``dead`` can reach no accepting state (-1: none)."""

    classes: bytes
    width: int
    table: list[int]
    accepts: list[tuple[int, ...]]
    dead: int


def _closure(nfa: _Nfa, states) -> frozenset[int]:
    seen, todo = set(states), list(states)
    while todo:
        for chars, b in nfa.edges[todo.pop()]:
            if chars is None and b not in seen:
                seen.add(b)
                todo.append(b)
    return frozenset(seen)


def _determinise(nfa: _Nfa, starts, ends: dict[int, int]) -> _Dfa:
    """Subset construction, then minimisation by partition refinement."""
    sets = {c for out in nfa.edges for c, _ in out if c is not None}
    signature = [tuple(byte in s for s in sets) for byte in range(256)]
    numbers = {s: i for i, s in enumerate(dict.fromkeys(signature))}
    width, sample = len(numbers), [signature.index(s) for s in numbers]
    first = _closure(nfa, starts)
    index, order, rows = {first: 0}, [first], []
    for subset in order:
        row = []
        for byte in sample:
            to = _closure(nfa, {b for a in subset for chars, b in nfa.edges[a]
                                if chars is not None and byte in chars})
            if to not in index:
                index[to] = len(order)
                order.append(to)
            row.append(index[to])
        rows.append(row)
    accept = [tuple(sorted({ends[s] for s in subset if s in ends})) for subset in order]
    block, n = [0] * len(order), 0
    keys: list = list(accept)
    while len(set(keys)) != n:
        n = len(set(keys))
        names = {k: i for i, k in enumerate(dict.fromkeys(keys))}
        block = [names[k] for k in keys]
        keys = [(block[i], *(block[t] for t in row)) for i, row in enumerate(rows)]
    table, accepts = [0] * (n * width), [()] * n
    for i, row in enumerate(rows):
        accepts[block[i]] = accept[i]
        table[block[i] * width:(block[i] + 1) * width] = [block[t] * width for t in row]
    dead = [b for b in range(n) if not accepts[b]
            and set(table[b * width:(b + 1) * width]) == {b * width}]
    return _Dfa(bytes(numbers[s] for s in signature), width, table, accepts,
                dead[0] * width if dead else -1)


class Automaton:
    """All rules compiled: one search automaton, and per rule an anchored and a
    reversed one."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.keep = [re.compile(r.keep, re.S).fullmatch if r.keep else None for r in rules]
        self.forward, self.backward = [], []
        joint, ends = _Nfa(), {}
        root = joint.state()
        joint.edge(root, frozenset(range(256)), root)
        for k, rule in enumerate(rules):
            parsed = sre.parse(rule.scan)
            ends[joint.add(parsed, root, False)] = k
            one = _Nfa()
            start = one.state()
            end = one.add(parsed, start, False)
            self.backward.append(_determinise(one.reversed(), {end}, {start: k}))
            longer = one.add(sre.parse(rule.tail), end, False)
            self.forward.append(_determinise(one, {start}, {end: k, longer: k}))
        self.search = _determinise(joint, {root}, ends)
        self.hit = [bool(a) for a in self.search.accepts for _ in range(self.search.width)]
        if self.search.accepts[0]:
            raise ValueError("a rule matches the empty string")

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, end, rule) of every kept match, byte offsets, by start then rule."""
        dfa = self.search
        table, width, accepts, hit = dfa.table, dfa.width, dfa.accepts, self.hit
        done = [0] * len(self.rules)
        found = []
        state = 0
        for at, byte in enumerate(data.translate(dfa.classes)):
            state = table[state + byte]
            if hit[state]:
                for k in accepts[state // width]:
                    if at >= done[k]:
                        start = self._longest(self.backward[k], data, at, done[k] - 1, -1)
                        if start is None:
                            continue
                        end = self._longest(self.forward[k], data, start, len(data), 1) + 1
                        done[k] = end
                        keep = self.keep[k]
                        if keep is None or keep(data, start, end):
                            found.append((start, end, k))
        found.sort(key=lambda x: (x[0], x[2]))
        return found

    @staticmethod
    def _longest(dfa: _Dfa, data: bytes, at: int, stop: int, step: int) -> int | None:
        """The last position of the longest match that begins at ``at``."""
        state, last = 0, None
        for i in range(at, stop, step):
            state = dfa.table[state + dfa.classes[data[i]]]
            if dfa.accepts[state // dfa.width]:
                last = i
            elif state == dfa.dead:
                break
        return last

    def spans(self, data: bytes) -> list[tuple[str, int, int]]:
        """Kept matches as (kind, start, end) in code points, end exclusive."""
        found = self.scan(data)
        if not found:
            return []
        marks = sorted({p for s, e, _ in found for p in (s, e)})
        points, at, seen = {}, 0, 0
        for p in marks:  # matches begin and end at ASCII bytes
            seen += len(data[at:p].decode("utf-8", "replace"))
            points[p], at = seen, p
        return [(self.rules[k].kind, points[s], points[e]) for s, e, k in found]


def automaton(rules: tuple[Rule, ...] = RULES) -> Automaton:
    """The compiled rules; compiled once per Python worker."""
    return held(("secrets", rules), lambda: Automaton(rules))


def find_secrets(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Spans of all secrets of a text column as array<struct<kind, start, end>>,
    by start and then in rule order; offsets in code points, end exclusive.

    Null and empty texts give an empty array. Whole texts are scanned; a row is
    handled alone, so neither long texts, repeated rows nor hot sources meet.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    @F.arrow_udf(SPAN_TYPE)
    def spans(texts: pa.Array) -> pa.Array:
        scan = automaton(rules).spans
        return pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in scan(t)]
                         for t in utf8_values(texts)], type=kind)

    return spans(text)


def scan_documents(df: DataFrame, text_col: str = "text", out_col: str = "secrets",
                   rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with the spans in ``out_col`` (a column of that name is replaced)."""
    return df.withColumn(out_col, find_secrets(F.col(text_col), rules))


def redact(df: DataFrame, text_col: str = "text", mark: str = "[secret]",
           rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with every span of its text replaced by ``mark``; spans that overlap
    are replaced together. Texts without secrets, and null, stay as they are."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array) -> pa.Array:
        scan, out, sign = automaton(rules).scan, [], mark.encode()
        for value, data in zip(texts, utf8_values(texts), strict=True):
            found = scan(data)
            if not found:
                out.append(value.as_py())
                continue
            parts, at = [], 0
            for start, end, _ in found:
                if start >= at:
                    parts += [data[at:start], sign]
                at = max(at, end)
            out.append(b"".join([*parts, data[at:]]).decode("utf-8", "replace"))
        return pa.array(out, type=pa.string())

    return df.withColumn(text_col, cut(F.col(text_col)))
