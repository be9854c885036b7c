"""Secret scans: assignment-aware lexing on top of three base patterns.

Base spans (``assign``, ``access``, ``hex``) are regular-expression matches over
the whole text. The lexer then reads ``name = value`` pairs in source and
configuration syntax (``=``, ``:``, ``:=``, ``=>``; quoted or bare names and
values; values joined by ``+`` or ``.``), in text order. A type may stand between
name and ``=`` (``name: type =``, ``name As Type =``, ``name string =``, ``name[] =``),
and ``a = b = value`` is a pair for every name. A value that names an earlier pair, or else a later one, takes that pair's literals (constants are propagated, with an
alias counted once), so a literal is judged by every name it reaches. Its score
is the weight of the most sensitive of those names times the literal's
strength; from ``THRESHOLD`` on it is a ``named`` span, unless a base span
already covers it.

Positions are code points, ends exclusive. Null and empty texts have no span.
Repeated rows give repeated rows; extra columns are carried along by ``redact``
and ignored by ``scan``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fareseg.llm.common import by_batch

# The base kinds in their order, patterns and least lengths.
KINDS = ["assign", "access", "hex", "named"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs, so the same as runs filtered by length
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

#: How strongly a part of a target name says that its value is a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "pass": 0.8, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "credential": 0.9, "credentials": 0.9, "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "secretkey": 1.0,
    "authkey": 1.0, "auth": 0.7, "bearer": 0.9, "private": 0.6, "key": 0.6, "signature": 0.6, "salt": 0.6, "pin": 0.5,
    "session": 0.5, "cookie": 0.5,
}
THRESHOLD = 0.45
#: Literals that are joined and judged as one at most; a longer sum's are judged as they stand in the pairs behind it.
JOINED = 64

# A name is a whole run of its characters, so that each run is read once however long it is.
_NAME = r"(?<![A-Za-z0-9_.\-])[0-9.\-]*+(?P<name>[A-Za-z_][A-Za-z0-9_.\-]*+)"
_VALUE = (r"""(?P<value>(?:"[^"\n]*"|'[^'\n]*'|[A-Za-z0-9_+/$][^\s"'`,;(){}\[\]<>]*)"""
          r"""(?:[ \t]*[+.][ \t]*(?:"[^"\n]*"|'[^'\n]*'|[A-Za-z_]\w*))*)""")


def _nested(a: str, b: str, depth: int = 3) -> str:
    inner = rf"[^\{a}\{b}\n=]*+"
    return rf"\{a}{inner}" + (rf"(?:{_nested(a, b, depth - 1)}{inner})*+" if depth > 1 else "") + rf"\{b}"


_TYPE = (r"""(?:"[^"\n]*"|'[^'\n]*'|(?:&(?:'\w+[ \t]+)?|\*|\?|(?:mut|dyn|impl|inout|readonly|constant|unique|keyof|typeof)[ \t]+)*"""
         rf"(?:[A-Za-z_][A-Za-z0-9_.]*+(?:::[A-Za-z_]\w*+)*+|{_nested('[', ']')}|{_nested('(', ')')})"
         rf"(?:{_nested('<', '>')}|{_nested('[', ']')})*+[?!]*+)")
_PAIR = re.compile(
    rf"""(?P<q>["']?){_NAME}(?P=q)(?:(?:[?!]?[ \t]*:[ \t]*(?P<type>{_TYPE}(?:[ \t]*[|&][ \t]*{_TYPE})*+)"""
    r"""|[ \t]+(?:As[ \t]+[A-Za-z_][\w.]*+|\*?(?:\[\])?(?:string|byte|rune|any)\b)|(?:\[\d*\])++)[ \t]*:?=(?![=>])"""
    rf"""|[ \t]*(?P<op>:=|=>|=(?!=)|:(?![:/])))[ \t]*{_VALUE}""", re.A)
_VALUE_AT = re.compile(_VALUE, re.A)
_LINK = re.compile(r"\$?(?P<name>[A-Za-z_][A-Za-z0-9_.\-]*+)(?P<gap>[ \t]*+)=(?![=>])[ \t]*+", re.A)
_TIGHT = re.compile(r"\$?([A-Za-z_][A-Za-z0-9_.\-]*+)=(?![=>])", re.A)
_NAMELIKE = re.compile(r"[^0-9]*[0-9]{0,3}[^0-9A-Za-z]*")
_ATOM = re.compile(r""""([^"\n]*)"|'([^'\n]*)'|([^\s"'+]+(?:\+[^\s"'+]+)*)""")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def name_weight(name: str) -> float:
    """The weight of the name's most sensitive part, two neighbouring parts also read as one word."""
    parts = [p.lower() for p in _PARTS.findall(name)]
    both = ["".join(p) for p in zip(parts, parts[1:])]
    return max([SENSITIVE.get(p, 0.0) for p in parts + both], default=0.0)


def strength(literal: str) -> float:
    """0 to 1: entropy of the characters times length, none for words, paths and place-holders."""
    n = len(literal)
    if n < 8 or literal.isalpha() and (literal.islower() or literal.istitle() or literal.isupper()):
        return 0.0
    if literal[:2] in ("${", "$(", "{{", "<%") or literal.startswith(("http:", "https:", "/")) or " " in literal:
        return 0.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    kinds = sum((any(c.islower() for c in literal), any(c.isupper() for c in literal), any(c.isdigit() for c in literal),
                 any(not c.isalnum() for c in literal)))
    return min(1.0, entropy / 3.2) * min(1.0, n / 12) * (0.4 if kinds < 2 else 1.0)


def _chain(text: str, at: int) -> tuple[list[str], list[tuple[int, int]], int]:
    """The names of ``b = c = value`` from ``at`` on, the spans among them that may as well be literals, and where the value starts."""
    names, words = [], []
    while m := _LINK.match(text, at):
        if not m["gap"]:  # b=c="literal"; without the quote it is one bare value
            run, end = [], at
            while t := _TIGHT.match(text, end):
                run.append(t[1])
                end = t.end()
            start = end
            while text[start:start + 1] in (" ", "\t"):
                start += 1
            if text[start:start + 1] in ('"', "'") and _VALUE_AT.match(text, start):
                return names + run, [*words, (at, end)], start
            break
        if not _VALUE_AT.match(text, m.end()):
            break
        names.append(m["name"])
        if not _NAMELIKE.fullmatch(m["name"]):
            words.append((at, m.end("name")))
        at = m.end()
    return names, words, at


class _Pair(NamedTuple):
    """The names of one value, the greatest weight of them, and its parts: start, end and, for a bare word, the word."""

    names: list[str]
    weight: float
    parts: list[tuple[int, int, str | None]]


def _targets(pairs: list[_Pair]) -> list[list[int | None]]:
    """For every part the pair it stands for. A bare word that is a name stands for that name's last pair before, or else its first one after."""
    where: dict[str, list[int]] = {}
    for i, p in enumerate(pairs):
        for name in dict.fromkeys(p.names):
            where.setdefault(name, []).append(i)

    def target(word: str | None, i: int) -> int | None:
        at = where.get(word) if word is not None else None
        if at is None:
            return None
        k = bisect_left(at, i)
        if k:
            return at[k - 1]
        k += at[k:k + 1] == [i]
        return at[k] if k < len(at) else None

    return [[target(word, i) for _, _, word in p.parts] for i, p in enumerate(pairs)]


def _resolved(pairs: list[_Pair]) -> list[tuple[float, list[tuple[int, int]]]]:
    """Weights and the literals that they judge as one: every pair's, names replaced by what they stand for.

    A pair with more than ``JOINED`` literals (a string that a program adds up)
    keeps only those written in it; its weight goes on to the pairs behind its
    names and judges what is written in each of them, so that long accumulations
    take linear time and memory.
    """
    aims = _targets(pairs)
    done: list[list[tuple[int, int]] | None] = [None] * len(pairs)
    begun, long = [False] * len(pairs), [False] * len(pairs)
    written: list[list[tuple[int, int]]] = [[] for _ in pairs]
    for first in range(len(pairs)):
        todo = [first]
        while todo:
            i = todo[-1]
            if done[i] is None:
                wait = [] if begun[i] else [j for j in dict.fromkeys(aims[i]) if j is not None and done[j] is None and not begun[j]]
                begun[i] = True
                if wait:
                    todo += wait
                    continue
                got: dict[tuple[int, int], None] = {}
                own = written[i]
                for (s, e, _), j in zip(pairs[i].parts, aims[i]):
                    # names that only lead to each other are words
                    if j is None or done[j] is None:
                        own.append((s, e))
                        got[s, e] = None
                    elif long[j]:
                        long[i] = True
                    elif not long[i]:
                        got.update(dict.fromkeys(done[j]))
                        long[i] = len(got) > JOINED
                done[i] = own if long[i] else list(got)
            todo.pop()
    out = [(p.weight, x) for p, x in zip(pairs, done)]
    # heaviest first, a pair is passed once: with the heaviest name that leads to it
    passed = [False] * len(pairs)
    for first in sorted((i for i in range(len(pairs)) if long[i]), key=lambda i: -pairs[i].weight):
        todo = [first]
        while todo:
            i = todo.pop()
            if not passed[i]:
                passed[i] = True
                out.append((pairs[first].weight, written[i]))
                todo += [j for j in dict.fromkeys(aims[i]) if j is not None and not passed[j]]
    return out


def named_spans(text: str) -> list[tuple[int, int, float]]:
    """``(start, end, score)`` of literals whose score reaches the threshold."""
    if "=" not in text and ":" not in text:
        return []
    pairs: list[_Pair] = []
    best: dict[tuple[int, int], float] = {}

    def judge(weight: float, literals: list[tuple[int, int]]) -> None:
        if weight:
            score = weight * strength("".join(text[s:e] for s, e in literals))  # joined pieces count as one literal
            for s in literals:
                best[s] = max(best.get(s, 0.0), score)

    at = 0
    while m := _PAIR.search(text, at):
        names, words, start = [m["name"]], [], m.start("value")
        weight = name_weight(m["name"])
        if m["type"] is not None:
            if m["type"][0].islower():  # { password: pwd = "..." }
                weight = max(weight, name_weight(m["type"]))
            if not _NAMELIKE.fullmatch(m["type"]):
                words.append(m.span("type"))
        if m["op"] != ":":
            more, also, start = _chain(text, start)
            names += more
            words += also
            weight = max([weight, *map(name_weight, more)])
        for s, e in words:
            judge(weight, [(s, e)])
        value = _VALUE_AT.match(text, start)
        at = value.end()
        parts: list[tuple[int, int, str | None]] = []
        for a in _ATOM.finditer(value["value"]):
            k = a.lastindex
            word = a[k].rstrip(".:!?") if k == 3 else a[k]
            parts.append((start + a.start(k), start + a.start(k) + len(word), a[k] if k == 3 else None))
        pairs.append(_Pair(names, weight, parts))
    for weight, literals in _resolved(pairs):
        judge(weight, literals)
    return [(s, e, w) for (s, e), w in best.items() if w >= THRESHOLD and e > s]


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """All spans by start, then kind as listed, then end."""
    base = base_spans(text)
    more = [(s, e, "named") for s, e, _ in named_spans(text) if not any(a <= s and e <= b for a, b, _ in base)]
    return sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def mask(text: str, spans: list[tuple[int, int, str]], sign: str = "[SECRET]") -> str:
    """The text with every run of overlapping spans replaced by ``sign``."""
    out, at, end = [], 0, -1
    for s, e, _ in spans:
        if s >= end:
            out += [text[at:s], sign] if s >= at else []
        end = max(end, e)
        at = end
    return "".join([*out, text[at:]])


SPANS_SQL = "array<struct<start:long,end:long,kind:string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans``, an array of (start, end, kind), for every row."""
    def kernel(b):
        spans = [find_spans(t.as_py()) if t.is_valid else [] for t in b.column(1)]
        found = pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in spans], _SPANS)
        return pa.RecordBatch.from_arrays([b.column(0), found], [key, "spans"])

    schema = docs.select(key, F.lit(None).cast(SPANS_SQL).alias("spans")).schema
    return docs.select(key, text).mapInArrow(by_batch(kernel), schema)


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The same columns with secrets masked in ``text`` and ``length``, if there, brought up to date where it changed."""
    names = docs.columns
    kind = to_arrow_type(docs.schema[length].dataType) if length in names else None

    def kernel(b):
        texts = b.column(names.index(text)).to_pylist()
        clean = [None if t is None else mask(t, x) if (x := find_spans(t)) else t for t in texts]
        cols = list(b.columns)
        cols[names.index(text)] = pa.array(clean, pa.string())
        if kind is not None:
            old = b.column(names.index(length)).to_pylist()
            cols[names.index(length)] = pa.array([o if c is t else len(c) for o, c, t in zip(old, clean, texts)], kind)
        return pa.RecordBatch.from_arrays(cols, names)

    return docs.mapInArrow(by_batch(kernel), docs.schema)


def secret_digests(docs: DataFrame) -> DataFrame:
    """One row per document: counts per base kind, checksum of the base spans, and all spans as text."""
    line = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    joined = lambda s: F.array_join(F.transform(s, line), ",")
    base = F.filter("spans", lambda x: x["kind"] != "named")
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return scan(docs).select("doc_id", count("assign"), count("access"), count("hex"),
                             F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                             count("named"))
