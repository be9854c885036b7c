"""License scans: template markup compiled into token automata.

Each template (see ``license_templates.py``) becomes a chain of states over
words: a word leads on, an optional region has a way around it, a replaceable
region is a row of states that any word passes. All templates share one
automaton; its state sets are made as texts need them and remembered, so a word
costs one look-up. Wherever two words stand that can begin a template, the
automaton runs on until nothing matches; a template is accepted where all of its
mandatory wording has been read, in order and without a gap.

Words are runs of ASCII letters, digits and all characters beyond ASCII, with
A-Z lower-cased. Besides, three base phrases are found at every place where
their words stand one after the other.

Word identities are compared by their bytes, not by hashes. Texts are read whole,
``WINDOW`` bytes at a time. Null and empty texts have no words, no labels, score
0. Repeated rows are rows of their own, keys may be null, extra columns are
ignored. ``share`` is the largest share of a template's mandatory words that a
run has read: 1 for an accepted template.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.llm.common import slices
from fareseg.llm.license_templates import TEMPLATES
from fareseg.llm.words import LOWER, Hasher

#: Label of every base phrase (fixed values).
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Bytes of one text whose words are found at once.
WINDOW = 4 << 20
#: State sets remembered before a worker starts anew.
STATES = 20_000
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_MARK = re.compile(r"<<(.*?)>>", re.S)


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(bytes(LOWER[np.frombuffer(text.encode(), np.uint8)]))


def parse(template: str) -> list:
    """A template as nested items: words (bytes), ``(least, most)`` for a replaceable region, a list for an optional one."""
    stack: list[list] = [[]]
    for n, part in enumerate(_MARK.split(template)):
        if n % 2 == 0:
            stack[-1] += words_of(part)
        elif part == "beginOptional":
            stack.append([])
        elif part == "endOptional" and len(stack) > 1:
            region = stack.pop()
            stack[-1].append(region)
        elif m := re.fullmatch(r"var;.*words=(\d+)-(\d+)", part):
            stack[-1].append((int(m[1]), int(m[2])))
        else:
            raise ValueError(f"unknown or misplaced markup <<{part}>>")
    if len(stack) > 1:
        raise ValueError("an optional region isn't closed")
    return stack[0]


class Automaton:
    """All templates as one automaton over word numbers, determinised as texts need it."""

    OTHER = 0

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]) -> None:
        self.labels, self.ends = [], {}            # template -> label; last state -> template
        self.on: list[dict[int, int]] = []         # state -> {word: next}
        self.any: list[int] = []                   # state -> next by any word, or -1
        self.skip: list[list[int]] = []            # state -> states reached without a word
        self.read: list[int] = []                  # state -> mandatory words read before it
        self.of: list[int] = []                    # state -> template
        self.number: dict[bytes, int] = {}
        self.need, starts = [], []
        for label, text in templates:
            self.labels.append(label)
            items = parse(text)
            self.need.append(sum(isinstance(x, bytes) for x in items))
            if self.need[-1] < 2 or isinstance(items[0], tuple):
                raise ValueError(f"a template needs two mandatory words and can't begin with a replaceable region: {text!r}")
            starts.append(self._state(0))
            self.ends[self._chain(starts[-1], items, True)] = len(self.labels) - 1
        self.phrases = [([self._word(w) for w in words_of(p)], label) for p, label in phrases.items()]
        self.closed = [self._closure(s) for s in range(len(self.on))]
        self.start = frozenset().union(*[self.closed[s] for s in starts])
        self.words = Words(list(self.number))
        self._first_pairs()
        self.forget()

    def _word(self, w: bytes) -> int:
        return self.number.setdefault(w, len(self.number) + 1)

    def _state(self, read: int) -> int:
        for column, x in ((self.on, {}), (self.any, -1), (self.skip, []), (self.read, read), (self.of, len(self.labels) - 1)):
            column.append(x)
        return len(self.on) - 1

    def _chain(self, s: int, items: list, mandatory: bool) -> int:
        """Adds the items after state ``s``; the state after them."""
        for x in items:
            if isinstance(x, bytes):
                t = self._state(self.read[s] + mandatory)
                self.on[s][self._word(x)] = t
            elif isinstance(x, tuple):
                least, most = x
                row = [s]
                for _ in range(most):
                    row.append(self._state(self.read[s]))
                    self.any[row[-2]] = row[-1]
                t = self._state(self.read[s])
                for r in row[least:]:
                    self.skip[r].append(t)
            else:
                inside = self._state(self.read[s])
                self.skip[s].append(inside)
                end = self._chain(inside, x, False)
                t = self._state(self.read[s])
                self.skip[end].append(t)
                self.skip[s].append(t)
            s = t
        return s

    def _closure(self, s: int) -> frozenset[int]:
        seen, todo = {s}, [s]
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def _next(self, states: frozenset[int], word: int) -> frozenset[int]:
        out: set[int] = set()
        for s in states:
            if word in self.on[s]:
                out |= self.closed[self.on[s][word]]
            if self.any[s] >= 0:
                out |= self.closed[self.any[s]]
        return frozenset(out)

    def _first_pairs(self) -> None:
        """Which two words in a row can begin a template."""
        size = len(self.number) + 1
        self.opens = np.zeros((size, size), bool)
        anchored = {s for s in self.start if self.on[s]}
        for s in anchored:
            for w, t in self.on[s].items():
                for u in self.closed[t]:
                    if self.any[u] >= 0:
                        self.opens[w] = True
                    self.opens[w, list(self.on[u])] = True
        self.start = frozenset(anchored)

    def forget(self) -> None:
        self.sets, self.numbers, self.table, self.facts = [], {}, [], []
        self._number(self.start)

    def _number(self, states: frozenset[int]) -> int:
        n = self.numbers.get(states)
        if n is None:
            n = self.numbers[states] = len(self.sets)
            self.sets.append(states)
            self.table.append({})
            done = tuple(sorted({self.labels[self.ends[s]] for s in states if s in self.ends}))
            share = max((self.read[s] / self.need[self.of[s]] for s in states), default=0.0)
            self.facts.append((done, share, not states))
        return n

    def run(self, numbers: np.ndarray, at: int, end: int) -> tuple[dict[str, int], float]:
        """From word ``at`` on: the longest accepted length by label, and the largest share read."""
        if len(self.sets) > STATES:
            self.forget()
        found, best, s = {}, 0.0, 0
        table, facts, n = self.table, self.facts, 0
        for lo in range(at, end, 16):
            for w in numbers[lo:min(lo + 16, end)].tolist():
                n += 1
                t = table[s].get(w)
                if t is None:
                    t = table[s][w] = self._number(self._next(self.sets[s], w))
                s = t
                done, share, dead = facts[s]
                if dead:
                    return found, best
                if share > best:
                    best = share
                for label in done:
                    found[label] = n
        return found, best


class Words:
    """Numbers words by their bytes: eight bytes at a time as an integer, and the length."""

    def __init__(self, known: list[bytes]) -> None:
        self.width = -(-max(map(len, known), default=1) // 8)
        rows = np.zeros((len(known), 8 * self.width), np.uint8)
        for n, w in enumerate(known):
            rows[n, :len(w)] = list(w)
        self.codes, self.sizes = rows.view("<u8"), np.array([len(w) for w in known], np.int64)
        self.heads = np.unique(self.codes[:, 0])
        #: the words with each head, one column a word, -1 where there are no more
        by_head = [np.flatnonzero(self.codes[:, 0] == h) for h in self.heads]
        self.with_head = np.full((len(by_head), max(map(len, by_head), default=0)), -1)
        for n, at in enumerate(by_head):
            self.with_head[n, :len(at)] = at

    def numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each word's number, 0 for one that isn't known."""
        out = np.zeros(len(starts), np.int16)
        if not len(starts) or not len(self.heads):
            return out
        padded = np.concatenate([data, np.zeros(8 * self.width, np.uint8)])

        def eight(at, size):
            x = np.zeros(len(at), np.uint64)
            for k in range(8):
                x |= np.where(size > k, padded[at + k], 0).astype(np.uint64) << np.uint64(8 * k)
            return x
        size = ends - starts
        head = eight(starts, size)
        near = np.minimum(np.searchsorted(self.heads, head), len(self.heads) - 1)
        maybe = np.flatnonzero(self.heads[near] == head)
        for column in self.with_head[near[maybe]].T:
            sure = (column >= 0) & (self.sizes[column] == size[maybe])
            for k in range(1, self.width):
                longer = np.flatnonzero(sure & (size[maybe] > 8 * k))
                sure[longer] = self.codes[column[longer], k] == eight(starts[maybe[longer]] + 8 * k, size[maybe[longer]] - 8 * k)
            out[maybe[sure]] = column[sure] + 1
        return out


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]) -> None:
        self.auto, self.hasher = Automaton(templates, phrases), Hasher()

    def numbers(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of texts one after the other, and how many words each text has."""
        if len(offs) > 2 or len(data) <= WINDOW:
            low = LOWER[data]
            starts, ends, doc = self.hasher.spans(low, offs, _IN_WORD)
            return self.auto.words.numbers(low, starts, ends), np.bincount(doc, minlength=len(offs) - 1)
        parts, lo = [], 0  # one long text: cut between words
        while lo < len(data):
            hi = min(lo + WINDOW, len(data))
            while hi < len(data) and _IN_WORD[LOWER[data[hi]]]:
                far = min(hi + WINDOW, len(data))
                gaps = np.flatnonzero(~_IN_WORD[LOWER[data[hi:far]]])
                hi = hi + int(gaps[0]) if len(gaps) else far
            part, _ = self.numbers_of(data[lo:hi])
            parts.append(part)
            lo = hi
        found = np.concatenate(parts)
        return found, np.array([len(found)])

    def numbers_of(self, data: np.ndarray) -> tuple[np.ndarray, int]:
        low = LOWER[data]
        starts, ends, _ = self.hasher.spans(low, np.array([0, len(low)]), _IN_WORD)
        return self.auto.words.numbers(low, starts, ends), len(starts)

    def scan(self, data: np.ndarray, offs: np.ndarray):
        """For each text ``(n_words, n_base, first, last, base labels, matches, share)``; matches: ``(label, first, end)``."""
        numbers, count = self.numbers(data, offs)
        at = np.concatenate([[0], np.cumsum(count)])
        doc = np.repeat(np.arange(len(count), dtype=np.int32), count)
        base: dict[int, list] = {}
        for phrase, label in self.auto.phrases:
            n = len(phrase)
            hit = np.flatnonzero(numbers[:len(numbers) - n + 1] == phrase[0]) if len(numbers) >= n else np.zeros(0, np.int64)
            for k in range(1, n):
                hit = hit[numbers[hit + k] == phrase[k]]
            hit = hit[doc[hit] == doc[hit + n - 1]]
            docs, first, many = np.unique(doc[hit], return_index=True, return_counts=True)
            for d, f, m in zip(docs.tolist(), first.tolist(), many.tolist()):
                base.setdefault(d, []).append((label, m, int(hit[f] - at[d]), int(hit[f + m - 1] - at[d])))
        opens = np.flatnonzero(self.auto.opens[numbers[:-1], numbers[1:]] & (doc[:-1] == doc[1:])) if len(numbers) > 1 else []
        matches: dict[int, list] = {}
        shares: dict[int, float] = {}
        free: dict[tuple, int] = {}
        for p in np.asarray(opens, np.int64).tolist():
            d = int(doc[p])
            found, share = self.auto.run(numbers, p, int(at[d + 1]))
            shares[d] = max(shares.get(d, 0.0), share)
            for label, n in found.items():
                if p >= free.get((d, label), 0):  # the leftmost, longest ones of a label don't overlap
                    free[d, label] = p + n
                    matches.setdefault(d, []).append((label, int(p - at[d]), int(p + n - at[d])))
        for d, n in enumerate(count.tolist()):
            b = base.get(d, [])
            yield (n, sum(x[1] for x in b), min((x[2] for x in b), default=None), max((x[3] for x in b), default=None),
                   sorted({x[0] for x in b}), matches.get(d, []), shares.get(d, 0.0))


_MATCH = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())]))
_KINDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
          ("base_labels", pa.list_(pa.string())), ("matches", _MATCH), ("share", pa.float64())]


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """``key, n_words``, the base phrases' places (``n_base, first_word, last_word, base_labels``), ``matches`` of templates
    as ``(label, first_word, end_word)`` and ``share``."""
    from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type
    from pyspark.sql.types import StructField, StructType

    kind = to_arrow_type(docs.schema[key].dataType)
    schema = StructType([docs.schema[key], *[StructField(n, from_arrow_type(t)) for n, t in _KINDS]])

    def kernel(batches):
        scanner = Scanner(templates, phrases)
        for b in batches:
            for lo, hi, data, offs in slices(b.column(1)):
                columns = list(zip(*scanner.scan(data, offs)))
                found = [pa.array([None if x is None else [dict(zip(("label", "first_word", "end_word"), m)) for m in x] for x in c], t)
                         if t == _MATCH else pa.array(c, t) for c, (_, t) in zip(columns, _KINDS)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo).cast(kind), *found], [key, *[n for n, _ in _KINDS]])

    return docs.select(key, text).mapInArrow(kernel, schema)


def license_digests(docs: DataFrame, **how) -> DataFrame:
    """One row per document; score: 1 for an accepted template, else the larger of the share read and, for a base phrase, 0.5."""
    found = license_scan(docs.select("doc_id", "text"), **how)
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("matches", lambda m: m["label"]))))
    score = F.when(F.size("matches") > 0, 1.0).otherwise(F.greatest("share", F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base_labels").alias("base_labels"),
                        F.concat_ws(",", labels).alias("labels"), score.alias("score"))
