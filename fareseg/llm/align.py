"""Cross-tokenizer alignment: which tokens of two tokenizers end at the same bytes, and how often corpus-wide.

Both tokenizers write the same bytes, space + text. Where tokens of both end, the
text is cut into groups; the two tokens that end there are linked.

Counting. When two tokens end at the same byte of the same text, the shorter
one's bytes are the end of the longer one's. So the distinct pairs that any
corpus can show are known from the vocabularies alone (324,297 for the default
two, however large the corpus). A minimal perfect hash gives each a slot; every
look-up is verified against the slot's key. A task adds up one dense vector of
counts by slot, and the tasks' vectors are summed as a tree, segment by segment,
``FAN_IN`` at a time. The second pass aligns the documents again and looks the
counts up.

Texts are aligned in chunks (a word with the space before it, mostly) at places
where neither tokenizer can join bytes: tokenizer A because its pre-tokens end
there, tokenizer B because no piece of its vocabulary spans such a place, which
is checked when it is read (if one does, texts are aligned whole). So a chunk's
tokens depend on nothing around it, and a worker remembers chunks, up to ``MEMO``
bytes, then starts anew.

Null and empty texts, and those whose bytes either tokenizer changes (such as
one with U+2581, which B reads as a space), have no tokens: zeros and ''.
Special tokens' strings are plain text. Extra columns are ignored; rows may
repeat and count each time; keys may be null.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.llm.packing import byte_alphabet
from fareseg.llm.words import mix

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
FAN_IN = 32
#: Counts of one segment of the dense vector, as it travels between tasks.
SEGMENT = 1 << 15
#: Bytes of chunks and their alignments that a worker remembers (about), and characters of a text handled at once.
MEMO = 160 << 20
WINDOW = 1 << 20

#: Unicode's White_Space characters (fixed values) but the space and the carriage return.
_OTHER_SPACE = "\t\n\x0b\x0c\x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_W, _V, _X = rf"[ \r{_OTHER_SPACE}]", f"[{_OTHER_SPACE}]", rf"[^ \r{_OTHER_SPACE}]"
#: Pieces such as ";\r" exist, so a run with a carriage return stays with the words on both sides.
_RETURNS = rf"{_W}*\r{_W}*{_X}*"
_WORD = f"{_X}+(?:{_RETURNS})*"
#: A word takes one space before it; what stands before that space is a chunk, as is one other space character. Any
#: other run before a word stays with it (A reads the run's last character by what follows).
CHUNK = re.compile(f"(?:{_RETURNS})+|(?:{_W}*  |{_W}+{_V}){_WORD}| ?{_WORD}|{_W}*{_V}(?= {_X})|{_W}+")
_CUT = re.compile(f"{_X}(?= {_X})")
_PLAIN = re.compile(f" {_X}(?:.*{_X})?$", re.S)
_SPACES = "\r" + _OTHER_SPACE


class PairHash:
    """Minimal perfect hash over distinct 64-bit keys, built and read as arrays.

    Level by level, keys that meet no other key at their place keep it and the
    rest go on to the next level; a key's slot is the number of kept places
    before its own.
    """

    def __init__(self, keys: np.ndarray, spread: float = 1.5) -> None:
        rest, self.levels, taken = np.unique(np.asarray(keys, np.uint64)), [], []
        self.n, start = len(rest), 0
        while len(rest):
            size = max(1, int(len(rest) * spread))
            place = self._place(rest, len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            self.levels.append((start, size))
            taken.append(alone)
            start += size
            rest = rest[~alone[place]]
        self.taken = np.concatenate(taken) if taken else np.zeros(0, bool)
        self.rank = np.cumsum(self.taken) - 1
        self.keys = np.zeros(self.n, np.uint64)
        keys = np.unique(np.asarray(keys, np.uint64))
        self.keys[self._slots(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (start, size) in enumerate(self.levels):
            at = start + self._place(keys[left], level, size)
            here = self.taken[at]
            out[left[here]] = self.rank[at[here]]
            left = left[~here]
            if not len(left):
                break
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; a key that isn't in the table is an error."""
        out = self._slots(keys)
        if len(keys) and (out.min() < 0 or (self.keys[out] != keys).any()):
            raise KeyError("a pair that the vocabularies don't allow")
        return out


def read_byte_level(path: str) -> dict[int, bytes]:
    """Bytes by id of a byte-level BPE file, without its special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"]
    if spec["model"]["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"] or spec["normalizer"]:
        raise ValueError(f"not a plain byte-level BPE file: {path}")
    byte, added = byte_alphabet(), {t["content"] for t in spec["added_tokens"]}
    return {i: bytes(byte[c] for c in t) for t, i in spec["model"]["vocab"].items() if t not in added}


def read_pieces(path: str) -> tuple[dict[int, bytes], bool]:
    """Bytes by id of a sentencepiece model, and whether its texts may be cut into chunks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out, cut = {}, True
    inside = re.compile(rf".{_V}|{_V}.|[^ {_OTHER_SPACE}] ", re.S)
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out[i] = bytes([int(piece[3:5], 16)])
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            text = piece.replace("▁", " ")
            out[i] = text.encode()
            cut = cut and not inside.search(text)
    guard = model.encode("\n")
    return out, cut and len(guard) == 2 and [out.get(i) for i in guard] == [b" ", b"\n"]


def possible_pairs(a: dict[int, bytes], b: dict[int, bytes]) -> np.ndarray:
    """``a << 32 | b`` for all id pairs of which one's bytes are the end of the other's."""
    found: set[int] = set()
    for longer, shorter, key in ((a, b, lambda i, j: i << 32 | j), (b, a, lambda i, j: j << 32 | i)):
        of: dict[bytes, list[int]] = {}
        for i, t in shorter.items():
            of.setdefault(t, []).append(i)
        for i, t in longer.items():
            for s in range(len(t)):
                found.update(key(i, j) for j in of.get(t[s:], ()))
    return np.fromiter(found, np.uint64, len(found))


class Vocabularies:
    """What every task needs: both tokenizers' bytes by id and the hash of the possible pairs."""

    def __init__(self, a_path: str = BYTE_LEVEL, b_path: str = PIECES) -> None:
        self.b_path = b_path
        self.a = read_byte_level(a_path)
        self.b, self.cut = read_pieces(b_path)
        self.hash = PairHash(possible_pairs(self.a, self.b))

    def a_of(self) -> np.ndarray:
        return (self.hash.keys >> np.uint64(32)).astype(np.int64)

    def b_of(self) -> np.ndarray:
        return (self.hash.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)


class Ragged:
    """Growing rows of integers of different length."""

    def __init__(self) -> None:
        self.at, self.values = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]

    def add(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values.append(values)
        self.at.append(self.at[-1][-1] + np.cumsum(sizes))

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        self.at, self.values = [np.concatenate(self.at)], [np.concatenate(self.values)]
        return self.at[0], self.values[0]


class Aligner(dict):
    """Aligns texts chunk by chunk; one per Python worker.

    As a dictionary it numbers the remembered chunks. A key is the chunk without
    its leading space, or the chunk's bytes if it has none.
    """

    def __init__(self, words: Vocabularies, counts: np.ndarray | None = None, memo: int = MEMO) -> None:
        import sentencepiece
        import tiktoken

        self.words, self.room = words, memo
        self.a_len = np.zeros(max(words.a, default=0) + 1, np.int64)
        self.b_len = np.zeros(max(words.b, default=0) + 1, np.int64)
        for sizes, of in ((self.a_len, words.a), (self.b_len, words.b)):
            sizes[list(of)] = [len(t) for t in of.values()]
        self.encode_a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in words.a.items()},
                                          special_tokens={}).encode_ordinary
        self.encode_b = sentencepiece.SentencePieceProcessor(model_file=words.b_path).encode
        #: with counts, chunks also get their text form and sums; without, only their slots are kept
        self.counts = counts
        if counts is not None:
            b_of = words.b_of()
            most = np.zeros(len(self.b_len), np.int64)
            np.maximum.at(most, b_of, counts)
            self.is_best = (counts == most[b_of]) & (counts > 0)
            self.items = [[f"{i}{sep}" for i in range(n)] for n, seps in ((len(self.a_len), ",|"), (len(self.b_len), ",;")) for sep in seps]
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh: list = []
        self.held = 0
        self.facts, self.known = np.zeros((6, 1024), np.int64), 0  # rows: kept whole, n_a, n_b, n_links, n_best, count_sum
        self.slots, self.forms = Ragged(), []

    def __missing__(self, key) -> int:
        n = self[key] = len(self)
        self.fresh.append(key)
        return n

    def _tokens(self, fresh: list[str]) -> tuple:
        """Ids of both tokenizers, the chunk of each id, and which chunks both keep whole."""
        whole = np.zeros(len(fresh), bool)
        a, b = self.words.a, self.words.b
        ids, owner = ([], []), ([], [])
        # words with a space before them follow each other in any text as they do here, so they are encoded as one
        plain = [n for n, c in enumerate(fresh) if _PLAIN.match(c)] if self.words.cut else []
        if plain:
            data = [fresh[n].encode() for n in plain]
            text = "".join([fresh[n] for n in plain])
            x, y = np.array(self.encode_a(text), np.int64), np.array(self.encode_b(text[1:]), np.int64)
            if b"".join([a[i] for i in x.tolist()]) == b"".join([b.get(i, b"") for i in y.tolist()]) == b"".join(data):
                ends, of = np.cumsum([len(t) for t in data]), np.array(plain)
                for side, (v, size) in enumerate(((x, self.a_len), (y, self.b_len))):
                    ids[side].append(v)
                    owner[side].append(of[np.searchsorted(ends, size[v].cumsum())])
                whole[plain] = True
            else:  # some chunk's bytes change: each by itself
                plain = []
        single = np.ones(len(fresh), bool)
        single[plain] = False
        for n in np.flatnonzero(single).tolist():
            c = fresh[n]
            data, x = c.encode(), self.encode_a(c)
            y = self.encode_b("\n" + c)[2:] if self.words.cut else self.encode_b(c[1:])
            whole[n] = b"".join([a[i] for i in x]) == data and b"".join([b.get(i, b"") for i in y]) == data
            if whole[n]:
                for side, v in enumerate((x, y)):
                    ids[side].append(np.array(v, np.int64))
                    owner[side].append(np.full(len(v), n))
        out = []
        for v, of in zip(ids, owner):
            v, of = (np.concatenate(v), np.concatenate(of)) if v else (np.zeros(0, np.int64),) * 2
            order = np.argsort(of, kind="stable")
            out += [v[order], of[order]]
        return *out, whole

    def _learn(self) -> None:
        """Aligns the chunks met for the first time."""
        if not self.fresh:
            return
        fresh, self.fresh = [k.decode() if isinstance(k, bytes) else " " + k for k in self.fresh], []
        size = len(fresh)
        a_all, a_of, b_all, b_of, whole = self._tokens(fresh)
        a_end, b_end = self.a_len[a_all].cumsum(), self.b_len[b_all].cumsum()
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        a_last, b_last = np.searchsorted(a_end, cuts), np.searchsorted(b_end, cuts)
        slots = self.words.hash.slots((a_all[a_last] << 32 | b_all[b_last]).astype(np.uint64))
        chunk = a_of[a_last]
        n_a, n_b, links = (np.bincount(x, minlength=size) for x in (a_of, b_of, chunk))
        if self.known + size > self.facts.shape[1]:
            self.facts = np.concatenate([self.facts, np.zeros((6, max(self.facts.shape[1] // 2, size)), np.int64)], axis=1)
        new = slice(self.known, self.known + size)
        self.facts[:4, new] = whole, n_a, n_b, links
        self.known += size
        self.held += sum(map(len, fresh)) + 250 * size + 8 * len(slots)
        if self.counts is None:
            self.slots.add(slots, links)
            return
        self.facts[4, new] = np.bincount(chunk, weights=self.is_best[slots], minlength=size)
        np.add.at(self.facts[5, new], chunk, self.counts[slots])
        # the chunks' groups as text: each id with its separator, A's of a group before B's
        a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
        a_at = np.arange(len(a_all)) + np.searchsorted(b_group, a_group)
        b_at = np.arange(len(b_all)) + np.searchsorted(a_group, b_group, "right")
        text = np.empty(len(a_all) + len(b_all), object)
        for ids, at, last, plain, closed in ((a_all, a_at, a_last, *self.items[:2]), (b_all, b_at, b_last, *self.items[2:])):
            text[at] = [plain[i] for i in ids.tolist()]
            text[at[last]] = [closed[i] for i in ids[last].tolist()]
        at, text = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist(), text.tolist()
        self.forms += ["".join(text[lo:hi]) for lo, hi in zip(at[:-1], at[1:])]
        self.held += sum(map(len, self.forms[new])) + 60 * size

    def _keys(self, text: str):
        """Keys of the chunks of space + ``text``, a window of it at a time."""
        if not self.words.cut:
            yield [text]
            return
        if not text[0].isspace() and not text[-1].isspace() and "  " not in text and not any(
                " " + c in text or c + " " in text for c in _SPACES if c in text):
            lo = 0  # single spaces between words: every one of them is a place to cut
            while lo < len(text):
                hi = text.find(" ", lo + WINDOW) if len(text) > lo + WINDOW else -1
                hi = len(text) if hi < 0 else hi
                yield text[lo:hi].split(" ")
                lo = hi + 1
            return
        text, lo = " " + text, 0
        while lo < len(text):
            cut = _CUT.search(text, lo + WINDOW) if len(text) > lo + WINDOW else None
            hi = cut.end() if cut else len(text)
            yield [c[1:] if c[0] == " " else c.encode() for c in CHUNK.findall(text, lo, hi)]
            lo = hi

    def groups(self, texts):
        """``(numbers, at)`` for texts by the group: chunk numbers, and where each text's begin; then all chunks are known."""
        parts, at, size = [np.zeros(0, np.int64)], [0], 0
        for t in texts:
            n = 0
            for keys in self._keys(t) if t else ():
                parts.append(np.fromiter(map(self.__getitem__, keys), np.int64, len(keys)))
                n += len(keys)
            at.append(at[-1] + n)
            size += len(t or "")
            if size >= WINDOW:
                self._learn()
                yield np.concatenate(parts), np.array(at)
                parts, at, size = [np.zeros(0, np.int64)], [0], 0
        if len(at) > 1:
            self._learn()
            yield np.concatenate(parts), np.array(at)

    def _by_text(self, numbers: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The facts' sums by text; 0 in the first row for a text that isn't kept whole (or has no chunks)."""
        sums = np.zeros((6, len(at)), np.int64)
        if len(numbers):
            total = np.concatenate([np.zeros((6, 1), np.int64), self.facts[:, numbers].cumsum(axis=1)], axis=1)
            sums[:, :-1] = total[:, at[1:]] - total[:, at[:-1]]
        sums[0, :-1] = (sums[0, :-1] == np.diff(at)) & (np.diff(at) > 0)
        return sums[:, :-1]

    def count(self, texts, total: np.ndarray) -> None:
        """Adds the links of these texts to ``total``, by slot."""
        met: list[np.ndarray] = []
        for numbers, at in self.groups(texts):
            met.append(numbers[np.repeat(self._by_text(numbers, at)[0] > 0, np.diff(at))])
            if self.held > self.room:
                self._settle(met, total)
                met = []
                self.forget()
        self._settle(met, total)

    def _settle(self, met: list[np.ndarray], total: np.ndarray) -> None:
        if not met:
            return
        at, slots = self.slots.joined()
        times = np.zeros(self.known, np.int64)
        for p in met:
            times += np.bincount(p, minlength=self.known)
        used = np.flatnonzero(times)
        size = at[used + 1] - at[used]
        where = np.repeat(at[used] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(used) else used
        np.add.at(total, slots[where], np.repeat(times[used], size))

    def look_up(self, texts, digest: bool):
        """For each text ``n_a, n_b, n_groups, n_links, n_best, count_sum`` and the groups (or their SHA-256)."""
        for numbers, at in self.groups(texts):
            facts = self._by_text(numbers, at).T.tolist()
            for (whole, n_a, n_b, links, best, total), lo, hi in zip(facts, at[:-1].tolist(), at[1:].tolist()):
                if not whole:
                    yield 0, 0, 0, 0, 0, 0, ""
                    continue
                sha, parts = hashlib.sha256(), []
                for s in range(lo, hi, WINDOW):
                    form = "".join([self.forms[i] for i in numbers[s:min(hi, s + WINDOW)].tolist()])
                    form = form[:-1] if s + WINDOW >= hi else form
                    sha.update(form.encode()) if digest else parts.append(form)
                yield n_a, n_b, links, links, best, total, sha.hexdigest() if digest else "".join(parts)
            if self.held > self.room:
                self.forget()


def _held(shared, counts: np.ndarray | None) -> Aligner:
    """The worker's own aligner, kept with the broadcast value."""
    value = shared.value
    if "aligner" not in value:
        value["aligner"] = Aligner(value["words"], counts if counts is None else value["counts"])
    return value["aligner"]


def _tree_sum(parts: DataFrame, lanes: int) -> DataFrame:
    """``segment, counts`` summed over ``lane``, ``FAN_IN`` vectors in a task at a time."""
    def add(groups: pa.Table) -> pa.Table:
        total = np.zeros(SEGMENT, np.int64)
        for x in groups["counts"]:
            total += np.frombuffer(x.as_buffer(), "<i8")
        return pa.table({"lane": groups["lane"][:1], "segment": groups["segment"][:1], "counts": pa.array([total.tobytes()], pa.binary())})

    while lanes > 1:
        lanes = -(-lanes // FAN_IN)
        parts = (parts.withColumn("lane", F.floor(F.col("lane") / FAN_IN).cast("int")).groupBy("lane", "segment")
                 .applyInArrow(add, "lane int, segment int, counts binary"))
    return parts


def pair_counts(docs: DataFrame, words: Vocabularies, text: str = "text") -> np.ndarray:
    """How many links of the corpus hold each possible pair, by slot of ``words.hash``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({"words": words})
    n = words.hash.n

    def kernel(batches):
        aligner, lane = _held(shared, None), TaskContext.get().partitionId()
        total = np.zeros(-(-n // SEGMENT) * SEGMENT, np.int64)
        for b in batches:
            aligner.count((t.as_py() for t in b.column(0)), total)
        for s in range(len(total) // SEGMENT):
            part = total[s * SEGMENT:(s + 1) * SEGMENT]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([lane], pa.int32()), pa.array([s], pa.int32()),
                                                  pa.array([part.astype("<i8").tobytes()], pa.binary())], ["lane", "segment", "counts"])

    texts = docs.select(text)
    sums = _tree_sum(texts.mapInArrow(kernel, "lane int, segment int, counts binary"), texts.rdd.getNumPartitions())
    out = np.zeros(-(-n // SEGMENT) * SEGMENT, np.int64)
    for r in sums.collect():
        out[r["segment"] * SEGMENT:(r["segment"] + 1) * SEGMENT] += np.frombuffer(r["counts"], "<i8")
    shared.unpersist()
    return out[:n]


def aligned(docs: DataFrame, a_path: str = BYTE_LEVEL, b_path: str = PIECES, key: str = "doc_id", text: str = "text",
            digest: bool = False) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum`` and ``groups`` (``groups_sha256`` with ``digest``)."""
    from pyspark.sql.pandas.types import to_arrow_type

    words = Vocabularies(a_path, b_path)
    shared = docs.sparkSession.sparkContext.broadcast({"words": words, "counts": pair_counts(docs, words, text)})
    names = [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256" if digest else "groups"]
    kinds = [to_arrow_type(docs.schema[key].dataType), *[pa.int64()] * 6, pa.string()]
    zeros = [F.lit(0).cast("long").alias(c) for c in names[1:7]]

    def kernel(batches):
        aligner = _held(shared, True)
        for b in batches:
            size, rows = 0, []
            found = aligner.look_up((t.as_py() for t in b.column(1)), digest)
            for k, r in zip(b.column(0), found):
                rows.append((k.as_py(), *r))
                size += len(r[-1])
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)
                    size, rows = 0, []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)

    schema = docs.select(key, *zeros, F.lit("").alias(names[-1])).schema
    return docs.select(key, text).mapInArrow(kernel, schema)


def alignment_digests(docs: DataFrame, **how) -> DataFrame:
    return aligned(docs.select("doc_id", "text"), digest=True, **how)
