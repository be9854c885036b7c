"""Packing token ids into fixed windows: bounded-space online best fit.

Every task reads its partition once. A document (ids and an end id) is cut into
whole windows plus a rest; whole windows go out at once, the rest goes into the
open window it fills best. When none fits, the fullest open window is emitted
and a new one opened, so a task holds ``open_windows`` windows, never its
partition. The windows still open at a task's end are leftovers: they are
merged, ``fan_in`` partitions at a time, by the same rule over their pieces,
longest first.

Null and empty texts are the end id alone. Repeated rows and ids are packed
like any others. Null keys are kept. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import json

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareseg.llm.common import written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WINDOW = 1024
OPEN_WINDOWS = 64
FAN_IN = 64
END_ID = 0
_MERGED = 1 << 62

PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("left", pa.int64())])
PIECE_SQL = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, left long")


def byte_alphabet() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(vocabulary: str):
    """``text -> uint32 ids``, equal to the vocabulary's own ``Tokenizer.encode(text, add_special_tokens=False)``.

    The merges run in tiktoken on the file's ids, several times faster; a text
    that holds one of the file's added tokens goes through ``tokenizers`` itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    byte = byte_alphabet()
    added = [t["content"] for t in spec["added_tokens"]]
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow: list = []

    def encode(text: str) -> np.ndarray:
        if any(t in text for t in added):
            if not slow:
                slow.append(Tokenizer.from_file(vocabulary))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, disallowed_special=())
    return encode


class Windows:
    """At most ``space`` open windows of ``size`` ids, kept by free space."""

    def __init__(self, size: int, space: int) -> None:
        self.size, self.space = size, space
        self.open: list[tuple[int, int]] = []  # (free, window number), ascending
        self.pieces: dict[int, list] = {}
        self.made = 0

    def put(self, piece: tuple, length: int) -> list | None:
        """Places one piece of up to ``size`` ids; the pieces of a window that had to go, if any."""
        at = bisect.bisect_left(self.open, (length, -1))
        gone = None
        if at < len(self.open):
            free, w = self.open.pop(at)
        else:
            if len(self.open) >= self.space:
                gone = self.pieces.pop(self.open.pop(0)[1])
            free, w = self.size, self.made
            self.made += 1
            self.pieces[w] = []
        self.pieces[w].append(piece)
        if free == length:
            return self.pieces.pop(w) if gone is None else gone + [None] + self.pieces.pop(w)
        bisect.insort(self.open, (free - length, w))
        return gone

    def rest(self) -> list[list]:
        return [self.pieces[w] for _, w in self.open]


class _Rows:
    """Collects finished windows as output rows and hands them out as batches."""

    def __init__(self, first_id: int) -> None:
        self.next, self.rows, self.held = first_id, [], 0

    def window(self, pieces: list, left: int = 0) -> None:
        if not pieces:
            return
        at = 0
        for p in pieces:
            if p is None:  # a second window
                self.next, at = self.next + 1, 0
                continue
            n = p[2]
            self.rows.append((*p, self.next, at, left))
            at += n
            self.held += 4 * n + 64
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*self.rows), PIECE)], schema=PIECE)
        self.rows, self.held = [], 0
        return out


def packed(docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, open_windows: int = OPEN_WINDOWS,
           fan_in: int = FAN_IN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids`` (little-endian uint32), ``doc_tokens, sequence_id, offset``."""
    def first(batches):
        part = TaskContext.get().partitionId()
        encode, space, out = encoder(vocabulary), Windows(window, open_windows), _Rows(part << 32)
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4").tobytes()
                n = len(ids) // 4
                for s in range(0, n, window):
                    m = min(window, n - s)
                    piece = (key, s, m, ids[4 * s:4 * (s + m)], n)
                    gone = [piece] if m == window else space.put(piece, m)
                    if gone:
                        out.window(gone)
                if out.held > 4 << 20:
                    yield out.batch()
        for pieces in space.rest():
            out.window(pieces, 1 + part // fan_in)
        if out.rows:
            yield out.batch()

    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (-r["length"], r["sequence_id"], r["offset"]))
        space = Windows(window, open_windows)
        out = _Rows(_MERGED | (rows[0]["left"] << 32))
        for r in rows:
            gone = space.put((r["doc_id"], r["start"], r["length"], r["ids"], r["doc_tokens"]), r["length"])
            if gone:
                out.window(gone)
        for pieces in space.rest():
            out.window(pieces)
        return pa.Table.from_batches([out.batch()], PIECE)

    key = F.col("doc_id").cast("long").alias("doc_id")
    pieces = written(docs.select(key, "text").mapInArrow(first, PIECE_SQL), "pieces")
    merged = pieces.where("left > 0").groupBy("left").applyInArrow(merge, PIECE_SQL)
    return pieces.where("left = 0").unionByName(merged).drop("left")


def piece_digests(docs: DataFrame, **how) -> DataFrame:
    return packed(docs, **how).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                                      "sequence_id", "offset")
