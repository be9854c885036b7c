"""Byte-level BPE encoding and decoding by two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary: a pre-token that is a
vocabulary entry is resolved whole by one displacement read and one compare.
Tier two takes the misses: their bytes form a linked list, a heap holds the
neighbouring pairs whose joined bytes are an entry, and the lowest rank (then
the leftmost) merges first; stale heap entries are skipped.

A pre-token's ids depend on nothing else, so a worker remembers resolved
pre-tokens, up to ``MEMO``, then starts anew. Null and empty texts have no ids. Every id of the
vocabulary decodes to its bytes, and decoding gives the text's UTF-8 bytes back.
Extra columns are ignored; rows may repeat, keys may be null.
"""

from __future__ import annotations

import base64
from heapq import heapify
from heapq import heappop as pop
from heapq import heappush as push

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Pre-tokens a Python worker remembers before it starts anew (bounds its memory).
MEMO = 1_000_000
_MASK = (1 << 64) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


class PerfectHash:
    """Minimal perfect hash over ``keys`` by hash and displace: n keys, n slots, one small integer a bucket."""

    def __init__(self, keys: list[bytes], per_bucket: int = 4) -> None:
        self.n, self.buckets = len(keys), max(1, len(keys) // per_bucket)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        if len(set(hashes)) != len(hashes):
            raise ValueError("keys must be distinct")
        groups: dict[int, list[int]] = {}
        for i, h in enumerate(hashes):
            groups.setdefault(h % self.buckets, []).append(i)
        self.shift, self.key, used = [0] * self.buckets, [b""] * self.n, bytearray(self.n)
        self.value = [0] * self.n
        free = 0
        for g, members in sorted(groups.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(members) == 1:  # the last buckets name their slot
                while used[free]:
                    free += 1
                slots, d = [free], -1 - free
            else:
                d = 1
                while True:
                    slots = [self._slot(hashes[i], d) for i in members]
                    if len(set(slots)) == len(slots) and not any(used[s] for s in slots):
                        break
                    d += 1
            self.shift[g] = d
            for i, s in zip(members, slots):
                used[s], self.key[s], self.value[s] = 1, keys[i], i

    def _slot(self, h: int, d: int) -> int:
        return (((h ^ (d * 0x9E3779B97F4A7C15 & _MASK)) * 0xD6E8FEB86659FD93 & _MASK) >> 20) % self.n

    def get(self, key: bytes) -> int:
        """The key's position in ``keys``, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        s = -1 - d if d < 0 else self._slot(h, d)
        return self.value[s] if self.key[s] == key else -1


#: Bits for a position in a heap entry (rank, start, end); pieces beyond it get wider entries.
_BITS = 20


def order(ranks: dict[bytes, int], bits: int = _BITS) -> dict[bytes, int]:
    """Each entry's rank plus one, shifted to leave room for two positions."""
    return {t: r + 1 << 2 * bits for t, r in ranks.items()}


def merge(piece: bytes, shifted: dict[bytes, int], bits: int = _BITS) -> list[bytes]:
    """The parts of one pre-token that isn't an entry itself. ``shifted``: ``order(ranks, bits)``.

    ``end[s]`` is where the part starting at s ends and ``before[s]`` where the
    part before it starts. Position n ends at 0 and merged-away starts end at
    n + 1, so that stale entries and missing neighbours fail the lookups by themselves.
    """
    n = len(piece)
    low = (1 << bits) - 1
    end = [*range(1, n + 1), 0, 0]
    before = [n, *range(n)]
    get = shifted.get
    heap = [r + (s << bits) + s + 2 for s in range(n - 1) if (r := get(piece[s:s + 2]))]
    heapify(heap)
    while heap:
        x = pop(heap)
        t = x & low
        s = x >> bits & low
        mid = end[s]
        if end[mid] != t:
            continue
        end[s], end[mid], before[t] = t, n + 1, s
        e = end[t]
        r = get(piece[s:e])
        if r:
            push(heap, r + (s << bits) + e)
        p = before[s]
        r = get(piece[p:t])
        if r:
            push(heap, r + (p << bits) + t)
    out, s = [], 0
    while s < n:
        e = end[s]
        out.append(piece[s:e])
        s = e
    return out


class Codec(dict):
    """Encodes texts to little-endian uint32 ids and back; one per Python worker.

    The dictionary itself is the memory of resolved pre-tokens: a missing one is resolved on its first look-up.
    """

    def __init__(self, keys: list[bytes], ids: list[int], table: PerfectHash, pattern: str, memo: int = MEMO) -> None:
        self.ranks = dict(zip(keys, ids))
        self.shifted = order(self.ranks)
        self.table, self.ids = table, [i.to_bytes(4, "little") for i in ids]
        self.packed = dict(zip(keys, self.ids))
        self.bytes = dict(zip(ids, keys))
        self.find, self.room = regex.compile(pattern).findall, memo

    def __missing__(self, token: str) -> bytes:
        piece = token.encode()
        at = self.table.get(piece)
        if at >= 0:
            out = self.ids[at]
        else:
            bits = max(_BITS, len(piece).bit_length())
            parts = merge(piece, self.shifted if bits == _BITS else order(self.ranks, bits), bits)
            out = b"".join([self.packed[p] for p in parts])
        self[token] = out
        return out

    def encode(self, text: str) -> bytes:
        out = b"".join(map(self.__getitem__, self.find(text)))
        if len(self) > self.room:
            self.clear()
        return out

    def decode(self, ids: bytes) -> bytes:
        get = self.bytes.__getitem__
        return b"".join([get(i) for i in np.frombuffer(ids, "<u4").tolist()])


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """``key, ids, decoded``: ids as little-endian uint32 bytes, and the bytes they decode to."""
    ranks = read_ranks(vocabulary)
    keys = list(ranks)
    shared = docs.sparkSession.sparkContext.broadcast({"parts": (keys, [ranks[k] for k in keys], PerfectHash(keys), pattern)})

    def kernel(batches):
        held = shared.value  # one object per Python worker, so its codec serves all tasks there
        codec = held["codec"] = held.get("codec") if "codec" in held else Codec(*held["parts"])
        for b in batches:
            size, part = 0, ([], [], [])
            for k, t in zip(b.column(0), b.column(1)):
                ids = codec.encode(t.as_py() or "")
                for column, v in zip(part, (k.as_py(), ids, codec.decode(ids))):
                    column.append(v)
                size += 2 * len(ids)
                if size > 8 << 20:
                    yield pack(part)
                    size, part = 0, ([], [], [])
            if part[0]:
                yield pack(part)

    def pack(part):
        return pa.RecordBatch.from_arrays([pa.array(part[0], kind), pa.array(part[1], pa.binary()), pa.array(part[2], pa.binary())],
                                          [key, "ids", "decoded"])

    from pyspark.sql.pandas.types import to_arrow_type
    kind = to_arrow_type(docs.schema[key].dataType)
    schema = docs.select(key, F.lit(b"").alias("ids"), F.lit(b"").alias("decoded")).schema
    return docs.select(key, text).mapInArrow(kernel, schema)


def token_digests(docs: DataFrame, **how) -> DataFrame:
    """One row per document: number of ids and checksums of the ids and of the decoded bytes."""
    return encoded(docs, **how).select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
