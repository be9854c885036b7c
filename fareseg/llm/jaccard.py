"""N-gram Jaccard join: a size-aware heavy-light set join with exact results.

A document's set holds the 64-bit hashes of its distinct five-word shingles; two
sets link from a similarity of ``NUM / DEN`` = 80 %. Equal sets are one class
throughout, so copies never meet each other.

1. *Sizes and keys.* One pass over the texts writes each row's class, set size
   and first ``q`` shingles in hash order: the usual prefix plus a slack. Linked
   sets share more than slack-many of these (pigeonhole), so a set with fewer
   shared ones can't link and is dropped, common shingles or not.
2. *Light sets.* Up to a size chosen by cost (subsets to write against list
   entries to write and read), sets enumerate all subsets of each fixed size
   that a linked pair must share; equal subsets meet.
3. *Heavy sets.* The survivors' whole sets are read again, shingles counted
   exactly among them. Shingles that occur once can't be shared, which bounds
   every overlap; the rest of the prefix, rarest first, forms inverted lists.
4. *Scanning.* Each list first meets its fullest member only, then the members
   that aren't yet connected to it meet the others. Pairs whose overlap bound
   is too small, and pairs already connected, are skipped: a large group of
   near copies costs its size, not its square. Pairs are made only at keys
   within the prefix that their two sizes call for. Every pair left is verified on
   whole sets.

Texts without words (null, empty, white space) have size 0 and link with
nothing. Repeated rows and equal texts share a class. Null ids take part, but a
component's id is the smallest id that isn't null. Extra columns are ignored
(``deduplicated`` carries them along).
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareseg.llm.common import by_batch, slices, written
from fareseg.llm.components import components
from fareseg.llm.words import LOWER, NOT_SPACE, Hasher, combine, mix

SHINGLE = 5
NUM, DEN = 4, 5
#: Sets up to this size are written whole in the first pass, so that the boundary can lie anywhere below.
MOST_LIGHT = 20
#: What an inverted-list entry costs (written and read) against a subset written.
ENTRY_COST = 2
#: Classes whose shingles a task remembers to have given, before it starts anew.
SEEN = 500_000
#: Positions of the membership bitmap that lets the second pass skip most texts (a fixed 2**20 bits).
BITMAP = 1 << 20


def least_overlap(n: int, m: int) -> int:
    """Smallest overlap o with o / (n + m - o) >= NUM / DEN."""
    return -(-NUM * (n + m) // (NUM + DEN))


def least_size(n: int) -> int:
    return -(-NUM * n // DEN)


def slack(n: int) -> int:
    return -(-n // 10) + 4


def sets_of(hasher: Hasher, data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, ascending; texts under five words are one shingle of all their words."""
    data = LOWER[data]
    s, e, doc = hasher.spans(data, offs, NOT_SPACE)
    h = hasher.hashes(data, s, e)
    cut = np.searchsorted(doc, np.arange(len(offs)))
    k = SHINGLE
    grams = combine(*[h[i:len(h) - k + 1 + i] for i in range(k)]) if len(h) >= k else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a >= k:
            x = np.sort(grams[a:b - k + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif b > a:
            out.append(combine(*[h[i:i + 1] for i in range(a, b)]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class(x: np.ndarray) -> int:
    """One signed 64-bit number for a whole set."""
    up = np.arange(1, 2 * len(x), 2, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return int(mix(np.array([(mix(x ^ up) * (up | np.uint64(1))).sum() + np.uint64(len(x))], np.uint64)).view(np.int64)[0])


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat.view(np.int64)))


def first_keys(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep``, ``sk`` (class), ``n`` (set size), ``q`` (first shingles in hash order).

    A task gives a class's shingles once; further copies in it have an empty ``q``, so copies don't pile up on their keys.
    """
    keep = ["doc_id"] if keep is None else keep

    def kernel(batches):
        hasher, seen = Hasher(), set()
        for b in batches:
            for lo, hi, data, offs in slices(b.column(text)):
                sets = sets_of(hasher, data, offs)
                n = [len(x) for x in sets]
                sk = [_class(x) for x in sets]
                if len(seen) > SEEN:
                    seen.clear()
                q = [x[:0] if c in seen else seen.add(c) or x[:m if m <= MOST_LIGHT else m - least_size(m) + 1 + slack(m)]
                     for x, m, c in zip(sets, n, sk)]
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(sk, pa.int64()),
                                                  pa.array(n, pa.int64()), _lists(q)], [*keep, "sk", "n", "q"])

    schema = docs.select(*keep, F.lit(0).cast("long").alias("sk"), F.lit(0).cast("long").alias("n"),
                         F.array(F.lit(0).cast("long")).alias("q")).schema
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(kernel, schema)


def subset_sizes(n: int) -> list[int]:
    """The overlaps that some partner size forces on a set of size n, capped at n."""
    return sorted({o for m in range(least_size(n), n * DEN // NUM + 1) if (o := least_overlap(n, m)) <= min(n, m)})


def boundary(counts: dict[int, int]) -> int:
    """The largest light size, by cost over the number of sets of each size up to MOST_LIGHT."""
    subsets = {n: sum(math.comb(n, c) for c in subset_sizes(n)) for n in range(1, MOST_LIGHT + 1)}
    entries = {n: ENTRY_COST * (n - least_size(n) + 1 + min(slack(n), least_size(n))) for n in subsets}

    def cost(x: int) -> int:
        light = sum(counts.get(n, 0) * subsets[n] for n in range(1, x + 1))
        return light + sum(counts.get(n, 0) * entries[n] for n in subsets if n >= least_size(x + 1))
    return min(range(MOST_LIGHT + 1), key=lambda x: (cost(x), x))


def subsets(rows: DataFrame) -> DataFrame:
    """``sk, n, q`` with q holding one hash for every subset of every forced size of the set in q."""
    def kernel(b):
        out = []
        for q in b.column("q"):
            x = np.array(q.as_py(), np.int64).view(np.uint64)
            keys = []
            for c in subset_sizes(len(x)):
                pick = np.array(list(combinations(range(len(x)), c)))
                keys.append(combine(np.full(len(pick), c, np.uint64), *x[pick].T))
            out.append(np.concatenate(keys) if keys else np.zeros(0, np.uint64))
        return pa.RecordBatch.from_arrays([b.column("sk"), b.column("n"), _lists(out)], ["sk", "n", "q"])

    rows = rows.select("sk", "n", "q")
    return rows.mapInArrow(by_batch(kernel), rows.schema)


def _spread(rows: DataFrame) -> DataFrame:
    return rows.select("sk", F.explode("q").alias("key"))


def shared_keys(entries: DataFrame) -> DataFrame:
    """The distinct ``(key, sk)`` whose key occurs in two classes or more, with ``df``, its number of classes."""
    twice = entries.groupBy("key").agg(F.count("*").alias("df")).where("df > 1").select("key")
    some = written(entries.join(twice, "key").distinct(), "shared")
    df = some.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    return some.join(df, "key")


def survivors(first: DataFrame, light: int) -> DataFrame:
    """``sk, n`` of the classes that share enough of their keys to link with some other class."""
    listed = first.where(F.col("n") >= least_size(light + 1))
    shared = shared_keys(_spread(listed)).groupBy("sk").agg(F.count("*").alias("m"))
    low = F.ceil(F.col("n") * NUM / DEN)
    enough = F.least(F.ceil(low / 10) + 4 + 1, low)
    sizes = first.where("n > 0").groupBy("sk").agg(F.max("n").alias("n"))
    heavy = shared.join(sizes, "sk").where(F.col("m") >= enough).select("sk", "n")
    by_subset = shared_keys(_spread(subsets(first.where(F.col("n").between(1, light) & (F.size("q") > 0))))).select("sk").distinct().join(sizes, "sk")
    return written(heavy.unionByName(by_subset).distinct(), "survivors")


def whole_sets(docs: DataFrame, first: DataFrame, classes: DataFrame, key: str, text: str) -> DataFrame:
    """``sk, n, q`` (whole set) once per class of ``classes``.

    A fixed-size bitmap over one id of each class skips texts that can't belong;
    what it lets through by chance goes in the join.
    """
    spot = F.pmod(F.xxhash64(key), F.lit(BITMAP))
    ids = first.join(classes.select("sk"), "sk").groupBy("sk").agg(F.min(key).alias(key))
    bits = np.zeros(BITMAP, bool)
    bits[[r[0] for r in ids.select(spot.cast("long")).distinct().collect()]] = True  # at most BITMAP rows
    bits = np.packbits(bits).tobytes()

    def kernel(batches):
        hasher, member = Hasher(), np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
        for b in batches:
            b = b.filter(pa.array(member[b.column("_spot").to_numpy()]))
            for _, _, data, offs in slices(b.column(text)):
                sets = [x for x in sets_of(hasher, data, offs) if len(x)]
                yield pa.RecordBatch.from_arrays([pa.array([_class(x) for x in sets], pa.int64()),
                                                  pa.array([len(x) for x in sets], pa.int64()), _lists(sets)], ["sk", "n", "q"])

    found = docs.select(spot.cast("long").alias("_spot"), text).mapInArrow(kernel, "sk long, n long, q array<long>")
    return written(found.join(classes.select("sk"), "sk", "left_semi").dropDuplicates(["sk"]), "sets")


def inverted_lists(sets: DataFrame, light: int) -> DataFrame:
    """``key, sk, n, most, at``: prefix entries, rarest shingles first, and light sets' subsets.

    ``most`` counts a set's shared shingles and so bounds any overlap; ``at`` is the entry's place among them.
    """
    listed = sets.where(F.col("n") >= least_size(light + 1))
    shared = shared_keys(_spread(listed)).join(listed.select("sk", "n"), "sk")
    per_set = Window.partitionBy("sk")
    entries = (shared.withColumn("most", F.count("*").over(per_set))
               .withColumn("at", F.row_number().over(per_set.orderBy("df", "key")))
               .where(F.col("most") >= F.ceil(F.col("n") * NUM / DEN))
               .where(F.col("at") <= F.col("most") - F.ceil(F.col("n") * NUM / DEN) + 1))
    small = shared_keys(_spread(subsets(sets.where(F.col("n") <= light)))).join(sets.select("sk", "n"), "sk")
    small = small.select("key", "sk", "n", F.col("n").alias("most"), F.lit(1).alias("at"))
    lists = entries.select("key", "sk", "n", "most", "at").unionByName(small)
    return written(lists, "lists")


def _need(n1: str, n2: str):
    return F.ceil((F.col(n1) + F.col(n2)) * NUM / (NUM + DEN))


def _within(at1: str, most1: str, n1: str, at2: str, most2: str, n2: str):
    """Whether a key at these places of the two prefixes can be the one by which a linked pair of these sizes must meet."""
    after = F.least(F.col(most1) - F.col(at1), F.col(most2) - F.col(at2))
    return (F.col(at1) <= F.col(most1) - _need(n1, n2) + 1) & (F.col(at2) <= F.col(most2) - _need(n1, n2) + 1) & (
        F.least(at1, at2) + after >= _need(n1, n2))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose whole sets link."""
    left = sets.select(F.col("sk").alias("a"), F.col("n").alias("na"), F.col("q").alias("qa"))
    right = sets.select(F.col("sk").alias("b"), F.col("n").alias("nb"), F.col("q").alias("qb"))
    both = F.size(F.array_intersect("qa", "qb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("o"), (F.col("na") + F.col("nb")).alias("s"))
            .where(F.col("o") * DEN >= (F.col("s") - F.col("o")) * NUM).select("a", "b"))


def class_links(sets: DataFrame, lists: DataFrame) -> DataFrame:
    """``(v, root)`` of all classes that hang together with another one."""
    centre = lists.groupBy("key").agg(F.max(F.struct("most", "n", "sk")).alias("c"), F.count("*").alias("len")).where("len > 1")
    centre = written(centre.select("key", F.col("c.sk").alias("c"), F.col("c.n").alias("cn"), F.col("c.most").alias("cm")), "centres")
    star = (lists.join(centre, "key").where((F.col("sk") != F.col("c")) & (_need("n", "cn") <= F.least("most", "cm")))
            .select(F.greatest("sk", "c").alias("a"), F.least("sk", "c").alias("b")).distinct())
    links = written(verified(star, sets), "star")
    roots = written(components(links), "roots")
    named = roots.withColumnRenamed("v", "sk")
    at = (lists.join(centre, "key").join(named, "sk", "left").withColumn("root", F.coalesce("root", "sk"))
          .join(roots.select(F.col("v").alias("c"), F.col("root").alias("c_root")), "c", "left")
          .withColumn("c_root", F.coalesce("c_root", "c")).select("key", "sk", "n", "most", "at", "root", "c_root", "c"))
    at = written(at, "rooted")
    loose = at.where("root <> c_root").select("key", F.col("sk").alias("a"), F.col("n").alias("an"), F.col("most").alias("am"),
                                              F.col("at").alias("a_at"), F.col("root").alias("a_root"))
    others = written(at.where("sk <> c").drop("c"), "others")
    rest = (loose.join(others, "key")
            .where((F.col("a_root") != F.col("root")) & ((F.col("root") == F.col("c_root")) | (F.col("a") > F.col("sk"))))
            .where(_within("a_at", "am", "an", "at", "most", "n"))
            .select(F.greatest("a", "sk").alias("a"), F.least("a", "sk").alias("b")).distinct())
    more = written(verified(rest, sets), "rest")
    return components(links.unionByName(more))


def grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per row: ``keep`` columns (default the key), ``n`` and ``root``, equal for rows whose sets hang together (null for size 0)."""
    keep = [key] if keep is None else keep
    first = written(first_keys(docs, text, keep), "first")
    counts = {r["n"]: r["c"] for r in first.where(F.col("n").between(1, MOST_LIGHT)).groupBy("n").agg(F.count("*").alias("c")).collect()}
    light = boundary(counts)
    classes = survivors(first, light)
    sets = whole_sets(docs, first, classes, key, text)
    roots = class_links(sets, inverted_lists(sets, light)).withColumnRenamed("v", "sk")
    root = F.when(F.col("n") > 0, F.coalesce("root", "sk"))
    return first.drop("q").join(roots, "sk", "left").select(*keep, "n", root.alias("root"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row."""
    rows = written(grouped(docs.select("doc_id", "text")), "groups")
    first = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("_first"))
    return rows.join(first, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("_first", "doc_id").alias("component_id"))


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column of ``docs`` has it (columns' case doesn't count)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of every group: that of the smallest key (nulls last), one of it if it repeats.

    All columns are carried along, whatever their names.
    """
    id_, hash_ = _unused(docs, "_id"), _unused(docs, "_hash")
    marked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    rows = written(grouped(marked, "doc_id", "text", ["doc_id", "h"]), "groups").where("root is not null")
    who = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("h").alias("h"))
    rows = rows.groupBy("root", "doc_id", "h").agg(F.count("*").alias("copies"))
    best = rows.groupBy("root").agg(F.min(who).alias("best"), F.sum("copies").alias("size")).where("size > 1")
    acts = rows.join(best, "root").select(F.col("doc_id").alias(id_), F.col("h").alias(hash_), "copies", (F.col("best") == who).alias("stays"))
    acts = written(acts, "acts")
    here = F.col(key).eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(hash_))
    gone, repeated = (acts.where(c).select(id_, hash_) for c in ("not stays or copies > 1", "stays and copies > 1"))
    out = docs.join(gone, here, "left_anti")
    if repeated.isEmpty():
        return out
    again = docs.join(repeated, here, "left_semi").withColumn(hash_, F.xxhash64(text))
    return out.unionByName(again.dropDuplicates([key, hash_]).drop(hash_))
