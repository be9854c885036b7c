"""Near-dedup, search and Jaccard join against brute force, with hostile rows."""

import random
import re

import numpy as np
import pytest

from fareseg.llm import components, jaccard, near_embed, topk

NAN, INF = float("nan"), float("inf")
EMB = "vec_id long, embedding array<float>, label int, codes string, rid string"


def roots(n, links):
    low = list(range(n))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(160):
        base = rng.normal(size=8)
        rows.append((1000 - i, base.tolist(), i % 3))
        for _ in range(i % 4):
            rows.append((1000 + len(rows), (base + rng.normal(size=8) * 0.25).tolist(), i % 3))
    rows += [(5, rows[0][1], 0), (5, rows[0][1], 0), (6, None, 0), (7, [0.0] * 8, 0), (50, [NAN] + [1.0] * 7, 0), (100, [INF] * 8, 0),
             (9, [None] + [1.0] * 7, 0), (10, rows[0][1], None), (None, rows[0][1], 0), (11, [1.0, 2.0], 0), (12, [1.0, 2.0], 0)]
    return rows


def good(e):
    return e is not None and all(x is not None and np.isfinite(x) for x in e)


def test_near_duplicates_match_brute_force(spark):
    rows = vectors()
    got = near_embed.near_duplicates(spark.createDataFrame([(*r, "x", "y") for r in rows], EMB)).collect()
    links = []
    for i, (_, e, lab) in enumerate(rows):
        for j in range(i):
            f = rows[j][1]
            if lab is not None and lab == rows[j][2] and good(e) and good(f) and len(e) == len(f) and any(e) and any(f):
                x, y = np.float32(e).astype(float), np.float32(f).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                    links.append((i, j))
    root = roots(len(rows), links)
    first = {}
    for (v, _, _), r in zip(rows, root):
        if v is not None:
            first[r] = min(first.get(r, v), v)
    count = np.bincount(np.array(links).ravel(), minlength=len(rows))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    want = sorted(((v, int(c), first.get(r), v is not None and v == first.get(r)) for (v, _, _), r, c in zip(rows, root, count)), key=key)
    assert sorted((tuple(r) for r in got), key=key) == want and len(links) > 100


def test_large_buckets_are_compared_whole(spark, monkeypatch):
    monkeypatch.setattr(near_embed, "BLOCK", 7)
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(6) + rng.normal(size=6) * 0.01).tolist(), 1, "", "") for i in range(60)]
    got = near_embed.near_duplicates(spark.createDataFrame(rows, EMB)).collect()
    assert all(r["n_links"] == 59 and r["component_id"] == 0 for r in got) and sum(r["kept"] for r in got) == 1


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "STRIPE", 60)
    monkeypatch.setattr(topk, "CHUNK", 16)
    monkeypatch.setattr(topk, "GROUP", 3)
    rows = vectors(8) + [(v, [float(round(x)) for x in e], lab) for v, e, lab in vectors(9) if good(e)]
    got = topk.top_inner_products(spark.createDataFrame([(*r, "x", "y") for r in rows], EMB)).collect()
    part = [(i, v, np.floor(256 * np.float32(e).astype(float)).astype(np.int64)) for i, (v, e, _) in enumerate(rows) if good(e)]
    want = []
    for i, v, e in part:
        if v is not None and v % 50 == 0:
            s = sorted((-int(e @ f), w is None, w or 0) for j, w, f in part if j != i and len(f) == len(e))[:5]
            want += [(v, k + 1, None if none else w, -x) for k, (x, none, w) in enumerate(s)]
    key = lambda r: (r[0], r[1], r[3], str(r[2]))
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key) and len(want) > 20


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def documents():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)] + ["É", "ß", "x y"]
    passage = " ".join(rng.choice(vocab) for _ in range(30))
    rows = []
    for i in range(150):
        w = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14, 16, 20, 25, 60, 120]))]
        if i % 3 == 0:
            w += passage.split()
        rows.append(" ".join(w))
        for _ in range(i % 5):
            v = list(w)
            for _ in range(rng.randint(0, max(1, len(v) // 12))):
                v[rng.randrange(len(v))] = rng.choice(vocab)
            rows.append((" " if i % 2 else "\n").join(v[: rng.choice([len(v), len(v), len(v) - 1 or 1])]).upper())
    rows += [None, "", " \t\n", "one", "ONE", "w " * 20000, "w " * 19999]
    ids = [i * 7 % 1009 for i in range(len(rows))]
    return [*zip(ids, rows), (None, rows[0]), (ids[3], rows[3]), (ids[3], rows[4])]


DOC = "doc_id long, text string, q string, n string"


def test_jaccard_components_match_brute_force(spark):
    rows = documents()
    got = jaccard.jaccard_components(spark.createDataFrame([(*r, "a", "b") for r in rows], DOC)).collect()
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and 100 * len(a & b) >= 80 * len(a | b)]
    first, root = {}, roots(len(rows), links)
    for (d, _), r in zip(rows, root):
        if d is not None:
            first[r] = min(first.get(r, d), d)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    want = sorted(((d, len(s), first.get(r)) for (d, _), s, r in zip(rows, sets, root)), key=key)
    assert sorted((tuple(r) for r in got), key=key) == want
    assert len({(a, b) for a, b in links if sets[a] != sets[b]}) > 50
    kept = jaccard.deduplicated(spark.createDataFrame([(*r, "a", "b") for r in rows], DOC)).collect()
    by = {r: sum(1 for x in root if x == r) for r in root}
    assert len(kept) == len(by) and kept[0].asDict().keys() == {"doc_id", "text", "q", "n"}
    pairs = {(r["doc_id"], r["text"]) for r in kept}
    assert all((min(d for (d, _), x in zip(rows, root) if x == r and d is not None)) in {d for d, _ in pairs} for r in by if first.get(r) is not None)


def test_subset_rule_covers_every_linked_pair():
    for n in range(1, 41):
        for m in range(n, 60):
            need = jaccard.least_overlap(n, m)
            assert (need * 100 >= 80 * (n + m - need)) and ((need - 1) * 100 < 80 * (n + m - need + 1))
            if need <= n:
                assert need in jaccard.subset_sizes(n) and need in jaccard.subset_sizes(m)
    assert jaccard.boundary({}) == 0 and jaccard.boundary({3: 10, 6: 10}) >= 6


def test_components_on_paths_and_stars(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(100)]
    star = [(500, 500 + i) for i in range(1, 200)]
    links = path + star + [(7, 7), (None, 3)]
    rng.shuffle(links)
    got = {r["v"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 101)} | {500 + i: 500 for i in range(1, 200)}


@pytest.mark.parametrize("run,schema", [(near_embed.near_duplicates, EMB), (topk.top_inner_products, EMB),
                                        (jaccard.jaccard_components, DOC), (jaccard.deduplicated, DOC)])
def test_empty_tables(spark, run, schema):
    assert run(spark.createDataFrame([], schema)).collect() == []


def test_copies_of_a_vector_are_one_class(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(30, 8))
    near = base + rng.normal(size=base.shape) * 0.05
    rows = [(i, v.tolist(), 1, "", "") for i, v in enumerate([*base, *near])]
    rows += [(1000 + i, base[3].tolist(), 1, "", "") for i in range(5000)]
    seen = spark.sparkContext.accumulator(0)
    plain = near_embed.sign_codes

    def counted(classes, *how):
        def touch(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return plain(classes.mapInArrow(touch, classes.schema), *how)
    near_embed.sign_codes = counted
    try:
        got = {r["vec_id"]: r for r in near_embed.near_duplicates(spark.createDataFrame(rows, EMB)).collect()}
    finally:
        near_embed.sign_codes = plain
    x = np.float32([r[1] for r in rows]).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in (0, 3, 33, 17):
        assert got[rows[i][0]]["n_links"] == (x @ x[i] >= 0.93).sum() - 1
    assert got[1004]["n_links"] == got[3]["n_links"] >= 5000 and {got[1000 + i]["component_id"] for i in range(5000)} == {3}
    assert seen.value <= 4 * 60  # the tables' passes see classes, not copies


def test_queries_go_only_to_stripes_that_can_win(spark, monkeypatch):
    monkeypatch.setattr(topk, "STRIPE", 50)
    rng = np.random.default_rng(2)
    length = np.geomspace(50, 0.01, 1000)  # few long rows, many short ones
    v = rng.normal(size=(1000, 8))
    v *= (length / np.linalg.norm(v, axis=1))[:, None]
    rows = spark.createDataFrame([(int(i), x.tolist(), 0, "", "") for i, x in enumerate(v)], EMB)
    sent = []
    plain = topk.still_open

    def counted(queries, tops, first, stripes):
        out = plain(queries, tops, first, stripes)
        sent.append((out.count(), queries.count(), stripes))
        return out
    monkeypatch.setattr(topk, "still_open", counted)
    got = {(r["query_id"], r["rank"]): r["score"] for r in topk.top_inner_products(rows).collect()}
    e = np.floor(256 * np.float32(v).astype(float)).astype(np.int64)
    for i in range(0, 1000, 50):
        s = np.sort(np.delete(e @ e[i], i))[::-1]
        assert [got[i, r] for r in range(1, 6)] == s[:5].tolist()
    n, queries, stripes = sent[0]
    assert queries == 20 and stripes == 20 and n < 0.5 * queries * (stripes - 1)


def test_scores_beyond_a_long_saturate(spark):
    top = 2 ** 63 - 1
    rows = [(0, [3e38] * 4), (50, [-3e38] * 4), (1, [1e30] * 4), (2, [1.0, 0.0, 0.0, 0.0]), (3, [-1e30] * 4), (4, [0.0] * 4), (5, [3e38, -3e38, 0.0, 0.0])]
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in
           topk.top_inner_products(spark.createDataFrame([(i, v, 0, "", "") for i, v in rows], EMB)).collect()}
    assert [got[0, r] for r in range(1, 4)] == [(1, top), (2, top), (4, 0)]
    assert got[0, 4][0] == 5 and got[50, 1] == (3, top)


def test_clashing_names_are_carried_along(spark):
    text = " ".join(f"w{i}" for i in range(40))
    schema = "doc_id long, text string, _id string, _h string, _ID_ string, _hash long, root string, sk string, n string, q string, copies string, stays string, best string"
    rows = [(i, text, *"abc", i, *"defghij") for i in (3, 1, 1, 2)] + [(9, "other words entirely here now", *"abc", 9, *"defghij")]
    got = jaccard.deduplicated(spark.createDataFrame(rows, schema))
    assert got.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted(map(tuple, got.collect())) == sorted([rows[1], rows[4]])


def test_words_that_collide_under_a_polynomial_differ(spark):
    a = "a"
    for _ in range(10):  # Thue-Morse words and their complements have equal polynomials modulo a power of two
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"one two three four {a}", "", ""), (2, f"one two three four {b}", "", "")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {1: 1, 2: 2}


def test_word_hashes_do_not_depend_on_windows(monkeypatch):
    from fareseg.llm import words

    rng = random.Random(5)
    text = " ".join("x" * rng.choice([1, 3, 7, 64, 65, 200]) + str(rng.randint(0, 99)) for _ in range(3000))
    data = np.frombuffer(text.encode(), np.uint8)
    seen = []
    for window in (2 << 20, 100, 1):
        monkeypatch.setattr(words, "WINDOW", window)
        h = words.Hasher()
        s, e, _ = h.spans(data, np.array([0, len(data)]))
        seen.append(h.hashes(data, s, e))
    assert (seen[0] == seen[1]).all() and (seen[0] == seen[2]).all()
    found = {}
    assert all(found.setdefault(w, int(x)) == int(x) for w, x in zip(text.split(), seen[0])) and len(set(found.values())) == len(found)
