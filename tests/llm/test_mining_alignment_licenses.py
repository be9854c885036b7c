"""Hard negatives, token alignment and license scans against brute force, with hostile rows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from test_pairs import EMB, good, vectors
from tokenizers import Tokenizer

from fareseg.llm import align, licenses, negatives
from fareseg.llm.license_templates import TEMPLATES

DOC = "doc_id long, text string, labels string, score string, n_a string"


def brute_negatives(rows, every=100, low=30, high=90):
    part = [(i, v, np.floor(256 * np.float32(e).astype(float)), lab) for i, (v, e, lab) in enumerate(rows) if good(e) and lab is not None]
    top = 2 ** 63 - 1
    part = [(i, v, [int(min(max(x, -2.0 ** 63), top)) if abs(x) < 2 ** 63 else (top if x > 0 else -top - 1) for x in e], lab) for i, v, e, lab in part]
    out = []
    for i, v, e, lab in part:
        if v is None or v % every:
            continue
        all_ = sorted((-min(max(sum(a * b for a, b in zip(e, f)), -top - 1), top), w is None, w or 0, j, lab == m)
                      for j, w, f, m in part if j != i and len(f) == len(e))
        for s, none, w, _, _ in [x for x in all_ if x[4]][:5]:
            inside = [x for x in all_ if not x[4] and low * -s <= 100 * -x[0] <= high * -s][:10]
            out += [(v, None if none else w, r + 1, None if x[1] else x[2], -s, -x[0]) for r, x in enumerate(inside)]
    return out


@pytest.mark.parametrize("sizes", [(65536, 4096, 8192, 8), (40, 10, 7, 3)])
def test_hard_negatives_match_brute_force(spark, monkeypatch, sizes):
    for name, x in zip(("LANE", "LEAST_LANE", "BLOCK", "STEP"), sizes):
        monkeypatch.setattr(negatives, name, x)
    rows = vectors(8) + [(v, [float(round(x)) for x in e], lab) for v, e, lab in vectors(9) if good(e)]
    rows += [(2100 + i, [1.0] * 8, i % 2) for i in range(60)]  # one vector many times
    rows += [(2200, [3e38] * 8, 1), (2201, [-3e38] * 8, 2), (2300, [3e6] * 8, 1), (2301, [2e6] * 8, 2), (2302, [2.5e6] * 8, 1)]
    got = negatives.hard_negatives(spark.createDataFrame([(*r, "x", "y") for r in rows], EMB), every=20).collect()
    want = brute_negatives(rows, every=20)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key) and len(want) > 200
    assert {r["anchor_id"] for r in got} >= {2300}


def test_bounds_leave_few_rows_to_the_last_dimension():
    rng = np.random.default_rng(5)
    v = np.floor(256 * rng.normal(size=(5000, 64)) * np.linspace(3, 0.05, 64)).astype(np.int64)
    block = negatives.Block(np.arange(5000), np.arange(5000), np.ones(5000, bool), np.zeros(5000, np.int64), v)
    read = []

    def still(low, up):
        read.append(len(low))
        return up >= negatives._kth(low, 5)
    at, s = block.scores(v[7], np.arange(5000), still)
    exact = v @ v[7]
    assert set(np.argsort(-exact, kind="stable")[:5]) <= set(at.tolist()) and (s == exact[at]).all()
    assert read[0] == 5000 and read[-1] < 500 and sum(read[:-1]) < 0.8 * 5000 * (len(read) - 1)


def brute_alignment(texts):
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    words, found, count = align.Vocabularies(), [], Counter()
    for x in texts:
        found.append(None)
        if not x:
            continue
        a, b, data = a_model.encode(" " + x, add_special_tokens=False).ids, b_model.encode(x), (" " + x).encode()
        if b"".join(words.a.get(i, b"") for i in a) != data or b"".join(words.b.get(i, b"") for i in b) != data:
            continue
        a_end, b_end = np.cumsum([len(words.a[i]) for i in a]).tolist(), np.cumsum([len(words.b[i]) for i in b]).tolist()
        ends, of_a, of_b = sorted(set(a_end) & set(b_end)), dict(zip(a_end, a)), dict(zip(b_end, b))
        links, groups, last = [(of_a[e], of_b[e]) for e in ends], [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for i, z in zip(ids, at) if last < z <= e) for ids, at in ((a, a_end), (b, b_end))))
            last = e
        count.update(links)
        found[-1] = len(a), len(b), links, ";".join(groups)
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else (f[0], f[1], len(f[2]), len(f[2]), sum(count[p] == most[p[1]] for p in f[2]),
                                                      sum(count[p] for p in f[2]), f[3]) for f in found]


BITS = [" ", "  ", "   ", "\n", "\n\n", "\t", "a", "b", "Foo", "'ll", "don't", "12", "½", "漢字", "🎉", "é", chr(0x3000), "\xa0", chr(0x2028), "\x1c",
        "\x1d", "!", "...", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "\r\n", "ß", "\x00", chr(0x200B), "the", "ing", "_", "  \n ", "\r",
        ";\r", " \r", "\r ", "{"]


def odd_texts(n=700):
    rng = random.Random(1)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(1, 40))) for _ in range(n)]
    return texts + [None, "", "▁", "a▁b", " ", "  ", "\n", "x", "x", "a" * 5000, " a b  c " * 300, "the cat sat on the mat " * 20]


@pytest.mark.parametrize("memo,window", [(1 << 28, 1 << 20), (5000, 64)])
def test_alignment_of_odd_texts_matches_the_libraries(monkeypatch, memo, window):
    monkeypatch.setattr(align, "WINDOW", window)
    texts, words = odd_texts(), align.Vocabularies()
    assert words.cut and words.hash.n == len(set(words.hash.slots(words.hash.keys).tolist()))
    total = np.zeros(words.hash.n, np.int64)
    align.Aligner(words, memo=memo).count(texts, total)
    want = brute_alignment(texts)
    assert list(align.Aligner(words, total, memo=memo).look_up(texts, False)) == want
    assert [r[-1] for r in align.Aligner(words, total, memo=memo).look_up(texts, True)] == [
        hashlib.sha256(w[-1].encode()).hexdigest() if w[-1] else "" for w in want]


def test_alignment_of_a_table(spark, monkeypatch):
    monkeypatch.setattr(align, "FAN_IN", 3)
    texts = odd_texts(150)
    rows = [(i if i != 3 else None, t, "x", "y", "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOC).repartition(10)
    got = {(r["doc_id"], *list(r)[1:]) for r in align.aligned(docs).collect()}
    want = brute_alignment(texts)
    assert got == {(r[0], *w) for r, w in zip(rows, want)}
    empty = spark.createDataFrame([], DOC)
    assert align.alignment_digests(empty).collect() == [] and licenses.license_digests(empty).collect() == []


def test_texts_are_aligned_whole_when_pieces_cross_words():
    words = align.Vocabularies()
    words.cut = False
    texts = [t for t in odd_texts(60)]
    total = np.zeros(words.hash.n, np.int64)
    align.Aligner(words).count(texts, total)
    assert list(align.Aligner(words, total).look_up(texts, False)) == brute_alignment(texts)


def test_perfect_hash_refuses_other_keys():
    h = align.PairHash(np.arange(1, 5000, 3))
    assert h.n == 1667 and sorted(h.slots(np.arange(1, 5000, 3).astype(np.uint64)).tolist()) == list(range(1667))
    with pytest.raises(KeyError):
        h.slots(np.array([2], np.uint64))
    assert align.PairHash(np.zeros(0)).n == 0


def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def as_pattern(items):
    return "".join(re.escape(x.decode()) + " " if isinstance(x, bytes) else r"(?:\S+ ){%d,%d}" % x if isinstance(x, tuple)
                   else "(?:" + as_pattern(x) + ")?" for x in items)


PATTERNS = [(label, re.compile(r"(?<!\S)" + as_pattern(licenses.parse(t)))) for label, t in TEMPLATES]


def brute_licenses(t):
    w, places = plain_words(t), []
    for phrase, label in licenses.PHRASES.items():
        k = phrase.split()
        places += [(i, label) for i in range(len(w) - len(k) + 1) if w[i:i + len(k)] == k]
    text = " ".join(w) + " "
    base, own = {x[1] for x in places}, {label for label, p in PATTERNS if p.search(text)}
    starts = [x[0] for x in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | own))), bool(own)


def filled(items, rng):
    out = []
    for x in items:
        if isinstance(x, bytes):
            out.append(x.decode())
        elif isinstance(x, tuple):
            out += [rng.choice(["foo", "the", "é漢", "software"]) for _ in range(rng.randint(*x))]
        elif rng.random() < 0.5:
            out += filled(x, rng)
    return out


def license_texts():
    rng, texts = random.Random(3), []
    for _, t in TEMPLATES:
        for change in ("", "", "drop", "swap"):
            f = filled(licenses.parse(t), rng)
            if change == "drop":
                f.pop(rng.randrange(len(f)))
            if change == "swap":
                f[rng.randrange(len(f))] = "x"
            texts.append("foo bar " * rng.randint(0, 3) + rng.choice([" ", ", ", "\n"]).join(f).upper() + " end")
    return texts + [None, "", "  ", "MIT license MIT LICENSE", "mit  (license)", "general public\nlicense", "general public licenses", "é MITé license",
                    "mit license", "mit license", "Released under the MIT License.", "word " * 50_000 + "mit license", "a" * 300_000]


@pytest.mark.parametrize("window", [4 << 20, 50])
def test_licenses_match_brute_force(spark, monkeypatch, window):
    monkeypatch.setattr(licenses, "WINDOW", window)
    texts = license_texts()
    if window < 100:  # long texts cut between words, kernel alone
        scanner = licenses.Scanner(TEMPLATES, licenses.PHRASES)
        for t in texts[-13:]:
            data = np.frombuffer((t or "").encode(), np.uint8)
            got = next(scanner.scan(data, np.array([0, len(data)])))
            want, own = brute_licenses(t)
            assert (*got[:4], ",".join(got[4])) == want[:5] and bool(got[5]) == own
        return
    rows = [(i if i != 3 else None, t, "x", "y", "z") for i, t in enumerate(texts)]
    got = licenses.license_digests(spark.createDataFrame(rows, DOC)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    for i, t, *_ in rows:
        want, own = brute_licenses(t)
        assert tuple(by[i])[1:7] == want
        assert 0 <= by[i]["score"] <= 1 and (by[i]["score"] == 1) == own and (by[i]["score"] >= 0.5 or not want[1])


def test_templates_are_checked_and_other_templates_work():
    for bad in ("a b <<beginOptional>> c", "a b <<endOptional>>", "a b <<var;name=x>>", "<<var;name=x;words=1-2>> a b", "a <<beginOptional>>b<<endOptional>>"):
        with pytest.raises(ValueError):
            licenses.Scanner([("x", bad)], {})
    s = licenses.Scanner([("x", "one two <<beginOptional>>or <<var;name=n;words=0-2>> so <<endOptional>> three")], {})
    for text, n in (("one two three", 1), ("one two or so three", 1), ("one two or a b so three", 1), ("one two or a b c so three", 0),
                    ("one two so three", 0), ("one two one two three", 1), ("one two three one two three", 2)):
        data = np.frombuffer(text.encode(), np.uint8)
        assert len(next(s.scan(data, np.array([0, len(data)])))[5]) == n, text
    assert pa.types.is_list(licenses._MATCH)
