"""Classifiers, scans, extraction, tokens, shards, packing and the pipeline."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_SMALL
from tokenizers import Tokenizer

import corpus_pipeline
from fareseg.llm import bpe, html_blocks, packing, quality, secret_scan, shards, toxicity
from fareseg.llm.common import held_out

DOC = "doc_id long, text string, lang string, source string, n_chars int, score string, ids string, shard string"
ODD = [None, "", " ", "\n\t ", "one", "é ß 漢字 🎉", "a" * 200_000, "word " * 30_000, "x", "x", "<|endoftext|> a", "don't  we'll\n\n 12 ½ ",
       "   　z", "token=token=abcdefghijkl", 'DB = "h8Kq2ZpL0vXs"\npassword = DB']


def odd_docs(spark):
    rows = [(i if i != 2 else None, t, None, "s", None if t is None else len(t), "k", None, "z") for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[5], rows[6]], DOC), [r[:2] for r in [*rows, rows[5], rows[6]]]


def tables(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/labels.parquet")


@pytest.mark.parametrize("run", [toxicity.toxicity, quality.quality])
def test_scores_of_odd_rows(spark, run):
    docs, rows = odd_docs(spark)
    _, labels = tables(spark)
    for lab in (labels, labels.limit(0), spark.createDataFrame([(1, None, 1), (None, 1, None), (4, 1, 0), (4, 1, 0)], labels.schema)):
        got = run(docs, lab).collect()
        assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
        assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
        assert len({r["score"] for r in got if r["doc_id"] in (8, 9)}) == 1
    assert run(docs.limit(0), labels).collect() == []


def test_scores_never_see_held_out_labels(spark):
    docs, labels = tables(spark)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end quality",
                                "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - toxic else toxic end toxic")
    for run in (toxicity.toxicity, quality.quality):
        a = {(r["doc_id"], round(r["score"], 9)) for r in run(docs, labels).collect()}
        assert a == {(r["doc_id"], round(r["score"], 9)) for r in run(docs, flipped).collect()}


def test_held_out_accuracy_at_the_larger_size(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    for run, column, least in ((toxicity.toxicity, "toxic", 0.96), (quality.quality, "quality", 0.98)):
        r = run(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
        assert (r["predicted"] == r[column]).mean() >= least


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    x = [np.unique(np.append(rng.integers(50, 4000, 40), [7] if i % 4 == 0 else [])).astype(np.int32) for i in range(800)]
    w = toxicity.ftrl(x, np.array([float(i % 4 == 0) for i in range(800)]), bits=12)
    assert len(w.index) < 100 and w.index[np.argmax(w.value)] == 7


def test_statistics_of_slices_equal_single_texts():
    h = quality.Hasher()
    raw = [t.encode() for t in ODD if t is not None]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    whole = quality.statistics(h, np.frombuffer(b"".join(raw), np.uint8), offs)
    for r, x in zip(raw, whole):
        assert np.allclose(quality.statistics(h, np.frombuffer(r, np.uint8), np.array([0, len(r)])), x)


def brute_spans(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A | re.I):
        out += [(m.start(), m.end(), "assign")] if len(m[2]) >= 12 else []
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda x: (x[0], ["assign", "access", "hex"].index(x[2])))


def test_secret_base_spans_are_exact(spark):
    rng = random.Random(5)
    bits = ["password", "TOKEN", "api_key", "apikey", " ", "=", ": ", '"', "'", "AKIA", "A1B2C3D4E5F6G7H8", "deadbeef", "0123456789abcdef",
            "é", "\n", "ſecret", "abcDEF123456-_", "token=token"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    for t in texts:
        assert [s for s in secret_scan.find_spans(t) if s[2] != "named"] == brute_spans(t)
    docs, rows = odd_docs(spark)
    got = {(r["doc_id"], r["base_sha256"], r["spans"]) for r in secret_scan.secret_digests(docs).collect()}
    for d, t in rows:
        b = ",".join(f"{k}:{s}:{e}" for s, e, k in brute_spans(t or ""))
        assert (d, hashlib.sha256(b.encode()).hexdigest()) in {x[:2] for x in got}
    assert secret_scan.scan(docs.limit(0)).collect() == []


def test_lexer_propagates_constants_and_masks():
    text = 'DB = "h8Kq2ZpL0vXs"\nother = "h8Kq2ZpL0vXt"\npassword = DB\nnote: hello'
    assert [(text[s:e], k) for s, e, k in secret_scan.find_spans(text)] == [("h8Kq2ZpL0vXs", "named")]
    joined = 'client_secret => "Zx81Kq" + "00pPq9"'
    assert [joined[s:e] for s, e, _ in secret_scan.find_spans(joined)] == ["Zx81Kq", "00pPq9"]
    assert secret_scan.mask("ab token=0123456789abcdef0 cd", secret_scan.find_spans("ab token=0123456789abcdef0 cd")) == "ab [SECRET] cd"


LITERAL = "h8Kq2ZpL0vXs"


@pytest.mark.parametrize("line", [
    'const apiKey: string = "L";', 'password: str = "L"', 'val pwd: String = "L"', 'token: &str = "L";', "const TOKEN: &'static str = \"L\";",
    'let pwd: String? = "L"', 'private pwd?: string | null = "L"', 'secret: Optional[Dict[str, str]] = "L"', 'pwd: Map<String, List<String>> = "L"',
    "Password : constant String := 'L'", 'pwd: "str" = "L"', 'var pwd string = "L"', 'Dim pwd As String = "L"', 'char pwd[32] = "L";',
    'f(host: String, pwd: String = "L")', 'const { x: pwd = "L" } = y', 'pwd:std::string="L"', 'pwd: (str | None) = "L"',
    'password = pwd = "L"', 'x = pwd = "L"', 'pwd = x = "L"', 'a = pwd = b = "L"', 'x=pwd="L"', "x := pwd = 'L'", 'pwd = x = L', 'x: str = pwd = "L"',
    "'pwd' => $x = 'L'", 'y: str = "L"\npwd = y', 'y = z = "L"\npwd = y', 'y = z = "L"\npwd = z', 'var y string = "L"\npwd = y'])
def test_lexer_reads_types_and_chains(line):
    text = line.replace("L", LITERAL) if '"L"' not in line and "'L'" not in line else line.replace('"L"', f'"{LITERAL}"').replace("'L'", f"'{LITERAL}'")
    assert [(text[s:e], k) for s, e, k in secret_scan.find_spans(text)] == [(LITERAL, "named")]
    assert LITERAL not in secret_scan.mask(text, secret_scan.find_spans(text))


def test_lexer_keeps_what_only_looks_like_a_type_or_chain():
    for line in ("pwd: h8Kq2ZpL0vXs = foo", "pwd = h8Kq2ZpL0vXs = foo", 'f("pwd=h8Kq2ZpL0vXs=", "x")', 'pwd=h8Kq2ZpL0vXs= "x"'):
        assert any(LITERAL in line[s:e] for s, e, _ in secret_scan.find_spans(line)), line
    assert secret_scan.find_spans('name: str = "h8Kq2ZpL0vXs"\nother = name\nif pwd == "h8Kq2ZpL0vXt": pass') == []


def test_lexer_reads_long_names_and_later_constants():
    long = "password." + "a" * 300
    for text in (f'{long} = "{LITERAL}"', f'"{long}": "{LITERAL}"', f'{long}_x = "{LITERAL}"', f'y{"a" * 300} = "{LITERAL}"\npwd = y{"a" * 300}',
                 f'password = DB\nDB = "{LITERAL}"', f'password = A\nA = B\nB = "{LITERAL}"', f'A = B\nB = "{LITERAL}"\npassword = A',
                 f'password = A\nA = B\nB = A\nA = "{LITERAL}"\npwd = A', f'pwd = pwd\npwd = "{LITERAL}"'):
        assert LITERAL in [text[s:e] for s, e, _ in secret_scan.find_spans(text)], text
    text = f'DB = "{LITERAL}"\npassword = DB\nDB = "h8Kq2ZpL0vXt"'
    assert [text[s:e] for s, e, _ in secret_scan.find_spans(text)] == [LITERAL]
    many = "\n".join(f"a{i} = a{i + 1}" for i in range(20_000)) + f'\na20000 = "{LITERAL}"\npassword = a0'
    assert [many[s:e] for s, e, _ in secret_scan.find_spans(many)] == [LITERAL]


def test_redact_keeps_columns_and_lengths(spark):
    docs, rows = odd_docs(spark)
    got = secret_scan.redact(docs)
    assert got.schema == docs.schema
    out = got.collect()
    assert len(out) == len(rows) and all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in out)
    assert not any(secret_scan.base_spans(r["text"] or "") for r in out)


def page(body):
    return f"<html><head><title>T</title></head><body>{body}</body></html>"


def test_main_text_of_pages(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    model = html_blocks.fit(pages)
    for r, got in zip(pages.orderBy("page_id").collect(), html_blocks.extract(pages, model).orderBy("page_id").collect()):
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", body)
        want = [" ".join(__import__("html").unescape(re.sub(r"<[^>]+>", lambda m: " " if "br" in m[0] else "", p)).split()) for p in parts]
        assert got["text"] == "\n".join(w for w in want if w)
    text = "The first sentence of a story, long enough to be read. It goes on, and on, for a while longer than a menu would."
    dressed = page(f"<div class='menu'><ul><li><a href='/'>Home</a><li><a href='/a'>About</a></ul></div><div class='content'><h2>A title</h2>"
                   f"<p>{text}<p>{text} &amp; more\n  text</p></div><div class='sidebar'><a href='/x'>Other</a></div><footer>&copy; x</footer>")
    rows = [(1, None, None, "t"), (2, "", "", "t"), (3, "u", "<<<>>", "t"), (4, "u", dressed, "t"), (None, "u", dressed, "t"), (4, "u", dressed, "t")]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_blocks.extract(odd, model, keep=["page_id", "url"]).collect()
    assert len(got) == 6 and got[0]["text"] == "" and got[1]["text"] == ""
    assert [r["text"].count(text) for r in got[3:]] == [2, 2, 2] and "Home" not in got[3]["text"] and "& more text" in got[3]["text"]
    assert html_blocks.main_text(odd.limit(0)).collect() == []


@pytest.mark.parametrize("before", [
    "<head><title>T</title><style>s{}</style>", "<head><meta charset=utf-8><script>if (a<b) x()</script>", "<title>T", "<head><title>T<body>",
    "<svg class='i'/>", "<svg viewBox='0 0 1 1' />", "<iframe src='/x'/>", "<iframe src=/x/>", "<object data='o'/>", "<button/>", "<script src=a.js/>",
    "<script src='a.js'/>", "<option value=a>", "<object data=o>", "<button>", "<svg>", "<iframe src=x>", "<noscript>", "<template>", "<select>",
    "<datalist><option>a<option>b</datalist>", "<select><option>a<optgroup><option>b</select>", "<svg><svg></svg><text>t</text></svg>",
    "<button-group></button-group>", "<template><template>t</template>u</template>", "<title><b><!-- t</title>", "<noscript><p>n</p></noscript>",
    "<textarea><p>t</p></textarea>", "<button><script>'</button>'</script>t</button>", "<style>s</style>", "<!-- <p>t</p> -->", "<object><p>t</p></object>"])
def test_blocks_after_cut_elements(before):
    tail = "<svg><title>i</title></svg><iframe>f</iframe><object>o</object><select><option>s</option></select><button>k</button><script>'</p>'</script>"
    tail += "<noscript>n</noscript><template>m</template>"
    for after in ("", tail):
        got = html_blocks.blocks(f"<html>{before}<p>One <svg/>two.<div class=x><p>Three.</div>{after}<p>Four.")
        assert [t for _, t, _ in got] == ["One two.", "Three.", "Four."], before
        assert got[0][0].part == ("p",) and not any(n in html_blocks.DROPPED for path, _, _ in got for part in path.parts() for n in part)


@pytest.mark.parametrize("tag", ["script", "style", "textarea"])
def test_blocks_of_text_elements_without_end(tag):
    assert [t for _, t, _ in html_blocks.blocks(f"<p>One.</p><{tag}> x <p>y</p>")] == ["One."]
    assert [t for _, t, _ in html_blocks.blocks("<p>One.</p><!-- x <p>y</p>")] == ["One."]


def test_blocks_of_many_starts_without_end_take_linear_time():
    got = html_blocks.blocks("<iframe src=x><title><option><object>w <p>" * 40_000)
    assert [t for _, t, _ in got] == ["w"] * 40_000


@pytest.mark.parametrize("piece,closing", [("<a ", ""), ("<a ", ">"), ("<div>x", ""), ("<a \"'", ""), ("<a b=\"", ">x"), ("<a b='\">", ""),
                                           ("<a b='c\" d=\"e' <", ">"), ("</div>", ""), ("<div></p>", ""), ("<", ""), ("<!-", "")])
def test_a_broken_megabyte_takes_linear_time(piece, closing):
    import time
    import tracemalloc

    html = "<p>One.</p>" + piece * (1_000_000 // len(piece)) + closing
    tracemalloc.start()
    start = time.process_time()
    got = html_blocks.blocks(html)
    took = time.process_time() - start
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert took < 20 and peak < 500e6 and got[0][1] == "One."  # traced; about a fifth of it without


def test_deep_pages_are_labelled_in_bounded_memory():
    net = html_blocks.Labeller(1)
    page = html_blocks.blocks("<div>x" * 60_000)
    assert len(page) == 60_000 and page[-1][0].depth == 60_000
    assert len(net.label(html_blocks.page_vectors([page], html_blocks.Hasher()))[0]) == 60_000


def test_attribute_values_leave_no_markup():
    for tag in ("<a href=it's>", "<a href=a\"b class=x>", "<a title=\"x>y\">", "<a title='x>\"y'>", "<a \"stray' quotes>", "<a b=\"c>", "<a b = 'c' d=\"\">",
                "<a =>", "<a/>", "<A HREF=x'y'z>"):
        got = html_blocks.blocks(f"<div>One {tag}link</a> two.</div><p>Three.</p>")
        assert [t for _, t, _ in got] == ["One link two.", "Three."], tag
    path = html_blocks.blocks("<section class='Main text'><div id=content><p>a")[0][0]
    assert path.parts() == [("section", "main", "text"), ("div", "content"), ("p",)] and path.article and not path.boiler
    names = [html_blocks._part_vector(p, {}) for p in path.parts()]
    assert np.allclose(path.vector(), 0.7 * names[0] + names[1] + names[2])


HAND = [
    ("<html><body><div id=top><ul class=menu><li><a href=/>Home</a><li><a href=/n>News</a></ul></div><div class=post>"
     "<h1>The river in spring</h1><p>In spring the river rises by a metre, and the meadows beside it stand under water for weeks.</p>"
     "<p>Farmers move their herds to the hills, as they have done for as long as anybody can remember.</p></div>"
     "<div class=sidebar><p><a href=/a>Most read</a></p><p><a href=/b>Weather</a></p></div><footer><p>All rights reserved.</p></footer>",
     "The river in spring\nIn spring the river rises by a metre, and the meadows beside it stand under water for weeks.\n"
     "Farmers move their herds to the hills, as they have done for as long as anybody can remember."),
    ("<table><tr><td class=nav><a href=1>Start</a><td class=content><p>The old bridge was built of stone, and it has carried the road across the "
     "valley for two hundred years.</p><p>Last winter one of its arches cracked, so that it must now be repaired, which will take until May.</p>"
     "</table><div class=cookie>We use cookies. <button>Accept</button></div>",
     "The old bridge was built of stone, and it has carried the road across the valley for two hundred years.\n"
     "Last winter one of its arches cracked, so that it must now be repaired, which will take until May."),
]


@pytest.mark.parametrize("n", [0, pytest.param(1, marks=pytest.mark.xfail(strict=True, reason="a three-word notice after a table layout is kept"))])
def test_hand_written_pages_without_article(spark, n):
    model = html_blocks.fit(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"))
    pages = spark.createDataFrame([(n, "u", HAND[n][0])], "page_id long, url string, html string")
    text = html_blocks.extract(pages, model).first()["text"]
    assert text.startswith(HAND[n][1])
    assert text == HAND[n][1]


def test_lstm_gradient_matches_differences():
    rng = np.random.default_rng(1)
    net = html_blocks.Labeller(3)
    v = [rng.normal(size=(n, html_blocks.INPUT)) for n in (4, 2)]
    x, seen = html_blocks._padded(v)
    y = (rng.random(seen.shape) < 0.5) * seen
    grads = net.gradient(x, seen, y)

    def loss():
        p = net.probability(x, seen)
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * seen).sum() / seen.sum()
    for k in ("xf", "hb", "cf", "o"):
        at = tuple(rng.integers(n) for n in net.w[k].shape)
        old = net.w[k][at]
        net.w[k][at] = old + 1e-5
        up = loss()
        net.w[k][at] = old - 1e-5
        assert abs((up - loss()) / 2e-5 - grads[k][at]) < 1e-6
        net.w[k][at] = old


def test_bpe_equals_tiktoken_and_round_trips(spark):
    ranks = bpe.read_ranks(bpe.VOCABULARY)
    keys = list(ranks)
    table = bpe.PerfectHash(keys)
    assert sorted(table.value) == list(range(len(keys))) and all(table.get(k) == i for i, k in enumerate(keys)) and table.get(b"qqqqzz") == -1
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng, codec = random.Random(3), bpe.Codec(keys, [ranks[k] for k in keys], table, public_tokenizers.PATTERN, memo=50)
    bits = ["a", "b", "th", "er", " ", "  ", "\n", "é", "ß", "'s", "1", "!", "　", "漢", "🎉", "ing", "X"]
    for _ in range(2000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(t) and codec.decode(ids) == t.encode()
    wide = bpe.merge(b"theringing" * 5, bpe.order(ranks, 33), 33)
    assert wide == bpe.merge(b"theringing" * 5, bpe.order(ranks))
    docs, rows = odd_docs(spark)
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.token_digests(docs).collect()), key=str)
    want = []
    for d, t in rows:
        ids = np.array(enc.encode_ordinary(t or ""), "<u4")
        want.append((d, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.token_digests(docs.limit(0)).collect() == []


def test_shards_hold_every_row_once(spark):
    docs, rows = odd_docs(spark)
    many = docs.unionByName(spark.range(100, 400).selectExpr("id doc_id", "repeat('t', cast(id as int)) text", "'' lang", "'' source", "1 n_chars",
                                                             "'' score", "'' ids", "'' shard"))
    got = shards.shuffle_shards(many, 16, bucket_bytes=4000)
    out = got.collect()
    assert len(out) == len(rows) + 300 and set(got.columns) == set(many.columns) | {"slot"}
    by = [sorted(r["slot"] for r in out if r["shard"] == s) for s in range(16)]
    assert all(x == list(range(len(x))) for x in by) and max(map(len, by)) - min(map(len, by)) <= 1
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in shards.shuffle_shards(many.repartition(5), 16, bucket_bytes=4000).collect()}
    assert {x for x in again if x[0] and x[0] >= 100} == {(r["doc_id"], r["shard"], r["slot"]) for r in out if r["doc_id"] and r["doc_id"] >= 100}
    digests = shards.shard_digests(many).collect()
    want = sorted((str(d), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in digests if r["doc_id"] is None or r["doc_id"] < 100) == want
    assert shards.shard_digests(many.limit(0)).collect() == []


def test_packing_covers_every_id_once(spark):
    docs, rows = odd_docs(spark)
    small, _ = tables(spark)
    docs = docs.select("doc_id", "text").unionByName(small.selectExpr("doc_id + 1000 doc_id", "text")).repartition(6)
    rows = rows + [(r["doc_id"] + 1000, r["text"]) for r in small.collect()]
    tok = Tokenizer.from_file(packing.VOCABULARY)
    out = packing.packed(docs, open_windows=4, fan_in=2).collect()
    ids = {}
    for r in out:
        ids.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], bytes(r["ids"]), r["length"]))
    want = {}
    for d, t in rows:
        x = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        want.setdefault((d, len(x) // 4), []).append(x)
    assert ids.keys() == want.keys()
    for k, pieces in ids.items():
        assert sorted(b for _, b, _ in pieces) == sorted(x[4 * s:4 * (s + 1024)] for x in want[k] for s in range(0, len(x) // 4, 1024))
    windows = {}
    for r in out:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for w in windows.values():
        at = 0
        for o, n in sorted(w):
            assert o == at
            at += n
        assert at <= 1024
    used = sum(r["length"] for r in out)
    assert len(windows) * 1024 < 1.06 * used
    assert packing.piece_digests(docs.limit(0)).collect() == []


def test_vocabulary_files_agree():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(bpe.VOCABULARY, "rb"))}
    assert len(ranks) == 50256
    enc = packing.encoder(packing.VOCABULARY)
    for t in ODD:
        assert enc(t or "").tolist() == Tokenizer.from_file(packing.VOCABULARY).encode(t or "", add_special_tokens=False).ids


def test_pipeline_stages_match_brute_force(spark):
    docs, labels = tables(spark)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "toxicity", "dedup", "secrets", "packing"] and corpus_pipeline.ORACLE_SQL is None
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF_SMALL)
        assert out.columns == docs.columns
        before, after = {r["doc_id"]: r for r in kept.collect()}, {r["doc_id"]: r for r in out.collect()}
        if name == "quality":
            want = {r["doc_id"] for r in quality.quality(kept, labels).collect() if r["predicted"] == 1}
        elif name == "toxicity":
            want = {r["doc_id"] for r in toxicity.toxicity(kept, labels).collect() if r["predicted"] == 0}
        elif name == "dedup":
            from test_pairs import roots, shingles
            ids = sorted(before)
            sets = [shingles(before[i]["text"]) for i in ids]
            links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and 100 * len(a & b) >= 80 * len(a | b)]
            want = {ids[r] for r in roots(len(ids), links)}
        else:
            want = set(before)
            assert all(after[i]["text"] == secret_scan.mask(r["text"], secret_scan.find_spans(r["text"])) for i, r in before.items())
        assert set(after) == want
        kept = spark.createDataFrame(list(after.values()), docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_SMALL).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in kept.collect()}
    assert corpus_pipeline.run(spark, SF_SMALL).count() == len(packed)


def test_held_out_rule(spark):
    got = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


@pytest.mark.parametrize("make", [
    lambda n: 's = ""\n' + "".join(f's = s + "abc def {i}"\n' for i in range(n)),
    lambda n: 'a="b"+' * n,
    lambda n: "".join(f"v{i} = v{i + 1} + v{i + 1}\n" for i in range(n)) + f'v{n} = "x1"\n',
    lambda n: "".join(f'w{i % 50} = w{(i * 7 + 1) % 50} + "q{i}"\n' for i in range(n))])
def test_accumulating_code_takes_linear_time(make):
    import time

    text = make(30_000)
    start = time.process_time()
    secret_scan.find_spans(text)
    assert time.process_time() - start < 20


def test_weights_reach_literals_behind_long_sums():
    parts = "".join(f's = s + "x{i} y"\n' for i in range(300))
    text = f's = "h8Kq2ZpL0vXs7Rt4"\n{parts}password = s\n'
    at = text.index("h8Kq")
    assert (at, at + 16, "named") in secret_scan.find_spans(text)
    assert secret_scan.find_spans(text.replace("password = s", "colour = s")) == []
    joined = 'a = "h8Kq2Z"\nb = "pL0vXs7Rt4"\npassword = a + b\n'
    assert [joined[s:e] for s, e, k in secret_scan.find_spans(joined) if k == "named"] == ["h8Kq2Z", "pL0vXs7Rt4"]
