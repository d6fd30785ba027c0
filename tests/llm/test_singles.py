"""The other operators against brute force, round trips and held-out rows."""

import hashlib
import io
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from playlog.llm import langid as L
from playlog.llm import media as M
from playlog.llm import packing as P
from playlog.llm import quality as Q
from playlog.llm import secrets as X
from playlog.llm import sharding as H
from playlog.llm import urlfilter as U
from playlog.llm import warc as W
from playlog.llm.queries import URL_BLOCKED, URL_RULES, tokenizer_path


# media
@given(st.binary(max_size=300))
@settings(max_examples=100, deadline=None)
def test_wave_round_trip(data):
    payload = M.payload_of(data)
    assert len(payload) % 64 == 0 and len(payload) > 0 and payload[: len(data)] == data and not any(payload[len(data) :])
    assert M.decode_wave(M.encode_wave(payload)) == payload
    assert M.decode_wave(M.encode_wave(data)) == data


def test_html_sequence():
    page = '<h1>A &amp; B</h1><p>one<figure><img src="sha256:AB"><img src="x.png" alt="q"><figcaption>cap <b>t</b></figcaption></figure>two<script>no</script> three<img src="sha256:cd" alt="alt"></p><style>p{}</style>'
    items = M.parse_html(page)
    assert [(i["position"], i["kind"], i["text"], i["digest"], i["caption"]) for i in items] == [
        (0, "text", "A & B", None, None), (1, "text", "one", None, None), (2, "media", "sha256:AB", "ab", "cap t"), (3, "media", "x.png", None, "cap t"),
        (4, "text", "two three", None, None), (5, "media", "sha256:cd", "cd", "alt"),
    ]
    first = M.parse_html('<figure><figcaption>before</figcaption><video src="sha256:1"></video></figure>')
    assert first[0]["caption"] == "before" and M.parse_html(None) == [] and M.parse_html("<p") in ([], M.parse_html("<p"))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<figure><img src=x><figcaption>cap</figure><p>body text after", [("media", "x", "cap"), ("text", "body text after", None)]),
        ("<figure><img src=x><figcaption>cap<p>body text after", [("media", "x", "cap"), ("text", "body text after", None)]),
        ("<figure><img src=x><figcaption><p>cap</p></figcaption></figure>end", [("media", "x", "cap"), ("text", "end", None)]),
        ("<figure><figcaption>out</figcaption><img src=a><figure><img src=b><figcaption>in</figcaption></figure></figure>", [("media", "a", "out"), ("media", "b", "in")]),
        ("<figure><figure><img src=b></figure><figcaption>out</figcaption></figure>", [("media", "b", "out")]),
        ("<template><img src=q>no</template><noscript><img src=z></noscript>yes", [("text", "yes", None)]),
        ("<title>abc<p>def", [("text", "def", None)]),
        ("x<figcaption>stray</figcaption>y", [("text", "x", None), ("text", "stray", None), ("text", "y", None)]),
        ("<figure><table><tr><td>1</table><figcaption>T</figcaption></figure>", [("text", "1", None), ("text", "T", None)]),
        ("<figcaption>open to the end", [("text", "open to the end", None)]),
    ],
)
def test_captions_and_hidden_parts(page, want):
    assert [(i["kind"], i["text"], i["caption"]) for i in M.parse_html(page)] == want


def test_pages_against_a_tree_walk():
    """Every page of the table: the blocks' texts in order, as a tree of tags gives them."""
    import html
    import os

    import pyarrow.parquet as pq

    if not os.path.exists("/root/testdata/sf0.01/pages.parquet"):
        pytest.skip("no test tables")
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        shown = re.sub(r"(?s)<!--.*?-->|<!DOCTYPE[^>]*>|<(script|style|title)\b.*?</\1>", "", page or "")
        shown = re.sub(r"(?s)</?(?:a|b|html|head|body|meta)(?=[ >/])[^>]*>", "", shown)  # tags that part no words
        blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"(?s)</?[a-z][^>]*>", shown)]
        assert [i["text"] for i in M.parse_html(page)] == [b for b in blocks if b]


def test_unknown_digest_keeps_its_place(spark):
    pages = spark.createDataFrame([(1, '<p>t</p><img src="sha256:00" alt="c">')], "id int, html string")
    refs = M.references(M.parse_interleaved(pages, keep=("id",)), ("id",))
    row = M.resolve(refs, M.described(spark.createDataFrame([], "digest string, media binary"))).first()
    assert (row.position, row.caption, row.payload_bytes) == (1, "c", None)


def test_media_query(spark):
    texts = {1: "a", 2: None, 3: "a", 4: "é<b>&amp;\n\n" * 40, 5: "x" * 64}
    rows = {r.doc_id: r for r in M.media_features(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for k, t in texts.items():
        p = M.payload_of((t or "").encode())
        r = rows[k]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert r.media_sha256 == hashlib.sha256(M.encode_wave(p)).hexdigest() and r.media_bytes == len(p) + 44
    assert rows[1].feature == rows[3].feature != rows[2].feature


# packing
@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = P.hilbert_key(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_token_ids_are_the_tokenizers():
    import pyarrow as pa
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    texts = ["", "It's we'll don't a_b __ x²y 1,234 ÀÉ 'S ISN'T <|endoftext|> q", "日本語 テキスト", "é x y\x1cz", "İstanbul ſs", "a.b,c,, d..", "o'clock ''s 're'red l'll'd", "Hello, world.Next\tline\nΣΑΣ", None, "ß" * 50, "word " * 3000]
    own = P.WordTokenizer(tokenizer_path())
    old, P.CACHE_WORDS = P.CACHE_WORDS, 4
    try:
        for part in (texts, texts[::-1], texts):
            ids, ends = own.encode(pa.array(part, pa.string()))
            assert [x.tolist() for x in np.split(ids, ends[:-1])] == [plain.encode(t or "", add_special_tokens=False).ids for t in part]
    finally:
        P.CACHE_WORDS = old


def test_packing(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(3)
    texts = {k: " ".join(rng.choices("alpha beta gamma delta, epsilon. zeta".split(), k=rng.choice([0, 1, 50, 400, 9000]))) for k in range(60)} | {99: None}
    pieces = P.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), tokenizer_path()).collect()
    for k, t in texts.items():
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        own = sorted((p for p in pieces if p.doc_id == k), key=lambda p: p.start)
        assert [i for p in own for i in struct.unpack(f"<{p.length}I", p.ids)] == ids
        assert all(zlib.crc32(p.ids) == p.ids_crc32 and p.doc_tokens == len(ids) for p in own)
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
    total, by = sum(p.length for p in pieces), {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p)
    assert sorted(by) == list(range(-(-total // 4096)))
    for s, own in by.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        used = own[-1].offset + own[-1].length
        assert used == 4096 if s < len(by) - 1 else used <= own[0].padded_length <= 4096


# language
def test_profiles_and_out_of_place():
    grams, counts = L.gram_counts("Ab ab! b2")
    have = {"".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0)).replace("\0", ""): n for g, n in zip(grams.tolist(), counts.tolist(), strict=True)}
    assert have == {"a": 2, "b": 3, " a": 2, "ab": 2, "b ": 3, " b": 1, " ab": 2, "ab ": 2, " b ": 1}
    order = L.ranking(grams, counts, 3)
    want = sorted(zip((-counts).tolist(), grams.tolist(), strict=True))[:3]
    assert order.tolist() == [g for _, g in want]
    own, profile = np.array([5, 7, 9]), np.array([7, 5])
    at = np.argsort(profile)
    assert L.out_of_place(own, profile[at], at, 10) == 1 + 1 + 10
    assert L.predict_one("12 !!", {"en": (profile[at], at)}) == ("und", 0.0) and L.predict_one("abc", {}) == ("und", 0.0)


def test_language_held_out(spark):
    rng = random.Random(4)
    parts = {"aa": "ka ko ku ki la".split(), "bb": "sch ung ei heit der".split(), "cc": "ion que eau les".split()}
    text = lambda lang: " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(30))
    rows = [(k, text(lang), lang) for k, lang in enumerate(rng.choices(list(parts), k=150))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in L.identify(df.filter("doc_id >= 75"), L.profiles(df.filter("doc_id < 75"))).collect()}
    assert sum(got[k].lang_pred == lang for k, _, lang in rows[75:]) >= 74


def test_one_hot_id_is_a_sample_too(spark):
    """Rows that share an id, or have none, are drawn row by row."""
    rows = [(7 if k % 2 else None, f"ka ko {k}", "aa") for k in range(3000)]
    known = L.profiles(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=300)
    grams, ranks = known["aa"]
    assert len(grams) > 5
    digits = L.profiles(spark.createDataFrame([(1, "ab" + chr(945 + k % 20) * 3, "aa") for k in range(4000)], "doc_id long, text string, lang string"), sample=5)
    assert 0 < len(digits["aa"][0]) < 80  # five rows or so, not all 20 kinds


# quality
def test_messages_against_all_labellings():
    rng = np.random.default_rng(6)
    s, moves = rng.normal(size=(3, 5)), rng.normal(size=(2, 2))
    mask = np.array([[1] * 5, [1] * 3 + [0] * 2, [1] + [0] * 4], bool)
    good, pairs = Q._messages(s * mask, moves, mask)
    seen = np.zeros((2, 2))
    for row in range(3):
        n = int(mask[row].sum())
        total, node = 0.0, np.zeros(n)
        edge = np.zeros((2, 2))
        for bits in range(2**n):
            y = [bits >> k & 1 for k in range(n)]
            w = np.exp(sum(s[row, k] for k in range(n) if y[k]) + sum(moves[y[k], y[k + 1]] for k in range(n - 1)))
            total += w
            node += w * np.array(y)
            for k in range(n - 1):
                edge[y[k], y[k + 1]] += w
        assert np.allclose(good[row, :n], node / total)
        seen += edge / total
    assert np.allclose(pairs, seen)


def test_marginals_equal_messages():
    rng = np.random.default_rng(8)
    f = Q.LineField(weights=rng.normal(size=3 * Q.FEATURES + 2), bias=0.3, moves=rng.normal(size=(2, 2)))
    x = rng.normal(size=(6, Q.FEATURES))
    s = (Q.with_neighbours(x) @ f.weights + f.bias)[None].clip(-30, 30)
    good, _ = Q._messages(s, f.moves, np.ones((1, 6), bool))
    assert np.allclose(f.marginals(x), good[0], atol=1e-9)


def test_quality_held_out(spark):
    rng = random.Random(9)
    words = "the of and there thing with rather other every".split()
    line = lambda bad: " ".join(w + rng.choice(["***", "%%%", "!!"]) * bad for w in rng.choices(words, k=rng.randint(3, 20)))
    rows = [(k, "\n".join(line(k % 4 == 0 and rng.random() < 0.9) for _ in range(rng.randint(1, 9)))) for k in range(400)]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, int(k % 4 != 0)) for k in range(400)], "doc_id long, quality int")
    field = Q.learned(docs, labels)
    out = {r.doc_id: r for r in Q.score_lines(docs, field).collect()}
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert sum(out[k].predicted == int(k % 4 != 0) for k in held) >= 0.95 * len(held)
    assert all(len(out[k].line_good) == out[k].lines for k in out)
    assert Q.learned(docs, labels.filter("quality = 1")).constant == 1.0


# urls
def slow_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    under = lambda h: host == h or host.endswith("." + h)
    fit = max((r for r in URL_RULES if under(r[1]) and path.startswith(r[2])), key=lambda r: len(r[1] + r[2]), default=None)
    verdict = fit[0] if fit else "block" if any(under(b) for b in URL_BLOCKED) else "allow"
    return host, path, fit[1] + fit[2] if fit else None, verdict


def test_url_verdicts(spark):
    rng = random.Random(10)
    hosts = ["example.com", "A.Example.COM", "notexample.com", "example.net", "b.example.net", "casino-win.example.org", "x.adult-x.example.com", "org", "com", "net.", "", "é.com:80"]
    paths = ["", "/", "/en/", "/en/7", "/en/75?x#y", "/de/8/1", "/de/", "/es/q", "#a/en/", "?q=/en/", "/EN/7"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "a://b://c/d", "://", "http://" + ".".join("ab" * 50) + ".com/en/"]
    rng.shuffle(urls)
    rows = list(enumerate(urls))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES, URL_BLOCKED).collect()}
    assert got == {k: slow_verdict(u) for k, u in rows}


def test_long_hosts_cost_their_length():
    import tracemalloc

    host = ".".join(["ab"] * 40_000) + ".example.com"
    tracemalloc.start()
    keys = U.keys_of(host, "/" * 50_000, [4, 9], [1, 2, 3])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(keys) == 9 and "example.com" in keys and peak < 2_000_000


def test_long_lists_are_parted(spark):
    rng = random.Random(3)
    hosts = [f"h{k}.{rng.choice('abc')}.net" for k in range(400)]
    pages = spark.createDataFrame([(k, f"http://{rng.choice(['', 'x.'])}{h}{rng.choice(['/', '/de/9', '/en/'])}") for k, h in enumerate(hosts)], "page_id long, url string")
    blocked = spark.createDataFrame([(h,) for h in hosts[::3]] + [(None,), ("absent.org",)], "key string")
    one = {tuple(r) for r in U.judge(pages, URL_RULES, blocked).collect()}
    assert one == {tuple(r) for r in U.judge(pages, URL_RULES, blocked, most_keys=30).collect()}
    assert {r[0] for r in one if r[5] in hosts} >= set(range(0, 400, 3)) - {r[0] for r in one if r[3]}


@pytest.mark.parametrize("listed", [0, 1, 40, 3000])
def test_cascade_is_exact(spark, listed):
    keys = [f"k{k}" for k in range(3000)]
    levels = U.build_cascade(spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string"), spark.createDataFrame([(k,) for k in keys[:listed]] + [("absent",), (None,)], "key string"))
    assert [U.listed_by(levels, k) for k in keys] == [k < listed for k in range(3000)]


# secrets
def test_base_patterns():
    text = 'Token = "abcdefgh" token: secret: 12345678 api_key:x API-KEY="abcdefgh1" PASSWD=short AKIA' + "Q" * 12 + " AKIAX " + "a0" * 16 + "g" + "f" * 31 + " \u017fecret=abcdefghij"
    spans = X.base_spans(text)
    assert [(k, text[a:b]) for a, b, k in spans] == [("assign", 'Token = "abcdefgh'), ("access", "AKIA" + "Q" * 12), ("hex", "a0" * 16)]


@given(st.text(alphabet='tokenTOKEN=: "\'abcdef0123456789AKIAPQsecretapi_key', max_size=120))
@settings(max_examples=300, deadline=None)
def test_base_spans_equal_whole_scan(text):
    want = [(m.start(), m.end(), "assign") for m in re.finditer(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 8]
    want += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    want += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    model = X.KeyModel([X.KeyModel.counted(["a1b2"])], [X.KeyModel.counted(["word"])])
    got = [s for s in X.spans_of(text.encode(), model) if s[2] != "markov"]
    assert sorted(got) == sorted(want)


def test_corpus_counts_are_those_of_short_plain_words(spark):
    """Nothing that the models may judge is counted, nor runs with digits, marks or capitals inside, however a text is cut into pieces."""
    texts = ["ab cde\u00e9f-g Hij. NATO xY a1 x_y " + "token=abcdefgh12 x", "", None, "q" * 70_000 + " r", "abcdefghijklmnopqrstu vw", "one Two " * 300_000, "z" * 1_500_000 + " end"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    runs = [w for t in texts if t for w in re.findall("[A-Za-z0-9+/_=.-]+", t)]
    want = X.KeyModel.counted(w for w in runs if len(w) < X.RUN and re.fullmatch("([A-Z]?[a-z]+|[A-Z]{2,})[.-]?", w))
    assert (X.corpus_counts(docs) == want).all() and want.sum() > 1_000_000
    assert (X.corpus_counts(docs.unionByName(docs)) == 2 * want).all()


def test_keys_in_the_scanned_table_are_reported(spark, tmp_path):
    """Through the query and the stage: keys that stand in the scanned table once, and in fifty texts; and ordinary compounds of its languages."""
    pipeline = pytest.importorskip("corpus_pipeline")
    from playlog.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    some = [r.text for r in docs.filter("text is not null").limit(150).collect()]
    words = sorted({w for t in some for w in re.findall("[A-Za-z]{3,}", t)})
    draw = random.Random(77)
    keys = [k for kind in X.random_keys(25, seed=501) for k in kind]
    often = [k for kind in X.random_keys(2, seed=502) for k in kind]
    compounds = [c for c in (draw.choice(["", "-", "_", "."]).join(draw.sample(words, draw.randint(4, 7))).lower().capitalize() for _ in range(300)) if len(c) >= X.RUN]
    rows = [(10_000 + k, f"see {key} in use", key) for k, key in enumerate(keys)]
    rows += [(20_000 + 100 * k + j, f"note {j}: {key} again {j * j}", key) for k, key in enumerate(often) for j in range(50)]
    rows += [(30_000 + k, f"the {c} here", None) for k, c in enumerate(compounds)]
    docs.unionByName(spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t, _ in rows], docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    spans = {r.doc_id: r.spans for r in queries.op8_secrets(spark, f"file://{tmp_path}").collect()}
    where = lambda t, key: f"{t.index(key)}:{t.index(key) + len(key.rstrip('.-'))}"
    for some_rows in ([r for r in rows if 10_000 <= r[0] < 20_000], [r for r in rows if 20_000 <= r[0] < 30_000]):
        found = [where(t, key) in (spans[k] or "") for k, t, key in some_rows]
        assert sum(found) >= 0.97 * len(found)
    wrong = [k for k, _, key in rows if key is None and spans[k]]
    assert len(wrong) <= 0.01 * len(compounds)
    left = {r.doc_id: r.text for r in pipeline.secrets(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), f"file://{tmp_path}").collect()}
    assert sum(key not in left[k] and "<secret>" in left[k] for k, _, key in rows if key) >= 0.97 * sum(key is not None for _, _, key in rows)
    assert all(left[k] == t for k, t, key in rows if key is None and k not in wrong)


def test_key_models_and_redaction(spark):
    words = "configuration manager server response handler thinking thereby international communication".split()
    docs = spark.createDataFrame([(k, " ".join(words)) for k in range(30)] + [(99, None)], "doc_id long, text string")
    model = X.trained(docs)
    # strings that nothing was chosen by: other seeds than those of the samples
    keys = [k for kind in X.random_keys(300, seed=101) for k in kind]
    found = [k for k in keys if model.of(k) >= X.RATIO]
    assert len(found) >= 0.99 * len(keys)
    names = [n for n in X.identifiers(words, 600, seed=102) + X.identifiers(X.COMMON, 600, seed=103) + [s for kind in X.machine_strings(300, seed=104) for s in kind] if len(n) >= X.RUN]
    assert sum(model.of(n) >= X.RATIO for n in names) <= 0.01 * len(names)
    assert model.of("qwErTyUiOpAsDfGhJkLzXcVbNm") >= X.RATIO > model.of("550e8400-e29b-41d4-a716-446655440000")
    key = next(k for k in keys if k in found and re.search("[0-9]", k) and re.search("[A-Z]", k) and re.fullmatch("[A-Za-z0-9]+", k))
    text = f"see {key}, é token = abcdefgh12 and configurationManagerServer2 end"
    spans = X.find_spans(text, model)
    assert [(k, text[a:b]) for a, b, k in spans] == [("markov", key), ("assign", "token = abcdefgh12")]
    out = X.redacted(spark.createDataFrame([(1, text, 5, "kept")], "doc_id long, text string, n_chars long, spans string"), model).first()
    assert out.text == "see <secret>, é <secret> and configurationManagerServer2 end" and out.n_chars == len(out.text) and out.spans == "kept"
    assert X.replaced("abcdef", [(0, 3, "x"), (1, 2, "y"), (2, 5, "z")], "-") == "-f"


# shards
@pytest.mark.parametrize("copies", [[1] * 90, [40, 30] + [2] * 20 + [1] * 7, [97]])
def test_shards(spark, copies):
    rows, k = [], 0
    for g, n in enumerate(copies):
        for _ in range(n):
            rows.append((k, f"text {g}"))
            k += 1
    out = H.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()
    assert sorted(r.doc_id for r in out) == [d for d, _ in rows]
    text, by, homes = dict(rows), {}, {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
        homes.setdefault(text[r.doc_id], set()).add(r.shard)
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text[r.doc_id]) + 8, zlib.crc32(text[r.doc_id].encode()), "rows", None)
    sizes = [len(by.get(s, [])) for s in range(5)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    for g, n in enumerate(copies):
        assert len(homes[f"text {g}"]) <= -(-n // min(sizes)) + (n > min(sizes))


def test_links_of_several_groups(spark):
    """Two cliques that share a member: each stays together, whatever the other does."""
    links = [(k, "a") for k in range(8)] + [(k, "b") for k in range(7, 16)] + [(None, "a"), (3, None), (3, "a")]
    df = spark.range(40).withColumnRenamed("id", "row")
    placed = H.propagate(df, spark.createDataFrame(links, "row long, group string"), 2)
    cut = H.cut_links(placed, spark.createDataFrame([l for l in links if None not in l], "row long, group string")).first()
    assert placed.count() == 40 and cut.apart <= 1
    assert sorted(r["count"] for r in placed.groupBy("shard").count().collect()) == [20, 20]


# warc
def test_archive_bytes():
    records = [W.record(k, 7 * k, None if k == 3 else f"http://x/{k}", bytes([k]) * (k * 50), hashlib.sha256(bytes([k]) * (k * 50)).hexdigest(), 1 if k == 4 else None, 7 if k == 4 else None, k == 4) for k in range(40)]
    buffer = io.BytesIO()
    writer = W.ArchiveWriter(buffer)
    for r in records:
        writer.add(r)
    writer.close()
    data = buffer.getvalue()
    magic, size = struct.unpack("<II", data[:8])
    assert magic == 0x184D2A5D and list(W.read_records(io.BytesIO(data))) == records
    words = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    at, n = 8 + size, 0
    while at < len(data):  # every record is a frame of its own
        part = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
        assert part.decompress(data[at:]) == records[n]
        at, n = len(data) - len(part.unused_data), n + 1
    assert n == 40
    parsed = W.parse_record(records[4])
    assert (parsed["type"], parsed["refers_to"], parsed["payload"], parsed["length"]) == ("revisit", 1, None, 200) and W.parse_record(records[3])["url"] is None
    with pytest.raises(ValueError):
        list(W.read_records(io.BytesIO(data[:-30])))


def test_few_records_have_a_dictionary_too():
    for some in ([], [b"x"], [b""]):
        buffer = io.BytesIO()
        writer = W.ArchiveWriter(buffer)
        for r in some:
            writer.add(r)
        writer.close()
        assert list(W.read_records(io.BytesIO(buffer.getvalue()))) == some


def test_warc_round_trip(spark):
    rng = random.Random(12)
    bodies = ["<p>" + "".join(rng.choices("abc \r\n", k=n)) + "</p>" for n in (0, 10, 91, 92, 93, 400, 5000)]
    rows = [(k, f"http://e/{k}", rng.choice([*bodies, None, ""])) for k in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = W.write_archives(pages, f"{W.fresh_path(spark, 'test')}")
    got = {r.key: r for r in W.read_archives(names).collect()}
    first = {}
    for k, _, html in rows:
        first.setdefault(html or "", k)
    for k, url, html in rows:
        raw, r = (html or "").encode(), got[k]
        again = len(raw) >= 100 and first[html or ""] != k
        assert (r.type, r.refers_to, r.digest, r.length, r.url) == ("revisit" if again else "response", first[html or ""] if again else None, hashlib.sha256(raw).hexdigest(), len(raw), url)
        assert (r.payload is None) == again and (again or bytes(r.payload) == raw)
    assert Counter(r.type for r in got.values())["revisit"] > 20


def test_archives_go_where_spark_and_tasks_both_reach(spark, tmp_path):
    """A mount table is resolved to the store behind it; a store that tasks don't reach is refused before anything is written."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.arch.link./to", f"file://{tmp_path}")
    pages = spark.createDataFrame([(k % 5, f"http://x/{k}", "same page " * 20 if k % 2 else f"page {k} " * 30) for k in range(40)], "page_id long, url string, html string")
    names = W.write_archives(pages, "viewfs://arch/to/archives")
    assert names.count() and all(r.path.startswith(f"file://{tmp_path}/archives/") for r in names.collect())
    assert sorted(r.key for r in W.read_archives(names).collect()) == sorted(k % 5 for k in range(40))
    raw = [W.parse_record(r) for n in names.collect() for r in W.read_records(open(n.path.removeprefix("file://"), "rb"))]
    assert len({r["name"] for r in raw}) == 40  # ids repeat, names of records don't
    assert W.arrow_uri(spark, str(tmp_path / "bare"), make=True) == f"file://{tmp_path}/bare" and (tmp_path / "bare").is_dir()
    conf.set("fs.odd.impl", "org.apache.hadoop.fs.viewfs.ViewFileSystem")
    for folder in ("odd://store/x", "nowhere://store/x"):
        with pytest.raises(Exception):
            W.write_archives(pages, folder)
