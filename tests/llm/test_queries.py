"""Every registered operator query and the whole pipeline over the smallest tables, against brute force in plain Python."""

import hashlib
import itertools
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from playlog.llm import common, decontaminate, queries, quality, secrets
from playlog.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rows(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


@pytest.fixture(scope="module")
def docs():
    return {r["doc_id"]: r for r in rows("documents")}


def crc(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def text_of(r):
    return r["text"] or ""


def test_op1(spark, docs):
    out = queries.op1_media(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        raw = text_of(docs[r.doc_id]).encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        wave = b"RIFF" + (36 + len(payload)).to_bytes(4, "little") + b"WAVEfmt " + bytes.fromhex("100000000100010040 1f0000401f000001000800".replace(" ", "")) + b"data" + len(payload).to_bytes(4, "little") + payload
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(wave), hashlib.sha256(wave).hexdigest())
        assert r.feature.startswith(f"n={len(payload)};sum={sum(payload) - 128 * len(payload)};squares={sum((b - 128) ** 2 for b in payload)};")
        assert r.caption == f"document of {len(raw)} bytes" and r.position == r.text_items


def encoded(texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    return {k: [*plain.encode(t, add_special_tokens=False).ids, 2] for k, t in texts.items()}


def check_pieces(pieces, ids):
    held, sequences = {}, {}
    for p in pieces:
        held.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append(p)
    assert held.keys() == ids.keys()
    for k, own in held.items():
        at = 0
        for p in sorted(own, key=lambda p: p.start):
            part = ids[k][at : at + p.length]
            assert (p.start, p.doc_tokens) == (at, len(ids[k])) and p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            at += p.length
        assert at == len(ids[k])
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    assert sorted(sequences) == list(range(-(-sum(map(len, ids.values())) // 4096)))


def test_op2(spark, docs):
    check_pieces(queries.op2_packing(spark, SF).collect(), encoded({k: text_of(r) for k, r in docs.items()}))


def slow_curve_key(ids, packing, projection, slot, sign):
    """A document's place on the curve, one number at a time: the curve's axes are undone bit by bit, from the highest down."""
    vector = [0.0] * packing.HASH_DIMS
    for i in ids:
        vector[slot[i]] += sign[i]
    damped = [math.copysign(math.log1p(abs(v)), v) for v in vector]
    norm = math.sqrt(sum(v * v for v in damped)) or 1.0
    axes = [sum(v / norm * float(projection[k][d]) for k, v in enumerate(damped) if v) * math.sqrt(packing.HASH_DIMS) for d in range(packing.CURVE_DIMS)]
    bits, dims = packing.CURVE_BITS, packing.CURVE_DIMS
    x = [min(max(int((1 << bits) / (1 + math.exp(-1.702 * a / 2))), 0), (1 << bits) - 1) for a in axes]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(dims):
            if x[d] >> b & 1:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[d]) & low
                x[0], x[d] = x[0] ^ swap, x[d] ^ swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = 0
    for b in range(bits - 1, 0, -1):
        if x[-1] >> b & 1:
            flip ^= (1 << b) - 1
    return int("".join(str((v ^ flip) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2), axes


def test_op2_follows_the_curve(spark, docs):
    """Documents lie in the sequences in the order of their places on the curve."""
    from playlog.llm import packing

    ids = encoded({k: text_of(r) for k, r in docs.items()})
    rng, size = np.random.default_rng(20240229), packing.WordTokenizer(tokenizer_path()).size
    slot, sign = rng.integers(0, packing.HASH_DIMS, size), rng.choice([-1.0, 1.0], size)
    projection = (rng.standard_normal((packing.HASH_DIMS, packing.CURVE_DIMS)) / np.sqrt(packing.HASH_DIMS)).astype(np.float32)
    keys = {k: slow_curve_key(own[:-1], packing, projection, slot, sign) for k, own in ids.items()}
    starts = sorted((p.sequence_id, p.offset, p.doc_id) for p in queries.op2_packing(spark, SF).collect() if p.start == 0)
    order = [keys[k][0] for *_, k in starts]
    edge = lambda axes: min(abs((a := (1 << packing.CURVE_BITS) / (1 + math.exp(-1.702 * v / 2))) - round(a)) for v in axes)
    clear = [keys[k][0] for *_, k in starts if edge(keys[k][1]) > 1e-2]  # sums in another order may fall on a cell's other side
    assert clear == sorted(clear) and len(clear) > 0.7 * len(order) and len(set(order)) > 0.5 * len(order)


def grams(text):
    words = re.sub(r"[\W\d_]+", " ", text.lower()).split()
    out = Counter()
    for w in words:
        out.update(w)
        padded = f" {w} "
        out.update(padded[k : k + 2] for k in range(len(padded) - 1))
        out.update(padded[k : k + 3] for k in range(len(padded) - 2))
    return out


def ranked(counts, size=400):
    packed = lambda g: int.from_bytes(b"", "big") if not g else sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], packed(x[0])))[:size]]


def test_op3(spark, docs):
    """With so few rows the sample is all of them, so the profiles are those of all learned texts."""
    totals = {}
    for k, r in docs.items():
        if r["lang"] is not None and crc(k, 4) != 2 and re.search(r"[^\W\d_]", text_of(r)):
            totals.setdefault(r["lang"], Counter()).update(grams(r["text"]))
    places = {lang: {g: n for n, g in enumerate(ranked(c))} for lang, c in totals.items()}
    out = {r.doc_id: r for r in queries.op3_langid(spark, SF).collect()}
    assert out.keys() == docs.keys()
    for k, r in docs.items():
        assert out[k].held_out == (crc(k, 4) == 2) and 0 <= out[k].score <= 1
        if not re.search(r"[^\W\d_]", text_of(r)):
            assert out[k].lang_pred == "und"
            continue
        own = ranked(grams(r["text"]))
        sums = {lang: sum(abs(place[g] - n) if g in place else 400 for n, g in enumerate(own)) for lang, place in places.items()}
        assert out[k].lang_pred == min(sums, key=lambda lang: (sums[lang], lang))


def test_op4(spark, docs):
    from tests.llm.test_pairs import slow_components, slow_fingerprint

    ids = sorted(docs)
    fps = [slow_fingerprint(text_of(docs[k])) for k in ids]
    roots = slow_components(len(ids), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    out = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash(spark, SF).collect()}
    assert out == {k: (f"{fps[n]:016x}", ids[roots[n]]) for n, k in enumerate(ids)}


def words_of(text):
    return re.findall(r"\w+", re.sub("_", " ", text.lower()))


def leaks(texts):
    """(document, item) of all windows within a fifth of the item's words in edits."""
    found = set()
    for item in rows("benchmark"):
        a = words_of(item["text"] or "")
        for k, text in texts.items():
            b = words_of(text)
            code = {w: n for n, w in enumerate({*a, *b})}
            if a and decontaminate.edit_distance([code[w] for w in a], [code[w] for w in b], inside=True) <= len(a) // 5:
                found.add((k, item["item_id"]))
    return found


def test_op5(spark, docs):
    want = leaks({k: text_of(r) for k, r in docs.items()})
    out = {(r.doc_id, r.item_id) for r in queries.op5_decontamination(spark, SF).collect()}
    assert out <= want and len(out) >= 0.95 * len(want) and want


def test_op6(spark, docs):
    out = {r.doc_id: r for r in queries.op6_quality(spark, SF).collect()}
    assert out.keys() == docs.keys()
    by_text = {}
    for k, r in docs.items():
        assert out[k].held_out == (crc(k, 5) == 0) and 0 <= out[k].score <= 1 and out[k].predicted == int(out[k].score >= 0.3)
        assert out[k].lines == text_of(r).count("\n") + 1 >= out[k].bad_lines
        assert by_texts_equal(by_text, text_of(r), out[k].score)
    labelled = {r["doc_id"]: r["quality"] for r in rows("labels") if r["quality"] is not None and r["doc_id"] in docs}
    right = [out[k].predicted == y for k, y in labelled.items() if crc(k, 5) == 0]
    assert sum(right) >= 0.9 * len(right)


def slow_line(line, before):
    """The numbers of a line, character by character; ``before``: the lines above it."""
    words = re.findall(rb"[^ \t\n\r\x0b\x0c]+", line)
    if not words:
        return [0.0] * 10 + [1.0, 1.0, 0.0]
    n, count = len(words), lambda chars: sum(line.count(bytes([c])) for c in chars)
    twice = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        count(b"#$%&*+<>=@[]^_`{|}~\\") / n, sum(65 <= c <= 90 for c in line) / len(line), line.count(b"|") / n, line.count(b"!") / n, 1 - len(set(words)) / n, twice / n,
        sum(48 <= c <= 57 for c in line) / len(line), math.log(len(line)), float(line in before), len(line) / n / 10, 0.0, float(n < 4), sum(len(w) < 4 for w in words) / n,
    ]


def slow_score(text, field):
    """The field's score: all labellings of up to eight lines, and plain sums over paths beyond."""
    lines = text.encode().split(b"\n")
    x = [slow_line(line, lines[:k]) for k, line in enumerate(lines)]
    none, scores = [0.0] * 13, []
    for k in range(len(x)):
        wide = [*x[k], *(x[k - 1] if k else none), *(x[k + 1] if k + 1 < len(x) else none), float(k == 0), float(k == len(x) - 1)]
        units = [max(-4.0, min(4.0, (v - m) / s)) for v, m, s in zip(wide, field.mean, field.spread, strict=True)]
        scores.append(max(-30.0, min(30.0, sum(u * w for u, w in zip(units, field.weights, strict=True)) + field.bias)))
    moves, n = field.moves.tolist(), len(x)
    if n <= 8:
        weights = {y: math.exp(sum(s * v for s, v in zip(scores, y, strict=True)) + sum(moves[a][b] for a, b in zip(y, y[1:], strict=False))) for y in itertools.product((0, 1), repeat=n)}
        good = [sum(w for y, w in weights.items() if y[k]) / sum(weights.values()) for k in range(n)]
    else:
        add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b)))
        ahead, back = [[0.0, scores[0]]], [[0.0, 0.0]]
        for s in scores[1:]:
            ahead.append([add(ahead[-1][0] + moves[0][v], ahead[-1][1] + moves[1][v]) + s * v for v in (0, 1)])
        for s in reversed(scores[1:]):
            back.append([add(moves[v][0] + back[-1][0], moves[v][1] + s + back[-1][1]) for v in (0, 1)])
        good = []
        for a, b in zip(ahead, reversed(back), strict=True):
            good.append(1 / (1 + math.exp(min(700, a[0] + b[0] - a[1] - b[1]))))
    raw = sum(g * (len(line) + 1) for g, line in zip(good, lines, strict=True)) / sum(len(line) + 1 for line in lines)
    raw = min(max(raw, 1e-6), 1 - 1e-6)
    return 1 / (1 + math.exp(-(field.slope * math.log(raw / (1 - raw)) + field.shift)))


def test_op6_scores(spark, docs):
    """Every document's score, from the field that the query learns."""
    field = quality.learned(common.table(spark, SF, "documents"), common.table(spark, SF, "labels"))
    out = {r.doc_id: r.score for r in queries.op6_quality(spark, SF).collect()}
    for k, r in docs.items():
        assert out[k] == pytest.approx(slow_score(text_of(r), field), abs=1e-7)


def test_the_sample_is_bounded_in_lines(spark):
    """A labelled text of very many lines is drawn from evenly, and no more of it comes to the driver than of others."""
    long_text = "\n".join(f"line {k} of a long text" for k in range(200_000))
    learned_ids = [k for k in range(50) if crc(k, 5)][:4]
    docs = spark.createDataFrame(list(zip(learned_ids, [long_text, "short\nand plain", "x !!! ###", None], strict=True)), "doc_id long, text string")
    labels = spark.createDataFrame(list(zip(learned_ids, [1, 1, 0, 0], strict=True)), "doc_id long, quality int")
    counts, sample = quality.sampled(docs, labels)
    assert counts == {1: 2, 0: 2} and sorted(len(x) for _, _, x in sample)[:3] == [1, 1, 2] and max(len(x) for _, _, x in sample) <= quality.SAMPLE_BLOCKS * quality.FIT_LINES
    marked = quality.drawn_lines(np.arange(200_000)[:, None])[:, 0]
    assert marked[0] == 0 and marked[-1] == 199_999 and max(np.diff(marked)) <= 200_000 // (quality.SAMPLE_BLOCKS - 1)
    assert 0 <= quality.learned(docs, labels).score([0.5], np.array([3.0])) <= 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_quality_and_language_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    right = [r.predicted == labels[r.doc_id] for r in queries.op6_quality(spark, sf).collect() if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(right) >= 0.95 * len(right) and len(right) > 50
    langs = dict(zip(*pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "lang"]).to_pydict().values(), strict=True))
    right = [r.lang_pred == langs[r.doc_id] for r in queries.op3_langid(spark, sf).collect() if r.held_out and langs[r.doc_id] and r.lang_pred != "und"]
    assert sum(right) >= 0.98 * len(right) and len(right) > 100


def by_texts_equal(seen, text, value):
    return seen.setdefault(text, value) == value


def base(text):
    kinds = [
        ("assign", r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
        ("access", "AKIA[A-Z0-9]+", 0, 16),
        ("hex", "[0-9a-f]+", 0, 32),
    ]
    return sorted((m.start(), n, m.end(), kind) for n, (kind, pattern, group, least) in enumerate(kinds) for m in re.finditer(pattern, text) if len(m[group]) >= least)


def test_op8(spark, docs):
    model = secrets.trained(common.table(spark, SF, "documents"))
    out = {r.doc_id: r for r in queries.op8_secrets(spark, SF).collect()}
    assert out.keys() == docs.keys()
    for k, r in docs.items():
        spans = base(text_of(r))
        own = out[k]
        joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert [own.n_assign, own.n_access, own.n_hex] == [sum(s[3] == kind for s in spans) for kind in ("assign", "access", "hex")]
        assert own.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in own.spans.split(",") if s and not s.startswith("markov")] == joined.split(",") * bool(joined)
        assert [s for s in own.spans.split(",") if s.startswith("markov")] == [f"markov:{a}:{b}" for a, b in random_runs(text_of(r), model)]


def test_op9(spark, docs):
    out = queries.op9_sharding(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    shards, homes = {k: [] for k in range(24)}, {}
    for r in out:
        raw = text_of(docs[r.doc_id]).encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        shards[r.shard].append(r.slot)
        homes.setdefault(raw, Counter())[r.shard] += 1
    counts = [len(v) for v in shards.values()]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in shards.values())
    grouped = {t: c for t, c in homes.items() if c.total() > 1}
    apart = sum(c.total() - max(c.values()) for c in grouped.values())
    assert apart <= sum(max(0, c.total() - min(counts)) for c in grouped.values()) + 0.1 * sum(c.total() for c in grouped.values())


def random_runs(text, model):
    """Runs of key characters that no fixed pattern covers and whose likeliest random model beats the likeliest ordinary one, character by character."""
    covered, out = [(a, b) for a, _, b, _ in base(text)], []
    for m in re.finditer("[A-Za-z0-9+/_=.-]{20,}", text):
        word = m[0].rstrip(".-")
        if len(word) < 20 or any(a <= m.start() and m.start() + len(word) <= b for a, b in covered):
            continue
        codes = [0, 0, *(1 + secrets.KEY_CHARS.index(c) for c in word)]
        sums = [[sum(m[codes[k]][codes[k + 1]][codes[k + 2]] for k in range(len(word))) for m in side] for side in (model.random, model.ordinary)]
        if (max(sums[0]) - max(sums[1])) / len(word) >= secrets.RATIO:
            out.append((m.start(), m.start() + len(word)))
    return out


def test_pipeline(spark, docs):
    """Each stage by brute force over what the one before keeps; the field's weights are the trained ones."""
    from tests.llm.test_neardup import survivors

    field = quality.learned(common.table(spark, SF, "documents"), common.table(spark, SF, "labels"))

    def good(text):
        x, lengths = quality.line_features(text.encode())
        return field.score(field.marginals(x), lengths) >= 0.3

    kept = {k: text_of(r) for k, r in docs.items() if good(text_of(r))}
    kept = {k: kept[k] for k in survivors(list(kept.items()))}
    found = {k for k, _ in leaks(kept)}
    kept = {k: t for k, t in kept.items() if k not in found}
    model = secrets.trained(spark.createDataFrame(list(kept.items()), "doc_id long, text string"))
    for k, t in kept.items():
        out, at = [], 0
        for a, b in sorted([(a, b) for a, _, b, _ in base(t)] + random_runs(t, model)):
            if a >= at:
                out += [t[at:a], "<secret>"]
            at = max(at, b)
        kept[k] = "".join(out) + t[at:]
    before = len(common.staged())
    pieces = corpus_pipeline.run(spark, SF).collect()
    check_pieces(pieces, encoded(kept))
    assert len(common.staged()) == before  # what others staged stays, and nothing of its own
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "packing"]


def test_two_pipelines_at_once(spark, docs):
    """Neither deletes what the other, or a lazy query beside them, still reads."""
    from concurrent.futures import ThreadPoolExecutor

    beside = queries.op4_simhash(spark, SF)
    with ThreadPoolExecutor(2) as pool:
        one, two = (sorted(map(tuple, f.result().select("doc_id", "start", "length", "ids_crc32").collect())) for f in [pool.submit(corpus_pipeline.run, spark, SF) for _ in range(2)])
    assert [r[0] for r in one] == [r[0] for r in two] and beside.count() == len(docs)
