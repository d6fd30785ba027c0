"""Near-duplicates, components and leaks against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from xxhash import xxh64_intdigest

from playlog.llm import decontaminate as D
from playlog.llm import simhash as S
from playlog.llm.components import components


def slow_fingerprint(text: str) -> int:
    import re

    low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@given(st.text(alphabet="aB É\t\n\x0b\x1c\u00a0ßxyz ", max_size=60))
@settings(max_examples=200, deadline=None)
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == slow_fingerprint(text)


def slow_components(n, linked):
    root = list(range(n))
    for a in range(n):
        for b in range(a):
            if linked(a, b) and root[a] != root[b]:
                x, y = sorted((root[a], root[b]))
                root = [x if r == y else r for r in root]
    return root


@pytest.mark.parametrize(("within", "spread"), [(2, 6), (2, 3), (4, 12)])
def test_shard_search_and_routing(within, spread):
    rng = np.random.default_rng(spread)
    centres = rng.integers(0, 2**63, 60, np.uint64)
    points = np.unique(np.concatenate([centres] + [centres ^ np.bitwise_or.reduce([np.uint64(1) << rng.integers(0, 64, 60, np.uint64) for _ in range(int(k))]) for k in rng.integers(1, spread, 25)]))
    old, S.BLOCK = S.BLOCK, 64
    try:
        tree = S.build_tree(points[::3], 3)
        leaves = S.route(points, tree, within)
        assert len(leaves) > 2
        met = set()
        for _, own in leaves:
            a, b = S.shard_links(points[own].view(np.int64), within)
            met |= set(zip(a.view(np.uint64).tolist(), b.view(np.uint64).tolist(), strict=True))
    finally:
        S.BLOCK = old
    values = points.tolist()
    want = slow_components(len(values), lambda a, b: (values[a] ^ values[b]).bit_count() <= within)
    at = {v: k for k, v in enumerate(values)}
    links = {tuple(sorted((at[a], at[b]))) for a, b in met}
    assert slow_components(len(values), lambda a, b: (b, a) in links) == want
    homes = np.concatenate([own for _, own in leaves])
    assert set(homes.tolist()) == set(range(len(points)))


def test_flood_equals_blocks():
    rng = np.random.default_rng(2)
    dense = np.unique(np.uint64(12345) ^ np.bitwise_or.reduce([np.uint64(1) << rng.integers(0, 9, 900, np.uint64) for _ in range(3)]))
    a, b = S._Union(len(dense)), S._Union(len(dense))
    S._flood(dense, np.arange(len(dense)), a, 2)
    S._blocks(dense, np.arange(len(dense)), b, 2)
    assert [a.find(k) for k in range(len(dense))] == [b.find(k) for k in range(len(dense))]


@pytest.mark.parametrize("small", [0, 1000])
@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed, small):
    rng = random.Random(seed)
    links = [(rng.randrange(40), rng.randrange(40)) for _ in range(25)] + [(k, k + 1) for k in range(100, 140)]
    got = {r.a: r.root for r in components(spark.createDataFrame(links, "a long, b long"), small).collect()}
    ends = sorted({x for l in links if l[0] != l[1] for x in l})
    pairs = {tuple(sorted(l)) for l in links}
    want = slow_components(len(ends), lambda a, b: (ends[b], ends[a]) in pairs)
    assert got == {e: ends[w] for e, w in zip(ends, want, strict=True)}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_near_duplicates_query(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for k in range(40):
        own = rng.choices(words, k=rng.choice([0, 1, 2, 3, 60, 500]))
        texts.append(" ".join(own))
        for _ in range(rng.randint(0, 4)):
            if own:
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append("  ".join(own))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    fps = [slow_fingerprint(t) for t in texts]
    want = slow_components(len(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert got == {k: (f"{fps[k]:016x}", want[k]) for k in range(len(texts))}


@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12))
@settings(max_examples=200, deadline=None)
def test_edit_distance(a, b):
    def table(free):
        row = [0 if free else k for k in range(len(b) + 1)]
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return min(row) if free else row[-1]

    assert D.edit_distance(a, b) == table(False)
    assert D.edit_distance(a, b, inside=True) == table(True)


def leaky(seed, share):
    rng = random.Random(seed)
    syllables = "ka to mi re lo sa vi nu pe do".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    items = [(k, " ".join(word() for _ in range(rng.randint(8, 50)))) for k in range(40)]
    docs, truth = [], set()
    for k in range(300):
        item, text = rng.choice(items)
        words = text.split()
        edits = int(share * len(words))
        for _ in range(edits):
            at, kind = rng.randrange(len(words)), rng.random()
            if kind < 0.6:
                words[at] = word() + "x"
            elif kind < 0.8:
                del words[at]
            else:
                words.insert(at, word() + "x")
        around = [word() for _ in range(rng.randint(0, 80))]
        at = rng.randint(0, len(around))
        if k % 3:
            docs.append((k, " ".join(around[:at] + words + around[at:]).upper().replace(" ", ",\n", 2)))
            truth.add((k, item))
        else:
            docs.append((k, " ".join(around)))
    return items, docs, truth


@pytest.mark.parametrize("share", [0.0, 0.1, 0.2])
def test_leaks_are_found_and_others_left(spark, share):
    items, docs, truth = leaky(5, share)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(table, bench, block=25).collect()}
    assert len(truth & got) >= 0.97 * len(truth)
    # whatever else is found is within reach by brute force
    for doc, item in got - truth:
        a, b = items[item][1].split(), dict(docs)[doc].lower().replace(",", " ").split()
        code = {w: n for n, w in enumerate({*a, *b})}
        assert D.edit_distance([code[x] for x in a], [code[x] for x in b], inside=True) <= 0.2 * len(a)
    kept = {r.doc_id for r in D.decontaminated(table, bench, block=25).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}


def test_walks_agree_as_assumed():
    rng = np.random.default_rng(1)
    walk = D.Embedding(40, 50)
    share = []
    for _ in range(60):
        a = rng.integers(0, 3000, 40).astype(np.int32)
        b = a.copy()
        b[rng.choice(40, 8, replace=False)] = rng.integers(3000, 6000, 8)
        x = walk.walk(np.stack([a, b]))
        share.append((x[walk.sampled, 0, np.arange(50)] == x[walk.sampled, 1, np.arange(50)]).mean())
    assert np.mean(share) >= D.AGREEMENT
    assert D.repetitions(0.98, 0.3, 2) == 42


def test_words():
    words, sizes = D.split_words(pa.array(["A b,C", None, "", "...", "x"]))
    assert words.to_pylist() == ["a", "b", "c", "x"] and sizes.tolist() == [3, 0, 0, 0, 1]


def test_short_and_unspaced_items_are_found(spark):
    items = [(1, "\u3053\u306e\u554f\u984c\u306e\u7b54\u3048\u306f\u4f55\u3067\u3059\u304b"), (2, "only four words here"), (3, "two words"), (4, "..."), (5, None), (6, "Two, WORDS")]
    docs = [(1, "x \u3053\u306e\u554f\u984c\u306e\u7b54\u3048\u306f\u8ab0\u3067\u3059\u304b y"), (2, "and only FOUR, words here too"), (3, "two other words"), (4, "one two words"), (5, "only four words"), (6, None)]
    got = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.distance) for r in got.collect()) == [(1, 1, 1), (2, 2, 0), (4, 3, 0), (4, 6, 0)]


@pytest.mark.parametrize("seed", range(6))
def test_of_equal_windows_the_first_counts(seed):
    rng = random.Random(seed)
    item = [f"w{k}" for k in range(20)]
    twice = []
    for _ in range(2):
        own = list(item)
        for at in rng.sample(range(20), 2):
            own[at] = f"x{rng.randrange(99)}"
        twice.append(own)
    text = [f"a{k}" for k in range(7)] + twice[0] + [f"b{k}" for k in range(30)] + twice[1]
    (hit,) = D.LeakIndex([(1, " ".join(item))]).search(*D.split_words(pa.array([" ".join(text)])))
    assert hit[2] == 7 and hit[4] == 2


def edited_words(rng, words, share):
    words = list(words)
    for _ in range(int(share * len(words))):
        at, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.5:
            words[at] = f"e{rng.randrange(9999)}"
        elif kind < 0.75:
            del words[at]
        else:
            words.insert(at, f"e{rng.randrange(9999)}")
    return words


@pytest.mark.parametrize("share", [0.0, 0.1, 0.19])
def test_long_items_are_found_by_their_pieces(share):
    """Items of one to eighty pieces, whole and edited, beside texts that hold only a part of one; against brute force."""
    rng = random.Random(int(share * 100))
    items = [(k, " ".join(f"w{rng.randrange(3000)}" for _ in range(n))) for k, n in enumerate([5, 63, 64, 65, 66, 100, 128, 129, 190, 250, 400, 777, 1500, 5000] * 2)]
    index = D.LeakIndex(items)
    assert max(index.by_length) <= D.PIECE
    docs = []
    for k, text in items:
        pad = lambda: [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60))]
        docs.append((pad() + edited_words(rng, text.split(), share) + pad(), k))
        docs.append((pad() + text.split()[: len(text.split()) // 2] + pad(), None))
    hits = {(row, k): (at, d) for row, k, at, _, d in index.search(*D.split_words(pa.array([" ".join(w) for w, _ in docs])))}
    planted = {(row, k) for row, (_, k) in enumerate(docs) if k is not None}
    code = {}
    near = lambda k, row: D.edit_distance([code.setdefault(x, len(code)) for x in items[k][1].split()], [code.setdefault(x, len(code)) for x in docs[row][0]], inside=True)
    assert len(planted & hits.keys()) >= 0.95 * len(planted)
    for (row, k), (at, d) in hits.items():
        n = len(items[k][1].split())
        assert near(k, row) <= n // 5 and d <= n // 5 and 0 <= at < len(docs[row][0])
        if n > D.PIECE:
            assert d == near(k, row)


def test_memory_does_not_grow_with_an_items_length():
    """One very long item beside many short texts, and many items of all lengths."""
    import tracemalloc

    rng = random.Random(8)
    items = [(0, " ".join(f"w{rng.randrange(20_000)}" for _ in range(50_000)))] + [(k, " ".join(f"w{rng.randrange(20_000)}" for _ in range(rng.randrange(5, 200)))) for k in range(1, 400)]
    tracemalloc.start()
    index = D.LeakIndex(items)
    built = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    texts = ["a few words"] * 4096 + [items[0][1], items[5][1]]
    hits = index.search(*D.split_words(pa.array(texts)))
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert {(4096, 0), (4097, 5)} <= {(row, k) for row, k, *_ in hits}
    assert built < 400e6 and peak < 400e6 and index.nbytes < 40e6


def test_blocks_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(D, "TRAVEL_BYTES", 1 << 20)
    rows = [(k, " ".join(f"w{k * j % 997}" for j in range(5, 5 + 20 * (k % 7)))) for k in range(80)] + [(99, "long " * 5000)]
    found = list(D.indexes(spark.createDataFrame(rows, "item_id long, text string")))
    blocks = [x for some in found for x in some]
    assert sum(len(x.items) for x in blocks) == len({t for _, t in rows if t})
    assert all(len(x.items) == 1 or sum(len(w) for w in x.items) * 5 < 3 * 4000 for x in blocks)
    assert all(len(some) == 1 or sum(x.nbytes for x in some) <= 1 << 20 for some in found)


@pytest.mark.parametrize(("shard", "most"), [(16, 40), (8, 12)])
def test_full_and_dense_shards_lose_no_pair(spark, shard, most):
    rng = np.random.default_rng(shard)
    flips = lambda n, bits, of: np.bitwise_or.reduce([np.uint64(1) << rng.integers(0, of, n, np.uint64) for _ in range(bits)])
    points = np.unique(np.concatenate([rng.integers(0, 2**63, 200, np.uint64), np.uint64(77) ^ flips(150, 3, 40), rng.integers(0, 2**63, 1, np.uint64) ^ flips(80, 5, 64)]))
    df = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
    old, S.LEVELS = S.LEVELS, 2
    try:
        got = {r.a: r.root for r in components(S.fingerprint_links(df, 2, shard, most)).collect()}
    finally:
        S.LEVELS = old
    values = points.tolist()
    want = slow_components(len(values), lambda a, b: (values[a] ^ values[b]).bit_count() <= 2)
    root = {int(np.uint64(v).astype(np.int64)): int(np.uint64(values[w]).astype(np.int64)) for v, w in zip(values, want, strict=True)}
    mine = {v: got.get(v, v) for v in root}
    groups = lambda m: sorted(sorted(k for k in m if m[k] == r) for r in set(m.values()))
    assert groups(mine) == groups(root)


def test_both_ways_to_join_positions_agree(spark, monkeypatch):
    from playlog.llm import packing
    from playlog.llm.queries import tokenizer_path

    docs = spark.createDataFrame([(k, f"text number {k % 7} " * (k % 50)) for k in range(120)], "doc_id long, text string")
    hashed = sorted(map(tuple, packing.pack(docs, tokenizer_path(), with_ids=False).collect()))
    monkeypatch.setattr(packing, "HASHED_ROWS", 0)
    assert hashed == sorted(map(tuple, packing.pack(docs, tokenizer_path(), with_ids=False).collect()))
