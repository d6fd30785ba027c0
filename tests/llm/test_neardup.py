"""The pipeline's near-duplicates against brute force over exact shingle sets."""

import random

import pytest

from corpus_pipeline import near_dedup
from playlog.llm import neardup as N


def pieces(text):
    words = (text or "").lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def survivors(docs):
    own = {k: pieces(t) for k, t in docs}
    root = {k: k for k in own}
    for a in own:
        for b in own:
            if a < b and root[a] != root[b] and 5 * len(own[a] & own[b]) >= 4 * len(own[a] | own[b]):
                x, y = sorted((root[a], root[b]))
                root = {k: x if r == y else r for k, r in root.items()}
    return sorted(k for k in own if root[k] == k)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a b", "A  b", "a b c", "one two three four five", "one two three four six"]
    for size in (30, 100, 400, 1000):
        for _ in range(12):
            base = [f"w{rng.randrange(5000)}" for _ in range(size)]
            texts += [" ".join(edited(rng, base, e)) for e in (0, 0, size // 100, size // 50, size // 30, size // 10)]
    base = [f"w{rng.randrange(5000)}" for _ in range(60)]
    texts += [" ".join(edited(rng, base, rng.choice([0, 1, 1, 2]))) for _ in range(80)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_stage_keeps_what_brute_force_keeps(spark):
    docs = corpus(3)
    got = near_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in got.collect()) == survivors(docs)


@pytest.mark.parametrize("tile", [4, 16])
def test_large_keys_are_tiled_without_loss(spark, tile):
    docs = corpus(4)
    got = N.deduplicated(spark.createDataFrame(docs, "doc_id long, text string"), tile)
    assert sorted(r.doc_id for r in got.collect()) == survivors(docs)
