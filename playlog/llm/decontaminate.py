"""Benchmark decontamination: edit distance through CGK embeddings and bit-sampling LSH.

Texts and items are sequences of lower-cased words. A document is cut into windows of an item's length at every
word. The CGK random walk reads a sequence, and at each step writes its current word and moves on or stays, by a
random bit of the step and the word; sequences at a small edit distance so become sequences at a small Hamming
distance. Each repetition has its own walk and samples a few coordinates of it as an LSH key; a window whose key
equals an item's in any repetition, with the words around it, is held against it by exact edit distance, the
item's to the nearest stretch. The number of repetitions follows
from the target recall.

Before the walk, two bounds leave out windows: within ``1 - SIMILARITY`` of an item's length n in edits, all but
the edits (and half as many more, for words that insertions push out of the window) are words of the items of that
length, and one of any edits + 1 words of the item is there, of which the rarest are taken. After it, a pair goes on
only if all but the edits of the item's words are there at all.

Items of more than ``PIECE`` words are searched for by pieces of about that length: where the whole is within reach,
one piece at least is within its own share of the edits. A piece that is found says where the whole may stand, and the
whole is then held against the words there. So windows, walks and tables are bounded whatever the items' lengths.

Words are lower-cased runs of letters, digits and marks; in scripts that are written without spaces, every character
is a word. Items of fewer than five words allow no edit, so they are found where their words stand in a row.

Equal items are searched for once. Items are read in blocks of about ``BLOCK`` texts and ``BLOCK_BYTES`` bytes, counted
before they are read; a block of more than twice that is a single item. Up to ``BLOCKS`` blocks, and no more than
``TRAVEL_BYTES`` of their tables, travel to the tasks for one scan of the documents, which cross no shuffle. Defined results: null or empty items, or
ones without a word, are near nothing; an item without an id is reported as -1; a null text has no words; equal items
each count; repeated rows each get their hits; of a text's windows, the one counts around which an item lies at the
smallest distance, of those the one that is nearest itself, and of those the first; of an item in pieces, the place that
its first piece found says; a very long text is cut into windows whole, some thousands at a time; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids as with_ids, keep_rows, map_arrow

SIMILARITY, RECALL, BLOCK, BLOCKS = 0.8, 0.98, 20_000, 5
BLOCK_BYTES, TRAVEL_BYTES = 4 << 20, 192 << 20
#: Words of a piece, at most; a length is a bit of a number.
PIECE = 64
#: Scripts without spaces between words.
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])"
#: Windows that are held at once.
WINDOWS = 1 << 15
#: Coordinates of a key, and the share of coordinates on which walks of sequences at the largest distance agree, as measured in the tests.
COORDINATES, AGREEMENT = 2, 0.3
_OTHER, _PAD = -1, -2


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words, words of each text): lower-cased runs of letters, digits and marks, and single characters of scripts without spaces."""
    low = pc.utf8_lower(pc.fill_null(column, ""))
    unspaced = pc.match_substring_regex(low, _UNSPACED)
    if pc.any(unspaced).as_py():
        low = pc.if_else(unspaced, pc.replace_substring_regex(low, _UNSPACED, r" \1 "), low)
    parts = pc.ascii_split_whitespace(pc.utf8_trim_whitespace(pc.replace_substring_regex(low, r"[^\pL\pN\pM]+", " ")))
    words = pc.list_flatten(parts)
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    blank = pc.equal(words, "")
    if pc.any(blank).as_py():  # a text without words yields one empty word
        owner = np.repeat(np.arange(len(sizes)), sizes)[~blank.to_numpy(zero_copy_only=False)]
        words, sizes = words.filter(pc.invert(blank)), np.bincount(owner, minlength=len(sizes))
    return words, sizes


def edit_distance(a: list[int], b: list[int], inside: bool = False) -> int:
    """Levenshtein distance by bit-parallel columns; ``inside``: of ``a`` to the nearest stretch of ``b``."""
    if not a or not b:
        return len(a) if inside else len(a) + len(b)
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full, top, score = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    up, down, least, edge = full, 0, len(a), 0 if inside else 1
    for x in b:
        eq = where.get(x, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        rise, fall = down | (full & ~(xh | up)), up & xh
        score += bool(rise & top) - bool(fall & top)
        if score < least:
            least = score
        rise, fall = (rise << 1 | edge) & full, (fall << 1) & full
        up, down = fall | (full & ~(xv | rise)), rise & xv
    return least if inside else score


def repetitions(recall: float = RECALL, agreement: float = AGREEMENT, coordinates: int = COORDINATES) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - agreement**coordinates))


class Embedding:
    """CGK walks of windows of one length, and the LSH keys of their sampled coordinates."""

    def __init__(self, length: int, reps: int, coordinates: int = COORDINATES, seed: int = 3):
        rng = np.random.default_rng([seed, length])
        self.length, self.reps = length, reps
        self.factor = rng.integers(1, 2**63, reps, np.uint64) | np.uint64(1)
        self.steps = 2 * length
        self.shift = rng.integers(0, 2**63, (self.steps, reps), np.uint64)
        self.sampled = rng.integers(0, int(1.7 * length), (coordinates, reps))

    def walk(self, windows: np.ndarray) -> np.ndarray:
        """(steps x windows x reps): the word that each step writes; past the end, padding."""
        n = len(windows)
        padded = np.concatenate([windows, np.full((n, 1), _PAD, windows.dtype)], 1).astype(np.int32)
        at, rows = np.zeros((n, self.reps), np.int64), np.arange(n)[:, None]
        out = np.empty((self.steps, n, self.reps), np.int32)
        for j in range(self.steps):
            word = padded[rows, at]
            out[j] = word
            mix = (word.astype(np.int64) + 3).astype(np.uint64) * self.factor + self.shift[j]
            mix ^= mix >> np.uint64(31)
            mix *= np.uint64(0x9E3779B97F4A7C15)
            at = np.minimum(at + (mix >> np.uint64(63)).astype(np.int64), self.length)
        return out

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """(windows x reps) keys."""
        out = np.empty((len(windows), self.reps), np.uint64)
        rep = np.arange(self.reps)
        for a in range(0, len(windows), 2048):
            steps = self.walk(windows[a : a + 2048])
            key = np.zeros(steps.shape[1:], np.uint64) + rep.astype(np.uint64)
            for row in self.sampled:
                key = (key ^ (steps[row, :, rep].T.astype(np.int64) + 3).astype(np.uint64)) * np.uint64(0xD1B54A32D192ED03)
                key ^= key >> np.uint64(29)
            out[a : a + 2048] = key
        return out


class LeakIndex:
    """The items of a block, in pieces: vocabulary, bounds, and tables of LSH keys for each length."""

    def __init__(self, items: list[tuple[int, str]], similarity: float = SIMILARITY, recall: float = RECALL):
        words, sizes = split_words(pa.array([t for _, t in items], pa.string()))
        flat = words.to_pylist()
        ends = np.cumsum(sizes)
        split = [flat[e - s : e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
        kept = [(i, w) for (i, _), w in zip(items, split, strict=True) if w]
        spread = Counter(x for _, w in kept for x in set(w))
        names = sorted(spread)
        code = {w: k for k, w in enumerate(names)}
        times = np.array([spread[w] for w in names], np.int64)
        self.item_ids = [i for i, _ in kept]
        self.items = [np.array([code[x] for x in w], np.int32) for _, w in kept]
        self.similarity = similarity
        self.pieces: list[np.ndarray] = []
        self.piece_of: list[tuple[int, int]] = []  # item, and first word in it
        for k, w in enumerate(self.items):
            cuts = [len(w) * j // -(-len(w) // PIECE) for j in range(-(-len(w) // PIECE) + 1)]
            for at, to in zip(cuts, cuts[1:], strict=False):
                self.pieces.append(w[at:to])
                self.piece_of.append((k, at))
        reps = repetitions(recall)
        # bit n - 1: the word is one of a piece of n words, or one of the rarest of such a piece
        self.members, self.anchors = np.zeros(len(names) + 2, np.uint64), np.zeros(len(names) + 2, np.uint64)
        self.by_length: dict[int, tuple] = {}
        for n in sorted({len(w) for w in self.pieces}):
            own, bit = [k for k, w in enumerate(self.pieces) if len(w) == n], np.uint64(1 << (n - 1))
            for k in own:
                piece = self.pieces[k]
                self.members[piece] |= bit
                self.anchors[piece[np.lexsort((piece, times[piece]))[: self.edits(n) + 1]]] |= bit
            walk = Embedding(n, reps)
            keys = walk.keys(np.stack([self.pieces[k] for k in own]))
            owner = np.broadcast_to(np.array(own, np.int32)[:, None], keys.shape).ravel()
            order = np.argsort(keys.ravel(), kind="stable")
            self.by_length[n] = (walk, keys.ravel()[order], owner[order])
        self.vocabulary = pa.array(names, pa.string())
        self.longest = max(self.by_length, default=0)

    @property
    def nbytes(self) -> int:
        """Bytes that travel, about."""
        tables = sum(walk.shift.nbytes + keys.nbytes + owner.nbytes for walk, keys, owner in self.by_length.values())
        return tables + self.vocabulary.nbytes + self.members.nbytes * 2 + sum(w.nbytes + 200 for w in self.items) * 2 + 200 * len(self.pieces)

    def edits(self, n: int) -> int:
        return int((1 - self.similarity) * n + 1e-9)

    def slack(self, n: int) -> int:
        """Words of a window that need not be the items': the edits, and half as many that insertions push out of it."""
        return self.edits(n) + self.edits(n) // 2

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, window starts, pieces) of windows that share a key with a piece; ``ids``: words, padded between documents."""
        inside, begun = ids >= 0, ids != _PAD
        at_all = np.flatnonzero(inside)
        member = self.members[ids[at_all]]
        for n in self.by_length:
            if len(ids) < n:
                continue
            known = np.zeros(len(ids) + 1, np.int32)
            known[at_all + 1] = (member >> np.uint64(n - 1)) & np.uint64(1)
            np.cumsum(known, out=known)
            enough = known[n:] - known[:-n] >= n - self.slack(n)
            starts = np.flatnonzero(enough & begun[: len(enough)])  # a window begins in its document
            for a in range(0, len(starts), WINDOWS):
                yield from self._paired(ids, n, starts[a : a + WINDOWS])

    def _paired(self, ids: np.ndarray, n: int, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        walk, keys, owner = self.by_length[n]
        windows = ids[starts[:, None] + np.arange(n)]
        near = ((self.anchors[windows] >> np.uint64(n - 1)) & np.uint64(1)).any(1)  # the table ends in two places without bits, for other words and padding
        starts, windows = starts[near], windows[near]
        if not len(starts):
            return
        found = walk.keys(windows).ravel()
        low, high = np.searchsorted(keys, found, "left"), np.searchsorted(keys, found, "right")
        hits = np.flatnonzero(high > low)
        reach = self.edits(n)
        while len(hits):  # so many that their pairs are about as many as windows
            some = max(1, int(np.searchsorted(np.cumsum(high[hits] - low[hits]), WINDOWS, "right")))
            hit, hits = hits[:some], hits[some:]
            times = (high - low)[hit]
            base = np.repeat(low[hit] - np.cumsum(times) + times, times) + np.arange(times.sum())
            pairs = np.unique(np.stack([np.repeat(starts[hit // walk.reps], times), owner[base]], 1), axis=0)  # in order of starts
            for a in range(0, len(pairs), 2048):
                part = pairs[a : a + 2048]
                around = ids[np.clip(part[:, :1] + np.arange(-reach, n + reach), 0, len(ids) - 1)]
                piece = np.stack([self.pieces[k] for k in part[:, 1].tolist()])
                kept = (piece[:, :, None] == around[:, None, :]).any(2).sum(1) >= n - reach  # words of the piece that are there at all
                yield n, part[kept, 0], part[kept, 1]

    def search(self, words: pa.Array, sizes: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item id, first word, words, distance): the best window for each text and item within reach; texts as ``split_words`` gives them."""
        if not self.by_length:
            return []
        ids = pc.fill_null(pc.index_in(words, self.vocabulary), _OTHER).to_numpy(zero_copy_only=False).astype(np.int32)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        flat = np.full(len(ids) + (len(sizes) + 1) * self.longest, _PAD, np.int32)
        flat[np.arange(len(ids)) + owner * self.longest] = ids
        first = np.cumsum(sizes) - sizes + np.arange(len(sizes)) * self.longest
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        wholes: dict[tuple[int, int], dict[int, int]] = {}
        for n, starts, pieces in self.candidates(flat):
            rows = np.searchsorted(first, starts, "right") - 1
            for start, row, p in zip(starts.tolist(), rows.tolist(), pieces.tolist(), strict=True):
                k, offset = self.piece_of[p]
                held, part = best.get((row, k)), len(self.items[k]) > PIECE
                if held and held[:2] == (0, 0):  # starts ascend
                    continue
                at = start - int(first[row])
                step = max(1, self.edits(len(self.items[k])))  # of an item in pieces, its reach
                if part and (at - offset) // step in wholes.get((row, k), ()):  # the whole will be looked for there in any case
                    continue
                reach, piece = self.edits(n), self.pieces[p].tolist()
                window = flat[max(start - reach, int(first[row])) : start + n + reach]
                d = edit_distance(piece, window[window != _PAD].tolist(), inside=True)
                if d > reach or (held and d > held[0]):
                    continue
                if part:
                    wholes.setdefault((row, k), {})[(at - offset) // step] = at - offset
                    continue
                own = flat[start : start + n]
                found = (d, edit_distance(piece, own[own != _PAD].tolist()), at, n)
                if held is None or found < held:
                    best[row, k] = found
        for (row, k), places in wholes.items():
            item, n, reach = self.items[k].tolist(), len(self.items[k]), self.edits(len(self.items[k]))
            begin, size = int(first[row]), int(sizes[row])
            around = reach + self.edits(PIECE)  # edits before the piece, and those by which its window is off
            for place, at in sorted(places.items()):
                window = flat[begin + max(0, place * reach - around) : begin + min(size, (place + 1) * reach + n + around)]
                d = edit_distance(item, window.tolist(), inside=True)
                found = (d, d, min(max(at, 0), size - 1), n)
                if d <= reach and ((row, k) not in best or found < best[row, k]):
                    best[row, k] = found
        return [(row, self.item_ids[k], at, n, d) for (row, k), (d, _, at, n) in sorted(best.items())]


def indexes(benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, block: int = BLOCK, blocks: int = BLOCKS) -> Iterator[list[LeakIndex]]:
    """The distinct texts of the items, some blocks at a time; an index names a text by its hash."""
    texts = benchmark.select("text").filter("text is not null").distinct().withColumn("id", F.xxhash64("text"))
    rows, size = texts.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    parts = max(1, -(-rows * 5 // (4 * block)), -(-(size or 0) * 5 // (4 * BLOCK_BYTES)))
    while parts > 1:  # one row comes back
        own = texts.groupBy(F.pmod(F.col("id"), F.lit(parts))).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size"))
        if own.filter(f"n > 1 AND (size > {2 * BLOCK_BYTES} OR n > {2 * block})").limit(1).count() == 0:
            break
        parts = parts * 3 // 2 + 1
    held: list[LeakIndex] = []
    for b in range(parts):
        own = texts.filter(F.pmod(F.col("id"), F.lit(parts)) == b).collect()
        index = LeakIndex(sorted((r["id"], r["text"]) for r in own), similarity, recall)
        if held and (len(held) == blocks or sum(x.nbytes for x in held) + index.nbytes > TRAVEL_BYTES):
            yield held
            held = []
        held.append(index)
    yield held


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, first_word, words, distance): a row for each document and item that it holds a window near."""
    out = None
    for some in indexes(benchmark, similarity, recall, block):

        def run(batches: Iterator[pa.RecordBatch], some: list[LeakIndex] = some) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = split_words(batch.column("text"))
                doc = batch.column("doc_id")
                for index in some:
                    hits = index.search(*words)
                    rows, *rest = zip(*hits, strict=True) if hits else ([],) * 5
                    yield pa.RecordBatch.from_arrays([doc.take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in rest)], ["doc_id", "text_id", "first_word", "words", "distance"])

        part = map_arrow(with_ids(docs, "text"), run, "doc_id long, text_id long, first_word long, words long, distance long")
        out = part if out is None else out.unionByName(part)
    return out.join(_named(benchmark), "text_id").select("doc_id", "item_id", "first_word", "words", "distance")


def _named(benchmark: DataFrame) -> DataFrame:
    """(text_id, item_id) of the items that have a text."""
    own = benchmark.select("item_id", "text").filter("text is not null")
    return own.select(F.xxhash64("text").alias("text_id"), F.coalesce(F.col("item_id").cast("long"), F.lit(-1).cast("long")).alias("item_id"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that hold no window near an item, with their columns."""
    for some in indexes(benchmark, similarity, recall, block):

        def clean(batch: pa.RecordBatch, some: list[LeakIndex] = some) -> list[bool]:
            words = split_words(batch.column("text"))
            leaks = {h[0] for index in some for h in index.search(*words)}
            return [k not in leaks for k in range(batch.num_rows)]

        docs = keep_rows(docs, clean)
    return docs
