"""Packing in space-filling-curve order.

A document's token ids are hashed into a signed vector, the vector is projected to a few dimensions, and the
position along a Hilbert curve through that space orders the documents. Neighbours along the curve are
concatenated and cut into sequences of a fixed length, so that similar documents share sequences and only the
last sequence of all can be short.

Defined results: a null text is an empty one; an empty document is its end token alone; a document longer
than a sequence is cut over several; equal keys are ordered by row; repeated rows are each packed; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids, map_arrow, stage, with_row_id

SEQUENCE = 4096
END_ID = 2
HASH_DIMS, CURVE_DIMS, CURVE_BITS = 1024, 4, 12
#: Words whose ids a worker keeps.
CACHE_WORDS = 700_000
#: Positions that a task may hash, 50 MB or so.
HASHED_ROWS = 500_000

#: Texts of these characters only are lowered and split at white space, which the tokenizer's own rule never crosses; all others go to the tokenizer whole.
_PLAIN = r"^[\t\n\x0b\x0c\r\x20-\x7e\x{a1}-\x{b1}\x{b4}-\x{b8}\x{ba}\x{bb}\x{bf}-\x{12f}\x{131}-\x{24f}]*$"
#: Marks side by side are one piece to that rule, so only lone ones may be set apart.
_RUNS = r"[^\s\pL\pN][^\s\pL\pN]"


class WordTokenizer:
    """Ids of whole texts by a ``tokenizers`` file, with a bounded cache of the words met so far.

    The file's rule drops white space and encodes each word by itself, so a text's ids are its words' ids in
    order. The library encodes missing words, all of a batch in one call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.letters, self.mixed = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        self.ends = np.zeros(self.size, bool)
        self.ends[[k for w, k in self.tokenizer.get_vocab().items() if w.endswith("</w>")]] = True
        self.mixed.pre_tokenizer = self.tokenizer.pre_tokenizer
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def codes(self, words: list[str]) -> list[bytes]:
        """Packed ids of distinct words, from the cache or the library."""
        out = [*map(self.young.get, words)]
        gaps = [k for k, c in enumerate(out) if c is None]
        plain: list[int] = []
        mixed: list[int] = []
        for k in gaps:
            code = self.old.get(words[k])
            if code is None:
                (plain if words[k].isalpha() else mixed).append(k)
            out[k] = code
        if plain:  # words of letters in one text; each one's last id ends a word
            ids = np.array(self.letters.encode_batch_fast([" ".join([words[k] for k in plain])], add_special_tokens=False)[0].ids, "<u2")
            cuts = np.flatnonzero(self.ends[ids]) * 2 + 2
            if len(cuts) == len(plain):
                raw, a = ids.tobytes(), 0
                for k, b in zip(plain, cuts.tolist(), strict=True):
                    out[k] = raw[a:b]
                    a = b
            else:
                mixed += plain
        for k, got in zip(mixed, self.mixed.encode_batch_fast([words[k] for k in mixed], add_special_tokens=False), strict=True):
            out[k] = array("H", got.ids).tobytes()
        if len(self.young) + len(gaps) > CACHE_WORDS // 2:  # words not met since the last change of generations go
            self.old, self.young = self.young, {}
        self.young.update((words[k], out[k]) for k in gaps)
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ends of each text) of a string column, null as empty.

        Arrow splits the texts and finds the distinct words of the batch; only those are looked up in Python.
        """
        column = pc.fill_null(column, "")
        plain = pc.and_(pc.match_substring_regex(column, _PLAIN), pc.invert(pc.match_substring(column, "<|")))
        low = pc.utf8_lower(pc.if_else(plain, column, ""))
        apart = pc.replace_substring(pc.replace_substring(low, ",", " , "), ".", " . ")
        split = pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(low, _RUNS), low, apart))
        words = pc.list_flatten(split).dictionary_encode()
        per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        names = words.dictionary.to_pylist()
        coded = self.codes(names)
        pool, sizes = np.frombuffer(b"".join(coded), "<u2"), np.fromiter(map(len, coded), np.int64, len(coded)) // 2
        starts = np.cumsum(sizes) - sizes
        at = words.indices.to_numpy(zero_copy_only=False)
        n = sizes[at] if len(at) else np.zeros(0, np.int64)
        ends = np.cumsum(n)
        ids = pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[at] - ends + n, n)] if len(at) else pool[:0]
        ends = np.append(0, ends)[np.cumsum(per_text)]
        odd = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        if len(odd):
            parts = np.split(ids, ends[:-1])
            for k in odd.tolist():
                parts[k] = np.frombuffer(self.whole(column[k].as_py()), "<u2")
            ids, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        return ids, ends


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position of each row of ``cells`` (n x d unsigned cells below 2**bits) along the Hilbert curve."""
    x = cells.astype(np.int64).T.copy()
    dims, q = len(x), 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        flip ^= np.where(x[dims - 1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> b) & 1
    return key


def curve_position(vectors: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed count vectors: damped, normed, projected, and each axis cut by the normal's tails."""
    damped = np.sign(vectors) * np.log1p(np.abs(vectors))
    norm = np.linalg.norm(damped, axis=1, keepdims=True)
    axes = damped / np.where(norm > 0, norm, 1) @ projection * np.sqrt(HASH_DIMS)
    share = 1 / (1 + np.exp(-1.702 * axes / 2))
    return hilbert_key(np.clip(share * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.int64), CURVE_BITS)


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(row, doc_id, key, tokens, ids): each document's ids as packed unsigned 16-bit numbers, and its place on the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordTokenizer(tokenizer)
        rng = np.random.default_rng(20240229)
        size = encoder.size
        slot, sign = rng.integers(0, HASH_DIMS, size), rng.choice([-1.0, 1.0], size)
        projection = (rng.standard_normal((HASH_DIMS, CURVE_DIMS)) / np.sqrt(HASH_DIMS)).astype(np.float32)
        end = np.array([end_id], "<u2").tobytes()
        for batch in batches:
            flat, ends = encoder.encode(batch.column("text"))
            vectors, coded = np.zeros((len(ends), HASH_DIMS), np.float32), []
            for k, (a, b) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
                own = flat[a:b]
                vectors[k] = np.bincount(slot[own], sign[own], HASH_DIMS)
                coded.append(own.tobytes() + end)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(curve_position(vectors, projection)), pa.array([len(x) // 2 for x in coded], pa.int64()), pa.array(coded, pa.binary())],
                ["row", "doc_id", "key", "tokens", "ids"],
            )

    return map_arrow(with_row_id(ids(docs, "text"), "row"), run, "row long, doc_id long, key long, tokens long, ids binary")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens before each row within its partition."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("tokens").to_numpy(zero_copy_only=False)
        ends = before + np.cumsum(n)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.full(len(n), part, np.int32)), pa.array(ends - n), batch.column("tokens")], ["row", "part", "before", "tokens"])
        before = int(ends[-1]) if len(n) else before


def placed(rows: DataFrame) -> DataFrame:
    """(row, position): the tokens before each row in curve order, over all rows.

    Rows are range-partitioned by (key, row), so that a hot key is split; running sums are taken within the
    partitions, and one total for each partition gives the offsets. The partitions are written once, since a
    second evaluation could draw other ranges.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select("row", "key", "tokens").repartitionByRange(parts, "key", "row").sortWithinPartitions("key", "row")
    local = stage(map_arrow(ordered, _running, "row long, part int, before long, tokens long"), "pack-order")
    totals = sorted((r["part"], r["n"]) for r in local.groupBy("part").agg(F.sum("tokens").alias("n")).collect())  # a row for each partition
    offsets, at = [], 0
    for part, n in totals:
        offsets.append((part, at))
        at += n
    starts = rows.sparkSession.createDataFrame(offsets, "part int, offset long")
    return local.join(F.broadcast(starts), "part").select("row", (F.col("before") + F.col("offset")).alias("position"))


def pack(docs: DataFrame, tokenizer: str, length: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length (the sequence's,
    a power of two where the last one is short) and, with ``with_ids``, the piece's ids as unsigned 32-bit
    little-endian bytes. The ids cross one shuffle, by row id, beside the small table of positions.
    """
    rows = stage(tokenized(docs, tokenizer, end_id), "pack-ids")
    spots = placed(rows)
    total, n = rows.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    last, short = divmod(total or 0, length)
    # positions are hashed where a partition's surely fit in a task's memory, which spares sorting the ids; beyond, both sides are sorted
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spots = spots.hint("shuffle_hash" if n <= HASHED_ROWS * parts else "merge")
    joined = rows.select("row", "doc_id", "tokens", "ids").join(spots, "row").select("doc_id", "position", "ids")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_length long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, position, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                wide = memoryview(np.frombuffer(raw, "<u2").astype("<u4").tobytes())
                n, start = len(raw) // 2, 0
                while start < n:
                    seq, offset = divmod(position + start, length)
                    size = min(length - offset, n - start)
                    own = wide[4 * start : 4 * (start + size)]
                    padded = 1 << (short - 1).bit_length() if seq == last else length
                    out.append((doc, start, size, zlib.crc32(own), n, seq, offset, min(padded, length), *([bytes(own)] * with_ids)))
                    start += size
            if out:
                kinds = [pa.int64()] * 8 + [pa.binary()] * with_ids
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names[: len(kinds)])

    return map_arrow(joined, run, schema)
