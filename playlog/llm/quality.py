"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's evidence is a linear score of its own features and those of the
lines before and after it; transition scores tie neighbouring labels. Forward-backward gives each line's
marginal probability of being good, and the length-weighted mean of the marginals, calibrated by a logistic
curve, is the document's score.

The field is fitted on a bounded, class-balanced sample of labelled documents: ``SAMPLE`` of each class and the lines of
their texts, of which every one carries its document's label. The curve is calibrated out of sample: by the
scores that fields fitted on the other half of the documents give to each half. Long documents are fitted in blocks of ``FIT_LINES`` lines, which weigh as ``WEIGHT`` blocks
at most together, so that none outweighs the others; of a document with more than ``SAMPLE_BLOCKS`` blocks so many are
drawn, evenly from its beginning to its end. 56 bytes a line come to the driver, 172 MB at the very most, and the three
fits run beside each other as tasks. Scoring reads whole texts only: no label, language, source or id.

Defined results: a null or empty text is one empty line; a document without labels is scored like any other;
documents labelled twice count with their smaller label, labelled ids of several texts with the smallest text; without
two classes to learn from, the score is the share of label 1 (0.5 without labels); repeated rows get equal scores; a
very long text is scored whole, by itself; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_of_id, keep_rows, map_arrow, text_bytes

SAMPLE, FIT_LINES, WEIGHT, FOLDS = 2000, 48, 3, 2
SAMPLE_BLOCKS = 16
THRESHOLD = 0.3
STEPS, RATE, PENALTY, REACH, RIDGE = 160, 0.08, 4e-3, 4.0, 1e-3

_MARKS, _UPPER, _DIGITS = b"#$%&*+<>=@[]^_`{|}~\\", bytes(range(65, 91)), b"0123456789"
FEATURES = 13


def line_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(lines x FEATURES, line lengths) of a UTF-8 text."""
    lines = text.split(b"\n")
    done, rows, seen = [], [], set()
    for line in lines:
        if len(rows) == 1 << 16:  # a line's numbers take a fifth of the room as an array
            done.append(np.array(rows))
            rows = []
        words = line.split()
        n, size = len(words), len(line)
        if not n:
            rows.append((0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0, 0.0))
            continue
        distinct = len(set(words))
        rows.append(
            (
                (size - len(line.translate(None, _MARKS))) / n,
                (size - len(line.translate(None, _UPPER))) / size,
                line.count(b"|") / n,
                line.count(b"!") / n,
                1 - distinct / n,
                sum(map(eq, words, words[1:])) / n,
                (size - len(line.translate(None, _DIGITS))) / size,
                log(size),
                float(line in seen),
                size / n / 10,
                0.0,
                float(n < 4),
                sum(len(w) < 4 for w in words) / n,
            )
        )
        seen.add(line)
    return np.concatenate([*done, np.array(rows)]) if done else np.array(rows), np.array([len(x) for x in lines], float)


def with_neighbours(x: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it, and whether there are such lines."""
    pad = np.zeros((1, x.shape[1]))
    first, last = np.zeros((len(x), 1)), np.zeros((len(x), 1))
    first[0], last[-1] = 1, 1
    return np.hstack([x, np.vstack([pad, x[:-1]]), np.vstack([x[1:], pad]), first, last])


@dataclass
class LineField:
    """Emission weights (label good against bad), transition scores [from][to], scaling and calibration."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(3 * FEATURES + 2))
    bias: float = 0.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(3 * FEATURES + 2))
    spread: np.ndarray = field(default_factory=lambda: np.ones(3 * FEATURES + 2))
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """Standard units, cut at REACH, so that no odd feature outweighs all others."""
        return np.clip((x - self.mean) / self.spread, -REACH, REACH)

    def marginals(self, x: np.ndarray) -> list[float]:
        """P(good) of each line: ratios of the forward and backward messages, which need no rescaling."""
        scores = np.clip(self.scaled(with_neighbours(x)) @ self.weights + self.bias, -30, 30)
        gain = np.exp(scores).tolist()
        (bb, bg), (gb, gg) = np.exp(self.moves).tolist()
        ahead, r = [gain[0]], gain[0]
        for e in gain[1:]:
            r = min(max(e * (bg + gg * r) / (bb + gb * r), 1e-30), 1e30)
            ahead.append(r)
        out, q = [0.0] * len(gain), 1.0
        for t in range(len(gain) - 1, -1, -1):
            both = ahead[t] * q
            out[t] = both / (1 + both)
            e = gain[t] * q
            q = min(max((gb + gg * e) / (bb + bg * e), 1e-30), 1e30)
        return out

    def raw(self, marginals: list[float], lengths: np.ndarray) -> float:
        """The length-weighted mean of the marginals."""
        return min(max(float(np.dot(marginals, lengths + 1) / (lengths + 1).sum()), 1e-6), 1 - 1e-6)

    def score(self, marginals: list[float], lengths: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        raw = self.raw(marginals, lengths)
        z = self.slope * log(raw / (1 - raw)) + self.shift
        return 1 / (1 + exp(-z)) if z > -700 else 0.0


def _messages(s: np.ndarray, moves: np.ndarray, mask: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Node marginals (n x T) and expected transitions (2 x 2) of padded sequences, which count with their weights."""
    n, t_max = s.shape
    a, b = np.zeros((t_max, n, 2)), np.zeros((t_max, n, 2))
    node = np.stack([np.zeros_like(s), s], -1)
    a[0] = node[:, 0]
    for t in range(1, t_max):
        step = np.logaddexp(a[t - 1][:, :1] + moves[0], a[t - 1][:, 1:] + moves[1]) + node[:, t]
        a[t] = np.where(mask[:, t, None], step, a[t - 1])
    for t in range(t_max - 2, -1, -1):
        after = node[:, t + 1] + b[t + 1]
        step = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
        b[t] = np.where(mask[:, t + 1, None], step, 0)
    total = np.logaddexp(a[-1][:, 0], a[-1][:, 1])
    good = np.exp(np.minimum(a[:, :, 1] + b[:, :, 1] - total, 0)).T
    pair = a[:-1, :, :, None] + moves + (node.transpose(1, 0, 2)[1:] + b[1:])[:, :, None, :] - total[:, None, None]
    there = mask.T[1:, :, None, None] * (1.0 if weights is None else weights[None, :, None, None])
    return good, (np.exp(np.minimum(pair, 0)) * there).sum((0, 1))


def fit(blocks: list[tuple[np.ndarray, int, float]]) -> LineField:
    """Maximum likelihood with a ridge penalty, by Adam; ``blocks``: the lines' features with neighbours, the label, and the weight."""
    field_ = LineField()
    weight = np.array([w for _, _, w in blocks])
    sizes = np.array([len(x) for x, _, _ in blocks])
    every = np.vstack([x for x, _, _ in blocks])
    heavy = np.repeat(weight, sizes)
    field_.mean = np.average(every, 0, heavy)
    field_.spread = np.sqrt(np.average((every - field_.mean) ** 2, 0, heavy)) + 1e-6
    t_max = int(sizes.max())
    x = np.zeros((len(blocks), t_max, every.shape[1]), np.float32)
    mask, y = np.zeros((len(blocks), t_max), bool), np.array([[v] for _, v, _ in blocks], float)
    for k, (own, _, _) in enumerate(blocks):
        x[k, : len(own)], mask[k, : len(own)] = field_.scaled(own), True
    flat, rows = x[mask], heavy.sum()
    del x, every
    theta = np.zeros(flat.shape[1] + 1 + 4)
    seen = np.zeros((2, 2))
    for v in (0, 1):
        seen[v, v] = ((mask[:, 1:] & (y == v)) * weight[:, None]).sum()
    m, v2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, bias, moves = theta[:-5], theta[-5], theta[-4:].reshape(2, 2)
        s = np.zeros(mask.shape)
        s[mask] = flat @ w + bias
        good, pairs = _messages(s, moves, mask, weight)
        wrong = ((np.broadcast_to(y, mask.shape) - good) * weight[:, None])[mask]
        grad = np.concatenate([wrong @ flat, [wrong.sum()], (seen - pairs).ravel()]) / rows - PENALTY * theta
        m, v2 = 0.9 * m + 0.1 * grad, 0.999 * v2 + 0.001 * grad**2
        theta += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v2 / (1 - 0.999**step)) + 1e-8)
    field_.weights, field_.bias, field_.moves = theta[:-5].copy(), float(theta[-5]), theta[-4:].reshape(2, 2).copy()
    return field_


def calibrate(field_: LineField, scored: list[tuple[float, int, float]]) -> None:
    """Slope and shift of the final curve by Newton's steps over (raw score, label, weight); both classes weigh alike."""
    raw, y, w = (np.array(c, float) for c in zip(*scored, strict=True))
    x = np.stack([np.log(raw / (1 - raw)), np.ones(len(raw))], 1)
    beta, ridge = np.array([1.0, 0.0]), np.array([RIDGE, 1e-4])  # a slope near 1 unless the labels say otherwise: separable samples would make it endless
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + w.sum() * np.diag(ridge)
        beta += np.clip(np.linalg.solve(hess, x.T @ (w * (y - p)) - w.sum() * ridge * (beta - [1.0, 0.0])), -2, 2)
    field_.slope, field_.shift = float(max(beta[0], 0.05)), float(beta[1])


def sampled(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> tuple[dict[int, int], list[tuple[int, int, np.ndarray]]]:
    """Rows of each label, and (label, fold, lines x (FEATURES + 1)) of the sample: features and length of all lines."""
    own = labels.filter(crc_of_id(F.col("doc_id"), modulus) != held).filter("quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("label"))
    own = own.persist()
    counts = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    mix = F.xxhash64("doc_id", F.lit(11)).bitwiseAND(F.lit(0xFFFFFFFF))
    picks = None
    for label, n in sorted(counts.items()):
        cut = int(min(1.0, 1.2 * SAMPLE / n) * 2**32)
        part = own.filter((F.col("label") == label) & (mix < cut)).orderBy(mix, "doc_id").limit(SAMPLE)
        picks = part if picks is None else picks.unionByName(part)
    if len(counts) < 2:
        own.unpersist()
        return counts, []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in text_bytes(batch, "text"):
                x, lengths = line_features(text)
                out.append(drawn_lines(np.hstack([x, lengths[:, None]]).astype(np.float32)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("fold"), pa.array(out, pa.binary())], ["label", "fold", "x"])

    # at most 2 * SAMPLE ids are broadcast; of an id's rows one is taken
    fold = F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(64)).cast("int").alias("fold")
    texts = docs.select("doc_id", "text").join(F.broadcast(picks), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = map_arrow(texts.select("label", fold, "text"), run, "label int, fold int, x binary").collect()
    own.unpersist()
    plain = sorted((r["label"], r["fold"], bytes(r["x"])) for r in rows)
    return counts, [(label, k, np.frombuffer(x, np.float32).reshape(-1, FEATURES + 1).astype(float)) for label, k, x in plain]


def drawn_lines(x: np.ndarray) -> np.ndarray:
    """The lines of at most ``SAMPLE_BLOCKS`` blocks, evenly spread over all of them."""
    n = -(-len(x) // FIT_LINES)
    if n <= SAMPLE_BLOCKS:
        return x
    return np.concatenate([x[k * FIT_LINES : (k + 1) * FIT_LINES] for k in (j * (n - 1) // (SAMPLE_BLOCKS - 1) for j in range(SAMPLE_BLOCKS))])


def _fitted(rows: list[tuple[int, int, np.ndarray]]) -> LineField:
    blocks = []
    for label, _, x in rows:
        wide, n = with_neighbours(x[:, :-1]), -(-len(x) // FIT_LINES)
        blocks += [(wide[a : a + FIT_LINES], label, min(1.0, WEIGHT / n)) for a in range(0, len(x), FIT_LINES)]
    return fit(blocks)


def _without(sample: list[tuple[int, int, np.ndarray]], fold: int, folds: int) -> tuple[LineField | None, list[tuple[float, int]]]:
    """The field without a fold, and what it gives that fold's documents; the field of all documents for a fold that isn't there."""
    rest, own = [r for r in sample if r[1] % folds != fold], [r for r in sample if r[1] % folds == fold]
    if len({label for label, _, _ in rest}) < 2:
        return None, []
    part = _fitted(rest)
    return part, [(part.raw(part.marginals(x[:, :-1]), x[:, -1]), label) for label, _, x in own]


def trained(spark: SparkSession, sample: list[tuple[int, int, np.ndarray]], folds: int = FOLDS) -> LineField:
    """The field of all documents, calibrated by scores that fields without a document's fold give it; each is fitted by a task of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fold in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_pydict({"fold": [fold], "found": [pickle.dumps(_without(sample, fold, folds))]})

    parts = {r["fold"]: pickle.loads(bytes(r["found"])) for r in spark.range(folds + 1, numPartitions=folds + 1).mapInArrow(run, "fold long, found binary").collect()}
    scored = [pair for fold in range(folds) for pair in parts[fold][1]]
    field_ = parts[folds][0]
    drawn = {v: sum(label == v for _, label in scored) for v in (0, 1)}
    if all(drawn.values()):
        calibrate(field_, [(raw, label, len(scored) / drawn[label]) for raw, label in scored])
    return field_


def learned(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> LineField:
    """The field fitted on a bounded sample of labelled rows whose id's crc32 modulo ``modulus`` is not ``held``."""
    counts, sample = sampled(docs, labels, modulus, held)
    if len({label for label, _, _ in sample}) < 2:
        return LineField(constant=counts.get(1, 0) / sum(counts.values()) if counts else 0.5)
    return trained(docs.sparkSession, sample)


def score_lines(docs: DataFrame, field_: LineField, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD, with_lines: bool = True) -> DataFrame:
    """(keep..., score, predicted, lines, bad_lines) and, with ``with_lines``, each line's probability of being good."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, lines, bad, marks = [], [], [], []
            for text in text_bytes(batch, "text"):
                x, lengths = line_features(text)
                good = field_.marginals(x)
                scores.append(field_.score(good, lengths))
                lines.append(len(good))
                bad.append(sum(p < 0.5 for p in good))
                marks.append(good)
            cols = [pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(lines, pa.int64()), pa.array(bad, pa.int64())]
            names = [*keep, "score", "predicted", "lines", "bad_lines"]
            if with_lines:
                cols.append(pa.array(marks, pa.list_(pa.float64())))
                names.append("line_good")
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *cols], names)

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "score double, predicted int, lines long, bad_lines long", *(["line_good array<double>"] * with_lines)])
    return map_arrow(docs.select(*dict.fromkeys([*keep, "text"])), run, schema)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose predicted label is 1, with their columns."""
    field_ = learned(docs, labels)

    def wanted(batch: pa.RecordBatch) -> list[bool]:
        out = []
        for text in text_bytes(batch, "text"):
            x, lengths = line_features(text)
            out.append(field_.score(field_.marginals(x), lengths) >= threshold)
        return out

    return keep_rows(docs, wanted)
