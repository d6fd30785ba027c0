"""Secrets in texts: fixed patterns, and character Markov models that tell random strings from identifiers.

Second-order character models are trained from labelled samples, some of random strings and some of ordinary ones,
each of one kind; a run of key characters is a secret if the likeliest random model beats the likeliest ordinary one
by ``RATIO`` a character. Random samples are drawn by a seeded generator from the usual alphabets of keys. Ordinary
ones are the words of the whole corpus, shapes of names in programs, and strings that machines write without secrecy:
UUIDs, digests, versions, dates, paths, addresses and ruled lines. Only runs too short to be judged are words, so a key
in the corpus never makes itself ordinary.

The corpus is counted whole: its words enter as counts of three characters, summed up by the tasks, at most 360,000
rows however long the texts are. Spans are code points, end exclusive. Defined results: a null or empty text has no
spans; whole texts are read, a very long one by itself; repeated rows get equal spans; an empty table gives no rows,
and models without a corpus still work; further columns are not read, and redaction passes them on.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, text_bytes

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Runs that the models judge: key characters, at least RUN of them.
RUN, KEY_CHARS = 20, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"
RUNS = re.compile(r"[A-Za-z0-9+/_=.-]{20,}")
#: Words that count as ordinary: whole runs shorter than RUN, letters of one case, or with a first capital.
_WORD = re.compile(rb"(?<![A-Za-z0-9+/_=.-])(?:[A-Z]?[a-z]{1,18}|[A-Z]{2,19})[.-]?(?![A-Za-z0-9+/_=.-])")
_BREAK = re.compile(rb"[^A-Za-z0-9+/_=.-]")
#: Least log-likelihood ratio for each character: among strings that no sample holds, keys seldom fall below 2, and long compounds seldom rise above 1.
RATIO = 1.5
#: Strings that are drawn of each kind.
DRAWN = 4000

_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_HEX_MAP = bytes(49 if chr(c) in "0123456789abcdef" else 48 for c in range(256))
_KEY_MAP = bytes(49 if chr(c) in KEY_CHARS else 48 for c in range(256))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _may_hold(raw: bytes) -> tuple[bool, bool]:
    """Whether the fixed patterns, and the models' runs, can match at all: a few passes at memory speed."""
    low = raw.lower()
    base = any(w in low for w in _WORDS) or b"AKIA" in raw or b"1" * 32 in raw.translate(_HEX_MAP)
    return base, b"1" * RUN in raw.translate(_KEY_MAP)


class KeyModel:
    """Log-likelihood ratios between second-order character models over KEY_CHARS, several of either side."""

    SIZE = len(KEY_CHARS) + 1

    def __init__(self, random_counts: list[np.ndarray], ordinary_counts: list[np.ndarray]):
        self.random, self.ordinary = np.stack([self._logs(c) for c in random_counts]), np.stack([self._logs(c) for c in ordinary_counts])

    @classmethod
    def codes(cls, word: str) -> np.ndarray:
        return np.concatenate([[0, 0], _CODES[np.frombuffer(word.encode("latin-1", "replace"), np.uint8)]])

    @classmethod
    def counted(cls, words: Iterable[str]) -> np.ndarray:
        """Counts of three characters, words padded in front."""
        counts = np.zeros(cls.SIZE**3)
        for word in words:
            c = cls.codes(word)
            np.add.at(counts, (c[:-2] * cls.SIZE + c[1:-1]) * cls.SIZE + c[2:], 1)
        return counts

    @classmethod
    def _logs(cls, counts: np.ndarray) -> np.ndarray:
        counts = counts.reshape((cls.SIZE,) * 3)
        single = counts.sum((0, 1)) + 0.5  # each order backs the one above it, so that contexts not met are judged by their characters
        single /= single.sum()
        double = counts.sum(0) + 8 * single
        double /= double.sum(1, keepdims=True)
        triple = counts + 8 * double
        return np.log(triple / triple.sum(2, keepdims=True))

    def of(self, word: str) -> float:
        """Mean log-likelihood ratio of the word's characters: the likeliest random model against the likeliest ordinary one."""
        if not word:
            return 0.0
        c = self.codes(word)
        mean = lambda logs: float(logs[:, c[:-2], c[1:-1], c[2:]].mean(1).max())
        return mean(self.random) - mean(self.ordinary)


_CODES = np.zeros(256, np.int64)
_CODES[list(KEY_CHARS.encode())] = np.arange(1, len(KEY_CHARS) + 1)


_LOW, _UP, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets of keys; digits and a to f alone are those of digests too, of which the fixed patterns take the long ones.
ALPHABETS = (_LOW + _UP + _DIGITS + "+/", _LOW + _UP + _DIGITS + "-_", _LOW + _UP + _DIGITS, _LOW + _UP, _UP + _DIGITS, _LOW + _DIGITS)


def random_keys(n: int = DRAWN, seed: int = 7) -> list[list[str]]:
    """Keys of each alphabet, by a seeded generator."""
    draw = random.Random(seed)
    return [["".join(draw.choices(alphabet, k=draw.randint(20, 64))) for _ in range(n)] for alphabet in ALPHABETS]


#: Ordinary names that stand in every sample, so that a small corpus still trains a model.
COMMON = """about account action address after application array author before begin body border boolean buffer build button cache
calendar callback category channel character check child client close code collection color column command comment
company component config connection console container content context control convert country create current customer
data database date default delete description detail device dictionary directory display document domain download
element email enable encoding engine entity error event example exception export factory feature field file filter
folder format function gateway graph group handler header height history host html http https image import index info
input instance integer interface internal invalid invoice item java json keyboard label language layout length level
library license limit list listener local location login long manager mapping message method model module month name
network node notification null number object offset operation option order output package page parameter parent parser
path pattern payment person phone picture pipeline platform player point policy position previous price process product
profile project property protocol provider public query queue random range reader record region register release
remote report repository request resource response result return role route schedule schema screen script search
section select sender server service session settings shape shared source special stack start state static status
storage stream string style subject submit summary support system table target task template test text theme thread
time title total track transaction transfer type unique unknown update upload user utility validation value variable
vector vendor version video view visible wait warning website week width window word worker write year""".split()


def identifiers(words: list[str], n: int = DRAWN, seed: int = 7) -> list[str]:
    """Shapes of names in programs, made of ``words``."""
    draw = random.Random(seed)
    out = list(words)
    for k in range(n):
        some = draw.sample(words, min(len(words), draw.randint(2, 5)))
        joint = ("_", "-", ".", "/", "")[k % 5]
        named = [w.title() if not joint else w.upper() if k % 7 == 0 else w for w in some]
        out.append(joint.join(named) + ("" if k % 3 else str(draw.randint(0, 2030))))
    return out


def machine_strings(n: int = DRAWN, seed: int = 7) -> list[list[str]]:
    """Strings that machines write and that open nothing, by kind: UUIDs, digests, numbers with dates and versions, paths and addresses, ruled lines."""
    draw = random.Random(seed)
    of = lambda alphabet, k: "".join(draw.choices(alphabet, k=k))
    low, up = _DIGITS + "abcdef", _DIGITS + "ABCDEF"
    uuids = ["-".join(of(low if k % 4 else up, m) for m in (8, 4, 4, 4, 12)) for k in range(n)]
    digests = [of(low if k % 4 else up, draw.choice((20, 24, 28, 32, 40, 64))) for k in range(n)]
    word = lambda: draw.choice(COMMON)
    numbers, paths = [], []
    for k in range(n):
        day = f"{draw.randint(1970, 2040)}-{draw.randint(1, 12):02d}-{draw.randint(1, 28):02d}"
        clock = f"T{draw.randint(0, 23):02d}-{draw.randint(0, 59):02d}-{draw.randint(0, 59):02d}.{of(_DIGITS, 6)}Z"
        version = ".".join(str(draw.randint(0, 40)) for _ in range(3))
        numbers.append((of(_DIGITS, draw.randint(12, 30)), day + clock, f"{word()}-{version}-{day.replace('-', '')}", f"{version}-{word()}.{draw.randint(0, 99)}+{of(_DIGITS, 8)}", f"{of(_DIGITS, 4)}-{of(_DIGITS, 4)}-{of(_DIGITS, 4)}-{of(_DIGITS, 4)}")[k % 5])
        names = [word() + draw.choice(("", "", "s", str(draw.randint(0, 99)))) for _ in range(draw.randint(2, 6))]
        paths.append(("/" + "/".join(names), f"//{names[0]}.example.{draw.choice(('com', 'org', 'net'))}/" + "/".join(names[1:]), "/".join(names) + f".{draw.choice(('py', 'html', 'json', 'tar.gz', 'png'))}", f"/{draw.choice(('usr', 'home', 'var', 'opt'))}/lib/{names[0]}{draw.randint(2, 20)}.{draw.randint(0, 9)}/" + "-".join(names[1:]))[k % 4])
    rules = [draw.choice("-=._+/") * draw.randint(12, 80) if k % 3 else of("-=._", 2) * draw.randint(6, 30) for k in range(n)]
    return [uuids, digests, numbers, paths, rules]


def words_of(raw: bytes) -> Iterator[bytes]:
    """The text's words, line by line, in pieces of about a megabyte that end between runs of key characters."""
    at = 0
    while at < len(raw):
        end = _BREAK.search(raw, at + (1 << 20))
        end = end.end() if end else len(raw)
        yield b"\n".join(_WORD.findall(raw, at, end))
        at = end


def corpus_counts(docs: DataFrame) -> np.ndarray:
    """Counts of three characters over the words of all texts: whole runs of key characters, too short to be judged, all letters and of one case but for a first capital.

    What the models judge is never counted, so that no text vouches for its own keys, in however many copies they
    stand; and random strings of other shapes, short as they may be, don't make random ones ordinary.
    """
    size = KeyModel.SIZE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size**3, np.int64)
        for batch in batches:
            for raw in text_bytes(batch, "text"):
                for words in words_of(raw):
                    c = np.concatenate([[0, 0], _CODES[np.frombuffer(words, np.uint8)]])
                    first, second = np.where(c[1:-1] == 0, 0, c[:-2]), c[1:-1]
                    total += np.bincount(((first * size + second) * size + c[2:])[c[2:] > 0], minlength=size**3)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there])], ["gram", "n"])

    counts = np.zeros(size**3)
    for r in map_arrow(docs.select("text"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toLocalIterator():  # at most size ** 3 rows
        counts[r["gram"]] = r["n"]
    return counts


def labelled_samples() -> list[tuple[list[str], int]]:
    """(strings of one kind, 1 for random ones or 0 for ordinary ones) to train from beside the corpus."""
    return [(k, 1) for k in random_keys()] + [(w, 0) for w in [identifiers(COMMON), *machine_strings()]]


def trained(docs: DataFrame) -> KeyModel:
    """The models of the labelled samples and of the corpus's own words, which count as ordinary."""
    samples = labelled_samples()
    return KeyModel([KeyModel.counted(s) for s, y in samples if y], [corpus_counts(docs), *(KeyModel.counted(s) for s, y in samples if not y)])


def find_spans(text: str, model: KeyModel, least: float = RATIO) -> list[tuple[int, int, str]]:
    """The fixed patterns' spans, and runs that the models call random and no fixed pattern covers."""
    out = base_spans(text)
    starts, ends = [s[0] for s in out], np.maximum.accumulate([s[1] for s in out]).tolist() if out else []
    more = []
    for m in RUNS.finditer(text):
        a = m.start()
        b = a + len(m[0].rstrip(".-"))
        word = text[a:b]
        k = bisect_right(starts, a)
        if b - a >= RUN and not (k and ends[k - 1] >= b) and model.of(word) >= least:
            more.append((a, b, "markov"))
    return sorted(out + more, key=lambda s: (s[0], KINDS.index(s[2]), s[1])) if more else out


def spans_of(raw: bytes, model: KeyModel) -> list[tuple[int, int, str]]:
    """All spans of a UTF-8 text; most texts are done after a few passes over their bytes."""
    base, runs = _may_hold(raw)
    return find_spans(raw.decode(), model) if runs else base_spans(raw.decode()) if base else []


def scan(docs: DataFrame, model: KeyModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep..., spans): array of struct(kind, start, end), in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for a, b, k in spans_of(raw, model)] for raw in text_bytes(batch, "text")]
            cols = [batch.column(c) for c in keep]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([*cols, pa.array(found, kind)], [*keep, "spans"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "spans array<struct<kind:string,start:long,end:long>>"])
    return map_arrow(docs.select(*dict.fromkeys([*keep, "text"])), run, schema)


def replaced(text: str, spans: list[tuple[int, int, str]], by: str) -> str:
    out, at, end = [], 0, -1
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], by]
            at = b
        else:
            at = max(at, b)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, model: KeyModel, by: str = "<secret>") -> DataFrame:
    """``docs`` with its columns; each stretch of spans is replaced in ``text``, and ``n_chars``, where present, follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new: dict[int, str] = {}
            for k, raw in enumerate(text_bytes(batch, "text")):
                if spans := spans_of(raw, model):
                    new[k] = replaced(raw.decode(), spans, by)
            if new:
                for name, value in (("text", lambda t: t), ("n_chars", len)):
                    at = batch.schema.get_field_index(name)
                    if at >= 0:
                        old = batch.column(at)
                        col = [value(new[k]) if k in new else x for k, x in enumerate(old.to_pylist())]
                        batch = batch.set_column(at, batch.schema.field(at), pa.array(col, old.type))
            yield batch

    return map_arrow(docs, run, docs.schema)


def span_text(spans: str, kinds: tuple[str, ...]) -> F.Column:
    """kind:start:end of the given kinds, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


