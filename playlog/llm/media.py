"""Media columns: interleaved document sequences.

``parse_interleaved`` turns HTML into an ordered array of items, texts and media references with their captions;
a media table holds stored forms under their digest; ``resolve`` joins references to it by digest. The store is
decoded before the join, so that descriptors rather than payloads cross it: a task decodes each digest that it
holds once, and of the descriptors of one digest one is kept. A hot digest is a hot key of the references only,
which adaptive execution can split.

The stored form here is 8-bit mono PCM in a WAVE file: one sample for each byte of payload, nothing lost.

Defined results: null HTML has no items; a reference keeps its position and caption even where its digest is not
in the store; a figure's caption belongs to its media and to those of figures within that have none, else the
``alt`` text does; a caption ends at its tag, at its figure's or where a block begins after its first words, and
one without media is text; scripts, styles, templates and titles, and media in them, are left out; repeated
references resolve alike; a null text is an empty one, whose payload is 64 zero bytes; a very long text is one row
and held once in a task at a time; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ids, map_arrow, stage

BLOCK, RATE = 64, 8000
#: Bytes of an Arrow batch: a text becomes a page, a stored form and items here.
BATCH_BYTES = 2 << 20
#: Digests that a task remembers as decoded.
SEEN = 50_000
SCHEME = "sha256:"
ITEM = "struct<position:int,kind:string,text:string,digest:string,caption:string>"
_ITEM = pa.struct([("position", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("digest", pa.string()), ("caption", pa.string())])

_BREAKS = frozenset("address article aside blockquote br dd div dl dt figure figcaption footer h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
_HIDDEN = frozenset(("script", "style", "template", "title", "noscript"))
_MEDIA = frozenset(("img", "audio", "video", "source", "embed"))


def payload_of(text: bytes, block: int = BLOCK) -> bytes:
    """The text with zero bytes up to a positive multiple of ``block``."""
    return text + bytes(-len(text) % block if text else block)


def encode_wave(payload: bytes, rate: int = RATE) -> bytes:
    """8-bit mono PCM; each byte is a sample."""
    pad = len(payload) & 1
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload) + pad, b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)) + payload + bytes(pad)


def decode_wave(data: bytes) -> bytes:
    """The samples of an 8-bit mono WAVE file, found by walking its chunks."""
    if data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, kind = 12, None
    while at + 8 <= len(data):
        name, size = struct.unpack_from("<4sI", data, at)
        if name == b"fmt ":
            kind = struct.unpack_from("<HHIIHH", data, at + 8)
        elif name == b"data":
            if kind is None or (kind[0], kind[1], kind[5]) != (1, 1, 8) or at + 8 + size > len(data):
                raise ValueError("not whole 8-bit mono PCM")
            return data[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no samples")


def wave_feature(payload: bytes) -> str:
    """A description of the samples: count, exact sum and sum of squares about the middle, crossings, peaks and energy by quarter."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    above = x >= 0
    quarters = ",".join(str(int((q * q).sum())) for q in np.array_split(x, 4))
    return f"n={len(x)};sum={x.sum()};squares={(x * x).sum()};crossings={(above[1:] != above[:-1]).sum()};low={x.min()};high={x.max()};quarters={quarters}"


class _Sequence(HTMLParser):
    """Collects items in order. ``hidden``: open tags whose content isn't shown; ``figures``: open figures, each with its media and its caption so far."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.words: list[str] = []
        self.hidden: list[str] = []
        self.figures: list[dict] = []
        self.caption: list[str] | None = None

    def _flush(self) -> None:
        text = " ".join(" ".join(self.words).split())
        self.words = []
        if text:
            self.items.append({"position": len(self.items), "kind": "text", "text": text, "digest": None, "caption": None})

    def _end_caption(self) -> None:
        text, self.caption = " ".join(" ".join(self.caption or ()).split()), None
        if text and self.figures:
            self.figures[-1]["captions"].append(text)
        elif text:  # a caption of nothing is text
            self._flush()
            self.words = [text]
            self._flush()

    def _end_figure(self) -> None:
        if self.caption is not None:
            self._end_caption()
        self._flush()
        figure = self.figures.pop()
        text = " ".join(figure["captions"])
        for k in figure["media"] if text else ():
            self.items[k]["caption"] = text
        if not text and self.figures:  # an outer caption covers the media of figures without one
            self.figures[-1]["media"] += figure["media"]
        elif text and not figure["media"]:
            self.words = [text]
            self._flush()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.hidden == ["title"] and (tag in _BREAKS or tag == "body"):  # a title that was never closed
            self.hidden = []
        if tag == "body":
            self.hidden = []
        if tag in _HIDDEN:
            self.hidden.append(tag)
        if self.hidden:
            return
        if tag in _BREAKS:
            if tag != "br" and "".join(self.caption or ()).strip():  # a caption ends where a block begins, so an unclosed one takes no more than its own line
                self._end_caption()
            self._flush()
        if tag == "figure":
            self.figures.append({"media": [], "captions": []})
        elif tag == "figcaption":
            if self.caption is not None:
                self._end_caption()
            self.caption = []
        elif tag in _MEDIA:
            own = dict(attrs)
            src = own.get("src")
            if src:
                self._flush()
                digest = src.removeprefix(SCHEME).lower() if src.startswith(SCHEME) else None
                if self.figures:
                    self.figures[-1]["media"].append(len(self.items))
                self.items.append({"position": len(self.items), "kind": "media", "text": src, "digest": digest, "caption": own.get("alt") or None})

    def handle_endtag(self, tag: str) -> None:
        if tag in ("head", "body", "html"):
            self.hidden = []
        elif tag in self.hidden:
            del self.hidden[self.hidden.index(tag) :]
        if self.hidden:
            return
        if tag == "figcaption" and self.caption is not None:
            self._end_caption()
        elif tag in _BREAKS and tag != "figure":
            self._flush()
        if tag == "figure" and self.figures:
            self._end_figure()

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            (self.words if self.caption is None else self.caption).append(data)

    def close(self) -> None:
        super().close()
        while self.figures:
            self._end_figure()
        if self.caption is not None:
            self._end_caption()
        self._flush()


def parse_html(html: str | None) -> list[dict]:
    """The ordered items of one page."""
    parser = _Sequence()
    parser.feed(html or "")
    parser.close()
    return parser.items


def parse_interleaved(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., items): each page's sequence of text and media-reference structs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [parse_html(h) for h in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(items, pa.list_(_ITEM))], [*keep, "items"])

    kinds = dict(pages.dtypes)
    return map_arrow(pages.select(*dict.fromkeys([*keep, html])), run, ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), f"items array<{ITEM}>"]), BATCH_BYTES)


def references(sequences: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """(keep..., position, digest, caption): a row for each media reference."""
    media = F.filter("items", lambda i: i["kind"] == "media")
    return sequences.select(*keep, F.explode(media).alias("item")).select(*keep, "item.position", "item.digest", "item.caption")


def described(store: DataFrame) -> DataFrame:
    """One row for each distinct digest of ``store`` (digest, media): what its stored form decodes to.

    A task decodes a digest once, as long as it is among the last ``SEEN`` that it met; the copies that other tasks
    decode go as descriptors, so that no stored form is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, None] = {}
        for batch in batches:
            rows, media = [], batch.column("media")
            for k, digest in enumerate(batch.column("digest").to_pylist()):
                if digest in seen:
                    continue
                if len(seen) >= SEEN:
                    del seen[next(iter(seen))]
                seen[digest] = None
                data = media[k].as_py()
                own = hashlib.sha256(data).hexdigest()
                if own != digest:
                    raise ValueError("a stored form differs from its digest")
                payload = decode_wave(data)
                rows.append((digest, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(data), own, wave_feature(payload)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    schema = "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return map_arrow(store.select("digest", "media"), run, schema, BATCH_BYTES).dropDuplicates(["digest"])


def resolve(refs: DataFrame, described_store: DataFrame) -> DataFrame:
    """``refs`` with what their digests resolve to; unknown or null digests resolve to nulls."""
    right = described_store.withColumnRenamed("digest", "__digest")
    return refs.join(right, refs["digest"] == right["__digest"], "left").drop("__digest")


def page_of(text: bytes, digest: str, caption: str = "document") -> str:
    """A text as a page of paragraphs and a figure that refers to the text's stored form."""
    body = escape(text.decode(), quote=False).replace("\n", "</p><p>")
    return f'<article><p>{body}</p><figure><audio src="{SCHEME}{digest}"></audio><figcaption>{caption} of {len(text)} bytes</figcaption></figure></article>'


def illustrated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, items, digest, media): each text's page as its sequence, and the stored form that the page refers to.

    One pass stores and parses a text, so no page leaves the task; a batch goes on as soon as it holds BATCH_BYTES.
    """
    names = ["doc_id", "n_bytes", "items", "digest", "media"]
    kinds = [pa.int64(), pa.int64(), pa.list_(_ITEM), pa.string(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, column, rows, held = batch.column("doc_id"), batch.column("text").cast(pa.binary()), [], 0
            for k in range(batch.num_rows):
                text = column[k].as_py() or b""
                media = encode_wave(payload_of(text))
                digest = hashlib.sha256(media).hexdigest()
                rows.append((doc[k].as_py(), len(text), parse_html(page_of(text, digest)), digest, media))
                held += len(media)
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return map_arrow(ids(docs, "text"), run, f"doc_id long, n_bytes long, items array<{ITEM}>, digest string, media binary", BATCH_BYTES)


def media_features(docs: DataFrame) -> DataFrame:
    """Store, interleave and resolve whole texts: one row for each document, with what its stored form reads back as."""
    pages = illustrated(docs)
    texts = F.size(F.filter("items", lambda i: i["kind"] == "text"))
    media = F.filter("items", lambda i: i["kind"] == "media")
    own = stage(pages.select("doc_id", "n_bytes", texts.alias("text_items"), media.alias("items"), F.col("digest").alias("stored"), "media"), "media")
    refs = references(own, ("doc_id", "n_bytes", "text_items"))
    # written, so that both sides of the join are dealt for it alone and a hot digest can be split
    return resolve(refs, stage(described(own.select(F.col("stored").alias("digest"), "media")), "media-described"))
