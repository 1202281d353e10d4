"""Media columns: interleaved sequences of text and media references, and the stored media they resolve to.

Media are stored as 8-bit grey images (binary PGM, ROW samples a row) under the SHA-256 of their samples. HTML is parsed
into an ordered array of structs: text, or a media reference with its digest and caption. Digests are joined to what is
read back from the store; a digest that very many rows share is split over LANES in store and references alike, and
payloads themselves never travel in the join. Positions and captions stay those of the parsed sequence.

Defined cases: null payloads and texts are empty; null HTML is an empty sequence; references to unknown digests keep
their place with null media; markup left open ends with the document; repeated rows resolve each; equal payloads have an
entry in a lane for each writing task, and one in described(); rows with a null id share a lane; texts of any length are stored
whole; columns of other names are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import save, slices

ROW, LANES = 64, 64
SCHEME = "media:"
SEQUENCE = "array<struct<position:int,kind:string,text:string,digest:string,caption:string>>"
_BLOCKS = {"p", "div", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "br", "nav", "footer", "header", "table", "tr", "figure", "figcaption", "blockquote", "pre"}


class _Interleaver(HTMLParser):
    """Ordered items of a document: text between media, and media with their captions."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.items: list[dict] = []
        self.text: list[str] = []
        self.hidden = 0
        self.figure: dict | None = None
        self.caption: list[str] | None = None

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text = []
        if text:
            self.items.append({"kind": "text", "text": text, "digest": None, "caption": None})

    def handle_starttag(self, tag, attrs) -> None:
        of = dict(attrs)
        if tag in ("script", "style", "template"):
            self.hidden += 1
        elif tag == "figcaption" and self.figure is not None:
            self.caption = []
        elif tag in ("img", "video", "audio", "source"):
            self.flush()
            ref = of.get("src") or ""
            self.items.append({"kind": "media", "text": None, "digest": ref.removeprefix(SCHEME) if ref.startswith(SCHEME) else ref or None, "caption": of.get("alt")})
            self.figure = self.items[-1] if self.figure is not None else None
        elif tag == "figure":
            self.flush()
            self.figure = {}
        if tag in _BLOCKS:
            self.text.append(" ")

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag) -> None:
        if tag in ("script", "style", "template"):
            self.hidden = max(0, self.hidden - 1)
        elif tag == "figcaption" and self.caption is not None:
            if self.figure:
                self.figure["caption"] = " ".join("".join(self.caption).split())
            self.caption = None
        elif tag == "figure":
            self.figure = None
        if tag in _BLOCKS:
            self.text.append(" ")

    def handle_data(self, data) -> None:
        if not self.hidden:
            (self.text if self.caption is None else self.caption).append(data)


def interleaved(html: str | None) -> list[dict]:
    parser = _Interleaver()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    return [{"position": i, **item} for i, item in enumerate(parser.items)]


def parse_sequences(df: DataFrame, html_col: str, *keep: str) -> DataFrame:
    """(*keep, sequence): the ordered items of each row's HTML."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("position", pa.int32()), *((n, pa.string()) for n in ("kind", "text", "digest", "caption"))]))
        for batch in batches:
            for part in slices(batch, len(keep), 4 << 20):
                made = pa.array([interleaved(h) for h in part.column(len(keep)).to_pylist()], kind)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], made], [*keep, "sequence"])

    rows = df.select(*keep, F.col(html_col).cast("string").alias("_html"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(keep)])
    return rows.mapInArrow(run, f"{kinds}{', ' if keep else ''}sequence {SEQUENCE}")


def padded(payload: Column) -> Column:
    """Bytes 0 appended up to a positive multiple of ROW."""
    rest = F.greatest(F.lit(ROW), F.ceil(F.octet_length(payload) / ROW) * ROW).cast("int") - F.octet_length(payload)
    return F.concat(payload, F.unhex(F.repeat(F.lit("00"), rest)))


def to_image(payload: Column) -> Column:
    """The samples as a binary PGM image, ROW a row."""
    head = F.concat(F.lit(f"P5\n{ROW} "), (F.octet_length(payload) / ROW).cast("long").cast("string"), F.lit("\n255\n"))
    return F.concat(head.cast("binary"), payload)


def from_image(stored: bytes) -> bytes:
    """The samples of a binary PGM image."""
    magic, width, height, most, *_ = stored.split(maxsplit=4)[:4] + [b""]
    at = len(magic) + len(width) + len(height) + len(most) + 4
    samples = stored[at : at + int(width) * int(height)]
    if magic != b"P5" or int(most) != 255 or len(samples) != int(width) * int(height):
        raise ValueError("not an 8-bit PGM image")
    return samples


def feature(samples: bytes) -> str:
    """Mean, deviation and entropy of the samples, and the mean change along rows."""
    x = np.frombuffer(samples, np.uint8)
    p = np.bincount(x, minlength=256) / len(x)
    p = p[p > 0]
    return f"mean={x.mean():.6f};std={x.std():.6f};entropy={-(p * np.log2(p)).sum() + 0.0:.6f};change={np.abs(np.diff(x.reshape(-1, ROW).astype(int), axis=1)).mean():.6f}"


def store(payloads: DataFrame, digest_col: str, payload_col: str, lane_col: str) -> DataFrame:
    """Write the media as images; (digest, lane, media) as read back."""
    return save(payloads.select(F.col(digest_col).alias("digest"), F.col(lane_col).alias("lane"), to_image(F.col(payload_col)).alias("media")), "media")


def described(media: DataFrame) -> DataFrame:
    """(digest, lane, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) of the stored bytes, one
    row per digest and lane."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, seen = [], set()
            for digest, lane, stored in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (digest, lane) not in seen:
                    seen.add((digest, lane))
                    x = from_image(stored)
                    rows.append((digest, lane, len(x), hashlib.sha256(x).hexdigest(), zlib.crc32(x[-ROW:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(x)))
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds], ["digest", "lane", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    rows = media.mapInArrow(run, "digest string, lane int, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
    return rows.dropDuplicates(["digest", "lane"])


def resolve(sequences: DataFrame, media: DataFrame, *keep: str) -> DataFrame:
    """(*keep, position, kind, text, caption, and the media's columns or null): one row per item of (row, lane, sequence).
    Items keep their position; media lists (digest, lane, ...)."""
    items = sequences.select(*keep, "lane", F.explode_outer("sequence").alias("_i"))
    items = items.select(*keep, "lane", "_i.*")
    return items.join(media, ["digest", "lane"], "left").drop("lane")


def document_html(digest: Column, text: Column, caption: Column) -> Column:
    """A document's page: the first line, its payload as a captioned figure, then its other lines, a paragraph each."""
    clean = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    first = F.substring_index(clean(text), "\n", 1)
    rest = F.substr(clean(text), F.length(first) + 2)
    figure = F.concat(F.lit('<figure><img src="' + escape(SCHEME)), digest, F.lit('"><figcaption>'), clean(caption), F.lit("</figcaption></figure>"))
    return F.concat(F.lit("<article><p>"), first, F.lit("</p>"), figure, F.lit("<p>"), F.replace(rest, F.lit("\n"), F.lit("</p><p>")), F.lit("</p></article>"))


def document_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, position, caption, n_texts, texts_sha256, and the columns of described()): every text stored as media and
    resolved through its page's sequence. n_texts and texts_sha256 are of the sequence's text items, joined by line feeds."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), padded(text.cast("binary")).alias("_payload"))
    lane = F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(LANES)).cast("int")
    rows = rows.select("_id", "_text", "_payload", F.sha2("_payload", 256).alias("_digest"), lane.alias("lane"))
    media = described(store(rows, "_digest", "_payload", "lane"))
    pages = rows.select("_id", F.octet_length("_text").cast("long").alias("n_bytes"), "lane", document_html(F.col("_digest"), F.col("_text"), F.lit("text as samples")).alias("_html"))
    texts = F.transform(F.filter("sequence", lambda i: i["kind"] == "text"), lambda i: i["text"])
    sequences = parse_sequences(pages, "_html", "_id", "n_bytes", "lane").select("_id", "n_bytes", "lane", F.size(texts).alias("n_texts"), F.sha2(F.array_join(texts, "\n"), 256).alias("texts_sha256"), F.filter("sequence", lambda i: i["kind"] == "media").alias("sequence"))
    found = resolve(sequences, media, "_id", "n_bytes", "n_texts", "texts_sha256")
    return found.select(F.col("_id").alias(id_col), "n_bytes", "position", "caption", "n_texts", "texts_sha256", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
