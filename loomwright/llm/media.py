"""Media columns: interleaved sequences of text and media references.

A page's HTML becomes an ordered array of structs: texts, and references to images, video, audio, frames and
embedded objects, each at its place, with its caption (figcaption, else alt, title).  A reference has the
SHA-256 digest of its absolute address, or of the bytes of its data: address; payloads (digest, payload)
are joined by digest.  Pages without references aren't shuffled.

Scripts, styles, comments and hidden templates give no text.  Pages are parsed once, whole, however long.  Null and empty pages have an empty
sequence, null addresses leave references as they are.  Repeated rows keep their own sequences.  Where several payloads tie in their digest,
the least is taken.  References without an address are left out; unresolved ones have a null payload.  Extra columns don't matter.  An empty
table gives no sequences.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import re
from html import unescape
from urllib.parse import unquote_to_bytes, urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, durable

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|$)|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<![^>]*>", re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z_:][-a-zA-Z0-9_:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_KINDS = {"img": "image", "video": "video", "audio": "audio", "source": "source", "iframe": "frame", "embed": "object", "object": "object", "picture": None}
_INLINE = frozenset("a b i em strong span u s small sub sup code mark q cite abbr font label time".split())
_STEP = pa.struct([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("url", pa.string()), ("digest", pa.string()), ("caption", pa.string())])


def _data(url: str) -> bytes:
    head, _, body = url.partition(",")
    if head.lower().endswith(";base64"):
        try:
            return base64.b64decode(unquote_to_bytes(body))
        except (binascii.Error, ValueError):
            return body.encode()
    return unquote_to_bytes(body)


def digest(url: str) -> str:
    return hashlib.sha256(_data(url) if url[:5].lower() == "data:" else url.encode()).hexdigest()


def parse(url: str | None, html: str | None) -> list[dict]:
    steps: list[dict] = []
    text: list[str] = []
    figure: list[dict] | None = None
    caption: list[str] | None = None
    within: list[str] = []

    def flush() -> None:
        words = " ".join(unescape("".join(text)).split())
        text.clear()
        if words:
            steps.append({"kind": "text", "text": words, "url": None, "digest": None, "caption": None})

    at = 0
    html = html or ""
    for m in _TOKEN.finditer(html):
        chunk = html[at : m.start()]
        (text if caption is None else caption).append(chunk)
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        close = bool(m[2])
        if tag == "figure":
            flush()
            figure = None if close else []
        elif tag == "figcaption" and figure is not None:
            if not close:
                caption = []
            elif caption is not None:
                words = " ".join(unescape("".join(caption)).split())
                caption = None
                for x in figure:
                    x["caption"] = words or x["caption"]
        elif tag in _KINDS:
            if close:
                if within and within[-1] == tag:
                    within.pop()
                continue
            attrs = {a.lower(): unescape(b or c or d) for a, b, c, d in _ATTR.findall(m[4])}
            kind = _KINDS[tag]
            if tag == "source":
                kind = {"picture": "image"}.get(within[-1] if within else "", within[-1] if within else "source")
            if tag in ("picture", "video", "audio"):
                within.append(tag)
            link = attrs.get("src") or attrs.get("data-src") or attrs.get("data") or (attrs.get("srcset") or "").split(",")[0].strip().split(" ")[0]
            if kind and link:
                flush()
                try:
                    full = link if link[:5].lower() == "data:" else urljoin(url or "", link)
                except ValueError:
                    full = link
                step = {"kind": kind, "text": None, "url": full, "digest": digest(full), "caption": attrs.get("alt") or attrs.get("title")}
                steps.append(step)
                if figure is not None:
                    figure.append(step)
        elif tag not in _INLINE:
            if caption is None:
                flush()
            else:
                caption.append(" ")
    (text if caption is None else caption).append(html[at:])
    if caption:
        text.extend(caption)  # a caption that doesn't end is text
    flush()
    for i, x in enumerate(steps):
        x["pos"] = i
    return steps


_PARSED = "struct<texts:array<string>,seq:array<struct<pos:int,kind:string,text:string,url:string,digest:string,caption:string>>>"


def _sequence(urls: pa.Array, htmls: pa.Array) -> pa.Array:
    """Texts alone of pages without references, which take a third of the room; else the steps."""
    texts, seqs = [], []
    for u, h in zip(urls.to_pylist(), htmls.to_pylist(), strict=True):
        steps = parse(u, h)
        plain = all(x["digest"] is None for x in steps)
        texts.append([x["text"] for x in steps] if plain else None)
        seqs.append(None if plain else steps)
    return pa.StructArray.from_arrays([pa.array(texts, pa.list_(pa.string())), pa.array(seqs, pa.list_(_STEP))], ["texts", "seq"])


def sequences(pages: DataFrame, payloads: DataFrame) -> DataFrame:
    """(page_id, url, sequence): sequence is array<struct<pos, kind, text, url, digest, caption, payload>>.
    ``payloads`` has digest and payload (string or binary)."""
    kind = dict(payloads.dtypes)["payload"]
    s = durable(bounded(pages).select("page_id", "url", F.arrow_udf(_sequence, _PARSED)("url", "html").alias("parsed"))).select("page_id", "url", "parsed.*")
    none = lambda name, t="string": F.lit(None).cast(t).alias(name)
    step = lambda t, i: F.struct(i.cast("int").alias("pos"), F.lit("text").alias("kind"), t.alias("text"), none("url"), none("digest"), none("caption"), none("payload", kind))
    plain = s.where("texts is not null").select("page_id", "url", F.transform("texts", step).alias("sequence"))
    rich = s.where("texts is null").withColumn("row", F.md5(F.to_json(F.struct("page_id", "url", "seq")))).drop("texts")
    refs = rich.select("row", F.explode("seq").alias("x")).where("x.digest is not null").select("row", F.col("x.digest").alias("digest")).distinct()
    found = refs.join(payloads.where("payload is not null").groupBy("digest").agg(F.min("payload").alias("payload")), "digest")
    maps = found.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("digest", "payload"))).alias("found"))
    look = lambda x: F.try_element_at(F.col("found"), F.coalesce(x["digest"], F.lit("")))
    full = lambda x: F.struct(*[x[c].alias(c) for c in ("pos", "kind", "text", "url", "digest", "caption")], look(x).alias("payload"))
    return plain.unionByName(rich.join(maps, "row", "left").select("page_id", "url", F.transform("seq", full).alias("sequence")))


def page_payloads(pages: DataFrame) -> DataFrame:
    """The pages themselves as payloads of frames and embedded objects: (digest of the address, page_id as text)."""
    return pages.where("url is not null").groupBy(F.sha2("url", 256).alias("digest")).agg(F.min(F.col("page_id").cast("string")).alias("payload"))
