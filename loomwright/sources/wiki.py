"""Wikitext and article HTML: text with link offsets, redirects, disambiguations, template, list and category links."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalise import url_decode

META = ("Benutzer:", "Benutzerin:", "Datei:", "Bild:", "Vorlage:", "Wikipedia:", "Portal:", "Hilfe:", "Modul:", "MediaWiki:", "Spezial:", "Diskussion:", "Kategorie Diskussion:", "Benutzer Diskussion:", "Vorlage Diskussion:")
CATEGORY = "Kategorie:"
_LINK = re.compile(r"\[\[([^\[\]|]+)(?:\|([^\[\]]*))?\]\]")
_KEEP = frozenset("p h1 h2 h3 h4 h5 h6".split())
_SKIP = frozenset("small table sup script style".split())


def is_meta(title: Column) -> Column:
    out = F.lit(False)
    for x in META:
        out = out | title.startswith(x)
    return out


def is_redirect(text: Column) -> Column:
    return text.rlike(r"^#?(REDIRECT|WEITERLEITUNG)")


def is_disambiguation(text: Column) -> Column:
    return F.trim(text).endswith("{{Begriffsklärung}}")


def is_category_link(alias: Column, page: Column) -> Column:
    return alias.startswith(CATEGORY) | page.startswith(CATEGORY)


def clean_redirect(text: Column) -> Column:
    """Without the redirect's keyword, hard blanks as blanks."""
    return F.trim(F.regexp_replace(F.translate(text, "\u00a0", " "), r"^#?(REDIRECT|WEITERLEITUNG)\s*:?", ""))


def braces(text: str) -> tuple[str, list[str]]:
    """The text without {...} (by depth; a backslash escapes), and what was in {{...}} at the top."""
    out, inside, depth, start, i = [], [], 0, 0, 0
    while i < len(text):
        c = text[i]
        if c == "\\" and i + 1 < len(text):
            if not depth:
                out.append(text[i : i + 2])
            i += 2
            continue
        if c == "{":
            if not depth:
                start = i
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if not depth and text[start : start + 2] == "{{":
                inside.append(text[start : i + 1])
        elif not depth:
            out.append(c)
        i += 1
    return "".join(out), inside


def links_of(wikitext: str) -> list[tuple[str, str]]:
    """(alias, page), without files."""
    return [(m[2] or m[1], m[1].strip()) for m in _LINK.finditer(wikitext) if not m[1].startswith(("Datei:", "File:", "Bild:"))]


def article(wikitext: str | None) -> dict:
    """{text, links: [(alias, page, offset)], template_links, categories, redirect, disambiguation}."""
    body, templates = braces(wikitext or "")
    text, links, categories, at, size = [], [], [], 0, 0
    for m in _LINK.finditer(body):
        before = body[at : m.start()]
        text.append(before)
        size += len(before)
        page, alias = m[1].strip(), m[2] or m[1]
        at = m.end()
        if page.startswith(("Datei:", "File:", "Bild:")):
            continue
        if page.startswith(CATEGORY):
            categories.append(page[len(CATEGORY) :])
            continue
        links.append((alias, page, size))
        text.append(alias)
        size += len(alias)
    text.append(body[at:])
    redirect = re.match(r"#?(?:REDIRECT|WEITERLEITUNG)\s*\[\[([^\]|]+)", wikitext or "")
    return {"text": "".join(text), "links": links, "template_links": [x for t in templates for x in links_of(t)], "categories": categories, "redirect": redirect[1] if redirect else None, "disambiguation": (wikitext or "").rstrip().endswith("{{Begriffsklärung}}")}


_ARTICLE = "struct<text:string,links:array<struct<alias:string,page:string,offset:int>>,template_links:array<struct<alias:string,page:string>>,categories:array<string>,redirect:string,disambiguation:boolean>"


def parse_articles(pages: DataFrame) -> DataFrame:
    """(title, text, links, template_links, categories, redirect, disambiguation) of (title, text) rows that aren't meta pages."""

    def run(col: pa.Array) -> pa.Array:
        out = []
        for x in map(article, col.to_pylist()):
            x["links"] = [{"alias": a, "page": p, "offset": o} for a, p, o in x["links"]]
            x["template_links"] = [{"alias": a, "page": p} for a, p in x["template_links"]]
            out.append(x)
        link = pa.struct([("alias", pa.string()), ("page", pa.string()), ("offset", pa.int32())])
        return pa.array(out, pa.struct([("text", pa.string()), ("links", pa.list_(link)), ("template_links", pa.list_(pa.struct(list(link)[:2]))), ("categories", pa.list_(pa.string())), ("redirect", pa.string()), ("disambiguation", pa.bool_())]))

    return pages.where(~is_meta(F.col("title"))).select("title", F.arrow_udf(run, _ARTICLE)("text").alias("a")).select("title", "a.*")


class _Body(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text, self.size, self.links, self.keep, self.skip, self.href = [], 0, [], 0, 0, None

    def handle_starttag(self, tag, attrs):
        self.keep += tag in _KEEP
        self.skip += tag in _SKIP
        if tag == "a":
            self.href = (dict(attrs).get("href") or "", self.size)

    def handle_endtag(self, tag):
        self.keep = max(0, self.keep - (tag in _KEEP))
        self.skip = max(0, self.skip - (tag in _SKIP))
        if tag == "a" and self.href:
            page, at = self.href
            alias = "".join(self.text)[at:]
            if alias and page:
                self.links.append((alias, page, at))
            self.href = None

    def handle_data(self, data):
        if self.keep and not self.skip:
            self.text.append(data)
            self.size += len(data)


def html_text(html: str | None) -> tuple[str, list[tuple[str, str, int]]]:
    """Text of paragraphs and headings, and (alias, target, offset) of its links."""
    p = _Body()
    p.feed(html or "")
    p.close()
    return "".join(p.text), p.links


def redirects(pages: DataFrame) -> DataFrame:
    """(src, dst) of redirect pages."""
    return parse_articles(pages).where("redirect is not null").select(F.col("title").alias("src"), F.col("redirect").alias("dst"))


def page_of(href: Column) -> Column:
    return url_decode(href)


def annotate(text: str, entities: list[tuple[int, str, str]]) -> str:
    """HTML with (offset, alias, page) entities as anchors; overlapping ones are left out."""
    out, at = [], 0
    for off, alias, page in sorted(entities):
        if off >= at and text[off : off + len(alias)] == alias:
            out += [text[at:off], f'<a href="{page}">{alias}</a>']
            at = off + len(alias)
    return "".join(out + [text[at:]])
