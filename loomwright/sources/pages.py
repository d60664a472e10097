"""Pages of directories and newspapers, lists of files, text sinks."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ranges import ranked

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Node:
    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None):
        self.tag, self.attrs, self.parent, self.inside = tag, attrs, parent, []

    def text(self) -> str:
        return " ".join("".join(self._texts()).split())

    def _texts(self):
        todo = [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                yield x
            elif x.tag not in ("script", "style"):
                todo += reversed(x.inside)
                if x.tag in ("p", "div", "br", "li", "td", "h1", "h2", "h3"):
                    yield " "

    def walk(self):
        todo = [self]
        while todo:
            x = todo.pop()
            yield x
            todo += [c for c in reversed(x.inside) if isinstance(c, Node)]

    def find(self, tag: str | None = None, id_: str | None = None, *classes: str) -> list[Node]:
        """Nodes below with the tag, the id and all classes."""
        return [x for x in self.walk() if x is not self and (tag is None or x.tag == tag) and (id_ is None or x.attrs.get("id") == id_) and set(classes) <= set((x.attrs.get("class") or "").split())]


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag == "li" and self.at.tag == "li" or tag == "p" and self.at.tag == "p":
            self.at = self.at.parent
        node = Node(tag, dict(attrs), self.at)
        self.at.inside.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_endtag(self, tag):
        x = self.at
        while x.parent and x.tag != tag:
            x = x.parent
        if x.parent:
            self.at = x.parent

    def handle_data(self, data):
        self.at.inside.append(data)


def tree(html: str | None) -> Node:
    p = _Tree()
    p.feed((html or "").replace("&nbsp;", " "))
    p.close()
    return p.root


def _second(nodes: list[Node], tag: str) -> str | None:
    """The text of the second ``tag`` in the first of the nodes that has one."""
    for n in nodes:
        p = n.find(tag)
        if len(p) > 1:
            return p[1].text()
    return None


def directory_entry(html: str | None) -> dict[str, list[str]]:
    """What a company's page in the directory tells: address, turnover, employees, city, executives, activities, and the titled lines of its
    presentation."""
    doc, out = tree(html), {}
    items = [li for box in doc.find(None, None, "employees") for li in box.find("li")]
    single = {"address": next((n.text() for n in doc.find(None, None, "addressCoordinates")), None), "turnover": _second([li for box in doc.find(None, None, "turnover") for li in box.find("li")], "p"), "employees": _second(items[1:2], "p"), "city": next((n.text() for n in doc.find(None, "search_category_link[3]")), None)}
    out |= {k: [v] for k, v in single.items() if v is not None}
    out["executives"] = [n.text() for box in doc.find(None, "executives") for n in box.find(None, None, "name")]
    for box in doc.find(None, None, "general", "bloc"):
        for part in box.find(None, None, "presentation", "global"):
            for li in part.find("li"):
                p = li.find("p")
                if len(p) > 1 and p[1].text():
                    out[p[0].text()] = [p[1].text()]
    out["activities"] = [a.text().replace('"', "").strip() for box in doc.find(None, "secondaryActivitiesTree") for a in box.find("a")]
    return out


def directory_entities(dump: DataFrame, given: tuple[str, ...] = ("url", "sector", "specified_sector", "county", "district")) -> DataFrame:
    """(id, label, instancetype, aliases, data) of rows (name, html and the given attributes)."""

    def run(col: pa.Array) -> pa.Array:
        return pa.array([list(directory_entry(h).items()) for h in col.to_pylist()], pa.map_(pa.string(), pa.list_(pa.string())))

    parsed = F.arrow_udf(run, "map<string,array<string>>")("html")
    have = [c for c in given if c in dump.columns]
    own = F.map_filter(F.create_map(*[x for c in have for x in (F.lit(c), F.array(F.col(c)))]), lambda _, v: v[0].isNotNull()) if have else F.create_map().cast("map<string,array<string>>")
    both = F.map_concat(F.map_filter(own, lambda k, _: ~F.map_contains_key("page_", k)), F.col("page_"))
    return dump.withColumn("page_", parsed).select(F.sha2(F.concat_ws("/", "name", *have), 256).alias("id"), F.col("name").alias("label"), F.lit("business").alias("instancetype"), F.array().cast("array<string>").alias("aliases"), both.alias("data"))


ARTICLE_BOXES = ("spArticleContent", "dig-artikel", "article-section")


def news_text(html: str | None, boxes: tuple[str, ...] = ARTICLE_BOXES) -> str:
    """The head's text and the first box that occurs just once, else the body."""
    doc = tree(html)
    head = " ".join(n.text() for n in doc.find("head"))
    body = " ".join(n.text() for n in doc.find("body")) or ("" if doc.find("head") else doc.text())
    content = next((found[0].text() for b in boxes if len(found := doc.find("div", None, b)) == 1), body)
    return f"{head} {content}".strip()


def news_articles(dump: DataFrame) -> DataFrame:
    """(id, title, text) of (id, title, content)."""

    def run(col: pa.Array) -> pa.Array:
        return pa.array([None if h is None else news_text(h) for h in col.to_pylist()], pa.string())

    return dump.select("id", F.replace("title", F.lit("&nbsp;"), F.lit(" ")).alias("title"), F.arrow_udf(run, "string")("content").alias("text"))


def list_links(html: str | None) -> list[tuple[str, str]]:
    """(text, target) of the first link of each list item: what list and disambiguation pages lead to."""
    out = []
    for li in tree(html).find("li"):
        a = [x for x in li.find("a") if x.attrs.get("href")]
        if a and a[0].text():
            out.append((a[0].text(), a[0].attrs["href"]))
    return out


def linked_files(html: str | None, containing: str, without: str = "") -> list[str]:
    """Targets of the links whose text has ``containing``; those with ``without`` in them are left out."""
    return [a.attrs["href"] for a in tree(html).find("a") if a.attrs.get("href") and containing in a.text() and not (without and without in a.attrs["href"])]


def reduced(articles: DataFrame) -> DataFrame:
    """(title, text), without empty articles."""
    return articles.select("title", "text").where("text is not null and text <> ''")


def numbered_sentences(sentences: DataFrame, order: list[str]) -> DataFrame:
    """``sentences`` with ``index``, their place in the order from 0."""
    return ranked(sentences, order, "index")


def write_tokens(df: DataFrame, column: str, path: str) -> None:
    """One line for each row, its tokens between tabs."""
    df.select(F.concat_ws("\t", column).alias("value")).write.mode("overwrite").text(path)


def write_stamped(df: DataFrame, folder: str, name: str, stamp: str) -> str:
    """Lines in a folder of their own for each run, which is returned."""
    path = f"{folder}/{name}_{stamp}"
    df.write.mode("errorifexists").text(path)
    return path
