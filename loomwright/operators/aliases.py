"""Links, aliases, tries, redirects."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..ranges import BROADCAST_BYTES
from ..session import durable

ANCHOR = r'<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>'


class Trie:
    """Token trie: append, remove, contains, all matches from a position."""

    def __init__(self, words: Iterable[Iterable[str]] = ()):
        self.root: dict = {}
        for w in words:
            self.append(w)

    def append(self, tokens: Iterable[str]) -> None:
        node = self.root
        for t in tokens:
            node = node.setdefault(t, {})
        node[""] = True

    def _path(self, tokens: Iterable[str]) -> list[dict] | None:
        path = [self.root]
        for t in tokens:
            if t not in path[-1]:
                return None
            path.append(path[-1][t])
        return path

    def contains(self, tokens: Iterable[str]) -> bool:
        path = self._path(tokens)
        return bool(path and "" in path[-1])

    def has_prefix(self, tokens: Iterable[str]) -> bool:
        return self._path(tokens) is not None

    def remove(self, tokens: Iterable[str]) -> bool:
        tokens = list(tokens)
        path = self._path(tokens)
        if not path or "" not in path[-1]:
            return False
        del path[-1][""]
        for t, parent, node in zip(reversed(tokens), reversed(path[:-1]), reversed(path[1:]), strict=True):
            if not node:
                del parent[t]
        return True

    def matches(self, tokens: list[str], at: int = 0) -> list[int]:
        """Lengths of the stored words that begin at ``at``."""
        node, out = self.root, []
        for i in range(at, len(tokens)):
            node = node.get(tokens[i])
            if node is None:
                break
            if "" in node:
                out.append(i - at + 1)
        return out


def longest_matches(trie: Trie, tokens: list[str]) -> list[tuple[int, int]]:
    """(start, length): the longest match of each start, without starts that a longest match covers."""
    longest = {i: m[-1] for i in range(len(tokens)) if (m := trie.matches(tokens, i))}
    covered = {j for i, n in longest.items() for j in range(i + 1, i + n)}
    return [(i, n) for i, n in longest.items() if i not in covered]


class _Dictionary:
    """Aliases as token lists; each worker process builds their trie once."""

    def __init__(self, lists: list[list[str]]):
        self.lists, self.built = lists, None

    def __getstate__(self):
        return {"lists": self.lists, "built": None}

    def trie(self) -> Trie:
        if self.built is None:
            self.built = Trie(self.lists)
        return self.built


def search(docs: DataFrame, aliases: DataFrame, token_column: str = "tokens", everything: bool = False, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, alias, pos) of the (alias) in the token arrays: the longest from each position, without those that begin inside a longest one;
    ``everything`` keeps nested matches.  Dictionaries of at most ``limit`` bytes become a trie in each worker, larger ones are joined by
    their first two tokens and compared."""
    known = aliases.select(F.trim(F.regexp_replace("alias", r"\s+", " ")).alias("alias")).where("alias <> ''").distinct()
    size = known.agg(F.sum(F.octet_length("alias") + 64).alias("b")).first()["b"] or 0
    if size > limit:
        return _joined(docs, known, token_column, everything)
    shared = docs.sparkSession.sparkContext.broadcast(_Dictionary([r["alias"].split(" ") for r in known.collect()]))

    def run(col: pa.Array) -> pa.Array:
        trie, out = shared.value.trie(), []
        for tokens in col.to_pylist():
            tokens = tokens or []
            found = [(i, n) for i in range(len(tokens)) for n in trie.matches(tokens, i)] if everything else longest_matches(trie, tokens)
            out.append([{"pos": i, "alias": " ".join(tokens[i : i + n])} for i, n in found])
        return pa.array(out, pa.list_(pa.struct([("pos", pa.int32()), ("alias", pa.string())])))

    hits = F.arrow_udf(run, "array<struct<pos:int,alias:string>>")
    return docs.select("doc_id", F.explode(hits(token_column)).alias("m")).select("doc_id", "m.alias", "m.pos")


def _joined(docs: DataFrame, known: DataFrame, token_column: str, everything: bool) -> DataFrame:
    """The same by a join; rows of one doc_id are one document here."""
    a = known.withColumn("words", F.split("alias", " ")).withColumn("n", F.size("words"))
    a = a.withColumn("key", F.xxhash64(F.col("words")[0], F.coalesce(F.try_element_at("words", F.lit(2)), F.lit(""))))
    t = docs.select("doc_id", F.col(token_column).alias("tokens")).select("doc_id", F.posexplode("tokens").alias("pos", "word"), "tokens")
    t = t.withColumn("keys", F.array(F.xxhash64("word", F.lit("")), F.xxhash64("word", F.coalesce(F.try_element_at("tokens", F.col("pos") + 2), F.lit("")))))
    # only windows as long as the longest alias travel
    longest = known.select(F.size(F.split("alias", " ")).alias("n")).agg(F.max("n")).first()[0] or 0
    t = t.withColumn("window", F.slice("tokens", F.col("pos") + 1, F.lit(longest))).drop("tokens", "word").withColumn("key", F.explode(F.array_distinct("keys"))).drop("keys")
    hit = t.join(a, "key").where(F.slice("window", F.lit(1), F.col("n")) == F.col("words")).select("doc_id", "alias", "pos", "n")
    if everything:
        return hit.select("doc_id", "alias", "pos")
    best = hit.groupBy("doc_id", "pos").agg(F.max_by("alias", "n").alias("alias"), F.max("n").alias("n"))
    reach = F.max(F.col("pos") + F.col("n")).over(Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    return best.withColumn("reach", reach).where("reach is null or pos >= reach").select("doc_id", "alias", "pos")


def unlinked(found: DataFrame, links: DataFrame, stop: tuple[str, ...] = ()) -> DataFrame:
    """Of the longest matches (doc_id, alias, pos) those that begin where no link (doc_id, pos) does, without stop words and symbols: the mentions that are
    still to be linked."""
    left = found.join(links.select("doc_id", "pos").distinct(), ["doc_id", "pos"], "left_anti")
    left = left.where(F.col("alias").rlike(r"[\p{L}\p{N}]"))
    return left.where(~F.lower("alias").isin(*stop)) if stop else left


def anchors(pages: DataFrame) -> DataFrame:
    """(page_id, alias, page): the links of every page; empty aliases and links are dropped."""
    links = F.arrays_zip(F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(1)).alias("page"), F.regexp_extract_all("html", F.lit(ANCHOR), F.lit(2)).alias("alias"))
    return pages.select("page_id", F.explode(links).alias("l")).select("page_id", "l.alias", "l.page").where("alias <> '' and page <> '' and length(alias) <= 1000")


def link_counts(links: DataFrame, by: str, of: str) -> DataFrame:
    """(by, map<of, count>)."""
    n = links.groupBy(by, of).agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(of, "n")))).alias("counts"))


def alias_scores(links: DataFrame) -> DataFrame:
    """(alias, page, n, share): of each alias's links, the share that each page has."""
    n = links.groupBy("alias", "page").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("alias")))


def alias_occurrences(links: DataFrame, found: DataFrame) -> DataFrame:
    """(alias, links, total): found aliases that no link of the document consumes add to the total (a multiset difference)."""
    a = links.groupBy("doc_id", "alias").agg(F.count(F.lit(1)).alias("linked"))
    b = found.groupBy("doc_id", "alias").agg(F.count(F.lit(1)).alias("found"))
    both = a.join(b, ["doc_id", "alias"], "full").select("alias", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("found", F.lit(0)).alias("found"))
    return both.groupBy("alias").agg(F.sum("linked").alias("links"), F.sum(F.greatest("linked", "found")).alias("total"))


def clean_links(links: DataFrame, titles: DataFrame) -> DataFrame:
    """Links whose page exists (titles has the column page)."""
    return links.join(titles.select("page").distinct(), "page", "left_semi")


def extended_link(page: Column) -> Column:
    """Of map<page, count>: the only page, or the only one left of those with count > 1 or over a tenth of the greatest; null if several are
    left.  If none is left, the page with the greatest count, then the least name."""
    entries = F.map_entries(page)
    top = F.array_max(F.map_values(page))
    kept = F.filter(entries, lambda e: (e["value"] > 1) | (e["value"] / top > 0.1))
    first = F.array_min(F.transform(entries, lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("k"))))["k"]
    return F.when(F.size(entries) == 1, F.try_element_at(entries, F.lit(1))["key"]).when(F.size(kept) == 1, kept[0]["key"]).when(F.size(kept) == 0, first)


def resolve_redirects(edges: DataFrame) -> DataFrame:
    """(src, dst): every redirect to its end by pointer doubling; what leads into a cycle or to itself is left out.  Each source has one target, the
    least.  Rounds go on while fewer redirects than before lead to another: what then is left runs in circles."""
    e = durable(edges.where("src <> dst").groupBy("src").agg(F.min("dst").alias("dst")))
    ends = e.limit(0)
    open_, count = e, None
    while True:
        sources = e.select(F.col("src").alias("dst"))
        ends = durable(ends.unionByName(open_.join(sources, "dst", "left_anti").select("src", "dst")))
        left = durable(open_.join(sources, "dst", "left_semi").select("src", "dst"))
        n = left.count()
        if n == 0 or n == count:
            return ends
        # a target that has come to its end goes on there, another as far again
        hop = open_.select(F.col("src").alias("dst"), F.col("dst").alias("next")).unionByName(ends.join(open_, "src", "left_anti").select(F.col("src").alias("dst"), F.col("dst").alias("next")))
        open_, count = durable(left.join(hop, "dst").select("src", F.col("next").alias("dst"))), n


def drop_overlaps(candidates: DataFrame, taken: DataFrame) -> DataFrame:
    """Candidates (doc_id, lo, hi) that overlap no taken interval of their document."""
    t = taken.select(F.col("doc_id").alias("d"), F.col("lo").alias("l"), F.col("hi").alias("h"))
    return candidates.join(t, F.expr("doc_id = d and lo < h and l < hi"), "left_anti")


def subclass_paths(edges: DataFrame, root, max_rounds: int = 64) -> DataFrame:
    """(node, path): the shortest path from every class below ``root`` to it, ties by the least path; each round joins the frontier once."""
    spark = edges.sparkSession
    kind = dict(edges.dtypes)["parent"]
    # a checkpoint keeps what the optimiser has inferred of its columns, which each round would multiply
    infer, before = "spark.sql.constraintPropagation.enabled", spark.conf.get("spark.sql.constraintPropagation.enabled")
    spark.conf.set(infer, "false")
    try:
        edges = durable(edges.select("parent", "child").distinct())
        known = frontier = durable(spark.createDataFrame([(root, [root])], f"node {kind}, path array<{kind}>"))
        for _ in range(max_rounds):
            step = edges.join(frontier.select(F.col("node").alias("parent"), "path"), "parent").select(F.col("child").alias("node"), F.concat("path", F.array("child")).alias("path"))
            frontier = durable(step.groupBy("node").agg(F.min("path").alias("path")).join(known.select("node"), "node", "left_anti"))
            if frontier.isEmpty():
                return known
            known = durable(known.unionByName(frontier))
    finally:
        spark.conf.set(infer, before)
    raise RuntimeError("the class tree is deeper than max_rounds")
