"""Components, groups and motifs over edge tables (src, dst)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable


def degrees(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(id, component): least label by alternating stars; lineage is cut every round."""
    e = durable(edges.where("src <> dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct())
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(least, "a")
        new = durable(star.select("a", F.col("m").alias("b")).union(star.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        settled = new.groupBy("a").count().where("count > 1").isEmpty() and new.join(new.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()
        e = new
        if settled:
            return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
    raise RuntimeError("components did not converge")


def component_groups(edges: DataFrame, least: int = 3) -> DataFrame:
    """(component, size, id, degree): the members of components of at least ``least``, one row each, as a component may hold most of the graph.
    Nodes without edges are in none."""
    c = durable(components(edges))
    sizes = c.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= least)
    return c.join(sizes, "component").join(degrees(edges), "id").select("component", "size", "id", "degree")


def ownership_groups(relations: DataFrame, names: tuple[str, ...], least: int = 3) -> DataFrame:
    """``component_groups`` of the edges (src, dst, relation) with one of the relations."""
    return component_groups(durable(relations.where(F.col("relation").isin(*names)).select("src", "dst").distinct()), least)


def result_graphs(groups: DataFrame, kind: str) -> DataFrame:
    """(component, type, nodes, size), members by descending degree, then id: for exports of groups that are known to be small."""
    members = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("degree")).alias("d"), "id"))), lambda x: x["id"])
    return groups.groupBy("component").agg(members.alias("nodes"), F.count(F.lit(1)).alias("size")).withColumn("type", F.lit(kind))


def chains(edges: DataFrame) -> DataFrame:
    """(a, b, c, d) of all paths of three edges; nodes may repeat."""
    e = lambda x, y: edges.select(F.col("src").alias(x), F.col("dst").alias(y))
    return e("a", "b").join(e("b", "c"), "b").join(e("c", "d"), "c").select(*"abcd")


def stars(edges: DataFrame, spokes: int = 3) -> DataFrame:
    """(hub, s1 ... sn) of all stars; spokes may repeat, all permutations are found."""
    if not 3 <= spokes <= 10:
        raise ValueError("3 to 10 spokes")
    out = edges.select(F.col("src").alias("hub"), F.col("dst").alias("s1"))
    for i in range(2, spokes + 1):
        out = out.join(edges.select(F.col("src").alias("hub"), F.col("dst").alias(f"s{i}")), "hub")
    return out
