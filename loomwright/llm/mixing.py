"""Mixing sources to target weights by a low-discrepancy schedule.

Slot t has the golden-ratio point frac(t * 2654435769 / 2**32), exact in integers, which the cumulative weights
map to a source.  A source's k-th slot takes its k-th block: its documents, shuffled by a hash, cut into
blocks of ``block`` tokens (a document belongs to the block in which it begins).  The schedule ends before
the first source would run out, so that the weights hold and nothing repeats; what the other sources then have
left is not taken.  With ``whole`` it goes on: the sources with blocks left share the further slots evenly spread in
proportion to their weights, until every block has its slot.

Tokens are words between blanks, of whole texts.  Default weights are proportional to tokens ** ``alpha``.  Null sources are one
source; null and empty texts, rows without tokens and sources without a weight are never scheduled; repeated rows are scheduled as
often as they occur, with ``whole`` always.  Rows that tie in hash, doc_id and tokens follow each other in some fixed order.
Empty tables give empty results.  The sources, one row each, are summed in one task; nothing else is.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import hashing as H
from .common import bounded, content_key, durable, fresh, numbers, ranked, running, small

BLOCK, ALPHA, CELLS = 16384, 0.5, 1024
GOLDEN = 2654435769


def _count(texts: pa.Array) -> pa.Array:
    return pa.array(H.count_fields(texts))


def n_tokens(column: str) -> Column:
    return F.arrow_udf(_count, "long")(column)


def point(slot: Column) -> Column:
    """slot * GOLDEN mod 2**32, in two halves so that no product overflows."""
    high, low = F.shiftright(slot.bitwiseAND(F.lit((1 << 32) - 1)), 16), slot.bitwiseAND(F.lit(65535))
    return F.pmod((high * F.lit(GOLDEN)).bitwiseAND(F.lit(65535)) * F.lit(65536) + low * F.lit(GOLDEN), F.lit(1 << 32))


def _hash() -> Column:
    return F.md5(F.concat(F.lit("mix"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("h")


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, alpha: float = ALPHA, whole: bool = False) -> DataFrame:
    """(slot, source, block, doc_id, n_tokens, begins): the documents in the order of the schedule is the order of
    slot, begins, doc_id.  ``begins`` is the document's first token in its source's shuffled sequence."""
    d = bounded(docs).select("doc_id", "source", n_tokens("text").alias("n_tokens"), _hash())
    return _schedule(durable(d.where("n_tokens > 0")), weights, block, alpha, whole)


def _schedule(d: DataFrame, weights: dict[str, float] | None, block: int, alpha: float, whole: bool = False) -> DataFrame:
    spark = d.sparkSession
    extra = [c for c in d.columns if c == "node"]
    placed = running(d, ["source"], ["h", "doc_id", "n_tokens", *extra], F.col("n_tokens"), "begins")
    placed = placed.withColumn("block", F.floor(F.col("begins") / F.lit(block)).cast("long")).drop("h")
    total = d.groupBy("source").agg(F.sum("n_tokens").alias("n"))
    if weights is None:
        total = total.withColumn("w", F.pow("n", F.lit(alpha)))
    else:
        given = spark.createDataFrame(list(weights.items()) or [("", 0.0)], "g string, w double").where("w > 0")
        total = total.join(given, F.expr("source <=> g")).drop("g")
    everything, so_far = Window.orderBy("source"), Window.orderBy("source").rowsBetween(Window.unboundedPreceding, 0)
    share = F.sum("w").over(so_far) / F.sum("w").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    total = total.withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("long")).withColumn("hi", F.when(F.lead("w").over(everything).isNull(), F.lit(1 << 32)).otherwise(F.round(share * F.lit(2.0**32)).cast("long")))
    total = durable(total.withColumn("lo", F.coalesce(F.lag("hi").over(everything), F.lit(0))))
    slots = total.agg(F.sum("blocks").alias("n")).first()["n"] or 0  # more than can be used; cut where the first source runs out
    width = 2**32 // CELLS
    edges = total.where("hi > lo").select("source", "blocks", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))
    t = spark.range(slots).select(F.col("id").alias("slot"), point(F.col("id")).alias("u")).withColumn("cell", F.floor(F.col("u") / width))
    plan = t.join(small(edges), "cell").where("u >= lo and u < hi").select("slot", "source", "blocks", F.floor(F.col("slot") / 65536).alias("part"))
    # a slot's rank in its source, in two levels: slots come in order in parts of 65,536
    parts = plan.groupBy("source", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = durable(parts.select(F.col("source").alias("s2"), F.col("part").alias("p2"), before.alias("before")))
    rank = F.row_number().over(Window.partitionBy("source", "part").orderBy("slot")).cast("long") - 1
    plan = durable(plan.withColumn("rank", rank).join(small(parts), F.expr("source <=> s2 and part = p2")).select("slot", "source", (F.col("before") + F.col("rank")).alias("block"), "blocks"))
    end = plan.where("block >= blocks").agg(F.min("slot").alias("end")).first()["end"]
    plan = plan.where(F.lit(True) if end is None else F.col("slot") < end).select("slot", F.col("source").alias("s2"), F.col("block").alias("b2"))
    if whole:
        plan = plan.unionByName(_rest(plan, total.select("source", "blocks", "w"), slots if end is None else end))
    return placed.join(plan, F.expr("source <=> s2 and block = b2")).select("slot", "source", "block", "doc_id", "n_tokens", "begins", *extra)


def _rest(plan: DataFrame, sources: DataFrame, first: int) -> DataFrame:
    """(slot, s2, b2) of the blocks that ``plan`` leaves, from slot ``first``: a source's k-th is due at (k + 1/2) / weight."""
    used = plan.groupBy("s2").agg(F.count(F.lit(1)).alias("used"))
    left = sources.join(used, F.expr("source <=> s2"), "left").select("source", "blocks", "w", F.coalesce("used", F.lit(0)).alias("used"))
    due = numbers(left, F.col("used"), F.col("blocks"), "b2").withColumn("due", (F.col("b2") - F.col("used") + 0.5) / F.col("w"))
    return ranked(due.select("due", "source", "b2"), ["due", "source", "b2"], "slot").select((F.col("slot") + F.lit(first)).alias("slot"), F.col("source").alias("s2"), "b2")


def mix_documents(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, alpha: float = ALPHA, whole: bool = False) -> DataFrame:
    """The rows of ``docs`` that the schedule takes, in its order, all columns as they are.  Of rows that are equal in doc_id, source and text,
    but not in other columns, the schedule takes the first in the order of these columns' JSON."""
    node = fresh(docs, "node")
    d = bounded(docs).select("doc_id", "source", n_tokens("text").alias("n_tokens"), _hash(), content_key("doc_id", "source", "text").alias("node"))
    d = durable(d.where("n_tokens > 0"))
    return _in_order(docs, d, _schedule(d, weights, block, alpha, whole), node)


def _in_order(docs: DataFrame, d: DataFrame, taken: DataFrame, node: str) -> DataFrame:
    """The taken rows of ``docs`` by slot and begin, each partition a range of slots; the texts of repeated rows alone are shuffled once more, to number
    the copies."""
    spark = docs.sparkSession
    slot, begins, rank, other, part = (fresh(docs, x) for x in ("slot", "begins", "rank", "other", "part"))
    places = durable(taken.select(F.col("node").alias(node), F.col("slot").alias(slot), F.col("begins").alias(begins)))
    marked = docs.withColumn(node, content_key("doc_id", "source", "text"))
    repeated = durable(d.groupBy(F.col("node").alias(node)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(node))
    once = marked.join(small(places.join(small(repeated), node, "left_anti")), node)
    more = running(places.join(small(repeated), node, "left_semi"), [node], [slot, begins], F.lit(1), rank)
    rest = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    again = marked.join(small(repeated), node, "left_semi").withColumn(other, F.to_json(F.struct(*[F.col(f"`{c}`") for c in rest])) if rest else F.lit(""))
    again = running(durable(again), [node], [other], F.lit(1), rank).drop(other).join(more, [node, rank]).drop(rank)
    # slots are of equal tokens, so equal ranges of them need no sample
    n, last = int(spark.conf.get("spark.sql.shuffle.partitions")), places.agg(F.max(slot).alias("last")).first()["last"] or 0
    out = once.unionByName(again).withColumn(part, F.least(F.lit(n - 1), F.floor(F.col(slot) * n / (last + 1))).cast("int"))
    return out.repartitionById(n, F.col(part)).sortWithinPartitions(slot, begins, node).select(*docs.columns)
