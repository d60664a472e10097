"""Sentences with entities, co-occurrence, training data for the relation classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable


def entity_lists(rows: DataFrame, sentence: str, entity: str) -> DataFrame:
    """(sentence, entities): the different entities of each sentence, sorted; sentences with one are dropped."""
    return rows.groupBy(sentence).agg(F.array_sort(F.collect_set(entity)).alias("entities")).where(F.size("entities") > 1)


def ordered_lists(rows: DataFrame, sentence: str, entity: str, at: str) -> DataFrame:
    """As ``entity_lists``, in the order of first occurrence, so that the same entities in another order are another list."""
    first = rows.groupBy(sentence, entity).agg(F.min(at).alias("at_"))
    lists = first.groupBy(sentence).agg(F.transform(F.array_sort(F.collect_list(F.struct("at_", entity))), lambda x: x[entity]).alias("entities"))
    return lists.where(F.size("entities") > 1)


def pair_bags(sentences: DataFrame) -> DataFrame:
    """(pair, term, n): the bags of the sentences (pair, bag as array) of each pair as one."""
    return sentences.select("pair", F.explode("bag").alias("term")).groupBy("pair", "term").agg(F.count(F.lit(1)).alias("n"))


def cooccurrences(lists: DataFrame) -> DataFrame:
    return lists.groupBy("entities").agg(F.count(F.lit(1)).alias("n"))


def pair_counts(lists: DataFrame, most: int = 1 << 21) -> DataFrame:
    """(a, b, n) for a before b in the list, counted in as many parts as keep each at about ``most`` pairs."""
    lists = durable(lists.select("entities"))
    size = F.size("entities").cast("double")
    total = lists.agg(F.sum(size * (size - 1) / 2)).first()[0] or 0
    a = lists.select("entities", F.posexplode("entities").alias("i", "a"))
    pairs = a.select("a", F.explode(F.slice("entities", F.col("i") + 2, F.size("entities"))).alias("b"))
    pairs = pairs.repartition(min(1 << 13, int(total / most) + 1), "a", "b") if total > most else pairs
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def relation_examples(sentences: DataFrame, relations: DataFrame, least: int = 2) -> DataFrame:
    """Sentences of exactly two entities, labelled 1 where the pair has a relation; rarely co-occurring pairs are dropped."""
    two = sentences.where(F.size("entities") == 2).withColumn("pair", F.array_sort("entities"))
    often = two.groupBy("pair").count().where(F.col("count") >= least).select("pair")
    known = relations.select(F.array_sort(F.array("src", "dst")).alias("pair")).distinct().withColumn("related", F.lit(1))
    return two.join(often, "pair", "left_semi").join(known, "pair", "left").withColumn("related", F.coalesce("related", F.lit(0)))


def class_weights(rows: DataFrame, label: str) -> DataFrame:
    """weight: the share of the other class."""
    share = rows.agg(F.avg(F.col(label).cast("double")).alias("share"))
    return rows.crossJoin(F.broadcast(share)).withColumn("weight", F.when(F.col(label) == 1, 1 - F.col("share")).otherwise(F.col("share"))).drop("share")
