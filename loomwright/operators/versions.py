"""Attribute histories: change detection, as-of, diff, restore, and curation commits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def history(log: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """The rows of a log at which the value changed: what a setter that appends only on change would keep."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(*order))
    return log.withColumn("before", before).where(~F.col(value).eqNullSafe(F.col("before")))


def nth_version(changes: DataFrame, key: str, order: list[str], value: str, n: int) -> DataFrame:
    """(key, value): the n-th of each key's changes, the last if there are fewer."""
    i = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return changes.withColumn("i_", i).where(F.col("i_") <= n).groupBy(key).agg(F.max_by(value, "i_").alias(value))


def as_of(log: DataFrame, key: str, order: str, value: str, when: Column) -> DataFrame:
    """(key, value): the last at or before ``when``."""
    return log.where(F.col(order) <= when).groupBy(key).agg(F.max_by(value, order).alias(value))


def version_in(versions: Column, wanted: Column) -> Column:
    """Of array<struct<version, ...>>: the wanted version, else the latest older one, else null."""
    return F.try_element_at(F.array_sort(F.filter(versions, lambda v: v["version"] <= wanted)), F.lit(-1))


def additions(old: Column, new: Column) -> Column:
    """What the new list has and the old one doesn't; repeats stay."""
    return F.filter(new, lambda x: ~F.array_contains(old, x))


def diff(old: Column, new: Column) -> Column:
    """JSON {"+": [...], "-": [...]}; null for no change."""
    plus, minus = additions(old, new), additions(new, old)
    return F.when((F.size(plus) > 0) | (F.size(minus) > 0), F.to_json(F.struct(plus.alias("+"), minus.alias("-"))))


def diff_rows(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, change, n): values that only the new rows have as +, that only the old ones have as -, with how often they do.  No list of a key's
    values is built."""
    both = old.select(key, value, F.lit(0).alias("side")).unionByName(new.select(key, value, F.lit(1).alias("side")))
    by = both.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), F.sum("side").alias("late"))
    return by.where("late = 0 or late = n").select(key, value, F.when(F.col("late") > 0, "+").otherwise("-").alias("change"), "n")


def restore(subjects: DataFrame, histories: dict[str, str], wanted: Column) -> DataFrame:
    """Every column of ``histories`` {column: history column} as of the wanted version."""
    return subjects.withColumns({c: version_in(F.col(h), wanted)["value"] for c, h in histories.items()})


def append_version(subjects: DataFrame, column: str, history_column: str, value: Column, version: Column) -> DataFrame:
    """Sets the column and appends to its history, only where the value changes."""
    changed = ~F.col(column).eqNullSafe(value)
    entry = F.struct(version.alias("version"), value.alias("value"))
    return subjects.withColumn(history_column, F.when(changed, F.concat(history_column, F.array(entry))).otherwise(F.col(history_column))).withColumn(column, value)


def merge_maps(old: Column, new: Column) -> Column:
    """New values win; empty lists are dropped."""
    return F.map_filter(F.map_zip_with(old, new, lambda _, a, b: F.coalesce(b, a)), lambda _, v: F.size(v) > 0)


def symmetric(relations: DataFrame) -> DataFrame:
    return relations.union(relations.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *relations.columns[2:])).distinct()


def apply_commit(subjects: DataFrame, commit: DataFrame) -> DataFrame:
    """``commit`` has (id, action, name, properties): created and updated ids become rows of source human with the changed
    attributes, deleted ones a row with property deleted.  Earlier rows stay."""
    done = F.create_map(F.lit("deleted"), F.array(F.lit("true")))
    rows = commit.select("id", F.lit("human").alias("datasource"), "name", F.when(F.col("action") == "delete", done).otherwise(F.coalesce("properties", F.create_map().cast("map<string,array<string>>"))).alias("properties"))
    old = subjects.where("datasource = 'human'").select("id", F.col("name").alias("old_name"), F.col("properties").alias("old_props"))
    merged = rows.join(old, "id", "left").select("id", "datasource", F.coalesce("name", "old_name").alias("name"), F.when(F.col("old_props").isNull(), F.col("properties")).otherwise(merge_maps(F.col("old_props"), F.col("properties"))).alias("properties"))
    return subjects.join(merged.select("id", "datasource"), ["id", "datasource"], "left_anti").unionByName(merged, allowMissingColumns=True)


def redirect_target(slaves: DataFrame, order: Column) -> DataFrame:
    """(master, target): the destination of the master's slave of the first source."""
    return slaves.groupBy("master").agg(F.min_by("id", F.struct(order, "id")).alias("target"))
