"""Exact ranks and running sums without a task for a whole group, size-checked broadcasts, columns that cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import durable

BROADCAST_BYTES = 24 << 20
_INDEX = (1 << 33) - 1  # monotonically_increasing_id has the partition above and the row's index in these bits


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows take at most ``limit`` bytes, counted; else, or with nested columns, as it is, for a shuffled
    join."""
    fixed, text = 64, []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            text.append(f.name)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return df
        fixed += 8
    size = F.count(F.lit(1)) * F.lit(fixed)
    for name in text:
        size = size + F.coalesce(F.sum(F.octet_length(F.col(f"`{name}`"))), F.lit(0))
    return F.broadcast(df) if df.agg(size.alias("bytes")).first()["bytes"] <= limit else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def _sorted(df: DataFrame, order: list, at: str) -> DataFrame:
    """``df`` in range partitions, which split ties too, with ``at``: the partition and the index in it."""
    tie = fresh(df, "tie")
    kept = durable(df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order, tie).sortWithinPartitions(*order, tie).drop(tie))
    return kept.withColumn(at, F.monotonically_increasing_id())


def ranked(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` with ``name``: the place of the row in the order, from 0.  Rows are range-sorted and counted by partition, so no task holds more
    than its range; ties are in some fixed order."""
    at, part, before = fresh(df, "at"), fresh(df, "part"), fresh(df, "before")
    kept = _sorted(df, order, at)
    counts = {r["p"]: r["n"] for r in kept.groupBy(F.shiftright(at, 33).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row for each partition
    total, rows = 0, []
    for p in sorted(counts):
        rows.append((p, total))
        total += counts[p]
    starts = df.sparkSession.createDataFrame(rows, f"{part} long, {before} long")
    return kept.join(F.broadcast(starts), F.shiftright(at, 33) == F.col(part)).withColumn(name, F.col(before) + F.col(at).bitwiseAND(F.lit(_INDEX))).drop(at, part, before)


def running(df: DataFrame, by: list[str], order: list, value: Column, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over the rows of the group ``by`` that come before this one.  Groups may have any size: each range
    partition sums its own part, to which the sums of the parts before are added."""
    at, part, v, before = (fresh(df, x) for x in ("at", "part", "value", "before"))
    kept = _sorted(df.withColumn(v, value), [*by, *order], at).withColumn(part, F.shiftright(at, 33))
    sums = kept.groupBy(part, *by).agg(F.sum(v).alias(before))
    sums = sums.withColumn(before, F.coalesce(F.sum(before).over(Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    keys = {c: fresh(kept, f"{c}_of") for c in (part, *by)}
    sums = durable(sums.select(before, *[F.col(c).alias(k) for c, k in keys.items()]))
    same = F.lit(True)
    for c, k in keys.items():
        same = same & F.col(c).eqNullSafe(F.col(k))
    inner = F.sum(v).over(Window.partitionBy(part, *by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)) - F.col(v)
    out = kept.withColumn(name, inner).join(small(sums), same)
    return out.withColumn(name, F.col(name) + F.col(before)).drop(at, part, v, before, *keys.values())


def numbers(df: DataFrame, first: Column, end: Column, name: str, step: int = 1 << 16) -> DataFrame:
    """``df`` with a row for each ``name`` from ``first`` to below ``end``, however many."""
    start, stop = fresh(df, "start"), fresh(df, "stop")
    d = df.withColumn(stop, end.cast("long")).withColumn(start, first.cast("long")).where(F.col(start) < F.col(stop))
    d = d.withColumn(start, F.explode(F.sequence(F.col(start), F.col(stop) - 1, F.lit(step).cast("long"))))
    return d.withColumn(name, F.explode(F.sequence(F.col(start), F.least(F.col(stop), F.col(start) + step) - 1))).drop(start, stop)
