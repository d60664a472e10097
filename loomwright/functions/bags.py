"""Bags (multisets) as map<string, number>: only positive counts are kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _positive(bag: Column) -> Column:
    return F.map_filter(bag, lambda _, n: n > 0)


def of(values: Column) -> Column:
    """The bag of an array's values, nulls left out; keys are sorted."""
    have = F.filter(values, lambda v: v.isNotNull())
    return F.map_from_entries(F.transform(F.array_sort(F.array_distinct(have)), lambda v: F.struct(v, F.size(F.filter(have, lambda x: x == v)))))


def plus(a: Column, b: Column) -> Column:
    return _positive(F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0))))


def minus(a: Column, b: Column) -> Column:
    """What is left of the first; counts don't go below none."""
    return _positive(F.map_zip_with(a, b, lambda _, x, y: F.coalesce(x, F.lit(0)) - F.coalesce(y, F.lit(0))))


def add(bag: Column, value: Column, n: int = 1) -> Column:
    return plus(bag, F.create_map(value, F.lit(n)))


def remove(bag: Column, value: Column, n: int = 1) -> Column:
    return minus(bag, F.create_map(value, F.lit(n)))


def normalise(bag: Column) -> Column:
    """Counts divided by the greatest, to 2 places."""
    top = F.array_max(F.map_values(bag))
    return F.transform_values(bag, lambda _, n: F.round(n / top, 2))


def size(bag: Column) -> Column:
    return F.aggregate(F.map_values(bag), F.lit(0).cast("long"), lambda acc, n: acc + n)
