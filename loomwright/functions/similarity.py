"""Similarity measures as columns.  Character n-grams are multisets.  An unknown measure name raises."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def grams(s: Column, n: int) -> Column:
    """All character n-grams in order; none for a shorter string."""
    return F.when(F.char_length(s) >= n, F.transform(F.sequence(F.lit(1), F.char_length(s) - (n - 1)), lambda i: F.substring(s, i, n))).otherwise(F.array().cast("array<string>"))


def shared(a: Column, b: Column) -> Column:
    """Size of the multiset intersection of two arrays."""
    count = lambda arr, g: F.size(F.filter(arr, lambda x: x == g))
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda acc, g: acc + F.least(count(a, g), count(b, g)))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def exact(a: Column, b: Column, n: int = 1) -> Column:
    return F.when(a == b, 1.0).otherwise(0.0)


def jaccard(a: Column, b: Column, n: int = 1) -> Column:
    x, y = grams(a, n), grams(b, n)
    i = shared(x, y)
    return _ratio(i, F.size(x) + F.size(y) - i)


def dice(a: Column, b: Column, n: int = 1) -> Column:
    x, y = grams(a, n), grams(b, n)
    return _ratio(2 * shared(x, y), F.size(x) + F.size(y))


def overlap(a: Column, b: Column, n: int = 1) -> Column:
    x, y = grams(a, n), grams(b, n)
    return _ratio(shared(x, y), F.least(F.size(x), F.size(y)))


def ngram(a: Column, b: Column, n: int = 1) -> Column:
    x, y = grams(a, n), grams(b, n)
    return _ratio(shared(x, y), F.greatest(F.size(x), F.size(y)))


def relative_numbers(a: Column, b: Column, n: int = 1) -> Column:
    """min / max, NaN for two zeros."""
    a, b = a.cast("double"), b.cast("double")
    return F.when(F.greatest(a, b) == 0, F.lit(float("nan"))).otherwise(F.least(a, b) / F.greatest(a, b))


def geo_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radians: bool = False) -> Column:
    """Kilometres on a plane; by default the cosine takes degrees as they are, as callers of old results expect."""
    angle = F.radians(lat1) if radians else lat1
    return 110.25 * F.sqrt(F.pow(lat1 - lat2, F.lit(2)) + F.pow((lon1 - lon2) * F.cos(angle), F.lit(2)))


def geo_score(distance: Column, scale: int = 1) -> Column:
    return F.when(distance <= 5 * scale, 1.0).when(distance <= 20 * scale, 0.75).when(distance <= 100 * scale, 0.5).otherwise(0.0)


def geo(a: Column, b: Column, n: int = 1) -> Column:
    """Of two "lat;lon" strings."""
    part = lambda c, i: F.try_element_at(F.split(c, ";"), F.lit(i)).try_cast("double")
    return geo_score(geo_distance(part(a, 1), part(a, 2), part(b, 1), part(b, 2)), n)


def jaro_value(s: str, t: str) -> float:
    if s == t:
        return 1.0 if s else 0.0
    if not s or not t:
        return 0.0
    reach = max(0, max(len(s), len(t)) // 2 - 1)
    used, left = [False] * len(t), []
    for i, c in enumerate(s):
        for j in range(max(0, i - reach), min(len(t), i + reach + 1)):
            if not used[j] and t[j] == c:
                used[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    swaps = sum(a != b for a, b in zip(left, (c for c, u in zip(t, used, strict=True) if u), strict=True)) // 2
    return (m / len(s) + m / len(t) + (m - swaps) / m) / 3


def jaro_winkler_value(s: str, t: str) -> float:
    j = jaro_value(s, t)
    prefix = 0
    for a, b in zip(s[:4], t[:4], strict=False):
        if a != b:
            break
        prefix += 1
    return j + prefix * 0.1 * (1 - j)


def monge_elkan_value(s: str, t: str) -> float:
    def way(a: list[str], b: list[str]) -> float:
        return sum(max((jaro_winkler_value(x, y) for y in b), default=0.0) for x in a) / len(a) if a else 0.0

    a, b = s.split(), t.split()
    return max(way(a, b), way(b, a))


def _pairwise(f: Callable[[str, str], float]) -> Callable:
    def measure(a: Column, b: Column, n: int = 1) -> Column:
        def run(x: pa.Array, y: pa.Array) -> pa.Array:
            known: dict[tuple, float | None] = {}
            out = []
            for pair in zip(x.to_pylist(), y.to_pylist(), strict=True):
                if pair not in known:
                    known[pair] = None if None in pair else f(*pair)
                out.append(known[pair])
            return pa.array(out, pa.float64())

        return F.arrow_udf(run, "double")(a, b)

    return measure


jaro, jaro_winkler, monge_elkan = _pairwise(jaro_value), _pairwise(jaro_winkler_value), _pairwise(monge_elkan_value)


def url(a: Column, b: Column, n: int = 1) -> Column:
    """Jaro-Winkler of the hosts without www.; null for an unreadable address."""
    h = lambda c: F.regexp_replace(F.try_parse_url(c, F.lit("HOST")), r"^www\.", "")
    return jaro_winkler(h(a), h(b))


MEASURES = {
    "ExactMatchString": exact, "ExactMatchDouble": exact, "Jaccard": jaccard, "DiceSorensen": dice, "Overlap": overlap, "NGram": ngram, "Jaro": jaro, "JaroWinkler": jaro_winkler,
    "MongeElkan": monge_elkan, "EuclidianDistance": geo, "RelativeNumbersSimilarity": relative_numbers, "UrlCompare": url,
}


#: Measures that run in Python, on columns of the plan only, not on elements of lists.
IN_PYTHON = frozenset(("Jaro", "JaroWinkler", "MongeElkan", "UrlCompare"))


def measure(name: str) -> Callable:
    if name not in MEASURES:
        raise ValueError(f"no measure {name!r}; there are {', '.join(MEASURES)}")
    return MEASURES[name]


def best_match_average(xs: Column, ys: Column, compare: Callable[[Column, Column], Column]) -> Column:
    """Mean over the left list of the best match in the right one (not symmetric); null if either is empty."""
    best = F.transform(xs, lambda x: F.array_max(F.transform(ys, lambda y: compare(x, y))))
    return F.when((F.size(xs) > 0) & (F.size(ys) > 0), F.aggregate(best, F.lit(0.0), lambda acc, v: acc + v) / F.size(xs))


def head_only(xs: Column, ys: Column, compare: Callable[[Column, Column], Column]) -> Column:
    return compare(F.try_element_at(xs, F.lit(1)), F.try_element_at(ys, F.lit(1)))


def lower_average(xs: Column, ys: Column, compare: Callable[[Column, Column], Column]) -> Column:
    low = lambda v: F.transform(v, F.lower)
    return best_match_average(low(xs), low(ys), compare)


STRATEGIES = dict.fromkeys(("name", "aliases", "geo_city", "geo_country"), lower_average) | dict.fromkeys(("category", "geo_postal", "gen_employees"), head_only)


def strategy(attribute: str) -> Callable:
    """How two lists of the attribute's values are compared: names and places in lower case, some by their first value, others by the average."""
    return STRATEGIES.get(attribute, best_match_average)


def normalise_weights(weights: dict[str, float]) -> dict[str, float]:
    """Shares, rounded half up to 4 places; non-positive weights go; equal shares if all are zero."""
    total = sum(weights.values())
    if not total:
        return {k: int(1 / len(weights) * 1e4 + 0.5) / 1e4 for k in weights}
    return {k: v for k, w in weights.items() if (v := int(w / total * 1e4 + 0.5) / 1e4) > 0}


def weighted_score(parts: list[tuple[Column, Column, float, list[tuple[str, float, int]]]]) -> Column:
    """Sum over attributes (left, right, weight, [(measure, weight, n)]) that both sides have.  Weights aren't shared out anew when one is
    missing."""
    score = F.lit(0.0)
    for a, b, weight, measures in parts:
        value = F.lit(0.0)
        for name, w, n in measures:
            value = value + measure(name)(a, b, n) * w
        score = score + F.when(a.isNotNull() & b.isNotNull(), value * weight).otherwise(0.0)
    return score


def bucket(score: Column, n: int) -> Column:
    return F.floor(score * n) / n


def cosine_maps(a: Column, b: Column) -> Column:
    """Of two map<string,double>; 0 if a norm is 0."""
    norm = lambda m: F.sqrt(F.aggregate(F.map_values(m), F.lit(0.0), lambda acc, v: acc + v * v))
    dot = F.aggregate(F.map_keys(a), F.lit(0.0), lambda acc, k: acc + F.coalesce(F.try_element_at(a, k) * F.try_element_at(b, k), F.lit(0.0)))
    return _ratio(dot, norm(a) * norm(b))
