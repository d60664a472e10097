"""Tokens, contexts, term statistics, TF-IDF and second-order features."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stem import stems
from ..ranges import ranked
from ..session import durable

WORD = r"[A-Za-zÀ-ÖØ-öø-ÿ0-9]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def whitespace_tokens(text: Column) -> Column:
    return F.split(text, " ")


def clean_tokens(text: Column) -> Column:
    """Split on blanks and line ends, punctuation and quotes stripped; tokens may be empty."""
    return F.transform(F.split(text, "[ \n]"), lambda t: F.regexp_replace(t, r"[().!?,;:'\"„“”`´]", ""))


def sentences(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+|\n+"), lambda x: F.trim(x)), lambda s: s != "")


def without_symbols(tokens: Column, stop: Sequence[str] = ()) -> Column:
    """Tokens with a letter or digit that aren't stop words."""
    kept = F.filter(tokens, lambda t: t.rlike(r"[\p{L}\p{N}]"))
    return F.filter(kept, lambda t: ~F.lower(t).isin(*stop)) if stop else kept


def process(tokens: Column, stop: Sequence[str] = (), stem: bool = False) -> Column:
    """Stop words go (case matters) before stemming."""
    kept = F.filter(tokens, lambda t: ~t.isin(*stop)) if stop else tokens
    return stems(kept) if stem else kept


TOKENIZERS = {"whitespace": whitespace_tokens, "clean": clean_tokens, "words": words, "clean_words": lambda text: F.filter(words(text), lambda t: ~t.isin(*".!?,;:")), "sentences": sentences}


def tokenizer(args: Sequence[str] = ()) -> Callable[[Column], Column]:
    """By up to three arguments: a name, whether stop words go, whether words are stemmed; missing ones mean words, yes and yes.  The function takes the
    text and, where they are to go, the stop words."""
    if len(args) > 3:
        raise ValueError("a tokenizer takes at most three arguments")
    name, *flags = [*args, *("words", "true", "true")[len(args) :]]
    if name not in TOKENIZERS:
        raise ValueError(f"no tokenizer {name!r}; there are {', '.join(TOKENIZERS)}")
    stop_too, stem = (f.lower() == "true" for f in flags)
    return lambda text, stop=(): process(TOKENIZERS[name](text), stop if stop_too else (), stem)


def term_frequency(docs: DataFrame) -> DataFrame:
    """(doc_id, term, tf), lower case."""
    t = docs.select("doc_id", F.explode(F.transform(words(F.col("text")), F.lower)).alias("term"))
    return t.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def distinct_terms(docs: DataFrame) -> DataFrame:
    """(term), lower case, once for each document that has it: what document frequencies count, without a shuffle by document."""
    return docs.select(F.explode(F.array_distinct(F.transform(words(F.col("text")), F.lower))).alias("term"))


def document_frequency(tf: DataFrame, least: int = 5) -> DataFrame:
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= least)


def tf_idf(tf: DataFrame, df: DataFrame, n_docs: int, default_df: int = 4) -> DataFrame:
    """tf * log10(N / df); rarer terms than the document frequencies hold get the default."""
    return tf.join(df, "term", "left").withColumn("tfidf", F.col("tf") * F.log10(F.lit(n_docs) / F.coalesce("df", F.lit(default_df))))


def context(tokens: Column, at: Column, length: Column, size: int = 20) -> Column:
    """Tokens on both sides of the ``length`` tokens at index ``at`` (0-based), without them."""
    left = F.slice(tokens, F.greatest(F.lit(1), at - size + 1), F.least(at, F.lit(size)))
    return F.concat(left, F.slice(tokens, at + length + 1, F.lit(size)))


def cosine_join(tfidf: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, cosine) of the given pairs of doc_ids; 0 without a common term."""
    norm = tfidf.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf"))).alias("norm"))
    x = tfidf.select(F.col("doc_id").alias("a"), "term", F.col("tfidf").alias("x"))
    y = tfidf.select(F.col("doc_id").alias("b"), "term", F.col("tfidf").alias("y"))
    dot = pairs.join(x, "a").join(y, ["b", "term"]).groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("dot"))
    out = pairs.join(dot, ["a", "b"], "left").join(norm.withColumnsRenamed({"doc_id": "a", "norm": "na"}), "a", "left").join(norm.withColumnsRenamed({"doc_id": "b", "norm": "nb"}), "b", "left")
    return out.select("a", "b", F.when((F.col("na") > 0) & (F.col("nb") > 0), F.coalesce("dot", F.lit(0.0)) / (F.col("na") * F.col("nb"))).otherwise(0.0).alias("cosine"))


def _vectors(tfidf: DataFrame) -> DataFrame:
    """(doc_id, at, x): each document's terms, by their places from the rarest to the most frequent, and their weights over the norm; documents without a
    norm are left out."""
    df = tfidf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = tfidf.select("doc_id", "term", "tfidf").join(ranked(df, ["df", "term"], "place").drop("df"), "term")
    v = w.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("place", "tfidf"))).alias("v")).select("doc_id", F.col("v.place").alias("at"), F.col("v.tfidf").alias("x"))
    return v.withColumn("x", F.arrow_udf(_unit, "array<double>")("x")).where("x is not null")


def _unit(x: pa.Array) -> pa.Array:
    """Arrays over their norms; null where it is 0."""
    out = []
    for v in x:
        v = v.values.to_numpy(zero_copy_only=False)
        norm = np.sqrt(v @ v)
        out.append(v / norm if norm > 0 else None)
    return pa.array(out, pa.list_(pa.float64()))


def _prefixes(least: float) -> Callable[[pa.Array], pa.Array]:
    def run(x: pa.Array) -> pa.Array:
        """How many terms the prefix has, and the norm of the rest."""
        out = []
        for v in x:
            rest = np.sqrt(np.append(np.cumsum(np.square(v.values.to_numpy(zero_copy_only=False))[::-1])[::-1], 0))
            n = int((rest[:-1] >= least - 1e-9).sum())
            out.append({"n": n, "rest": rest[n]})
        return pa.array(out, pa.struct([("n", pa.int32()), ("rest", pa.float64())]))

    return run


def _near(least: float, step: int = 1 << 22) -> Callable[[pa.Table], pa.Table]:
    """(a, b) of two blocks of prefixes whose cosine may be ``least``: what they share before the end of the shorter prefix, and no more than the norms
    of what both have after it."""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        side, ids, rest = (t[c].to_numpy() for c in ("own", "doc_id", "rest"))
        one = t["i"][0].as_py() == t["j"][0].as_py()
        lists = t["at"].chunk(0)
        n = np.diff(lists.offsets.to_numpy())
        at, x = lists.flatten().to_numpy(), t["x"].chunk(0).flatten().to_numpy()
        row, begin = np.repeat(np.arange(len(n)), n), np.append(0, np.cumsum(n))
        squares = np.append(0, np.cumsum(x * x))
        end = at[begin[1:] - 1]
        mine = np.full(len(n), True) if one else side == t["i"][0].as_py()
        other = mine if one else ~mine
        # rows and columns of the matrix of sums
        place, k, m = np.zeros(len(n), np.int64), int(mine.sum()), int(other.sum())
        place[mine] = np.arange(k)
        column = place.copy()
        column[other] = np.arange(m)
        parts = []
        for keep in (mine, other):
            idx = np.flatnonzero(keep[row])
            parts.append(idx[np.argsort(at[idx], kind="stable")])
        left, right = parts
        low, high = np.searchsorted(at[right], at[left]), np.searchsorted(at[right], at[left], "right")
        size = high - low
        sums = np.zeros(k * m)
        cuts = np.append(0, np.cumsum(size))
        start = 0
        while start < len(left):  # some millions of products at a time
            stop = max(start + 1, int(np.searchsorted(cuts, cuts[start] + step, "right")) - 1)
            s = size[start:stop]
            l, r = np.repeat(left[start:stop], s), right[np.repeat(low[start:stop] - (cuts[start:stop] - cuts[start]), s) + np.arange(s.sum())]  # noqa: E741
            np.add.at(sums, place[row[l]] * m + column[row[r]], x[l] * x[r])
            start = stop
        hit = np.flatnonzero(sums)
        a, b = np.flatnonzero(mine)[hit // m], np.flatnonzero(other)[hit % m]
        total = sums[hit]
        if one:
            a, b, total = (v[ids[a] < ids[b]] for v in (a, b, total))
        first = np.minimum(end[a], end[b])

        def after(d: np.ndarray) -> np.ndarray:
            """The norm of what comes after the end of the shorter prefix."""
            # places are ranks below 2**40, so that each prefix is a stretch of one sorted array
            stop = np.searchsorted((row << 40) + at, (d << 40) + first, "right")
            return np.sqrt(np.maximum(squares[begin[d + 1]] - squares[stop], 0) + rest[d] ** 2)

        good = total + after(a) * after(b) >= least - 1e-6
        a, b = ids[a[good]], ids[b[good]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def _dots(ats: pa.Array, xs: pa.Array, bts: pa.Array, ys: pa.Array) -> pa.Array:
    out = []
    for a, x, b, y in zip(ats, xs, bts, ys, strict=True):
        _, i, j = np.intersect1d(a.values.to_numpy(), b.values.to_numpy(), assume_unique=True, return_indices=True)
        out.append(float(x.values.to_numpy()[i] @ y.values.to_numpy()[j]))
    return pa.array(out, pa.float64())


def cosine_search(tfidf: DataFrame, least: float = 0.8, block: int = 1 << 12) -> DataFrame:
    """(a, b, cosine), a < b, of all pairs of documents with a cosine of at least ``least`` > 0.  Terms are ordered from the rarest; a document's prefix
    ends where the norm of the rest is under ``least``, so that what only the rests share can't reach it.  Each pair of blocks of about ``block``
    documents sums what their prefixes share, so that no pair of a document and a shared term is shuffled; pairs that may reach ``least``, by that sum and
    by the norms of the rests, are compared by their whole vectors.  Ids are whole numbers."""
    if least <= 0:
        raise ValueError("least must be over 0")
    v = durable(_vectors(tfidf))
    k = max(1, -(-v.count() // block))
    p = v.withColumn("p", F.arrow_udf(_prefixes(least), "struct<n:int,rest:double>")("x"))
    p = p.select("doc_id", F.slice("at", F.lit(1), F.col("p.n")).alias("at"), F.slice("x", F.lit(1), F.col("p.n")).alias("x"), "p.rest", F.pmod(F.xxhash64("doc_id"), F.lit(k)).cast("int").alias("own")).where("size(at) > 0")
    p = p.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("with")).select("*", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j")).drop("with")
    spread = min(k * (k + 1) // 2, 1 << 13)
    pairs = durable(p.repartition(spread, "i", "j").groupBy("i", "j").applyInArrow(_near(least), "a long, b long"))
    x, y = (v.select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "at", "x"), names, strict=True)]) for names in (("a", "ats", "xs"), ("b", "bts", "ys")))
    return pairs.join(x, "a").join(y, "b").select("a", "b", F.arrow_udf(_dots, "double")("ats", "xs", "bts", "ys").alias("cosine")).where(F.col("cosine") >= least)


def second_order(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Rank, distance to the top and to the next lower different value; infinite where there is none."""
    down = Window.partitionBy(*group).orderBy(F.desc(value))
    inf = F.lit(float("inf"))
    top = F.max(value).over(Window.partitionBy(*group))
    levels = df.select(*group, value).distinct().withColumn("next", F.lead(value).over(down))
    lower = levels.select(*group, F.col(value), "next")
    out = df.withColumn("rank", F.rank().over(down)).withColumn("delta_top", F.when(F.col(value) == top, inf).otherwise(top - F.col(value)))
    return out.join(lower, [*group, value]).withColumn("delta_successor", F.coalesce(F.col(value) - F.col("next"), inf)).drop("next")
