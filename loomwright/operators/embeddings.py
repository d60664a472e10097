"""Sentence embeddings: word weights, weighted sums, first-component removal, k-means."""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_tokens(tokens: Column, digits: bool = True, stop: tuple[str, ...] = ()) -> Column:
    """Lower case without number signs; ``digits`` keeps tokens that have some, ``stop`` words go; so do tokens that then are empty."""
    low = F.transform(tokens, lambda t: F.replace(F.lower(t), F.lit("#"), F.lit("")))
    kept = F.filter(low, lambda t: (t != "") if digits else (t != "") & ~t.rlike("[0-9]"))
    return F.filter(kept, lambda t: ~t.isin(*stop)) if stop else kept


def word_weights(frequencies: DataFrame, a: float = 1e-7) -> DataFrame:
    """(word, weight): a / (a + share)."""
    total = frequencies.agg(F.sum("n").alias("total"))
    return frequencies.crossJoin(F.broadcast(total)).select("word", (F.lit(a) / (F.lit(a) + F.col("n") / F.col("total"))).alias("weight"))


def element_sum(rows: DataFrame, key: str, vector: str) -> DataFrame:
    parts = rows.select(key, F.posexplode(vector).alias("i", "x")).groupBy(key, "i").agg(F.sum("x").alias("x"))
    return parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("embedding"))


def sentence_embeddings(tokens: DataFrame, vectors: DataFrame, weights: DataFrame) -> DataFrame:
    """(id, embedding) from (id, word): the weighted sum of the known words' vectors; sentences without one are dropped."""
    known = vectors.join(weights, "word", "left").withColumn("w", F.coalesce("weight", F.lit(1.0)))
    known = known.select("word", F.expr("transform(vector, x -> x * w)").alias("v"))
    # vectors are weighted once for each word, so that the tokens are joined once
    return element_sum(tokens.join(known, "word").select("id", "v"), "id", "v")


def gram_matrix(rows: DataFrame, vector: str) -> np.ndarray:
    """Sum of x xT; partial sums per partition, dimension squared values come to the driver."""

    def part(batches):
        total = None
        for pdf in batches:
            if len(pdf):
                m = np.stack(pdf[vector].to_numpy()).astype(float)
                total = m.T @ m if total is None else total + m.T @ m
        if total is not None:
            import pandas as pd

            yield pd.DataFrame({"i": np.arange(total.size), "x": total.ravel()})

    got = rows.select(vector).where(F.col(vector).isNotNull()).mapInPandas(part, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").collect()
    d = int(round(len(got) ** 0.5))
    return np.array([r["x"] for r in got]).reshape(d, d)


def first_component(rows: DataFrame, vector: str) -> list[float]:
    """Of the uncentred matrix; its largest entry is positive."""
    g = gram_matrix(rows, vector)
    if not g.size:
        return []
    v = np.linalg.eigh(g)[1][:, -1]
    return (v * np.sign(v[np.abs(v).argmax()])).tolist()


def remove_component(x: Column, v: list[float]) -> Column:
    u = F.array(*[F.lit(float(c)) for c in v])
    dot = F.aggregate(F.zip_with(x, u, lambda a, b: a * b), F.lit(0.0), lambda acc, y: acc + y)
    return F.zip_with(x, u, lambda a, b: a - dot * b)


def k_means(rows: DataFrame, vector: str, k: int, iterations: int = 300, seed: int = 1) -> DataFrame:
    """``rows`` with ``cluster``."""
    v = rows.where(F.size(vector) > 0).withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
    return KMeans(k=k, maxIter=iterations, seed=seed, predictionCol="cluster").fit(v).transform(v).drop("features")
