"""Quality by a hashed n-gram log-likelihood ratio between trusted target and raw corpus.

Two multinomials over ``buckets`` hashed 1- and 2-grams of words and marks: of the trusted documents, and of all
documents.  A document's score is the mean over its n-grams of log p_target - log p_raw.  Documents at or over
the threshold stay.  All documents are counted, and each is scored over its whole text.

Texts are counted and scored whole, however long.  Documents without n-grams (null, empty) score None and don't stay.  Repeated rows are counted and
scored as often as they occur; a trusted doc_id marks all rows that have it; rows without a doc_id are never trusted.  A score that
ties with the threshold stays.  Without trusted documents both multinomials are the corpus's, every score is 0.  An empty table has no
scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .common import bounded, fresh, small

BUCKETS, THRESHOLD, SMOOTH = 1 << 16, -0.25, 1.0


def ngrams(s: H.Slice, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and buckets of all 1- and 2-grams."""
    t = H.tokenise(s, H.WORDS_AND_MARKS)
    doc2, two = H.grams(t, 2)
    return np.concatenate([t.doc, doc2]), np.concatenate([t.hash % np.uint64(buckets), two % np.uint64(buckets)]).astype(np.int64)


def _count(buckets: int):
    def run(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            trusted = b.column("trusted").to_numpy(zero_copy_only=False)
            for s in H.slices(b.column("text"), lower=False):
                doc, at = ngrams(s, buckets)
                raw += np.bincount(at, minlength=buckets)
                target += np.bincount(at[trusted[s.first + doc]], minlength=buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"])

    return run


def log_ratio(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Of each bucket; ``buckets`` rows come to the driver."""
    ids = trusted.select("doc_id").where("doc_id is not null").distinct()
    mark = fresh(ids, "trusted")
    rows = bounded(docs).select("doc_id", "text").join(small(ids.withColumn(mark, F.lit(True))), "doc_id", "left").select("text", F.coalesce(mark, F.lit(False)).alias("trusted"))
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in rows.mapInArrow(_count(buckets), "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(buckets)
    return np.log((target + SMOOTH) / (target.sum() + SMOOTH * buckets)) - np.log((raw + SMOOTH) / (raw.sum() + SMOOTH * buckets))


def mean_scores(texts: pa.Array, ratio: np.ndarray) -> pa.Array:
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    for s in H.slices(texts, lower=False):
        doc, at = ngrams(s, len(ratio))
        total[s.first : s.first + len(s)] = H.per_doc(doc, len(s), ratio[at])
        n[s.first : s.first + len(s)] = H.per_doc(doc, len(s))
    return pa.array(np.round(total / np.maximum(1, n), 9), mask=n == 0)


def scored(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, score, keep) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(log_ratio(docs, trusted, buckets))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return mean_scores(texts, shared.value)

    return docs.select("doc_id", score("text").alias("score")).withColumn("keep", F.coalesce(F.col("score") >= threshold, F.lit(False)))
