"""Shards of equal bytes by histogram sort.

Rows are ordered by a 64-bit key, the hash of doc_id.  Each round counts, in one pass over (key, bytes) pairs,
the exact bytes below every candidate boundary in all partitions, and narrows each splitter's bracket between
the neighbouring probes, until the splitter is within the tolerance or its bracket holds a single key.  Then
the rows are exchanged once, to the partition of their shard.

Rows with equal keys stay together, so many rows with one doc_id, repeated rows among them, make their shard larger than the others.
Null doc_ids have one key; null and empty texts count no bytes but the row's overhead; texts are counted whole, however long.
Rows that tie in key are in the order of doc_id.  An empty table gives no shards.  The driver holds one bracket for each shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, fresh

TARGET_BYTES, TOLERANCE, PROBES, ROW_BYTES = 64 << 20, 0.01, 5, 16
_TOP = np.uint64(1 << 63)


def _below(weights: DataFrame, probes: np.ndarray) -> np.ndarray:
    """Exact bytes with key < probe, for each of the sorted probes."""
    shared = weights.sparkSession.sparkContext.broadcast(probes)

    def count(batches):
        total = np.zeros(len(shared.value) + 1, np.int64)
        for b in batches:
            at = np.searchsorted(shared.value, b.column("key").to_numpy(), "right")
            np.add.at(total, at, b.column("bytes").to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "bytes"])

    t = weights.mapInArrow(count, "at long, bytes long").groupBy("at").agg(F.sum("bytes").alias("bytes")).toArrow()
    total = np.zeros(len(probes) + 1, np.int64)
    total[t.column("at").to_numpy()] = t.column("bytes").to_numpy()
    return np.cumsum(total)[:-1]


def splitters(weights: DataFrame, target_bytes: int = TARGET_BYTES, tolerance: float = TOLERANCE, probes: int = PROBES) -> tuple[list[int], int]:
    """Boundaries b_1 < b_2 ... : shard i has the keys from b_i to below b_(i+1).  And the number of rounds."""
    total, lo, hi = weights.agg(F.sum("bytes"), F.min("key"), F.max("key")).first()
    if not total:
        return [], 0
    shards = max(1, round(total / target_bytes))
    if shards == 1 or lo == hi:
        return [], 0
    goal = total / shards * np.arange(1, shards)
    # keys as unsigned numbers from 0, whose differences fit; a bracket is (low, high], with the bytes below both
    low, high = np.full(len(goal), lo + 2**63, np.uint64), np.full(len(goal), hi + 2**63, np.uint64)
    under, over = np.zeros(len(goal)), np.full(len(goal), float(total))
    cut, open_ = np.zeros(len(goal), np.uint64), np.ones(len(goal), bool)
    slack, rounds = tolerance * total / shards / 2, 0
    while open_.any():
        rounds += 1
        a, b = low[open_], high[open_]
        gap = b - a
        share = np.clip((goal[open_] - under[open_]) / np.maximum(1.0, over[open_] - under[open_]), 0, 1)
        near = (gap.astype(np.float64) * share).astype(np.uint64)
        step = np.maximum(gap // np.uint64(64), np.uint64(1))
        offsets = [near, near - np.minimum(near, step), near + step, *[gap // np.uint64(probes + 1) * np.uint64(k) for k in range(1, probes + 1)]]
        tried = np.unique(np.concatenate([a + np.clip(o, np.uint64(1), gap) for o in offsets]))
        values = _below(weights, (tried - _TOP).view(np.int64)) if len(tried) else np.zeros(0)
        # bytes below grow with the key: the last probe at or under the goal and the first over it are neighbours
        g = goal[open_]
        at = np.searchsorted(values, g, "right")
        below, above = np.maximum(at - 1, 0), np.minimum(at, len(tried) - 1)
        better = (at > 0) & (tried[below] > a) & (tried[below] <= b)
        a2, u2 = np.where(better, tried[below], a), np.where(better, values[below], under[open_])
        better = (at < len(tried)) & (tried[above] > a) & (tried[above] < b)
        b2, o2 = np.where(better, tried[above], b), np.where(better, values[above], over[open_])
        low[open_], under[open_], high[open_], over[open_] = a2, u2, b2, o2
        miss_low, miss_high = np.abs(under - goal), np.abs(over - goal)
        cut = np.where(open_, np.where(miss_low <= miss_high, low, high), cut)
        open_ &= (np.minimum(miss_low, miss_high) > slack) & (high - low > np.uint64(1))
    cuts = np.unique((cut - _TOP).view(np.int64))
    return [int(c) for c in cuts if lo < c <= hi], rounds


def shard(docs: DataFrame, target_bytes: int = TARGET_BYTES, tolerance: float = TOLERANCE) -> DataFrame:
    """All rows and columns of ``docs`` and ``shard``, in one partition for each shard, sorted by key within."""
    key, name = fresh(docs, "key"), fresh(docs, "shard")
    keyed = F.xxhash64("doc_id")
    weights = durable(docs.select(keyed.alias("key"), (F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES)).cast("long").alias("bytes")))
    cuts, _ = splitters(weights, target_bytes, tolerance)
    bounds = np.array(cuts, dtype=np.int64)

    @F.arrow_udf("int")
    def place(keys: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, keys.to_numpy(zero_copy_only=False), "right").astype(np.int32))

    out = docs.withColumn(key, keyed).withColumn(name, place(key))
    return out.repartitionById(len(cuts) + 1, F.col(name)).sortWithinPartitions(key, "doc_id").drop(key)
