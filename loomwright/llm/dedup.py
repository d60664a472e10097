"""MinHash near-duplicates by a multi-index Hamming join.

Each document's word 2-grams give K b-bit minima (b = 16).  The distance of two documents is the number of
positions at which their signatures differ; 1 - distance / K estimates the Jaccard similarity.  The signature
is split into chunks.  By the pigeonhole principle a pair within the threshold has a chunk with at most
``threshold // chunks`` errors, so every way to leave out that many positions of a chunk gives a key, and the
pair shares a key.  Every bucket is then verified on whole signatures, whatever its size: no pair within the
threshold is missed.  Buckets of more than TILE signatures are verified by pairs of tiles, so that no task holds a whole
one; a bucket of m different signatures costs at most m * m / 2 comparisons.  Equal signatures are merged first, so that exact copies cost
one key set.

Whole texts are signed, however long.  Documents without words (null, empty, punctuation only) duplicate nothing.  Repeated rows
and rows that tie in all but some column are one document's copies.  Null doc_ids come last where one of a group is kept.  An empty table
has no duplicates.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .common import bounded, content_key, durable, fresh, small

POSITIONS, CHUNKS, THRESHOLD, SHINGLE, TILE = 30, 6, 11, 2, 2048
_MULT = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.Generator(np.random.PCG64(8)).integers(1, 1 << 63, 256, dtype=np.uint64)


def signatures(texts: pa.Array, positions: int = POSITIONS, shingle: int = SHINGLE) -> list[bytes | None]:
    """2 * positions bytes for each text, None where it has no words."""
    out: list[bytes | None] = [None] * len(texts)
    for s in H.slices(texts):
        doc, h = H.grams(H.tokenise(s), shingle, short=True)
        if not len(h):
            continue
        at = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        sig = np.empty((len(at), positions), dtype="<u2")
        work = np.empty_like(h)
        for k in range(positions):
            np.multiply(h, _MULT[k], out=work)
            work += _ADD[k]
            sig[:, k] = (H.mix(np.minimum.reduceat(work, at)) & np.uint64(0xFFFF)).astype("<u2")
        for i, d in enumerate(doc[at]):
            out[s.first + int(d)] = sig[i].tobytes()
    return out


def _signature_udf(positions: int, shingle: int):
    @F.arrow_udf("binary")
    def signature(texts: pa.Array) -> pa.Array:
        return pa.array(signatures(texts, positions, shingle), type=pa.binary())

    return signature


def chunk_keys(positions: int, chunks: int, threshold: int) -> list[list[int]]:
    """The positions that each key keeps.  Chunks may differ in length by one."""
    errors = threshold // chunks
    edges = [round(i * positions / chunks) for i in range(chunks + 1)]
    return [list(keep) for a, b in zip(edges, edges[1:], strict=False) for keep in combinations(range(a, b), max(0, b - a - errors))]


def _forest(nodes: list[int], sigs: list[bytes], side: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Edges that connect what pairs within the threshold connect: a breadth-first search that compares each found
    node with all that aren't reached yet; where there are two sides, with those of the other side."""
    m = np.frombuffer(b"".join(sigs), dtype="<u2").reshape(len(sigs), -1)
    one, edges = side.max() == side.min(), []
    left = [np.arange(len(nodes))] if one else [np.flatnonzero(side == 0), np.flatnonzero(side == 1)]
    while len(left[0]) and (not one or len(left[0]) > 1):
        queue = [(int(left[0][0]), 0)]
        left[0] = left[0][1:]
        while queue:
            x, s = queue.pop()
            s = 0 if one else 1 - s
            near = (m[left[s]] != m[x]).sum(axis=1) <= threshold
            if near.any():
                edges += [(nodes[x], nodes[y]) for y in left[s][near]]
                queue += [(int(y), s) for y in left[s][near]]
                left[s] = left[s][~near]
    return edges


def _verify(threshold: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            a, b = [], []
            members = batch.column("members")
            off = members.offsets.to_numpy()
            flat = members.flatten()
            nodes, sigs, side = flat.field("node").to_pylist(), flat.field("sig").to_pylist(), flat.field("side").to_numpy()
            base = off[0]
            for i in range(len(members)):
                lo, hi = off[i] - base, off[i + 1] - base
                for x, y in _forest(nodes[lo:hi], sigs[lo:hi], side[lo:hi], threshold):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    return run


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, root) for every node of an edge, root the least node of its component.  Alternating large-star
    and small-star rounds: each round's edges are written to the checkpoint folder."""
    e = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        low = low.select("a", F.least("m", "a").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(least, "a").select(F.greatest("b", "m").alias("x"), F.least("b", "m").alias("m"), "a")
        out = star.select(F.col("a").alias("a"), F.col("m").alias("b")).union(star.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b")))
        new = durable(out.distinct())
        done = new.groupBy("a").count().where("count > 1").isEmpty() and new.join(new.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()
        e = new
        if done:
            break
    else:
        raise RuntimeError("components did not converge")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def signed(docs: DataFrame, positions: int = POSITIONS, shingle: int = SHINGLE) -> DataFrame:
    """(node, content, doc_id, copies, sig): one row for each different (doc_id, text), which a 128-bit hash tells apart, numbered."""
    text = bounded(docs).select("doc_id", "text")
    rows = text.select("doc_id", content_key("doc_id", "text").alias("content"), _signature_udf(positions, shingle)("text").alias("sig"))
    nodes = durable(rows.where("sig is not null").groupBy("content", "doc_id", "sig").agg(F.count(F.lit(1)).alias("copies")))
    return nodes.withColumn("node", F.monotonically_increasing_id())


def _tiled(keyed: DataFrame, tile: int) -> DataFrame:
    """(key, pair, member): every bucket in parts; a member is node * 2 + side.  A bucket of at most ``tile`` nodes is one part, pair -1; a larger one is
    dealt to tiles by the node's hash, and each pair of tiles is a part, with a side for either, so that parts are of bounded size and all pairs
    are in one."""
    large = durable(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > tile).select(F.col("key").alias("large"), F.ceil(F.col("n") / tile).alias("tiles")))
    t = keyed.join(small(large), F.col("key") == F.col("large"), "left").withColumn("own", F.pmod(F.xxhash64("node", F.lit("tile")), "tiles"))
    part = lambda pair, side: F.struct(pair.cast("long").alias("pair"), (F.col("node") * 2 + side.cast("long")).alias("member"))
    own = F.col("own")
    many = F.transform(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda o: part(F.least(own, o) * F.col("tiles") + F.greatest(own, o), own > o))
    return t.select("key", F.explode(F.when(F.col("tiles").isNull(), F.array(part(F.lit(-1), F.lit(0)))).otherwise(many)).alias("p")).select("key", "p.pair", "p.member")


def near_edges(nodes: DataFrame, positions: int, chunks: int, threshold: int, tile: int = TILE) -> DataFrame:
    """(a, b) edges between nodes whose components are those of all pairs within the threshold."""
    reps = durable(nodes.groupBy("sig").agg(F.min("node").alias("node")))
    same = nodes.select("node", "sig").join(reps.withColumnRenamed("node", "rep"), "sig").where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    keys = F.array(*[F.xxhash64(F.lit(i), *[F.substring("sig", 2 * p + 1, 2) for p in keep]) for i, keep in enumerate(chunk_keys(positions, chunks, threshold))])
    parts = _tiled(reps.select("node", F.explode(keys).alias("key")), tile)
    bucket = parts.groupBy("key", "pair").agg(F.array_sort(F.collect_list("member")).alias("members")).where(F.size("members") > 1).select("members").distinct()
    bucket = bucket.select(F.xxhash64("members").alias("bucket"), F.explode("members").alias("m")).select("bucket", F.shiftright("m", 1).alias("node"), F.col("m").bitwiseAND(F.lit(1)).cast("int").alias("side"))
    members = bucket.join(reps, "node").groupBy("bucket").agg(F.collect_list(F.struct("node", "sig", "side")).alias("members")).select("members")
    return same.union(members.mapInArrow(_verify(threshold), "a long, b long"))


def groups(docs: DataFrame, positions: int = POSITIONS, chunks: int = CHUNKS, threshold: int = THRESHOLD, shingle: int = SHINGLE, tile: int = TILE) -> DataFrame:
    """(doc_id, content, keep_id, keep, copies) for every document of a group of near duplicates and every repeated
    row; the group's least (doc_id, content) stays.  Rows that are equal in doc_id and text share a content."""
    nodes = signed(docs, positions, shingle)
    roots = components(near_edges(nodes, positions, chunks, threshold, tile))
    roots = durable(roots.union(roots.select(F.col("root").alias("node"), "root")).distinct())
    member = nodes.drop("sig").join(roots, "node", "left").where("root is not null or copies > 1").withColumn("root", F.coalesce("root", "node"))
    keep = member.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "content")).alias("k"))
    return member.join(keep, "root").select("doc_id", "content", F.col("k.doc_id").alias("keep_id"), F.col("k.content").alias("keep"), "copies")


def near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """(doc_id, duplicate_of): each different text of a document that isn't kept, and the kept document of its group.  Rows that share the kept
    row's doc_id aren't listed, as the pair would name one document; ``drop_near_duplicates`` drops them."""
    g = groups(docs, **params)
    return g.where("content <> keep or copies > 1").select("doc_id", F.col("keep_id").alias("duplicate_of")).where("not (doc_id <=> duplicate_of)")


def drop_near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """All rows of ``docs`` but the near duplicates: one of each group stays, all columns as they are; of rows that repeat the kept doc_id and
    text the one whose other columns are first as JSON.  Texts aren't shuffled while the decisions are few enough to broadcast."""
    g = durable(groups(docs, **params))
    node, act, other = fresh(docs, "node"), fresh(docs, "act"), fresh(docs, "other")
    acts = durable(g.where("content <> keep or copies > 1").select(F.col("content").alias(node), F.when(F.col("content") != F.col("keep"), "drop").otherwise("once").alias(act)))
    marked = docs.withColumn(node, content_key("doc_id", "text")).join(small(acts), node, "left")
    stay = marked.where(F.col(act).isNull()).drop(node, act)
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    once = marked.where(F.col(act) == "once").withColumn(other, F.to_json(F.struct(*rest)) if rest else F.lit(""))
    once = once.groupBy(node).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), other).alias(other)).select(f"{other}.*")
    return stay.unionByName(once.select(*docs.columns))
