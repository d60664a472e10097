"""Best-fit packing in bulk-synchronous rounds.

Documents longer than the capacity are cut into full pieces and a rest.  Pieces are range-sorted by length, longest first, and get exact
ranks by distributed prefix counts.  Then round by round all pieces that are left and the gaps of all bins, in range partitions of their
sizes, are swept from large to small, which matches every piece to its successor, the smallest free gap that holds it; of gaps of one size the
one in the lowest bin is first, of pieces of one length the one of the least rank.  The gaps shrink and move to the partition of their new
size, and the rounds go on until nothing fits, when the longest remaining pieces open as many bins as all that is left needs.

A sweep matches like brackets: each partition matches its own pieces and gaps, which leaves pieces without a gap and then gaps without a piece; the
partitions tell each other these (the first superstep), each finds the same matches across partitions from them, and the shrunk gaps move (the
second).  The partitions are the tasks of a barrier stage, so as many cores as there are partitions must be free at once, and dynamic allocation must be
off.  They find each other by the stage's gather, which takes a second a call, and then talk over sockets of their own, with a key for each stage.  Pieces of one length differ only in rank, so what is swept and told is runs of ranks and of bins, never
rows; the rows find their runs by rank in one join.

With ``lane``, in ``pack_in_order`` and in ``pack_rows``, the pieces are dealt to lanes that are packed each for itself, by the same rounds in one task.

Lengths are words between blanks, of whole texts.  Rows without words (null, empty) aren't packed.  Repeated rows and equal doc_ids are packed
as often as they occur.  Pieces that tie in length are in the order of doc_id (nulls first), then of their first token.  Empty tables give
no bins.
"""

from __future__ import annotations

import json
import secrets
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from multiprocessing.connection import Client, Listener

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, durable, fresh, numbers, ranked, running, stored
from .mixing import BLOCK, n_tokens

CAPACITY, LANE, PARTS = 4096, 1 << 22, 4


def rounds(counts: dict[int, int], capacity: int, part: int = 0, parts: int = 1, gather: Callable[[list], list] = lambda said: [said]) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, number, first bin, offset in the bins): pieces of these ranks go to consecutive bins.  ``counts`` has the lengths of
    the range ``part`` of ``parts``; the runs are those whose gaps this part had.  ``gather`` gives every part what each has said."""
    left, rank = {n: c for n, c in counts.items() if c}, dict.fromkeys(counts, 0)
    gaps: dict[int, list[list[int]]] = {}  # size: runs [first bin, number]
    out: list[tuple[int, int, int, int, int]] = []
    bins = 0
    while True:
        stack: list[list[int]] = []  # gaps not taken yet, the smallest on top: [size, first bin, number]
        filled: list[tuple[int, int, int]] = []

        def take(size: int, first: int, most: int, stack: list = stack, filled: list = filled) -> int:
            g = stack[-1]
            k = min(most, g[2])
            out.append((size, first, k, g[1], capacity - g[0]))
            filled.append((g[0] - size, g[1], k))
            g[1] += k
            g[2] -= k
            if not g[2]:
                stack.pop()
            return k

        for size in sorted({*left, *gaps}, reverse=True):
            stack += [[size, *run] for run in sorted(gaps.pop(size, []), reverse=True)]
            while stack and left.get(size):
                k = take(size, rank[size], left[size])
                rank[size] += k
                left[size] -= k
        wants = [(n, rank[n], left[n]) for n in sorted(left, reverse=True) if left[n]]
        said = gather([wants, sum(g[2] for g in stack), len(filled)])
        matched, rest, free = sum(x[2] for x in said), [], []  # free: [part, gaps], the smaller on top
        for q in range(parts - 1, -1, -1):
            for size, first, n in said[q][0]:
                while n and free:
                    k = min(n, free[-1][1])
                    if free[-1][0] == part:
                        done = 0
                        while done < k:
                            done += take(size, first + done, k - done)
                    free[-1][1] -= k
                    if not free[-1][1]:
                        free.pop()
                    first, n, matched = first + k, n - k, matched + 1
                rest += [[q, size, first, n]] if n else []
            free += [[q, said[q][1]]] if said[q][1] else []
        if rest and not matched:
            need = -(-sum(size * n for _, size, _, n in rest) // capacity)
            for x in rest:
                q, size, first, n = x
                k = min(need, n)
                if q == part and k:
                    out.append((size, first, k, bins, 0))
                    filled.append((capacity - size, bins, k))
                x[2:] = first + k, n - k
                bins, need = bins + k, need - k
        mine = [x for x in rest if x[0] == part and x[3]]
        left, rank = {x[1]: x[3] for x in mine}, {x[1]: x[2] for x in mine}
        if not any(x[3] for x in rest):
            return out
        here = lambda size: (size - 1) * parts // capacity == part
        moved = gather([x for x in filled if x[0] and not here(x[0])])
        for size, first, n in [*stack, *(x for x in filled if x[0] and here(x[0])), *(x for q in range(parts) if q != part for x in moved[q] if here(x[0]))]:
            gaps.setdefault(size, []).append([first, n])


def places(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each piece of a lane; pieces of one length are ranked as they come."""
    sizes, starts, counts = np.unique(np.sort(lengths), return_index=True, return_counts=True)
    start = dict(zip(sizes.tolist(), starts.tolist(), strict=True))
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(lengths, kind="stable")
    for n, first, k, bin_, offset in rounds(dict(zip(sizes.tolist(), counts.tolist(), strict=True)), capacity):
        rows = order[start[n] + first : start[n] + first + k]
        bins[rows] = bin_ + np.arange(k)
        offsets[rows] = offset
    return bins, offsets


def cut(rows: DataFrame, total: Column, capacity: int) -> DataFrame:
    """A row (first, n) for each piece of ``total`` tokens, ``first`` its first token."""
    at = F.explode(F.sequence(F.lit(0).cast("long"), total - 1, F.lit(capacity).cast("long")))
    return rows.where(total > 0).withColumn("first", at).withColumn("n", F.least(total - F.col("first"), F.lit(capacity)).cast("long"))


def sweep(pieces: DataFrame, capacity: int) -> DataFrame:
    """(bin, offset, doc_id, first, n) of (lane, place, doc_id, first, n): each lane's pieces in bins of its own, which are numbered from
    lane * 2**32; of pieces of one length the one with the least place is first."""
    kind = dict(pieces.dtypes)["doc_id"]

    def run(key, t):
        t = t.sort_by([("place", "ascending"), ("first", "ascending")])
        bins, offsets = places(t.column("n").to_numpy(), capacity)
        return pa.table({"bin": pa.array(bins + (key[0].as_py() << 32)), "offset": pa.array(offsets), "doc_id": t.column("doc_id"), "first": t.column("first"), "n": t.column("n")})

    return pieces.select("lane", "place", "doc_id", "first", "n").groupBy("lane").applyInArrow(run, f"bin long, offset long, doc_id {kind}, first long, n long")


def gathers(context: BarrierTaskContext, ends: ExitStack) -> Callable[[list], list]:
    """A function that gives each task of the barrier stage what all have said, by partition: the first task hears the others and tells them."""
    part, hosts = context.partitionId(), [x.address.rsplit(":", 1)[0] for x in context.getTaskInfos()]
    key = secrets.token_hex(32)
    listener = ends.enter_context(Listener((hosts[0], 0), backlog=len(hosts), authkey=key.encode())) if part == 0 else None
    host, port, key = json.loads(context.allGather(json.dumps([*listener.address, key] if listener else []))[0])
    if listener:
        others = {}
        for _ in hosts[1:]:
            c = ends.enter_context(listener.accept())
            others[int(c.recv_bytes())] = c

        def hub(said: list) -> list:
            told = json.dumps([said, *(json.loads(others[q].recv_bytes()) for q in range(1, len(hosts)))])
            for c in others.values():
                c.send_bytes(told.encode())
            return json.loads(told)

        return hub
    c = ends.enter_context(Client((host, port), authkey=key.encode()))
    c.send_bytes(str(part).encode())

    def member(said: list) -> list:
        c.send_bytes(json.dumps(said).encode())
        return json.loads(c.recv_bytes())

    return member


def matches(lengths: DataFrame, capacity: int, parts: int = PARTS) -> DataFrame:
    """(start, k, bin, offset) of (n, k, start), the number and the first place of the pieces of each length: the k pieces from place ``start``
    on go to consecutive bins from ``bin`` on."""
    spark = lengths.sparkSession
    parts = max(1, min(parts, capacity, spark.sparkContext.defaultParallelism))
    # a row more for each part, so that none is without a task
    every = spark.range(parts).select(F.col("id").cast("int").alias("part"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("start"))
    ranges = lengths.select(F.expr(f"cast((n - 1) * {parts} div {capacity} as int)").alias("part"), "n", "k", "start").unionByName(every)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist() if r["k"]]
        context = BarrierTaskContext.get()
        with ExitStack() as ends:
            gather = gathers(context, ends)
            starts = {n: at for x in gather([(r["n"], r["start"]) for r in rows]) for n, at in x}
            out = rounds({r["n"]: r["k"] for r in rows}, capacity, context.partitionId(), parts, gather)
        columns = ([starts[x[0]] + x[1] for x in out], *([x[i] for x in out] for i in (2, 3, 4)))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["start", "k", "bin", "offset"])

    return ranges.repartitionById(parts, F.col("part")).mapInArrow(run, "start long, k long, bin long, offset long", barrier=True)


def pack(docs: DataFrame, capacity: int = CAPACITY, lane: int | None = None, parts: int = PARTS) -> DataFrame:
    """(bin, offset, doc_id, first, n): bin contents don't overlap and are at most ``capacity`` long.  The sweeps are over all pieces, in ``parts``
    ranges, or, with ``lane``, each over the pieces of a lane of about so many tokens, to which ranks deal equal shares of every length."""
    d = cut(bounded(docs).select("doc_id", n_tokens("text").alias("total")), F.col("total"), capacity).drop("total")
    p = durable(ranked(durable(d), [F.desc("n"), F.asc("doc_id"), F.asc("first")], "place"))
    if lane is not None:
        tokens = p.agg(F.sum("n").alias("n")).first()["n"] or 0
        lanes = max(1, -(-tokens // lane))
        return sweep(p.withColumn("lane", F.pmod("place", F.lit(lanes)).cast("long")), capacity)
    runs = durable(matches(p.groupBy("n").agg(F.count(F.lit(1)).alias("k"), F.min("place").alias("start")), capacity, parts))
    at = numbers(runs, F.col("start"), F.col("start") + F.col("k"), "place").select("place", (F.col("bin") + F.col("place") - F.col("start")).alias("bin"), "offset")
    return p.join(at, "place").select("bin", "offset", "doc_id", "first", "n")


def pack_in_order(order: DataFrame, capacity: int = CAPACITY, window: int = LANE, block: int = BLOCK) -> DataFrame:
    """As ``pack``, for (doc_id, n_tokens, slot, begins): a lane is a window of the schedule, of as many slots as have ``window`` tokens
    at ``block`` tokens each, so that bins keep the mix: bin numbers go up with the schedule and a bin's pieces come from one window.  Of
    pieces of one length the earlier in the schedule is first."""
    place = fresh(order, "place")
    rows = ranked(durable(order), ["slot", "begins", "doc_id"], place).withColumn("lane", F.floor(F.col("slot") / max(1, window // block)).cast("long"))
    return sweep(cut(rows, F.col("n_tokens"), capacity).withColumn("place", F.col(place)), capacity)


def pack_rows(docs: DataFrame, capacity: int = CAPACITY, window: int = LANE, block: int = BLOCK) -> DataFrame:
    """As ``pack_in_order``, with the rows of ``docs`` in the order in which they are stored as the schedule: a slot is ``block`` tokens of them."""
    at = {f"at{i}": c for i, c in enumerate(stored(docs))}
    d = bounded(docs).select("doc_id", n_tokens("text").alias("n_tokens"), *[c.alias(name) for name, c in at.items()])
    d = running(durable(d).where("n_tokens > 0"), [], list(at), F.col("n_tokens"), "begins")
    return pack_in_order(d.select("doc_id", "n_tokens", F.floor(F.col("begins") / block).alias("slot"), "begins"), capacity, window, block)
