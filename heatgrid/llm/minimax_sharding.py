"""Contiguous shards with the smallest largest size.

Equal texts are an atomic group. The groups are ordered by their smallest
doc_id; a shard is a run of them. The smallest feasible capacity is found by
binary search, checked greedily: fill a shard until the next group would
overflow it. Greedy cuts leave the slack to the last shards, so the groups are
then cut as near to even shares as that capacity allows.

The search needs the groups' starts in order, and there are as many as distinct
texts. The driver holds about ``UNITS`` of them at a time: with more groups it
gets the first and the last start of each of so many stretches of bytes, which
bound the smallest feasible capacity and each shard's start from both sides. It
then gets the starts between these bounds, in as many shorter stretches, until
both sides meet, and looks up those next to the even shares. So the cuts are
those of single groups for any number of them.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatgrid.llm import shared

UNITS = 1 << 17


def greedy_cuts(ends: list[int], capacity: int, shards: int) -> list[int] | None:
    """The units' ends (running sums) cut greedily: each shard's first unit; None if it takes too many."""
    cuts, unit = [], 0
    while unit < len(ends):
        if len(cuts) == shards:
            return None
        cuts.append(unit)
        unit = bisect_right(ends, capacity + (ends[unit - 1] if unit else 0))
    return cuts


def minimax_cuts(sizes: list[int], shards: int) -> list[int]:
    """First unit of each shard for the smallest capacity under which ``shards`` runs hold all units."""
    if not sizes:
        return []
    ends = list(accumulate(sizes))
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        mid = (low + high) // 2
        if greedy_cuts(ends, mid, shards) is None:
            low = mid + 1
        else:
            high = mid
    return greedy_cuts(ends, low, shards)


def narrow(runs: list[tuple[int, int, int]], low: int, high: int, shards: int):
    """Bounds of the smallest feasible capacity in [low, high], and of the shards' starts for these capacities.

    ``runs`` are (first start, last start, groups) of stretches in order, the last one the end of all; what
    starts within a run is not known. Holds while the starts for all of [low, high] are in the runs.
    """
    firsts, lasts = [r[0] for r in runs], [r[1] for r in runs]

    def starts(capacity: int, late: bool) -> list[int]:
        found = [0]
        for _ in range(shards):
            reach = found[-1] + capacity
            k = bisect_right(firsts, reach) - 1
            found.append(lasts[k] if reach >= lasts[k] else reach if late else firsts[k])
        return found

    def least(late: bool) -> int:
        a, b = low, high
        while a < b:
            mid = (a + b) // 2
            if starts(mid, late)[-1] < lasts[-1]:
                a = mid + 1
            else:
                b = mid
        return a

    low, high = least(True), least(False)
    return low, high, starts(low, False), starts(high, True)


def search(fetch: Callable, runs: list[tuple[int, int, int]], low: int, high: int, shards: int) -> list[int]:
    """The shards' starts, and the end, for the smallest feasible capacity in [low, high].

    ``fetch`` gives the runs in windows (a, b), or single starts. Where windows do not get emptier (their
    bounds lie on two sides of a large group), the middle capacity is settled on its own.
    """
    before = None
    while True:
        low, high, early, late = narrow(runs, low, high, shards)
        if low == high and early == late:
            return early
        # cut at each bound, so that a start's later bound is resolved whatever else its window meets
        ends = sorted({*early, *(b + 1 for b in late)})
        windows = [(a, b - 1) for a, b in zip(ends, ends[1:]) if any(c <= a <= d for c, d in zip(early, late))]
        inside, k = 0, 0
        for first, last, n in runs:
            while k < len(windows) - 1 and windows[k][1] < first:
                k += 1
            inside += n if windows[k][0] <= last and first <= windows[k][1] else 0
        if low < high and inside > UNITS and before is not None and 2 * inside > before:
            mid = (low + high) // 2
            if search(fetch, runs, mid, mid, shards)[-1] == runs[-1][0]:
                high = mid
            else:
                low = mid + 1
            continue
        before = inside
        runs = [*fetch(windows, inside <= UNITS), runs[-1]]


def earliest(fetch: Callable, runs: list[tuple[int, int, int]], capacity: int, shards: int) -> list[int]:
    """Per shard the first start from which it and those after it hold the rest: greedy from the end."""
    total = runs[-1][0]

    def turned(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        return [(total - b, total - a, n) for a, b, n in reversed(found)]

    def fetch_turned(windows: list, single: bool) -> list[tuple[int, int, int]]:
        found = turned(fetch([(total - b, total - a) for a, b in reversed(windows)], single))
        return [(0, 0, 0), *found] if windows[0][0] == 0 else found

    back = search(fetch_turned, [*turned(runs), (total, total, 0)], capacity, capacity, shards)
    return [total - at for at in reversed(back)]


def level(around: Callable, early: list[int], capacity: int, shards: int, total: int) -> list[int]:
    """The shards' starts, and the end: each as near as may be to an even share of what is left.

    ``around`` gives the last start up to a place and the first one after it. No shard exceeds ``capacity``,
    and none but those after the last group is empty.
    """
    found = [0]
    for k in range(1, shards):
        last = found[-1]
        if last < total:
            goal = last + (total - last) // (shards - k + 1)
            low, high = around(goal)
            late = low == last or high - goal < goal - low and high - last <= capacity
            last = max(high if late else low, early[k])
        found.append(last)
    return [*found, total]


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    task, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        size = batch.column(1).to_numpy()
        before = total + np.cumsum(size) - size
        total += int(size.sum())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(size), task, np.int32)),
                                          pa.array(before)], names=[*batch.schema.names, "part", "before"])


def shard(docs: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size``: UTF-8 bytes of the text plus ``overhead``; a null text counts as
    empty. Equal texts are in one shard. ``slot`` numbers a shard's rows from
    0. ``law`` is ``bytes`` and ``grown_shard`` null. Rows without doc_id come
    before all others in the order; rows that repeat a doc_id are rows like
    any other. Fewer groups than shards leave shards empty. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    stage = shared.Stage(spark, "sharding")
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    rows = stage.keep("rows", docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("same")))
    lowest = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    groups = rows.groupBy("same").agg(F.min(lowest).alias("first"), F.sum("size").alias("bytes"))
    # groups may share a first id (rows that repeat one): they are ordered by text then
    ordered = stage.keep("groups", groups.select("first", "bytes", "same").repartitionByRange("first", "same")
                         .sortWithinPartitions("first", "same")
                         .mapInArrow(_running, "first long, bytes long, same binary, part int, before long"))
    parts = ordered.groupBy("part").agg(F.sum("bytes").alias("n")).select(
        "part", F.expr("coalesce(sum(n) over (order by part rows between unbounded preceding and 1 preceding), 0)")
        .alias("at"))
    total, count, largest = ordered.agg(F.sum("bytes"), F.count("*"), F.max("bytes")).first()
    placed = ordered.join(F.broadcast(parts), "part").withColumn("at", F.col("at") + F.col("before"))

    def fetch(windows: list, single: bool) -> list[tuple[int, int, int]]:
        most, base, of = max(2, UNITS // len(windows)), 0, []
        for a, b in windows:
            width = 1 if single else (b - a) // most + 1
            of.append(F.when(F.col("at").between(a, b), F.expr(f"{base} + (at - {a}) div {width}")))
            base += (b - a) // width + 1
        found = (placed.filter(F.col("at") < total).select("at", F.coalesce(*of).alias("run")).filter("run is not null")
                 .groupBy("run").agg(F.min("at"), F.max("at"), F.count("*")))
        return sorted(tuple(r)[1:] for r in found.collect())

    def near(runs: list) -> list[tuple[int, int, int]]:
        """The runs, with those around the even shares in shorter ones."""
        firsts, reach = [r[0] for r in runs], len(runs) // (8 * shards)
        at = [bisect_right(firsts, total * k // shards) - 1 for k in range(1, shards)]
        picked = sorted({i for k in at for i in range(max(0, k - reach), min(len(runs) - 1, k + reach + 1))})
        if all(runs[i][2] <= 2 for i in picked):
            return runs
        spans, inner = [], set(picked)      # a window at most for each share
        for i in picked:
            if spans and spans[-1][1] == i - 1:
                spans[-1][1] = i
            else:
                spans.append([i, i])
        found = fetch([(runs[a][0], runs[b][1]) for a, b in spans], sum(runs[i][2] for i in picked) <= UNITS)
        return sorted(found + [r for i, r in enumerate(runs) if i not in inner])

    def lookup(runs: list) -> Callable:
        firsts = [r[0] for r in runs]

        def around(place: int) -> tuple[int, int]:
            k = bisect_right(firsts, place) - 1
            first, last, n = runs[k]
            if place >= last:
                return last, firsts[k + 1]
            if n == 2:
                return first, last
            inside = placed.filter(F.col("at").between(first, last))
            return tuple(inside.agg(F.max(F.when(F.col("at") <= place, F.col("at"))),
                                    F.min(F.when(F.col("at") > place, F.col("at")))).first())
        return around

    cuts = []
    if total:
        runs = [*fetch([(0, total)], count <= UNITS), (total, total, 0)]
        greedy = search(fetch, runs, max(largest, -(-total // shards)), total, shards)
        capacity = max(b - a for a, b in zip(greedy, greedy[1:]))
        early = earliest(fetch, runs, capacity, shards)
        cuts = [at for at in level(lookup(near(runs)), early, capacity, shards, total) if at < total]
    elif count:
        cuts = [0]
    of = F.lit(-1)
    for cut in cuts:
        of = of + (F.col("at") >= cut).cast("int")
    dealt = rows.join(placed.select("same", of.alias("shard")), "same").select("doc_id", "size", "text_crc32", "shard")
    return shared.numbered(stage, "dealt", dealt, ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
