"""Problem 8: filling containers of a fixed capacity, by bulk-synchronous best fit.

Each round range-sorts the unplaced items and the gaps of all containers together by size. A successor sweep passes through each range
partition from small to large: every gap takes the largest unmatched item that fits it, so item and gap match like brackets. What a
partition can't match itself are gaps before items; how many there are of each in every partition, one pair of numbers each, tells
which stretch of one partition's items goes with which stretch of a later one's gaps, by rank. Then the gaps are updated, and the
next round begins. If no gap takes any item, as many containers are opened as the rest needs at least.

Items of one size are alike, and so are containers of one gap, so both are kept as runs (size, first number, count); a run of more
items than gaps gives each gap as many as fit and are there. A round's cost thus grows with the distinct sizes, and with the items only
where all sizes differ. Nothing but a few numbers per partition reaches the driver. An item is split only if it exceeds the capacity: full containers
of its own, and a rest that is an item like any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kolam.operators.keyed import positions_in_key
from kolam.scratch import Scratch, local_table

ITEM, GAP, PLACED = 0, 1, 2
_RUN = "kind int, size long, first long, n long, home long, each long, at long, part int"


def successor_sweep(runs: list[tuple[int, int, int, int]]) -> tuple[list[tuple[int, int, int, int, int, int]], list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(matches, unmatched items, unmatched gaps) of runs (size, kind, first, n) in that order.

    A match is (size, first item, gap, first container, containers, items in each); the others are (size, first, n), items from the
    bottom of the stack to its top.
    """
    stack: list[list[int]] = []
    matches, gaps = [], []
    for size, kind, first, n in runs:
        if kind == ITEM:
            if stack and stack[-1][0] == size and stack[-1][1] + stack[-1][2] == first:
                stack[-1][2] += n
            else:
                stack.append([size, first, n])
            continue
        while n and stack:
            top = stack[-1]
            use = min(n, top[2])
            each = max(1, min(size // top[0], top[2] // use))
            matches.append((top[0], top[1], size, first, use, each))
            top[1] += use * each
            top[2] -= use * each
            first, n = first + use, n - use
            if not top[2]:
                stack.pop()
        if n:
            gaps.append((size, first, n))
    return matches, [tuple(s) for s in stack], gaps


def bracket_pairs(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """(item part, first item, gap part, first gap, n) of what is matched across partitions: n unmatched items from that position on,
    from last to first, with n gaps from that position on. counts: (part, unmatched gaps, unmatched items), a row per partition."""
    stack: list[list[int]] = []
    out = []
    for part, gaps, items in sorted(counts):
        at = 0
        while at < gaps and stack:
            top = stack[-1]
            use = min(gaps - at, top[1])
            top[1] -= use
            out.append((top[0], top[1], part, at, use))
            at += use
            if not top[1]:
                stack.pop()
        if items:
            stack.append([part, items])
    return out


def _best_fit(sizes: DataFrame, capacity: int, box: Scratch, runs_per_task: int) -> tuple[DataFrame, int]:
    """((size, first, home, n, each) runs that place all items, and the number of containers). sizes: (size, n)."""
    spark = sizes.sparkSession

    def sweep(batches):
        import pyarrow as pa

        from pyspark import TaskContext

        runs = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("size", "kind", "first", "n")))]
        if runs:
            part = TaskContext.get().partitionId()
            matches, items, gaps = successor_sweep(runs)
            out = [(PLACED, s, f, n, h, each, g, part) for s, f, g, h, n, each in matches]
            for kind, left in ((ITEM, items), (GAP, gaps)):
                at = 0
                for s, f, n in left:
                    out.append((kind, s, f, n, -1, 0, at, part))
                    at += n
            names = [c.split()[0] for c in _RUN.split(", ")]
            kinds = [pa.int32() if c.endswith(" int") else pa.int64() for c in _RUN.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    def overlay(both: pd.DataFrame) -> pd.DataFrame:
        """The runs of one pair, cut where either side changes."""
        both = both.sort_values("t")
        items, gaps = both[both["kind"] == ITEM], both[both["kind"] == GAP]
        if not len(items) or not len(gaps):
            return pd.DataFrame({c.split()[0]: [] for c in _RUN.split(", ")})
        cut = np.unique(np.concatenate([items["t"], gaps["t"]]))
        n = np.diff(np.concatenate([cut, [int(items["t"].iloc[-1] + items["n"].iloc[-1])]]))
        i = np.searchsorted(items["t"].to_numpy(), cut, side="right") - 1
        g = np.searchsorted(gaps["t"].to_numpy(), cut, side="right") - 1
        of = lambda p, k, c: p[c].to_numpy()[k]
        return pd.DataFrame({"kind": PLACED, "size": of(items, i, "size"), "first": of(items, i, "first") + cut - of(items, i, "t"), "n": n, "home": of(gaps, g, "first") + cut - of(gaps, g, "t"), "each": 1, "at": of(gaps, g, "size"), "part": -1})

    # what is left of a run when others of its pair are taken: positions t from 0 within the pair
    def stretches(left: DataFrame, pairs: DataFrame, kind: int) -> DataFrame:
        part, first = ("ip", "i0") if kind == ITEM else ("gp", "g0")
        both = left.where(F.col("kind") == kind).join(F.broadcast(pairs), (F.col("part") == F.col(part)) & (F.col("at") < F.col(first) + F.col("m")) & (F.col(first) < F.col("at") + F.col("n")))
        lo, hi = F.greatest("at", first), F.least(F.col("at") + F.col("n"), F.col(first) + F.col("m"))
        t = (F.col(first) + F.col("m") - hi) if kind == ITEM else (lo - F.col(first))
        return both.select("pair", "kind", "size", (F.col("first") + lo - F.col("at")).alias("first"), (hi - lo).alias("n"), t.alias("t"))

    def unpaired(left: DataFrame, pairs: DataFrame) -> DataFrame:
        """The runs less what pairs take: of items the top, of gaps the bottom."""
        i = pairs.groupBy(F.col("ip").alias("part")).agg(F.min("i0").alias("upto"))
        g = pairs.groupBy(F.col("gp").alias("part")).agg(F.max(F.col("g0") + F.col("m")).alias("from"))
        x = left.join(F.broadcast(i), "part", "left").join(F.broadcast(g), "part", "left")
        lo = F.when(F.col("kind") == GAP, F.greatest("at", F.coalesce("from", F.lit(0)))).otherwise(F.col("at"))
        end = F.col("at") + F.col("n")
        hi = F.when(F.col("kind") == ITEM, F.least(end, F.coalesce("upto", end))).otherwise(end)
        return x.where(hi > lo).select("kind", "size", (F.col("first") + lo - F.col("at")).alias("first"), (hi - lo).alias("n"))

    state = sizes.select(F.lit(ITEM).alias("kind"), "size", F.lit(0).cast("long").alias("first"), "n")
    state = box.save(state, "runs")
    runs, rest, matched, containers = *(state.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("size") * F.col("n")), F.lit(0))).first()), 0, 0
    placed: list[DataFrame] = []
    while rest:
        if not matched:  # at the start, or no gap takes any item
            new = -(-rest // capacity)
            state = state.unionByName(local_table(spark, [(GAP, capacity, containers, new)], "kind int, size long, first long, n long"))
            containers += new
        tasks = 1 + runs // runs_per_task
        ordered = (state.repartitionByRange(tasks, "size", "kind") if tasks > 1 else state.repartition(1)).sortWithinPartitions("size", "kind", "first")
        swept = box.save(ordered.select("size", "kind", "first", "n").mapInArrow(sweep, _RUN), "swept")
        left = swept.where(F.col("kind") != PLACED)
        counts = {} if tasks == 1 else {(r["part"], r["kind"]): r["n"] for r in left.groupBy("part", "kind").agg(F.sum("n").alias("n")).collect()}  # two per partition
        pairs = bracket_pairs([(p, counts.get((p, GAP), 0), counts.get((p, ITEM), 0)) for p in {p for p, _ in counts}])
        hits, left = swept.where(F.col("kind") == PLACED), left.select("kind", "size", "first", "n", "at", "part")
        if pairs:
            table = local_table(spark, [(k, *p) for k, p in enumerate(pairs)], "pair int, ip int, i0 long, gp int, g0 long, m long")  # at most two rows per partition
            across = stretches(left, table, ITEM).unionByName(stretches(left, table, GAP)).groupBy("pair").applyInPandas(overlay, _RUN)
            hits = box.save(hits.unionByName(across), "hits")
            left = unpaired(left, table)
        placed.append(hits.select("size", "first", "home", "n", "each"))
        after = hits.select(F.lit(GAP).alias("kind"), (F.col("at") - F.col("size") * F.col("each")).alias("size"), F.col("home").alias("first"), "n").where(F.col("size") > 0)
        state = left.select("kind", "size", "first", "n").unionByName(after)
        told = state.agg(F.count(F.lit(1)).alias("runs"), F.sum(F.when(F.col("kind") == ITEM, F.col("size") * F.col("n")).otherwise(0)).alias("rest")).first()
        matched, runs, rest = rest - (told["rest"] or 0), told["runs"], told["rest"] or 0
    out = placed[0] if placed else local_table(spark, [], "size long, first long, home long, n long, each long")
    for p in placed[1:]:
        out = out.unionByName(p)
    return box.save(out, "placed"), containers


def pack(items: DataFrame, key: str, size: str, capacity: int = 2048, runs_per_task: int = 50_000, block: int = 256) -> DataFrame:
    """(key, piece, size, container): where each item's pieces go; an item of at most the capacity is one piece, number 0.

    An item of k capacities and a rest gives k pieces that fill a container each and one piece for the rest. Items of null or
    non-positive size hold nothing and get no row. Equal keys are items of their own. Which of equal sizes goes where follows the
    keys' hashes. Containers are numbered from 0 without gaps. No items give no rows.
    """
    if capacity < 1:
        raise ValueError("the capacity must be at least 1")
    spark = items.sparkSession
    box = Scratch(spark, "packing")
    full = items.select(F.col(key).alias("k"), F.col(size).cast("long").alias("z")).where(F.col("z") > 0)
    full = box.save(full.select("k", F.expr(f"z div {capacity}").alias("whole"), (F.col("z") % capacity).alias("size"), F.xxhash64("k").alias("h")), "items")
    loose = full.where(F.col("size") > 0)
    runs, used = _best_fit(loose.groupBy("size").agg(F.count(F.lit(1)).alias("n")), capacity, box, runs_per_task)

    # An item's rank among those of its size finds its run: both are cut into blocks of ranks, so no size is one task's.
    ranked = positions_in_key(loose, "size", ["h", "whole"], "rank", box=box).withColumn("rank", F.col("rank") - 1).withColumn("blk", F.expr(f"rank div {block}"))
    last = F.col("first") + F.col("n") * F.col("each") - 1
    cut = runs.select("size", "first", "home", "each", last.alias("last"), F.explode(F.sequence(F.expr(f"first div {block}"), F.floor(last / block))).alias("blk"))
    at = ranked.alias("x").join(cut.alias("y"), (F.col("x.size") == F.col("y.size")) & (F.col("x.blk") == F.col("y.blk")) & F.col("x.rank").between(F.col("y.first"), F.col("y.last")))
    small = at.select(F.col("x.k").alias(key), F.col("x.whole").alias("piece"), F.col("x.size").alias("size"), (F.col("y.home") + F.expr("(x.rank - y.first) div y.each")).alias("container"))

    # Full containers of the items above the capacity: numbered by a running sum within partitions, and the partitions' totals.
    big = box.save(full.where(F.col("whole") > 0).withColumn("part", F.spark_partition_id()).withColumn("u", F.monotonically_increasing_id()), "big")
    offset, so_far = [], used
    for r in big.groupBy("part").agg(F.sum("whole").alias("n")).orderBy("part").collect():  # one row per partition
        offset.append((r["part"], so_far))
        so_far += r["n"]
    before = F.sum("whole").over(Window.partitionBy("part").orderBy("u").rowsBetween(Window.unboundedPreceding, 0)) - F.col("whole")
    pieces = big.withColumn("before", before).join(F.broadcast(local_table(spark, offset, "part int, off long")), "part")
    pieces = pieces.select("k", "before", "off", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)).alias("piece"))
    large = pieces.select(F.col("k").alias(key), "piece", F.lit(capacity).cast("long").alias("size"), (F.col("off") + F.col("before") + F.col("piece")).alias("container"))
    out = box.save(small.unionByName(large), "packed")
    box.keep_only(out)
    return out
