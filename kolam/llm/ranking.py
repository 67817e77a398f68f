"""Problem 4: one ranking from several differently scaled scores, by a rank-walk Markov chain.

From an item the walk picks one of the scores at random and jumps to an item that is at least as high in that score, each alike;
with the damping's remainder it jumps anywhere. Only ranks matter, so no score weighs more for its scale. Power iteration needs,
for each score, the mass of the items at each value, divided by the number of items at or above it, and summed over all lower
values: a prefix sum over the score's distinct values in order. No values are merged, so the result is that of the walk itself.

The distinct values are counted first. If all scores together have at most `table_values`, their sums fit one bounded table, which is
sent to all tasks; a round is then one pass over the items. Beyond that nothing is sent but one number per partition: values are
range-sorted, each partition sums its own stretch, and the partitions' totals give the offsets. Both ways give the same walk.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kolam.llm.cutoffs import keep_fraction_cutoffs
from kolam.scratch import Scratch, local_table


def rank_walk(items: DataFrame, scores: list[str], key: str, damping: float = 0.85, tolerance: float = 1e-10, max_rounds: int = 200, table_values: int = 1_000_000) -> DataFrame:
    """(key, stationarity) of the items that have a number in every score; greater is better.

    Items with a null or NaN score take no part. Equal items get equal stationarity; the order between them is for the caller to
    fix. Repeated keys are items of their own. No items give no rows. Rounds end when no item's mass moves by more than tolerance / n;
    if that isn't reached in max_rounds, a RuntimeError says so. table_values bounds what is sent to all tasks, not the result.
    """
    spark = items.sparkSession
    box = Scratch(spark, "ranking")
    names = [f"s{i}" for i in range(len(scores))]
    full = items.select(F.col(key).alias("k"), *[F.col(s).cast("double").alias(n) for s, n in zip(scores, names)])
    for s in names:
        full = full.where(F.col(s).isNotNull() & ~F.isnan(s))
    full = box.save(full, "scores")
    n = full.count()
    out_schema = f"k {dict(full.dtypes)['k']}, stationarity double"
    if not n:
        return local_table(spark, [], out_schema).withColumnRenamed("k", key)
    each = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(s).alias("v")) for i, s in enumerate(names)]))
    values = box.save(full.select(each).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")), "values")
    walk = _walk_by_table if values.count() <= table_values else _walk_by_partitions
    out = box.save(walk(full, values, names, n, damping, tolerance, max_rounds, box), "stationarity")
    box.keep_only(out)
    return out.withColumnRenamed("k", key)


def _walk_by_table(full: DataFrame, values: DataFrame, names: list[str], n: int, damping: float, tolerance: float, max_rounds: int, box: Scratch) -> DataFrame:
    import pyarrow as pa

    sc = full.sparkSession.sparkContext
    rows = values.toPandas().sort_values(["i", "v"])
    edges = [rows["v"].to_numpy()[rows["i"].to_numpy() == i] for i in range(len(names))]
    starts = np.concatenate([[0], np.cumsum([len(e) for e in edges])])
    d = int(starts[-1])
    b_edges = sc.broadcast((edges, starts))
    cells = [f"c{i}" for i in range(len(names))]
    kind = dict(full.dtypes)["k"]

    def to_cells(batches):
        edges, starts = b_edges.value
        for b in batches:
            at = [(np.searchsorted(e, b.column(s).to_numpy(zero_copy_only=False)) + o).astype(np.int32) for e, o, s in zip(edges, starts, names)]
            yield pa.RecordBatch.from_arrays([b.column("k"), *map(pa.array, at)], names=["k", *cells])

    table = box.save(full.mapInArrow(to_cells, f"k {kind}, " + ", ".join(f"{c} int" for c in cells)), "cells")

    def prefix(x):
        """Sums up to each place, anew in each score."""
        return np.concatenate([np.cumsum(x[a:b]) for a, b in zip(starts, starts[1:])])

    count = rows["n"].to_numpy(float)
    above = np.concatenate([np.cumsum(count[a:b][::-1])[::-1] for a, b in zip(starts, starts[1:])])  # items at least as high

    def mass(at, reach):
        return (1 - damping) / n + damping / len(at) * sum(reach[a] for a in at)

    def step(reach):
        shared = sc.broadcast(reach)

        def part(batches):
            total = np.zeros(d)
            for b in batches:
                at = [b.column(c).to_numpy() for c in cells]
                total += np.bincount(np.concatenate(at), np.tile(mass(at, shared.value), len(at)), minlength=d)
            a = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(total[a])], names=["a", "m"])

        got = table.select(*cells).mapInArrow(part, "a long, m double").groupBy("a").agg(F.sum("m").alias("m")).toPandas()  # at most table_values rows
        out = np.zeros(d)
        out[got["a"].to_numpy()] = got["m"].to_numpy()
        return prefix(out / above)

    reach = prefix(count / n / above)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(max_rounds):
        new = step(reach)
        off = new - reach
        if float(np.abs(off).max()) * n <= tolerance:
            break
        past = [*past[-7:], (reach, off)]
        reach = _extrapolated(past)
    else:
        raise RuntimeError("the rank walk did not converge")
    shared = sc.broadcast(new)

    def score(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array(mass([b.column(c).to_numpy() for c in cells], shared.value))], names=["k", "stationarity"])

    return table.mapInArrow(score, f"k {kind}, stationarity double")


def _extrapolated(past: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The next point of the power iteration from the last points and what a step moved each: the combination of them that a step
    would move least (Anderson's mixing), as the steps are linear."""
    at, off = past[-1]
    if len(past) == 1:
        return at + off
    move = np.stack([b[0] - a[0] for a, b in zip(past, past[1:])], axis=1)
    change = np.stack([b[1] - a[1] for a, b in zip(past, past[1:])], axis=1)
    part = np.linalg.lstsq(change, off, rcond=None)[0]
    return at + off - (move + change) @ part


def _walk_by_partitions(full: DataFrame, values: DataFrame, names: list[str], n: int, damping: float, tolerance: float, max_rounds: int, box: Scratch) -> DataFrame:
    spark = full.sparkSession
    order = Window.partitionBy("i", "part").orderBy("v")  # a stretch of one range partition

    def summed(rows: DataFrame, what: str, down: bool = False) -> DataFrame:
        """rows (i, part, v, what) with sum: of what over all values of i up to v; with down, from v on."""
        by = order.rowsBetween(Window.unboundedPreceding, 0) if not down else Window.partitionBy("i", "part").orderBy(F.desc("v")).rowsBetween(Window.unboundedPreceding, 0)
        own = rows.withColumn("own", F.sum(what).over(by))
        totals = rows.groupBy("i", "part").agg(F.sum(what).alias("t")).collect()  # one row per partition and score
        offset, last, so_far = [], None, 0.0
        for r in sorted(totals, key=lambda r: (r["i"], -r["part"] if down else r["part"])):
            so_far = so_far if r["i"] == last else 0.0
            offset.append((r["i"], r["part"], float(so_far)))
            last, so_far = r["i"], so_far + r["t"]
        return own.join(F.broadcast(local_table(spark, offset, "i int, part int, before double")), ["i", "part"]).withColumn("sum", F.col("own") + F.col("before")).drop("own", "before")

    placed = box.save(values.repartitionByRange("i", "v").withColumn("part", F.spark_partition_id()), "placed")
    placed = box.save(summed(placed, "n", down=True).select("i", "part", "v", "n", F.col("sum").alias("above")), "above")
    items = box.save(full.withColumn("u", F.monotonically_increasing_id()), "items")
    each = F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(s).alias("v")) for i, s in enumerate(names)]))
    long = box.save(items.select("u", each).join(placed.select("i", "v", "part"), ["i", "v"]), "long")

    def step(mass: DataFrame) -> DataFrame:
        """(u, x) after a round of the walk."""
        at = long.join(mass, "u").groupBy("i", "part", "v").agg(F.sum("x").alias("m")).join(placed.select("i", "v", "above"), ["i", "v"])
        at = box.save(at.select("i", "part", "v", (F.col("m") / F.col("above")).alias("m")), "at")
        got = long.join(summed(at, "m").select("i", "v", "sum"), ["i", "v"]).groupBy("u").agg(F.sum("sum").alias("reach"))
        out = box.save(got.select("u", ((1 - damping) / n + damping / len(names) * F.col("reach")).alias("x")), "mass")
        box.drop(at)
        return out

    mass = box.save(items.select("u", F.lit(1.0 / n).alias("x")), "mass")
    for _ in range(max_rounds):
        new = step(mass)
        moved = new.join(mass.withColumnRenamed("x", "old"), "u").agg(F.max(F.abs(F.col("x") - F.col("old")))).first()[0] * n
        box.drop(mass)
        mass = new
        if moved <= tolerance:
            break
    else:
        raise RuntimeError("the rank walk did not converge")
    return items.select("k", "u").join(mass, "u").select("k", F.col("x").alias("stationarity"))


def first_places(ranked: DataFrame, places: int, key: str) -> DataFrame:
    """The rows of the first places by stationarity; among equals at the last place those with the least keys.

    places may grow with the input, so the rows are not sorted into one task: a quickselect finds the stationarity of the last
    place, all greater rows are in, and only the places that its ties still fill are sorted. 0 or fewer places give no rows.
    """
    if places <= 0:
        return ranked.limit(0)
    n = ranked.count()
    if places >= n:
        return ranked
    spark = ranked.sparkSession
    one = local_table(spark, [("all", (places - 0.5) / n)], "source string, keep_fraction double")
    cutoff = keep_fraction_cutoffs(ranked.select(F.lit("all").alias("source"), F.col("stationarity").alias("value")), one, source="source").first()["cutoff"]
    more = ranked.where(F.col("stationarity") > cutoff)
    ties = ranked.where(F.col("stationarity") == cutoff).orderBy(key).limit(places - more.count())
    return more.unionByName(ties)
