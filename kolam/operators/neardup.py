"""Greedy near-duplicate removal by cosine, in order, within a key.

A row is kept if no earlier kept row of its key (history counts as earlier and kept) has a cosine of at least the threshold. A
rejected row rejects nobody. The rule is sequential, but keys are independent, and most are small: many are decided in one pass of a
task. In a large key only rows with a near neighbour depend on others: near pairs are found blockwise, as matrix products of at most
block x block rows in any task, and decided in rounds. Both give the sequential rule's result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolam.scratch import Scratch


def near_pairs(rows: DataFrame, key: str, order: str, vector: str, threshold: float, block: int = 2000) -> DataFrame:
    """(key, a, b), a before b in order, of the rows of one key with a cosine of at least the threshold.

    order must be unique in a key. A vector of no length is near to nothing (for thresholds above 0); null vectors take no part.
    """
    kind = dict(rows.dtypes)
    r = rows.select(F.col(key).alias("k"), F.col(order).alias("o"), F.col(vector).alias("v")).where(F.col("k").isNotNull() & F.col("v").isNotNull())
    blocks = r.groupBy("k").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n"))
    placed = r.join(blocks, "k").withColumn("at", F.pmod(F.xxhash64("o"), "n").cast("int"))
    sides = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select("k", "o", "v", "at", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"))

    def find(p: pd.DataFrame) -> pd.DataFrame:
        def units(q):
            m = np.array(q["v"].tolist(), dtype=np.float64).reshape(len(q), -1)
            n = np.sqrt((m * m).sum(axis=1, keepdims=True))
            return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

        i, j = p["i"].iloc[0], p["j"].iloc[0]
        x = p[p["at"] == i]
        y = x if i == j else p[p["at"] == j]
        if not len(x) or not len(y):
            return pd.DataFrame({"k": [], "a": [], "b": []})
        s, t = np.nonzero(units(x) @ units(y).T >= threshold - 1e-12)
        a, b = x["o"].to_numpy()[s], y["o"].to_numpy()[t]
        keep = a < b if i == j else np.ones(len(a), bool)
        lo, hi = np.where(a < b, a, b)[keep], np.where(a < b, b, a)[keep]
        return pd.DataFrame({"k": pd.Series([p["k"].iloc[0]] * len(lo), dtype=object), "a": lo, "b": hi})

    return sides.groupBy("k", "i", "j").applyInPandas(find, f"k {kind[key]}, a {kind[order]}, b {kind[order]}").withColumnRenamed("k", key)


def greedy_near_duplicates(rows: DataFrame, key: str, order: str, vector: str, threshold: float, history: str | None = None, small: int = 2000, rounds: int = 8) -> DataFrame:
    """rows with kept BOOLEAN. history names a BOOLEAN column: such rows are kept always and come before all others of their key.

    Rows with a null key or vector are kept. order must be unique in a key. Keys of at most `small` rows are decided in one pass, many
    to a task; of larger ones near pairs are found blockwise, decided in parallel rounds, and what long chains leave open after
    `rounds` of them by one pass over their links in order.
    """
    box = Scratch(rows.sparkSession, "greedy")
    past = F.coalesce(F.col(history), F.lit(False)) if history else F.lit(False)
    kind = dict(rows.dtypes)
    plain = rows.select(F.col(key).alias("k"), F.col(order).alias("o"), past.alias("past"), F.col(vector).cast("array<double>").alias("v")).where(F.col("k").isNotNull() & F.col("v").isNotNull())
    plain = box.save(plain, "rows")
    large = box.save(plain.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > small).select("k"), "large")
    some = not large.isEmpty()
    few = plain.join(large, "k", "left_anti") if some else plain
    schema = f"k {kind[key]}, o {kind[order]}"
    out = few.repartition("k").sortWithinPartitions("k", F.desc("past"), "o").mapInArrow(lambda batches: _decided(batches, threshold), schema)
    if some:
        out = out.unionByName(_decided_by_links(plain.join(large, "k", "left_semi"), threshold, rounds, schema, box))
    out = box.save(out, "rejected")
    box.keep_only(out)
    bad = out.select(F.col("k").alias("_k"), F.col("o").alias("_r"), F.lit(True).alias("_bad"))
    return rows.join(bad, (F.col(key) == F.col("_k")) & (F.col(order) == F.col("_r")), "left").withColumn("kept", F.col("_bad").isNull()).drop("_k", "_r", "_bad")


def _decided(batches, threshold: float):
    """The rejected (k, o) of rows sorted by key, history and order; holds no more than a batch and one key."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def rejected(b):
        """Of whole keys."""
        k, n = b.column("k"), b.num_rows
        if not n:
            return
        starts = np.concatenate([[0], np.flatnonzero(pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)) + 1, [n]])
        past = b.column("past").to_numpy(zero_copy_only=False)
        v = b.column("v")
        x = v.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
        bad = np.zeros(n, bool)
        for a, e in zip(starts, starts[1:]):
            if e - a < 2:
                continue
            near = np.tril(x[a:e] @ x[a:e].T >= threshold - 1e-12, -1)
            for i in np.flatnonzero(near.any(axis=1)):
                bad[a + i] = not past[a + i] and bool((near[i] & ~bad[a:e]).any())
        if bad.any():
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(bad)) for c in (k, b.column("o"))], names=["k", "o"])

    held = None
    for b in batches:
        if held is not None and held.num_rows:
            b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        if not b.num_rows:
            continue
        k = b.column("k")
        same = pc.equal(k, k[-1]).to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0  # the last key may go on in the next batch
        yield from rejected(b.slice(0, last))
        held = b.slice(last)
    if held is not None:
        yield from rejected(held)


def _decided_by_links(plain: DataFrame, threshold: float, rounds: int, schema: str, box: Scratch) -> DataFrame:
    """The rejected (k, o) by near pairs: rounds that decide every row without an undecided earlier neighbour, then a pass in order."""
    pairs = near_pairs(plain, "k", "o", "v", threshold)
    p = plain.select("k", "o", "past")
    named = pairs.join(p.select("k", F.col("o").alias("a"), F.col("past").alias("pa")), ["k", "a"]).join(p.select("k", F.col("o").alias("b"), F.col("past").alias("pb")), ["k", "b"]).where(~(F.col("pa") & F.col("pb")))
    # (k, early, late): late may be rejected by early
    edges = named.select("k", F.when(F.col("pb"), F.col("b")).otherwise(F.col("a")).alias("early"), F.when(F.col("pb"), F.col("a")).otherwise(F.col("b")).alias("late"), (F.col("pa") | F.col("pb")).alias("sure"))
    edges = box.save(edges, "edges")
    out = box.save(edges.where("sure").select("k", F.col("late").alias("o")).distinct(), "rejected")
    open_ = box.save(edges.where("not sure").join(out.withColumnRenamed("o", "late"), ["k", "late"], "left_anti").join(out.withColumnRenamed("o", "early"), ["k", "early"], "left_anti").select("k", "early", "late"), "open")
    for _ in range(rounds):
        if open_.isEmpty():
            return out
        # early rows that no open edge could still reject are kept, so their late partners are rejected
        kept = open_.select("k", "early").distinct().join(open_.select("k", F.col("late").alias("early")).distinct(), ["k", "early"], "left_anti")
        gone = box.save(open_.join(kept, ["k", "early"]).select("k", F.col("late").alias("o")).distinct(), "gone")
        grown = box.save(out.unionByName(gone).distinct(), "rejected")
        left = box.save(open_.join(gone.withColumnRenamed("o", "late"), ["k", "late"], "left_anti").join(gone.withColumnRenamed("o", "early"), ["k", "early"], "left_anti"), "open")
        box.drop(out, open_, gone)
        out, open_ = grown, left

    def in_order(batches):
        """Links sorted by key and late row: an early row is decided when its late ones come."""
        import pyarrow as pa

        key, gone = None, set()
        for b in batches:
            bad = []
            for k, late, early in zip(*(b.column(c).to_pylist() for c in ("k", "late", "early"))):
                if k != key:
                    key, gone = k, set()
                if early not in gone and late not in gone:
                    gone.add(late)
                    bad.append((k, late))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in bad], b.schema.field(c).type) for i, c in enumerate(("k", "late"))], names=["k", "o"])

    return out.unionByName(open_.repartition("k").sortWithinPartitions("k", "late").select("k", "late", "early").mapInArrow(in_order, schema))
