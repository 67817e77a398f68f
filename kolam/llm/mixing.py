"""Problem 9: mixing sources to target weights, by capped water-filling.

Each source's share is clamped at what its size allows with at most max_copies repetitions; the excess is given to the free sources
in proportion, until no further source is clamped. A source's copies are whole ones and a fraction, which a seeded hash of the
records samples.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolam.functions.names import norm_name
from kolam.scratch import Scratch, local_table


def filling_rounds(sizes: np.ndarray, shares: np.ndarray, copies: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray]:
    """(the size each source contributes to a mixture of the total, the round from 1 in which it was clamped, else 0).

    A source gives its share, or its size x copies where that is not more, and then it is clamped; the excess is redistributed in
    proportion in the next round. If all sources together can't reach the total, all are clamped."""
    most = sizes * copies
    got, free = np.zeros(len(sizes)), shares > 0
    clamped = np.zeros(len(sizes), int)
    room, round_ = float(total), 0
    while free.any() and room > 0:
        round_ += 1
        want = room * shares / shares[free].sum()
        clamp = free & (want >= most)
        if not clamp.any():
            got[free] = want[free]
            break
        got[clamp], clamped[clamp] = most[clamp], round_
        room -= most[clamp].sum()
        free &= ~clamp
    return got, clamped


def water_filling(sizes: np.ndarray, shares: np.ndarray, copies: np.ndarray, total: float) -> np.ndarray:
    """The sizes of filling_rounds."""
    return filling_rounds(sizes, shares, copies, total)[0]


def mix_sources(records: DataFrame, targets: DataFrame, key: str, size: str, source: str = "source", total: float | None = None, seed: int = 0, bins: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(report, copies).

    report, a row for each row of targets: source as spelled there, target_share, max_copies, size of its records, reachable (size x
    max_copies >= target_share x total of all listed sources), clamped (the round of the water-filling that clamped it, 0 for none;
    in the first a source is held against its own target, later ones have others' excess too), planned and used size, actual_share.
    copies: (key, source, size, copies) of each record used, copies from 1 to max_copies.

    total defaults to the size of all records of the listed sources, each counted once. Names are compared by norm_name; if targets
    lists a source twice, the spelling that sorts first keeps the records and the others get none. Null or negative shares and copies
    count as 0. Records of other or null sources and of null or non-positive size take no part. The fraction of a source is taken by
    hash, to within one of `bins` parts of its size or one hash value, whichever is more, and never makes more than max_copies.
    """
    spark = records.sparkSession
    box = Scratch(spark, "mixing")
    rows = targets.select(source, F.greatest(F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("share"), F.greatest(F.coalesce(F.col("max_copies").cast("int"), F.lit(0)), F.lit(0)).alias("copies"), norm_name(source).alias("s")).orderBy("s", source).collect()
    names = list(dict.fromkeys(r["s"] for r in rows if r["s"] is not None))
    listed = local_table(spark, [(s,) for s in names], "s string")
    bin_ = F.pmod(F.xxhash64(F.col("k").cast("string"), F.lit(seed)), F.lit(bins))
    kept = records.select(F.col(key).alias("k"), norm_name(source).alias("s"), F.col(size).cast("long").alias("z")).where(F.col("z") > 0).join(listed, "s")
    kept = box.save(kept.withColumn("bin", bin_), "records")
    per_bin = kept.groupBy("s", "bin").agg(F.sum("z").alias("z")).toPandas().sort_values(["s", "bin"])  # at most sources x bins rows
    first = {r["s"]: r for r in reversed(rows)}
    sizes = per_bin.groupby("s")["z"].sum().to_dict()
    size_of = np.array([float(sizes.get(s, 0)) for s in names])
    shares = np.array([first[s]["share"] for s in names])
    copies = np.array([float(first[s]["copies"]) for s in names])
    whole = float(size_of.sum())
    planned, clamped = filling_rounds(size_of, shares, copies, whole if total is None else total)
    plan = []
    used: dict[str, float] = {}
    for s, z, p, c in zip(names, size_of, planned, copies):
        full = min(int(p // z), int(c)) if z else 0
        mine = per_bin[per_bin["s"] == s]
        upto = np.cumsum(mine["z"].to_numpy())
        want = p - full * z
        take = int(np.argmin(np.abs(np.concatenate([[0], upto]) - want))) if full < c and z else 0  # bins taken once more
        edge = int(mine["bin"].to_numpy()[take - 1]) + 1 if take else 0
        used[s] = full * z + (float(upto[take - 1]) if take else 0.0)
        plan.append((s, full, edge))
    all_used = sum(used.values())
    report = []
    for r in rows:
        own = r["s"] is not None and first[r["s"]] is r
        z = float(sizes.get(r["s"], 0))
        u = used.get(r["s"], 0.0) if own else 0.0
        report.append((r[source], r["share"], r["copies"], int(z), bool(z * r["copies"] >= r["share"] * whole), int(clamped[names.index(r["s"])]) if own else 0, float(planned[names.index(r["s"])]) if own else 0.0, int(u), float(u / all_used) if all_used else 0.0))
    report_df = local_table(spark, report, f"{source} string, target_share double, max_copies int, size long, reachable boolean, clamped int, planned double, used long, actual_share double")
    plan_df = local_table(spark, plan, "s string, full int, edge int")
    out = kept.join(plan_df, "s").withColumn("copies", F.col("full") + (F.col("bin") < F.col("edge")).cast("int")).where(F.col("copies") > 0)
    return report_df, out.select(F.col("k").alias(key), F.col("s").alias(source), F.col("z").alias("size"), "copies")
