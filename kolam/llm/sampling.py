"""Problem 3: a sample whose category shares follow targets, by calibration and the pivotal method.

Each target's wished number is set by its share, kept between its floor and what there is, and made whole. Inclusion probabilities
are then calibrated: Newton iterations on the dual of exponential tilting find the factor of each category at which the sum of
min(1, base weight x factor) over its records is that number. The moments of an iteration are one distributed aggregation. The
pivotal method draws the sample: records of a category duel, block by block in parallel, until all but one of a block are in or
out; what is left of the blocks duels in the next round. The sample has exactly the wished number of each category.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolam.functions.names import present_name
from kolam.scratch import Scratch, local_table


def whole_numbers(share: np.ndarray, floor: np.ndarray, there: np.ndarray, total: int) -> np.ndarray:
    """Whole numbers near total x share, between min(floor, there) and there, that sum to the total where that is possible.

    If there are too few records all are taken. If the floors alone exceed the total they are cut in proportion.
    """
    least, most = np.minimum(floor, there).astype(float), there.astype(float)
    if least.sum() > total:
        least = least * total / least.sum()
        most = np.ceil(least)
    total = int(min(total, there.sum()))

    def at(level: float) -> np.ndarray:
        return np.clip(level * share * total, least, most)

    lo, hi = 0.0, 1.0
    while at(hi).sum() < total and hi < 1e12:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if at(mid).sum() < total else (lo, mid)
    want = at(hi)
    out = np.floor(want + 1e-9)
    for i in sorted(range(len(want)), key=lambda i: (out[i] - want[i], i))[: max(0, int(total - out.sum()))]:
        if out[i] < there[i]:
            out[i] += 1
    return out.astype(int)


def calibrate(records: DataFrame, wished: np.ndarray, max_rounds: int = 60) -> np.ndarray:
    """The logarithms of the categories' factors. records: (cell int, weight double) rows, each one record or, with a column n, n.

    A category whose wished number is all it has gets infinity, one with none wished minus infinity.
    """
    spark = records.sparkSession
    moments = records.groupBy("cell", "weight").agg(F.sum("n").alias("n")) if "n" in records.columns else records.groupBy("cell", "weight").agg(F.count(F.lit(1)).alias("n"))
    moments = Scratch(spark, "moments").save(moments, "moments")
    have, base = np.zeros(len(wished)), np.ones(len(wished))
    for r in moments.groupBy("cell").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("weight")).alias("w")).collect():  # one row per target
        have[r["cell"]], base[r["cell"]] = r["n"], max(r["w"], 1e-300)
    log_factor = np.where(wished <= 0, -np.inf, np.where(wished >= have, np.inf, np.log(np.maximum(wished, 1e-300) / base)))
    free = np.isfinite(log_factor)
    for _ in range(max_rounds):
        if not free.any():
            break
        factors = local_table(spark, [(int(i), float(math.exp(log_factor[i]))) for i in np.flatnonzero(free)], "cell int, factor double")
        p = F.col("weight") * F.col("factor")
        got = moments.join(factors, "cell").groupBy("cell").agg(F.sum(F.least(p, F.lit(1.0)) * F.col("n")).alias("sum"), F.sum(F.when(p < 1, p).otherwise(0.0) * F.col("n")).alias("slope")).collect()
        worst = 0.0
        for r in got:
            i, off = r["cell"], wished[r["cell"]] - r["sum"]
            worst = max(worst, abs(off) / max(1.0, wished[i]))
            log_factor[i] += float(np.clip(off / r["slope"], -1, 1)) if r["slope"] > 0 else math.copysign(1, off)
        if worst < 1e-9:
            break
    return log_factor


def pivotal(p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The probabilities after duels in order: each 0 or 1 but at most one, at the end of the chain; their sum is unchanged."""
    p = p.astype(float).copy()
    between = (p > 1e-9) & (p < 1 - 1e-9)
    p[~between] = np.round(p[~between])
    open_ = np.flatnonzero(between)
    if not len(open_):
        return p
    luck = rng.random(len(open_))
    keep = open_[0]
    for j, u in zip(open_[1:], luck):
        a, b = p[keep], p[j]
        s = a + b
        if s < 1 - 1e-12:
            keep, out = (keep, j) if u * s < a else (j, keep)
            p[keep], p[out] = s, 0.0
        else:
            win, keep = (keep, j) if u * (2 - s) < 1 - b else (j, keep)
            p[win], p[keep] = 1.0, s - 1
            if p[keep] <= 1e-9 or p[keep] >= 1 - 1e-9:
                p[keep] = round(p[keep])
    if not 1e-9 < p[keep] < 1 - 1e-9:
        p[keep] = round(p[keep])
    return p


def target_report(records: DataFrame, targets: DataFrame, size: int) -> DataFrame:
    """A row for each distinct row of targets: its columns as spelled, available, needed, wished, met.

    needed is the greater of min_rows and ceil(target_share * size); met is whether so many records are available. wished is what the
    sample takes. Two rows of targets of one name see the same records; the sample gives them to the one that sorts first.
    records: (domain, category), any spelling; missing ones belong to no target.
    """
    names = {c: present_name(c) for c in ("domain", "category")}
    t = targets.select("domain", "category", F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)).alias("target_share"), F.coalesce(F.col("min_rows").cast("long"), F.lit(0)).alias("min_rows")).distinct()
    t = t.withColumns({"_d": names["domain"], "_c": names["category"]})
    per = records.select(names["domain"].alias("_d"), names["category"].alias("_c")).where(F.col("_d").isNotNull() & F.col("_c").isNotNull()).groupBy("_d", "_c").agg(F.count(F.lit(1)).alias("available"))
    rows = t.join(per, ["_d", "_c"], "left").withColumn("available", F.coalesce("available", F.lit(0))).toPandas()  # one row per target
    rows = rows.sort_values(["_d", "_c", "domain", "category"]).reset_index(drop=True)
    rows["needed"] = np.maximum(rows["min_rows"], [math.ceil(s * size) for s in rows["target_share"]])
    rows["met"] = rows["available"] >= rows["needed"]
    own = ~rows.duplicated(["_d", "_c"]) & rows["_d"].notna() & rows["_c"].notna()
    rows["wished"] = 0
    if own.any():
        o = rows[own]
        rows.loc[own, "wished"] = whole_numbers(o["target_share"].to_numpy(float), o["min_rows"].to_numpy(), o["available"].to_numpy(), size)
    rows = rows.astype({"needed": "int64", "wished": "int64", "available": "int64"})
    schema = "domain string, category string, target_share double, min_rows long, available long, needed long, wished long, met boolean, _d string, _c string"
    plain = rows[[c.split()[0] for c in schema.split(", ")]].astype(object)
    return local_table(records.sparkSession, list(plain.where(plain.notna(), None).itertuples(index=False, name=None)), schema)


def calibrated_gaps(records: DataFrame, report: DataFrame) -> DataFrame:
    """report with reached, the sum of inclusion probabilities when each row's records are calibrated to its needed number, and gap,
    what is missing then. Where there are too few records the tilting has no finite solution: all are in, and the gap is above 0."""
    spark = records.sparkSession
    rows = report.select("domain", "category", "target_share", "min_rows", "_d", "_c", "needed").orderBy("_d", "_c", "domain", "category", "target_share", "min_rows").collect()  # one row per target
    cells = local_table(spark, [(i, r["_d"], r["_c"]) for i, r in enumerate(rows)], "cell int, _d string, _c string")
    per = records.select(present_name("domain").alias("_d"), present_name("category").alias("_c")).groupBy("_d", "_c").agg(F.count(F.lit(1)).alias("n"))
    moments = Scratch(spark, "gaps").save(per.join(cells, ["_d", "_c"]).select("cell", F.lit(1.0).alias("weight"), "n"), "moments")
    logs = calibrate(moments, np.array([r["needed"] for r in rows], float))
    factors = [(i, float(min(1e300, math.exp(min(x, 690)))), *(r[c] for c in ("domain", "category", "target_share", "min_rows"))) for i, (x, r) in enumerate(zip(logs, rows))]
    table = local_table(spark, factors, "cell int, factor double, domain string, category string, target_share double, min_rows long")
    own = ["domain", "category", "target_share", "min_rows"]
    sums = table.join(moments, "cell", "left").groupBy(*own).agg(F.coalesce(F.sum(F.least(F.col("weight") * F.col("factor"), F.lit(1.0)) * F.col("n")), F.lit(0.0)).alias("reached"))
    x, y = report.alias("x"), sums.alias("y")
    on = F.lit(True)
    for c in own:
        on = on & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
    return x.join(y, on).select("x.*", "y.reached", (F.col("x.needed") - F.round("y.reached", 6)).alias("gap"))


def proportional_sample(records: DataFrame, report: DataFrame, key: str, weight: str | None = None, seed: int = 0, block: int = 20_000) -> DataFrame:
    """(key, domain, category) of the sampled records, names in their compared form; report is target_report's.

    Each category gives exactly its wished number. Records of one weight have equal chances; weight, above 0, tilts them. A null
    key is a key like any other; repeated keys are records of their own. Equal inputs and seed give equal samples.
    """
    spark = records.sparkSession
    box = Scratch(spark, "sample")
    wished = [(i, r["_d"], r["_c"], r["wished"]) for i, r in enumerate(report.where("wished > 0").orderBy("_d", "_c").collect())]
    if not wished:
        return local_table(spark, [], f"{key} {dict(records.dtypes)[key]}, domain string, category string")
    cells = local_table(spark, [(i, d, c) for i, d, c, _ in wished], "cell int, domain string, category string")
    kept = records.select(F.col(key).alias("k"), present_name("domain").alias("domain"), present_name("category").alias("category"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight")).join(cells, ["domain", "category"])
    kept = box.save(kept.select("k", "cell", "weight"), "records")
    logs = calibrate(kept, np.array([w for *_, w in wished], float))
    factors = local_table(spark, [(i, float(min(1e300, math.exp(min(x, 690))))) for i, x in enumerate(logs)], "cell int, factor double")
    kind = dict(kept.dtypes)["k"]
    per = kept.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    state = kept.join(factors, "cell").join(per, "cell").select("k", "cell", F.least(F.col("weight") * F.col("factor"), F.lit(1.0)).alias("p"), F.pmod(F.xxhash64("k", F.lit(seed)), "blocks").cast("int").alias("block"), "blocks")
    picked: list[DataFrame] = []

    def duel(key_, p):
        p = p.sort_values("h")
        rng = np.random.default_rng([seed, *map(int, key_)])
        after = pivotal(p["p"].to_numpy(), rng)
        if int(p["blocks"].iloc[0]) == 1:
            after = np.round(after)
        p = p.assign(p=after, k=p["k"].astype(object))
        return p.loc[p["p"] > 0, ["k", "cell", "p", "block", "blocks"]]

    for round_ in range(20):
        rolled = state.withColumn("h", F.xxhash64("k", F.lit(seed + 1), "cell")).groupBy("cell", "block").applyInPandas(duel, f"k {kind}, cell int, p double, block int, blocks int")
        rolled = box.save(rolled, "rolled")
        picked.append(rolled.where(F.col("p") == 1))
        state = rolled.where((F.col("p") < 1)).select("k", "cell", "p", F.expr(f"block div {block}").cast("int").alias("block"), F.ceil(F.col("blocks") / block).cast("int").alias("blocks"))
        if state.isEmpty():
            break
    out = picked[0]
    for p in picked[1:]:
        out = out.unionByName(p)
    return out.join(cells, "cell").select(F.col("k").alias(key), "domain", "category")
