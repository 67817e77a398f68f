"""Problem 1: a score cutoff per source that keeps a target fraction of its records.

Distributed quickselect. Each round takes the median of every (partition, source) among the values still in play, makes the
weighted median of those medians the source's pivot, counts the values above and at the pivot, and discards the side without the
target rank. A source ends when its pivot holds the rank, or when so few values are left that one small sort ends it. A round is
one job over two columns; its state is one row per source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kolam.functions.names import norm_name
from kolam.scratch import Scratch


def keep_fraction_cutoffs(values: DataFrame, targets: DataFrame, source: str = "domain", value: str = "value", fraction: str = "keep_fraction", finish_at: int = 16, max_rounds: int = 500) -> DataFrame:
    """One row per source name of targets: source as spelled there, its fraction, n, wanted, cutoff, n_kept.

    The cutoff is the largest of the source's values that at least ceil(fraction * n) of its records reach, so ties at the cutoff
    are kept and n_kept may exceed wanted. Names are compared by norm_name; targets may spell one source in several ways, and each
    spelling then has its row. Records with a null source or a null or NaN value don't count. A source without records, or with a
    null fraction, has a null cutoff and keeps none. Fractions below 0 count as 0 and above 1 as 1; at 0 the cutoff is the greatest value.
    finish_at: a source with at most so many values in play is ended by a sort of those.
    """
    spark = values.sparkSession
    box = Scratch(spark, "cutoffs")
    v = values.select(norm_name(source).alias("s"), F.col(value).cast("double").alias("v")).where(F.col("s").isNotNull() & F.col("v").isNotNull() & ~F.isnan("v"))
    wanted = targets.select(F.col(source).alias("spelled"), F.col(fraction).cast("double").alias("fraction"), norm_name(source).alias("s")).distinct()
    asked = wanted.where(F.col("s").isNotNull()).withColumn("k_of", F.when(F.col("fraction").isNotNull() & ~F.isnan("fraction"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("fraction")))))
    base = live = box.save(v, "values")
    n = box.save(base.groupBy("s").agg(F.count(F.lit(1)).alias("n")), "sizes")
    goal = asked.join(n, "s", "left").withColumn("wanted", F.ceil(F.col("k_of") * F.col("n")))
    # One search per (source, rank): two spellings may ask for different fractions.
    state = box.save(
        goal.where(F.col("wanted").isNotNull()).select("s", F.greatest(F.col("wanted"), F.lit(1)).alias("rank"), "n").distinct()
        .select("s", "rank", F.col("rank").alias("k"), F.col("n").alias("left"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(None).cast("double").alias("cutoff")),
        "state",
    )
    base_rows = None
    for _ in range(max_rounds):
        open_ = state.where(F.col("cutoff").isNull())
        left = open_.agg(F.count(F.lit(1)).alias("n"), F.max("left").alias("most"), F.sum("left").alias("rows")).first()
        if not left["n"] or left["most"] <= finish_at:
            break
        base_rows = base_rows or left["rows"]
        if left["rows"] * 4 < base_rows:  # most rows are out of play: carry on with a table of the rest
            live, base_rows = box.save(_in_play(live, open_), "live"), left["rows"]
        playing = _in_play(live, open_)
        medians = playing.groupBy("s", "rank", F.spark_partition_id().alias("part")).agg(F.percentile_approx("v", F.lit(0.5), F.lit(200)).alias("m"), F.count(F.lit(1)).alias("w"))
        by = Window.partitionBy("s", "rank")
        pivots = (
            medians.withColumn("upto", F.sum("w").over(by.orderBy("m", "part").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("all", F.sum("w").over(by))
            .where(F.col("upto") * 2 >= F.col("all"))
            .groupBy("s", "rank").agg(F.min("m").alias("pivot"))
        )
        sides = playing.join(pivots, ["s", "rank"]).groupBy("s", "rank").agg(F.first("pivot").alias("pivot"), F.sum((F.col("v") > F.col("pivot")).cast("long")).alias("above"), F.sum((F.col("v") == F.col("pivot")).cast("long")).alias("at"))
        step = state.join(sides, ["s", "rank"], "left")
        up, here = F.col("k") <= F.col("above"), F.col("k") <= F.col("above") + F.col("at")
        state = box.save(
            step.select(
                "s", "rank",
                F.when(F.col("pivot").isNull() | up | here, F.col("k")).otherwise(F.col("k") - F.col("above") - F.col("at")).alias("k"),
                F.when(F.col("pivot").isNull(), F.col("left")).when(up, F.col("above")).when(here, F.col("at")).otherwise(F.col("left") - F.col("above") - F.col("at")).alias("left"),
                F.when(up, F.col("pivot")).otherwise(F.col("lo")).alias("lo"),
                F.when(F.col("pivot").isNotNull() & ~up & ~here, F.col("pivot")).otherwise(F.col("hi")).alias("hi"),
                F.when(F.col("pivot").isNotNull() & ~up & here, F.col("pivot")).otherwise(F.col("cutoff")).alias("cutoff"),
            ),
            "state",
        )
    else:
        raise RuntimeError("the search for a cutoff did not end")
    few = _in_play(live, state.where(F.col("cutoff").isNull()), extra=("k",))
    ended = few.withColumn("r", F.row_number().over(Window.partitionBy("s", "rank").orderBy(F.desc("v")))).where(F.col("r") == F.col("k")).select("s", "rank", F.col("v").alias("found"))
    cut = state.join(ended, ["s", "rank"], "left").select("s", "rank", F.coalesce("cutoff", "found").alias("cutoff"))
    kept = base.join(cut, "s").groupBy("s", "rank").agg(F.first("cutoff").alias("cutoff"), F.sum((F.col("v") >= F.col("cutoff")).cast("long")).alias("n_kept"))
    out = goal.withColumn("rank", F.when(F.col("wanted").isNotNull(), F.greatest(F.col("wanted"), F.lit(1)))).join(kept, ["s", "rank"], "left")
    cutoffs = box.save(out.select(F.col("spelled").alias(source), F.col("fraction").alias(fraction), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("wanted", F.lit(0)).alias("wanted"), "cutoff", F.coalesce("n_kept", F.lit(0)).alias("n_kept")), "cutoffs")
    box.keep_only(cutoffs)
    return cutoffs


def _in_play(live: DataFrame, open_: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(s, rank, v) of the values between the bounds of an open search; a live table that has ranks is matched by them too."""
    on = ["s", "rank"] if "rank" in live.columns else ["s"]
    inside = (F.col("lo").isNull() | (F.col("v") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("v") < F.col("hi")))
    return live.join(open_.select("s", "rank", "lo", "hi", *extra), on).where(inside).select("s", "rank", "v", *extra)
