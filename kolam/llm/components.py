"""Connected components by frontier breadth-first search from many seeds at once, and splits made of whole components (problem 5).

Each level takes as seeds all vertices that are smaller than every neighbour, expands them hop by hop over hash-partitioned
adjacency rows, and lets colliding seed labels form a smaller graph, on which the next level works. Adjacency is kept as rows, not
as lists: a vertex with a third of all edges is merged map-side where labels are grouped, and where they are joined its rows are split
by Spark's skew handling. A level leaves at most half of the labels that still
touch, so there are about log2(vertices) of them at most, fewer in practice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolam.scratch import Scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", hops: int = 2, box: Scratch | None = None) -> DataFrame:
    """(vertex, component) for every vertex of the edges; the component is its smallest vertex reached by the labels.

    Vertices are longs, best hashes, as then the seeds lie at random. Edges with a null end tie nothing; loops make a vertex known;
    repeated edges don't matter. No edges give no rows.
    """
    own = box is None
    box = box or Scratch(edges.sparkSession, "components")
    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull()).distinct()
    first = box.save(e, "edges")
    vertices = first.select(F.col("a").alias("v")).union(first.select(F.col("b").alias("v"))).distinct()
    adjacency = box.save(_both_ways(first), "adjacency")
    levels: list[DataFrame] = []
    while not adjacency.isEmpty():
        labels = _level(adjacency, hops, box)
        levels.append(labels)
        ends = adjacency.where(F.col("u") < F.col("v"))
        lifted = ends.join(labels.select(F.col("v").alias("u"), F.col("label").alias("a")), "u").join(labels.select("v", F.col("label").alias("b")), "v").where(F.col("a") != F.col("b")).select("a", "b")
        lower = box.save(_both_ways(lifted.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()), "adjacency")
        box.drop(adjacency)
        adjacency = lower
    top = levels[-1] if levels else vertices.withColumn("label", F.col("v"))
    for lower in reversed(levels[:-1]):
        up = top.select(F.col("v").alias("label"), F.col("label").alias("higher"))
        top = lower.join(up, "label", "left").select("v", F.coalesce("higher", "label").alias("label"))
    out = box.save(vertices.join(top, "v", "left").select(F.col("v").alias("vertex"), F.coalesce("label", "v").alias("component")), "components")
    if own:
        box.keep_only(out)
    return out


def _both_ways(e: DataFrame) -> DataFrame:
    e = e.where(F.col("a") != F.col("b"))
    return e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct()


def _level(adjacency: DataFrame, hops: int, box: Scratch) -> DataFrame:
    """(v, label): seeds keep their own id, the others take the least label that reaches them within the hops, else their own."""
    least = adjacency.groupBy("v").agg(F.min("u").alias("least"))
    # The first hop needs no join: v's least neighbour labels it if that neighbour is a seed.
    labels = least.select("v", F.when(F.col("v") < F.col("least"), F.col("v")).alias("label"))
    labels = box.save(labels, "seeds")
    for _ in range(hops):
        frontier = labels.where(F.col("label").isNotNull()).select(F.col("v").alias("u"), "label")
        reached = adjacency.join(frontier, "u").groupBy("v").agg(F.min("label").alias("reached"))
        grown = box.save(labels.join(reached, "v", "left").select("v", F.coalesce("label", "reached").alias("label")), "frontier")
        box.drop(labels)
        labels = grown
    return box.save(labels.select("v", F.coalesce("label", "v").alias("label")), "labels")


def split_whole_components(rows: DataFrame, targets: DataFrame, component: str = "component", seed: int = 0, bins: int = 1 << 16) -> DataFrame:
    """rows with a column split: all rows of a component in one split, sizes near the target shares.

    targets: (split_name, target_share). Components are laid out by the hash of their id, and the splits take consecutive stretches
    of that order. A component of more than half the smallest share is placed first, the largest first, each into the split that
    still misses most rows; there can only be about two such components for each smallest share, whatever the input's size. Rows
    with a null component are one component each, by a hash of all their columns. Equal inputs give equal splits.
    """
    spark = rows.sparkSession
    shares = [(r[0], max(0.0, r[1] or 0.0)) for r in targets.select("split_name", F.col("target_share").cast("double")).where(F.col("split_name").isNotNull()).orderBy(F.desc("target_share"), "split_name").collect()]
    if not shares or sum(s for _, s in shares) <= 0:
        raise ValueError("targets name no split with a share above 0")
    total_share = sum(s for _, s in shares)
    own = F.xxhash64(*[F.col(c).cast("string") for c in sorted(rows.columns)])
    keyed = rows.withColumn("_c", F.coalesce(F.col(component).cast("long"), own)).withColumn("_bin", F.pmod(F.xxhash64("_c", F.lit(seed)), F.lit(bins)))
    sizes = keyed.groupBy("_c", "_bin").agg(F.count(F.lit(1)).alias("n"))
    box = Scratch(spark, "splits")
    sizes = box.save(sizes, "sizes")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    goal = {name: total * share / total_share for name, share in shares}
    large_from = max(1.0, min(s for _, s in shares if s > 0) / total_share / 2 * total)
    large = sizes.where(F.col("n") > large_from).orderBy(F.desc("n"), "_c").collect()  # at most total / large_from rows
    placed, got = {}, dict.fromkeys(goal, 0)
    for r in large:
        name = max(goal, key=lambda s: goal[s] - got[s])
        placed[r["_c"]] = name
        got[name] += r["n"]
    by_bin = sizes.where(F.col("n") <= large_from).groupBy("_bin").agg(F.sum("n").alias("n")).orderBy("_bin").collect()  # at most bins rows
    order, cuts, k = [name for name, _ in shares], [], 0
    rest = {s: max(0.0, goal[s] - got[s]) for s in order}
    scale = sum(r["n"] for r in by_bin) / max(1e-9, sum(rest.values()))
    taken = 0.0
    for r in by_bin:
        while k + 1 < len(order) and taken + r["n"] / 2 > rest[order[k]] * scale:
            taken -= rest[order[k]] * scale
            cuts.append(r["_bin"])
            k += 1
        taken += r["n"]
    cuts += [bins] * (len(order) - 1 - len(cuts))
    pick = F.lit(order[-1])
    for name, upto in reversed(list(zip(order, cuts))):
        pick = F.when(F.col("_bin") < upto, F.lit(name)).otherwise(pick)
    for name in order:
        mine = [c for c, s in placed.items() if s == name]
        if mine:
            pick = F.when(F.col("_c").isin(mine), F.lit(name)).otherwise(pick)
    return keyed.withColumn("split", pick).drop("_c", "_bin")
