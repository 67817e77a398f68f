"""Keyed operators: last or first of a key, upserts, numbering, chunking, ordered merges, joins that keep what has no partner.

Order is always a column (or several); Spark tables have none of their own. One row per key is picked by an aggregation with a
map-side part, so a key with a large share of the rows needs no large sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kolam.scratch import Scratch, local_table


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _pick(df: DataFrame, key, order, how) -> DataFrame:
    key, order = _list(key), _list(order)
    rest = [c for c in df.columns if c not in key]
    row = F.struct(F.struct(*order).alias("o"), F.struct(*rest).alias("r"))
    return df.groupBy(*key).agg(how(row).alias("_m")).select(*key, "_m.r.*").select(*df.columns)


def last_wins(df: DataFrame, key, order) -> DataFrame:
    """The row of each key that is last by order; among equals, of the greatest values. Null keys are one key."""
    return _pick(df, key, order, F.max)


def first_wins(df: DataFrame, key, order) -> DataFrame:
    """The row of each key that is first by order; among equals, of the least values. Null keys are one key."""
    return _pick(df, key, order, F.min)


def upsert_if_absent(state: DataFrame, new: DataFrame, key, order=None) -> DataFrame:
    """state and those rows of new whose key it doesn't have; of several, the first by order, or any one if there's no order."""
    key = _list(key)
    fresh = new.join(state.select(*key), key, "left_anti")
    fresh = first_wins(fresh, key, order) if order else fresh.dropDuplicates(key)
    return state.unionByName(fresh, allowMissingColumns=True)


def missing_from(asked: DataFrame, got: DataFrame, key) -> DataFrame:
    """The rows asked for whose key has no answer."""
    return asked.join(got.select(*_list(key)).distinct(), _list(key), "left_anti")


def missing_keys(asked: DataFrame, got: DataFrame, key) -> DataFrame:
    """The distinct keys asked for that have no answer, as a set difference: a null key is a key."""
    return asked.select(*_list(key)).subtract(got.select(*_list(key)))


def answered_or_failed(asked: DataFrame, answers: DataFrame, key, order, reason: str = "no answer for this record") -> DataFrame:
    """Each row asked for with its last answer; status OK, or FAILED with the reason. Answers nobody asked for are ignored."""
    key = _list(key)
    own = last_wins(answers, key, order).drop(*_list(order)).withColumn("_got", F.lit(True))
    out = asked.join(own, key, "left")
    return out.withColumns({"status": F.when(F.col("_got"), "OK").otherwise("FAILED"), "reason": F.when(F.col("_got").isNull(), F.lit(reason))}).drop("_got")


def matched(answers: DataFrame, asked: DataFrame, key, order) -> DataFrame:
    """Answers whose key was asked for, once per key (the last): an answer given twice doesn't count twice."""
    return last_wins(answers, key, order).join(asked, _list(key))


def global_positions(df: DataFrame, order, column: str = "pos", box: Scratch | None = None) -> DataFrame:
    """df with its position from 0 in the order, over the whole table, without bringing it into one partition.

    The rows are range-sorted and saved; each partition then counts from the number of rows before it. Only one count per partition
    goes to the driver and back, as a table of one row per partition.
    """
    spark = df.sparkSession
    box = box or Scratch(spark, "positions")
    sorted_ = box.save(df.repartitionByRange(*[F.col(c) for c in _list(order)]).sortWithinPartitions(*_list(order)).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "sorted")
    before, base = 0, []
    for r in sorted_.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect():
        base.append((r["_part"], before))
        before += r["n"]
    offset = local_table(spark, base, "_part int, _off long")
    return sorted_.join(F.broadcast(offset), "_part").withColumn(column, F.col("_at") + F.col("_off")).drop("_part", "_at", "_off")


def chunks(df: DataFrame, order, size: int, per_job: int | None = None, box: Scratch | None = None) -> DataFrame:
    """df with pos, chunk_id, pos_in_chunk and, with per_job, job_id: consecutive chunks of size rows, jobs of per_job chunks."""
    if size < 1 or (per_job is not None and per_job < 1):
        raise ValueError("chunks and jobs hold at least one")
    out = global_positions(df, order, box=box).withColumns({"chunk_id": F.expr(f"pos div {size}"), "pos_in_chunk": F.col("pos") % size})
    return out.withColumn("job_id", F.expr(f"chunk_id div {per_job}")) if per_job else out


def positions_in_key(df: DataFrame, key: str, order, column: str = "n", box: Scratch | None = None) -> DataFrame:
    """df with each row's position from 1 within its key. Keys are range-sorted with the rows, so one key may span partitions."""
    at = global_positions(df, [key, *_list(order)], "_pos", box)
    first = at.groupBy(key).agg(F.min("_pos").alias("_first")).withColumnRenamed(key, "_key")
    return at.join(first, at[key].eqNullSafe(F.col("_key"))).withColumn(column, F.col("_pos") - F.col("_first") + 1).drop("_pos", "_first", "_key")


def renumber(df: DataFrame, key: str, order, base: Column | None = None, column: str = "sentence_id") -> DataFrame:
    """df with ids "key_number", numbered in order within the key from base + 1 (0 without base)."""
    out = positions_in_key(df, key, order, "_n")
    n = F.col("_n") + (F.lit(0) if base is None else F.coalesce(base, F.lit(0)))
    return out.withColumn(column, F.concat_ws("_", F.col(key).cast("string"), n.cast("string"))).drop("_n")


def merge_candidates(log: DataFrame, key: str, order: str, items: str, keep: list[str]) -> DataFrame:
    """(key, keep..., pos, item): the items of a key's arrays, one after another in the log's order, numbered from 0; the columns to
    keep from the key's first log row. One row per item, so that no key becomes one large row. order is unique in a key."""
    first = first_wins(log.select(key, order, *keep), key, order).drop(order)
    each = log.select(key, order, F.posexplode(items).alias("_at", "item"))
    placed = positions_in_key(each, key, [order, "_at"], "_n")
    return placed.join(first, key).select(key, *keep, (F.col("_n") - 1).alias("pos"), "item")
