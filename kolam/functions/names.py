"""Names and current rows: how two spellings or two deliveries are told to be the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_name(c) -> Column:
    """A name without outer blanks and tabs, with single spaces, in lower case."""
    return F.lower(F.trim(F.regexp_replace(as_col(c), r"[ \t]+", " ")))


def present_name(c) -> Column:
    """norm_name, or null where the name is missing: null, blank or the token nan."""
    n = norm_name(c)
    return F.when((n != "") & (n != "nan"), n)


def has_text(c) -> Column:
    """True where a text is neither null nor only white space."""
    return F.coalesce(as_col(c).rlike(r"(?U)[^\s​﻿⁠\p{Z}]"), F.lit(False))


def usable_similarity(c) -> Column:
    """The number if it lies from 0 to 1, else null (null, NaN, infinite or out of range)."""
    c = as_col(c).cast("double")
    return F.when((~F.isnan(c)) & (c >= 0) & (c <= 1), c)


def current_rows(df: DataFrame, columns: list, key: str = "sentence_id") -> DataFrame:
    """The current row of each key: greatest updated_at, then greatest loaded_at, then greatest values, so that ties have one result.

    columns are the columns (or Columns with an alias) that are wanted. Rows without a key are no deliveries of anything and give
    nothing. It is one aggregation with a map-side part, so a key with any share of the rows is merged before the shuffle.
    """
    wanted = [as_col(c) for c in columns]
    packed = df.where(F.col(key).isNotNull()).select(F.col(key), F.struct("updated_at", "loaded_at", F.struct(*wanted).alias("row")).alias("d"))
    return packed.groupBy(key).agg(F.max("d").alias("d")).select(key, "d.row.*")
