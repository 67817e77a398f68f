"""Parquet tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kolam.scratch import ensure_importable


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ensure_importable(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
