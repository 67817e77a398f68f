"""An optional stream over the append-only raw log: each micro-batch of new records goes through the batch gates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kolam.functions.text import strip
from kolam.operators.validation import has_sentences, split_by_reason, structural_reason

RAW = "row_id INT, word STRING, sentences ARRAY<STRUCT<sentence: STRING, context: STRING>>"


def gate_new_records(spark: SparkSession, log: str, checkpoint: str, sink: Callable[[DataFrame, DataFrame, int], None]):
    """A query that calls sink(passed, rejected, batch) for the sentences of each new part of the log; run it with processAllAvailable
    or awaitTermination. Restarted on the same checkpoint it goes on after the last finished batch."""

    def batch(df: DataFrame, number: int) -> None:
        each = df.where(has_sentences()).select("row_id", "word", F.posexplode("sentences").alias("pos", "s")).select("row_id", "word", "pos", strip("s.sentence").alias("sentence"))
        sink(*split_by_reason(each, structural_reason("sentence", "word"), "structural_validation"), number)

    return spark.readStream.schema(RAW).json(log).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).start()
