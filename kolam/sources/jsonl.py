"""Line-delimited JSON."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kolam.functions.text import strip
from kolam.operators.keyed import global_positions
from kolam.scratch import local_table

SENTENCE = "row_id INT, sentence_id STRING, domain STRING, category STRING, word STRING, sentence STRING, context STRING, overall_score DOUBLE"


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The records of a file, a folder or a pattern of such; none where it is missing. Blank lines are skipped; a malformed line fails
    the read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where):
        return local_table(spark, [], schema)
    return spark.read.schema(T.StructType.fromDDL(schema)).option("mode", "FAILFAST").json(path)


def in_file_order(df: DataFrame, column: str = "ord") -> DataFrame:
    """df with its rows' positions in the files it was read from, one file after another by name; of other tables, as they are read."""
    try:
        at = df.select("*", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("_at"))
    except AnalysisException:
        at = df.select("*", F.monotonically_increasing_id().alias("_at"))
    return global_positions(at, "_at", column).drop("_at")


def translation_input(sentences: DataFrame) -> DataFrame:
    """Sentences as input of translation: trimmed and not blank, ids as text, "" for a missing domain, category or word. A column ord
    stays."""
    out = sentences.select(
        F.col("sentence_id").cast("string").alias("sentence_id"), F.col("row_id").cast("int").alias("row_id"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("domain", "category", "word")], strip("sentence").alias("english_sentence"), *(["ord"] if "ord" in sentences.columns else []),
    )
    return out.where(F.coalesce(F.length("english_sentence"), F.lit(0)) > 0)


def read_prompt(folder: str, role: str) -> str:
    """The system prompt of a role: the text of its file in the prompts folder."""
    with open(f"{folder.rstrip('/')}/{role}.txt", encoding="utf-8") as f:
        return f.read()


def read_env(path: str) -> dict[str, str]:
    """NAME=value lines of a file, with the process's own variables before them; comments, blank lines and quotes at the ends are
    dropped. A missing file has none. Keys stay on the driver and in workers that make clients, never in plans or tables."""
    import os

    out: dict[str, str] = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            for line in f:
                name, eq, value = line.strip().partition("=")
                if eq and not name.startswith("#"):
                    out[name.removeprefix("export ").strip()] = value.strip().strip("\"'")
    return out | {k: v for k, v in os.environ.items() if k in out and v}
