"""The vocabulary: CSV or spreadsheet rows with domain, category, word and, at times, row_id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kolam.functions.text import strip
from kolam.scratch import local_table
from kolam.sources.jsonl import in_file_order

REQUIRED = ("domain", "category", "word")
# Tokens that a spreadsheet reader takes for missing.
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_words(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """(row_id, domain, category, word) of a .csv, .xlsx or .xls file, with ordered also ord, the row's place in it; any other
    extension is a ValueError."""
    kind = path.lower().rsplit(".", 1)[-1]
    if kind == "csv":
        raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    elif kind in ("xlsx", "xls"):
        raw = _spreadsheet(spark, path)
    else:
        raise ValueError(f"the vocabulary must be a .csv, .xlsx or .xls file: {path}")
    return clean_words(in_file_order(raw, "_ord") if ordered else raw)


def _spreadsheet(spark: SparkSession, path: str) -> DataFrame:
    try:
        import openpyxl
    except ImportError as e:
        raise ImportError("reading spreadsheets needs openpyxl") from e
    rows = list(openpyxl.load_workbook(path, read_only=True, data_only=True).active.iter_rows(values_only=True))  # a sheet has at most 1,048,576
    names = [str(c) for c in rows[0]] if rows else []
    return local_table(spark, [tuple(None if v is None else str(v) for v in r) for r in rows[1:]], ", ".join(f"`{n}` string" for n in names))


def clean_words(raw: DataFrame) -> DataFrame:
    """Words of a table of strings: headers in any case and with blanks; row_id from the file, or numbered from 1 before rows without
    a word are dropped. A missing domain or category becomes "nan". Missing is blank or one of MISSING_TOKENS."""
    named = raw.toDF(*[c.strip().lower() for c in raw.columns])
    lacking = [c for c in REQUIRED if c not in named.columns]
    if lacking:
        raise ValueError(f"the vocabulary lacks the columns {lacking}")
    if "row_id" not in named.columns:
        named = (named if "_ord" in named.columns else in_file_order(named, "_ord")).withColumn("row_id", F.col("_ord") + 1)
    value = lambda c: F.when(~F.col(c).isin(*MISSING_TOKENS), strip(c))
    out = named.select(F.col("row_id").cast("int").alias("row_id"), F.coalesce(value("domain"), F.lit("nan")).alias("domain"), F.coalesce(value("category"), F.lit("nan")).alias("category"), value("word").alias("word"), *([F.col("_ord").alias("ord")] if "_ord" in raw.columns else []))
    return out.where((F.coalesce("word", F.lit("")) != "") & (F.lower("word") != "nan"))


WORD = "row_id INT, domain STRING, category STRING, word STRING"
