"""Exports and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kolam.functions.scores import TRANSLATION_THRESHOLDS

# The columns of the two exports, in order.
FINAL_SENTENCES = ("row_id", "sentence_id", "domain", "category", "word", "sentence", "context", "overall_score")
FINAL_TRANSLATIONS = (
    "sentence_id", "row_id", "domain", "category", "word", "source_language", "target_language", "english_sentence", "telugu_sentence",
    "telugu_romanized", "translation_provider", "translation_model", "judge_provider", "judge_model", *TRANSLATION_THRESHOLDS,
    "overall_score", "semantic_similarity", "status",
)


def final_sentences(words: DataFrame, accepted: DataFrame, order: str | None = None) -> DataFrame:
    """Every accepted sentence of every word, whatever the word's status, with the word's own columns; in the words' input order
    where order names a column of it, a word's sentences by the numbers of their ids."""
    kept = accepted.select(*[c for c in FINAL_SENTENCES if c not in ("domain", "category", "word")])
    both = words.select("row_id", "domain", "category", "word", *([order] if order else [])).join(kept, "row_id")
    if order:
        both = both.orderBy(order, F.length("sentence_id"), "sentence_id")
    return both.select(*FINAL_SENTENCES)


def final_translations(state: DataFrame, source_language: str = "en-IN", target_language: str = "te-IN", order: str | None = None) -> DataFrame:
    """The complete sentences with their seven scores flat, as accepted rows; a score or similarity that is no number is null. With
    order, a column of state, they come in that order."""
    number = lambda c: F.nanvl(c, F.lit(None).cast("double"))
    flat = state.where(F.col("status") == "complete").withColumns({d: number(F.col(f"scores.{d}")) for d in TRANSLATION_THRESHOLDS})
    flat = flat.withColumns({c: number(F.col(c)) for c in ("semantic_similarity", "overall_score")})
    flat = flat.orderBy(order) if order else flat
    flat = flat.withColumns({"source_language": F.lit(source_language), "target_language": F.lit(target_language), "status": F.lit("accepted")})
    return flat.select(*FINAL_TRANSLATIONS)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Adds part files of lines; non-ASCII stays, nulls are written."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_spreadsheet(df: DataFrame, path: str, max_rows: int = 1_000_000) -> None:
    """A .xlsx file; only for results that fit one, else a ValueError. Larger ones are for write_csv."""
    try:
        import openpyxl
    except ImportError as e:
        raise ImportError("writing spreadsheets needs openpyxl; write_csv needs nothing") from e
    if df.count() > max_rows:
        raise ValueError(f"more than {max_rows} rows don't fit a spreadsheet; use write_csv")
    book = openpyxl.Workbook(write_only=True)
    sheet = book.create_sheet()
    sheet.append(df.columns)
    for row in df.toLocalIterator():
        sheet.append(list(row))
    book.save(path)


def rejected_rows(*parts: DataFrame) -> DataFrame:
    """One table of rejected rows of all stages; a column that a stage lacks is null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
