"""Gates on sentences and translations: the first failing rule of each row, or null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kolam.config import Rules
from kolam.functions.names import as_col
from kolam.functions.text import contains_word, length_ratio, longest_latin_run, numbers_lost, script_letter_ratio, strip


def structural_reason(sentence, word) -> Column:
    """empty_sentence, target_word_missing or null."""
    return F.when(F.coalesce(F.length(strip(sentence)), F.lit(0)) == 0, "empty_sentence").when(~contains_word(sentence, word), "target_word_missing")


def rule_reason(source, target, rules: Rules = Rules()) -> Column:
    """The first rule a translation breaks, in this order: empty_translation, script_ratio, latin_run, too_short, too_long,
    numbers_lost; null if none. Length rules are skipped for a blank source. Limits are inclusive on the passing side."""
    source, target = as_col(source), as_col(target)
    ratio = length_ratio(source, target)
    reason = (
        F.when(F.coalesce(F.length(strip(target)), F.lit(0)) == 0, "empty_translation")
        .when(script_letter_ratio(target, rules.script_low, rules.script_high) < rules.min_script_ratio, "script_ratio")
        .when(longest_latin_run(target) > rules.max_latin_run, "latin_run")
        .when(ratio < rules.min_length_ratio, "too_short")
        .when(ratio > rules.max_length_ratio, "too_long")
    )
    return reason.when(F.size(numbers_lost(source, target)) > 0, "numbers_lost") if rules.require_numbers else reason


def split_by_reason(df: DataFrame, reason: Column, stage: str) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, rows with one, as rejected rows of the stage)."""
    marked = df.withColumn("reason", reason)
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull()).withColumn("stage", F.lit(stage))


def has_sentences(column: str = "sentences") -> Column:
    """Whether a generated record has at least one sentence."""
    return F.coalesce(F.size(column), F.lit(0)) > 0
