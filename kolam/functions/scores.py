"""Decisions from judge scores, always recomputed from the scores; a judge's own decision is never used."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kolam.functions.names import as_col

# Dimensions in the order of reports, and their least scores.
SENTENCE_THRESHOLDS = {
    "target_usage": 0.90, "grammar": 0.85, "naturalness": 0.85, "domain_relevance": 0.80,
    "category_relevance": 0.80, "context_quality": 0.80, "training_usefulness": 0.85,
}
TRANSLATION_THRESHOLDS = {
    "meaning_preservation": 0.90, "completeness": 0.90, "hallucination": 0.90, "target_word_accuracy": 0.85,
    "grammar": 0.85, "naturalness": 0.85, "context_preservation": 0.80,
}
SEMANTIC_FLOOR = 0.80


def number(c) -> Column:
    """A score as a double; numeric strings count, anything else is null."""
    c = as_col(c)
    return F.coalesce(c.try_cast("double"))


def decide(scores: dict[str, Column], thresholds: dict[str, float], similarity: Column | None = None, floor: float = SEMANTIC_FLOOR) -> Column:
    """struct<decision, overall, failures array<string>, reason>.

    A missing dimension (no number, or NaN) fails with overall 0 and names all that are missing. Otherwise overall is the mean of all
    dimensions, and every dimension below its threshold is a failure, in the order of thresholds; equal passes. With similarity, one
    below the floor, or missing, is the last failure. reason joins the failures with "; ", empty on a pass.
    """
    value = {d: number(scores[d]) for d in thresholds}
    here = {d: v.isNotNull() & ~F.isnan(v) for d, v in value.items()}
    missing = F.filter(F.array(*[F.when(~F.coalesce(here[d], F.lit(False)), F.lit(d)) for d in thresholds]), lambda x: x.isNotNull())
    total = None
    for d in thresholds:  # in order: the sum's last bits depend on it
        total = value[d] if total is None else total + value[d]
    overall = total / len(thresholds)
    below = [F.when(value[d] < t, F.format_string(f"{d}=%.2f < {t:.2f}", value[d])) for d, t in thresholds.items()]
    if similarity is not None:
        s = number(similarity)
        below.append(F.when(s.isNull() | F.isnan(s), F.lit("semantic_similarity unavailable")).when(s < floor, F.format_string(f"semantic_similarity=%.2f < {floor:.2f}", s)))
    failed = F.filter(F.array(*below), lambda x: x.isNotNull())
    incomplete = F.size(missing) > 0
    failures = F.when(incomplete, F.transform(missing, lambda d: F.concat(F.lit("missing score: "), d))).otherwise(failed)
    return F.struct(
        F.when(incomplete | (F.size(failed) > 0), F.lit("FAIL")).otherwise(F.lit("PASS")).alias("decision"),
        F.when(incomplete, F.lit(0.0)).otherwise(overall).alias("overall"),
        failures.alias("failures"),
        F.array_join(failures, "; ").alias("reason"),
    )
