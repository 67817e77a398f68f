"""Settings, with the published defaults; load() reads a YAML file of the same sections over them."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from kolam.functions.scores import SEMANTIC_FLOOR, SENTENCE_THRESHOLDS, TRANSLATION_THRESHOLDS


@dataclass(frozen=True)
class Retry:
    max_api_attempts: int = 4
    base_backoff_seconds: float = 2.0
    max_backoff_seconds: float = 30.0


@dataclass(frozen=True)
class Rules:
    """Limits of the translation rules; script_low and script_high are the code points of the target script."""

    min_script_ratio: float = 0.50
    max_latin_run: int = 25
    min_length_ratio: float = 0.50
    max_length_ratio: float = 3.00
    require_numbers: bool = True
    script_low: int = 0x0C00
    script_high: int = 0x0C7F


@dataclass(frozen=True)
class Generation:
    batch_size: int = 25
    sentences_requested_per_word: int = 5
    min_passing_sentences_per_word: int = 3
    max_generation_rounds: int = 3
    near_duplicate_similarity_threshold: float = 0.92
    judge_batch_job_max_chunks: int = 14
    judge_max_concurrent_jobs: int = 2
    generation_batch_job_max_chunks: int = 30
    generation_max_concurrent_jobs: int = 2
    sync_max_workers: int = 5
    thresholds: dict = field(default_factory=lambda: dict(SENTENCE_THRESHOLDS))


@dataclass(frozen=True)
class Translation:
    chunk_size: int = 25
    judge_chunk_size: int = 20
    job_max_chunks: int = 50
    max_concurrent_jobs: int = 12
    unit_size: int = 20_000
    max_attempts: int = 2
    near_duplicate_similarity_threshold: float = 0.95
    semantic_similarity_threshold: float = SEMANTIC_FLOOR
    source_language: str = "en-IN"
    target_language: str = "te-IN"
    rules: Rules = field(default_factory=Rules)
    thresholds: dict = field(default_factory=lambda: dict(TRANSLATION_THRESHOLDS))


@dataclass(frozen=True)
class Config:
    generation: Generation = field(default_factory=Generation)
    translation: Translation = field(default_factory=Translation)
    retry: Retry = field(default_factory=Retry)
    prompts_dir: str = "prompts"
    log_level: str = "INFO"


def overlay(base, given: dict):
    """base with the given values; an unknown name is an error, so that a misspelt setting isn't ignored."""
    known = {f.name: getattr(base, f.name) for f in fields(base)}
    unknown = set(given) - set(known)
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return replace(base, **{k: overlay(known[k], v) if hasattr(known[k], "__dataclass_fields__") and isinstance(v, dict) else v for k, v in given.items()})


def load(path: str) -> Config:
    import yaml

    with open(path, encoding="utf-8") as f:
        return overlay(Config(), yaml.safe_load(f) or {})
