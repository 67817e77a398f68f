"""Command line: python -m kolam generate|translate FOLDER INPUT [--config FILE] [--sync | --replay LOG] [--limit N].

Providers are named in the code that calls main(), or registered in kolam.providers.base; without network, stored responses serve.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession

from kolam.config import Config, load
from kolam.functions.embedding import hashing_embedder
from kolam.log import start
from kolam.plans.generation import RAW_LOG as LOG
from kolam.plans.generation import GenerationRun
from kolam.plans.translation import TranslationRun
from kolam.providers.base import Provider, provider
from kolam.providers.requests import ClientProvider
from kolam.sinks.export import final_sentences, write_csv, write_jsonl, write_spreadsheet
from kolam.sources.jsonl import SENTENCE, in_file_order, read_jsonl, read_prompt, translation_input
from kolam.sources.words import read_words


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kolam")
    p.add_argument("phase", choices=["generate", "translate"])
    p.add_argument("folder")
    p.add_argument("input")
    p.add_argument("--config")
    p.add_argument("--replay", help="judge stored raw records of this JSON-lines log again, or of the run's own with the word own; wins over --sync")
    p.add_argument("--sync", action="store_true")
    p.add_argument("--limit", type=int)
    return p


def client_provider(role: str, config: Config, client: dict) -> ClientProvider:
    """A network provider of a role: its prompt from the prompts folder, its retries from the settings. client: name, model and the
    client's four functions (ClientProvider), and its style and form if they aren't the usual ones."""
    r = config.retry
    return ClientProvider(prompt=read_prompt(config.prompts_dir, role), attempts=r.max_api_attempts, base=r.base_backoff_seconds, most=r.max_backoff_seconds, **client)


def _store(df: DataFrame, path: str) -> None:
    """The final table as JSON lines and CSV, and as a spreadsheet where that library is there and the rows fit."""
    write_jsonl(df, f"{path}_jsonl")
    write_csv(df, path)
    try:
        write_spreadsheet(df, f"{path.removeprefix('file://')}.xlsx")
    except (ImportError, ValueError) as reason:
        logging.getLogger("kolam").info("no spreadsheet: %s", reason)


def main(args: list[str], spark: SparkSession, providers: dict[str, Provider] | None = None, clients: dict[str, dict] | None = None, embedders: dict[str, object] | None = None) -> None:
    """providers: by role; clients: by role, for network providers; embedders: "sentence", "source" and "target", the hashing one by default."""
    a = parser().parse_args(args)
    config = load(a.config) if a.config else Config()
    start(f"{a.folder}/run.log" if "://" not in a.folder else None, config.log_level)

    def of(role: str) -> Provider:
        if role in (providers or {}):
            return providers[role]
        return client_provider(role, config, clients[role]) if role in (clients or {}) else provider(role)

    known = lambda name: next((p for p in (providers or {}).values() if p.name == name), None)
    embed = lambda which: (embedders or {}).get(which) or hashing_embedder()
    if a.phase == "generate":
        words = read_words(spark, a.input, ordered=True)
        run = GenerationRun(spark, a.folder, of("generator"), of("judge"), embed("sentence"), config, sync=a.sync and not a.replay, other=known)
        if a.replay:
            accepted = run.replay(None if a.replay == "own" else read_jsonl(spark, a.replay, LOG))
        else:
            accepted = run.run(words)
        _store(final_sentences(words, accepted, "ord"), f"{a.folder}/final_sentences")
    else:
        run = TranslationRun(spark, a.folder, of("tier1"), of("tier2"), of("judge"), embed("source"), embed("target"), config, other=known)
        _store(run.run(translation_input(in_file_order(read_jsonl(spark, a.input, SENTENCE))), a.limit), f"{a.folder}/final_translations")
