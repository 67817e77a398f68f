"""The translation pipeline: sentences -> tier 1, later tier 2 -> rules -> near duplicates -> judge with a semantic floor -> export."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kolam.config import Config
from kolam.functions.scores import decide, number
from kolam.functions.vectors import cosine
from kolam.operators import keyed, parsing, state, validation
from kolam.operators.neardup import greedy_near_duplicates
from kolam.providers.asking import Asker
from kolam.providers.base import Provider
from kolam.scratch import Scratch
from kolam.sinks.export import final_translations, rejected_rows

SCORES = "meaning_preservation, completeness, hallucination, target_word_accuracy, grammar, naturalness, context_preservation".split(", ")
SENTENCE_STATE = (
    "sentence_id STRING, row_id INT, domain STRING, category STRING, word STRING, english_sentence STRING, status STRING, attempts INT, tier INT, "
    "telugu_sentence STRING, telugu_romanized STRING, translation_provider STRING, translation_model STRING, judge_provider STRING, judge_model STRING, "
    f"scores STRUCT<{', '.join(f'{s}: DOUBLE' for s in SCORES)}>, semantic_similarity DOUBLE, overall_score DOUBLE, reason STRING, vector ARRAY<FLOAT>, ord BIGINT"
)
REJECTED = "sentence_id STRING, english_sentence STRING, telugu_sentence STRING, stage STRING, reason STRING, tier INT, semantic_similarity DOUBLE"
WORK = "sentence_id STRING, ord BIGINT, unit BIGINT"
log = logging.getLogger("kolam.translation")


@dataclass
class TranslationRun:
    """A run over one folder. embed_source and embed_target: functions from a column name to a Column of vectors, with whatever
    prefixes the model wants. Escalation goes to another translator than the one that failed: tier 2 by the attempts so far.

    A round takes the sentences that need work in units of unit_size, in input order; a unit is translated, gated and judged before the
    next begins, so that its near-duplicate gate sees what earlier units had accepted. A unit's new state is one part of the changes,
    which the end of a round puts into the state; a stopped run goes on with the unit it was in.
    """

    spark: SparkSession
    folder: str
    tier1: Provider
    tier2: Provider
    judge: Provider
    embed_source: object
    embed_target: object
    config: Config = field(default_factory=Config)
    other: object = lambda name: None

    def __post_init__(self):
        self.state = state.Snapshots(self.spark, f"{self.folder}/sentences")
        self.rejected, self.changes, self.work = (state.PartLog(self.spark, f"{self.folder}/{n}", s) for n, s in (("rejected", REJECTED), ("changes", SENTENCE_STATE), ("work", WORK)))
        self.asker = Asker(self.spark, self.folder, self.other)

    def run(self, sentences: DataFrame, limit: int | None = None) -> DataFrame:
        """final_translations of the input (translation_input's columns) and all earlier runs, in input order. limit: only the first so
        many sentences in that order (column ord; without it, of row ids and the numbers in sentence ids), for a pilot; none or 0 means all."""
        t = self.config.translation
        if "ord" not in sentences.columns:
            by = [F.col("row_id"), F.length("sentence_id"), F.col("sentence_id")]
            named = sentences.withColumns({f"_o{i}": c for i, c in enumerate(by)})
            sentences = keyed.global_positions(named, ["_o0", "_o1", "_o2"], "ord").drop("_o0", "_o1", "_o2")
        if limit:
            sentences = sentences.orderBy("ord").limit(limit)
        twice = sentences.groupBy("sentence_id").count().where("count > 1").limit(1).count()
        if twice:
            raise ValueError("sentence ids must be unique")
        if not self._open_round():
            old = self.state.read(SENTENCE_STATE)
            after = old.agg(F.coalesce(F.max("ord") + 1, F.lit(0))).first()[0]  # later inputs come behind earlier ones
            fresh = sentences.withColumns({"status": F.lit(state.PENDING), "attempts": F.lit(0), "ord": F.col("ord") + after})
            self._write(keyed.upsert_if_absent(old, fresh, "sentence_id"))
        for _ in range(t.max_attempts):
            round_ = self._open_round()
            if not round_:
                if state.sentences_needing_work(self.state.read(SENTENCE_STATE)).isEmpty():
                    break
                round_ = 1 + (self.asker.journal.read().get("round") or 0)
                self.asker.note(round=round_, base=self.state.current())
            self._round(round_)
        return final_translations(self.state.read(SENTENCE_STATE), t.source_language, t.target_language, order="ord")

    def _open_round(self) -> int | None:
        """The round in progress; none if its end has been written."""
        j = self.asker.journal.read()
        return j["round"] if "round" in j and j.get("base") == self.state.current() else None

    def _round(self, round_: int) -> None:
        t = self.config.translation
        mine = f"round-{round_}"
        if not self.work.has(mine):
            todo = state.sentences_needing_work(self.state.read(SENTENCE_STATE)).select("sentence_id", "ord")
            self.work.write(mine, keyed.chunks(todo, "ord", t.unit_size).withColumnRenamed("chunk_id", "unit"))
        work = self.work.read(parts=[mine])
        units = work.agg(F.coalesce(F.max("unit") + 1, F.lit(0))).first()[0]
        for unit in range(units):
            part = f"{mine}-unit-{unit}"
            if not self.changes.has(part):
                log.info("%s: unit %d of %d", mine, unit + 1, units)
                now = self._now(mine)
                self._unit(now.join(work.where(F.col("unit") == unit).select("sentence_id"), "sentence_id", "left_semi"), now, part)
        self._write(self._now(mine))  # ends the round: the journal names the state before

    def _now(self, round_: str) -> DataFrame:
        """The state with the changes of the round's units so far."""
        base = self.state.read(SENTENCE_STATE)
        new = self.changes.read(parts=[p for p in self.changes.parts() if p.startswith(f"{round_}-unit-")])
        return base.join(new.select("sentence_id"), "sentence_id", "left_anti").unionByName(new)

    def _write(self, df: DataFrame) -> DataFrame:
        return self.state.write(_conformed(df))

    def _unit(self, own: DataFrame, now: DataFrame, part: str) -> None:
        box = Scratch(self.spark, "unit")
        s = box.save(own, "own")
        bad: list[DataFrame] = []
        s = self._translate(s, part, box)
        s = self._rules(s, bad, box)
        s = self._near_duplicates(s, now, bad, box)
        s = self._judge(s, part, bad, box)
        self.rejected.write(part, rejected_rows(*bad))
        self.changes.write(part, s)  # ends the unit
        box.keep_only()

    def _translate(self, s: DataFrame, part: str, box: Scratch) -> DataFrame:
        t = self.config.translation
        asked_of = {1: s.where((F.col("status") == state.PENDING) & (F.col("attempts") == 0)), 2: s.where((F.col("status") == state.PENDING) & (F.col("attempts") > 0))}
        for tier, provider in ((1, self.tier1), (2, self.tier2)):
            asked = asked_of[tier]
            if asked.isEmpty():
                continue
            chunked = box.save(keyed.chunks(asked.select("sentence_id", "domain", "category", "word", "english_sentence", "ord"), "ord", t.chunk_size, box=box), "asked")
            payloads = parsing.request_payloads(chunked, {c: c for c in ("sentence_id", "domain", "category", "word", "english_sentence")})
            got = self.asker.ask(f"tier{tier}-{part}", payloads, provider, t.job_max_chunks, t.max_concurrent_jobs, None if tier == 1 else 8)
            # an answer counts for the chunk that asked for it
            parsed = parsing.parse_translations(got).join(chunked.select("chunk_id", "sentence_id"), ["chunk_id", "sentence_id"], "left_semi").select("sentence_id", "telugu_sentence")
            s = box.save(_conformed(state.apply_translations(s, asked, parsed, tier, provider.name, provider.model, t.max_attempts)), "translated")
        return s

    @staticmethod
    def _translated(s: DataFrame) -> DataFrame:
        return s.where((F.col("status") == state.TRANSLATED) & F.col("telugu_sentence").isNotNull())

    def _rules(self, s: DataFrame, bad: list[DataFrame], box: Scratch) -> DataFrame:
        t = self.config.translation
        failed = self._translated(s).withColumn("reason", validation.rule_reason("english_sentence", "telugu_sentence", t.rules)).where(F.col("reason").isNotNull())
        failed = box.save(failed.withColumn("stage", F.lit("rules")).select("sentence_id", "english_sentence", "telugu_sentence", "stage", "reason", "tier"), "failed")
        bad.append(failed)
        return box.save(_conformed(state.fail_sentences(s, failed, t.max_attempts)), "ruled")

    def _near_duplicates(self, s: DataFrame, now: DataFrame, bad: list[DataFrame], box: Scratch) -> DataFrame:
        t = self.config.translation
        cols = ["row_id", "sentence_id", "ord", "english_sentence", "telugu_sentence", "tier"]
        new = self._translated(s).select(*cols, F.lit(False).alias("past")).withColumn("vector", self.embed_target("telugu_sentence").cast("array<float>"))
        old = now.where(F.col("status") == state.COMPLETE).join(s.select("row_id").distinct(), "row_id", "left_semi").select(*cols, F.lit(True).alias("past"), "vector")
        both = box.save(new.unionByName(old), "vectors")
        marked = box.save(greedy_near_duplicates(both, "row_id", "ord", "vector", t.near_duplicate_similarity_threshold, history="past").where(~F.col("past")), "marked")
        failed = marked.where(~F.col("kept")).withColumns({"stage": F.lit("near_duplicate"), "reason": F.lit("near_duplicate")})
        bad.append(failed.select("sentence_id", "english_sentence", "telugu_sentence", "stage", "reason", "tier"))
        v = marked.where("kept").select("sentence_id", F.col("vector").alias("_v"))
        s = s.join(v, "sentence_id", "left").withColumn("vector", F.coalesce("_v", "vector")).drop("_v")
        return box.save(_conformed(state.fail_sentences(s, failed, t.max_attempts)), "distinct")

    def _judge(self, s: DataFrame, part: str, bad: list[DataFrame], box: Scratch) -> DataFrame:
        t = self.config.translation
        todo = self._translated(s)
        if todo.isEmpty():
            return s
        chunked = box.save(keyed.chunks(todo.select("sentence_id", "domain", "category", "word", "english_sentence", F.col("telugu_sentence").alias("telugu_translation"), "ord"), "ord", t.judge_chunk_size, box=box), "judged")
        names = {c: c for c in ("sentence_id", "domain", "category", "word", "english_sentence", "telugu_translation")}
        got = self.asker.ask(f"judge-{part}", parsing.request_payloads(chunked, names), self.judge, t.job_max_chunks, t.max_concurrent_jobs)
        evals = parsing.parse_judgements(got, list(t.thresholds)).join(chunked.select("chunk_id", "sentence_id"), ["chunk_id", "sentence_id"], "left_semi")
        evals = evals.select("sentence_id", F.struct(*t.thresholds, "telugu_romanized", "judge_decision").alias("e"))
        both = todo.select("sentence_id", "english_sentence", "telugu_sentence", "tier", F.col("vector").alias("tv")).withColumn("ev", self.embed_source("english_sentence")).join(evals, "sentence_id", "left")
        both = both.withColumn("semantic_similarity", cosine("ev", "tv"))
        g = decide({d: F.col(f"e.{d}") for d in t.thresholds}, t.thresholds, F.col("semantic_similarity"), t.semantic_similarity_threshold)
        both = box.save(both.withColumn("g", F.when(F.col("e").isNotNull(), g)).drop("ev", "tv"), "decided")
        ok = both.where(F.col("g.decision") == "PASS").select("sentence_id", F.struct(*[number(F.col(f"e.{d}")).alias(d) for d in t.thresholds]).alias("scores"), "semantic_similarity", F.col("g.overall").alias("overall_score"), F.col("e.telugu_romanized").alias("telugu_romanized"))
        failed = both.where(F.col("g.decision") == "FAIL").withColumns({"stage": F.lit("judge"), "reason": F.col("g.reason")})
        silent = both.where(F.col("g").isNull()).select("sentence_id", F.lit("judge returned no evaluation").alias("reason"))
        bad.append(failed.select("sentence_id", "english_sentence", "telugu_sentence", "stage", "reason", "tier", "semantic_similarity"))
        s = state.accept_sentences(s, ok, self.judge.name, self.judge.model)
        return box.save(_conformed(state.fail_sentences(s, failed.select("sentence_id", "reason").unionByName(silent), t.max_attempts)), "decided")


def _conformed(df: DataFrame) -> DataFrame:
    """df with the state's columns, in order; null where it lacks one."""
    kinds = [(f.name, f.dataType) for f in T.StructType.fromDDL(SENTENCE_STATE)]
    return df.select(*[F.col(c).cast(k).alias(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in kinds])
