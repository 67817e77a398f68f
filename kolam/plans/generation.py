"""The generation pipeline: words -> sentences -> gates -> judged -> accepted, in rounds, and its replay from stored responses.

Responses come from a provider as a table that is written once, job by job; everything behind it is a plan over tables. A run that is
stopped goes on with the round it was in: what is stored or in flight isn't asked for again.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kolam.config import Config
from kolam.functions.scores import decide
from kolam.functions.text import strip
from kolam.operators import keyed, parsing, state, validation
from kolam.operators.neardup import greedy_near_duplicates
from kolam.providers.asking import Asker
from kolam.providers.base import Provider
from kolam.scratch import Scratch
from kolam.sinks.export import rejected_rows, write_jsonl
from kolam.sources.jsonl import read_jsonl

WORD_STATE = "row_id INT, domain STRING, category STRING, word STRING, status STRING, rounds_attempted INT, accepted_count INT, minted INT"
ACCEPTED = "row_id INT, sentence_id STRING, domain STRING, category STRING, word STRING, sentence STRING, context STRING, overall_score DOUBLE, vector ARRAY<FLOAT>"
KEPT = "row_id INT, sentence_id STRING, pos INT, domain STRING, category STRING, word STRING, sentence STRING, context STRING, vector ARRAY<FLOAT>, chunk_id BIGINT, pos_in_chunk BIGINT"
REJECTED = "row_id INT, sentence_id STRING, sentence STRING, stage STRING, reason STRING"
RAW_LOG = "ord BIGINT, row_id INT, sentences ARRAY<STRUCT<sentence: STRING, context: STRING>>"
log = logging.getLogger("kolam.generation")


def generation_payloads(words: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(words with chunk_id, payloads by chunk) of the words to ask for."""
    chunked = keyed.chunks(words.select("row_id", "domain", "category", "word"), "row_id", size)
    names = {c: c for c in ("row_id", "domain", "category", "word")}
    return chunked, parsing.request_payloads(chunked, names)


def candidates(parsed: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidates, rejected) of a round's parsed responses. Ids go on from the most a word ever minted, so none is given twice; domain,
    category and word are the asked ones, not the response's echo."""
    bad = parsed.where(F.col("status") == "FAILED").select("row_id", F.lit("generation").alias("stage"), "reason")
    own = parsed.where(F.col("status") == "OK").select("row_id", "domain", "category", "word", F.posexplode("sentences").alias("pos", "s"))
    minted = words.select("row_id", F.coalesce("minted", F.lit(0)).alias("_base"))
    numbered = own.join(minted, "row_id").withColumn("sentence_id", F.concat_ws("_", "row_id", (F.col("_base") + F.col("pos") + 1).cast("string")))
    numbered = numbered.select("row_id", "sentence_id", "pos", "domain", "category", "word", strip("s.sentence").alias("sentence"), F.coalesce("s.context", F.lit("")).alias("context"))
    good, rejected = validation.split_by_reason(numbered, validation.structural_reason("sentence", "word"), "structural_validation")
    return good, rejected_rows(bad, rejected.select("row_id", "sentence_id", "sentence", "stage", "reason"))


def without_near_duplicates(found: DataFrame, accepted: DataFrame, embed, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): a word's candidates in order against its accepted sentences and the candidates kept before."""
    new = found.withColumn("vector", embed("sentence").cast("array<float>")).withColumn("_past", F.lit(False))
    old = accepted.select("row_id", "sentence_id", "vector").withColumn("_past", F.lit(True))
    both = new.unionByName(old, allowMissingColumns=True).withColumn("_at", F.struct(~F.col("_past"), F.coalesce("pos", F.lit(0)), "sentence_id"))
    ranked = keyed.positions_in_key(both, "row_id", "_at", "_n").drop("_at")
    marked = greedy_near_duplicates(ranked, "row_id", "_n", "vector", threshold, history="_past").where(~F.col("_past")).drop("_past", "_n")
    rejected = marked.where(~F.col("kept")).select("row_id", "sentence_id", "sentence", F.lit("near_duplicate").alias("stage"), F.lit("near_duplicate").alias("reason"))
    return marked.where("kept").drop("kept"), rejected


def judged(found: DataFrame, evaluations: DataFrame, thresholds: dict) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of the candidates, each by the last evaluation in the answer to the chunk it was in; one without an
    evaluation is neither."""
    last = evaluations.select("chunk_id", "sentence_id", F.struct(*[F.col(d).alias(d) for d in thresholds]).alias("e"))
    both = found.join(last, ["chunk_id", "sentence_id"]).withColumn("g", decide({d: F.col(f"e.{d}") for d in thresholds}, thresholds))
    ok = both.where(F.col("g.decision") == "PASS").select("row_id", "sentence_id", "domain", "category", "word", "sentence", "context", F.round("g.overall", 4).alias("overall_score"), "vector")
    no = both.where(F.col("g.decision") == "FAIL").select("row_id", "sentence_id", "sentence", F.lit("judge").alias("stage"), F.col("g.reason").alias("reason"))
    return ok, no


@dataclass
class GenerationRun:
    """A run over one folder. embed: function from a column name to a Column of vectors. other: gives the provider of a name, for jobs
    that another one took before the run was stopped.

    Accepted sentences, rejected rows, responses and logs grow by parts, one a round or job; only the words' state is written anew. The
    journal names the round in progress and the state it began from, so that a stopped round is gone on with and counted once.
    """

    spark: SparkSession
    folder: str
    generator: Provider
    judge: Provider
    embed: object
    config: Config = field(default_factory=Config)
    sync: bool = False
    other: object = lambda name: None

    def __post_init__(self):
        self.words = state.Snapshots(self.spark, f"{self.folder}/words")
        self.accepted, self.rejected, self.kept = (state.PartLog(self.spark, f"{self.folder}/{n}", s) for n, s in (("accepted", ACCEPTED), ("rejected", REJECTED), ("kept", KEPT)))
        self.asker = Asker(self.spark, self.folder, self.other)

    def run(self, words: DataFrame) -> DataFrame:
        """The accepted sentences after at most max_generation_rounds rounds over the words."""
        g = self.config.generation
        fresh = words.select("row_id", "domain", "category", "word").withColumns({"status": F.lit(state.PENDING), "rounds_attempted": F.lit(0), "accepted_count": F.lit(0), "minted": F.lit(0)})
        if not self._open_round():
            self.words.write(keyed.upsert_if_absent(self.words.read(WORD_STATE), fresh, "row_id", "word"))
        for _ in range(g.max_generation_rounds):
            if not self._open_round():
                if state.words_needing_work(self.words.read(WORD_STATE), g.min_passing_sentences_per_word).isEmpty():
                    break
                self.words.write(state.begin_round(self.words.read(WORD_STATE)))
                self.asker.note(round=self._next_round(), words=self.words.current())
            round_ = self._open_round()
            log.info("round %d", round_)
            self._round(state.words_needing_work(self.words.read(WORD_STATE), g.min_passing_sentences_per_word), round_)
        return self.accepted.read()

    def _next_round(self) -> int:
        return 1 + max([0, *(int(n) for p in self.accepted.parts() if (n := p.removeprefix("round-")).isdigit())])

    def _open_round(self) -> int | None:
        """The round in progress; none if its end has been written."""
        j = self.asker.journal.read()
        if "round" in j and j.get("words") == self.words.current():
            return j["round"]
        return None

    def _ask(self, payloads: DataFrame, provider: Provider, scope: str, per_job: int, jobs: int) -> DataFrame:
        return self.asker.ask(scope, payloads, provider, per_job, jobs, self.config.generation.sync_max_workers if self.sync else None)

    def _round(self, work: DataFrame, round_: int) -> None:
        g = self.config.generation
        chunked, payloads = generation_payloads(work, g.batch_size)
        got = self._ask(payloads, self.generator, f"generation-{round_}", g.generation_batch_job_max_chunks, g.generation_max_concurrent_jobs)
        parsed = Scratch(self.spark, "parsed").save(parsing.parse_generation(got, chunked), "parsed")
        raw = parsed.where(F.col("status") == "OK").select(F.lit(round_).alias("ord"), "row_id", "sentences")
        write_jsonl(raw, f"{self.folder}/raw/round-{round_}")
        self._judge(*candidates(parsed, self.words.read(WORD_STATE)), f"round-{round_}")

    def _judge(self, found: DataFrame, rejected: DataFrame, part: str) -> None:
        g = self.config.generation
        box = Scratch(self.spark, "round")
        found, rejected = box.save(found, "candidates"), box.save(rejected, "rejected")
        before = self.accepted.read(parts=[p for p in self.accepted.parts() if p != part])
        near = None
        if not self.kept.has(part):  # decided once, as the judge's chunks are made of it
            kept, near = without_near_duplicates(found, before, self.embed, g.near_duplicate_similarity_threshold)
            kept, near = box.save(kept, "kept"), box.save(near, "near")
            self.rejected.write(f"{part}-near", near)
            chunked = keyed.chunks(kept, ["row_id", "pos"], g.batch_size * g.sentences_requested_per_word, box=box)
            self.kept.write(part, chunked)
        chunked = self.kept.read(parts=[part])
        names = {c: c for c in ("row_id", "sentence_id", "domain", "category", "word", "sentence", "context")}
        got = self._ask(parsing.request_payloads(chunked, names), self.judge, f"judge-{part}", g.judge_batch_job_max_chunks, g.judge_max_concurrent_jobs)
        evaluations = box.save(parsing.parse_judgements(got, list(g.thresholds)), "evaluations")
        write_jsonl(evaluations, f"{self.folder}/processed/{part}")
        ok, no = judged(chunked, evaluations, g.thresholds)
        self.accepted.write(part, ok)
        self.rejected.write(part, rejected_rows(rejected, no))
        minted = found.groupBy("row_id").agg(F.max("pos").alias("_p"))
        words = self.words.read(WORD_STATE).join(minted, "row_id", "left").withColumn("minted", F.coalesce("minted", F.lit(0)) + F.coalesce(F.col("_p") + 1, F.lit(0))).drop("_p")
        done = state.finish_words(words, self.accepted.read(), g.min_passing_sentences_per_word, g.max_generation_rounds)
        self.words.write(done.select(*[c.split()[0] for c in WORD_STATE.split(", ")]))  # ends the round: the journal names the state before
        box.keep_only()

    def complete_raw(self) -> None:
        """Waits for the generation jobs in flight of a stopped round and stores their responses, without judging them."""
        for scope in [k for k in self.asker.journal.read() if k.startswith("generation-")]:
            self.asker.finish(scope, self.generator)
            round_ = int(scope.removeprefix("generation-"))
            parsed = parsing.payload_items("response", "records")
            items = self.asker.stored(scope).select(F.explode(parsed).alias("item"))
            sentence = lambda s: F.struct(F.try_variant_get(s, "$.sentence", "string").alias("sentence"), F.try_variant_get(s, "$.context", "string").alias("context"))
            rows = items.select(F.lit(round_).alias("ord"), parsing.field("item", "$.row_id", "int").alias("row_id"), F.transform(parsing.field("item", "$.sentences", "array<variant>"), sentence).alias("sentences"))
            write_jsonl(rows.where(F.col("row_id").isNotNull()), f"{self.folder}/raw/round-{round_}")

    def replay(self, log_: DataFrame | None = None) -> DataFrame:
        """Judges the stored raw records of pending words again, without generating and without counting a round.

        log_: (ord, row_id, sentences array<struct<sentence, context>>), in log order; by default the run's own raw log, completed by the
        jobs still in flight. Nothing derived is written back to it.
        """
        if log_ is None:
            self.complete_raw()
            log_ = read_jsonl(self.spark, f"{self.folder}/raw/*", RAW_LOG)
        words = self.words.read(WORD_STATE)
        pending = words.where(F.col("status") == state.PENDING)
        own = log_.where(validation.has_sentences()).join(pending.select("row_id"), "row_id", "left_semi")
        each = keyed.merge_candidates(own, "row_id", "ord", "sentences", [])
        base = words.select("row_id", "domain", "category", "word", F.coalesce("minted", F.lit(0)).alias("_base"))
        rows = each.join(base, "row_id").select("row_id", F.concat_ws("_", "row_id", (F.col("_base") + F.col("pos") + 1).cast("string")).alias("sentence_id"), F.col("pos").cast("int").alias("pos"), "domain", "category", "word", strip("item.sentence").alias("sentence"), F.coalesce("item.context", F.lit("")).alias("context"))
        good, bad = validation.split_by_reason(rows, validation.structural_reason("sentence", "word"), "structural_validation")
        self._judge(good, bad.select("row_id", "sentence_id", "sentence", "stage", "reason"), f"replay-{self.words.current() or 0}")
        return self.accepted.read()
