"""Runs that are stopped and taken up again, order, last answers, providers, prompts, keys and logs."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from kolam import log
from kolam.config import Config, Retry
from kolam.functions.embedding import hashing_embedder
from kolam.functions.scores import SENTENCE_THRESHOLDS, TRANSLATION_THRESHOLDS
from kolam.operators.state import Journal, PartLog
from kolam.plans.generation import WORD_STATE, GenerationRun
from kolam.plans.translation import REJECTED, TranslationRun
from kolam.providers.asking import Asker
from kolam.providers.base import PERMANENT_MARKERS, Breaker, CircuitOpen, ReplayProvider, Status, cached_client, first_key, is_permanent, status_of, with_retry
from kolam.providers.requests import ClientProvider, Style, content_request, inlined_requests
from kolam.sources.jsonl import in_file_order, read_env, read_jsonl, read_prompt

WORD = "row_id int, domain string, category string, word string"


class Stop(Exception):
    """What ends a run from outside."""


class Counting(ReplayProvider):
    """Counts what it is asked for; stops the run when it is asked for the state of a job, so many times."""

    def __init__(self, answer, name, stops=0):
        super().__init__(answer, name, "m")
        self.stops, self.submitted = stops, []

    def submit(self, payloads):
        self.submitted.append(sorted(payloads))
        return super().submit(payloads)

    def status(self, job):
        if self.stops:
            self.stops -= 1
            raise Stop
        return super().status(job)


def sentences_for(payload):
    return json.dumps([{"row_id": a["row_id"], "sentences": [{"sentence": f"The {a['word']} {x} by the door.", "context": ""} for x in ("stood quietly", "fell down loudly again", "was painted yellow last week", "vanished")]} for a in json.loads(payload)])


def good(payload, dims=SENTENCE_THRESHOLDS):
    return json.dumps({"evaluations": [{"sentence_id": s["sentence_id"], "telugu_romanized": "r", **{d: 0.95 for d in dims}} for s in json.loads(payload)]})


@pytest.mark.parametrize("stopped", ["generator", "judge"])
def test_a_stopped_round_is_gone_on_with(spark, tmp_path, stopped):
    g, j = Counting(sentences_for, "g", stopped == "generator"), Counting(good, "j", stopped == "judge")
    words = spark.createDataFrame([(i, "D", "C", f"lamp{i}") for i in range(60)], WORD)
    make = lambda: GenerationRun(spark, str(tmp_path), g, j, hashing_embedder())
    with pytest.raises(Stop):
        make().run(words)
    flying = make().asker.journal.read()
    assert any(k.startswith("generation-" if stopped == "generator" else "judge-") and v for k, v in flying.items())
    got = make().run(words)
    assert got.count() == 240 and got.select("row_id", "sentence_id").distinct().count() == 240
    assert len(g.submitted) == 1 and len(j.submitted) == 1  # nothing was asked for twice
    assert {r["rounds_attempted"] for r in make().words.read(WORD_STATE).collect()} == {1}
    assert make().run(words).count() == 240 and len(g.submitted) == 1


def test_replay_of_the_own_log(spark, tmp_path):
    """A run stopped with a job in flight: its answers are stored, and then judged without asking again."""
    g, j = Counting(sentences_for, "g", 1), Counting(good, "j")
    words = spark.createDataFrame([(1, "D", "C", "lamp")], WORD)
    with pytest.raises(Stop):
        GenerationRun(spark, str(tmp_path), g, j, hashing_embedder()).run(words)
    assert GenerationRun(spark, str(tmp_path), g, j, hashing_embedder()).replay().count() == 4
    assert len(g.submitted) == 1


def test_jobs_of_another_provider(spark, tmp_path):
    old, new = Counting(lambda p: "old", "old", 1), Counting(lambda p: "new", "new")
    payloads = spark.createDataFrame([(i, f"p{i}") for i in range(5)], "chunk_id long, payload string")
    with pytest.raises(Stop):
        Asker(spark, str(tmp_path / "a")).ask("s", payloads, old, 2, 1)
    got = Asker(spark, str(tmp_path / "a"), {"old": old}.get).ask("s", payloads, new, 2, 1).collect()
    assert sorted(map(tuple, got)) == [(0, "old"), (1, "old"), (2, "new"), (3, "new"), (4, "new")]
    assert new.submitted == [[2, 3], [4]] and not Asker(spark, str(tmp_path / "a")).journal.read()


def test_calls_from_executors(spark, tmp_path):
    def answer(payload):
        if payload == "p1":
            raise RuntimeError("quota, try later")
        if payload == "dead":
            raise RuntimeError("API key not valid. Please pass a valid API key.")
        return payload.upper()

    payloads = spark.createDataFrame([(i, f"p{i}") for i in range(4)], "chunk_id long, payload string")
    asker = Asker(spark, str(tmp_path))
    assert sorted(map(tuple, asker.ask("s", payloads, ReplayProvider(answer), 3, 1, workers=2).collect())) == [(0, "P0"), (2, "P2"), (3, "P3")]
    assert [r["error"] for r in asker.responses.read().where(F.col("chunk_id") == 1).collect()] == ["quota, try later"]
    with pytest.raises(Exception, match="API key not valid"):
        asker.ask("t", payloads.withColumn("payload", F.lit("dead")), ReplayProvider(answer), 3, 1, workers=2)


def test_the_last_evaluation_of_the_own_chunk_counts(spark, tmp_path):
    def judge(payload):
        out = []
        for s in json.loads(payload):
            for v in (0.95, 0.1, 0.9):  # the last passes, the greatest is first, the least between them
                out.append({"sentence_id": s["sentence_id"], **{d: v for d in SENTENCE_THRESHOLDS}})
        return json.dumps(out + [{"sentence_id": "1_1", **{d: 0.0 for d in SENTENCE_THRESHOLDS}}] * ("1_1" not in payload))

    config = dataclasses.replace(Config(), generation=dataclasses.replace(Config().generation, batch_size=1, sentences_requested_per_word=1))
    words = spark.createDataFrame([(1, "D", "C", "lamp"), (2, "D", "C", "boat")], WORD)
    got = GenerationRun(spark, str(tmp_path), Counting(sentences_for, "g"), Counting(judge, "j"), hashing_embedder(), config).run(words).collect()
    assert len(got) == 8 and {r["overall_score"] for r in got} == {0.9}


TRANSLATION = "sentence_id string, row_id int, domain string, category string, word string, english_sentence string, ord long"


def translation(spark, folder, first, judge, **how):
    settings = dataclasses.replace(Config().translation, **({"semantic_similarity_threshold": -1.0} | how))
    return TranslationRun(spark, folder, first, ReplayProvider(lambda p: "[]", "two"), judge, hashing_embedder(), hashing_embedder(), dataclasses.replace(Config(), translation=settings))


def telugu(payload):
    texts = {"10_1": "నేను నిన్న దుకాణానికి వెళ్ళాను", "2_1": "పిల్లి మెల్లగా చెట్టు ఎక్కింది", "3_1": "నేను నిన్న దుకాణానికి వెళ్ళాను"}
    return json.dumps({"translations": [{"sentence_id": x["sentence_id"], "telugu_sentence": texts.get(x["sentence_id"], "కుక్క బాగా నిద్రపోతోంది")} for x in json.loads(payload)] + [{"sentence_id": "3_1", "telugu_sentence": "ఇతర"}] * ("3_1" not in payload)})


ROWS = [("10_1", 1, "D", "C", "w", "I went to the store yesterday", 0), ("2_1", 2, "D", "C", "w", "The cat climbed slowly up there", 1), ("3_1", 1, "D", "C", "w", "I walked to the shop yesterday", 2), ("4_1", 4, "D", "C", "w", "The dog sleeps well at night", 3)]


def test_units_see_what_earlier_ones_accepted(spark, tmp_path):
    first, judge = Counting(telugu, "one"), Counting(lambda p: good(p, TRANSLATION_THRESHOLDS), "judge", 1)
    given = spark.createDataFrame(ROWS, TRANSLATION)
    make = lambda: translation(spark, str(tmp_path), first, judge, unit_size=2, chunk_size=1)
    with pytest.raises(Stop):
        make().run(given)
    got = [r["sentence_id"] for r in make().run(given).collect()]
    assert got == ["10_1", "2_1", "4_1"]  # in input order; 3_1 repeats 10_1 of the unit before
    assert len(first.submitted) == 2 and len(judge.submitted) == 2
    rejected = {(r["sentence_id"], r["stage"]) for r in make().rejected.read(REJECTED).collect()}
    assert rejected == {("3_1", "near_duplicate")}


def test_limit_takes_the_first_in_input_order(spark, tmp_path):
    make = lambda name: translation(spark, str(tmp_path / name), Counting(telugu, "one"), Counting(lambda p: good(p, TRANSLATION_THRESHOLDS), "judge"))
    assert [r["sentence_id"] for r in make("a").run(spark.createDataFrame(ROWS, TRANSLATION), 1).collect()] == ["10_1"]
    plain = spark.createDataFrame([r[:-1] for r in [("10_10", 10, *ROWS[0][2:]), ("10_2", 10, *ROWS[1][2:]), ("2_1", 2, *ROWS[3][2:])]], TRANSLATION.removesuffix(", ord long"))
    assert [r["sentence_id"] for r in make("b").run(plain, 2).collect()] == ["2_1", "10_2"]


def test_file_order(spark, tmp_path):
    for name, ids in (("b.json", range(5, 9)), ("a.json", range(5))):
        (tmp_path / name).write_text("".join(json.dumps({"row_id": i, "sentence_id": f"s{i}"}) + "\n\n" for i in ids), encoding="utf-8")
    df = in_file_order(read_jsonl(spark, str(tmp_path), "row_id int, sentence_id string"))
    assert [(r["ord"], r["row_id"]) for r in df.orderBy("ord").collect()] == [(i, i) for i in range(9)]
    assert read_jsonl(spark, str(tmp_path / "none*"), "row_id int").count() == 0


def test_part_logs_and_journals(spark, tmp_path):
    parts, journal = PartLog(spark, str(tmp_path / "p"), "a int, b string"), Journal(spark, str(tmp_path / "j"))
    assert parts.read().count() == 0 and journal.read() == {}
    parts.write("x", spark.range(3).select(F.col("id").alias("a"), F.lit(1).alias("c")))
    parts.write("x", spark.range(2).select(F.col("id").alias("a")))
    parts.write("y", spark.range(1).select(F.col("id").alias("a"), F.lit("t").alias("b")))
    (tmp_path / "p" / "z").mkdir()  # what a crash left
    assert {(r["a"], r["b"]) for r in parts.read().collect()} == {(0, None), (0, "t"), (1, None)} and parts.parts() == ["x", "y"]
    journal.write({"round": 1, "jobs": [["j", [1, 2]]]})
    journal.write({"ఒకటి": 2})
    assert journal.read() == {"ఒకటి": 2}


def test_errors_that_no_repetition_mends():
    for message in ("400 API key not valid. Please pass a valid API key.", "403 PERMISSION_DENIED", "Your prepayment credits are depleted.", "reason: API_KEY_INVALID"):
        assert is_permanent(RuntimeError(message))
        calls = []
        with pytest.raises(RuntimeError):
            with_retry(lambda m=message: calls.append(1) or (_ for _ in ()).throw(RuntimeError(m)), sleep=lambda s: None)
        assert len(calls) == 1
        with pytest.raises(CircuitOpen):
            Breaker(5).failed(RuntimeError(message))
    for message in ("404 model not found", "429 quota exceeded", "permission to wait"):
        assert not is_permanent(RuntimeError(message))
        Breaker(5).failed(RuntimeError(message))
    assert len(PERMANENT_MARKERS) == 4


def test_states_of_jobs(caplog):
    assert status_of("JOB_STATE_RUNNING") is Status.RUNNING and status_of("validating") is Status.RUNNING and not caplog.records
    log.logging.getLogger("kolam").propagate = True
    assert status_of("JOB_STATE_STRANGE") is Status.RUNNING and "JOB_STATE_STRANGE" in caplog.text


def test_requests_with_contents():
    r = content_request("[1]", "be good", Style(temperature=0.0, thinking="LOW", wrapper="evaluations"))
    assert r["generation_config"] == {"response_mime_type": "application/json", "max_output_tokens": 16_384, "temperature": 0.0, "thinking_config": {"thinking_level": "LOW"}}
    assert r["system_instruction"]["parts"][0]["text"] == "be good" and '"evaluations"' in r["contents"][0]["parts"][0]["text"]
    assert [x["metadata"]["chunk_id"] for x in inlined_requests({2: "b", 1: "a"}, "p")] == ["chunk-1", "chunk-2"]
    jobs = []
    p = ClientProvider("n", "m", "p", call=lambda q: q["contents"][0]["parts"][0]["text"], upload=lambda x: jobs.append(x) or "j", look=lambda j: "JOB_STATE_SUCCEEDED", download=lambda j: [("chunk-1", "x"), ("chunk-2", "y"), ("other-3", "z"), ("4", None)], inline=True)
    assert p.complete("hello") == "hello" and p.submit({1: "a"}) == "j" and jobs[0][0]["metadata"] == {"chunk_id": "chunk-1"}
    assert p.fetch("j") == {1: "x", 2: "y"} and p.status("j") is Status.SUCCEEDED


def test_prompts_keys_and_clients(tmp_path, monkeypatch):
    from kolam.cli import client_provider

    (tmp_path / "judge.txt").write_text("Judge well.", encoding="utf-8")
    assert read_prompt(str(tmp_path), "judge") == "Judge well."
    config = Config(prompts_dir=str(tmp_path), retry=Retry(max_api_attempts=2, base_backoff_seconds=0.0))
    tries = []
    none = {"upload": None, "look": None, "download": None}
    p = client_provider("judge", config, {"name": "n", "model": "m", "call": lambda q: tries.append(q) or "", **none})
    with pytest.raises(RuntimeError, match="empty"):
        p.complete("x")
    assert len(tries) == 2 and tries[0]["messages"][0]["content"] == "Judge well."
    (tmp_path / ".env").write_text("# keys\nA=one\nexport B='two'\nC=\n", encoding="utf-8")
    monkeypatch.setenv("A", "outer")
    env = read_env(str(tmp_path / ".env"))
    assert env == {"A": "outer", "B": "two", "C": ""} and read_env(str(tmp_path / "none")) == {}
    assert first_key(env, "C", "B", "A") == "two"
    with pytest.raises(KeyError):
        first_key(env, "C", "D")
    made = []
    assert cached_client(lambda *a: made.append(a) or object(), "k") is not None
    make = lambda k: made.append(k) or [k]
    assert cached_client(make, "k") is cached_client(make, "k") and cached_client(make, "l") == ["l"]


def test_logging_to_a_file(tmp_path):
    one = log.start(str(tmp_path / "logs" / "run.log"), "info")
    one.info("begun")
    log.start(str(tmp_path / "logs" / "run.log")).warning("again")
    text = (tmp_path / "logs" / "run.log").read_text(encoding="utf-8")
    assert text.count("begun") == 1 and text.count("again") == 1 and len(one.handlers) == 2
    for h in list(one.handlers):
        one.removeHandler(h)
