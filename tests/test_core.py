"""Expressions, gates, keys, parsing, state and providers against independent expectations."""

import json
import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from kolam.config import Config, overlay
from kolam.functions import scores, text, vectors
from kolam.functions.names import current_rows, norm_name, present_name, usable_similarity
from kolam.operators import keyed, neardup, parsing, state, validation
from kolam.providers.base import Breaker, CircuitOpen, Pool, ReplayProvider, Status, backoff, is_permanent, provider, status_of, with_retry
from kolam.sinks import export
from kolam.sources import jsonl, words


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {kind}")


def out(df, *cols):
    return [r[0] if len(cols) == 1 else tuple(r) for r in df.select(*cols).collect()]


@pytest.mark.parametrize("sentence, word, found", [
    ("I like C++!", "C++", True), ("Stores open", "Store", False), ("the store, open", "Store", True), ("Drop off now", "Drop Off", True), ("Really? yes", "Really?", True),
    ("x_store", "store", False), ("naïve idea", "NAÏVE", True), ("a.b", "a.b", True), ("axb", "a.b", False), (None, "a", False), ("a", None, False), ("a", "", False), ("1store", "store", False),
])
def test_contains_word(spark, sentence, word, found):
    df = spark.createDataFrame([(sentence, word)], "s string, w string")
    assert out(df, text.contains_word("s", "w")) == [found]


TEXTS = ["", "   ", "abc", "నేను abc నేను", "కొన్నాను 15 ok", "a b-c D e", "Привет мир", "x" * 30, "½ ٣ 7", None, " a b "]


def test_measures_equal_python(spark):
    df = column(spark, TEXTS)

    def ratio(t):
        letters = [c for c in t if c.isalpha()]
        return sum(0xC00 <= ord(c) <= 0xC7F for c in letters) / len(letters) if letters else 0.0

    def run(t):
        best = n = 0
        for c in t:
            if c.isascii() and c.isalpha():
                n += 1
                best = max(best, n)
            elif not c.isspace():
                n = 0
        return best

    known = [t for t in TEXTS if t is not None]
    assert out(df, text.script_letter_ratio("c")) == [ratio(t) if t is not None else None for t in TEXTS]
    assert [x for x, t in zip(out(df, text.longest_latin_run("c")), TEXTS) if t is not None] == [run(t) for t in known]
    assert [x for x, t in zip(out(df, text.word_count("c")), TEXTS) if t is not None] == [len(t.split()) for t in known]
    assert [x for x, t in zip(out(df, text.strip("c")), TEXTS) if t is not None] == [t.strip() for t in known]
    assert all(unicodedata.category(c)[0] == "L" for c in "abcన")


@pytest.mark.parametrize("english, telugu, reason", [
    ("I visited the store.", "  ", "empty_translation"), ("I visited the store.", None, "empty_translation"), ("I visited the store.", "nenu dukananiki vellanu.", "script_ratio"),
    ("x" * 60, "క" * 40 + "abcdefghijklmnopqrstuvwxyz", "latin_run"), ("e" * 100, "క" * 49, "too_short"), ("e" * 100, "క" * 50, None), ("e" * 10, "క" * 31, "too_long"), ("e" * 10, "క" * 30, None),
    ("Pay 15 now", "నేను కొన్నాను", "numbers_lost"), ("Pay 5 now", "15 కొన్నాను", None), ("Use Bluetooth", "నేను Bluetooth వాడుతున్నాను ఇప్పుడు", None), ("", "కొన్నాను", None),
])
def test_rules(spark, english, telugu, reason):
    df = spark.createDataFrame([(english, telugu)], "e string, t string")
    assert out(df, validation.rule_reason("e", "t")) == [reason]


def test_decisions(spark):
    base = {d: 0.95 for d in scores.TRANSLATION_THRESHOLDS}
    cases = [(base, 0.8, "PASS", 0), (base | {"grammar": 0.85}, 0.9, "PASS", 0), (base | {"grammar": 0.8499}, 0.9, "FAIL", 1), (base | {"grammar": "0.9"}, 0.9, "PASS", 0), (base | {"grammar": "good"}, 0.9, "FAIL", 1), (base, None, "FAIL", 1), (base | {"completeness": 0.1, "grammar": 0.1}, 0.1, "FAIL", 3)]
    df = spark.createDataFrame([tuple(str(v) for v in s.values()) + (sim,) for s, sim, *_ in cases], ", ".join(f"{d} string" for d in base) + ", sim double")
    got = df.select(scores.decide({d: F.col(d) for d in base}, scores.TRANSLATION_THRESHOLDS, F.col("sim")).alias("g")).select("g.*").collect()
    assert [(r["decision"], len(r["failures"])) for r in got] == [c[2:] for c in cases]
    assert got[4]["overall"] == 0 and abs(got[0]["overall"] - 0.95) < 1e-12 and got[6]["reason"].count(";") == 2


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0])], "a array<float>, b array<float>")
    got = out(df, vectors.cosine("a", "b"))
    assert abs(got[0] - 0.5**0.5) < 1e-9 and got[1:] == [0.0, None]
    df = spark.createDataFrame([([1.0, 0.0], [[0.0, 1.0], [1.0, 0.1], [1.0, 0.0]])], "a array<double>, k array<array<double>>")
    assert out(df, vectors.first_near("a", "k", 0.9)) == [1] and out(df, vectors.first_near("a", "k", 1.1)) == [-1]


def test_sql_functions(spark):
    text.register_sql_functions(spark)
    r = spark.sql("SELECT kolam_word_count(' a  b '), kolam_latin_run('ab c-d'), kolam_numbers_lost('1 22', 'x 1'), kolam_cosine(array(1D, 0D), array(1D, 0D)), kolam_telugu_ratio('aక'), kolam_strip(' x ')").first()
    assert list(r) == [2, 3, ["22"], 1.0, 0.5, "x"]


def test_names(spark):
    df = column(spark, [" Daily  Life\t", "NaN", "", None, "A"])
    assert out(df, norm_name("c")) == ["daily life", "nan", "", None, "a"] and out(df, present_name("c")) == ["daily life", None, None, None, "a"]
    assert out(column(spark, [0.0, 1.0, 1.1, -0.1, float("nan"), None], "double"), usable_similarity("c")) == [0.0, 1.0, None, None, None, None]


def test_current_rows(spark):
    df = spark.createDataFrame([("a", 1, 1, "x"), ("a", 3, 1, "late"), ("a", 3, 2, "again"), ("a", 2, 9, "old"), (None, 1, 1, "n"), ("b", None, 1, "only")], "sentence_id string, updated_at int, loaded_at int, v string")
    assert sorted(map(tuple, current_rows(df, ["v"]).collect())) == [("a", "again"), ("b", "only")]


def test_greedy_equals_the_sequential_rule(spark):
    rng = random.Random(1)
    data = [(rng.choice("ab"), i, [rng.gauss(0, 1) for _ in range(4)], rng.random() < 0.1) for i in range(300)] + [("c", 1, [0.0] * 4, False), ("c", 2, [0.0] * 4, False), (None, 3, [1.0] * 4, False), ("c", 4, None, False)]
    df = spark.createDataFrame(data, "k string, o int, v array<double>, past boolean")

    def cosine(a, b):
        n = (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
        return sum(x * y for x, y in zip(a, b)) / n if n else 0.0

    for threshold, history in ((0.6, None), (0.9, None), (0.8, "past")):
        kept = {}
        for k, o, v, past in sorted(data, key=lambda r: (str(r[0]), not (history and r[3]), r[1])):
            mine = kept.setdefault(k, [])
            if k is None or v is None or (history and past) or not any(w is not None and cosine(v, w) >= threshold for _, w in mine):
                mine.append((o, v))
        for how in ({}, {"small": 0}, {"small": 0, "rounds": 0}, {"small": 150, "rounds": 1}):
            got = neardup.greedy_near_duplicates(df, "k", "o", "v", threshold, history=history, **how).collect()
            assert {(r["k"], r["o"]) for r in got if r["kept"]} == {(k, o) for k, rows in kept.items() for o, _ in rows}
            assert len(got) == len(data)


@pytest.mark.parametrize("small", [10_000, 100])
def test_greedy_ends_on_long_chains(spark, small):
    """Each vector is near its neighbours only, so every second one goes: 5,000 links one after another."""
    n, step = 5001, math.pi / 2 / 5001
    df = spark.createDataFrame([(1, i, [math.cos(i * step), math.sin(i * step)]) for i in range(n)], "k int, o int, v array<double>")
    got = neardup.greedy_near_duplicates(df, "k", "o", "v", math.cos(1.5 * step), small=small)
    assert sorted(r["o"] for r in got.where("kept").collect()) == list(range(0, n, 2))


def test_chunks_and_positions(spark):
    df = spark.createDataFrame([(i * 3,) for i in range(103)], "x int").repartition(7)
    got = sorted(map(tuple, keyed.chunks(df, "x", 10, 4).select("x", "pos", "chunk_id", "pos_in_chunk", "job_id").collect()))
    assert got == [(i * 3, i, i // 10, i % 10, i // 40) for i in range(103)]
    assert keyed.chunks(df.limit(0), "x", 10).count() == 0
    with pytest.raises(ValueError):
        keyed.chunks(df, "x", 0)


def test_keyed(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 1, "y"), (None, 1, "n"), (None, 2, "m")], "k string, o int, v string")
    assert set(map(tuple, keyed.last_wins(df, "k", "o").collect())) == {("a", 2, None), ("b", 1, "y"), (None, 2, "m")}
    assert set(map(tuple, keyed.first_wins(df, "k", "o").collect())) == {("a", 1, "x"), ("b", 1, "y"), (None, 1, "n")}
    got = keyed.answered_or_failed(column(spark, ["a", "z"]).withColumnRenamed("c", "k"), df.where("k is not null"), "k", "o")
    assert {(r["k"], r["status"]) for r in got.collect()} == {("a", "OK"), ("z", "FAILED")}
    log = spark.createDataFrame([(1, 2, ["c"], "late"), (1, 1, ["a", "b"], "first"), (2, 1, [], "none")], "k int, o int, i array<string>, d string")
    assert sorted(map(tuple, keyed.merge_candidates(log, "k", "o", "i", ["d"]).collect())) == [(1, "first", 0, "a"), (1, "first", 1, "b"), (1, "first", 2, "c")]
    ids = keyed.renumber(spark.createDataFrame([(4, "x"), (4, "y"), (5, "z")], "k int, o string"), "k", "o", base=F.lit(2))
    assert sorted(r["sentence_id"] for r in ids.collect()) == ["4_3", "4_4", "5_3"]


@pytest.mark.parametrize("payload, expected", [
    ('[{"row_id": 1, "sentences": [{"sentence": "s"}]}]', ("OK", None)), ('{"records": [{"row_id": 1, "sentences": [{"sentence": "s"}]}]}', ("OK", None)), ('{"row_id": 1, "sentences": [{"sentence": "s"}]}', ("OK", None)),
    ("{bad", ("FAILED", "malformed_response")), ("null", ("FAILED", "malformed_response")), ("7", ("FAILED", "malformed_response")), ("[]", ("FAILED", "omitted")), ('[{"row_id": 2, "sentences": []}]', ("FAILED", "omitted")),
    ('[{"row_id": 1, "sentences": []}]', ("FAILED", "no_sentences")), ('[{"row_id": 1, "sentences": []}, {"row_id": 1, "sentences": [{"sentence": "late"}]}]', ("OK", None)),
    (None, ("FAILED", "malformed_response")),
])
def test_generation_responses(spark, payload, expected):
    asked = spark.createDataFrame([(0, 1)], "chunk_id bigint, row_id int")
    got = parsing.parse_generation(spark.createDataFrame([(0, payload)], "chunk_id bigint, response string"), asked).first()
    assert (got["status"], got["reason"]) == expected
    none = parsing.parse_generation(spark.createDataFrame([], "chunk_id bigint, response string"), asked).first()
    assert (none["status"], none["reason"]) == ("FAILED", "no_response")


def test_other_responses(spark):
    r = lambda *texts: spark.createDataFrame(list(enumerate(texts)), "chunk_id bigint, response string")
    got = parsing.parse_translations(r('{"translations": [{"sentence_id": "a", "telugu_sentence": " x "}, {"sentence_id": "a", "telugu_sentence": "y"}, {"sentence_id": "b", "telugu_sentence": " "}, {"sentence_id": "c", "status": "FAILED"}]}', "{", "[]"))
    assert [tuple(x) for x in got.collect()] == [(0, "a", "y")]
    e = {"sentence_id": "a", "grammar": "0.9", "decision": "FAIL", "telugu_romanized": "  "}
    got = parsing.parse_judgements(r(json.dumps({"evaluations": [{"row_id": 1, "results": [e, {"sentence_id": "b", "grammar": 1}]}]}), json.dumps(e), json.dumps([e])), ["grammar", "completeness"])
    assert {(x["chunk_id"], x["sentence_id"], x["grammar"], x["completeness"], x["telugu_romanized"]) for x in got.collect()} == {(0, "a", "0.9", None, None), (0, "b", "1", None, None), (1, "a", "0.9", None, None), (2, "a", "0.9", None, None)}


def test_vocabulary(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text(' Domain ,CATEGORY,Word\nA,B, Store \n,B,NA\nC,,C++\nD,E,"two\nlines"\nD,E, \n', encoding="utf-8")
    got = [tuple(r) for r in words.read_words(spark, str(path)).orderBy("row_id").collect()]
    assert got == [(1, "A", "B", "Store"), (3, "C", "nan", "C++"), (4, "D", "E", "two\nlines")]
    with pytest.raises(ValueError, match="word"):
        words.clean_words(spark.createDataFrame([("a", "b")], "domain string, category string"))
    with pytest.raises(ValueError, match="csv"):
        words.read_words(spark, "w.txt")


def test_jsonl(spark, tmp_path):
    assert jsonl.read_jsonl(spark, str(tmp_path / "none"), "a INT").count() == 0
    df = spark.createDataFrame([(1, "తె", None)], "a int, b string, c string")
    export.append_jsonl(df, str(tmp_path / "log"))
    export.append_jsonl(df, str(tmp_path / "log"))
    assert [tuple(r) for r in jsonl.read_jsonl(spark, str(tmp_path / "log"), "a INT, b STRING, c STRING").collect()] == [(1, "తె", None)] * 2
    assert '"c":null' in "".join(p.read_text() for p in (tmp_path / "log").glob("*.json")) and "తె" in "".join(p.read_text() for p in (tmp_path / "log").glob("*.json"))
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n\n{"a"\n')
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "a INT").collect()


def test_snapshots(spark, tmp_path):
    s = state.Snapshots(spark, str(tmp_path / "s"))
    assert s.current() is None and s.read("a INT").count() == 0
    for i in range(5):
        s.write(s.read("a INT").unionByName(spark.createDataFrame([(i,)], "a int")))
    assert s.current() == 5 and sorted(r[0] for r in s.read("a INT").collect()) == [0, 1, 2, 3, 4] and s.versions() == [3, 4, 5]
    spark.createDataFrame([(9,)], "a int").write.parquet(str(tmp_path / "s" / "v=6"))  # a crash before the version became current
    assert s.read("a INT").count() == 5 and s.write(spark.createDataFrame([(1,)], "a int")).count() == 1


def test_word_states(spark):
    s = spark.createDataFrame([(1, "pending", 3), (2, "pending", 3), (3, "exhausted", 3), (4, "pending", 1)], "row_id int, status string, rounds_attempted int").withColumn("accepted_count", F.lit(0))
    done = state.finish_words(s, spark.createDataFrame([(1,)] * 3 + [(3,)] * 5, "row_id int"), 3, 3)
    assert {(r["row_id"], r["status"], r["accepted_count"]) for r in done.collect()} == {(1, "complete", 3), (2, "exhausted", 0), (3, "exhausted", 5), (4, "pending", 0)}
    again = {r["row_id"]: (r["status"], r["rounds_attempted"]) for r in state.reset_exhausted(done).collect()}
    assert again[2] == ("pending", 0) and again[1] == ("complete", 3)
    assert [r["row_id"] for r in state.words_needing_work(done, 3).collect()] == [4]


def test_retry_and_breaker():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("busy")
        return "ok"

    assert with_retry(flaky, sleep=waits.append) == "ok" and len(waits) == 2
    assert 0.8 * 2 <= waits[0] <= 1.2 * 2 and backoff(9, luck=lambda: 0.5) == 30.0
    with pytest.raises(RuntimeError):
        with_retry(lambda: (_ for _ in ()).throw(RuntimeError("PERMISSION_DENIED")), sleep=waits.append)
    assert len(waits) == 2 and is_permanent("reason: API_KEY_INVALID")
    b = Breaker(2)
    b.failed(RuntimeError("x"))
    with pytest.raises(CircuitOpen):
        b.failed(RuntimeError("x"))
    with pytest.raises(ValueError):
        provider("nobody")
    assert status_of("JOB_STATE_RUNNING") is Status.RUNNING and status_of("completed").usable and not status_of("expired").usable


class SlowProvider(ReplayProvider):
    """Each job needs two looks; every third submission fails."""

    def __init__(self):
        super().__init__(lambda p: p.upper())
        self.looks, self.tries, self.most = {}, 0, 0

    def submit(self, payloads):
        self.tries += 1
        if self.tries % 3 == 0:
            raise RuntimeError("busy")
        job = super().submit(payloads)
        self.looks[job] = 2
        self.most = max(self.most, sum(v > 0 for v in self.looks.values()))
        return job

    def status(self, job):
        self.looks[job] -= 1
        return Status.SUCCEEDED if self.looks[job] <= 0 else Status.RUNNING


def test_pool():
    p, got = SlowProvider(), {}
    pool = Pool(p, lambda c: {k: f"c{k}" for k in c}, max_jobs=2, chunk_budget=6, sleep=lambda s: None)
    for i in range(0, 20, 4):
        pool.add(list(range(i, i + 4)))
    pool.fill()
    kept = pool.control()
    again = Pool(p, pool.payloads, max_jobs=2, chunk_budget=6, sleep=lambda s: None)
    again.restore(kept)
    again.drain(lambda chunks, answers, status: got.update(answers))
    assert got == {k: f"C{k}" for k in range(20)} and p.most <= 2


def test_config(tmp_path):
    c = overlay(Config(), {"translation": {"unit_size": 5, "rules": {"max_latin_run": 3}}})
    assert c.translation.unit_size == 5 and c.translation.rules.max_latin_run == 3 and c.generation.batch_size == 25
    with pytest.raises(ValueError):
        overlay(Config(), {"nothing": 1})


def test_requests():
    from kolam.providers.requests import ClientProvider, Style, batch_lines, chat_request, chunk_of

    r = chat_request('[{"a": "తె"}]', "be brief", "m", Style("records", 0.9, 10, "LOW"))
    assert r["temperature"] == 0.9 and r["response_format"] and '"records"' in r["messages"][1]["content"] and r["thinking_level"] == "LOW"
    assert "temperature" not in chat_request("[]", "p", "m", Style(temperature=1)) and "response_format" not in chat_request("[]", "p", "m")
    lines = batch_lines({3: "[]", 1: "తె"}, "p", "m")
    assert [json.loads(x)["custom_id"] for x in lines] == ["chunk-1", "chunk-3"] and "తె" in lines[0]
    assert chunk_of("chunk-12") == 12 and chunk_of("12") is None and chunk_of("chunk-x") is None
    p = ClientProvider("n", "m", "p", lambda q: "ok", lambda ls: f"job{len(ls)}", lambda j: "completed", lambda j: [("chunk-1", "a"), ("chunk-2", None), ("odd", "b")])
    job = p.submit({1: "x", 2: "y"})
    assert p.complete("x") == "ok" and p.status(job) is Status.SUCCEEDED and p.fetch(job) == {1: "a"}
