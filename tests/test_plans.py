"""The pipelines with stored responses, from an empty folder and taken up again; the queries against their SQL."""

import glob
import json

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kolam.functions.embedding import hashing_embedder
from kolam.functions.scores import SENTENCE_THRESHOLDS, TRANSLATION_THRESHOLDS
from kolam.plans.generation import GenerationRun
from kolam.plans.queries import ORACLES, QUERIES
from kolam.plans.translation import TranslationRun
from kolam.providers.base import ReplayProvider
from kolam.streaming.raw_log import gate_new_records

SMALL = "/root/testdata/sf0.001"


def generator():
    calls = []
    thing = ["red lamp", "old boat", "green hill", "quiet garden", "broken clock", "wet stone"]

    def answer(payload):
        asked = json.loads(payload)
        calls.append([a["row_id"] for a in asked])
        out = []
        for a in asked:
            if a["word"] == "lost":
                continue
            n = len(calls)
            texts = [f"My {a['word']} stood behind the {thing[(i + n) % 6]} number {i * n} all day." for i in range(4)]
            texts += [texts[0], "no target here", " "]
            out.append({"row_id": a["row_id"], "sentences": [{"sentence": t, "context": "c"} for t in texts]})
        return json.dumps({"records": out})

    return ReplayProvider(answer, "gen", "m1"), calls


def judge(bad="number 0 "):
    def answer(payload):
        out = [{"sentence_id": s["sentence_id"], "decision": "PASS", **{d: 0.5 if bad in s["sentence"] else 0.95 for d in SENTENCE_THRESHOLDS}} for s in json.loads(payload)]
        return json.dumps({"evaluations": out})

    return ReplayProvider(answer, "judge", "m2")


@pytest.mark.parametrize("sync", [False, True])
def test_generation(spark, tmp_path, sync):
    g, calls = generator()
    words = spark.createDataFrame([(1, "A", "B", "kettle"), (2, "A", "B", "lost"), (5, "A", "B", "C++")], "row_id int, domain string, category string, word string")
    run = GenerationRun(spark, str(tmp_path), g, judge(), hashing_embedder(), sync=sync)
    got = run.run(words).collect()
    per = {}
    for r in got:
        per.setdefault(r["row_id"], []).append(r["sentence_id"])
        assert r["word"].lower() in r["sentence"].lower() and r["overall_score"] == 0.95 and "number 0 " not in r["sentence"]
    assert set(per) == {1, 5} and all(len(v) == len(set(v)) >= 3 for v in per.values())
    from kolam.plans.generation import REJECTED, WORD_STATE

    st = {r["row_id"]: (r["status"], r["rounds_attempted"]) for r in run.words.read(WORD_STATE).collect()}
    assert st[2] == ("exhausted", 3) and st[1][0] == "complete"
    assert {r["stage"] for r in run.rejected.read(REJECTED).collect()} == {"generation", "structural_validation", "near_duplicate", "judge"}
    if not sync:
        n = len(calls)
        assert n == 3  # lost is asked for in three rounds
        GenerationRun(spark, str(tmp_path), g, judge(), hashing_embedder()).run(words)
        assert len(calls) == n  # nothing is asked for twice


def test_replay(spark, tmp_path):
    words = spark.createDataFrame([(1, "A", "B", "kettle")], "row_id int, domain string, category string, word string")
    g = ReplayProvider(lambda p: "{", "gen", "m")
    run = GenerationRun(spark, str(tmp_path), g, judge(), hashing_embedder())
    import dataclasses

    run.config = dataclasses.replace(run.config, generation=dataclasses.replace(run.config.generation, max_generation_rounds=1))
    run.words.write(spark.createDataFrame([(1, "A", "B", "kettle", "pending", 1, 0, 0)], "row_id int, domain string, category string, word string, status string, rounds_attempted int, accepted_count int, minted int"))
    log = spark.createDataFrame([(2, 1, [("The kettle sang loudly again.", "x")]), (1, 1, [("A kettle boils slowly here.", None), ("Nothing to see.", "")]), (3, 9, [("kettle", "")])], "ord long, row_id int, sentences array<struct<sentence:string,context:string>>")
    got = sorted((r["sentence_id"], r["sentence"]) for r in run.replay(log).collect())
    assert got == [("1_1", "A kettle boils slowly here."), ("1_3", "The kettle sang loudly again.")]
    assert words.count() == 1


def test_translation(spark, tmp_path):
    telugu = {"s1": "నేను నిన్న దుకాణానికి వెళ్ళాను", "s2": "నేను నిన్న దుకాణానికి వెళ్ళాను", "s3": "english only text here", "s4": "పిల్లి మెల్లగా చెట్టు ఎక్కింది 7", "s5": ""}
    first = ReplayProvider(lambda p: json.dumps({"translations": [{"sentence_id": x["sentence_id"], "telugu_sentence": telugu[x["sentence_id"]]} for x in json.loads(p)]}), "one", "small")
    second = ReplayProvider(lambda p: json.dumps([{"sentence_id": x["sentence_id"], "telugu_sentence": "కొత్త అనువాదం " + "ఇది" * int(x["sentence_id"][1:]) + " మంచిది ఇప్పుడు"} for x in json.loads(p)]), "two", "large")

    def answer(payload):
        return json.dumps({"evaluations": [{"sentence_id": x["sentence_id"], "telugu_romanized": " r ", **{d: 0.95 for d in TRANSLATION_THRESHOLDS}} for x in json.loads(payload)]})

    same = lambda c: F.array(F.lit(1.0).cast("float"), F.lit(0.5).cast("float"))
    run = TranslationRun(spark, str(tmp_path), first, second, ReplayProvider(answer, "judge", "jm"), same, hashing_embedder())
    run.embed_source = run.embed_target = hashing_embedder()
    run.config = __import__("dataclasses").replace(run.config, translation=__import__("dataclasses").replace(run.config.translation, semantic_similarity_threshold=-1.0))
    rows = [(f"s{i}", 1 if i < 3 else i, "D", "C", "w", e) for i, e in enumerate(["", "I went to the store yesterday", "I walked to the shop yesterday", "The dog sleeps well today ok", "The cat climbed 7 trees slowly", "Birds sing in the early morning"])][1:]
    got = {r["sentence_id"]: r for r in run.run(spark.createDataFrame(rows, "sentence_id string, row_id int, domain string, category string, word string, english_sentence string")).collect()}
    assert got["s1"]["translation_model"] == "small" and got["s4"]["translation_provider"] == "one" and got["s1"]["status"] == "accepted" and got["s1"]["telugu_romanized"] == "r"
    assert {k for k, r in got.items() if r["translation_provider"] == "two"} == {"s2", "s3", "s5"} & set(got) and "s3" in got and "s5" in got
    from kolam.plans.translation import REJECTED

    assert {(r["sentence_id"], r["stage"]) for r in run.rejected.read(REJECTED).collect()} >= {("s2", "near_duplicate"), ("s3", "rules")}
    with pytest.raises(ValueError):
        run.run(spark.createDataFrame(rows[:1] * 2, "sentence_id string, row_id int, domain string, category string, word string, english_sentence string"))


def test_stream(spark, tmp_path):
    log = tmp_path / "log"
    rows = spark.createDataFrame([(1, "kettle", [("A kettle.", "")]), (2, "x", [("nothing", ""), (" ", "")])], "row_id int, word string, sentences array<struct<sentence:string,context:string>>")
    rows.write.json(str(log))
    seen = []
    q = gate_new_records(spark, str(log), str(tmp_path / "cp"), lambda ok, bad, n: seen.append((ok.count(), sorted(r["reason"] for r in bad.collect()))))
    q.processAllAvailable()
    rows.write.mode("append").json(str(log))
    q.processAllAvailable()
    q.stop()
    assert sum(s[0] for s in seen) == 2 and sorted(sum((s[1] for s in seen), [])) == ["empty_sentence"] * 2 + ["target_word_missing"] * 2


def plain(v):
    if isinstance(v, float):
        return round(v, 9)  # NaN stays, and equals nothing
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{SMALL}/*.parquet"):
        c.execute(f"CREATE VIEW {f.split('/')[-1][:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_equal_their_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    r = duck.sql(ORACLES[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    mine = sorted((tuple(map(plain, x)) for x in df.select(*cols).collect()), key=str)
    assert mine == sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=str)


def test_entry(spark):
    assert entry.entry(spark).count() > 0 and set(entry.oracle_sql()) <= set(entry.queries())


def test_command_line(spark, tmp_path):
    from kolam.cli import main, parser

    (tmp_path / "w.csv").write_text("Domain,Category,Word\nA,B,kettle\nA,B,\n", encoding="utf-8")
    (tmp_path / "c.yaml").write_text("generation:\n  max_generation_rounds: 1\n", encoding="utf-8")
    main(["generate", str(tmp_path / "out"), str(tmp_path / "w.csv"), "--config", str(tmp_path / "c.yaml")], spark, {"generator": generator()[0], "judge": judge()})
    got = spark.read.csv(str(tmp_path / "out" / "final_sentences"), header=True).collect()
    assert len(got) >= 3 and {r["word"] for r in got} == {"kettle"} and {r["row_id"] for r in got} == {"1"}
    assert parser().parse_args(["translate", "f", "i", "--limit", "5"]).limit == 5
    with pytest.raises(ValueError):
        main(["generate", str(tmp_path / "out2"), str(tmp_path / "w.csv")], spark)


def test_shared_folder_needs_its_setting_on_a_cluster():
    from types import SimpleNamespace

    from kolam.scratch import shared_folder

    def session(master, named=None):
        conf = SimpleNamespace(get=lambda *a: named)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(getConf=lambda: conf, master=master, applicationId="x"))

    assert shared_folder(session("spark://a", "hdfs://b/c/")) == "hdfs://b/c"
    with pytest.raises(ValueError):
        shared_folder(session("spark://a"))
