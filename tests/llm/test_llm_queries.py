"""The problems' queries on the smallest tables, against SQL where there is some, else against brute force over whole tables."""

import collections
import glob
import math

import duckdb
import pandas as pd
import pytest

from kolam.llm import queries as q
from kolam.llm.lookalikes import same_look
from kolam.llm.wordsets import hashed_words

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        c.execute(f"CREATE VIEW {f.split('/')[-1][:-8]} AS SELECT * FROM '{f}'")
    return c


def current(duck, table, columns):
    return duck.sql(f"SELECT {columns} FROM {table} WHERE sentence_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sentence_id ORDER BY updated_at DESC, loaded_at DESC) = 1").fetchall()


def found(spark, name, *columns):
    rows = [tuple(r) for r in q.queries()[name](spark, SMALL).select(*columns).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("name", list(q.oracle_sql()))
def test_queries_equal_their_sql(spark, duck, name):
    r = duck.sql(q.oracle_sql()[name])
    assert found(spark, name, *r.columns) == set(r.fetchall())


def pairs_of(groups):
    return {(min(a, b), max(a, b)) for g in groups for a in g for b in g if a != b}


def test_p2_found(spark, duck):
    true = set()
    for field, table in (("sentence", "final_sentences"), ("telugu_sentence", "final_translations")):
        sets = {i: frozenset(hashed_words(same_look(t) if field[0] == "t" else t)) for i, t in current(duck, table, f"sentence_id, {field}") if t and t.strip()}
        parent = {i: i for i in sets}

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        ids = sorted(sets)
        for n, i in enumerate(ids):
            for j in ids[:n]:
                if len(sets[i] & sets[j]) >= 0.6 * len(sets[i] | sets[j]) - 1e-12:
                    parent[top(i)] = top(j)
        groups = collections.defaultdict(list)
        for i in ids:
            groups[top(i)].append(i)
        true |= {(field, *p) for p in pairs_of(groups.values())}
    assert found(spark, "p2_found", "field_name", "id_a", "id_b") == true


def test_p4_found(spark, duck):
    rows = [(i, *[(s or {}).get(k) for k in q.SCORES], o, v) for i, s, o, v in current(duck, "final_translations", "sentence_id, scores, overall_score, semantic_similarity")]
    rows = [r for r in rows if all(x is not None and not math.isnan(x) for x in r[1:]) and 0 <= r[-1] <= 1]
    x = pd.DataFrame(rows)
    mean = x.iloc[:, 1:].rank(pct=True).mean(axis=1)
    assert found(spark, "p4_found", "sentence_id") == {(i,) for i in x.loc[mean.sort_values(ascending=False).index[: len(x) // 50], 0]}


def test_p6_found(spark, duck):
    true = set()
    for field in ("telugu_sentence", "telugu_romanized"):
        forms = collections.defaultdict(list)
        for i, t in current(duck, "final_translations", f"sentence_id, {field}"):
            if t and t.strip():
                forms[same_look(t)].append((i, t))
        true |= {(field, min(a, b), max(a, b)) for g in forms.values() for a, s in g for b, t in g if s != t}
    assert found(spark, "p6_found", "field_name", "id_a", "id_b") == true


def test_p7_found(spark, duck):
    rows = [(i, r, b, " ".join((st or "").split()).lower() == "complete", frozenset(hashed_words(same_look(t)))) for i, r, b, st, t in current(duck, "final_translations", "sentence_id, row_id, batch_no, status, telugu_sentence") if t and t.strip() and r is not None]
    true = {(i,) for i, r, b, _, s in rows if any(r2 == r and ok and b2 < b and len(s & s2) >= 0.6 * len(s | s2) - 1e-12 for _, r2, b2, ok, s2 in rows)}
    assert found(spark, "p7_found", "sentence_id") == true


def test_p8_and_p9(spark, duck):
    packed = q.p8_containers(spark, SMALL).toPandas()
    assert packed.groupby("container")["size"].sum().max() <= 2048
    big = packed.groupby("doc_id")["size"].sum()
    assert found(spark, "p8_found", "doc_id") == {(int(i),) for i in big.index[big > 2048]}
    report = q.p8_report(spark, SMALL).first()
    assert report["filled"] > 0.95 and report["tokens"] == packed["size"].sum()
    mix = q.p9_report(spark, SMALL).toPandas()
    total = mix["size"].sum()
    assert found(spark, "p9_found", "source") == {(r["source"],) for r in mix.to_dict("records") if r["size"] * r["max_copies"] < r["target_share"] * total}
    assert abs(mix["actual_share"].sum() - 1) < 1e-9


def test_p10_by_script(spark, duck):
    """Documents in a script of one language have that language, whatever their label says."""
    texts = {i: t for i, t in duck.sql("SELECT doc_id, text FROM documents").fetchall() if t and t.strip()}
    got = collections.defaultdict(set)
    for r in q.p10_segments(spark, SMALL).collect():
        got[r["doc_id"]].add(r["lang"])
    assert set(got) == set(texts)
    for i, t in texts.items():
        for lang, (lo, hi) in {"te": (0xC00, 0xC7F), "hi": (0x900, 0x97F), "ta": (0xB80, 0xBFF)}.items():
            if sum(lo <= ord(c) <= hi for c in t) > 0.9 * sum(not c.isspace() for c in t) * 0.9:
                assert lang in got[i]
