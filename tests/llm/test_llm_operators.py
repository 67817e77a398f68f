"""Each operator against a brute-force version, and its edge cases: nulls, empty and long texts, ties, repeats, empty tables."""

import collections
import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kolam.llm import neardup
from kolam.llm.components import connected_components, split_whole_components
from kolam.llm.cutoffs import keep_fraction_cutoffs
from kolam.llm.history import PivotHistory, history_table, repeats_of_history
from kolam.llm.languages import Automaton, Languages, fit_languages, label_language, language_segments, sentences
from kolam.llm.lookalikes import look_alikes, published_pairs, same_look, same_look_column
from kolam.llm.mixing import filling_rounds, mix_sources, water_filling
from kolam.llm.neardup import band_pairs, band_rows, dart_signatures, near_duplicate_groups
from kolam.llm.packing import GAP, ITEM, bracket_pairs, pack, successor_sweep
from kolam.llm.ranking import first_places, rank_walk
from kolam.llm.sampling import calibrated_gaps, pivotal, proportional_sample, target_report, whole_numbers
from kolam.llm.tokens import token_count
from kolam.llm.wordsets import hashed_words, word_set
from kolam.scratch import Scratch


def rows(df):
    return [tuple(r) for r in df.collect()]


# 1
def test_cutoffs_equal_sorting(spark):
    rng = random.Random(1)
    data = [(rng.choice(["A", " a ", "b", "B\t", None, "hot"]), rng.choice([None, float("nan"), *[round(rng.random(), 2) for _ in range(8)]]), "clash") for _ in range(6000)]
    values = spark.createDataFrame(data, "domain string, value double, n string")
    targets = spark.createDataFrame([("A", 0.5), ("B", 0.3), ("Hot", 0.0), ("none", 0.5), ("b", 1.0), ("hot", None), (None, 0.5)], "domain string, keep_fraction double")
    got = {(r["domain"], r["keep_fraction"]): r for r in keep_fraction_cutoffs(values, targets, finish_at=5).collect()}
    by = collections.defaultdict(list)
    for d, v, _ in data:
        if d is not None and v is not None and not math.isnan(v):
            by[d.strip().lower()].append(v)
    for name, f in (("A", 0.5), ("B", 0.3), ("Hot", 0.0), ("b", 1.0)):
        xs = sorted(by[name.lower()], reverse=True)
        cut = xs[max(1, math.ceil(f * len(xs))) - 1]
        r = got[(name, f)]
        assert (r["n"], r["cutoff"], r["n_kept"]) == (len(xs), cut, sum(x >= cut for x in xs))
    assert got[("none", 0.5)]["cutoff"] is None and got[("hot", None)]["n_kept"] == 0


def test_cutoffs_of_nothing(spark):
    empty = spark.createDataFrame([], "domain string, value double")
    targets = spark.createDataFrame([("A", 0.5)], "domain string, keep_fraction double")
    assert rows(keep_fraction_cutoffs(empty, targets)) == [("A", 0.5, 0, 0, None, 0)]


# 2
def brute_groups(texts, threshold):
    sets = [frozenset(hashed_words(t)) for t in texts]
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-12:
                parent[top(i)] = top(j)
    out = collections.defaultdict(set)
    for i in range(len(sets)):
        out[top(i)].add(i)
    return {frozenset(v) for v in out.values()}


def edited_texts(n, seed, words=400):
    rng = random.Random(seed)
    texts = []
    while len(texts) < n:
        base = [f"w{int(words * rng.random() ** 2)}" for _ in range(rng.randint(12, 25))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 3])):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(words)}"
            if rng.random() < 0.3:
                rng.shuffle(copy)
            texts.append((" ".join(copy) + rng.choice(["", ".", "!"])).title())
    return texts[:n]


@pytest.mark.parametrize("hot", [20_000, 3])
def test_groups_equal_brute_force(spark, hot):
    texts = edited_texts(500, 4) + ["same words here again today"] * 30 + ["", "...", "...", None, "x" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumns({c: F.lit("clash") for c in ("group", "component", "id", "a", "band")})
    got = near_duplicate_groups(df.withColumn("words", word_set("text")), bands=60, hot=hot).select("i", "group").collect()
    groups = collections.defaultdict(set)
    for r in got:
        groups[r["group"]].add(r["i"])
    keep = [i for i, t in enumerate(texts) if t is not None]
    expected = {frozenset(keep[i] for i in g) for g in brute_groups([texts[i] for i in keep], 0.6)}
    assert {frozenset(g) for g in groups.values()} == expected


@pytest.fixture
def one_task_of_small_batches(spark):
    names = {"spark.sql.shuffle.partitions": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "100"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def brute_bands(rows, hot):
    """The pairs of the bands of at most hot rows, and the (band, id) of the others; for rows that all pass the filter."""
    by = collections.defaultdict(list)
    for r in rows:
        by[r["band"]].append(r["id"])
    pairs = {(min(x, y), max(x, y)) for ids in by.values() if len(ids) <= hot for n, x in enumerate(ids) for y in ids[:n]}
    return pairs, sorted((b, i) for b, ids in by.items() if len(ids) > hot for i in ids)


def found_bands(rows, hot):
    got = band_pairs(rows, 0.6, hot).collect()
    return {(r["a"], r["b"]) for r in got if r["a"] is not None}, sorted((r["band"], r["id"]) for r in got if r["id"] is not None)


@pytest.mark.parametrize("offset", [0, 1, 30, 60, 99, 150, 250])
def test_hot_bands_are_kept_wherever_they_lie(spark, one_task_of_small_batches, offset):
    bands = [n // 3 for n in range(offset)] + [1000] * 250 + [1001] * 199 + [1002] * 201 + [1003] * 2
    made = spark.createDataFrame([(b, i, 0, 12 << 40) for i, b in enumerate(bands)], "band long, id long, bits long, mark long")
    assert found_bands(made, 200) == brute_bands(made.collect(), 200)


def test_hot_bands_of_signatures_are_kept(spark, one_task_of_small_batches):
    base = list(range(100, 140))
    sets = [sorted(base[:i % 7] + base[i % 7 + 1:] + [1000 + i]) for i in range(260)] + [list(range(5000 + 40 * i, 5040 + 40 * i)) for i in range(40)]
    nodes = spark.createDataFrame(list(enumerate(sets)), "id long, words array<int>")
    made = band_rows(nodes, (np.zeros(0, np.int64), np.zeros(0)), 3, 30)
    pairs, hot = brute_bands(made.collect(), 30)
    assert hot and found_bands(made, 30) == (pairs, hot)


def groups_by_number(df, **how):
    groups = collections.defaultdict(set)
    for r in near_duplicate_groups(df.withColumn("words", word_set("text")), **how).select("i", "group").collect():
        groups[r["group"]].add(r["i"])
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("crowd", [1000, 4])
def test_pairs_of_common_words_are_found(spark, crowd):
    rng = random.Random(6)
    chosen = rng.sample(list(itertools.combinations([f"c{i}" for i in range(12)], 6)), 200)
    texts = [" ".join([*six, f"x{i}a{k}", f"x{i}b{k}"]) for i, six in enumerate(chosen) for k in range(2)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    expected = brute_groups(texts, 0.6)
    assert len(expected) == 200
    assert groups_by_number(df, crowd=crowd) == expected


@pytest.mark.parametrize("crowd", [1000, 3])
def test_groups_do_not_rest_on_bands(spark, crowd):
    rng = random.Random(7)
    short = [" ".join(f"w{rng.randrange(12)}" for _ in range(rng.randint(1, 5))) for _ in range(120)]
    texts = edited_texts(300, 5, words=120) + short
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    assert groups_by_number(df, rows_per_band=20, bands=1, crowd=crowd) == brute_groups(texts, 0.6)


def common_and_own_words(n, seed=8):
    """Sets of ten of 24 common words and two of their own each; each 50th differs from the one before by a word."""
    rng = np.random.default_rng(seed)
    sets = [sorted([*rng.choice(24, 10, replace=False).tolist(), 1000 + 2 * i, 1001 + 2 * i]) for i in range(n)]
    for i in range(49, n, 50):
        sets[i] = sorted([*sets[i - 1][:-1], -5 - i])
    return sets


def test_pairs_that_meet_in_bands_grow_with_the_collection(spark, monkeypatch):
    real, met = neardup.band_pairs, []

    def counted(rows, *how):
        met.append(sum(r["n"] * (r["n"] - 1) // 2 for r in rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").collect()))
        return real(rows, *how)

    monkeypatch.setattr(neardup, "band_pairs", counted)
    per_set = []
    for n in (1000, 8000):
        met.clear()
        df = spark.createDataFrame(list(enumerate(common_and_own_words(n))), "i int, words array<int>")
        got = near_duplicate_groups(df).select("i", "group").collect()
        group = {r["i"]: r["group"] for r in got}
        assert all(group[i] == group[i - 1] for i in range(49, n, 50))
        per_set.append(met[0] / n)
    assert per_set[1] < 3 * per_set[0]  # eight times the sets


@pytest.mark.parametrize("crowd, share, at_once", [(1000, 1, None), (5, 1, None), (5, 1, 3000), (5, 4, 300)])
def test_smaller_set_of_each_alike_pair_is_met(spark, crowd, share, at_once):
    rng = random.Random(9)
    sets = sorted({tuple(sorted(rng.sample(range(30), rng.randint(1, 14)))) for _ in range(400)})
    alike = {(i, j) for j in range(len(sets)) for i in range(j) if len(set(sets[i]) & set(sets[j])) >= 0.6 * len(set(sets[i]) | set(sets[j])) - 1e-12}
    nodes = spark.createDataFrame([(i, list(s)) for i, s in enumerate(sets)], "id long, words array<int>")
    words, numbers = np.unique(np.concatenate([np.array(s) for s in sets]), return_counts=True)
    some = nodes.where(F.col("id") % share == 0)
    parts, _ = neardup.prefix_parts(nodes, (words, numbers), 0.6, crowd, some=some, share=share, at_once=at_once)
    assert len(parts) > 1 if at_once else len(parts) == 1
    met, skipped = set(), 0
    for part in parts:
        by = collections.defaultdict(list)
        for r in part.collect():
            by[r["band"]].append((r["mark"] >> neardup.SIZE_AT, r["mark"] & neardup.LARGER, r["id"]))
        for rows_ in by.values():
            for x, y in itertools.combinations(sorted(rows_), 2):
                if x[1] == 0:
                    met.add((min(x[2], y[2]), max(x[2], y[2])))
                else:
                    skipped += 1
    assert alike and alike <= met and skipped
    given = {(r["a"], r["b"]) for part in parts for r in band_pairs(part, 0.6, 20_000).collect()}
    assert alike <= given


def test_crowded_bands_are_hot_if_most_of_their_rows_are_alike(spark, one_task_of_small_batches):
    rng = random.Random(10)
    few = [(7, i, rng.getrandbits(63), 12 << neardup.SIZE_AT) for i in range(300)]  # of 64 parities half differ
    many = [(9, i, 5, 12 << neardup.SIZE_AT) for i in range(300, 600)]
    got = band_pairs(spark.createDataFrame(few + many, "band long, id long, bits long, mark long"), 0.6, 1000, None, 100).collect()
    assert sorted(r["id"] for r in got if r["id"] is not None) == list(range(300, 600))
    assert len([r for r in got if r["a"] is not None]) < 10


def test_groups_of_nothing(spark):
    empty = spark.createDataFrame([], "i int, words array<int>")
    assert rows(near_duplicate_groups(empty)) == []


def test_darts_estimate_weighted_similarity():
    a, b = list(range(0, 40)), list(range(10, 50))
    w = lambda x: 0.2 if x % 3 else 2.5
    tokens = np.array(a + b, np.int64)
    weights = np.array([w(x) for x in a + b])
    sig = dart_signatures(tokens, np.array([0, 40, 80, 80]), weights, 4000)
    true = sum(w(x) for x in set(a) & set(b)) / sum(w(x) for x in set(a) | set(b))
    assert abs((sig[0] == sig[1]).mean() - true) < 0.04
    assert (sig[2] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    changed = weights.copy()
    changed[:40] *= 1.5  # one set weighs its elements more
    sig = dart_signatures(tokens, np.array([0, 40, 80]), changed, 4000)
    x, y = dict(zip(a, changed[:40])), dict(zip(b, changed[40:]))
    true = sum(min(x.get(e, 0), y.get(e, 0)) for e in {*a, *b}) / sum(max(x.get(e, 0), y.get(e, 0)) for e in {*a, *b})
    assert abs((sig[0] == sig[1]).mean() - true) < 0.04


# 3
def test_sample_meets_its_report(spark):
    rng = random.Random(2)
    data = [(i, rng.choice(["Farm", " farm", "FARM\t", "Sea", None, "nan"]), rng.choice(["Tool", "tool ", "Song"]), 1) for i in range(4000)] + [(None, "Sea", "Song", 1)]
    records = spark.createDataFrame(data, "id int, domain string, category string, weight int")
    targets = spark.createDataFrame([("Farm", "Tool", 0.5, 0), ("Sea", "Song", 0.25, 400), ("Sea", "Lamp", 0.25, 3)], "domain string, category string, target_share double, min_rows int")
    report = target_report(records, targets, 500)
    by = {(r["domain"], r["category"]): r for r in report.collect()}
    assert not by[("Sea", "Lamp")]["met"] and by[("Sea", "Lamp")]["available"] == 0
    assert by[("Sea", "Song")]["wished"] >= min(400, by[("Sea", "Song")]["available"] - 1)
    for block in (50, 20_000):
        sample = proportional_sample(records, report, "id", block=block)
        drawn = collections.Counter((r["domain"], r["category"]) for r in sample.collect())
        assert drawn == {(r["_d"], r["_c"]): r["wished"] for r in by.values() if r["wished"]}
        assert sample.select("id").distinct().count() == sum(drawn.values())


def test_gaps_are_those_of_the_calibration(spark):
    records = spark.createDataFrame([(i, "Farm" if i < 90 else " sea", "Tool") for i in range(100)], "id int, domain string, category string")
    targets = spark.createDataFrame([("Farm", "Tool", 0.9, 90), ("Farm ", "tool", 0.0, 91), ("Sea", "Tool", 0.1, 11), ("Sea", "Lamp", 0.0, 1), ("Sea", "Song", 0.0, 0), (None, "Tool", 0.0, 2)], "domain string, category string, target_share double, min_rows int")
    got = {(r["domain"], r["category"]): (round(r["reached"], 6), round(r["gap"], 6)) for r in calibrated_gaps(records, target_report(records, targets, 12)).collect()}
    assert got == {("Farm", "Tool"): (90, 0), ("Farm ", "tool"): (90, 1), ("Sea", "Tool"): (10, 1), ("Sea", "Lamp"): (0, 1), ("Sea", "Song"): (0, 0), (None, "Tool"): (0, 2)}


def test_sample_of_nothing(spark):
    records = spark.createDataFrame([], "id int, domain string, category string")
    targets = spark.createDataFrame([("A", "B", 1.0, 2)], "domain string, category string, target_share double, min_rows int")
    report = target_report(records, targets, 0)
    assert rows(report.select("available", "needed", "met")) == [(0, 2, False)] and rows(proportional_sample(records, report, "id")) == []


def test_sample_follows_weights(spark):
    records = spark.createDataFrame([(i, "A", "B", 1.0 if i % 2 else 5.0) for i in range(2000)], "id int, domain string, category string, w double")
    targets = spark.createDataFrame([("A", "B", 1.0, 0)], "domain string, category string, target_share double, min_rows int")
    got = [r["id"] for r in proportional_sample(records, target_report(records, targets, 300), "id", weight="w").collect()]
    heavy = sum(i % 2 == 0 for i in got)
    assert len(got) == 300 and 220 < heavy < 280


@settings(max_examples=50, deadline=None)
@given(st.lists(st.floats(0, 1), max_size=40), st.integers(0, 99))
def test_pivotal_keeps_the_sum(p, seed):
    after = pivotal(np.array(p), np.random.default_rng(seed))
    assert abs(after.sum() - sum(p)) < 1e-6 * max(1, len(p)) + 1e-7 * len(p)
    assert sum(0 < x < 1 for x in after) <= 1


def test_pivotal_is_fair():
    p = np.array([0.1, 0.5, 0.9, 0.3, 0.2])
    mean = np.mean([pivotal(p, np.random.default_rng(i)) for i in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def test_whole_numbers():
    got = whole_numbers(np.array([0.5, 0.3, 0.2]), np.array([0, 0, 30]), np.array([1000, 10, 25]), 100)
    assert got.sum() == 100 and got[1] <= 10 and got[2] == 25
    assert whole_numbers(np.array([0.5, 0.5]), np.array([80, 80]), np.array([100, 100]), 100).sum() == 100


# 4
def test_ranking_ignores_scales(spark):
    rng = np.random.default_rng(3)
    quality = rng.random(800)
    data = pd.DataFrame({"id": np.arange(800), "a": quality * 1e6, "b": np.round(quality + rng.normal(0, 0.05, 800), 1), "c": np.exp(quality)})
    data.loc[5, "a"] = np.nan
    items = spark.createDataFrame(data).withColumn("s0", F.lit("clash")).withColumn("b", F.when(F.col("id") == 7, None).otherwise(F.col("b")))
    ranked = rank_walk(items, ["a", "b", "c"], "id")
    got = {r["id"]: r["stationarity"] for r in ranked.collect()}
    assert len(got) == 798 and 5 not in got and 7 not in got
    assert abs(sum(got.values()) - 1) < 1e-3
    # the chain itself, on dense matrices
    use = [i for i in range(800) if i in got]
    sub = items.toPandas().set_index("id").loc[use, ["a", "b", "c"]].to_numpy(float)
    p = sum((m := (sub[None, :, s] >= sub[:, None, s]).astype(float)) / m.sum(axis=1, keepdims=True) for s in range(3)) / 3
    x = np.full(len(use), 1 / len(use))
    for _ in range(100):
        x = 0.15 / len(use) + 0.85 * x @ p
    assert np.abs(np.array([got[i] for i in use]) - x).max() < 2e-5 * x.max() / x.min() * x.min() + 1e-6
    top = {r["id"] for r in first_places(ranked, 50, "id").collect()}
    assert len(top) == 50 and top == set(sorted(use, key=lambda i: (-got[i], i))[:50])


def exact_walk(x, damping=0.85):
    """The chain's stationarity by prefix sums over every distinct value, in plain numpy."""
    n, s = x.shape
    place, above = [], []
    for i in range(s):
        _, inverse, count = np.unique(x[:, i], return_inverse=True, return_counts=True)
        place.append(inverse)
        above.append(np.cumsum(count[::-1])[::-1])
    mass = np.full(n, 1 / n)
    for _ in range(300):
        mass = (1 - damping) / n + damping / s * sum(np.cumsum(np.bincount(p, mass) / a)[p] for p, a in zip(place, above))
    return mass


@pytest.mark.parametrize("table_values", [1_000_000, 0])
def test_every_rank_is_that_of_the_exact_walk(spark, table_values):
    rng = np.random.default_rng(8)
    n = 3000
    quality = rng.random(n)
    data = pd.DataFrame({"id": np.arange(n), "a": quality + rng.random(n), "b": np.round(quality * 7), "c": np.where(rng.random(n) < 0.4, 0.0, -rng.random(n))})
    got = rank_walk(spark.createDataFrame(data), ["a", "b", "c"], "id", table_values=table_values, tolerance=1e-10 if table_values else 1e-7).toPandas().set_index("id")["stationarity"]
    true = exact_walk(data[["a", "b", "c"]].to_numpy())
    assert np.abs(got.reindex(range(n)).to_numpy() / true - 1).max() < (1e-8 if table_values else 1e-5)
    if table_values:
        assert (np.argsort(got.reindex(range(n)).to_numpy(), kind="stable") == np.argsort(true, kind="stable")).all()


def test_a_walk_that_does_not_converge_says_so(spark):
    items = spark.createDataFrame([(i, float(i), float(-i * i % 7)) for i in range(20)], "id int, a double, b double")
    for table_values in (1_000_000, 0):
        with pytest.raises(RuntimeError):
            rank_walk(items, ["a", "b"], "id", max_rounds=1, table_values=table_values)


def test_ranking_of_equals_and_of_nothing(spark):
    same = spark.createDataFrame([(i, 1.0, 2.0) for i in range(10)], "id int, a double, b double")
    ranked = rank_walk(same, ["a", "b"], "id")
    assert len({round(r["stationarity"], 9) for r in ranked.collect()}) == 1
    assert {r["id"] for r in first_places(ranked, 3, "id").collect()} == {0, 1, 2}
    none = rank_walk(same.limit(0), ["a", "b"], "id")
    assert rows(none) == [] and rows(first_places(none, 0, "id")) == []


# 5
def test_components_equal_union_find(spark):
    rng = random.Random(5)
    ids = [rng.getrandbits(40) for _ in range(400)]
    edges = [(rng.choice(ids), rng.choice(ids)) for _ in range(250)] + [(ids[i], ids[i + 1]) for i in range(100)] + [(ids[200], x) for x in ids[201:300]] + [(None, 1), (ids[0], ids[0])]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            parent[top(a)] = top(b)
    expected, mine = collections.defaultdict(set), collections.defaultdict(set)
    for x in list(parent):
        expected[top(x)].add(x)
    for r in got:
        mine[r["component"]].add(r["vertex"])
    assert {frozenset(v) for v in mine.values()} == {frozenset(v) for v in expected.values()}
    assert rows(connected_components(spark.createDataFrame([], "a long, b long"))) == []


def test_splits_keep_components(spark):
    rng = random.Random(6)
    data = [(i, rng.choice([1, 1, 1, *range(2, 600)]) if i % 9 else None, "x") for i in range(6000)]
    df = spark.createDataFrame(data, "id int, component long, split string").withColumn("n", F.lit("clash"))
    targets = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    got = split_whole_components(df, targets).collect()
    where = collections.defaultdict(set)
    for r in got:
        if r["component"] is not None:
            where[r["component"]].add(r["split"])
    assert len(got) == 6000 and all(len(v) == 1 for v in where.values())
    share = collections.Counter(r["split"] for r in got)
    assert abs(share["train"] / 6000 - 0.8) < 0.03 and abs(share["test"] / 6000 - 0.1) < 0.03
    assert rows(split_whole_components(df.limit(0), targets)) == []


# 6
@pytest.mark.parametrize("a, b", [
    ("ｎｅｎｕ　１５．", "nenu 15."), ("ne​nu", "nenu"), ("tā", "tā"), ("n u", "n u"), ("раru", "paru"), ("ಂ".join("కఖ"), "ం".join("కఖ")),
    ("ṣ́", "ṣ́"), ("﻿నేను", "నేను"), ("со вода ok then", "co вода ok then"), ("ﬁne", "fine"),
])
def test_same_look(a, b):
    assert same_look(a) == same_look(b)
    assert same_look(same_look(a)) == same_look(a)


PUBLISHED = [("ρaypal", "paypal"), ("αlpha", "alpha"), ("ιnk", "ink"), ("υnit", "unit"), ("ѵan", "van"), ("ӏamp", "lamp"), ("үou", "you"), ("ϲat", "cat"), ("Ꭺpple", "Apple"), ("ꓮpple", "Apple"), ("ⲟpen", "open")]


def test_published_look_alikes(spark):
    looks = look_alikes(spark)
    assert len(published_pairs(spark)) > 250
    for a, b in PUBLISHED:
        assert looks.form(a) == b == looks.form(b)
    for a, b in [("lI", "Il"), ("rn", "m"), ("0", "O"), ("Apple", "apple"), ("é", "e"), ("1", "l")]:
        assert looks.form(a) != looks.form(b)  # of one script, another case, or with a visible accent
    df = spark.createDataFrame([(a, b) for a, b in PUBLISHED] + [(None, None), ("", "")], "a string, b string")
    assert all(r[0] == r[1] for r in df.select(same_look_column("a"), same_look_column("b")).collect())


def test_forms_are_stable(spark):
    looks, rng = look_alikes(spark), random.Random(4)
    letters = [*looks.to, *"abcxyz .1", *"కఖగడ", "\u0301", "\u200b", "ｆ"]
    for _ in range(3000):
        text = " ".join("".join(rng.choice(letters) for _ in range(rng.randint(0, 5))) for _ in range(rng.randint(1, 4)))
        once = looks.form(text)
        assert looks.form(once) == once, text


@pytest.mark.parametrize("a, b", [("Nenu", "nenu"), ("nénu", "nenu"), ("x²", "x2"), ("nenu  a", "nenu a"), ("వాడు", "వాడ"), ("", " ")])
def test_different_look(a, b):
    assert same_look(a) != same_look(b)


def test_same_look_column(spark):
    texts = [None, "", "plain", "раru", "నేను", "నేను‌", "x" * 50_000 + " y", "tā", "ok నేను"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(same_look_column("t")).collect()] == [same_look(t) for t in texts]


# 7
@pytest.mark.parametrize("cell", [1000, 5])
def test_history_equals_brute_force(spark, cell):
    rng = random.Random(7)
    texts = edited_texts(600, 8, words=150)
    data = [(i, rng.choice([7, 7, 7, *range(20), None]), rng.choice([*range(6), None]), rng.random() < 0.7, t) for i, t in enumerate(texts)] + [(900, 1, 3, True, None), (901, 1, 0, None, "a b"), (902, 1, 2, True, "a b")]
    df = spark.createDataFrame(data, "id int, key int, unit int, ok boolean, text string").withColumn("words", word_set("text")).withColumns({c: F.lit("clash") for c in ("size", "side", "set", "since", "first_unit", "last", "part")})
    got = {r["id"]: r["first_unit"] for r in repeats_of_history(df, history_table(df, "key", "unit", F.col("ok")), "key", "unit", cell_size=cell).collect()}
    sets = {i: frozenset(hashed_words(t)) for i, *_, t in data if t is not None}
    expected = {}
    for i, k, u, _, t in data:
        if t is None or k is None or u is None:
            continue
        first = [u2 for j, k2, u2, ok, t2 in data if ok and t2 is not None and k2 == k and u2 is not None and u2 < u and len(sets[i] & sets[j]) >= 0.6 * len(sets[i] | sets[j]) - 1e-12]
        if first:
            expected[i] = min(first)
    assert got == expected and expected


def test_history_unit_by_unit(spark, tmp_path):
    """Units screened one after another against an appended table come out as all at once."""
    rng = random.Random(11)
    data = [(i, i // 40, i % 4, rng.random() < 0.7, t) for i, t in enumerate(edited_texts(200, 12, words=120))]
    df = spark.createDataFrame(data, "id int, key int, unit int, ok boolean, text string").withColumn("words", word_set("text"))
    at_once = {r["id"] for r in repeats_of_history(df, history_table(df, "key", "unit", F.col("ok")), "key", "unit").collect()}
    path, one_by_one = str(tmp_path / "history"), set()
    for unit in range(4):
        new = df.where(F.col("unit") == unit)
        if unit:
            one_by_one |= {r["id"] for r in repeats_of_history(new, spark.read.parquet(path), "key", "unit").collect()}
        history_table(new, "key", "unit", F.col("ok")).write.mode("append").parquet(path)
    assert at_once == one_by_one and at_once


def test_history_of_nothing(spark):
    df = spark.createDataFrame([(1, 1, 1, True, [1, 2])], "id int, key int, unit int, ok boolean, words array<int>")
    assert rows(repeats_of_history(df, history_table(df.limit(0), "key", "unit", F.col("ok")), "key", "unit")) == []
    assert rows(repeats_of_history(df.limit(0), history_table(df, "key", "unit", F.col("ok")), "key", "unit")) == []


def test_stored_history_reads_only_the_buckets_of_a_unit(spark, tmp_path):
    words = lambda df: df.withColumn("words", word_set("text")).withColumn("ok", F.lit(True))
    texts = edited_texts(300, 13, words=200)
    df = words(spark.createDataFrame([(i, i // 10, 0, t) for i, t in enumerate(texts)], "id int, key int, unit int, text string"))
    h = PivotHistory(spark, str(tmp_path / "h"), buckets=32)
    new = words(spark.createDataFrame([(1000 + i, 4, 9, texts[40 + i] + " x") for i in range(5)], "id int, key int, unit int, text string"))
    assert h.rows() is None and rows(h.repeats(new, "key", "unit")) == []
    h.append(df, "key", "unit", F.col("ok"))
    read, found = h.rows(new, "key"), {r["id"] for r in h.repeats(new, "key", "unit").collect()}
    n, bucket = read.count(), [r[0] for r in read.select("bucket").distinct().collect()]
    assert len(bucket) == 1 and 0 < n < 100 and found == {1000 + i for i in range(5)}
    plan = read._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    for k in range(3):  # history grows by other keys
        other = df.withColumn("key", F.col("key") + 100 * (k + 1))
        h.append(other.where(F.pmod(F.xxhash64("key"), F.lit(32)) != bucket[0]), "key", "unit", F.col("ok"))
    assert h.rows().count() > 3 * n and h.rows(new, "key").count() == n
    assert {r["id"] for r in h.repeats(new, "key", "unit").collect()} == found
    h.append(df, "key", "unit", F.col("ok"))  # the same unit once more, as after a lost job
    assert {r["id"] for r in h.repeats(new, "key", "unit").collect()} == found


def test_history_of_long_texts(spark):
    base = [f"w{i}" for i in range(3000)]
    data = [(0, 1, 0, " ".join(base)), (1, 1, 1, " ".join(base[600:] + ["y"])), (2, 1, 1, " ".join(base[1500:])), (3, 1, 1, "w1"), (4, 2, 0, "w1"), (5, 1, 2, "w1 w1")]
    df = spark.createDataFrame(data, "id int, key int, unit int, text string").withColumn("words", word_set("text"))
    got = {r["id"] for r in repeats_of_history(df, history_table(df, "key", "unit", F.lit(True)), "key", "unit").collect()}
    assert got == {1, 5}


def test_a_hot_key_is_not_compared_pair_by_pair(spark):
    """Of the four million pairs of two units of one key hardly any meet, and what repeats is found."""
    rng = random.Random(17)
    texts = [" ".join([f"own{i}x{j}" for j in range(8)] + rng.sample([f"common{c}" for c in range(30)], 4)) for i in range(2000)]
    again = {i: texts[i] + " more" for i in range(0, 2000, 100)}
    later = [again.get(i, " ".join([f"new{i}x{j}" for j in range(8)] + t.split()[8:])) for i, t in enumerate(texts)]
    data = [(i, 7, 0, t) for i, t in enumerate(texts)] + [(10_000 + i, 7, 1, t) for i, t in enumerate(later)]
    df = spark.createDataFrame(data, "id int, key int, unit int, text string").withColumn("words", word_set("text"))
    box = Scratch(spark, "hot")
    got = {r["id"] for r in repeats_of_history(df.where("unit = 1"), history_table(df.where("unit = 0"), "key", "unit", F.lit(True)), "key", "unit", cell_size=500, box=box).collect()}
    met = spark.read.parquet(f"{box.path}/*-first_words").groupBy("key", "band").agg((F.count("last") * F.count("since")).alias("n")).agg(F.sum("n")).first()[0]
    assert got == {10_000 + i for i in again} and 20 <= met < 40_000


# 8
def packed(items, capacity, **how):
    got = pack(items, "id", "size", capacity, **how).collect()
    of = collections.defaultdict(list)
    fill = collections.Counter()
    for r in got:
        of[r["id"]].append((r["piece"], r["size"]))
        fill[r["container"]] += r["size"]
    assert max(fill.values(), default=0) <= capacity and set(fill) == set(range(len(fill)))
    return {k: sorted(v) for k, v in of.items()}, fill


@pytest.mark.parametrize("runs_per_task", [50_000, 4])
def test_packing_places_everything_once(spark, runs_per_task):
    rng = random.Random(9)
    sizes = [rng.choice([1, 3, 50, 97, 100, 101, 250, 300, 40, 33]) for _ in range(3000)] + [0, None, -4]
    df = spark.createDataFrame([(i, s, 1) for i, s in enumerate(sizes)], "id int, size int, piece int")
    of, fill = packed(df, 100, runs_per_task=runs_per_task)
    assert all([z for _, z in of[i]] == [100] * (s // 100) + [s % 100] * (s % 100 > 0) for i, s in enumerate(sizes) if s and s > 0)
    assert all([p for p, _ in of[i]] == list(range(len(of[i]))) for i in of) and len(of) == 3000
    assert len(fill) <= -(-sum(s for s in sizes if s and s > 0) // 100) * 1.03 + 1


@pytest.mark.parametrize("runs_per_task", [50_000, 60])
def test_packing_of_many_sizes(spark, runs_per_task):
    """Sizes that hardly repeat, so that runs are single items and most matches cross partitions."""
    rng = random.Random(10)
    sizes = [int(100_000 * rng.random() ** 3) + 1 for _ in range(400)]
    of, fill = packed(spark.createDataFrame(list(enumerate(sizes)), "id int, size int"), 100_000, runs_per_task=runs_per_task)
    assert {k: v[0][1] for k, v in of.items()} == dict(enumerate(sizes))
    assert len(fill) <= -(-sum(sizes) // 100_000) * 1.06 + 1


def test_packing_of_nothing(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "id int, size int")
    assert rows(pack(df, "id", "size", 100)) == []
    of, fill = packed(spark.createDataFrame([(None, 5), (None, 5), (3, 250)], "id int, size int"), 100)
    assert of[None] == [(0, 5), (0, 5)] and of[3] == [(0, 100), (1, 100), (2, 50)] and len(fill) == 3


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(0, 1), st.integers(1, 4)), max_size=25))
def test_successor_sweep(given_runs):
    runs, at = [], {ITEM: collections.Counter(), GAP: 0}
    for size, kind, n in sorted(given_runs):
        runs.append((size, kind, at[ITEM][size] if kind == ITEM else at[GAP], n))
        if kind == ITEM:
            at[ITEM][size] += n
        else:
            at[GAP] += n
    matches, items, gaps = successor_sweep(runs)
    used, homes = collections.Counter(), collections.Counter()
    for s, f, gap, home, n, each in matches:
        assert s * each <= gap
        used.update((s, f + k) for k in range(n * each))
        homes.update(home + k for k in range(n))
    left = [(s, f + k) for s, f, n in items for k in range(n)]
    assert max(used.values(), default=1) == 1 and max(homes.values(), default=1) == 1
    assert sorted([*used, *left]) == sorted((s, k) for s, n in at[ITEM].items() for k in range(n))
    free = sorted(g for g, f, n in gaps for _ in range(n))
    assert not free or all(s > free[-1] for s, _ in left)  # no gap is left that would take an item


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=8))
def test_bracket_pairs(counts):
    pairs = bracket_pairs([(p, g, i) for p, (g, i) in enumerate(counts)])
    stack, expected = [], set()
    for p, (g, i) in enumerate(counts):
        expected |= {(*stack.pop(), p, k) for k in range(g) if stack}
        stack += [(p, k) for k in range(i)]
    assert {(a, x + n - 1 - k, b, y + k) for a, x, b, y, n in pairs for k in range(n)} == expected


def test_token_count(spark):
    df = spark.createDataFrame([("hello world",), ("",), (None,), (" \n",), ("<|endoftext|>",), ("a" * 20_000,)], "t string")
    got = [r[0] for r in df.select(token_count("t")).collect()]
    assert 2 <= got[0] <= 4 and got[1:4] == [0, 0, 0] and got[4] > 1 and got[5] > 100


# 9
def test_water_filling():
    got = water_filling(np.array([100.0, 10.0, 1000.0]), np.array([0.5, 0.4, 0.1]), np.array([2.0, 2.0, 1.0]), 1000.0)
    assert got[1] == 20 and got[0] == 200 and abs(got[2] - 780) < 1e-9
    assert filling_rounds(np.array([100.0, 290.0, 1000.0]), np.array([0.4, 0.4, 0.2]), np.array([1.0, 2.0, 1.0]), 1000.0)[1].tolist() == [1, 2, 0]


def test_mixture_keeps_to_its_caps(spark):
    rng = random.Random(10)
    data = [(i, rng.choice(["A", " a", "B", "c", "other", None]), rng.randint(0, 60), 1) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, source string, size int, copies int")
    targets = spark.createDataFrame([("a", 0.6, 2), ("b", 0.3, 1), ("C", 0.1, 3), ("gone", 0.0, 2), ("A ", 0.0, 9)], "source string, target_share double, max_copies int")
    report, copies = mix_sources(df, targets, "id", "size")
    by = {r["source"]: r for r in report.collect()}
    used = collections.Counter()
    for r in copies.collect():
        used[r["source"]] += r["size"] * r["copies"]
        assert 1 <= r["copies"] <= {"a": 2, "b": 1, "c": 3}[r["source"]]
    total = sum(used.values())
    for name in ("b", "C"):
        assert by[name]["used"] == used[name.lower()] and abs(by[name]["actual_share"] - used[name.lower()] / total) < 1e-12
        assert abs(by[name]["used"] - by[name]["planned"]) < 0.01 * total
    assert by["gone"]["used"] == 0
    r, c = mix_sources(df.limit(0), targets, "id", "size")
    assert rows(c) == [] and r.count() == 5


# 10
@settings(max_examples=60, deadline=None)
@given(st.text("abc", min_size=1, max_size=30), st.text("abcd", min_size=1, max_size=30))
def test_automaton_counts_longest_matches(text, word):
    count, at = 0, 0
    while at < len(word):
        n = 0
        while at + n < len(word) and word[at : at + n + 1] in text:
            n += 1
        at, count = at + max(1, n), count + 1
    codes = np.frombuffer(word.encode("utf-32-le"), np.int32)[None, :]
    assert Automaton(text).phrases(codes, np.array([len(word)]))[0] == count


def test_labels(spark):
    labels = ["en", "EN", "en-US", "ta_IN", "English", " telugu ", "deu", "und", "n/a", "", None, "xx", "pt-BR", "fre"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in labels], "l string").select(label_language("l")).collect()]
    assert got == ["en", "en", "en", "ta", "en", "te", "de", None, None, None, None, None, "pt", "fr"]


def test_sentences_are_whole():
    text = "One is here. Two?\nThree \"quoted.\" Four 3.5 ends\n\n" + "long " * 500
    parts = [text[a:b] for a, b in sentences(text)]
    assert parts[:4] == ["One is here.", "Two?", 'Three "quoted."', "Four 3.5 ends"]
    assert "".join(parts).replace(" ", "") == text.replace(" ", "").replace("\n", "")


def test_segments_of_a_mixed_document(spark):
    def made(starts, verbs, things, places):
        return [f"{a} {v} {t} {p}." for a in starts for v in verbs for t in things for p in places]

    en = made(["The old man", "My neighbour", "Nobody"], ["carried", "painted", "forgot"], ["a red lamp", "the big table", "their wooden boat"], ["near the river", "behind the station", "in the garden"])
    es = made(["El hombre viejo", "Mi vecina", "Nadie"], ["llevó", "pintó", "olvidó"], ["una lámpara roja", "la mesa grande", "el barco de madera"], ["junto al río", "detrás de la estación", "en el jardín"])
    te = made(["నా పొరుగువారు", "ముసలాయన"], ["నిన్న", "ఉదయం"], ["ఎర్ర దీపం", "పెద్ద బల్ల"], ["నది దగ్గర మోశారు", "తోటలో మర్చిపోయారు"])
    data = [(i, s, lang) for i, (s, lang) in enumerate([(s, "en") for s in en] + [(s, "Spanish") for s in es] + [(s, "te-IN") for s in te])]
    data += [(i + 700, s, "te") for i, s in enumerate(en[:9])]  # wrong labels
    data += [(900, en[0] + " " + es[0] + "\n" + te[0], "en"), (901, "", "en"), (902, None, "en"), (903, "12345 !!", None), (904, es[0] * 800, None)]
    docs = spark.createDataFrame(data, "doc_id int, text string, lang string").withColumn("start", F.lit(1))
    model = fit_languages(docs)
    got = collections.defaultdict(list)
    for r in language_segments(docs.where(F.length("text") > 0), model).orderBy("doc_id", "segment").collect():
        got[r["doc_id"]].append((r["lang"], r["start"], r["end"]))
        assert 0 <= r["confidence"] <= 1
    assert [x[0] for x in got[900]] == ["en", "es", "te"]
    assert got[903][0][0] == "und" and 901 not in got and 902 not in got
    assert {x[0] for x in got[904]} == {"es"} and got[904][-1][2] == len(es[0]) * 800
    assert rows(language_segments(docs.limit(0), model)) == []
    assert Languages({}).judge(["abc"])[0][0] == "und"
