"""The engine's operators as queries over the test tables, each with the SQL that states the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kolam.functions import scores, text, vectors
from kolam.functions.names import current_rows, norm_name, present_name
from kolam.operators import keyed, neardup, parsing, state, validation
from kolam.scratch import Scratch
from kolam.sinks.export import final_translations, rejected_rows
from kolam.sources.jsonl import translation_input
from kolam.sources.tables import table as t
from kolam.sources.words import clean_words

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_WS = r"[\s\p{Z}\x{85}]"
_STRIP = lambda c: f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"
_HAS_WORD = rf"""coalesce(regexp_matches(sentence, '(?i)(^|[^\p{{L}}\p{{N}}_])' || regexp_replace({_STRIP("word")}, '([^\p{{L}}\p{{N}}_\s])', '\\\1', 'g') || '($|[^\p{{L}}\p{{N}}_])') AND length({_STRIP("word")}) > 0, false)"""
_NORM = lambda c: f"lower(trim(regexp_replace({c}, '[ \\t]+', ' ', 'g'), ' '))"
_CURRENT = "(SELECT * FROM {} WHERE sentence_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sentence_id ORDER BY updated_at DESC, loaded_at DESC) = 1)"


# Predicates and gates
@query(f"SELECT sentence_id, loaded_at, {_HAS_WORD} AS has_word FROM final_sentences")
def word_boundary_filter(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "final_sentences").select("sentence_id", "loaded_at", text.contains_word("sentence", text.strip("word")).alias("has_word"))


@query(f"""SELECT coalesce(CASE WHEN coalesce(length({_STRIP("sentence")}), 0) = 0 THEN 'empty_sentence' WHEN NOT {_HAS_WORD} THEN 'target_word_missing' END, 'passed') AS outcome, count(*) AS n
FROM final_sentences GROUP BY 1""")
def structural_gate(spark: SparkSession, d: str) -> DataFrame:
    reason = validation.structural_reason("sentence", text.strip("word"))
    return t(spark, d, "final_sentences").select(F.coalesce(reason, F.lit("passed")).alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT sentence_id, loaded_at, coalesce(CASE WHEN coalesce(length({_STRIP("sentence")}), 0) = 0 THEN 'empty_sentence' WHEN NOT {_HAS_WORD} THEN 'target_word_missing' END, 'passed') AS outcome FROM final_sentences""")
def structural_gate_rows(spark: SparkSession, d: str) -> DataFrame:
    reason = validation.structural_reason("sentence", text.strip("word"))
    return t(spark, d, "final_sentences").select("sentence_id", "loaded_at", F.coalesce(reason, F.lit("passed")).alias("outcome"))


_RATIO = r"CASE WHEN telugu_sentence IS NOT NULL THEN coalesce(length(regexp_replace(regexp_replace(telugu_sentence, '\P{L}', '', 'g'), '[^\x{0C00}-\x{0C7F}]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(telugu_sentence, '\P{L}', '', 'g')), 0), 0) END"
_RUN = lambda c: rf"list_max(list_transform(string_split_regex({c}, '[^A-Za-z\s\p{{Z}}\x{{85}}]+'), lambda x: length(regexp_replace(x, '{_WS}+', '', 'g'))))"
_LOST = r"len(list_filter(regexp_extract_all(english_sentence, '(\p{Nd}+)', 1), lambda x: NOT contains(telugu_sentence, x)))"
_LENGTHS = f"(length({_STRIP('telugu_sentence')})::DOUBLE / nullif(length({_STRIP('english_sentence')}), 0))"


@query(f"SELECT sentence_id, loaded_at, {_RATIO} AS ratio FROM final_translations")
def script_ratio(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "final_translations").select("sentence_id", "loaded_at", text.script_letter_ratio("telugu_sentence").alias("ratio"))


@query(f"SELECT sentence_id, loaded_at, {_RUN('telugu_romanized')} AS run FROM final_translations")
def longest_latin_run(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "final_translations").select("sentence_id", "loaded_at", text.longest_latin_run("telugu_romanized").alias("run"))


@query(f"SELECT sentence_id, loaded_at, {_LOST} AS lost FROM final_translations WHERE english_sentence IS NOT NULL AND telugu_sentence IS NOT NULL")
def numbers_kept(spark: SparkSession, d: str) -> DataFrame:
    both = t(spark, d, "final_translations").where(F.col("english_sentence").isNotNull() & F.col("telugu_sentence").isNotNull())
    return both.select("sentence_id", "loaded_at", F.size(text.numbers_lost("english_sentence", "telugu_sentence")).cast("long").alias("lost"))


@query(f"SELECT sentence_id, loaded_at, {_LENGTHS} AS ratio FROM final_translations")
def length_ratio(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "final_translations").select("sentence_id", "loaded_at", text.length_ratio("english_sentence", "telugu_sentence").alias("ratio"))


_RULES = f"""CASE WHEN coalesce(length({_STRIP("telugu_sentence")}), 0) = 0 THEN 'empty_translation' WHEN {_RATIO} < 0.5 THEN 'script_ratio' WHEN {_RUN("telugu_sentence")} > 25 THEN 'latin_run'
WHEN {_LENGTHS} < 0.5 THEN 'too_short' WHEN {_LENGTHS} > 3.0 THEN 'too_long' WHEN {_LOST} > 0 THEN 'numbers_lost' END"""


@query(f"SELECT coalesce({_RULES}, 'passed') AS outcome, count(*) AS n FROM final_translations GROUP BY 1")
def rule_gate_first_failure(spark: SparkSession, d: str) -> DataFrame:
    reason = validation.rule_reason("english_sentence", "telugu_sentence")
    return t(spark, d, "final_translations").select(F.coalesce(reason, F.lit("passed")).alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


#: Rows that break each of the rules, as the tables hold few: every translation as it is, cut, repeated, replaced, and next to a run of letters.
_BROKEN = """(SELECT sentence_id, loaded_at, v.how AS how, english_sentence || ' in 1947' AS english_sentence, CASE v.how WHEN 0 THEN telugu_sentence || ' 1947' WHEN 1 THEN left(telugu_sentence, 4) || '1947' WHEN 2 THEN repeat(telugu_sentence || ' 1947 ', 9)
WHEN 3 THEN english_sentence || ' 1947' WHEN 4 THEN telugu_sentence WHEN 5 THEN telugu_sentence || telugu_sentence || ' 1947 abcdefghijklm nopqrstuvwxyz' ELSE '  ' END AS telugu_sentence FROM final_translations, (SELECT unnest(range(7)) AS how) v)"""


@query(f"SELECT sentence_id, loaded_at, how, coalesce({_RULES}, 'passed') AS outcome FROM {_BROKEN}")
def rule_gate_rows(spark: SparkSession, d: str) -> DataFrame:
    df = t(spark, d, "final_translations").withColumn("how", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(6).cast("long"))))
    te, en, how = F.col("telugu_sentence"), F.col("english_sentence"), F.col("how")
    made = F.when(how == 0, F.concat(te, F.lit(" 1947"))).when(how == 1, F.concat(F.left(te, F.lit(4)), F.lit("1947"))).when(how == 2, F.repeat(F.concat(te, F.lit(" 1947 ")), 9)).when(how == 3, F.concat(en, F.lit(" 1947")))
    made = made.when(how == 4, te).when(how == 5, F.concat(te, te, F.lit(" 1947 abcdefghijklm nopqrstuvwxyz"))).otherwise(F.lit("  "))
    broken = df.select("sentence_id", "loaded_at", "how", F.concat(en, F.lit(" in 1947")).alias("english_sentence"), made.alias("telugu_sentence"))
    return broken.select("sentence_id", "loaded_at", "how", F.coalesce(validation.rule_reason("english_sentence", "telugu_sentence"), F.lit("passed")).alias("outcome"))


@query(f"""SELECT stage, reason, count(*) AS n FROM (SELECT 'structural_validation' AS stage, CASE WHEN coalesce(length({_STRIP("sentence")}), 0) = 0 THEN 'empty_sentence' WHEN NOT {_HAS_WORD} THEN 'target_word_missing' END AS reason FROM final_sentences
UNION ALL SELECT 'rules', {_RULES} FROM {_BROKEN}) WHERE reason IS NOT NULL GROUP BY ALL""")
def rejected_by_stage(spark: SparkSession, d: str) -> DataFrame:
    """The rejected rows of two gates as one table, counted."""
    _, sentences = validation.split_by_reason(t(spark, d, "final_sentences"), validation.structural_reason("sentence", text.strip("word")), "structural_validation")
    translations = rule_gate_rows(spark, d).where(F.col("outcome") != "passed").select("sentence_id", F.lit("rules").alias("stage"), F.col("outcome").alias("reason"))
    return rejected_rows(sentences.select("row_id", "sentence_id", "sentence", "stage", "reason"), translations).groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("n"))


#: Thresholds in the units of the test table's judge.
_LEAST = {"meaning_preservation": 0.8, "completeness": 75.0, "hallucination": 0.85, "target_word_accuracy": 4.0, "grammar": 8.5, "naturalness": 0.5, "context_preservation": 170.0}
_MISSING = " OR ".join(f"scores.{k} IS NULL OR isnan(scores.{k})" for k in _LEAST)
_FAILS = ", ".join(f"CASE WHEN scores.{k} < {v} THEN '{k}' END" for k, v in _LEAST.items())


@query(f"""SELECT sentence_id, loaded_at, CASE WHEN {_MISSING} OR len(failed) > 0 THEN 'FAIL' ELSE 'PASS' END AS decision,
CASE WHEN {_MISSING} THEN 0 ELSE round(({" + ".join(f"scores.{k}" for k in _LEAST)}) / 7, 6) END AS overall, CASE WHEN {_MISSING} THEN NULL ELSE array_to_string(failed, ',') END AS failed
FROM (SELECT *, list_filter([{_FAILS}, CASE WHEN semantic_similarity IS NULL OR isnan(semantic_similarity) OR semantic_similarity < 0.8 THEN 'semantic_similarity' END], lambda x: x IS NOT NULL) AS failed FROM final_translations)""")
def score_gate_all_failures(spark: SparkSession, d: str) -> DataFrame:
    df = t(spark, d, "final_translations")
    g = df.select("sentence_id", "loaded_at", scores.decide({k: F.col(f"scores.{k}") for k in _LEAST}, _LEAST, F.col("semantic_similarity")).alias("g"))
    names = F.array_join(F.transform("g.failures", lambda x: F.regexp_extract(x, "^[a-z_]+", 0)), ",")
    missing = F.exists("g.failures", lambda x: x.startswith("missing score"))
    return g.select("sentence_id", "loaded_at", "g.decision", F.round("g.overall", 6).alias("overall"), F.when(~missing, names).alias("failed"))


# Names and current rows
@query(f"SELECT CASE WHEN {_NORM('domain')} NOT IN ('', 'nan') THEN {_NORM('domain')} END AS domain, count(*) AS n FROM {_CURRENT.format('final_sentences')} GROUP BY 1")
def current_by_domain(spark: SparkSession, d: str) -> DataFrame:
    return current_rows(t(spark, d, "final_sentences"), ["domain"]).groupBy(present_name("domain").alias("domain")).agg(F.count(F.lit(1)).alias("n"))


_MISSING_SQL = "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"
_VALUE = lambda c: f"CASE WHEN {c} NOT IN {_MISSING_SQL} THEN {_STRIP(c)} END"


@query(f"SELECT row_id, coalesce({_VALUE('domain')}, 'nan') AS domain, coalesce({_VALUE('category')}, 'nan') AS category, {_VALUE('word')} AS word FROM words WHERE coalesce({_VALUE('word')}, '') <> '' AND lower({_VALUE('word')}) <> 'nan'")
def clean_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return clean_words(t(spark, d, "words"))


@query(f"SELECT sentence_id, row_id, coalesce(domain, '') AS domain, coalesce(category, '') AS category, coalesce(word, '') AS word, {_STRIP('sentence')} AS english_sentence FROM final_sentences WHERE length({_STRIP('sentence')}) > 0")
def translation_input_rows(spark: SparkSession, d: str) -> DataFrame:
    return translation_input(t(spark, d, "final_sentences"))


# Vectors
_PAIRS = "SELECT a.label, a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {}"


@query(_PAIRS.format(0.3))
def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_pairs(t(spark, d, "embeddings"), "label", "vec_id", "embedding", 0.3)


@query("SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1)::DOUBLE[]), 9) AS similarity FROM embeddings")
def cosine_to_first(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "embeddings")
    first = e.groupBy().agg(F.min_by("embedding", "vec_id").alias("first"))  # one row
    both = e.select("vec_id", "embedding", first.scalar().alias("first"))
    return both.select("vec_id", F.round(vectors.cosine("embedding", "first"), 9).alias("similarity"))


_GREEDY = """WITH RECURSIVE e AS (SELECT label, row_number() OVER (PARTITION BY label ORDER BY {1}vec_id) rn, vec_id, {2} AS past, embedding::DOUBLE[] v FROM embeddings),
g AS (SELECT DISTINCT label, 0::BIGINT rn, NULL::BIGINT vec_id, true AS ok, []::DOUBLE[][] kept FROM e
      UNION ALL
      SELECT label, rn, vec_id, ok, CASE WHEN ok THEN list_append(kept, v) ELSE kept END
      FROM (SELECT g.label, n.rn, n.vec_id, n.v, g.kept, n.past OR len(list_filter(g.kept, lambda k: list_cosine_similarity(k, n.v) >= {0})) = 0 AS ok
            FROM g JOIN e n ON n.label = g.label AND n.rn = g.rn + 1))
SELECT label, vec_id, ok AS kept FROM g WHERE rn > 0"""


def _greedy(spark: SparkSession, d: str, threshold: float, **how) -> DataFrame:
    e = t(spark, d, "embeddings").withColumn("past", F.col("vec_id") % 3 == 0)
    return neardup.greedy_near_duplicates(e, "label", "vec_id", "embedding", threshold, **how).select("label", "vec_id", "kept")


@query(_GREEDY.format(0.3, "", "false"))
def greedy_near_dup(spark: SparkSession, d: str) -> DataFrame:
    return _greedy(spark, d, 0.3)


@query(_GREEDY.format(0.2, "", "false"))
def greedy_near_dup_dense(spark: SparkSession, d: str) -> DataFrame:
    return _greedy(spark, d, 0.2)


@query(_GREEDY.format(0.25, "vec_id % 3 <> 0, ", "vec_id % 3 = 0"))
def greedy_near_dup_history(spark: SparkSession, d: str) -> DataFrame:
    """A third of the rows are history: kept, and before all others of their key."""
    return _greedy(spark, d, 0.25, history="past")


@query(_GREEDY.format(0.3, "", "false"))
def greedy_near_dup_links(spark: SparkSession, d: str) -> DataFrame:
    """Every key taken for a large one: by blocks, rounds and links."""
    return _greedy(spark, d, 0.3, small=0, rounds=1)


# Numbering and chunks
@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 25 AS chunk_id, (row_number() OVER (ORDER BY doc_id) - 1) % 25 AS pos_in_chunk FROM documents")
def chunk_assign(spark: SparkSession, d: str) -> DataFrame:
    return keyed.chunks(t(spark, d, "documents").select("doc_id"), "doc_id", 25).select("doc_id", "chunk_id", "pos_in_chunk")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 25 // 30 AS job_id FROM orders")
def job_assign(spark: SparkSession, d: str) -> DataFrame:
    return keyed.chunks(t(spark, d, "orders").select("o_orderkey"), "o_orderkey", 25, 30).select("o_orderkey", "job_id")


@query("SELECT sentence_id, loaded_at, concat_ws('_', row_id, row_number() OVER (PARTITION BY row_id ORDER BY updated_at, loaded_at, sentence_id)) AS new_id FROM final_sentences")
def renumber_ids(spark: SparkSession, d: str) -> DataFrame:
    df = t(spark, d, "final_sentences").select("row_id", "sentence_id", "updated_at", "loaded_at")
    return keyed.renumber(df, "row_id", ["updated_at", "loaded_at", "sentence_id"], column="new_id").select("sentence_id", "loaded_at", "new_id")


# Words' states: nearly all words of the table are complete, so statuses and rounds are dealt anew by the row id, over all rows.
_STATES = """(SELECT row_id, word, updated_at, ['pending', 'complete', 'exhausted', 'pending', 'pending'][coalesce(row_id, 0) % 5 + 1] AS status, (coalesce(row_id, 0) // 5 % 5)::INT AS rounds_attempted,
CASE WHEN coalesce(row_id, 0) % 5 = 1 THEN 3 ELSE (coalesce(row_id, 0) // 25 % 4)::INT END AS accepted_count FROM word_state)"""


def _states(spark: SparkSession, d: str) -> DataFrame:
    n = F.coalesce("row_id", F.lit(0))
    kinds = F.array(*[F.lit(x) for x in ("pending", "complete", "exhausted", "pending", "pending")])
    dealt = {"status": F.get(kinds, (n % 5).cast("int")), "rounds_attempted": F.floor(n / 5).cast("int") % 5, "accepted_count": F.when(n % 5 == 1, 3).otherwise(F.floor(n / 25).cast("int") % 4)}
    return t(spark, d, "word_state").select("row_id", "word", "updated_at", *[c.alias(k) for k, c in dealt.items()])


# Keys
_LAST = "SELECT event_id, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts {0}, event_id {0}) = 1"


@query(_LAST.format("DESC"))
def last_wins(spark: SparkSession, d: str) -> DataFrame:
    return keyed.last_wins(t(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value"), "user_id", ["ts", "event_id"]).drop("ts")


@query(_LAST.format("ASC"))
def first_wins(spark: SparkSession, d: str) -> DataFrame:
    return keyed.first_wins(t(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value"), "user_id", ["ts", "event_id"]).drop("ts")


@query("""WITH last AS (SELECT row_id, status AS answer FROM word_state QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY updated_at DESC, status DESC) = 1)
SELECT w.row_id, w.word, answer, CASE WHEN l.row_id IS NULL THEN 'FAILED' ELSE 'OK' END AS status FROM words w LEFT JOIN last l USING (row_id)""")
def response_left_join(spark: SparkSession, d: str) -> DataFrame:
    got = t(spark, d, "word_state").select("row_id", "updated_at", F.col("status").alias("answer"))
    return keyed.answered_or_failed(t(spark, d, "words").select("row_id", "word"), got, "row_id", "updated_at").drop("reason")


@query("SELECT row_id, word FROM words WHERE row_id NOT IN (SELECT row_id FROM word_state WHERE row_id IS NOT NULL)")
def missing_anti(spark: SparkSession, d: str) -> DataFrame:
    return keyed.missing_from(t(spark, d, "words").select("row_id", "word"), t(spark, d, "word_state"), "row_id")


@query(f"SELECT sentence_id, row_id FROM final_sentences WHERE row_id IN (SELECT row_id FROM {_STATES} WHERE status = 'pending')")
def pending_semi(spark: SparkSession, d: str) -> DataFrame:
    pending = _states(spark, d).where(F.col("status") == state.PENDING).select("row_id").distinct()
    return t(spark, d, "final_sentences").select("sentence_id", "row_id").join(pending, "row_id", "left_semi")


@query("""SELECT s.sentence_id, s.row_id, j.overall_score FROM (SELECT sentence_id, overall_score FROM final_translations WHERE sentence_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sentence_id ORDER BY loaded_at DESC, overall_score DESC NULLS LAST) = 1) j
JOIN (SELECT DISTINCT sentence_id, row_id FROM final_sentences) s USING (sentence_id)""")
def judge_inner(spark: SparkSession, d: str) -> DataFrame:
    got = t(spark, d, "final_translations").where(F.col("sentence_id").isNotNull()).select("sentence_id", "loaded_at", "overall_score")
    return keyed.matched(got, t(spark, d, "final_sentences").select("sentence_id", "row_id").distinct(), "sentence_id", "loaded_at").select("sentence_id", "row_id", "overall_score")


@query("""WITH o AS (SELECT row_id, sentence_id, domain, row_number() OVER (PARTITION BY row_id ORDER BY updated_at, loaded_at, sentence_id) AS n FROM final_sentences)
SELECT o.row_id, f.domain, o.n - 1 AS pos, o.sentence_id AS item FROM o JOIN o f ON o.row_id = f.row_id AND f.n = 1""")
def merge_candidates(spark: SparkSession, d: str) -> DataFrame:
    log = t(spark, d, "final_sentences").select("row_id", "domain", F.struct("updated_at", "loaded_at", "sentence_id").alias("o"), F.array("sentence_id").alias("items"))
    return keyed.merge_candidates(log, "row_id", "o", "items", ["domain"])


# State
@query(f"SELECT status, count(*) AS n FROM {_STATES} GROUP BY 1")
def status_histogram(spark: SparkSession, d: str) -> DataFrame:
    return state.status_histogram(_states(spark, d))


@query(f"SELECT count(*) AS words, count(*) FILTER (status = 'complete') AS complete, count(*) FILTER (status = 'exhausted') AS exhausted, coalesce(sum(accepted_count), 0)::BIGINT AS accepted, avg((status = 'complete')::INT) AS complete_share FROM {_STATES}")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    return state.coverage(_states(spark, d))


@query("SELECT row_id, count(*) AS n FROM (SELECT DISTINCT row_id, sentence_id FROM final_sentences) GROUP BY 1 HAVING count(*) >= 3")
def accepted_per_word(spark: SparkSession, d: str) -> DataFrame:
    return state.accepted_counts(t(spark, d, "final_sentences").select("row_id", "sentence_id").distinct(), 3)


@query(f"""WITH n AS (SELECT row_id, count(*) AS n FROM final_sentences WHERE overall_score >= 0.9 GROUP BY 1)
SELECT w.row_id, w.word, CASE WHEN status IN ('complete', 'exhausted') THEN status WHEN coalesce(n, 0) >= 3 THEN 'complete' WHEN rounds_attempted >= 3 THEN 'exhausted' ELSE 'pending' END AS status, coalesce(n, 0)::INT AS accepted_count FROM {_STATES} w LEFT JOIN n USING (row_id)""")
def state_transition(spark: SparkSession, d: str) -> DataFrame:
    good = t(spark, d, "final_sentences").where(F.col("overall_score") >= 0.9)
    return state.finish_words(_states(spark, d), good, 3, 3).select("row_id", "word", "status", "accepted_count")


@query(f"SELECT row_id, word, rounds_attempted + (status = 'pending')::INT AS rounds_attempted FROM {_STATES} WHERE status = 'pending' AND accepted_count < 3")
def needs_work(spark: SparkSession, d: str) -> DataFrame:
    """The words of a round, which counts for them."""
    return state.words_needing_work(state.begin_round(_states(spark, d)), 3).select("row_id", "word", "rounds_attempted")


@query(f"SELECT row_id, word, CASE WHEN status = 'exhausted' THEN 'pending' ELSE status END AS status, CASE WHEN status = 'exhausted' THEN 0 ELSE rounds_attempted END AS rounds_attempted, accepted_count FROM {_STATES}")
def reset_exhausted(spark: SparkSession, d: str) -> DataFrame:
    return state.reset_exhausted(_states(spark, d)).select("row_id", "word", "status", "rounds_attempted", "accepted_count")


_SENTENCES = f"""(SELECT sentence_id, ['pending', 'translated', 'complete', 'needs_review'][row_id % 4 + 1] AS status, (row_id // 4 % 2)::INT AS attempts, CASE WHEN row_id % 4 > 0 THEN 1 END AS tier, telugu_sentence, english_sentence
FROM (SELECT * REPLACE (coalesce(row_id, 0) AS row_id) FROM {_CURRENT.format("final_translations")}))"""


def _sentence_states(spark: SparkSession, d: str) -> DataFrame:
    cur = current_rows(t(spark, d, "final_translations"), ["row_id", "telugu_sentence", "english_sentence"])
    n = F.coalesce("row_id", F.lit(0))
    kinds = F.array(*[F.lit(x) for x in ("pending", "translated", "complete", "needs_review")])
    dealt = {"status": F.get(kinds, (n % 4).cast("int")), "attempts": F.floor(n / 4).cast("int") % 2, "tier": F.when(n % 4 > 0, 1)}
    return cur.select("sentence_id", *[c.alias(k) for k, c in dealt.items()], "telugu_sentence", "english_sentence", *[F.lit(None).cast("string").alias(c) for c in ("translation_provider", "translation_model", "reason")])


@query(f"""SELECT sentence_id, CASE WHEN status <> 'pending' THEN status WHEN telugu_sentence IS NOT NULL AND length(telugu_sentence) % 3 > 0 THEN 'translated' WHEN attempts + 1 >= 2 THEN 'needs_review' ELSE 'pending' END AS status,
attempts + (status = 'pending')::INT AS attempts, CASE WHEN status = 'pending' AND telugu_sentence IS NOT NULL AND length(telugu_sentence) % 3 > 0 THEN 2 ELSE tier END AS tier,
CASE WHEN status = 'pending' AND telugu_sentence IS NOT NULL AND length(telugu_sentence) % 3 > 0 THEN 'm' END AS translation_model, CASE WHEN status = 'pending' AND (telugu_sentence IS NULL OR length(telugu_sentence) % 3 = 0) THEN 'no translation' END AS reason FROM {_SENTENCES}""")
def translations_applied(spark: SparkSession, d: str) -> DataFrame:
    """A translation pass over the pending sentences; those whose text has a length divisible by 3 get no answer."""
    s = _sentence_states(spark, d)
    got = s.where(F.length("telugu_sentence") % 3 > 0).select("sentence_id", "telugu_sentence")
    return state.apply_translations(s, state.needs_translation(s), got, 2, "p", "m", 2).select("sentence_id", "status", "attempts", "tier", "translation_model", "reason")


@query(f"""SELECT sentence_id, CASE WHEN status NOT IN ('pending', 'translated') OR r IS NULL THEN status WHEN attempts >= 1 THEN 'needs_review' ELSE 'pending' END AS status, CASE WHEN status IN ('pending', 'translated') THEN r END AS reason
FROM (SELECT *, {_RULES} AS r FROM {_SENTENCES})""")
def sentences_failed(spark: SparkSession, d: str) -> DataFrame:
    """The rule gate over the sentences in work, and what it makes of their state."""
    s = _sentence_states(spark, d)
    bad = state.sentences_needing_work(s).withColumn("reason", validation.rule_reason("english_sentence", "telugu_sentence")).where(F.col("reason").isNotNull())
    return state.fail_sentences(s, bad, 1).select("sentence_id", "status", "reason")


@query("""SELECT row_id, word, 'old' AS origin FROM word_state UNION ALL
(SELECT row_id, word, 'new' FROM words WHERE row_id NOT IN (SELECT row_id FROM word_state WHERE row_id IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY word NULLS FIRST) = 1)""")
def upsert_if_absent(spark: SparkSession, d: str) -> DataFrame:
    old = t(spark, d, "word_state").select("row_id", "word", F.lit("old").alias("origin"))
    return keyed.upsert_if_absent(old, t(spark, d, "words").select("row_id", "word", F.lit("new").alias("origin")), "row_id", "word")


@query("SELECT row_id FROM words EXCEPT SELECT row_id FROM word_state")
def missing_except(spark: SparkSession, d: str) -> DataFrame:
    return keyed.missing_keys(t(spark, d, "words"), t(spark, d, "word_state"), "row_id")


# Payloads
@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def parse_json_payload(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k"))


@query("""SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE TRY_CAST(json_extract_string(props, '$.k') AS INT) END AS k, event_type = 'click' AS malformed FROM events""")
def parse_malformed(spark: SparkSession, d: str) -> DataFrame:
    """The payloads of one event type lose their last sign: they are malformed, and still rows."""
    cut = t(spark, d, "events").withColumn("props", F.when(F.col("event_type") == "click", F.expr("left(props, length(props) - 1)")).otherwise(F.col("props")))
    items = cut.select("event_id", parsing.payload_items("props").alias("i"))
    return items.select("event_id", F.try_variant_get(F.get("i", 0), "$.k", "int").alias("k"), F.col("i").isNull().alias("malformed"))


@query(f"SELECT sentence_id, {_STRIP('telugu_sentence')} AS telugu_sentence FROM {_CURRENT.format('final_translations')} WHERE length({_STRIP('telugu_sentence')}) > 0")
def payload_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Translations packed into one JSON payload per chunk and parsed again as a response."""
    cur = current_rows(t(spark, d, "final_translations"), ["telugu_sentence"])
    sent = parsing.request_payloads(keyed.chunks(cur, "sentence_id", 25), {"sentence_id": "sentence_id", "telugu_sentence": "telugu_sentence"})
    return parsing.parse_translations(sent.withColumnRenamed("payload", "response")).select("sentence_id", "telugu_sentence")


# Export
@query("""SELECT sentence_id, row_id, domain, category, word, 'en-IN' AS source_language, 'te-IN' AS target_language, english_sentence, telugu_sentence, telugu_romanized, translation_provider, translation_model, judge_provider, judge_model,
CASE WHEN NOT isnan(scores.meaning_preservation) THEN scores.meaning_preservation END AS meaning_preservation, CASE WHEN NOT isnan(scores.completeness) THEN scores.completeness END AS completeness, CASE WHEN NOT isnan(scores.hallucination) THEN scores.hallucination END AS hallucination, CASE WHEN NOT isnan(scores.target_word_accuracy) THEN scores.target_word_accuracy END AS target_word_accuracy, CASE WHEN NOT isnan(scores.grammar) THEN scores.grammar END AS grammar, CASE WHEN NOT isnan(scores.naturalness) THEN scores.naturalness END AS naturalness, CASE WHEN NOT isnan(scores.context_preservation) THEN scores.context_preservation END AS context_preservation,
CASE WHEN NOT isnan(overall_score) THEN overall_score END AS overall_score, CASE WHEN NOT isnan(semantic_similarity) THEN semantic_similarity END AS semantic_similarity, 'accepted' AS status FROM final_translations WHERE status = 'complete'""")
def export_flatten(spark: SparkSession, d: str) -> DataFrame:
    return final_translations(t(spark, d, "final_translations"))


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def limit_prefix(spark: SparkSession, d: str) -> DataFrame:
    """The first rows in input order, as a pilot run takes them."""
    return t(spark, d, "documents").select("doc_id", "lang").orderBy("doc_id").limit(100)


@query(f"SELECT {_NORM('domain')} AS domain, count(*) AS n, count(*) FILTER (telugu_romanized IS NULL OR {_STRIP('telugu_romanized')} = '') AS without_romanization FROM final_translations GROUP BY 1")
def romanization_missing(spark: SparkSession, d: str) -> DataFrame:
    blank = F.nullif(text.strip("telugu_romanized"), F.lit("")).isNull()
    return t(spark, d, "final_translations").groupBy(norm_name("domain").alias("domain")).agg(F.count(F.lit(1)).alias("n"), F.count_if(blank).alias("without_romanization"))


@query(f"SELECT doc_id, len(list_filter(string_split_regex(text, '{_WS}+'), lambda x: x <> ''))::INT AS words FROM documents")
def word_counts(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", text.word_count("text").alias("words"))


@query("SELECT doc_id, coalesce(contains(lower(text), 'umbrella') OR contains(lower(text), 'library'), false) AS hit FROM documents")
def marker_mentions(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "documents").select("doc_id", text.mentions_any("text", ["Umbrella", "library"]).alias("hit"))


_DIMENSIONS = [*_LEAST]
_NUMBERED = "SELECT *, (row_number() OVER (ORDER BY sentence_id, updated_at, loaded_at) - 1) // 25 AS chunk_id, row_number() OVER (ORDER BY sentence_id, updated_at, loaded_at) AS n FROM final_translations WHERE sentence_id IS NOT NULL"


@query(f"""SELECT chunk_id, sentence_id, {", ".join(f"CASE WHEN NOT isnan(scores.{k}) THEN scores.{k} END AS {k}" for k in _LEAST)} FROM ({_NUMBERED}) QUALIFY row_number() OVER (PARTITION BY chunk_id, sentence_id ORDER BY n DESC) = 1""")
def last_evaluations(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries as judge's answers, several for a sentence in a chunk at times: the last in a chunk counts."""
    df = t(spark, d, "final_translations").where(F.col("sentence_id").isNotNull()).select("sentence_id", "updated_at", "loaded_at", *[F.col(f"scores.{k}").alias(k) for k in _LEAST])
    sent = parsing.request_payloads(keyed.chunks(df, ["sentence_id", "updated_at", "loaded_at"], 25), {c: c for c in ("sentence_id", *_LEAST)})
    got = parsing.parse_judgements(sent.withColumnRenamed("payload", "response"), _DIMENSIONS)
    value = lambda k: F.nanvl(scores.number(k), F.lit(None).cast("double"))
    return got.select("chunk_id", "sentence_id", *[value(k).alias(k) for k in _LEAST])


_ASKED = "(SELECT row_id, word, (row_number() OVER (ORDER BY row_id) - 1) // 25 AS chunk_id FROM (SELECT row_id, min(coalesce(word, '')) AS word FROM words WHERE row_id IS NOT NULL GROUP BY 1))"


@query(f"""SELECT row_id, CASE WHEN chunk_id % 11 = 0 OR chunk_id % 7 = 0 OR row_id % 5 = 0 OR word = '' THEN 'FAILED' ELSE 'OK' END AS status,
CASE WHEN chunk_id % 11 = 0 THEN 'no_response' WHEN chunk_id % 7 = 0 THEN 'malformed_response' WHEN row_id % 5 = 0 THEN 'omitted' WHEN word = '' THEN 'no_sentences' END AS reason,
CASE WHEN NOT (chunk_id % 11 = 0 OR chunk_id % 7 = 0 OR row_id % 5 = 0 OR word = '') THEN word END AS sentence FROM {_ASKED}""")
def generation_responses(spark: SparkSession, d: str) -> DataFrame:
    """Words asked for in chunks. Of the answers every eleventh is missing, every seventh cut off, and each lacks every fifth row id."""
    w = t(spark, d, "words").where(F.col("row_id").isNotNull()).groupBy("row_id").agg(F.min(F.coalesce("word", F.lit(""))).alias("word"))
    asked = Scratch(spark, "asked").save(keyed.chunks(w, "row_id", 25), "asked")
    own = F.when(F.col("word") != "", F.array(F.struct(F.col("word").alias("sentence"), F.lit("c").alias("context")))).otherwise(F.array())
    sent = parsing.request_payloads(asked.where(F.col("row_id") % 5 != 0).withColumn("sentences", own), {"row_id": "row_id", "sentences": "sentences"})
    cut = F.when(F.col("chunk_id") % 7 == 0, F.expr("left(payload, length(payload) - 1)")).otherwise(F.col("payload"))
    got = sent.where(F.col("chunk_id") % 11 != 0).select("chunk_id", cut.alias("response"))
    parsed = parsing.parse_generation(got, asked.select("chunk_id", "row_id"))
    return parsed.select("row_id", "status", "reason", F.get("sentences", 0)["sentence"].alias("sentence"))


@query("SELECT event_id, TRY_CAST(CASE event_type WHEN 'click' THEN 'n/a' WHEN 'view' THEN json_extract_string(props, '$.k') || '.25' ELSE json_extract_string(props, '$.k') END AS DOUBLE) AS score FROM events")
def score_coercion(spark: SparkSession, d: str) -> DataFrame:
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "string")
    given = F.when(F.col("event_type") == "click", "n/a").when(F.col("event_type") == "view", F.concat(k, F.lit(".25"))).otherwise(k)
    return t(spark, d, "events").select("event_id", scores.number(given).alias("score"))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Sentences through the structural gate, counted by domain and outcome."""
    reason = F.coalesce(validation.structural_reason("sentence", text.strip("word")), F.lit("passed"))
    cur = current_rows(t(spark, d, "final_sentences"), ["domain", "word", "sentence"])
    return cur.groupBy(present_name("domain").alias("domain"), reason.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
