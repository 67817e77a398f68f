"""The problems' queries over the tables of one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kolam.functions.names import current_rows, has_text, norm_name, present_name, usable_similarity
from kolam.scratch import Scratch
from kolam.sources.tables import table

SCORES = ("meaning_preservation", "completeness", "hallucination", "target_word_accuracy", "grammar", "naturalness", "context_preservation")


def pairs_within(members: DataFrame, by: list[str], id_: str) -> DataFrame:
    """(by..., id_a, id_b), the smaller id first, of all two different ids that share by: what the pN_found queries state."""
    m = members.select(*by, id_).distinct()
    a, b = m.alias("a"), m.alias("b")
    same = None
    for c in by:
        eq = F.col(f"a.{c}") == F.col(f"b.{c}")
        same = eq if same is None else same & eq
    return a.join(b, same & (F.col(f"a.{id_}") < F.col(f"b.{id_}"))).select(*[F.col(f"a.{c}").alias(c) for c in by], F.col(f"a.{id_}").alias("id_a"), F.col(f"b.{id_}").alias("id_b"))


# 1
def _similarities(spark: SparkSession, d: str) -> DataFrame:
    cur = current_rows(table(spark, d, "final_translations"), ["domain", "semantic_similarity"])
    return cur.select("sentence_id", present_name("domain").alias("domain"), usable_similarity("semantic_similarity").alias("value")).where(F.col("domain").isNotNull() & F.col("value").isNotNull())


def p1_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.cutoffs import keep_fraction_cutoffs

    return keep_fraction_cutoffs(_similarities(spark, d), table(spark, d, "keep_targets"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.cutoffs import keep_fraction_cutoffs

    rows = Scratch(spark, "p1").save(_similarities(spark, d), "similarities")
    cut = keep_fraction_cutoffs(rows, table(spark, d, "keep_targets")).where(F.col("cutoff").isNotNull())
    named = cut.select(F.col("domain").alias("spelled"), norm_name("domain").alias("domain"), "cutoff")
    return rows.join(named, "domain").where(F.col("value") >= F.col("cutoff")).select(F.col("spelled").alias("domain"), "sentence_id").distinct()


# 2
def _texts(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.wordsets import word_set

    en = current_rows(table(spark, d, "final_sentences"), ["sentence"]).where(has_text("sentence")).select(F.lit("sentence").alias("field_name"), "sentence_id", word_set("sentence").alias("words"))
    te = current_rows(table(spark, d, "final_translations"), ["telugu_sentence"]).where(has_text("telugu_sentence"))
    return en.unionByName(te.select(F.lit("telugu_sentence").alias("field_name"), "sentence_id", word_set("telugu_sentence", same_form=True).alias("words")))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.neardup import near_duplicate_groups

    return near_duplicate_groups(_texts(spark, d))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    groups = Scratch(spark, "p2").save(p2_groups(spark, d), "groups")
    shared = groups.groupBy("field_name", "group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")
    return pairs_within(groups.join(shared, ["field_name", "group"]), ["field_name", "group"], "sentence_id").select("field_name", "id_a", "id_b")


# 3
def _sampled_from(spark: SparkSession, d: str) -> DataFrame:
    cur = current_rows(table(spark, d, "final_sentences"), ["domain", "category", "sentence"]).where(has_text("sentence"))
    return cur.select("sentence_id", present_name("domain").alias("domain"), present_name("category").alias("category")).where(F.col("domain").isNotNull() & F.col("category").isNotNull())


def p3_sample(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.sampling import proportional_sample, target_report

    rows = Scratch(spark, "p3").save(_sampled_from(spark, d), "records")
    return proportional_sample(rows, target_report(rows, table(spark, d, "sample_targets"), rows.count() // 8), "sentence_id")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """The targets that can't be met: calibrated to what each needs, its records' probabilities still fall short, and the drawn sample too."""
    from kolam.llm.sampling import calibrated_gaps, proportional_sample, target_report

    rows = Scratch(spark, "p3").save(_sampled_from(spark, d), "records")
    report = target_report(rows, table(spark, d, "sample_targets"), rows.count() // 8)
    sample = proportional_sample(rows, report, "sentence_id")
    drawn = sample.groupBy(F.col("domain").alias("_d"), F.col("category").alias("_c")).agg(F.count(F.lit(1)).alias("drawn"))
    full = calibrated_gaps(rows, report).join(drawn, ["_d", "_c"], "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    return full.where((F.col("gap") > 0) & (F.col("drawn") < F.col("needed"))).select("domain", "category").distinct()


def p3_check(spark: SparkSession, d: str) -> DataFrame:
    """One row: the sample's size, its repeated ids, and the targets of which it has fewer than their floor though they are there; none
    of those where the floors alone are more than the sample."""
    from kolam.llm.sampling import target_report

    box = Scratch(spark, "p3")
    sample = box.save(p3_sample(spark, d), "sample")
    per = sample.groupBy(F.col("domain").alias("_d"), F.col("category").alias("_c")).agg(F.count(F.lit(1)).alias("drawn"))
    report = target_report(_sampled_from(spark, d), table(spark, d, "sample_targets"), 0).join(per, ["_d", "_c"], "left")
    floor = F.least("min_rows", "available")
    below = report.agg(F.count_if(F.coalesce("drawn", F.lit(0)) < floor).alias("below"), F.sum(floor).alias("floors"))
    size = sample.agg(F.count(F.lit(1)).alias("sampled"), (F.count(F.lit(1)) - F.countDistinct("sentence_id")).alias("repeated"))
    both = size.withColumn("k", F.lit(0)).join(below.withColumn("k", F.lit(0)), "k")
    return both.select("sampled", "repeated", F.when(F.col("floors") > F.col("sampled"), 0).otherwise(F.col("below")).alias("below_floor"))


# 4
def _scored(spark: SparkSession, d: str) -> DataFrame:
    cur = current_rows(table(spark, d, "final_translations"), ["scores", "semantic_similarity", "overall_score"])
    return cur.select("sentence_id", *[F.col(f"scores.{s}").alias(s) for s in SCORES], usable_similarity("semantic_similarity").alias("semantic_similarity"), "overall_score")


def p4_ranking(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.ranking import rank_walk

    return rank_walk(_scored(spark, d), [*SCORES, "semantic_similarity", "overall_score"], "sentence_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.ranking import first_places

    ranked = p4_ranking(spark, d)
    return first_places(ranked, ranked.count() // 50, "sentence_id").select("sentence_id")


# 5
MISSING_WORDS = ("", "nan", "na", "n/a", "#n/a", "null", "none", "<na>")  # fixed values: tokens of a missing word


def _tied(spark: SparkSession, d: str, extra: list[str] = []) -> DataFrame:  # noqa: B006
    word = norm_name("word")
    t = table(spark, d, "final_translations").select("row_id", F.when(~word.isin(*MISSING_WORDS), word).alias("word"), *extra)
    row = F.when(F.col("row_id").isNotNull(), F.xxhash64(F.lit("row"), "row_id"))
    return t.withColumn("a", row).withColumn("b", F.when(F.col("word").isNotNull(), F.xxhash64(F.lit("word"), "word")))


def _row_components(spark: SparkSession, d: str) -> DataFrame:
    """(row_id, a, component) of all row ids."""
    from kolam.llm.components import connected_components

    rows = Scratch(spark, "p5").save(_tied(spark, d).select("row_id", "a", "b").distinct(), "ties")
    comp = connected_components(rows.select(F.coalesce("a", "b").alias("a"), F.coalesce("b", "a").alias("b")))
    return rows, comp


def p5_splits(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.components import split_whole_components

    _, comp = _row_components(spark, d)
    rows = _tied(spark, d, ["sentence_id", "loaded_at"]).withColumn("v", F.coalesce("a", "b")).join(comp.withColumnRenamed("vertex", "v"), "v", "left")
    return split_whole_components(rows.select("sentence_id", "row_id", "word", "loaded_at", "component"), table(spark, d, "split_targets"))


def p5_check(spark: SparkSession, d: str) -> DataFrame:
    """One row: rows split, row ids and words whose rows are in several splits, and whether each split is within 0.05 of its share."""
    word = norm_name("word")
    rows = Scratch(spark, "p5").save(p5_splits(spark, d).withColumn("w", F.when(~word.isin(*MISSING_WORDS), word)), "splits")
    torn = lambda c: rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.countDistinct("split").alias("n")).agg(F.count_if(F.col("n") > 1).alias(f"torn_{c}"), F.lit(0).alias("k"))
    share = rows.groupBy("split").agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.sum("n").over(Window.partitionBy()))  # a row per split
    off = table(spark, d, "split_targets").join(share, F.col("split") == F.col("split_name"), "left")
    near = off.agg((F.max(F.abs(F.coalesce(F.col("n") / F.col("of"), F.lit(0.0)) - F.col("target_share"))) <= 0.05).alias("near_targets"), F.lit(0).alias("k"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).alias("k")).join(torn("row_id"), "k").join(torn("w"), "k").join(near, "k").drop("k")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows, comp = _row_components(spark, d)
    ids = rows.where(F.col("row_id").isNotNull()).select("row_id", "a").distinct().join(comp.withColumnRenamed("vertex", "a"), "a")
    return pairs_within(ids, ["component"], "row_id").select(F.col("id_a").alias("row_id_a"), F.col("id_b").alias("row_id_b"))


# 6
def _looks(spark: SparkSession, d: str) -> DataFrame:
    """(sentence_id, field_name, value, form) of the current rows that have the value."""
    from kolam.llm.lookalikes import same_look_column

    cur = current_rows(table(spark, d, "final_translations"), ["telugu_sentence", "telugu_romanized"])
    fields = [F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in ("telugu_sentence", "telugu_romanized")]
    return cur.select("sentence_id", F.inline(F.array(*fields))).where(has_text("value")).withColumn("form", same_look_column("value"))


def p6_forms(spark: SparkSession, d: str) -> DataFrame:
    return _looks(spark, d)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    looks = _looks(spark, d).select("field_name", "sentence_id", F.xxhash64("value").alias("value"), F.xxhash64("form").alias("form"))
    looks = Scratch(spark, "p6").save(looks, "looks")
    # Pairs are made of distinct values, of which a form has few, and only then of the rows that hold them.
    values = looks.select("field_name", "form", "value").distinct()
    a, b = values.alias("a"), values.alias("b")
    on = (F.col("a.field_name") == F.col("b.field_name")) & (F.col("a.form") == F.col("b.form")) & (F.col("a.value") < F.col("b.value"))
    pairs = Scratch(spark, "p6").save(a.join(b, on).select("a.field_name", F.col("a.value").alias("x"), F.col("b.value").alias("y")), "pairs")
    held = looks.select("field_name", "value", "sentence_id")
    first = pairs.join(held.withColumnsRenamed({"value": "x", "sentence_id": "i"}), ["field_name", "x"]).join(held.withColumnsRenamed({"value": "y", "sentence_id": "j"}), ["field_name", "y"])
    return first.select("field_name", F.least("i", "j").alias("id_a"), F.greatest("i", "j").alias("id_b")).distinct()


# 7
def _units(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.wordsets import word_set

    cur = current_rows(table(spark, d, "final_translations"), ["row_id", "batch_no", "status", "telugu_sentence"]).where(has_text("telugu_sentence") & F.col("row_id").isNotNull())
    return cur.select("sentence_id", "row_id", "batch_no", (norm_name("status") == "complete").alias("complete"), word_set("telugu_sentence", same_form=True).alias("words"))


def p7_repeats(spark: SparkSession, d: str) -> DataFrame:
    """Unit by unit: each is checked against the table of the units before it, then its own rows are appended."""
    from kolam.llm.history import PivotHistory

    box = Scratch(spark, "p7")
    spread = _units(spark, d).repartition("batch_no", F.pmod(F.xxhash64("sentence_id"), F.lit(8)))
    rows = box.save(spread, "units", by=["batch_no"])  # a unit's check reads its own rows only
    history = PivotHistory(spark, f"{box.path}/history", buckets=16)
    found = None
    for r in rows.where(F.col("batch_no").isNotNull()).groupBy("batch_no").agg(F.count_if("complete").alias("n")).orderBy("batch_no").collect():  # a row per unit
        unit = rows.where(F.col("batch_no") == r["batch_no"])
        repeats = box.save(history.repeats(unit, "row_id", "batch_no", box=box), "repeats")
        found = repeats if found is None else found.unionByName(repeats)
        if r["n"]:
            history.append(unit, "row_id", "batch_no", F.col("complete"))
    return found if found is not None else rows.withColumn("first_unit", F.col("batch_no")).drop("words")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_repeats(spark, d).select("sentence_id").distinct()


# 8, 9
def _sized(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.tokens import token_count

    return table(spark, d, "documents").select("doc_id", "source", token_count("text").alias("tokens"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.packing import pack

    return pack(_sized(spark, d).select("doc_id", "tokens"), "doc_id", "tokens")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_containers(spark, d).groupBy("doc_id").agg(F.max("piece").alias("last")).where(F.col("last") > 0).select("doc_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """One row: containers, the tokens in them, and the share of their room that is used."""
    per = p8_containers(spark, d).groupBy("container").agg(F.sum("size").alias("used"))
    return per.agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), (F.sum("used") / (F.count(F.lit(1)) * 2048)).alias("filled"))


def p8_check(spark: SparkSession, d: str) -> DataFrame:
    """One row: documents placed, containers that hold too much, documents split without need, and whether 98 % of all room but one container's is used."""
    placed = Scratch(spark, "p8").save(p8_containers(spark, d), "placed")
    fill = placed.groupBy("container").agg(F.sum("size").alias("n")).agg(F.count_if(F.col("n") > 2048).alias("overfull"), (F.sum("n") >= 0.98 * 2048 * (F.count(F.lit(1)) - 1)).alias("well_filled"), F.lit(0).alias("k"))
    docs = placed.groupBy("doc_id").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("pieces"))
    docs = docs.agg(F.count(F.lit(1)).alias("documents"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= 2048)).alias("split_without_need"), F.lit(0).alias("k"))
    return docs.join(fill, "k").drop("k")


def p9_check(spark: SparkSession, d: str) -> DataFrame:
    """One row: targets, sources used more often than allowed, and those off their planned size by more than their largest document."""
    from kolam.llm.mixing import mix_sources

    sized = Scratch(spark, "p9").save(_sized(spark, d), "sized")
    report, copies = mix_sources(sized, table(spark, d, "mix_targets"), "doc_id", "tokens")
    largest = sized.groupBy(norm_name("source").alias("s")).agg(F.max("tokens").alias("largest"))
    most = copies.groupBy(F.col("source").alias("s")).agg(F.max("copies").alias("most"))
    both = report.withColumn("s", norm_name("source")).join(largest, "s", "left").join(most, "s", "left")
    off = F.abs(F.col("used") - F.col("planned")) > F.coalesce("largest", F.lit(0))
    return both.agg(F.count(F.lit(1)).alias("targets"), F.count_if(F.col("most") > F.col("max_copies")).alias("over_copied"), F.count_if(off).alias("off_plan"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.mixing import mix_sources

    return mix_sources(_sized(spark, d), table(spark, d, "mix_targets"), "doc_id", "tokens")[1]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.mixing import mix_sources

    return mix_sources(_sized(spark, d), table(spark, d, "mix_targets"), "doc_id", "tokens")[0]


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """The sources that the first round of the water-filling clamps, and by less than their target."""
    return p9_report(spark, d).where((F.col("clamped") == 1) & ~F.col("reachable")).select("source").distinct()


# 10
def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.languages import fit_languages, language_segments

    docs = table(spark, d, "documents")
    return language_segments(docs.where(has_text("text")), fit_languages(docs))


def p10_documents(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.languages import document_language

    return document_language(p10_segments(spark, d))


def p10_by_script(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, lang) of the documents written almost wholly in a script that only one of the languages has, as their stretches say."""
    share = lambda lo, hi: F.length(F.regexp_replace("text", f"[^\\x{{{lo}}}-\\x{{{hi}}}]", "")) / F.length(F.regexp_replace("text", r"[\s\p{Z}]", ""))
    docs = table(spark, d, "documents").where(has_text("text"))
    one = F.when(share("0C00", "0C7F") >= 0.9, "te").when(share("0900", "097F") >= 0.9, "hi").when(share("0B80", "0BFF") >= 0.9, "ta")
    written = docs.select("doc_id", one.alias("lang")).where(F.col("lang").isNotNull())
    return p10_segments(spark, d).select("doc_id", "lang").distinct().join(written, ["doc_id", "lang"])


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from kolam.llm.languages import fit_languages, label_language, language_segments

    docs = table(spark, d, "documents")
    given = docs.where(has_text("text")).select(F.struct("doc_id", label_language("lang").alias("named")).alias("id"), "text")
    found = language_segments(given, fit_languages(docs), key="id")
    return found.where((F.col("lang") != "und") & ~F.col("lang").eqNullSafe(F.col("id.named"))).select(F.col("id.doc_id").alias("doc_id"), "lang").distinct()


def queries() -> dict:
    return {k: v for k, v in globals().items() if k[:1] == "p" and k[1:2].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    from kolam.llm.oracles import ORACLES

    return ORACLES
