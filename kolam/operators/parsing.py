"""Model responses, parsed in the JVM. A malformed payload is data: it becomes failed rows, never an exception."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kolam.functions.names import as_col
from kolam.functions.text import strip


def payload_items(text, *wrappers: str) -> Column:
    """array<variant> of the records in a payload: a bare array, an object that wraps one under one of the names, or a single object
    (taken as one record). Null where the text isn't JSON or has none of these shapes."""
    v = F.try_parse_json(as_col(text))
    kind = F.schema_of_variant(v)
    wrapped = [F.try_variant_get(v, f"$.{w}", "array<variant>") for w in wrappers]
    return F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(kind.startswith("OBJECT"), F.coalesce(*wrapped, F.array(v)))


def field(item, path: str, kind: str) -> Column:
    return F.try_variant_get(as_col(item), path, kind)


def _exploded(responses: DataFrame, text: str, *wrappers: str) -> DataFrame:
    return responses.withColumn("_items", payload_items(text, *wrappers)).select("*", F.posexplode_outer("_items").alias("pos", "item")).drop("_items")


def parse_generation(responses: DataFrame, requests: DataFrame, chunk: str = "chunk_id", text: str = "response") -> DataFrame:
    """(chunk, row_id, sentences array<struct<sentence, context>>, status, reason), a row per requested row_id.

    responses: (chunk, text); requests: (chunk, row_id, ...). Of an id answered twice the last counts. status is OK, or FAILED with
    malformed_response (the chunk's payload), no_response (the chunk has none) or omitted (this row). Ids nobody asked for are ignored.
    """
    items = _exploded(responses, text, "records")
    sentence = lambda s: F.struct(F.try_variant_get(s, "$.sentence", "string").alias("sentence"), F.coalesce(F.try_variant_get(s, "$.context", "string"), F.lit("")).alias("context"))
    rows = items.where(F.col("item").isNotNull()).select(chunk, "pos", field("item", "$.row_id", "int").alias("row_id"), F.transform(field("item", "$.sentences", "array<variant>"), sentence).alias("sentences"))
    last = rows.where(F.col("row_id").isNotNull()).groupBy(chunk, "row_id").agg(F.max_by("sentences", "pos").alias("sentences"), F.lit(True).alias("_got"))
    state = responses.select(chunk, F.when(payload_items(text, "records").isNull(), "malformed_response").otherwise("omitted").alias("_why")).groupBy(chunk).agg(F.max("_why").alias("_why"))
    out = requests.join(last, [chunk, "row_id"], "left").join(state, chunk, "left")
    empty = F.coalesce(F.size("sentences"), F.lit(0)) == 0
    return out.withColumns({
        "status": F.when(empty, "FAILED").otherwise("OK"),
        "reason": F.when(F.col("_got") & empty, "no_sentences").when(F.col("_got").isNull(), F.coalesce("_why", F.lit("no_response"))),
    }).drop("_got", "_why")


def parse_judgements(responses: DataFrame, dimensions: list[str], chunk: str = "chunk_id", text: str = "response") -> DataFrame:
    """(chunk, sentence_id, a string column per dimension, judge_decision, judge_reason, telugu_romanized): the last evaluation of
    each sentence of a chunk.

    Takes a bare array, {"evaluations": [...]} of records with results or of evaluations, or a single evaluation. Scores stay text,
    so that "0.9" and 0.9 are the same and anything else shows as a missing score later.
    """
    items = _exploded(responses, text, "evaluations").where(F.col("item").isNotNull())
    inner = F.coalesce(field("item", "$.results", "array<variant>"), F.array("item"))
    flat = items.select(chunk, "pos", F.posexplode(inner).alias("pos2", "e"))
    cols = [field("e", f"$.{d}", "string").alias(d) for d in dimensions]
    rows = flat.select(chunk, field("e", "$.sentence_id", "string").alias("sentence_id"), F.struct("pos", "pos2").alias("o"), F.struct(*cols, field("e", "$.decision", "string").alias("judge_decision"), field("e", "$.reason", "string").alias("judge_reason"), F.nullif(strip(field("e", "$.telugu_romanized", "string")), F.lit("")).alias("telugu_romanized")).alias("r"))
    return rows.where(F.col("sentence_id").isNotNull()).groupBy(chunk, "sentence_id").agg(F.max_by("r", "o").alias("r")).select(chunk, "sentence_id", "r.*")


def parse_translations(responses: DataFrame, chunk: str = "chunk_id", text: str = "response") -> DataFrame:
    """(chunk, sentence_id, telugu_sentence), trimmed and not blank; the last of each sentence. Failed and omitted ones are absent."""
    items = _exploded(responses, text, "translations").where(F.col("item").isNotNull())
    rows = items.select(chunk, "pos", field("item", "$.sentence_id", "string").alias("sentence_id"), strip(field("item", "$.telugu_sentence", "string")).alias("telugu_sentence"))
    rows = rows.where((F.coalesce("sentence_id", F.lit("")) != "") & (F.coalesce("telugu_sentence", F.lit("")) != ""))
    return rows.groupBy(chunk, "sentence_id").agg(F.max_by("telugu_sentence", "pos").alias("telugu_sentence"))


def request_payloads(chunked: DataFrame, fields: dict[str, str], chunk: str = "chunk_id", order: str = "pos_in_chunk") -> DataFrame:
    """(chunk, payload): the JSON array a chunk's request carries, in order. fields: name in the payload -> column. Chunks are small
    by construction, so a chunk is one row."""
    item = F.struct(F.col(order).alias("o"), F.struct(*[F.col(c).alias(n) for n, c in fields.items()]).alias("r"))
    packed = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["r"])
    return chunked.groupBy(chunk).agg(F.to_json(packed, {"ignoreNullFields": "false"}).alias("payload"))
