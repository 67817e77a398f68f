"""State of words and sentences as tables with a unique key, changed by joining events, and kept as versioned snapshots."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PENDING, COMPLETE, EXHAUSTED, TRANSLATED, NEEDS_REVIEW = "pending", "complete", "exhausted", "translated", "needs_review"


# Words: pending -> complete | exhausted
def word_status(accepted: Column, rounds: Column, min_passing: int, max_rounds: int) -> Column:
    """The status after a round; the quota is tested before the rounds."""
    return F.when(accepted >= min_passing, COMPLETE).when(rounds >= max_rounds, EXHAUSTED).otherwise(PENDING)


def words_needing_work(state: DataFrame, min_passing: int) -> DataFrame:
    return state.where((F.col("status") == PENDING) & (F.coalesce("accepted_count", F.lit(0)) < min_passing))


def begin_round(state: DataFrame) -> DataFrame:
    return state.withColumn("rounds_attempted", F.when(F.col("status") == PENDING, F.col("rounds_attempted") + 1).otherwise(F.col("rounds_attempted")))


def accepted_counts(accepted: DataFrame, least: int = 1) -> DataFrame:
    """(row_id, n) of the words with at least so many accepted rows."""
    per = accepted.groupBy("row_id").agg(F.count(F.lit(1)).alias("n"))
    return per.where(F.col("n") >= least) if least > 1 else per


def finish_words(state: DataFrame, accepted: DataFrame, min_passing: int, max_rounds: int) -> DataFrame:
    """The word state with counts and statuses by the accepted sentences (row_id, ...); complete and exhausted words stay so."""
    n = accepted_counts(accepted).select("row_id", F.col("n").cast("int").alias("_n"))
    out = state.join(n, "row_id", "left").withColumn("accepted_count", F.coalesce("_n", F.lit(0))).drop("_n")
    done = F.col("status").isin(COMPLETE, EXHAUSTED)
    return out.withColumn("status", F.when(done, F.col("status")).otherwise(word_status(F.col("accepted_count"), F.col("rounds_attempted"), min_passing, max_rounds)))


def reset_exhausted(state: DataFrame) -> DataFrame:
    """Exhausted words are pending again with no rounds attempted; what they have accepted stays."""
    again = F.col("status") == EXHAUSTED
    return state.withColumns({"rounds_attempted": F.when(again, 0).otherwise(F.col("rounds_attempted")), "status": F.when(again, PENDING).otherwise(F.col("status"))})


# Sentences: pending -> translated -> complete, or back to pending, or needs_review
def failed_status(attempts: Column, max_attempts: int) -> Column:
    return F.when(attempts >= max_attempts, NEEDS_REVIEW).otherwise(PENDING)


def sentences_needing_work(state: DataFrame) -> DataFrame:
    return state.where(F.col("status").isin(PENDING, TRANSLATED))


def needs_translation(state: DataFrame) -> DataFrame:
    return state.where(F.coalesce("status", F.lit(PENDING)) == PENDING)


def apply_translations(state: DataFrame, asked: DataFrame, got: DataFrame, tier: int, provider: str, model: str, max_attempts: int) -> DataFrame:
    """The state after a translation pass: each sentence asked for has one attempt more; one with a translation is translated, with
    who made it; one without has failed. asked: (sentence_id); got: (sentence_id, telugu_sentence)."""
    events = asked.select("sentence_id").distinct().join(got.select("sentence_id", F.col("telugu_sentence").alias("_t")), "sentence_id", "left").withColumn("_asked", F.lit(True))
    s = state.join(events, "sentence_id", "left")
    asked_, ok = F.col("_asked").isNotNull(), F.col("_t").isNotNull()
    attempts = F.col("attempts") + F.when(asked_, 1).otherwise(0)
    s = s.withColumn("attempts", attempts)
    new = {
        "status": F.when(ok, TRANSLATED).when(asked_, failed_status(F.col("attempts"), max_attempts)).otherwise(F.col("status")),
        "reason": F.when(ok, F.lit(None)).when(asked_, F.lit("no translation")).otherwise(F.col("reason")),
        "telugu_sentence": F.when(ok, F.col("_t")).otherwise(F.col("telugu_sentence")),
        "tier": F.when(ok, tier).otherwise(F.col("tier")),
        "translation_provider": F.when(ok, provider).otherwise(F.col("translation_provider")),
        "translation_model": F.when(ok, model).otherwise(F.col("translation_model")),
    }
    return s.withColumns(new).drop("_t", "_asked")


def fail_sentences(state: DataFrame, failed: DataFrame, max_attempts: int) -> DataFrame:
    """The state after a gate: rows of failed (sentence_id, reason) go back to pending or to review; no attempt is added."""
    f = failed.groupBy("sentence_id").agg(F.min("reason").alias("_why"))
    s = state.join(f, "sentence_id", "left")
    hit = F.col("_why").isNotNull()
    return s.withColumns({"status": F.when(hit, failed_status(F.col("attempts"), max_attempts)).otherwise(F.col("status")), "reason": F.coalesce("_why", "reason")}).drop("_why")


def accept_sentences(state: DataFrame, accepted: DataFrame, judge_provider: str, judge_model: str) -> DataFrame:
    """The state after judging: rows of accepted (sentence_id, scores, semantic_similarity, overall_score, telugu_romanized) are
    complete, without a reason, with the judge that scored them."""
    cols = ["scores", "semantic_similarity", "overall_score", "telugu_romanized"]
    a = accepted.select("sentence_id", F.struct(*cols).alias("_a"))
    s = state.join(a, "sentence_id", "left")
    hit = F.col("_a").isNotNull()
    new = {c: F.when(hit, F.col(f"_a.{c}")).otherwise(F.col(c)) for c in cols}
    new |= {"status": F.when(hit, COMPLETE).otherwise(F.col("status")), "reason": F.when(~hit, F.col("reason")), "judge_provider": F.when(hit, judge_provider).otherwise(F.col("judge_provider")), "judge_model": F.when(hit, judge_model).otherwise(F.col("judge_model"))}
    return s.withColumns(new).drop("_a")


def status_histogram(state: DataFrame) -> DataFrame:
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def coverage(state: DataFrame) -> DataFrame:
    """One row: words, complete, exhausted, accepted, complete_share (null without words)."""
    return state.agg(
        F.count(F.lit(1)).alias("words"), F.count_if(F.col("status") == COMPLETE).alias("complete"), F.count_if(F.col("status") == EXHAUSTED).alias("exhausted"),
        F.coalesce(F.sum("accepted_count"), F.lit(0)).alias("accepted"), F.avg((F.col("status") == COMPLETE).cast("int")).alias("complete_share"),
    )


class Snapshots:
    """Versions of a table under one folder, any Hadoop file system: v=N directories and a pointer that a rename replaces.

    A reader sees the last version that was completely written; a crash while writing leaves the one before.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        root = self._path(self.path)
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return sorted(int(n[len("_current-") :]) for n in names if n.startswith("_current-") and n[len("_current-") :].isdigit())

    def current(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def read(self, schema: T.StructType | str) -> DataFrame:
        """The current version; an empty table of the schema if there is none."""
        v = self.current()
        if v is None:
            schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/v={v}")

    def write(self, df: DataFrame, keep: int = 3) -> DataFrame:
        """Writes the next version, makes it current by creating its marker through a rename, and drops old ones."""
        v = (self.current() or 0) + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v={v}")
        draft, mark = self._path(f"{self.path}/_draft-{v}"), self._path(f"{self.path}/_current-{v}")
        self._fs.create(draft, True).close()
        if not self._fs.rename(draft, mark):
            raise OSError(f"version {v} of {self.path} could not be made current")
        for old in self.versions()[:-keep]:
            self._fs.delete(self._path(f"{self.path}/_current-{old}"), False)
            self._fs.delete(self._path(f"{self.path}/v={old}"), True)
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/v={v}")


class PartLog:
    """A table that grows by parts, each a folder of its own: writing a part again replaces it, nothing else is rewritten.

    A part counts once it was completely written; what a crash left of one is not read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def parts(self) -> list[str]:
        root = self._path(self.path)
        names = [s.getPath().getName() for s in self._fs.listStatus(root)] if self._fs.exists(root) else []
        return sorted(n for n in names if self.has(n))

    def has(self, part: str) -> bool:
        return self._fs.exists(self._path(f"{self.path}/{part}/_SUCCESS"))

    def read(self, schema: T.StructType | str | None = None, parts: list[str] | None = None) -> DataFrame:
        """All rows, or those of the parts, with the columns of the schema (by default the log's own); none where there is nothing."""
        here = self.parts() if parts is None else [p for p in parts if self.has(p)]
        schema = schema or self.schema
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if not here:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in here])

    def write(self, part: str, df: DataFrame) -> DataFrame:
        kinds = [(f.name, f.dataType) for f in T.StructType.fromDDL(self.schema)]
        whole = df.select(*[F.col(n).cast(k).alias(n) if n in df.columns else F.lit(None).cast(k).alias(n) for n, k in kinds])
        whole.write.mode("overwrite").parquet(f"{self.path}/{part}")
        return self.read(parts=[part])


class Journal:
    """A small record of what a run is doing, as one JSON text; a crash leaves the one before or the new one."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._jvm = spark._jvm

    def _numbers(self) -> list[int]:
        root = self._path(self.path)
        names = [s.getPath().getName() for s in self._fs.listStatus(root)] if self._fs.exists(root) else []
        return sorted(int(n) for n in names if n.isdigit())

    def read(self) -> dict:
        n = self._numbers()
        if not n:
            return {}
        stream = self._fs.open(self._path(f"{self.path}/{n[-1]}"))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8"))
        finally:
            stream.close()

    def write(self, what: dict) -> None:
        old = self._numbers()
        n = (old[-1] if old else 0) + 1
        draft = self._path(f"{self.path}/_draft-{n}")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps(what).encode("utf-8")))
        out.close()
        if not self._fs.rename(draft, self._path(f"{self.path}/{n}")):
            raise OSError(f"the journal {self.path} could not be written")
        for x in old[:-1]:
            self._fs.delete(self._path(f"{self.path}/{x}"), False)
