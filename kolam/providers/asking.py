"""Asking a provider for the responses to a table of payloads, and keeping them as they come.

Chunks are numbered without gaps, so a job is a stretch of numbers, and its answers are one part of the responses: the parts there are
tell which jobs are done. The journal holds the jobs in flight. A run that was stopped asks neither for what is stored nor for what is
in flight again; only a job submitted in the very moment of the stop is lost.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kolam.operators.state import Journal, PartLog
from kolam.providers.base import Pool, Provider, Status, is_permanent
from kolam.scratch import Scratch, local_table

RESPONSES = "chunk_id BIGINT, response STRING, error STRING"
log = logging.getLogger("kolam.asking")


def responses_in_parallel(payloads: DataFrame, provider: Provider, workers: int) -> DataFrame:
    """(chunk_id, response, error) by synchronous calls from the executors, workers at a time; a call that fails for now gives its
    error, one that fails for good ends the job.

    The result must be written before it is used: a plan over it would call again.
    """

    def call(batches):
        import pandas as pd

        for p in batches:
            out = []
            for chunk, payload in zip(p["chunk_id"], p["payload"]):
                try:
                    out.append((chunk, provider.complete(payload), None))
                except Exception as error:  # noqa: BLE001
                    if is_permanent(error):
                        raise
                    out.append((chunk, None, str(error)[:500]))
            yield pd.DataFrame(out, columns=["chunk_id", "response", "error"], dtype=object).astype({"chunk_id": "int64"})

    return payloads.select("chunk_id", "payload").repartition(workers).mapInPandas(call, RESPONSES)


class Asker:
    """The responses and the journal of a run's folder."""

    def __init__(self, spark: SparkSession, folder: str, other: Callable[[str], Provider | None] = lambda name: None, **pool):
        self.spark, self.other, self.pool = spark, other, pool
        self.responses = PartLog(spark, f"{folder}/responses", RESPONSES)
        self.journal = Journal(spark, f"{folder}/journal")

    def note(self, **what) -> None:
        """Sets entries of the journal; null removes one."""
        self.journal.write({k: v for k, v in (self.journal.read() | what).items() if v is not None})

    def stored(self, scope: str) -> DataFrame:
        """(chunk_id, response) of a scope, as far as there are any. A job that was stored twice counts once."""
        mine = [p for p in self.responses.parts() if p.startswith(f"{scope}=")]
        return self.responses.read(parts=mine).where(F.col("response").isNotNull()).select("chunk_id", "response")

    def ask(self, scope: str, payloads: DataFrame, provider: Provider, per_job: int, max_jobs: int, workers: int | None = None) -> DataFrame:
        """(chunk_id, response) of the payloads (chunk_id, payload): by batch jobs, or with workers by synchronous calls. scope names the
        phase; asked again it goes on with what is missing."""
        table = Scratch(self.spark, "payloads").save(payloads.select("chunk_id", "payload").repartitionByRange("chunk_id").sortWithinPartitions("chunk_id"), "payloads")
        last = table.agg(F.max("chunk_id")).first()[0]
        chunks = 0 if last is None else last + 1
        name = lambda job: f"{scope}={per_job}-{job[0] // per_job}"
        jobs = [[*range(i, min(i + per_job, chunks))] for i in range(0, chunks, per_job)]
        jobs = [j for j in jobs if not self.responses.has(name(j))]
        own = lambda job: table.where(F.col("chunk_id").between(job[0], job[-1]))
        log.info("%s: %d of %d chunks to ask for", scope, sum(map(len, jobs)), chunks)
        if workers:
            for j in jobs:
                got = self.responses.write(name(j), responses_in_parallel(own(j), provider, workers))
                failed = got.where(F.col("error").isNotNull()).count()
                if failed:
                    log.warning("%s: %d of %d calls failed", scope, failed, len(j))
            return self.stored(scope)
        flying = self.finish(scope, provider, name)
        p = self._pool(scope, provider, lambda job: {r["chunk_id"]: r["payload"] for r in own(job).collect()}, max_jobs=max_jobs, chunk_budget=per_job * max_jobs)
        for j in jobs:
            if j[0] not in flying:
                p.add(j)
        p.drain(self._keep(name))
        self.note(**{scope: None})
        return self.stored(scope)

    def _pool(self, scope: str, provider: Provider, payloads, **how) -> Pool:
        note = lambda rows: self.note(**{scope: [[job, who, chunks] for job, who, chunks in rows if job is not None]})
        return Pool(provider, payloads, journal=note, **(self.pool | how))

    def _keep(self, name):
        def done(chunks: list[int], answers: dict[int, str], status: Status) -> None:
            rows = [(c, answers.get(c), None if c in answers else status.value) for c in chunks]
            self.responses.write(name(chunks), local_table(self.spark, rows, RESPONSES))

        return done

    def finish(self, scope: str, provider: Provider, name=None) -> set[int]:
        """Waits for a scope's jobs in flight and keeps their answers, with the provider that took them; the first chunks of those jobs.
        Jobs of a provider that is no longer known are dropped, and their chunks asked for again."""
        rows = self.journal.read().get(scope) or []
        ended: set[int] = set()
        for who in dict.fromkeys(r[1] for r in rows):
            by = provider if who == provider.name else self.other(who)
            mine = [tuple(r) for r in rows if r[1] == who]
            if by is None:
                log.warning("%s: %d jobs of %s can't be taken up again", scope, len(mine), who)
                continue
            log.info("%s: %d jobs in flight are taken up again", scope, len(mine))
            p = self._pool(scope, by, lambda chunks: {}, max_jobs=len(mine))
            p.restore(mine)
            p.drain(self._keep(name or (lambda job, n=len(mine[0][2]): f"{scope}={n}-{job[0] // n}")))
            ended |= {r[2][0] for r in mine}
        if rows:
            self.note(**{scope: None})
        return ended
