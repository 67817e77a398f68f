"""Providers, retries, and pools of jobs in flight.

A provider takes the payloads of one job's chunks and later gives a response text per chunk. Jobs are few and live on the driver;
their payloads and responses are tables.
"""

from __future__ import annotations

import logging
import random
import time
from collections import deque
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from enum import Enum
from typing import Protocol


log = logging.getLogger("kolam.providers")


class Status(Enum):
    RUNNING = "running"
    SUCCEEDED = "succeeded"
    PARTIAL = "partially_succeeded"
    FAILED = "failed"
    CANCELLED = "cancelled"
    EXPIRED = "expired"

    @property
    def terminal(self) -> bool:
        return self is not Status.RUNNING

    @property
    def usable(self) -> bool:
        return self in (Status.SUCCEEDED, Status.PARTIAL)


# The services' names for the states of a batch job.
STATUS_NAMES = {
    "JOB_STATE_SUCCEEDED": Status.SUCCEEDED, "JOB_STATE_PARTIALLY_SUCCEEDED": Status.PARTIAL, "JOB_STATE_FAILED": Status.FAILED,
    "JOB_STATE_CANCELLED": Status.CANCELLED, "JOB_STATE_EXPIRED": Status.EXPIRED, "completed": Status.SUCCEEDED, "failed": Status.FAILED,
    "cancelled": Status.CANCELLED, "expired": Status.EXPIRED,
}
# Their names for states that a job leaves again.
RUNNING_NAMES = ("JOB_STATE_PENDING", "JOB_STATE_QUEUED", "JOB_STATE_RUNNING", "validating", "in_progress", "finalizing", "cancelling")


def status_of(name: str) -> Status:
    """The state a service's word stands for. A word not known is taken for a running job, and logged, as results may still come."""
    if name not in STATUS_NAMES and name not in RUNNING_NAMES:
        log.warning("unknown state of a job: %s", name)
    return STATUS_NAMES.get(name, Status.RUNNING)


class Provider(Protocol):
    name: str
    model: str

    def complete(self, payload: str) -> str: ...

    def submit(self, payloads: dict[int, str]) -> str: ...

    def status(self, job: str) -> Status: ...

    def fetch(self, job: str) -> dict[int, str]: ...


class ReplayProvider:
    """Gives stored responses: texts by chunk id, or a function from payload to text. Its jobs are done at once."""

    def __init__(self, answers: dict[int, str] | Callable[[str], str], name: str = "replay", model: str = "stored"):
        self.answers, self.name, self.model = answers, name, model
        self._jobs: dict[str, dict[int, str]] = {}

    def complete(self, payload: str) -> str:
        if not callable(self.answers):
            raise TypeError("stored responses are by chunk; only a function answers a payload")
        text = self.answers(payload)
        if not text:
            raise RuntimeError("empty response")
        return text

    def submit(self, payloads: dict[int, str]) -> str:
        job = f"{self.name}-{len(self._jobs) + 1}"
        got = {k: self.answers(p) if callable(self.answers) else self.answers.get(k) for k, p in payloads.items()}
        self._jobs[job] = {k: v for k, v in got.items() if v}
        return job

    def status(self, job: str) -> Status:
        return Status.SUCCEEDED if job in self._jobs else Status.FAILED

    def fetch(self, job: str) -> dict[int, str]:
        return dict(self._jobs[job])


_registry: dict[str, Callable[..., Provider]] = {"replay": ReplayProvider}


def register(name: str, make: Callable[..., Provider]) -> None:
    _registry[name] = make


def provider(name: str, *args, **kwargs) -> Provider:
    if name not in _registry:
        raise ValueError(f"unknown provider {name!r}; known: {sorted(_registry)}")
    return _registry[name](*args, **kwargs)


# Parts of messages of errors that no repetition mends.
PERMANENT_MARKERS = ("prepayment credits are depleted", "api key not valid", "api_key_invalid", "permission_denied")


def is_permanent(error: BaseException | str, markers: Iterable[str] = PERMANENT_MARKERS) -> bool:
    low = str(error).lower()
    return any(m in low for m in markers)


def backoff(attempt: int, base: float = 2.0, most: float = 30.0, luck: Callable[[], float] = random.random) -> float:
    """Seconds to wait after the attempt (from 1): doubling, bounded, with a fifth more or less."""
    return min(base * 2 ** (attempt - 1), most) * (0.8 + 0.4 * luck())


def with_retry(call: Callable[[], object], attempts: int = 4, base: float = 2.0, most: float = 30.0, sleep: Callable[[float], None] = time.sleep, permanent: Callable[[BaseException], bool] = is_permanent):
    """The call's result; it is repeated after errors that may pass, and the last error is raised."""
    for attempt in range(1, attempts + 1):
        try:
            return call()
        except Exception as error:  # noqa: BLE001
            if attempt == attempts or permanent(error):
                log.error("given up after %d attempts: %s", attempt, error)
                raise
            log.warning("attempt %d failed: %s", attempt, error)
            sleep(backoff(attempt, base, most))


class CircuitOpen(RuntimeError):
    """Submissions are given up."""


@dataclass
class Breaker:
    """Gives up after so many failures in a row, or at once on a permanent error."""

    limit: int = 5
    failures: int = 0

    def ok(self) -> None:
        self.failures = 0

    def failed(self, error: BaseException) -> None:
        self.failures += 1
        if is_permanent(error) or self.failures >= self.limit:
            raise CircuitOpen(str(error)) from error


@dataclass
class Pool:
    """Jobs in flight, bounded by their number and, with chunk_budget, by the chunks of all of them; the first is always let in.

    Queued jobs are lists of chunk ids. A failed submission goes back to the front of the queue. control() is what is needed for taking
    the work up again after a crash, restore() takes it up; journal, if given, gets it after every change of the jobs in flight.
    """

    provider: Provider
    payloads: Callable[[list[int]], dict[int, str]]
    max_jobs: int = 2
    chunk_budget: int | None = None
    breaker: Breaker = field(default_factory=Breaker)
    poll_seconds: float = 30.0
    timeout_seconds: float = 24 * 3600.0
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    queue: deque = field(default_factory=deque)
    flying: dict[str, list[int]] = field(default_factory=dict)
    journal: Callable[[list], None] | None = None

    def _note(self) -> None:
        if self.journal:
            self.journal(self.control())

    def add(self, chunks: list[int]) -> None:
        self.queue.append(list(chunks))

    def _admits(self, chunks: list[int]) -> bool:
        if not self.flying:
            return True
        if len(self.flying) >= self.max_jobs:
            return False
        return self.chunk_budget is None or sum(map(len, self.flying.values())) + len(chunks) <= self.chunk_budget

    def fill(self) -> None:
        while self.queue and self._admits(self.queue[0]):
            chunks = self.queue.popleft()
            try:
                job = self.provider.submit(self.payloads(chunks))
            except Exception as error:  # noqa: BLE001
                log.warning("a job of %d chunks was not taken: %s", len(chunks), error)
                self.queue.appendleft(chunks)
                self.breaker.failed(error)
                return
            self.breaker.ok()
            self.flying[job] = chunks
            self._note()

    def drain(self, done: Callable[[list[int], dict[int, str], Status], None]) -> None:
        """Runs until queue and pool are empty; done gets each job's chunks and responses, none of an unusable job. A job stays in the
        journal until done has returned, so done may get a job twice after a crash."""
        began = self.clock()
        while self.queue or self.flying:
            self.fill()
            ended = [(job, s) for job in list(self.flying) if (s := self.provider.status(job)).terminal]
            for job, s in ended:
                log.info("job %s: %s", job, s.value)
                done(self.flying[job], self.provider.fetch(job) if s.usable else {}, s)
                del self.flying[job]
                self._note()
            if not ended and (self.flying or self.queue):
                if self.clock() - began > self.timeout_seconds:
                    raise TimeoutError("jobs did not end in time")
                self.sleep(self.poll_seconds)

    def control(self) -> list[tuple[str | None, str, list[int]]]:
        return [(job, self.provider.name, chunks) for job, chunks in self.flying.items()] + [(None, self.provider.name, chunks) for chunks in self.queue]

    def restore(self, rows: Iterable[tuple[str | None, str, list[int]]]) -> None:
        for job, _, chunks in rows:
            if job is None:
                self.queue.append(list(chunks))
            else:
                self.flying[job] = list(chunks)


def first_key(settings: dict[str, str], *names: str) -> str:
    """The first of the settings that is there and not blank, as a judge's key and then the generator's."""
    for n in names:
        if (value := (settings.get(n) or "").strip()):
            return value
    raise KeyError(f"none of these is set: {', '.join(names)}")


_clients: dict[tuple, object] = {}


def cached_client(make: Callable[..., object], *args) -> object:
    """make(*args), made once in each process, driver or Python worker."""
    at = (make, args)
    if at not in _clients:
        _clients[at] = make(*args)
    return _clients[at]
