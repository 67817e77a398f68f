"""Requests to chat models, built from a chunk's payload: one call, or the lines of a batch file. Providers that reach a network are
made from these and a client; without a client library they can't be made, and stored responses serve instead."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from kolam.providers.base import Status, status_of, with_retry


@dataclass(frozen=True)
class Style:
    """How a service wants its requests: array answers as they are, or one JSON object that wraps them under a name."""

    wrapper: str | None = None
    temperature: float | None = None
    max_output_tokens: int = 16_384
    thinking: str | None = None


def chat_request(payload: str, prompt: str, model: str, style: Style = Style()) -> dict:
    """model, messages and limits of a call. A temperature of none or 1 is left out, as some models take no other."""
    ask = payload if style.wrapper is None else f'{payload}\n\nAnswer with one JSON object {{"{style.wrapper}": [...]}} that holds one entry for each record.'
    out: dict = {"model": model, "messages": [{"role": "system", "content": prompt}, {"role": "user", "content": ask}], "max_output_tokens": style.max_output_tokens}
    if style.wrapper:
        out["response_format"] = {"type": "json_object"}
    if style.temperature not in (None, 1, 1.0):
        out["temperature"] = style.temperature
    if style.thinking:
        out["thinking_level"] = style.thinking
    return out


def batch_lines(payloads: dict[int, str], prompt: str, model: str, style: Style = Style()) -> list[str]:
    """A line of a batch file for each chunk, which its id tells again in the answer."""
    return [json.dumps({"custom_id": f"chunk-{k}", "body": chat_request(p, prompt, model, style)}, ensure_ascii=False) for k, p in sorted(payloads.items())]


def content_request(payload: str, prompt: str, style: Style = Style()) -> dict:
    """The other common form: contents with a system instruction and a generation setting; JSON is asked for by its type."""
    ask = payload if style.wrapper is None else f'{payload}\n\nAnswer with one JSON object {{"{style.wrapper}": [...]}} that holds one entry for each record.'
    setting: dict = {"response_mime_type": "application/json", "max_output_tokens": style.max_output_tokens}
    if style.temperature is not None:
        setting["temperature"] = style.temperature
    if style.thinking:
        setting["thinking_config"] = {"thinking_level": style.thinking}
    return {"contents": [{"role": "user", "parts": [{"text": ask}]}], "system_instruction": {"parts": [{"text": prompt}]}, "generation_config": setting}


def inlined_requests(payloads: dict[int, str], prompt: str, style: Style = Style()) -> list[dict]:
    """The requests of a job that takes them inline, each with its chunk's id as metadata."""
    return [{"request": content_request(p, prompt, style), "metadata": {"chunk_id": f"chunk-{k}"}} for k, p in sorted(payloads.items())]


def chunk_of(custom_id: str) -> int | None:
    """The chunk an answer's id names; null for any other id."""
    kind, _, number = custom_id.partition("-")
    return int(number) if kind == "chunk" and number.isdigit() else None


@dataclass
class ClientProvider:
    """A provider over a client's four functions: call(request) -> text, upload(lines or inlined requests) -> job, look(job) -> the
    service's word for its state, download(job) -> (custom id, text or none) pairs. inline: the service takes requests with contents,
    inlined in a job, instead of chat requests as lines of a file."""

    name: str
    model: str
    prompt: str
    call: Callable[[dict], str]
    upload: Callable[[list[str]], str]
    look: Callable[[str], str]
    download: Callable[[str], list[tuple[str, str | None]]]
    style: Style = field(default_factory=Style)
    attempts: int = 4
    base: float = 2.0
    most: float = 30.0
    inline: bool = False

    def complete(self, payload: str) -> str:
        def once() -> str:
            text = self.call(content_request(payload, self.prompt, self.style) if self.inline else chat_request(payload, self.prompt, self.model, self.style))
            if not text:
                raise RuntimeError("empty response")
            return text

        return with_retry(once, self.attempts, self.base, self.most)

    def submit(self, payloads: dict[int, str]) -> str:
        return self.upload(inlined_requests(payloads, self.prompt, self.style) if self.inline else batch_lines(payloads, self.prompt, self.model, self.style))

    def status(self, job: str) -> Status:
        return status_of(self.look(job))

    def fetch(self, job: str) -> dict[int, str]:
        pairs = ((chunk_of(i), t) for i, t in self.download(job))
        return {k: t for k, t in pairs if k is not None and t}
