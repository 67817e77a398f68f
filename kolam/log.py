"""Logging of a run: to the terminal and to a file, on the driver."""

from __future__ import annotations

import logging
import os


def start(file: str | None = None, level: str = "INFO") -> logging.Logger:
    """The logger "kolam" with a handler for the terminal and, with file, one for it; called again it replaces them."""
    log = logging.getLogger("kolam")
    log.setLevel(level.upper())
    for h in list(log.handlers):
        log.removeHandler(h)
        h.close()
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if file:
        os.makedirs(os.path.dirname(file) or ".", exist_ok=True)
        handlers.append(logging.FileHandler(file, encoding="utf-8"))
    for h in handlers:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
        log.addHandler(h)
    log.propagate = False
    return log
