"""Sinks for changes, by name."""

from __future__ import annotations

from collections.abc import Callable

from changeflow.sinks.base import Sink
from changeflow.sinks.files import ConsoleSink, JsonLinesSink
from changeflow.sinks.jdbc import JdbcSink
from changeflow.sinks.table import TableSink
from changeflow.sinks.webhook import WebhookSink

SINKS: dict[str, Callable[..., Sink]] = {"stdout": ConsoleSink, "file": JsonLinesSink, "table": TableSink, "postgres": JdbcSink, "webhook": WebhookSink}


def create(name: str, **settings: object) -> Sink:
    if name not in SINKS:
        raise ValueError(f"unknown sink {name!r}; there are {sorted(SINKS)}")
    return SINKS[name](**settings)
