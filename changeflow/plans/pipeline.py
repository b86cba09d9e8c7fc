"""Rules, then routing, over the changes of a table; the same plan for batches and micro-batches."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from changeflow import model
from changeflow.operators.routing import Router, fan_in
from changeflow.operators.rules import RuleEngine
from changeflow.sinks.base import Sink


class Pipeline:
    """Rules see source names; routing comes after them."""

    def __init__(self, rules: RuleEngine | None = None, router: Router | None = None) -> None:
        self.rules, self.router = rules or RuleEngine(), router or Router()

    def run(self, changes: DataFrame, table: str, schema: str = "public") -> DataFrame:
        return self.router.apply(self.rules.apply(changes, table, schema), table, schema)

    def run_all(self, tables: Mapping[str, DataFrame], schema: str = "public") -> dict[str, DataFrame]:
        """The changes of each destination; sources of one destination are put together."""
        by: dict[str, list[DataFrame]] = {}
        for table, changes in tables.items():
            by.setdefault(self.router.destination(table, schema), []).append(self.run(changes, table, schema))
        return {t: fan_in(parts) for t, parts in by.items()}

    def deliver(self, tables: Mapping[str, DataFrame], sink: Sink, batch: int = 0, schema: str = "public") -> None:
        for table, changes in self.run_all(tables, schema).items():
            sink.write(changes, table, batch)

    def key(self, table: str, key: model.ReplicationKey, schema: str = "public") -> model.ReplicationKey:
        """The key under the names that routing gives."""
        route = self.router.of(table, schema)
        return key.renamed(route.names()) if route else key
