"""Routing: other names for tables, columns and key columns, and which operations pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import model


@dataclass(frozen=True)
class Route:
    """``operations`` None means inserts, updates and deletes; an empty list lets nothing pass."""

    source_table: str
    destination_table: str = ""
    column_mappings: tuple[tuple[str, str], ...] = ()
    operations: tuple[str, ...] | None = None

    def names(self) -> dict[str, str]:
        """New names by old ones; of several mappings of a column the first holds, an empty name changes nothing."""
        out: dict[str, str] = {}
        for source, to in self.column_mappings:
            out.setdefault(source, to or source)
        return out

    @staticmethod
    def read(table: str, config: Mapping[str, object]) -> Route:
        mappings = tuple((m["source"], m.get("destination") or "") for m in config.get("column_mappings") or ())
        operations = config.get("operations")
        return Route(table, config.get("destination_table") or table, mappings, None if operations is None else tuple(operations))


def _renamed(c: Column, row: Sequence[str], names: Mapping[str, str]) -> Column:
    return F.when(c.isNotNull(), F.struct(*[c.getField(n).alias(names.get(n, n)) for n in row]))


class Router:
    """At most one route a source table; several sources may go to one destination."""

    def __init__(self, routes: Mapping[str, Mapping[str, object]] | None = None) -> None:
        self.routes = {t: Route.read(t, c or {}) for t, c in (routes or {}).items()}

    def add(self, route: Route) -> None:
        self.routes[route.source_table] = route

    def of(self, table: str, schema: str = "public") -> Route | None:
        return self.routes.get(f"{schema}.{table}") or self.routes.get(table)

    def destination(self, table: str, schema: str = "public") -> str:
        route = self.of(table, schema)
        return (route.destination_table or table) if route else table

    def apply(self, changes: DataFrame, table: str, schema: str = "public") -> DataFrame:
        """The changes under their new names; without a route the changes themselves."""
        route = self.of(table, schema)
        if route is None:
            return changes
        operations = model.DATA_OPERATIONS if route.operations is None else route.operations
        passed = changes.where(F.col("_op").isin(*operations) if operations else F.lit(False))
        names = {a: b for a, b in route.names().items() if a != b}
        out = passed.withColumn("_table", F.lit(route.destination_table or table))
        if not names:
            return out
        row = model.columns_of(changes)
        lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        rename = lambda columns: F.transform(columns, lambda c: F.coalesce(F.try_element_at(lookup, c), c))
        key = F.struct(F.col("_key.type").alias("type"), F.when(F.col("_key.type") == model.FULL, F.col("_key.columns")).otherwise(rename(F.col("_key.columns"))).alias("columns"))
        return out.withColumns({"new": _renamed(F.col("new"), row, names), "old": _renamed(F.col("old"), row, names), "_key": key, "_toasted": rename(F.col("_toasted"))})


def fan_in(parts: Sequence[DataFrame]) -> DataFrame:
    """Changes of several sources for one destination; columns that one lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
