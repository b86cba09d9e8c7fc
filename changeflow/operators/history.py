"""The history of a table's columns: what a name means at a position of the stream.

A column is an identity; names and types are what it has from one position (``_seq``) to the next. A change of
the schema makes a version, the ordered identities and their names from its position on. A row tells the
names of its columns in the order of the table, so it is read by the version that has these names; where
several have (a column dropped and added again under its name), by the one in force at its position, and
where none has, by the one that agrees best. So rows meet the right columns whichever comes first in a log,
rows or command, and a name that was given up and given again means two columns.

``Catalog`` has the tables, which are identities with names likewise.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import pgtypes
from changeflow.operators.ddl import SchemaChange, parse

#: Before every position, and after it.
START, END = -(2**63), 2**63 - 1


@dataclass(frozen=True)
class Version:
    """(identity, name) of the columns in their order, from a position on."""

    since: int
    columns: tuple[tuple[int, str], ...] = ()

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(n for _, n in self.columns)


@dataclass(frozen=True)
class Reading:
    """How rows with these names, from ``since`` up to ``until``, are read: the place of each present column (0: none) and what each of their names is called now (None: gone)."""

    names: tuple[str, ...]
    since: int
    until: int
    places: tuple[int, ...]
    renamed: tuple[str | None, ...]


@dataclass
class TableHistory:
    """The versions of one table, the last one in force; ``types`` by identity, ``merged`` identities that turned out to be others."""

    name: str
    versions: list[Version] = field(default_factory=lambda: [Version(START)])
    types: dict[int, T.StructField] = field(default_factory=dict)
    merged: dict[int, int] = field(default_factory=dict)
    earlier: list[str] = field(default_factory=list)

    @staticmethod
    def of(name: str, row: T.StructType) -> TableHistory:
        made = TableHistory(name)
        for f in row:
            made._new(f)
        return made

    @property
    def row(self) -> T.StructType:
        """The columns in force."""
        return T.StructType([T.StructField(n, self.types[i].dataType, True, self.types[i].metadata) for i, n in self.versions[-1].columns])

    def _new(self, f: T.StructField) -> int:
        """A column that no command announced: it is there in the last version from now on."""
        number = max(self.types, default=0) + 1
        self.types[number] = f
        last = self.versions[-1]
        self.versions[-1] = Version(last.since, (*last.columns, (number, f.name)))
        return number

    def _identity(self, number: int) -> int:
        while number in self.merged:
            number = self.merged[number]
        return number

    def apply(self, changes: Sequence[SchemaChange], at: int) -> None:
        """Schema changes at a position; one that names what is not there is one that was applied before."""
        for c in changes:
            columns = list(self.versions[-1].columns)
            place = {n: k for k, (_, n) in enumerate(columns)}
            if c.action == "add" and c.column not in place:
                number = max(self.types, default=0) + 1
                self.types[number] = T.StructField(c.column, T._parse_datatype_string(c.to))
                columns.append((number, c.column))
            elif c.action == "drop" and c.column in place:
                del columns[place[c.column]]
            elif c.action == "rename" and c.column != c.to and (c.column in place or c.to not in place):
                if c.column not in place:  # a table whose rows were not seen yet
                    number = max(self.types, default=0) + 1
                    self.types[number] = T.StructField(c.to, T.StringType())
                    self.versions[-1] = Version(self.versions[-1].since, (*columns, (number, c.column)))
                    columns.append((number, c.to))
                else:
                    number = columns[place[c.column]][0]
                    columns[place[c.column]] = (number, c.to)
                    if c.to in place:  # rows under the new name came before the command
                        self.merged[columns[place[c.to]][0]] = number
                        del columns[place[c.to]]
            elif c.action == "retype" and c.column in place:
                number = columns[place[c.column]][0]
                self.types[number] = T.StructField(c.column, T._parse_datatype_string(c.to))
            if tuple(columns) != self.versions[-1].columns:
                self.versions.append(Version(at, tuple(columns)))

    def _bindings(self, names: tuple[str, ...]) -> list[tuple[int, int, dict[str, int]]]:
        """(since, until, identity by name) for rows with these names."""
        same = [v for v in self.versions if v.names == names]
        if same:
            ends = [*(v.since for v in same[1:]), END]
            return [(START if k == 0 else v.since, ends[k], {n: self._identity(i) for i, n in v.columns}) for k, v in enumerate(same)]
        asked = set(names)
        score = lambda v: len(asked & set(v.names)) - len(set(v.names) - asked)
        best = max(enumerate(self.versions), key=lambda kv: (score(kv[1]), kv[0]))[1]
        bound = {n: self._identity(i) for i, n in best.columns if n in asked}
        for n in names:
            if n not in bound:  # a name that the column had before, or has later
                others = [self._identity(i) for v in reversed(self.versions) for i, m in v.columns if m == n]
                free = [i for i in others if i not in bound.values()]
                if free:
                    bound[n] = free[0]
        return [(START, END, bound)]

    def meet(self, columns: Iterable[tuple[str, int]]) -> None:
        """Columns (name, type number) of rows: those that nothing tells of yet are new; what only a command told gets its type."""
        given = tuple(columns)
        names = tuple(n for n, _ in given)
        bound = self._bindings(names)[-1][2]
        for name, oid in given:
            f = T.StructField(name, pgtypes.spark_type(oid), True, {"pg_oid": oid})
            if name not in bound:
                self._new(f)
            elif "pg_oid" not in (self.types[bound[name]].metadata or {}) and self.types[bound[name]].dataType == T.StringType():
                self.types[bound[name]] = f

    def readings(self, lists: Iterable[Sequence[str]]) -> list[Reading]:
        """How rows of each list of names are read as the columns in force."""
        out, now = [], {self._identity(i): n for i, n in self.versions[-1].columns}
        for names in dict.fromkeys(tuple(x) for x in lists):
            for since, until, bound in self._bindings(names):
                place = {number: k + 1 for k, n in enumerate(names) if (number := bound.get(n)) is not None}
                out.append(Reading(names, since, until, tuple(place.get(self._identity(i), 0) for i, _ in self.versions[-1].columns), tuple(now.get(bound.get(n)) for n in names)))
        return out

    def state(self) -> dict:
        return {
            "name": self.name, "versions": [[v.since, v.columns] for v in self.versions], "types": {str(i): f.jsonValue() for i, f in self.types.items()},
            "merged": {str(a): b for a, b in self.merged.items()}, "earlier": self.earlier,
        }

    @staticmethod
    def restored(s: dict) -> TableHistory:
        versions = [Version(since, tuple((i, n) for i, n in columns)) for since, columns in s["versions"]]
        return TableHistory(s["name"], versions, {int(i): T.StructField.fromJson(f) for i, f in s["types"].items()}, {int(a): b for a, b in s["merged"].items()}, s["earlier"])


def reading_of(readings: Sequence[Reading], names: Column, seq: Column) -> Column:
    """The number of the reading for a row, or null."""
    found = F.lit(None).cast("int")
    for k, r in enumerate(readings):
        here = names == F.array(*map(F.lit, r.names)).cast("array<string>")
        if r.since > START:
            here = here & (seq >= r.since)
        if r.until < END:
            here = here & (seq < r.until)
        found = F.when(here, k).otherwise(found)
    return found


@dataclass
class Catalog:
    """The tables of a group: which table a name means at a position.

    ``spans`` has by name the positions from which it means a table, by number, or none.
    """

    tables: dict[int, TableHistory] = field(default_factory=dict)
    spans: dict[str, list[tuple[int, int | None]]] = field(default_factory=dict)
    #: Commands that were applied, by position: a log may tell one twice.
    done: list[tuple[int, str]] = field(default_factory=list)

    #: Commands remembered.
    MOST = 1000

    def table(self, name: str, at: int = END) -> TableHistory:
        """The table that a name means at a position; a new one if it means none."""
        spans = self.spans.setdefault(name, [])
        k = max((k for k, (since, _) in enumerate(spans) if since <= at), default=0)
        if spans and spans[k][1] is not None:
            return self.tables[spans[k][1]]
        number = max(self.tables, default=0) + 1
        self.tables[number] = TableHistory(name)
        if spans:
            spans[k] = (spans[k][0], number)
        else:
            spans.append((START, number))
        return self.tables[number]

    def add(self, name: str, row: T.StructType) -> None:
        self.table(name)
        self.tables[self.spans[name][-1][1]] = TableHistory.of(name, row)

    def apply(self, name: str, command: str, at: int) -> tuple[TableHistory, list[SchemaChange]] | None:
        """A command on the table that has the name at its position: the table and the changes; None if it was applied before."""
        if (at, command) in self.done:
            return None
        self.done = [*self.done, (at, command)][-self.MOST :]
        changes = parse(command)
        for c in changes:
            if c.action == "rename_table":  # the event trigger tells the new name
                own = c.table.rpartition(".")[2]
                if own != c.to:
                    table = self.table(own, at)
                    number = next(n for n, t in self.tables.items() if t is table)
                    self.spans[own].append((at, None))
                    spans = self.spans.setdefault(c.to, [])
                    spans.append((at if spans else START, number))
                    table.earlier.append(table.name)
                    table.name = c.to
                    return table, changes
                return None
        table = self.table(name, at)
        table.apply(changes, at)
        return table, changes

    def names_of(self, table: TableHistory) -> list[tuple[str, int, int]]:
        """(name, since, until) under which rows of a table come."""
        out = []
        for name, spans in self.spans.items():
            for k, (since, number) in enumerate(spans):
                if number is not None and self.tables[number] is table:
                    out.append((name, START if k == 0 else since, spans[k + 1][0] if k + 1 < len(spans) else END))
        return out

    def state(self) -> str:
        return json.dumps({"tables": {str(n): t.state() for n, t in self.tables.items()}, "spans": self.spans, "done": self.done})

    @staticmethod
    def restored(text: str) -> Catalog:
        s = json.loads(text)
        return Catalog({int(n): TableHistory.restored(t) for n, t in s["tables"].items()}, {n: [(a, b) for a, b in v] for n, v in s["spans"].items()}, [(a, c) for a, c in s["done"]])
