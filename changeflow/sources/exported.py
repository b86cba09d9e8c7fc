"""Copies of a server's tables as of one point in time, by many tasks, and the position at which the stream goes on.

One session exports a snapshot and tells the log position; it stays open while tasks copy. Each task has a
session of its own that takes over the snapshot and copies a range of pages, so all rows of all tables are
those of one moment, and a stream from the position on has every change after it. Rows come in the wire form
of the change log, with the snapshot's position.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from changeflow import model
from changeflow.sources import jdbc
from changeflow.sources.connection import Session
from changeflow.sources.snapshot import MOST_CONNECTIONS, PAGES_PER_RANGE, range_predicates

#: Rows of one Arrow batch.
BATCH = 4096


class Exported:
    """A snapshot that tasks can take over while this is open: ``name`` and the log position ``lsn``."""

    def __init__(self, options: Mapping[str, str]) -> None:
        self.session = Session(options)

    def __enter__(self) -> Exported:
        self.session.query("BEGIN ISOLATION LEVEL REPEATABLE READ READ ONLY")
        self.name, self.lsn = self.session.query("SELECT pg_export_snapshot(), pg_current_wal_lsn()")[0]
        return self

    def __exit__(self, *_) -> None:
        try:
            self.session.query("COMMIT")
        finally:
            self.session.close()


@dataclass(frozen=True)
class Table:
    """What a copy needs of a table."""

    schema: str
    name: str
    columns: tuple[tuple[str, int], ...]
    key: model.ReplicationKey | None
    pages: int


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _named(*parts: str) -> str:
    return ".".join('"' + p.replace('"', '""') + '"' for p in parts)


def table_of(session: Session, schema: str, name: str) -> Table:
    """Columns, key and pages of a table, as the session sees them."""
    whole = _quoted(_named(schema, name))
    columns = session.query(f"SELECT attname, atttypid FROM pg_attribute WHERE attrelid = {whole}::regclass AND attnum > 0 AND NOT attisdropped ORDER BY attnum")
    told = session.query(jdbc.key_query(schema, name))
    number = lambda v: None if v is None else int(v)
    rows = [{"index_id": number(i), "is_primary": p == "t", "is_unique": u == "t", "column_name": c, "place": number(k), "identity": d} for i, p, u, c, k, d in told]
    pages = session.query(jdbc.pages_query(schema, name))
    return Table(schema, name, tuple((c, int(oid)) for c, oid in columns), jdbc.key_from_rows(rows), int(pages[0][0]) if pages else 0)


class SnapshotDataSource(DataSource):
    """``changeflow_snapshot``: options of a session, ``snapshot``, ``table`` and ``schema``, ``columns``, ``pages`` and ``pagesPerRange``."""

    @classmethod
    def name(cls) -> str:
        return "changeflow_snapshot"

    def schema(self) -> str:
        return "new array<string>"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[InputPartition]:
        ranges = range_predicates(int(self.options["pages"]), int(self.options.get("pagesperrange", PAGES_PER_RANGE)))
        return [InputPartition(r) for r in ranges or ["true"]]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        o, session = self.options, Session(self.options)
        try:
            session.query("BEGIN ISOLATION LEVEL REPEATABLE READ READ ONLY")
            session.query(f"SET TRANSACTION SNAPSHOT {_quoted(o['snapshot'])}")
            held: list[list[str | None]] = []
            for row in session.copy(f"COPY (SELECT {o['columns']} FROM {_named(o['schema'], o['table'])} WHERE {partition.value}) TO STDOUT"):
                held.append(row)
                if len(held) == BATCH:
                    yield pa.RecordBatch.from_pydict({"new": pa.array(held, pa.list_(pa.string()))})
                    held = []
            if held:
                yield pa.RecordBatch.from_pydict({"new": pa.array(held, pa.list_(pa.string()))})
        finally:
            session.close()


def wire_rows(spark: SparkSession, options: Mapping[str, str], table: Table, snapshot: Exported, workers: int = 4, per_range: int = PAGES_PER_RANGE) -> DataFrame:
    """All rows of a table in the snapshot, in the wire form without a group, over at most ``workers`` connections at once."""
    spark.dataSource.register(SnapshotDataSource)
    columns = ", ".join(_named(c) for c, _ in table.columns)
    given = dict(options) | {"snapshot": snapshot.name, "schema": table.schema, "table": table.name, "columns": columns, "pages": str(table.pages), "pagesPerRange": str(per_range)}
    rows = spark.read.format("changeflow_snapshot").options(**given).load().coalesce(max(1, min(workers, MOST_CONNECTIONS)))
    told = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(oid).alias("oid")) for c, oid in table.columns])
    none = F.lit(None).cast("array<string>")
    return rows.select(
        F.lit(model.BEFORE).cast("long").alias("_seq"), F.lit(snapshot.lsn).alias("_lsn"), F.lit(snapshot.lsn).alias("_commit_lsn"), F.lit(model.INSERT).alias("_op"), F.lit(table.schema).alias("_schema"),
        (table.key or model.ReplicationKey()).column().alias("_key"), F.current_timestamp().alias("_emitted_at"), F.array().cast("array<string>").alias("_toasted"),
        told.alias("columns"), F.col("new"), none.alias("old"), F.lit(table.name).alias("_table"),
    )


def copy(spark: SparkSession, options: Mapping[str, str], schema: str, tables: Sequence[str], write: Callable[[str, DataFrame], None], workers: int = 4, per_range: int = PAGES_PER_RANGE) -> str:
    """Copies tables (all of the schema, if none is named) as of one moment; the log position that a stream goes on from."""
    with Exported(options) as snapshot:
        names = [t.rpartition(".")[2] for t in tables] or [r[0] for r in snapshot.session.query(jdbc.tables_query(schema))]
        for name in names:
            write(name, wire_rows(spark, options, table_of(snapshot.session, schema, name), snapshot, workers, per_range))
        return snapshot.lsn
