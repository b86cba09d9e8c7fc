"""The worker: a streaming query for each group.

A micro-batch holds whole commits (files of the log), keeps their order in ``_seq``, and goes to the sink
table by table with its number, so that a batch that comes again after a failure replaces itself. The
checkpoint folder is the group's state: positions and finished batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow import model
from changeflow.files import Folder, Numbered
from changeflow.operators import ddl
from changeflow.operators.history import Catalog, TableHistory
from changeflow.operators.routing import fan_in
from changeflow.plans.pipeline import Pipeline
from changeflow.sinks.base import Sink
from changeflow.sources import changelog

#: Milliseconds between flushes, and files of the log in one batch (defaults of the options).
FLUSH_MS, FILES = 500, 100
#: The row of a schema change.
DDL_ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("event_type", "object_type", "object_identity", "ddl_command")] + [T.StructField("created_at", T.TimestampType())])


class Worker:
    """Runs a pipeline over a group's log.

    ``tables`` has the row types of the tables to deliver; None delivers all, those that appear later too.
    Rows carry their own columns, and schema changes of the log tell what names mean from which position on
    (``operators.history``), so that neither columns that come later nor rows from before a change are lost,
    and tables are followed when they are renamed: rules and routes that a table had stay with it. What is
    known of the tables is kept in the checkpoint folder, batch by batch.
    """

    def __init__(self, log: str, group: str, tables: Mapping[str, T.StructType] | None, sink: Sink, pipeline: Pipeline | None = None, schema: str = "public", files: int = FILES, dead_letters: str | None = None, retention: str | None = None, archive: str | None = None) -> None:
        self.retention, self.archive = retention, archive
        self.log, self.group, self.sink = log, group, sink
        self.only = None if tables is None else set(tables)
        self.given, self.catalog = dict(tables or {}), Catalog()
        self.pipeline, self.schema, self.files, self.dead_letters = pipeline or Pipeline(), schema, files, dead_letters
        self.state: str | None = None
        self.done: int | None = None
        self._begin()

    def _begin(self) -> None:
        self.catalog = Catalog()
        for name, row in self.given.items():
            self.catalog.add(name, row)

    def _recall(self, spark: SparkSession, number: int) -> None:
        """The tables as they were before a batch: a batch that comes again starts from there too."""
        if self.state is None or self.done == number - 1:
            return
        found = Numbered(Folder(spark, self.state), "tables").latest(number)
        if found is None:
            self._begin()
        else:
            self.catalog = Catalog.restored(found[1])
            for name, row in self.given.items():
                if name not in self.catalog.spans:
                    self.catalog.add(name, row)

    def _commands(self, rows: DataFrame) -> list[tuple[int, str, str]]:
        """(position, table, command) of the schema changes of a batch in their order."""
        own = rows.where((F.col("_op") == model.DDL) & (F.col("_schema") == self.schema))
        found = own.orderBy("_seq").select("_seq", "_table", changelog._value("new", "ddl_command").alias("c")).collect()
        return [(r["_seq"], r["_table"], r["c"]) for r in found if r["c"] and self._wanted(r["_table"], r["c"])]

    def _wanted(self, table: str, command: str = "") -> bool:
        named = {table} | {c.table.rpartition(".")[2] for c in ddl.parse(command) if c.action == "rename_table"} if command else {table}
        followed = {n for n, spans in self.catalog.spans.items() if any(number is not None for _, number in spans)}
        return self.only is None or bool(named & (self.only | followed))

    def process(self, batch: DataFrame, number: int) -> None:
        """One micro-batch: it goes target by target, schema changes first."""
        spark = batch.sparkSession
        self._recall(spark, number)
        self.done = None
        # A row for each list of columns of a table; what rows say is read once more, by the sink.
        own = batch.where(F.col("_schema") == self.schema)
        seen = own.groupBy((F.col("_op") == model.DDL).alias("is_ddl"), "_table", "columns").agg(F.min("_seq").alias("from"), F.max("_seq").alias("at"), F.max_by("_key", "_seq").alias("key")).collect()
        commands = self._commands(batch) if any(r["is_ddl"] for r in seen) else []
        seen = [r for r in seen if not r["is_ddl"]]
        events: list[tuple[int, int, object]] = [(at, 1, (table, command)) for at, table, command in commands]
        events += [(r["from"], 0, r) for r in seen]
        told: dict[int, list[tuple[str, list[ddl.SchemaChange], str, str]]] = {}
        for at, is_command, e in sorted(events, key=lambda e: e[:2]):
            if is_command:
                self._told(told, *e, at)
            elif self._wanted(e["_table"]):
                self.catalog.table(e["_table"], at).meet([(c["name"], c["oid"]) for c in e["columns"]])
        met: dict[int, list] = {}
        for r in seen:
            if self._wanted(r["_table"]):
                for table in {id(t): t for t in (self.catalog.table(r["_table"], r["from"]), self.catalog.table(r["_table"], r["at"]))}.values():
                    met.setdefault(self._number(table), []).append(r)
        by_target: dict[str, list[int]] = {}
        for n in sorted(told.keys() | met.keys()):
            by_target.setdefault(self._target(self.catalog.tables[n]), []).append(n)
        for target in sorted(by_target):
            self._deliver(batch, target, by_target[target], number, told, met)
        if self.state is not None:
            kept = Numbered(Folder(spark, self.state), "tables")
            kept.put(number, self.catalog.state())
            kept.keep(10)
        self.done = number

    def _number(self, table: TableHistory) -> int:
        return next(n for n, t in self.catalog.tables.items() if t is table)

    def _told(self, told: dict, name: str, command: str, at: int) -> None:
        """Applies a command to the catalogue, and notes what the sink is to be told: (target, changes, command, target after)."""
        before = {n: self._target(t) for n, t in self.catalog.tables.items()}
        done = self.catalog.apply(name, command, at)
        if done is not None:
            table, changes = done
            n = self._number(table)
            told.setdefault(n, []).append((before.get(n, self._target(table)), changes, command, self._target(table)))

    def _config(self, table: TableHistory) -> str:
        """The name under which a table has rules or a route: its own, else the latest one before; its own if none has."""
        names = [table.name, *reversed(table.earlier)]
        return next((n for n in names if self.pipeline.rules.of(n, self.schema) or self.pipeline.router.of(n, self.schema)), table.name)

    def _target(self, table: TableHistory) -> str:
        """Where a table goes: a route's destination, else its own name."""
        config = self._config(table)
        return self.pipeline.router.destination(config, self.schema) if self.pipeline.router.of(config, self.schema) else table.name

    def _deliver(self, batch: DataFrame, target: str, tables: Sequence[int], number: int, told: Mapping, met: Mapping) -> None:
        """The changes of all tables that go to one target."""
        try:
            parts = [p for n in tables for p in self._part(batch, target, n, number, told.get(n, []), met.get(n, []))]
            if parts:
                self.sink.write(fan_in(parts), target, number)
        except Exception:
            if self.dead_letters is None:
                raise
            for n in tables:
                names = [name for name, _, _ in self.catalog.names_of(self.catalog.tables[n])]
                rows = batch.where(F.col("_table").isin(*names))
                rows.write.mode("overwrite").parquet(f"{self.dead_letters}/{self.catalog.tables[n].name}/batch={number}")

    def _part(self, batch: DataFrame, target: str, n: int, number: int, told: Sequence, met: Sequence) -> list[DataFrame]:
        """Tells the sink a table's schema changes; the table's changes, if there is something to write."""
        table, versioned = self.catalog.tables[n], hasattr(self.sink, "versions")
        config = self._config(table)
        if met and isinstance(getattr(self.sink, "keys", None), dict):
            last = max(met, key=lambda r: r["at"])["key"]
            key = model.ReplicationKey(last["type"], tuple(last["columns"]))
            self.sink.keys.setdefault(target, self.pipeline.key(config, key, self.schema))
        if told and hasattr(self.sink, "alter"):
            for at, changes, command, after in told:
                moved = [c for c in changes if c.action == "rename_table"]
                if moved and at == after:  # the target keeps its name
                    changes = [c for c in changes if c.action != "rename_table"]
                if changes:
                    self.sink.alter(at, changes, [command])
        if told and getattr(self.sink, "lines", False):
            rows = changelog.from_wire(batch.where(F.col("_op") == model.DDL), table.name, DDL_ROW, self.schema, names=self.catalog.names_of(table))
            self.sink.write(rows, f"{target}_ddl", number)
        row = table.row
        if told and not met and versioned:  # only what the sink holds is to change
            held = self.sink.read(batch.sparkSession, told[0][0])
            if held is None:
                return []
            row = ddl.evolve(held, [c for _, changes, _, _ in told for c in changes]).schema
        if not len(row) or not (met or told and versioned):
            return []
        readings = table.readings([[c["name"] for c in r["columns"]] for r in met])
        rows = changelog.from_wire(batch.where(F.col("_op") != model.DDL), table.name, row, self.schema, readings, self.catalog.names_of(table))
        return [self.pipeline.run(rows, config, self.schema)]

    def start(self, spark: SparkSession, checkpoint: str, once: bool = False, flush_ms: int = FLUSH_MS) -> StreamingQuery:
        """Starts or resumes the group. ``once`` works off what there is and stops."""
        self.state = f"{checkpoint}/tables_known"
        stream = changelog.read_stream(spark, self.log, self.group, self.files, self.retention, self.archive)
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).queryName(f"changeflow_{self.group.replace('-', '_')}")
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{flush_ms} milliseconds")).start()


def progress(query: StreamingQuery) -> dict[str, object]:
    """The number of the last batch and its rows."""
    last = query.lastProgress
    return {"batch": last["batchId"], "rows": last["numInputRows"]} if last else {"batch": None, "rows": 0}


def latest_by_key(events: DataFrame, keys: list[str], sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hands each batch's last event of every key, by ``_seq``, to ``sink``."""
    others = [c for c in events.columns if c not in keys]

    def run(batch: DataFrame, number: int) -> None:
        last = batch.groupBy(*keys).agg(F.max_by(F.struct(*others), "_seq").alias("e"))
        sink(last.select(*keys, "e.*"), number)

    return events.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
