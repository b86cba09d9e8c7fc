"""A sink that keeps tables behind JDBC up to date.

A batch is staged in one parallel write; what is applied is set-based and idempotent: the batch's last
state of each key it touches replaces the key's row. The key's state is replayed from the target's rows
of those keys, so that it is the one that statements in order would leave.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import model
from changeflow.operators.ddl import SchemaChange, parse
from changeflow.operators.replay import changes_key, replay, replay_rows, target_key
from changeflow.session import checkpointed
from changeflow.streaming.retry import with_retry

#: SQL states of lost connections, which are tried again (fixed values).
TRANSIENT = ("08006", "08003", "57P01", "57P02", "57P03")


#: SQL states of schemas, tables, columns and other objects that are not there (fixed values: PostgreSQL's, and Derby's of tests).
MISSING = ("3F000", "42P01", "42703", "42704", "42Y55", "42X05", "42X14", "42Y07", "42X65")
CONCURRENTLY = re.compile(r"\bCONCURRENTLY\b", re.I)


def _states(error: Exception) -> set[str]:
    """The SQL states of an error and of what caused it; without any, those that its text names."""
    found, e = set(), getattr(error, "java_exception", None)
    while e is not None:
        if hasattr(e, "getSQLState") and "SQL" in e.getClass().getName():
            found.add(e.getSQLState())
        e = e.getCause()
    return found or set(re.findall(r"\b[0-9A-Z]{5}\b", str(error)))


def transient(error: Exception) -> bool:
    return bool(_states(error) & set(TRANSIENT))


def missing(error: Exception) -> bool:
    """Whether a statement failed because what it is about is not there."""
    return bool(_states(error) & set(MISSING))


def quoted(name: str) -> str:
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


class JdbcSink:
    """``disable_foreign_keys`` sets the session's replica role, as PostgreSQL has it; ``create`` makes tables that are not there."""

    def __init__(self, url: str, keys: Mapping[str, model.ReplicationKey], options: Mapping[str, str] | None = None, disable_foreign_keys: bool = False, create: bool = True, tries: int = 5) -> None:
        self.url, self.keys, self.options, self.create, self.tries = url, dict(keys), dict(options or {}), create, tries
        if disable_foreign_keys:
            self.options["sessionInitStatement"] = "SET session_replication_role = 'replica'"

    def _connection(self, spark: SparkSession):
        jvm = spark.sparkContext._jvm
        if driver := self.options.get("driver"):
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
        p = jvm.java.util.Properties()
        for k, v in self.options.items():
            p.setProperty(k, v)
        return jvm.java.sql.DriverManager.getConnection(self.url, p)

    def execute(self, spark: SparkSession, statements: list[str], transaction: bool = True) -> None:
        """The statements on the driver, as one transaction, or each by itself, as CONCURRENTLY asks for."""

        def run() -> None:
            c = self._connection(spark)
            try:
                c.setAutoCommit(not transaction)
                s = c.createStatement()
                if init := self.options.get("sessionInitStatement"):
                    s.execute(init)
                for sql in statements:
                    s.execute(sql)
                if transaction:
                    c.commit()
            except Exception:
                if transaction:
                    c.rollback()
                raise
            finally:
                c.close()

        with_retry(run, self.tries, 1.0, 30.0, transient)

    def exists(self, spark: SparkSession, table: str) -> bool:
        """Whether the target has the table, as its catalogue says; failures are told, lost connections tried again."""
        schema, _, name = table.rpartition(".")

        def run() -> bool:
            c = self._connection(spark)
            try:
                found = c.getMetaData().getTables(None, schema or None, name, None)  # a pattern, in which _ is any character
                while found.next():
                    if found.getString("TABLE_NAME") == name:
                        return True
                return False
            finally:
                c.close()

        return with_retry(run, self.tries, 1.0, 30.0, transient)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.jdbc(self.url, quoted(table), properties=self.options)

    def alter(self, table: str, changes: Sequence[SchemaChange], commands: Sequence[str] = ()) -> None:
        """Runs the commands on the target, without those whose changes are all there already, as after a batch that comes again.

        A command about what the target does not have is passed over, as it concerns nothing there; one with
        CONCURRENTLY runs outside a transaction.
        """
        spark = SparkSession.getActiveSession()
        for command in commands:
            if self._is_done(spark, table, parse(command)):
                continue
            try:
                self.execute(spark, [command], transaction=not CONCURRENTLY.search(command))
            except Exception as e:
                if not missing(e):
                    raise
        for c in changes:
            if c.action == "rename" and table in self.keys:
                self.keys[table] = self.keys[table].renamed({c.column: c.to})
            elif c.action == "rename_table" and table in self.keys:
                self.keys[c.to] = self.keys.pop(table)

    def _is_done(self, spark: SparkSession, table: str, changes: Sequence[SchemaChange]) -> bool:
        if any(c.action == "rename_table" for c in changes):
            return all(c.action == "rename_table" and not self.exists(spark, table) and self.exists(spark, c.to) for c in changes)
        if not self.exists(spark, table):
            return False
        have = {c.lower() for c in self.read(spark, table).columns}
        there = {"add": lambda c: c.column.lower() in have, "drop": lambda c: c.column.lower() not in have, "rename": lambda c: c.column.lower() not in have and c.to.lower() in have}
        return all(c.action in there and there[c.action](c) for c in changes)

    def write(self, changes: DataFrame, table: str, batch: int = 0) -> None:
        spark, key = changes.sparkSession, self.keys.get(table)
        if key is None or not key.is_valid():
            raise ValueError(f"{table} has no replication key")
        changes = checkpointed(changes)
        row = model.row_type(changes)
        if not self.exists(spark, table):
            if not self.create:
                raise ValueError(f"{table} is not on the target")
            self._create(spark, table, row, key)
        base = self.read(spark, table)
        changes = model.widened(changes, base.schema)
        row = model.row_type(changes)
        # Names of their own, so that workers of one target do not meet.
        staged, touched_in = (f"{table}_{what}_{uuid.uuid4().hex[:12]}" for what in ("staged", "touched"))
        try:
            if key.type == model.FULL:
                rows = checkpointed(replay_rows(changes, base))
                self._stage(rows, staged)
                self.execute(spark, [f"DELETE FROM {quoted(table)}", self._insert(row.names, table, staged)])
                return
            keys = list(key.columns)
            k = target_key(keys)
            touched = changes.where(F.col("_op").isin(*model.DATA_OPERATIONS)).select(k.alias("k"))
            touched = touched.unionByName(changes.where(changes_key(keys)).select(F.struct(*[model.field("new", c).alias(c) for c in keys]).alias("k"))).distinct().select("k.*")
            touched = checkpointed(touched)
            match = [F.col(f"b.`{c}`").eqNullSafe(F.col(f"t.`{c}`")) for c in keys]
            known = base.alias("b").join(touched.alias("t"), match, "left_semi")
            rows = checkpointed(replay(changes, keys, known))
            self._stage(rows, staged)
            self._stage(touched, touched_in)
            equal = "(t.{0} = {1}.{0} OR t.{0} IS NULL AND {1}.{0} IS NULL)"  # keys of unique indexes can be null
            same = " AND ".join(equal.format(quoted(c), quoted(table)) for c in keys)
            self.execute(spark, [f"DELETE FROM {quoted(table)} WHERE EXISTS (SELECT 1 FROM {quoted(touched_in)} t WHERE {same})", self._insert(row.names, table, staged)])
        finally:
            for name in (staged, touched_in):
                if self.exists(spark, name):
                    self.execute(spark, [f"DROP TABLE {quoted(name)}"])

    def _create(self, spark: SparkSession, table: str, row: T.StructType, key: model.ReplicationKey) -> None:
        """The table with its key: a primary key, or a unique index."""
        primary = key.type == model.PRIMARY_KEY
        made = T.StructType([T.StructField(f.name, f.dataType, not (primary and f.name in key.columns), f.metadata) for f in row])
        spark.createDataFrame([], made).write.jdbc(self.url, quoted(table), mode="append", properties=self.options)
        columns = ", ".join(map(quoted, key.columns))
        if primary:
            self.execute(spark, [f"ALTER TABLE {quoted(table)} ADD PRIMARY KEY ({columns})"])
        elif key.type == model.UNIQUE:
            name = table.rpartition(".")[2]
            self.execute(spark, [f"CREATE UNIQUE INDEX {quoted(name + '_key')} ON {quoted(table)} ({columns})"])

    def _stage(self, rows: DataFrame, staged: str) -> None:
        rows.write.mode("overwrite").jdbc(self.url, quoted(staged), properties=self.options)

    def _insert(self, names: list[str], table: str, staged: str) -> str:
        columns = ", ".join(map(quoted, names))
        return f"INSERT INTO {quoted(table)} ({columns}) SELECT {columns} FROM {quoted(staged)}"
