"""Tables behind JDBC: parallel reading, and the metadata queries for keys and pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from changeflow import model
from changeflow.sources.snapshot import MOST_CONNECTIONS


def url(host: str, port: int, dbname: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{dbname}"


def read_table(spark: SparkSession, jdbc_url: str, table: str, options: Mapping[str, str] | None = None, predicates: Sequence[str] | None = None, partition: tuple[str, int, int, int] | None = None) -> DataFrame:
    """The table by conditions, one task each, or by ranges (column, low, high, parts) of a column, over at most MOST_CONNECTIONS."""
    reader = spark.read
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if predicates:
        return spark.read.jdbc(jdbc_url, table, predicates=list(predicates), properties=dict(options or {}))
    if partition:
        column, low, high, parts = partition
        reader = reader.option("partitionColumn", column).option("lowerBound", low).option("upperBound", high).option("numPartitions", min(parts, MOST_CONNECTIONS))
    return reader.format("jdbc").option("url", jdbc_url).option("dbtable", table).load()


def key_query(schema: str, table: str) -> str:
    """Index columns in key order with is_primary, is_unique and the table's identity, for ``key_from_rows``."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    return (
        "SELECT ix.indexrelid::bigint AS index_id, ix.indisprimary AS is_primary, ix.indisunique AS is_unique, a.attname AS column_name, k.place AS place, c.relreplident AS identity "
        "FROM pg_class c JOIN pg_namespace n ON n.oid = c.relnamespace LEFT JOIN pg_index ix ON ix.indrelid = c.oid AND ix.indpred IS NULL "
        "LEFT JOIN LATERAL unnest(ix.indkey) WITH ORDINALITY k(attnum, place) ON true LEFT JOIN pg_attribute a ON a.attrelid = c.oid AND a.attnum = k.attnum "
        f"WHERE n.nspname = {q(schema)} AND c.relname = {q(table)}"
    )


def key_from_rows(rows: Sequence[Mapping[str, object]]) -> model.ReplicationKey | None:
    """The key of a table from the rows of its ``key_query``: a handful for each table."""
    by: dict[object, list] = {}
    for r in rows:
        if r["index_id"] is not None:
            by.setdefault((not r["is_primary"], r["index_id"]), []).append(r)
    named = {k: [r["column_name"] for r in sorted(v, key=lambda r: r["place"])] for k, v in sorted(by.items()) if v[0]["is_primary"] or v[0]["is_unique"]}
    primary = next((c for (other, _), c in named.items() if not other), None)
    return model.choose_key(primary, [c for (other, _), c in named.items() if other], any(r["identity"] == "f" for r in rows))


def pages_query(schema: str, table: str) -> str:
    """The number of pages, for ``snapshot.range_predicates``."""
    return f"SELECT relpages FROM pg_class WHERE oid = '\"{schema}\".\"{table}\"'::regclass"


def publication_name(group: str) -> str:
    return f"changeflow_{group.replace('-', '_')}_publication"


def slot_name(group: str) -> str:
    return f"changeflow_{group.replace('-', '_')}_slot"


def admin_statements(group: str, tables: Sequence[str]) -> list[str]:
    """What an administrator runs once on the source for a group."""
    publication = publication_name(group)
    targets = "FOR TABLE " + ", ".join(tables) if tables else "FOR ALL TABLES"
    return [f"CREATE PUBLICATION {publication} {targets}", f"SELECT pg_create_logical_replication_slot('{slot_name(group)}', 'pgoutput')"]


def ddl_capture_statements(schema: str = "changeflow_internal") -> list[str]:
    """The schema-change log on the source: a table, a function and an event trigger for tables, their columns and indexes.

    ``position`` is where in the write-ahead log the command ran, which orders it among streamed changes.
    """
    return [
        f"CREATE SCHEMA IF NOT EXISTS {schema}",
        f"CREATE TABLE IF NOT EXISTS {schema}.ddl_log (id bigserial PRIMARY KEY, event_type text NOT NULL, object_type text, object_identity text, ddl_command text NOT NULL, created_at timestamptz NOT NULL DEFAULT clock_timestamp(), position bigint NOT NULL DEFAULT (pg_current_wal_lsn() - '0/0'::pg_lsn)::bigint)",
        f"CREATE OR REPLACE FUNCTION {schema}.log_ddl() RETURNS event_trigger LANGUAGE plpgsql AS $body$ BEGIN "
        f"INSERT INTO {schema}.ddl_log (event_type, object_type, object_identity, ddl_command) SELECT tg_tag, d.object_type, d.object_identity, current_query() "
        "FROM pg_event_trigger_ddl_commands() d WHERE d.object_type IN ('table', 'table column', 'index'); END $body$",
        f"CREATE EVENT TRIGGER {schema}_ddl ON ddl_command_end EXECUTE FUNCTION {schema}.log_ddl()",
    ]


def run_query(spark: SparkSession, jdbc_url: str, sql: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """The rows of a query that the source runs."""
    reader = spark.read.format("jdbc").option("url", jdbc_url).option("query", sql)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def tables_query(schema: str) -> str:
    return "SELECT table_name FROM information_schema.tables WHERE table_type = 'BASE TABLE' AND table_schema = '" + schema.replace("'", "''") + "'"


def snapshots(spark: SparkSession, jdbc_url: str, schema: str, tables: Sequence[str], options: Mapping[str, str] | None = None, workers: int = 4) -> dict[str, DataFrame]:
    """Snapshots of tables on a PostgreSQL source, each read by page ranges over at most ``workers`` tasks' worth of connections.

    Tables without pages, which were never analysed, are read in one range. Tasks have transactions of
    their own: the copy is not one point in time, and converges by the stream that follows it.
    """
    from changeflow.sources.snapshot import range_predicates, snapshot

    names = [t.rpartition(".")[2] for t in tables] or [r[0] for r in run_query(spark, jdbc_url, tables_query(schema), options).collect()]
    out = {}
    for t in names:
        key = key_from_rows([r.asDict() for r in run_query(spark, jdbc_url, key_query(schema, t), options).collect()])
        pages = run_query(spark, jdbc_url, pages_query(schema, t), options).first()[0]
        rows = read_table(spark, jdbc_url, f'"{schema}"."{t}"', options, predicates=range_predicates(pages) or None)
        out[t] = snapshot(rows.coalesce(max(1, min(workers, MOST_CONNECTIONS))), t, key, schema)
    return out
