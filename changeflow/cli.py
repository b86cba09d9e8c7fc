"""Commands: ``replicator`` fills a group's change log, ``worker SINK`` delivers it, ``version``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from changeflow import __version__, config, model
from changeflow.session import session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="changeflow")
    commands = top.add_subparsers(dest="command", required=True)
    commands.add_parser("version")
    replicator, worker = commands.add_parser("replicator"), commands.add_parser("worker")
    worker.add_argument("sink", choices=["stdout", "file", "table", "postgres", "webhook"])
    for p in (replicator, worker):
        p.add_argument("--config")
        for name, default in vars(config.Settings()).items():
            flag = "--" + name.replace("_", "-")
            if isinstance(default, bool):
                p.add_argument(flag, action="store_const", const=True)
            else:
                p.add_argument(flag)
    return top


def _keys(s: config.Settings) -> dict[str, model.ReplicationKey]:
    """Keys by table from a file: ``table: {type: ..., columns: [...]}``."""
    found = config._yaml(s.keys_config) if s.keys_config else {}
    return {t: model.ReplicationKey(k.get("type", model.PRIMARY_KEY), tuple(k.get("columns") or ())) for t, k in found.items()}


def replicate(s: config.Settings) -> None:
    """Copies tables of files or of a PostgreSQL source into the log, then follows the protocol frames and the schema-change log."""
    from pathlib import Path

    from pyspark.sql import functions as F

    from changeflow.sources import changelog, exported, jdbc, registry, snapshot

    if not s.host and not s.source_dir:
        raise ValueError("required: source-dir or host")
    spark, mode = session("changeflow-replicator"), registry.mode_of(s.copy, s.copy_and_stream)
    jdbc_url, options = jdbc.url(s.host, s.port, s.dbname), {"user": s.user, "password": s.password}
    if mode != "stream":
        tables = s.tables or sorted(p.stem for p in Path(s.source_dir or ".").glob("*.parquet"))
        keys = _keys(s)
        if s.host:  # one moment for all tables, and the stream goes on from it
            write = lambda t, wire: changelog.append(wire.withColumn("_group", F.lit(s.group)), s.log_dir)
            lsn = exported.copy(spark, session_options(s), s.schema, s.tables, write, s.max_copy_workers_per_table)
            s.starting_lsn = s.starting_lsn or lsn
        else:
            snapshots = snapshot.copy_tables(spark, {t.rpartition(".")[2]: f"{s.source_dir}/{t.rpartition('.')[2]}.parquet" for t in tables}, keys)
            failed = snapshot.write_snapshots(snapshots, lambda t, c: changelog.append(changelog.to_wire(c, s.group), s.log_dir), s.max_copy_workers_per_table)
            if failed:
                raise RuntimeError(f"tables failed: {failed}")
    if mode == "copy":
        return
    poller = _poller(spark, s, jdbc_url, options) if s.host and s.track_ddl else None
    if poller is not None:
        poller.poll()  # what the log holds is told before the stream begins
        poller.start()
    try:
        _follow(spark, s, poller)
    finally:
        if poller is not None:
            poller.stop()


def session_options(s: config.Settings) -> dict[str, str]:
    return {"host": s.host, "port": str(s.port), "dbname": s.dbname, "user": s.user, "password": s.password, "sslmode": s.sslmode}


def stream_options(s: config.Settings) -> dict[str, str]:
    """Options of the protocol source: a server's connection by way of a spool where a host is named, else a capture in files."""
    from changeflow.sources import jdbc

    if not s.host:
        return {"path": f"{s.source_dir}/frames", "startingLsn": s.starting_lsn}
    named = {"transport": "changeflow.sources.connection:Connection", "spool": s.spool_dir or f"{s.log_dir}_spool/{s.group}", "startingLsn": s.starting_lsn}
    return named | session_options(s) | {"slot": jdbc.slot_name(s.group), "publication": jdbc.publication_name(s.group)}


def _poller(spark, s: config.Settings, jdbc_url: str, options: dict[str, str]):
    from changeflow.sinks.jdbc import JdbcSink
    from changeflow.sources import changelog, jdbc
    from changeflow.streaming.ddl_poll import DdlPoller

    log, target = "changeflow_internal.ddl_log", JdbcSink(jdbc_url, {}, options)
    read = lambda: jdbc.read_table(spark, jdbc_url, log, options)
    publish = lambda c: changelog.append(changelog.to_wire(c, s.group), s.log_dir)
    return DdlPoller(read, publish, lambda ids: target.execute(spark, [f"DELETE FROM {log} WHERE id IN ({', '.join(map(str, ids))})"]), s.tables)


def _follow(spark, s: config.Settings, poller) -> None:
    """The stream into the log until it ends, or until the poller of schema changes fails for good."""
    from pyspark.sql import functions as F

    from changeflow.sources import changelog, pgoutput

    spark.dataSource.register(pgoutput.PgOutputDataSource)
    changes = spark.readStream.format("changeflow_pgoutput").options(**stream_options(s)).load()
    wire = changes.withColumn("_group", F.lit(s.group))
    writer = wire.writeStream.foreachBatch(lambda df, n: changelog.append(df, s.log_dir)).option("checkpointLocation", f"{s.checkpoint_dir or s.log_dir + '_checkpoint'}/replicator-{s.group}")
    query = (writer.trigger(availableNow=True) if s.once else writer.trigger(processingTime="500 milliseconds")).start()
    while not query.awaitTermination(5):
        if poller is not None:
            try:
                poller.check()
            except Exception:
                query.stop()
                raise


def work(s: config.Settings, sink_name: str) -> None:
    """Delivers the group's log to a sink, resuming where it stopped."""
    from pyspark.sql import types as T

    from changeflow import pgtypes, sinks
    from changeflow.plans.pipeline import Pipeline
    from changeflow.sources import changelog
    from changeflow.streaming.worker import Worker

    spark = session("changeflow-worker")
    pipeline = Pipeline(config.load_rules(s.rules_config) if s.rules_config else None, config.load_routes(s.routing_config) if s.routing_config else None)
    from pyspark.sql import functions as F

    seen = changelog.read(spark, s.log_dir, s.group).where(F.col("_op") != model.DDL).groupBy("_table").agg(F.max_by("columns", "_seq").alias("columns"), F.max_by("_key", "_seq").alias("key")).collect()  # a row a table
    tables = {r["_table"]: T.StructType([T.StructField(c["name"], pgtypes.spark_type(c["oid"]), True, {"pg_oid": c["oid"]}) for c in r["columns"]]) for r in seen}
    if s.tables:  # tables that are not in the log yet have no columns yet
        tables = {t: tables.get(t, T.StructType()) for t in (x.rpartition(".")[2] for x in s.tables)}
    keys = {r["_table"]: model.ReplicationKey(r["key"]["type"], tuple(r["key"]["columns"])) for r in seen} | _keys(s)
    routed = {pipeline.router.destination(t, s.schema): pipeline.key(t, k, s.schema) for t, k in keys.items()}
    made = {
        "stdout": lambda: sinks.create("stdout"),
        "file": lambda: sinks.create("file", path=s.file_output_dir),
        "table": lambda: sinks.create("table", path=s.table_output_dir, keys=routed),
        "postgres": lambda: sinks.create("postgres", url=f"jdbc:postgresql://{s.target_host}:{s.target_port}/{s.target_dbname}", keys=routed, options={"user": s.target_user, "password": s.target_password}, disable_foreign_keys=s.target_disable_foreign_keys, create=s.target_sync_schema),
        "webhook": lambda: sinks.create("webhook", url=s.webhook_url, progress=f"{s.checkpoint_dir or s.log_dir + '_checkpoint'}/posted-{s.group}"),
    }[sink_name]()
    Worker(s.log_dir, s.group, tables if s.tables else None, made, pipeline, s.schema, retention=s.log_retention or None, archive=s.log_archive_dir or None).start(spark, f"{s.checkpoint_dir or s.log_dir + '_checkpoint'}/worker-{s.group}-{sink_name}", once=s.once).awaitTermination()


def main(args: Sequence[str] | None = None) -> int:
    given = vars(parser().parse_args(args))
    command, path, sink = given.pop("command"), given.pop("config", None), given.pop("sink", None)
    if command == "version":
        print(f"changeflow {__version__}")
        return 0
    s = config.settings(given, path)
    s.require(config.REQUIRED[sink or command])
    if command == "replicator":
        replicate(s)
    else:
        work(s, sink)
    return 0
