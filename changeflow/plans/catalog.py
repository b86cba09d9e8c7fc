"""The queries over the driver's tables: one or more for each operator, each with its SQL where SQL has it.

Tables are read as snapshots, or as ``orders_cdc``: a change stream made from ``orders`` (every order is
inserted at 4k; k % 3 = 0 updated at 4k + 1 with twice the price and status U, its priority left out as
unchanged for even k; k % 5 = 0 deleted at 4k + 2; k % 10 = 0 inserted again at 4k + 3).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import model, pgtypes
from changeflow.functions import codecs
from changeflow.operators import ddl
from changeflow.operators.replay import effective, replay, replay_rows
from changeflow.operators.routing import Route, Router, fan_in
from changeflow.operators.rules import FilterRule, MaskRule, RegexRule, RuleEngine
from changeflow.plans.pipeline import Pipeline
from changeflow.session import ensure_checkpoint_dir, stored
from changeflow.sinks.base import message
from changeflow.sinks.files import JsonLinesSink
from changeflow.sinks.table import TableSink
from changeflow.sources import changelog, registry
from changeflow.sources.capture import to_frames, write_capture
from changeflow.sources.pgoutput import PgOutputDataSource
from changeflow.sources.snapshot import page_ranges, snapshot
from changeflow.streaming.stateful import replay_stream
from changeflow.streaming.worker import Worker

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return put


def scan(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def rows_of(changes: DataFrame) -> DataFrame:
    return changes.select("new.*")


ORDERS_KEY = model.ReplicationKey(model.PRIMARY_KEY, ("o_orderkey",))


def orders_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = scan(spark, sf_dir, "orders")
    k, row = F.col("o_orderkey"), orders.schema
    whole = F.struct(*orders.columns)
    left_out = k % 2 == 0
    updated = whole.withField("o_totalprice", F.col("o_totalprice") * 2).withField("o_orderstatus", F.lit("U")).withField("o_orderpriority", F.when(~left_out, F.col("o_orderpriority")))
    made = lambda rows, op, step, **more: model.envelope(rows, "orders", op=op, seq=k * 4 + step, key=ORDERS_KEY, emitted_at=F.lit(None).cast("timestamp"), row=row, **more)
    parts = [
        made(orders, model.INSERT, 0, new=whole),
        made(orders.where(k % 3 == 0), model.UPDATE, 1, new=updated, toasted=F.when(left_out, F.array(F.lit("o_orderpriority"))).otherwise(F.array())),
        made(orders.where(k % 5 == 0), model.DELETE, 2, old=whole),
        made(orders.where(k % 10 == 0), model.INSERT, 3, new=whole),
    ]
    return reduce(DataFrame.unionByName, parts)


_CDC = """
cdc AS (
  SELECT o_orderkey * 4 AS seq, 'INSERT' AS op, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, false AS kept FROM orders
  UNION ALL SELECT o_orderkey * 4 + 1, 'UPDATE', o_orderkey, o_custkey, 'U', o_totalprice * 2, o_orderdate, CASE WHEN o_orderkey % 2 <> 0 THEN o_orderpriority END, o_orderkey % 2 = 0 FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT o_orderkey * 4 + 2, 'DELETE', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, false FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL SELECT o_orderkey * 4 + 3, 'INSERT', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, false FROM orders WHERE o_orderkey % 10 = 0)
"""
_ALIVE = """
marked AS (SELECT *, coalesce(last_value(CASE WHEN op <> 'UPDATE' THEN op END IGNORE NULLS) OVER (PARTITION BY o_orderkey ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 'INSERT', false) AS alive FROM {cdc}),
done AS (SELECT * FROM marked WHERE CASE WHEN op = 'INSERT' THEN NOT alive ELSE alive END),
lives AS (SELECT *, sum(CASE WHEN op = 'INSERT' THEN 1 ELSE 0 END) OVER (PARTITION BY o_orderkey ORDER BY seq) AS life FROM done),
carried AS (SELECT *, last_value(CASE WHEN op <> 'DELETE' AND NOT kept THEN {{'v': o_orderpriority}} END IGNORE NULLS) OVER (PARTITION BY o_orderkey, life ORDER BY seq) AS p,
  row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) AS n FROM lives)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, p.v AS o_orderpriority FROM carried WHERE n = 1 AND op <> 'DELETE'
"""
_REPLAYED = f"WITH {_CDC}, " + _ALIVE.format(cdc="cdc")


# --- filters: every comparison over every kind of column


def _filter_query(table: str, column: str, operator: str, value: object, columns: tuple[str, ...], cast: str | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = scan(spark, sf_dir, table).select(*columns)
        if cast:
            rows = rows.withColumn(column, F.col(column).cast(cast))
        return rows_of(RuleEngine({table: [{"type": "filter", "column": column, "parameters": {"operator": operator, "value": value}}]}).apply(snapshot(rows, table), table))

    return run


_SIGNS = {"eq": "=", "ne": "<>", "gt": ">", "lt": "<", "gte": ">=", "lte": "<="}
_FILTERS: list[tuple[str, str, str, object, str, tuple[str, ...]]] = [
    ("int", "part", "p_size", 25, "25", ("p_partkey", "p_name", "p_size")),
    ("int_text_operand", "nation", "n_regionkey", "2", "2", ("n_nationkey", "n_name", "n_regionkey")),
    ("float", "orders", "o_totalprice", 150000.0, "150000.0", ("o_orderkey", "o_totalprice")),
    ("float_int_operand", "lineitem", "l_quantity", 25, "25.0", ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")),
    ("text", "customer", "c_mktsegment", "BUILDING", "'BUILDING'", ("c_custkey", "c_name", "c_mktsegment")),
    ("timestamp", "orders", "o_orderdate", "1995-06-17 00:00:00", "TIMESTAMP '1995-06-17 00:00:00'", ("o_orderkey", "o_orderdate")),
    ("timestamp_zone", "events", "ts", "2024-01-15T02:00:00+02:00", "TIMESTAMP '2024-01-15 00:00:00'", ("event_id", "ts", "event_type")),
]
for _kind, _table, _column, _value, _literal, _columns in _FILTERS:
    for _op, _sign in _SIGNS.items():
        query(f"filter_{_op}_{_kind}", f"SELECT {', '.join(_columns)} FROM {_table} WHERE {_column} {_sign} {_literal}")(_filter_query(_table, _column, _op, _value, _columns))
for _op, _sign in _SIGNS.items():
    query(f"filter_{_op}_numeric", f"SELECT c_custkey, CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal FROM customer WHERE CAST(c_acctbal AS DECIMAL(15,2)) {_sign} CAST('4500.00' AS DECIMAL(15,2))")(
        _filter_query("customer", "c_acctbal", _op, "4500.00", ("c_custkey", "c_acctbal"), "decimal(15,2)")
    )


def _bool_query(operator: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = scan(spark, sf_dir, "labels").select("doc_id", (F.col("toxic") == 1).alias("is_toxic"))
        return rows_of(FilterRule("is_toxic", operator, True).apply(snapshot(rows, "labels")))

    return run


for _op, _condition in {"eq": "toxic = 1", "ne": "toxic <> 1", "gte": "toxic = 1", "lte": "toxic = 1", "gt": "false", "lt": "false"}.items():
    query(f"filter_{_op}_bool", f"SELECT doc_id, toxic = 1 AS is_toxic FROM labels WHERE {_condition}")(_bool_query(_op))

query("filter_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'a')")(_filter_query("part", "p_name", "contains", "a", ("p_partkey", "p_name")))
query("filter_contains_case", "SELECT p_partkey, p_type FROM part WHERE contains(p_type, 'standard')")(_filter_query("part", "p_type", "contains", "standard", ("p_partkey", "p_type")))
query("filter_contains_empty", "SELECT p_partkey, p_name FROM part WHERE p_name IS NOT NULL")(_filter_query("part", "p_name", "contains", "", ("p_partkey", "p_name")))
query("filter_contains_unicode", "SELECT doc_id, lang FROM documents WHERE contains(text, 'ñ')")(lambda s, d: _filter_query("documents", "text", "contains", "ñ", ("doc_id", "lang", "text"))(s, d).select("doc_id", "lang"))
query("filter_wrong_operand_drops", "SELECT p_partkey, p_size FROM part WHERE false")(_filter_query("part", "p_size", "gt", 10.5, ("p_partkey", "p_size")))


@query("filter_unsupported_type_drops", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE false")
def _unsupported(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return rows_of(FilterRule("day", "gte", "1995-01-01").apply(snapshot(rows, "orders")))


@query("filter_typed_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1995-01-01'")
def _typed_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return rows_of(FilterRule("day", "gte", "1995-01-01", typed=True).apply(snapshot(rows, "orders")))


_NAN = "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 'NaN'::DOUBLE ELSE l_discount END AS d FROM lineitem"


def _nan_query(operator: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = scan(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 1, float("nan")).otherwise(F.col("l_discount")).alias("d"))
        return rows_of(FilterRule("d", operator, 0.05).apply(snapshot(rows, "lineitem"))).select("l_orderkey", "l_linenumber")

    return run


query("filter_gt_nan", f"SELECT l_orderkey, l_linenumber FROM ({_NAN}) WHERE NOT isnan(d) AND d > 0.05")(_nan_query("gt"))
query("filter_ne_nan", f"SELECT l_orderkey, l_linenumber FROM ({_NAN}) WHERE isnan(d) OR d <> 0.05")(_nan_query("ne"))


def _shown(changes: DataFrame) -> DataFrame:
    side = F.coalesce("new", "old")
    return changes.select("_seq", "_op", side["o_orderkey"].alias("o_orderkey"), side["o_totalprice"].alias("o_totalprice"))


query("filter_null_two_valued", f"WITH {_CDC} SELECT seq AS _seq, op AS _op, o_orderkey, o_totalprice FROM cdc WHERE op <> 'DELETE' AND coalesce(o_orderpriority <> '1-URGENT', false)")(
    lambda s, d: _shown(FilterRule("o_orderpriority", "ne", "1-URGENT").apply(orders_cdc(s, d).where("_op <> 'DELETE'")))
)
query("filter_deletes_read_old", f"WITH {_CDC} SELECT seq AS _seq, op AS _op, o_orderkey, o_totalprice FROM cdc WHERE o_totalprice > 200000.0")(lambda s, d: _shown(FilterRule("o_totalprice", "gt", 200000.0).apply(orders_cdc(s, d))))
query("filter_op_gate", f"WITH {_CDC} SELECT seq AS _seq, op AS _op, o_orderkey, o_totalprice FROM cdc WHERE op <> 'UPDATE' OR o_totalprice > 200000.0")(
    lambda s, d: _shown(FilterRule("o_totalprice", "gt", 200000.0, operations=("UPDATE",)).apply(orders_cdc(s, d)))
)
query("filter_delete_bypass", f"WITH {_CDC} SELECT seq AS _seq, op AS _op, o_orderkey, o_totalprice FROM cdc WHERE op = 'DELETE' OR o_totalprice > 200000.0")(
    lambda s, d: _shown(FilterRule("o_totalprice", "gt", 200000.0, allow_empty_deletes=True).apply(orders_cdc(s, d)))
)


@query("filter_chain", "SELECT p_partkey, p_brand, p_size FROM part WHERE p_size >= 10 AND p_size < 40 AND p_brand <> 'Brand#11'")
def _chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"type": "filter", "column": c, "parameters": {"operator": o, "value": v}} for c, o, v in (("p_size", "gte", 10), ("p_size", "lt", 40), ("p_brand", "ne", "Brand#11"))]
    return rows_of(RuleEngine({"part": rules}).apply(snapshot(scan(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size"), "part"), "part"))


# --- transforms


def _transform_query(table: str, columns: tuple[str, ...], rule: object) -> Query:
    return lambda spark, sf_dir: rows_of(rule.apply(snapshot(scan(spark, sf_dir, table).select(*columns), table)))


query("regex_replace_basic", "SELECT c_custkey, regexp_replace(c_name, '[0-9]+', '#', 'g') AS c_name FROM customer")(_transform_query("customer", ("c_custkey", "c_name"), RegexRule("c_name", "[0-9]+", "#")))
query("regex_groups", r"SELECT c_custkey, regexp_replace(c_name, '([A-Za-z]+)#0*([0-9]+)', '\2-\1', 'g') AS c_name FROM customer")(_transform_query("customer", ("c_custkey", "c_name"), RegexRule("c_name", "([A-Za-z]+)#0*([0-9]+)", "$2-$1")))
query("regex_named_group", r"SELECT c_custkey, regexp_replace(c_name, '([0-9]+)$', '<\1>', 'g') AS c_name FROM customer")(_transform_query("customer", ("c_custkey", "c_name"), RegexRule("c_name", "(?P<digits>[0-9]+)$", "<${digits}>")))
query("regex_no_match", "SELECT c_custkey, c_name FROM customer")(_transform_query("customer", ("c_custkey", "c_name"), RegexRule("c_name", r"@example\.com$", "@masked.com")))
query("regex_email", r"SELECT doc_id, regexp_replace(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+', '[email]', 'g') AS text FROM documents")(_transform_query("documents", ("doc_id", "text"), RegexRule("text", r"[A-Za-z0-9._]+@[A-Za-z0-9.]+", "[email]")))
for _name, _pattern in {"digits": "[0-9]*", "optional": "e?", "either": "(e|r)*", "lazy": "e??", "words": r"\b"}.items():
    query(f"regex_empty_{_name}", f"SELECT c_custkey, regexp_replace(c_name, '{_pattern}', '<x>', 'g') AS c_name FROM customer")(_transform_query("customer", ("c_custkey", "c_name"), RegexRule("c_name", _pattern, "<x>")))
query("regex_skips_non_text", "SELECT o_orderkey, o_totalprice FROM orders")(_transform_query("orders", ("o_orderkey", "o_totalprice"), RegexRule("o_totalprice", r"\d", "x")))
query("regex_deletes_untouched", f"WITH {_CDC} SELECT seq AS _seq, op AS _op, CASE WHEN op = 'DELETE' THEN o_orderstatus ELSE regexp_replace(o_orderstatus, 'O|U', 'x', 'g') END AS status FROM cdc")(
    lambda s, d: RegexRule("o_orderstatus", "O|U", "x").apply(orders_cdc(s, d)).select("_seq", "_op", F.coalesce("new", "old")["o_orderstatus"].alias("status"))
)
query("mask_name", "SELECT c_custkey, CASE WHEN length(c_name) <= 2 THEN c_name ELSE left(c_name, 1) || repeat('*', length(c_name) - 2) || right(c_name, 1) END AS c_name FROM customer")(
    _transform_query("customer", ("c_custkey", "c_name"), MaskRule("c_name", "*"))
)
query("mask_short", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")(lambda s, d: _transform_query("lineitem", ("l_returnflag", "l_linestatus"), MaskRule("l_returnflag", "*"))(s, d).distinct())
query("mask_multichar", "SELECT n_nationkey, CASE WHEN length(n_name) <= 2 THEN n_name ELSE left(n_name, 1) || repeat('xo', length(n_name) - 2) || right(n_name, 1) END AS n_name FROM nation")(
    _transform_query("nation", ("n_nationkey", "n_name"), MaskRule("n_name", "xo"))
)
query("mask_delete_old", f"WITH {_CDC} SELECT seq AS _seq, op AS _op, left(o_orderpriority, 1) || repeat('*', length(o_orderpriority) - 2) || right(o_orderpriority, 1) AS priority FROM cdc")(
    lambda s, d: MaskRule("o_orderpriority", "*").apply(orders_cdc(s, d)).select("_seq", "_op", F.coalesce("new", "old")["o_orderpriority"].alias("priority"))
)
query("mask_utf8_bytes")(lambda s, d: _transform_query("documents", ("doc_id", "text"), MaskRule("text", "*"))(s, d))


# --- routing


def _routed(spark: SparkSession, sf_dir: str, table: str, columns: tuple[str, ...], route: Route) -> DataFrame:
    router = Router()
    router.add(route)
    return router.apply(snapshot(scan(spark, sf_dir, table).select(*columns), table, model.ReplicationKey(model.PRIMARY_KEY, columns[:1])), table)


query("route_rename_table", "SELECT 'transactions' AS destination, o_orderkey, o_totalprice FROM orders")(
    lambda s, d: _routed(s, d, "orders", ("o_orderkey", "o_totalprice"), Route("orders", "transactions")).select(F.col("_table").alias("destination"), "new.*")
)
query("route_rename_columns", "SELECT c_custkey AS customer_id, c_name AS customer_name, c_acctbal FROM customer")(
    lambda s, d: rows_of(_routed(s, d, "customer", ("c_custkey", "c_name", "c_acctbal"), Route("customer", "customers", (("c_custkey", "customer_id"), ("c_name", "customer_name"), ("c_name", "ignored"), ("c_acctbal", "")))))
)
query("route_rename_key", "SELECT n_nationkey AS id, 'PRIMARY KEY' AS key_type, 'id' AS key_column FROM nation")(
    lambda s, d: _routed(s, d, "nation", ("n_nationkey", "n_name"), Route("nation", "countries", (("n_nationkey", "id"),))).select("new.id", F.col("_key.type").alias("key_type"), F.col("_key.columns")[0].alias("key_column"))
)


def _gated(operations: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        router = Router()
        router.add(Route("orders", "transactions", operations=operations))
        return _shown(router.apply(orders_cdc(spark, sf_dir), "orders"))

    return run


query("route_op_gate", f"WITH {_CDC} SELECT seq AS _seq, op AS _op, o_orderkey, o_totalprice FROM cdc WHERE op IN ('INSERT', 'UPDATE')")(_gated(("INSERT", "UPDATE")))
query("route_empty_operations_drop", f"WITH {_CDC} SELECT seq AS _seq, op AS _op, o_orderkey, o_totalprice FROM cdc WHERE false")(_gated(()))
query("route_passthrough", f"WITH {_CDC} SELECT seq AS _seq, op AS _op, o_orderkey, o_totalprice FROM cdc")(lambda s, d: _shown(Pipeline().run(orders_cdc(s, d), "orders")))


@query("route_fan_in", "SELECT 'parties' AS destination, c_custkey AS party_id, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT 'parties', s_suppkey, s_name, s_acctbal FROM supplier")
def _fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        _routed(spark, sf_dir, t, (f"{p}key", f"{t[0]}_name", f"{t[0]}_acctbal"), Route(t, "parties", ((f"{p}key", "party_id"), (f"{t[0]}_name", "name"), (f"{t[0]}_acctbal", "balance"))))
        for t, p in (("customer", "c_cust"), ("supplier", "s_supp"))
    ]
    return fan_in(parts).select(F.col("_table").alias("destination"), "new.*")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders over a price, masked, routed under new names."""
    rules = RuleEngine({"orders": [{"type": "filter", "column": "o_totalprice", "parameters": {"operator": "gt", "value": 100000.0}}, {"type": "transform", "column": "o_orderpriority", "parameters": {"type": "mask", "mask_char": "*"}}]})
    router = Router({"orders": {"destination_table": "transactions", "column_mappings": [{"source": "o_orderkey", "destination": "transaction_id"}, {"source": "o_totalprice", "destination": "amount"}]}})
    return rows_of(Pipeline(rules, router).run(snapshot(scan(spark, sf_dir, "orders"), "orders", ORDERS_KEY), "orders"))


query("rules_then_route", "SELECT o_orderkey AS transaction_id, o_custkey, o_orderstatus, o_totalprice AS amount, o_orderdate, left(o_orderpriority, 1) || repeat('*', length(o_orderpriority) - 2) || right(o_orderpriority, 1) AS o_orderpriority FROM orders WHERE o_totalprice > 100000.0")(flagship)


# --- snapshots and the envelope

for _table, _columns in {"orders": "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority", "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"}.items():
    query(f"snapshot_copy_{_table}", f"SELECT 'INSERT' AS op, '' AS lsn, '{_table}' AS tbl, {_columns} FROM {_table}")(
        lambda s, d, t=_table: snapshot(scan(s, d, t), t).select(F.col("_op").alias("op"), F.col("_lsn").alias("lsn"), F.col("_table").alias("tbl"), "new.*")
    )


@query(
    "snapshot_ranges",
    "WITH sized AS (SELECT (max(o_orderkey) + 20) // 20 AS span FROM orders) SELECT o_orderkey // span AS range_id, count(*) AS n, min(o_orderkey) AS least, max(o_orderkey) AS most FROM orders, sized GROUP BY 1",
)
def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy in 20 ranges of keys, the last one open, each read by a condition of its own that reaches the scan."""
    orders = scan(spark, sf_dir, "orders").select("o_orderkey")
    top = orders.agg(F.max("o_orderkey")).first()[0] + 1
    span, made = -(-top // 20), None
    for k, (a, b) in enumerate(page_ranges(top, span)):
        inside = F.col("o_orderkey") >= a if b is None else (F.col("o_orderkey") >= a) & (F.col("o_orderkey") < b)
        part = snapshot(orders.where(inside), "orders").select(F.lit(k).cast("long").alias("range_id"), "new.o_orderkey")
        made = part if made is None else made.unionByName(part)
    return made.groupBy("range_id").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("most"))


query("cdc_envelope", f"WITH {_CDC} SELECT seq AS _seq, op AS _op, o_orderkey, o_totalprice FROM cdc")(lambda s, d: _shown(orders_cdc(s, d)))
query("cdc_counts_by_op", f"WITH {_CDC} SELECT op AS _op, count(*) AS n FROM cdc GROUP BY op")(lambda s, d: orders_cdc(s, d).groupBy("_op").agg(F.count("*").alias("n")))

# --- replay

query("replay_orders", _REPLAYED)(lambda s, d: replay(orders_cdc(s, d), ["o_orderkey"]))
query("replay_toast", f"SELECT o_orderkey, o_orderpriority FROM ({_REPLAYED}) WHERE o_orderstatus = 'U'")(lambda s, d: replay(orders_cdc(s, d), ["o_orderkey"]).where("o_orderstatus = 'U'").select("o_orderkey", "o_orderpriority"))
query("replay_insert_conflict", f"WITH {_CDC} SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY seq) AS n FROM cdc WHERE op = 'INSERT') WHERE n = 1")(
    lambda s, d: replay(orders_cdc(s, d).where("_op = 'INSERT'"), ["o_custkey"]).select("o_custkey", "o_orderkey", "o_totalprice")
)
query("replay_missing_update", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE false")(lambda s, d: replay(orders_cdc(s, d).where("_op = 'UPDATE'"), ["o_orderkey"]))
query("replay_without_effect", f"WITH {_CDC}, marked AS (SELECT *, coalesce(last_value(CASE WHEN op <> 'UPDATE' THEN op END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 'INSERT', false) AS alive FROM cdc) SELECT op AS _op, count(*) AS n FROM marked WHERE CASE WHEN op = 'INSERT' THEN alive ELSE NOT alive END GROUP BY op")(
    lambda s, d: effective(orders_cdc(s, d), ["o_custkey"]).where("NOT effective").groupBy("_op").agg(F.count("*").alias("n"))
)
query("replay_copy_overlap", _REPLAYED)(lambda s, d: replay(snapshot(scan(s, d, "orders"), "orders").withColumn("_seq", F.lit(-1).cast("long")).unionByName(orders_cdc(s, d)), ["o_orderkey"]))
query("replay_incremental", _REPLAYED)(lambda s, d: replay(orders_cdc(s, d).where("_seq % 4 > 1"), ["o_orderkey"], base=replay(orders_cdc(s, d).where("_seq % 4 <= 1"), ["o_orderkey"])))


@query("replay_key_change", "SELECT CASE WHEN o_orderkey % 7 = 0 THEN -1 - o_orderkey ELSE o_orderkey END AS o_orderkey, o_totalprice FROM orders")
def _key_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    k = F.col("o_orderkey")
    made = lambda part, op, step, **more: model.envelope(part, "orders", op=op, seq=k * 2 + step, row=rows.schema, emitted_at=F.lit(None).cast("timestamp"), **more)
    whole = F.struct("o_orderkey", "o_totalprice")
    moved = made(rows.where(k % 7 == 0), model.UPDATE, 1, old=whole, new=F.struct((-1 - k).alias("o_orderkey"), F.lit(None).cast("double").alias("o_totalprice")), toasted=F.array(F.lit("o_totalprice")))
    return replay(made(rows, model.INSERT, 0, new=whole).unionByName(moved), ["o_orderkey"])


_FULL = ("l_returnflag", "l_linestatus", "l_quantity")


def _full_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *_FULL)
    whole, schema = F.struct(*_FULL), rows.select(*_FULL).schema
    seq = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    made = lambda part, op, **more: model.envelope(part, "lineitem", op=op, seq=seq, row=schema, emitted_at=F.lit(None).cast("timestamp"), **more)
    gone = F.col("l_orderkey") % 11 == 0
    return made(rows.where(~gone), model.INSERT, new=whole).unionByName(made(rows.where(gone), model.DELETE, old=whole))


query(
    "replay_full_identity",
    "WITH c AS (SELECT l_orderkey * 8 + l_linenumber AS seq, l_orderkey % 11 = 0 AS gone, l_returnflag, l_linestatus, l_quantity FROM lineitem), "
    "m AS (SELECT *, max(CASE WHEN gone THEN seq END) OVER (PARTITION BY l_returnflag, l_linestatus, l_quantity) AS last_gone FROM c) "
    "SELECT l_returnflag, l_linestatus, l_quantity FROM m WHERE NOT gone AND (last_gone IS NULL OR seq > last_gone)",
)(lambda s, d: replay_rows(_full_changes(s, d)))


@query("replay_full_update", "SELECT n_regionkey + CASE WHEN n_regionkey < 2 THEN 10 ELSE 0 END AS n_regionkey FROM nation")
def _full_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One UPDATE of a whole row moves all its copies."""
    rows = scan(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    schema = rows.select("n_regionkey").schema
    made = lambda part, op, seq, **more: model.envelope(part, "nation", op=op, seq=seq, row=schema, emitted_at=F.lit(None).cast("timestamp"), **more)
    moves = scan(spark, sf_dir, "region").select(F.col("r_regionkey").cast("int").alias("n_regionkey")).where("n_regionkey < 2")
    updates = made(moves, model.UPDATE, F.lit(10**6) + F.col("n_regionkey"), old=F.struct("n_regionkey"), new=F.struct((F.col("n_regionkey") + 10).cast("int").alias("n_regionkey")))
    return replay_rows(made(rows, model.INSERT, F.col("n_nationkey"), new=F.struct("n_regionkey")).unionByName(updates))


# --- schema changes

def _ddl_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schema-change log with a row for each order: its customer's table gets a column, and some rows are of objects that are not captured."""
    k, t = F.col("o_orderkey"), F.concat(F.lit("app.t"), (F.col("o_custkey") % 500).cast("string"))
    command = F.concat(F.lit("ALTER TABLE "), t, F.lit(" ADD COLUMN c"), (k % 7).cast("string"), F.lit(" int"))
    internal, publication = k % 11 == 0, k % 13 == 0
    return scan(spark, sf_dir, "orders").select(
        k.alias("id"),
        F.lit("ALTER TABLE").alias("event_type"),
        F.when(k % 4 == 0, "table").when(k % 4 == 1, "table column").when(k % 4 == 2, "index").otherwise("view").alias("object_type"),
        F.when(internal, "changeflow_internal.ddl_log").otherwise(t).alias("object_identity"),
        F.when(publication, F.concat(F.lit("CREATE PUBLICATION changeflow_app FOR TABLE "), t)).otherwise(command).alias("ddl_command"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


_LOG_SQL = """log AS (
  SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'table' WHEN 1 THEN 'table column' WHEN 2 THEN 'index' ELSE 'view' END AS object_type,
    o_orderkey % 11 = 0 AS internal, o_orderkey % 13 = 0 AS publication, o_orderdate AS created_at,
    CASE WHEN o_orderkey % 13 = 0 THEN 'CREATE PUBLICATION changeflow_app FOR TABLE app.t' || (o_custkey % 500)
      ELSE 'ALTER TABLE app.t' || (o_custkey % 500) || ' ADD COLUMN c' || (o_orderkey % 7) || ' int' END AS ddl_command
  FROM orders),
kept AS (SELECT * FROM log WHERE object_type <> 'view' AND NOT internal AND NOT publication)"""
_FIRST = "row_number() OVER (PARTITION BY ddl_command ORDER BY created_at, id) = 1"

query("ddl_dedupe", f"WITH {_LOG_SQL} SELECT id, ddl_command FROM log QUALIFY {_FIRST}")(lambda s, d: ddl.deduplicated(_ddl_log(s, d)).select("id", "ddl_command"))
query("ddl_skip", f"WITH {_LOG_SQL} SELECT id, object_type FROM kept")(lambda s, d: ddl.tracked(_ddl_log(s, d)).select("id", "object_type"))
query("ddl_changes", f"WITH {_LOG_SQL} SELECT id AS _seq, 'DDL' AS _op, CASE WHEN object_type = 'table column' THEN '' ELSE 'app' END AS _schema, ddl_command FROM kept QUALIFY {_FIRST}")(
    lambda s, d: ddl.as_changes(ddl.deduplicated(ddl.tracked(_ddl_log(s, d)))).select("_seq", "_op", F.when(F.col("new.object_type") == "table column", "").otherwise(F.col("_schema")).alias("_schema"), "new.ddl_command")
)
query("ddl_evolve", "SELECT r_regionkey AS region_id, CAST(NULL AS VARCHAR) AS note FROM region")(
    lambda s, d: ddl.evolve(scan(s, d, "region"), ddl.parse("ALTER TABLE region ADD COLUMN note text, RENAME COLUMN r_regionkey TO region_id") + ddl.parse("ALTER TABLE region RENAME COLUMN r_regionkey TO region_id") + ddl.parse("ALTER TABLE region DROP COLUMN r_name"))
)

# --- codecs


def _decoded(table: str, key: str, text: Callable[[], Column], decoded: Callable[[Column], Column], name: str) -> Query:
    """The decoded texts that a table's values have in the protocol, or that broken senders make of them."""
    return lambda spark, sf_dir: scan(spark, sf_dir, table).select(F.col(key).alias("id"), text().alias("v")).select("id", decoded(F.col("v")).alias(name))


def _forms(*texts: Column | str | None, key: str = "o_orderkey") -> Column:
    """One of the texts for each row, in turn by its key."""
    made = F.lit(None).cast("string")
    for k, t in enumerate(texts):
        made = F.when(F.col(key) % len(texts) == k, t if isinstance(t, Column) else F.lit(t)).otherwise(made)
    return made


def _told(column: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(column, pattern)


query("decode_bool", "SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS b FROM orders")(
    _decoded("orders", "o_orderkey", lambda: _forms("t", "f", "TRUE", "yes", None, ""), codecs.decode_bool, "b")
)
query("decode_int", "SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN o_custkey WHEN 1 THEN -o_custkey END AS n FROM orders")(
    _decoded("orders", "o_orderkey", lambda: _forms(F.col("o_custkey").cast("string"), F.concat(F.lit("-"), "o_custkey"), F.concat(F.lit(" "), "o_custkey"), F.concat("o_custkey", F.lit(".5")), "9223372036854775808"), codecs.decode_int, "n")
)
query("decode_float", "SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN o_totalprice WHEN 1 THEN -200.0 * o_custkey END AS x FROM orders")(
    _decoded("orders", "o_orderkey", lambda: _forms(F.col("o_totalprice").cast("string"), F.concat(F.lit("-"), F.col("o_custkey") * 2, F.lit("e2")), "null", "abc"), codecs.decode_float, "x")
)
query("decode_numeric", "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 < 2 THEN CAST(CAST(c_acctbal AS DECIMAL(15,2)) AS DECIMAL(18,3)) END AS x FROM customer")(
    _decoded("customer", "c_custkey", lambda: _forms(*[F.col("c_acctbal").cast("decimal(15,2)").cast("string")] * 2, "x", key="c_custkey"), lambda c: codecs.decode_numeric(c, 18, 3), "x")
)
query("decode_bytea", "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 < 2 THEN hex(p_name) END AS b FROM part")(
    _decoded("part", "p_partkey", lambda: _forms(F.concat(F.lit("\\x"), F.lower(F.hex("p_name"))), F.col("p_name"), "\\xzz", key="p_partkey"), lambda c: F.hex(codecs.decode_bytea(c)), "b")
)
query(
    "decode_timestamp",
    "SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN CAST(o_orderdate AS TIMESTAMP) WHEN 1 THEN CAST(o_orderdate AS TIMESTAMP) - INTERVAL 2 HOUR WHEN 2 THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 500 MILLISECOND "
    "WHEN 5 THEN CAST(o_orderdate AS TIMESTAMP) - INTERVAL 330 MINUTE END AS moment FROM orders",
)(
    _decoded(
        "orders",
        "o_orderkey",
        lambda: _forms(_told("o_orderdate"), F.concat(_told("o_orderdate"), F.lit("+02")), F.concat(_told("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".5Z")), _told("o_orderdate", "yyyy-MM-dd"), "12:34", F.concat(_told("o_orderdate"), F.lit("+05:30"))),
        codecs.decode_timestamp,
        "moment",
    )
)
query("decode_date", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders")(
    _decoded("orders", "o_orderkey", lambda: _forms(_told("o_orderdate", "yyyy-MM-dd"), _told("o_orderdate"), _told("o_orderdate", "yyyy-'02'-'30'")), codecs.decode_date, "day")
)
query("decode_array", "SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 0 WHEN 2 THEN -1 ELSE 2 END AS n, CASE o_orderkey % 4 WHEN 0 THEN o_custkey + 3 WHEN 1 THEN 0 WHEN 2 THEN -1 ELSE o_custkey END AS total FROM orders")(
    lambda s, d: _decoded("orders", "o_orderkey", lambda: _forms(F.concat(F.lit("{1,2,"), "o_custkey", F.lit("}")), "{}", "{a}", F.concat(F.lit("{"), "o_custkey", F.lit(",NULL}"))), lambda c: codecs.decode_array(c, "int4"), "a")(s, d).select(
        "id",
        F.coalesce(F.when(F.col("a").isNotNull(), F.size("a")), F.lit(-1)).alias("n"),
        F.coalesce(F.aggregate("a", F.lit(0).cast("long"), lambda x, y: x + F.coalesce(y, F.lit(0).cast("long"))), F.lit(-1).cast("long")).alias("total"),
    )
)
query("decode_text_array", "SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN p_name || '|b,c|q\"t|∅' WHEN 1 THEN '' WHEN 3 THEN 'NULL|' || p_brand END AS joined FROM part")(
    lambda s, d: _decoded(
        "part", "p_partkey", lambda: _forms(F.concat(F.lit('{"'), "p_name", F.lit('","b,c","q\\"t",NULL}')), "{}", F.concat("p_name", F.lit(" is no array")), F.concat(F.lit('{"NULL","'), "p_brand", F.lit('"}')), key="p_partkey"), codecs.array_elements, "a"
    )(s, d).select("id", F.array_join("a", "|", "∅").alias("joined"))
)


@query("codec_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def _roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = scan(spark, sf_dir, "orders")
    row = T.StructType([T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType) for f in orders.schema])
    return rows_of(changelog.from_wire(changelog.to_wire(snapshot(orders.select(*[F.col(f.name).cast(f.dataType) for f in row]), "orders")), "orders", row))


# --- sinks and streams


@query("json_envelope", "SELECT 'INSERT' AS op, 'orders' AS tbl, o_orderkey, o_orderstatus, o_orderkey % 2 AS odd FROM orders")
def _json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", (F.col("o_orderkey") % 2).alias("odd"))
    text = snapshot(rows, "orders").select(message(snapshot(rows, "orders")).alias("m"))
    parsed = text.select(F.from_json("m", "Type string, Table string, NewTuple struct<o_orderkey:long,o_orderstatus:string,odd:long>").alias("j"))
    return parsed.select(F.col("j.Type").alias("op"), F.col("j.Table").alias("tbl"), "j.NewTuple.*")


def _scratch(spark: SparkSession) -> str:
    """A new folder that all executors see."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/query-{uuid.uuid4().hex}"


@query("jsonl_sink_roundtrip", f"WITH {_CDC} SELECT op AS _op, o_orderkey, o_orderstatus FROM cdc WHERE op <> 'DELETE'")
def _jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _scratch(spark)
    JsonLinesSink(out).write(orders_cdc(spark, sf_dir).where("_op <> 'DELETE'"), "orders", 1)
    back = spark.read.text(f"{out}/orders").select(F.from_json("value", "Type string, NewTuple struct<o_orderkey:long,o_orderstatus:string>").alias("j"))
    return back.select(F.col("j.Type").alias("_op"), "j.NewTuple.*")


def _streamed(spark: SparkSession, sf_dir: str, stops: int, files: int) -> DataFrame:
    """The change stream through the log and a streaming worker into a table, stopped and resumed so many times."""
    base = _scratch(spark)
    log, state, out = f"{base}/log", f"{base}/state", f"{base}/tables"
    changes = orders_cdc(spark, sf_dir)
    row = model.row_type(changes)
    sink = TableSink(out, {"orders": ORDERS_KEY})
    for k in range(stops + 1):
        part = changes.where(F.floor(F.col("_seq") % 4 * (stops + 1) / 4) == k)
        changelog.append(changelog.to_wire(part, "g"), log)
        Worker(log, "g", {"orders": row}, sink, files=files).start(spark, state, once=True).awaitTermination()
    return sink.read(spark, "orders")


@query("ddl_rename_replay", "SELECT o_orderkey, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'n' END AS note FROM orders WHERE o_orderkey % 5 <> 4")
def _renamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy, then a renamed and an added column by way of the schema-change log, then changes under the new columns; a worker for each step."""
    base = _scratch(spark)
    log, out = f"{base}/log", TableSink(f"{base}/tables", {"orders": model.ReplicationKey(model.PRIMARY_KEY, ("o_orderkey",))})
    orders = scan(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    commands = [
        (1, "ALTER TABLE", "table column", "public.orders.o_orderstatus", "ALTER TABLE public.orders RENAME COLUMN o_orderstatus TO status", "2024-01-01 00:00:00"),
        (2, "ALTER TABLE", "table", "public.orders", "ALTER TABLE public.orders ADD COLUMN note text", "2024-01-01 00:00:01"),
    ]
    asked = spark.createDataFrame(commands, "id long, event_type string, object_type string, object_identity string, ddl_command string, created_at string").withColumn("created_at", F.col("created_at").cast("timestamp"))
    after = orders.select("o_orderkey", F.lit(None).cast("string").alias("status"), F.lit("n").alias("note")).where("o_orderkey % 2 = 0 OR o_orderkey % 5 = 4")
    gone = F.col("o_orderkey") % 5 == 4
    row = F.struct("o_orderkey", "status", "note")
    later = model.envelope(after, "orders", op=F.when(gone, model.DELETE).otherwise(model.UPDATE), new=F.when(~gone, row), old=F.when(gone, row), seq=F.col("o_orderkey"), toasted=F.array(F.lit("status")), key=ORDERS_KEY)
    for changes in (snapshot(orders, "orders", ORDERS_KEY), ddl.as_changes(ddl.tracked(asked, ["public.orders"])), later):
        changelog.append(changelog.to_wire(changes, "g"), log)
        Worker(log, "g", None, out).start(spark, f"{base}/state", once=True).awaitTermination()
    return out.read(spark, "orders")


@query("copy_then_stream", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'changed' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def _copied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed updates from position 0 on come after the copy, whatever the order of the log's files."""
    orders = scan(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    row = F.struct("o_orderkey", F.lit("changed").alias("o_orderstatus"))
    stream = model.envelope(orders.where("o_orderkey % 3 = 0"), "orders", op=model.UPDATE, new=row, old=F.lit(None).cast(orders.schema.simpleString()), seq=F.lit(0), key=ORDERS_KEY)
    return replay(stream.unionByName(snapshot(orders, "orders", ORDERS_KEY)), ["o_orderkey"])


query("stream_microbatch", _REPLAYED)(lambda s, d: _streamed(s, d, 0, 100))
query("stream_resume", _REPLAYED)(lambda s, d: _streamed(s, d, 1, 100))
query("row_md5_checksum", "SELECT o_orderkey, md5(concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)) AS checksum FROM orders")(
    lambda s, d: rows_of(snapshot(scan(s, d, "orders"), "orders")).select("o_orderkey", F.md5(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus", "o_orderpriority")).alias("checksum"))
)


@query(
    "type_registry",
    "SELECT t.name, t.oid, t.kind, o.n FROM (VALUES ('o_orderkey', 20, 'int8'), ('o_custkey', 20, 'int8'), ('o_orderstatus', 25, 'text'), ('o_totalprice', 701, 'float8'), ('o_orderdate', 1114, 'timestamp'), ('o_orderpriority', 25, 'text')) AS t(name, oid, kind), "
    "(SELECT count(*) AS n FROM orders) o",
)
def _registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types that the rows of a table carry through the log."""
    told = changelog.to_wire(snapshot(scan(spark, sf_dir, "orders"), "orders")).select(F.explode("columns").alias("c")).groupBy("c.name", "c.oid").agg(F.count("*").alias("n"))
    names = F.create_map(*[F.lit(x) for oid in (20, 25, 701, 1114) for x in (oid, pgtypes.type_name(oid))])
    return told.select("name", "oid", names[F.col("oid")].alias("kind"), "n")


# --- the protocol: changes of orders as frames of a server, decoded by many tasks


def _captured(spark: SparkSession, sf_dir: str, range_bytes: int = 1 << 18) -> DataFrame:
    """The change stream as one transaction an order, told in frames, and read back by the data source."""
    path = f"{_scratch(spark)}/frames"
    write_capture(to_frames(orders_cdc(spark, sf_dir), F.lit(4096) + F.col("_seq").bitwiseAND(F.lit(-4)) * 16, "orders", ["o_orderkey"]), path)
    spark.dataSource.register(PgOutputDataSource)
    return spark.read.format("changeflow_pgoutput").option("path", path).option("rangeBytes", range_bytes).load()


def _orders_row(spark: SparkSession, sf_dir: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType) for f in scan(spark, sf_dir, "orders").schema])


_DECODED = """decoded AS (
  SELECT ((4096 + o_orderkey * 64) << 14) + row_number() OVER (PARTITION BY o_orderkey ORDER BY seq) - 1 AS _seq, * FROM cdc)"""

query(
    "decode_frames",
    f"WITH {_CDC}, {_DECODED} SELECT _seq, op AS _op, o_orderkey, o_totalprice, op = 'UPDATE' AND kept AS left_out, 'public.orders' AS tbl, 'o_orderkey' AS key_column, 4096 + o_orderkey * 64 AS commit_position FROM decoded",
)(
    lambda s, d: changelog.from_wire(_captured(s, d), "orders", _orders_row(s, d)).select(
        "_seq",
        "_op",
        F.coalesce("new", "old")["o_orderkey"].alias("o_orderkey"),
        F.coalesce("new", "old")["o_totalprice"].alias("o_totalprice"),
        F.array_contains("_toasted", "o_orderpriority").alias("left_out"),
        F.concat_ws(".", "_schema", "_table").alias("tbl"),
        F.col("_key.columns")[0].alias("key_column"),
        F.conv(F.split("_commit_lsn", "/")[1], 16, 10).cast("long").alias("commit_position"),
    )
)


def _typed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decoded changes, decoded once: a replay reads them for moved keys first, then for the rows."""
    return stored(changelog.from_wire(_captured(spark, sf_dir), "orders", _orders_row(spark, sf_dir)))


query("decode_replay", _REPLAYED)(lambda s, d: replay(_typed_stream(s, d), ["o_orderkey"]))


@query("copy_and_stream_decoded", _REPLAYED)
def _copied_and_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capture mode of a copy with the stream that goes on from it; the stream repeats what the copy has."""
    row = _orders_row(spark, sf_dir)
    copy = snapshot(scan(spark, sf_dir, "orders").select(*[F.col(f.name).cast(f.dataType) for f in row]), "orders", ORDERS_KEY)
    stream = _typed_stream(spark, sf_dir)
    return replay(registry.capture("copy-and-stream", {"orders": copy}, {"orders": stream})["orders"], ["o_orderkey"])


# --- state


@query("replay_stateful", _REPLAYED)
def _stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change stream through the log into the state store, stopped and resumed between batches, and into a table."""
    base = _scratch(spark)
    log, out = f"{base}/log", TableSink(f"{base}/tables", {"orders": ORDERS_KEY})
    changes = orders_cdc(spark, sf_dir)
    for k in range(3):
        changelog.append(changelog.to_wire(changes.where(F.floor(F.col("_seq") % 4 * 3 / 4) == k), "g"), log)
        stream = changelog.from_wire(changelog.read_stream(spark, log, "g"), "orders", _orders_row(spark, sf_dir))
        replay_stream(stream, "orders", ["o_orderkey"], out, f"{base}/state", once=True).awaitTermination()
    return out.read(spark, "orders")


# --- names that change their meaning


@query(
    "ddl_history",
    "SELECT o_orderkey, o_orderstatus AS c, o_custkey AS b, CASE WHEN o_orderkey % 2 = 0 THEN 'x' || o_orderkey END AS a FROM orders WHERE o_orderkey % 7 <> 0 "
    "UNION ALL SELECT -1 - o_orderkey, 'N', o_orderkey, NULL FROM orders WHERE o_orderkey % 5 = 0",
)
def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name given up and given again (RENAME and ADD, DROP and ADD), two names swapped, a table renamed; half of it in one batch."""
    base = _scratch(spark)
    log, out = f"{base}/log", TableSink(f"{base}/tables", {})
    orders, k = scan(spark, sf_dir, "orders"), F.col("o_orderkey")

    def rows(step: int, op: str, columns: list[Column], where: Column, table: str = "orders", left_out: tuple[str, ...] = ()) -> DataFrame:
        made = orders.where(where).select(*columns)
        whole = F.struct(*made.columns)
        sides = {"old": whole} if op == model.DELETE else {"new": whole, "old": F.lit(None).cast(made.schema)}
        sides.setdefault("new", F.lit(None).cast(made.schema))
        return model.envelope(made, table, op=op, seq=F.lit(step << 44) + F.abs(made[made.columns[0]]), key=ORDERS_KEY, toasted=F.array(*map(F.lit, left_out)), **sides)

    def commands(step: int, *texts: str, table: str = "orders") -> DataFrame:
        told = [(i, "ALTER TABLE", "table", f"public.{table}", text, "2024-01-01 00:00:00", (step << 30) + i) for i, text in enumerate(texts)]
        asked = spark.createDataFrame(told, "id long, event_type string, object_type string, object_identity string, ddl_command string, created_at string, position long")
        return ddl.as_changes(asked.withColumn("created_at", F.col("created_at").cast("timestamp")))

    status, customer = F.col("o_orderstatus"), F.col("o_custkey")
    none = lambda kind: F.lit(None).cast(kind)
    steps = [
        snapshot(orders.select(k, status.alias("a"), customer.alias("c")), "orders", ORDERS_KEY),
        commands(1, "ALTER TABLE orders RENAME COLUMN a TO b", "ALTER TABLE orders ADD COLUMN a bigint"),
        rows(2, model.UPDATE, [k, none("string").alias("b"), none("long").alias("c"), k.alias("a")], k % 3 == 0, left_out=("b", "c")),
        commands(3, "ALTER TABLE orders RENAME COLUMN b TO t", "ALTER TABLE orders RENAME COLUMN c TO b", "ALTER TABLE orders RENAME COLUMN t TO c"),
        rows(4, model.INSERT, [(-1 - k).alias("o_orderkey"), F.lit("N").alias("c"), k.alias("b"), none("long").alias("a")], k % 5 == 0),
        commands(5, "ALTER TABLE orders DROP COLUMN a", "ALTER TABLE orders ADD COLUMN a text"),
        rows(6, model.UPDATE, [k, none("string").alias("c"), none("long").alias("b"), F.concat(F.lit("x"), k).alias("a")], k % 2 == 0, left_out=("c", "b")),
        commands(7, "ALTER TABLE orders RENAME TO purchases", table="purchases"),
        rows(8, model.DELETE, [k, status.alias("c"), customer.alias("b"), none("string").alias("a")], k % 7 == 0, "purchases"),
    ]
    for part in (steps[6::-1], steps[7:]):  # the log's files in no order: positions tell it
        for changes in part:
            changelog.append(changelog.to_wire(changes, "g"), log)
        Worker(log, "g", None, out).start(spark, f"{base}/state", once=True).awaitTermination()
    return out.read(spark, "purchases").select("o_orderkey", "c", "b", "a")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
