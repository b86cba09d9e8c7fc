"""Truth tables of the filter predicates."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import model
from changeflow.operators.predicates import as_int, as_timestamp, predicate, two_valued
from changeflow.operators.rules import FilterRule, build
from changeflow.sources.snapshot import snapshot

INT, DOUBLE, TEXT, BOOL, STAMP, NUM, DATE = T.IntegerType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampType(), T.DecimalType(15, 2), T.DateType()

CASES = [
    (TEXT, "completed", "eq", "completed", True),
    (TEXT, "pending", "eq", "completed", False),
    (TEXT, "electronics", "eq", "Electronics", False),
    (INT, 15, "gt", 10, True),
    (INT, 10, "gt", "5", True),
    (INT, 10, "gt", 5.5, False),
    (INT, 0, "ne", False, False),
    (DOUBLE, 99.99, "lt", 100, True),
    (DOUBLE, 1.0, "lt", "2.5", True),
    (TEXT, "Premium Widget", "contains", "Premium", True),
    (TEXT, "john doe", "contains", "John", False),
    (TEXT, "x", "contains", "", True),
    (TEXT, None, "contains", "", False),
    (TEXT, "5", "eq", 5, False),
    (TEXT, "true", "eq", True, False),
    (BOOL, True, "eq", True, True),
    (BOOL, False, "ne", True, True),
    (BOOL, True, "gte", True, True),
    (BOOL, True, "gt", False, False),
    (BOOL, None, "ne", True, False),
    (NUM, Decimal("100.00"), "gte", "99.99", True),
    (NUM, Decimal("999.99"), "lt", "1000.00", True),
    (NUM, Decimal("999.99"), "lt", 1000.0, False),
    (NUM, Decimal("1.50"), "eq", "1.500", True),
    (STAMP, datetime(2024, 1, 1, 12), "eq", "2024-01-01T07:00:00-05:00", True),
    (STAMP, datetime(2024, 1, 1, 12), "gt", "2024-01-01 11:59:59", True),
    (STAMP, datetime(2024, 1, 1, 12), "gt", "2024-01-01", False),
    (DATE, datetime(2024, 1, 1).date(), "eq", "2024-01-01", False),
    (INT, None, "ne", 3, False),
    (DOUBLE, float("nan"), "gt", 1.0, False),
    (DOUBLE, float("nan"), "ne", 1.0, True),
    (DOUBLE, float("nan"), "eq", float("nan"), False),
    (DOUBLE, 1.0, "ne", float("nan"), True),
]


@pytest.mark.parametrize("kind,value,operator,operand,passes", CASES)
def test_truth_table(spark, kind, value, operator, operand, passes):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("c", kind)]))
    compiled = predicate(F.col("c"), df.schema["c"], operator, operand)
    assert df.where(compiled).count() == int(passes)
    assert df.select(two_valued(compiled)).first()[0] is passes


def test_passed_types_have_contains_only(spark):
    field = T.StructField("c", TEXT, True, {"pg_oid": 2950})
    df = spark.createDataFrame([("abc",)], T.StructType([field]))
    assert df.where(predicate(F.col("c"), field, "eq", "abc")).count() == 0
    assert df.where(predicate(F.col("c"), field, "eq", "abc", typed=True)).count() == 1
    assert df.where(predicate(F.col("c"), field, "contains", "b")).count() == 1


def test_operands():
    assert as_int("7") == 7 and as_int(7.0) is None and as_int(True) is None and as_int("9223372036854775808") is None
    assert as_timestamp("2024-01-01 00:00:00+02") < as_timestamp("2024-01-01 00:00:00")
    assert as_timestamp("12:34") is None


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("int").alias("a"), F.col("id").cast("double").alias("b"), F.lit("x").alias("c")).write.parquet(str(tmp_path / "t"))
    df = FilterRule("a", "gt", 90).apply(snapshot(spark.read.parquet(str(tmp_path / "t")), "t")).select("new.a")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,90)" in plan and "ReadSchema: struct<a:int>" in plan
    assert df.count() == 9


@pytest.mark.parametrize(
    "config",
    [
        {"type": "filter", "column": "a", "parameters": {"value": 1}},
        {"type": "filter", "column": "a", "parameters": {"operator": "eq"}},
        {"type": "filter", "column": "a", "parameters": {"operator": "between", "value": 1}},
        {"type": "transform", "column": "a", "parameters": {"type": "upper"}},
        {"type": "transform", "column": "a", "parameters": {"type": "mask"}},
        {"type": "transform", "column": "a", "parameters": {"type": "regex", "pattern": "("}},
        {"type": "nothing"},
        {"type": "filter", "column": "a", "operations": ["MERGE"], "parameters": {"operator": "eq", "value": 1}},
    ],
)
def test_config_errors(config):
    with pytest.raises(ValueError):
        build(config)


def _changes(spark):
    row = "struct<id:int,age:int>"
    rows = [(1, "INSERT", (1, 30), None), (2, "UPDATE", (1, 10), (1, 30)), (3, "DELETE", None, (1, 30)), (4, "DELETE", None, (1, 10)), (5, "DDL", None, None)]
    return spark.createDataFrame(rows, f"_seq long, _op string, new {row}, old {row}")


def test_operation_gates(spark):
    seqs = lambda df: sorted(r["_seq"] for r in df.collect())
    c = _changes(spark)
    assert seqs(FilterRule("age", "gte", 18).apply(c)) == [1, 3, 5]
    assert seqs(FilterRule("age", "gte", 18, allow_empty_deletes=True).apply(c)) == [1, 3, 4, 5]
    assert seqs(FilterRule("age", "gte", 18, operations=("UPDATE",)).apply(c)) == [1, 3, 4, 5]
    assert seqs(FilterRule("none", "gte", 18).apply(c)) == [5]
    assert model.DATA_OPERATIONS == ("INSERT", "UPDATE", "DELETE")
