"""What a sink is, and the JSON form of a change."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import model


class Sink(Protocol):
    """Takes the changes of one table in a batch; a batch that comes again after a failure has the same number."""

    def write(self, changes: DataFrame, table: str, batch: int = 0) -> None: ...


def _shown(c: Column, t: T.DataType) -> Column:
    if isinstance(t, T.BinaryType):
        return F.base64(c)
    if isinstance(t, T.DecimalType):
        return c.cast("string")
    if isinstance(t, T.TimestampType):
        return F.regexp_replace(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), r"\.?0*Z$", "Z")
    return c


def message(changes: DataFrame) -> Column:
    """The JSON text of a change: Type, Schema, Table, ReplicationKey, LSN, EmittedAt, and NewTuple and OldTuple where they are there, nulls in them written out."""
    row = model.row_type(changes)
    side = lambda s: F.struct(*[_shown(model.field(s, f.name), f.dataType).alias(f.name) for f in row])
    head = F.struct(
        F.col("_op").alias("Type"), F.col("_schema").alias("Schema"), F.col("_table").alias("Table"), F.struct(F.col("_key.type").alias("Type"), F.col("_key.columns").alias("Columns")).alias("ReplicationKey"),
        F.col("_lsn").alias("LSN"), _shown(F.col("_emitted_at"), T.TimestampType()).alias("EmittedAt"),
    )
    json = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    tuple_of = lambda s, name: F.when(F.col(s).isNotNull(), F.concat(F.lit(f',"{name}":'), json(side(s)))).otherwise("")
    return F.concat(F.regexp_replace(json(head), r"\}$", ""), tuple_of("new", "NewTuple"), tuple_of("old", "OldTuple"), F.lit("}"))
