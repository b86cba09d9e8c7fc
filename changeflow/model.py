"""The change envelope: one row for each change of a table.

Columns: ``_seq`` (order of publication within a group, assigned at ingest; log positions are no sort
key), ``_lsn``, ``_commit_lsn``, ``_op``, ``_schema``, ``_table``, ``_key`` (type and columns of the
replication key), ``_emitted_at``, ``_toasted`` (columns that an UPDATE left out because they did not
change, which is not NULL), ``new`` and ``old`` (nullable structs with the table's columns).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INSERT, UPDATE, DELETE, DDL = "INSERT", "UPDATE", "DELETE", "DDL"
OPERATIONS = (INSERT, UPDATE, DELETE, DDL)
#: What rules and routes act on when they name no operations.
DATA_OPERATIONS = (INSERT, UPDATE, DELETE)
#: Where snapshots stand: after the rows of a target, before every streamed change.
BEFORE = -(2**61)
PRIMARY_KEY, UNIQUE, FULL = "PRIMARY KEY", "UNIQUE", "FULL"

META = ("_seq", "_lsn", "_commit_lsn", "_op", "_schema", "_table", "_key", "_emitted_at", "_toasted")


@dataclass(frozen=True)
class ReplicationKey:
    """How a change finds its row: by key columns, or by the whole row (FULL)."""

    type: str = FULL
    columns: tuple[str, ...] = ()

    def is_valid(self) -> bool:
        return self.type == FULL or self.type in (PRIMARY_KEY, UNIQUE) and len(self.columns) > 0

    def column(self) -> Column:
        return F.struct(F.lit(self.type).alias("type"), F.array(*map(F.lit, self.columns)).cast("array<string>").alias("columns"))

    def renamed(self, names: dict[str, str]) -> ReplicationKey:
        """The key after columns were renamed; FULL has no columns to rename."""
        return self if self.type == FULL else ReplicationKey(self.type, tuple(names.get(c, c) for c in self.columns))


def choose_key(primary: list[str] | None, unique: list[list[str]] | None, full_identity: bool = False) -> ReplicationKey | None:
    """The key of a table: primary key, else the first unique index, else whole rows if the table logs them, else none."""
    if primary:
        return ReplicationKey(PRIMARY_KEY, tuple(primary))
    for columns in unique or []:
        if columns:
            return ReplicationKey(UNIQUE, tuple(columns))
    return ReplicationKey(FULL) if full_identity else None


def row_type(changes: DataFrame) -> T.StructType:
    """The table's columns."""
    return changes.schema["new"].dataType


def columns_of(changes: DataFrame) -> list[str]:
    return row_type(changes).names


def field(struct: str | Column, name: str) -> Column:
    """A field of a struct column, whatever characters its name has."""
    return (F.col(struct) if isinstance(struct, str) else struct).getField(name)


def envelope(
    rows: DataFrame,
    table: str,
    op: Column | str = INSERT,
    new: Column | None = None,
    old: Column | None = None,
    seq: Column | None = None,
    key: ReplicationKey | None = None,
    schema: str = "public",
    lsn: Column | str = "",
    emitted_at: Column | None = None,
    toasted: Column | None = None,
    row: T.StructType | None = None,
) -> DataFrame:
    """Changes from ``rows``; without ``new`` and ``old`` whole rows are inserted."""
    row = row or rows.schema
    kind = row.simpleString()
    if new is None and old is None:
        new = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    as_col = lambda c: F.lit(c) if isinstance(c, str) else c
    return rows.select(
        (seq if seq is not None else F.lit(None)).cast("long").alias("_seq"),
        as_col(lsn).alias("_lsn"),
        as_col(lsn).alias("_commit_lsn"),
        as_col(op).alias("_op"),
        F.lit(schema).alias("_schema"),
        F.lit(table).alias("_table"),
        (key or ReplicationKey()).column().alias("_key"),
        (emitted_at if emitted_at is not None else F.current_timestamp()).alias("_emitted_at"),
        (toasted if toasted is not None else F.array()).cast("array<string>").alias("_toasted"),
        (new if new is not None else F.lit(None).cast(kind)).alias("new"),
        (old if old is not None else F.lit(None).cast(kind)).alias("old"),
    )


def widened(changes: DataFrame, columns: T.StructType) -> DataFrame:
    """Changes with further columns, which every UPDATE leaves out and every INSERT has as null."""
    more = [f for f in columns if f.name not in row_type(changes).names]
    if not more:
        return changes
    names = F.array(*[F.lit(f.name) for f in more])
    for side in ("new", "old"):
        own = [field(side, f.name).alias(f.name) for f in changes.schema[side].dataType]
        changes = changes.withColumn(side, F.when(F.col(side).isNotNull(), F.struct(*own, *[F.lit(None).cast(f.dataType).alias(f.name) for f in more])))
    return changes.withColumn("_toasted", F.when(F.col("_op") == UPDATE, F.array_union("_toasted", names)).otherwise(F.col("_toasted")))


def operand(name: str) -> Column:
    """What a filter or mask reads: the old value of a DELETE, else the new one; old falls back to new where there is none."""
    before = F.when(F.col("old").isNotNull(), field("old", name)).otherwise(field("new", name))
    return F.when(F.col("_op") == DELETE, before).otherwise(field("new", name))
