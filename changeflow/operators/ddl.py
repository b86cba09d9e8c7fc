"""Schema changes: what of the schema-change log is passed on, and applying it to tables.

Log rows: event_type, object_type, object_identity, ddl_command, created_at, and id for their order.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import model

#: Room of a change's place in its transaction, below the log position, in ``_seq``.
ORDINAL_BITS = 14
#: Objects whose changes are captured (fixed values).
OBJECTS = ("table", "table column", "index")


def tracked(log: DataFrame, tables: Sequence[str] = (), internal_schema: str = "changeflow_internal", publication_prefix: str = "changeflow_") -> DataFrame:
    """Without the engine's own objects and publications, and without tables that are not replicated."""
    own = F.contains(F.lower("ddl_command"), F.lit(internal_schema)) | F.contains(F.col("object_identity"), F.lit(internal_schema)) | (F.lower("ddl_command").rlike(r"\bpublication\s+\"?" + re.escape(publication_prefix)))
    kept = log.where(~F.coalesce(own, F.lit(False)) & F.col("object_type").isin(*OBJECTS))
    if tables:
        named = None
        for t in tables:
            one = (F.col("object_identity") == t) | F.col("object_identity").startswith(f"{t}.") | F.contains("ddl_command", F.lit(t))
            named = one if named is None else named | one
        kept = kept.where(named)
    return kept


def deduplicated(log: DataFrame) -> DataFrame:
    """The first of the rows with the same command text, by time, then id."""
    first = Window.partitionBy("ddl_command").orderBy("created_at", "id")
    return log.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def as_changes(log: DataFrame, seq_from: int = 0) -> DataFrame:
    """DDL changes in the order of the log; the new row holds the log's columns.

    A log that tells the ``position`` (of the source's write-ahead log, where the command ran) gives each
    command its place among the streamed changes: a table is locked while it changes, so all changes of
    transactions before have committed at lower positions, and all others come at higher ones.
    """
    columns = ["event_type", "object_type", "object_identity", "ddl_command", "created_at"]
    seq = F.col("id") + seq_from
    if "position" in log.columns:
        place = F.row_number().over(Window.partitionBy("position").orderBy("id")) - 1
        seq = F.coalesce(F.shiftleft(F.col("position").cast("long"), ORDINAL_BITS) + place, seq)
    made = model.envelope(log.withColumn("_at", seq).select(*columns, "_at"), "", op=model.DDL, new=F.struct(*columns), seq=F.col("_at"), row=log.select(*columns).schema)
    source = F.col("new.object_identity")
    # The identity of a column is schema.table.column.
    column, parts = F.col("new.object_type") == "table column", r"^([^.]*)\.([^.]*)\."
    return made.withColumns({"_schema": F.regexp_extract(source, r"^([^.]*)\.", 1), "_table": F.when(column, F.regexp_extract(source, parts, 2)).otherwise(F.regexp_replace(source, r"^[^.]*\.", ""))})


#: PostgreSQL names of types in commands and what columns become (fixed values).
TYPES = {
    "text": "string", "varchar": "string", "character varying": "string", "char": "string", "uuid": "string", "json": "string", "jsonb": "string", "int": "int", "integer": "int", "int4": "int",
    "bigint": "long", "int8": "long", "smallint": "short", "int2": "short", "boolean": "boolean", "bool": "boolean", "real": "float", "float4": "float", "double precision": "double", "float8": "double",
    "numeric": "decimal(38,18)", "decimal": "decimal(38,18)", "date": "date", "timestamp": "timestamp", "timestamptz": "timestamp", "bytea": "binary",
}
_ID = r'(?:"(?:[^"]|"")+"|[A-Za-z_][\w$]*)'
_TABLE = re.compile(rf"\s*ALTER\s+TABLE\s+(?:IF\s+EXISTS\s+)?(?:ONLY\s+)?({_ID}(?:\.{_ID})?)\s+(.*?);?\s*$", re.I | re.S)


@dataclass(frozen=True)
class SchemaChange:
    """``action``: add, drop, rename, retype, rename_table, default or none (indexes and what tables of files do not have)."""

    action: str
    table: str = ""
    column: str = ""
    to: str = ""


def _plain(name: str) -> str:
    return name[1:-1].replace('""', '"') if name.startswith('"') else name.lower()


def _spark_type(text: str) -> str:
    text = re.sub(r"\s+(NOT\s+NULL|NULL|DEFAULT|PRIMARY|UNIQUE|REFERENCES|CHECK|COLLATE|USING|GENERATED)\b.*", "", text.strip(), flags=re.I | re.S)
    if m := re.fullmatch(r"(?:numeric|decimal)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", text, re.I):
        return f"decimal({m[1]},{m[2] or 0})"
    if text.endswith("[]"):
        return f"array<{_spark_type(text[:-2])}>"
    name = re.sub(r"\s*\(.*\)", "", text).lower()
    name = re.sub(r"^(timestamp)\s+(with|without)\s+time\s+zone$", r"\1", name)
    return TYPES.get(" ".join(name.split()), "string")


def _actions(text: str) -> list[str]:
    """The comma-separated actions of a command; commas in brackets or quotes do not part them."""
    out, depth, quoted, start = [], 0, "", 0
    for i, c in enumerate(text):
        if quoted:
            quoted = "" if c == quoted else quoted
        elif c in "'\"":
            quoted = c
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "," and not depth:
            out.append(text[start:i])
            start = i + 1
    return [a.strip() for a in (*out, text[start:])]


def parse(command: str) -> list[SchemaChange]:
    """The schema changes of one command; none of them for indexes and other objects."""
    m = _TABLE.match(command)
    if not m:
        return [SchemaChange("none")]
    table, out = ".".join(_plain(p) for p in re.findall(_ID, m[1])), []
    for action in _actions(m[2]):
        if a := re.match(rf"RENAME\s+TO\s+({_ID})$", action, re.I):
            out.append(SchemaChange("rename_table", table, to=_plain(a[1])))
        elif a := re.match(rf"RENAME\s+(?:COLUMN\s+)?({_ID})\s+TO\s+({_ID})$", action, re.I):
            out.append(SchemaChange("rename", table, _plain(a[1]), _plain(a[2])))
        elif a := re.match(rf"DROP\s+(?:COLUMN\s+)?(?:IF\s+EXISTS\s+)?(?!CONSTRAINT\b)({_ID})(?:\s+(?:CASCADE|RESTRICT))?$", action, re.I):
            out.append(SchemaChange("drop", table, _plain(a[1])))
        elif a := re.match(rf"ALTER\s+(?:COLUMN\s+)?({_ID})\s+(?:SET\s+DATA\s+)?TYPE\s+(.+)$", action, re.I | re.S):
            out.append(SchemaChange("retype", table, _plain(a[1]), _spark_type(a[2])))
        elif a := re.match(rf"ALTER\s+(?:COLUMN\s+)?({_ID})\s+(?:SET|DROP)\s+(?:DEFAULT|NOT\s+NULL)", action, re.I):
            out.append(SchemaChange("default", table, _plain(a[1])))
        elif a := re.match(rf"ADD\s+(?:COLUMN\s+)?(?:IF\s+NOT\s+EXISTS\s+)?(?!CONSTRAINT\b|PRIMARY\b|UNIQUE\b|FOREIGN\b|CHECK\b)({_ID})\s+(.+)$", action, re.I | re.S):
            out.append(SchemaChange("add", table, _plain(a[1]), _spark_type(a[2])))
        else:
            out.append(SchemaChange("none", table))
    return out


def evolve(rows: DataFrame, changes: Sequence[SchemaChange]) -> DataFrame:
    """The rows of one schema under the next. What is not there any more is left alone, as a repeated command would be; values that a new type cannot hold raise."""
    for c in changes:
        has = c.column in rows.columns
        if c.action == "add" and not has:
            rows = rows.withColumn(c.column, F.lit(None).cast(c.to))
        elif c.action == "drop" and has:
            rows = rows.drop(F.col(f"`{c.column}`"))
        elif c.action == "rename" and has and c.to not in rows.columns:
            rows = rows.withColumnRenamed(c.column, c.to)
        elif c.action == "rename" and has and c.to != c.column:  # rows under the new name came before the command
            kind = rows.schema[c.to].dataType
            rows = rows.withColumn(c.to, F.coalesce(F.col(f"`{c.to}`"), F.col(f"`{c.column}`").try_cast(kind))).drop(F.col(f"`{c.column}`"))
        elif c.action == "retype" and has:
            rows = rows.withColumn(c.column, strict_cast(F.col(f"`{c.column}`"), c.to, c.column))
    return rows


def strict_cast(c: Column, kind: str | T.DataType, name: str) -> Column:
    """The value in another type; one that it cannot hold raises instead of going lost."""
    made = c.try_cast(kind)
    lost = F.concat(F.lit(f"column {name} has a value that its new type cannot hold: "), F.coalesce(c.cast("string"), F.lit("")))
    return F.when(c.isNotNull() & made.isNull(), F.raise_error(lost)).otherwise(made)
