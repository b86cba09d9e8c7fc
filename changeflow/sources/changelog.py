"""The change log: an append-only folder of changes of many tables, partitioned by group and table.

Tables differ in columns, so the log has one wire form: column names and type numbers, and the rows as
arrays of PostgreSQL text. ``to_wire`` and ``from_wire`` convert to and from the typed form of a table.
A batch is a commit's worth of changes or several: the files of one write appear together, so that a
reader never sees a part of a commit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import model, pgtypes
from changeflow.functions.codecs import decode, encode
from changeflow.operators.history import Reading, reading_of

WIRE = (
    "_seq long, _lsn string, _commit_lsn string, _op string, _schema string, _key struct<type:string,columns:array<string>>, _emitted_at timestamp, "
    "_toasted array<string>, columns array<struct<name:string,oid:int>>, new array<string>, old array<string>, _group string, _table string"
)


def to_wire(changes: DataFrame, group: str = "default") -> DataFrame:
    """Typed changes of one table as wire rows; null columns stay null, and an empty text stays empty."""
    row = model.row_type(changes)
    side = lambda s: F.when(F.col(s).isNotNull(), F.array(*[encode(model.field(s, f.name), pgtypes.oid_of(f)) for f in row]))
    columns = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(pgtypes.oid_of(f)).alias("oid")) for f in row])
    names = [c for c in model.META if c != "_table"]
    return changes.select(*names, columns.alias("columns"), side("new").alias("new"), side("old").alias("old"), F.lit(group).alias("_group"), "_table")


def _value(side: str, name: str) -> Column:
    """A column by its name in the row's own column list; null if the row has none of the name."""
    return F.try_element_at(side, F.nullif(_place(name), F.lit(0)))


def _place(name: str, names: str = "columns.name") -> Column:
    return F.array_position(names, F.lit(name)).cast("int")


def from_wire(log: DataFrame, table: str, row: T.StructType, schema: str = "public", readings: Sequence[Reading] = (), names: Sequence[tuple[str, int, int]] = ()) -> DataFrame:
    """Typed changes of one table from the log.

    ``row`` may have columns that older rows lack: an UPDATE of those leaves them out, which is not NULL.
    ``readings`` tell for lists of column names, from position to position, which column each name means;
    rows of other lists are read by the names that they have. ``names`` are those that the table bore, each
    from a position to another, if they differ from ``table``.
    """
    mine = F.col("_table") == table
    if names:
        spans = [(F.col("_table") == n) & (F.col("_seq") >= since) & (F.col("_seq") < until) for n, since, until in names]
        mine = reduce(lambda a, b: a | b, spans)
    own = log.where(mine & (F.col("_schema") == schema)).withColumn("_names", F.col("columns.name"))
    # Places are looked up once for each row, not for each side of it.
    places, told = F.array(*[_place(f.name, "_names") for f in row]).cast("array<int>"), F.col("_names")
    if readings:
        own = own.withColumn("_reading", reading_of(readings, F.col("_names"), F.col("_seq")))
        known = F.array(*[F.array(*map(F.lit, r.places)).cast("array<int>") for r in readings])
        now = F.array(*[F.array(*map(F.lit, r.renamed)).cast("array<string>") for r in readings])
        places = F.coalesce(F.try_element_at(known, F.col("_reading") + 1), places)
        told = F.coalesce(F.try_element_at(now, F.col("_reading") + 1), told)
    own = own.withColumn("_at", places).withColumn("_now", told)
    place = lambda i: F.nullif(F.get("_at", F.lit(i)), F.lit(0))
    side = lambda s: F.when(F.col(s).isNotNull(), F.struct(*[_typed(F.try_element_at(s, place(i)), f).alias(f.name) for i, f in enumerate(row)]))
    left = F.col("_toasted")
    if readings:
        called = lambda c: F.try_element_at("_now", F.nullif(F.array_position("_names", c).cast("int"), F.lit(0)))
        left = F.when(F.size(left) > 0, F.filter(F.transform(left, called), lambda c: c.isNotNull())).otherwise(left)
    lacking = F.filter(F.array(*[F.when(place(i).isNull(), F.lit(f.name)) for i, f in enumerate(row)]).cast("array<string>"), lambda c: c.isNotNull())
    toasted = F.when((F.col("_op") == model.UPDATE) & (F.size(lacking) > 0), F.array_union(left, lacking)).otherwise(left)
    given = {"_toasted": toasted.alias("_toasted"), "_table": F.lit(table).alias("_table")}
    return own.select(*[given.get(c, c) for c in model.META], side("new").alias("new"), side("old").alias("old"))


def _typed(c: Column, f: T.StructField) -> Column:
    if isinstance(f.dataType, T.DecimalType):
        return c.try_cast(f.dataType)
    if isinstance(f.dataType, (T.VariantType,)):
        return F.try_parse_json(c)
    return decode(c, pgtypes.oid_of(f)).cast(f.dataType)


def append(wire: DataFrame, path: str) -> None:
    """Adds changes to the log."""
    wire.write.mode("append").partitionBy("_group", "_table").parquet(path)


def read(spark: SparkSession, path: str, group: str | None = None) -> DataFrame:
    log = spark.read.schema(WIRE).parquet(path)
    return log.where(F.col("_group") == group) if group is not None else log


def read_stream(spark: SparkSession, path: str, group: str | None = None, max_files: int = 100, retention: str | None = None, archive: str | None = None) -> DataFrame:
    """The log as a stream, so many files a batch; with ``archive`` read files move there, which keeps the log short."""
    reader = spark.readStream.schema(WIRE).option("maxFilesPerTrigger", max_files)
    if retention is not None:
        reader = reader.option("maxFileAge", retention)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    log = reader.parquet(path)
    return log.where(F.col("_group") == group) if group is not None else log
