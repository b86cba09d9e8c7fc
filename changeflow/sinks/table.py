"""A sink that keeps the current rows of each table in Parquet, and rewrites what a batch touches only.

A table is cut into buckets by a hash of the replication key (of the whole row for FULL). A batch reads the
buckets that its keys fall on, replays its changes over their rows, writes these buckets anew in a folder of
its own, and ends with a manifest: which folder has each bucket in this version. So what a batch writes
follows the keys that it touches, a reader sees whole versions, and a batch that is lost or comes again
starts from the version before it.

Files name columns by identity, and the manifest tells their names and types, so that renaming, adding and
dropping columns and renaming tables rewrite nothing, and a name that is given up and given again is another
column. A column of a changed type is a new identity over the old one, whose values are cast as they are
read; values that the new type cannot hold raise, as the source would have refused them.
"""

from __future__ import annotations

import copy
import json
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import model
from changeflow.files import Folder, Numbered
from changeflow.operators.ddl import SchemaChange, strict_cast
from changeflow.operators.replay import changes_key, replay, replay_rows, target_key

#: Buckets of a new table, and bytes of a bucket on average from which their number doubles.
BUCKETS, BUCKET_BYTES = 8, 128 << 20


def _of(field: T.StructField) -> dict:
    return {"type": field.dataType.jsonValue(), "meta": field.metadata or {}}


def _type(kept: dict) -> T.DataType:
    return T.StructField.fromJson({"name": "c", "type": kept["type"], "nullable": True, "metadata": {}}).dataType


class Manifest:
    """A version of a table.

    ``fields`` has in order a name and the identities that its values can stand under in files, the one that
    is written first; ``types`` each identity's type; ``files`` the folder of each bucket that has rows.
    """

    def __init__(self, state: dict | None = None) -> None:
        state = state or {"buckets": 0, "next": 1, "fields": [], "types": {}, "files": {}, "bytes": {}}
        self.buckets: int = state["buckets"]
        self.next: int = state["next"]
        self.fields: list[dict] = state["fields"]
        self.types: dict[str, dict] = state["types"]
        self.files: dict[str, str] = state["files"]
        self.bytes: dict[str, int] = state["bytes"]

    def text(self) -> str:
        return json.dumps(vars(self))

    @property
    def row(self) -> T.StructType:
        return T.StructType([T.StructField(f["name"], _type(self.types[str(f["ids"][0])]), True, self.types[str(f["ids"][0])]["meta"]) for f in self.fields])

    def _place(self, name: str) -> int | None:
        return next((k for k, f in enumerate(self.fields) if f["name"] == name), None)

    def add(self, field: T.StructField) -> None:
        """A new column; one that is there under this name in another type is retyped."""
        at, number = self._place(field.name), self.next
        if at is not None and _of(field)["type"] == self.types[str(self.fields[at]["ids"][0])]["type"]:
            return
        self.next += 1
        self.types[str(number)] = _of(field)
        if at is None:
            self.fields.append({"name": field.name, "ids": [number]})
        else:
            self.fields[at]["ids"] = [number, *self.fields[at]["ids"]]

    def apply(self, c: SchemaChange) -> None:
        at = self._place(c.column)
        if c.action == "add" and at is None:
            self.add(T.StructField(c.column, T._parse_datatype_string(c.to)))
        elif c.action == "drop" and at is not None:
            del self.fields[at]
        elif c.action == "rename" and at is not None and c.to != c.column:
            there = self._place(c.to)
            if there is not None:  # rows under the new name came before the command
                self.fields[there]["ids"] += self.fields[at]["ids"]
                del self.fields[at]
            else:
                self.fields[at]["name"] = c.to
        elif c.action == "retype" and at is not None:
            self.add(T.StructField(c.column, T._parse_datatype_string(c.to)))

    def identities(self) -> list[int]:
        return [i for f in self.fields for i in f["ids"]]


class TableSink:
    """``path/TABLE`` has manifests by batch and the folders of buckets that they name; ``keep`` versions stay readable.

    ``buckets`` is the number of a new table's buckets; it doubles when they have more than ``bucket_bytes``
    on average, which rewrites the table once.
    """

    def __init__(self, path: str, keys: Mapping[str, model.ReplicationKey], keep: int = 2, on_conflict: str = "raise", buckets: int = BUCKETS, bucket_bytes: int = BUCKET_BYTES) -> None:
        self.path, self.keys, self.keep, self.on_conflict = path, dict(keys), keep, on_conflict
        self.buckets, self.bucket_bytes = buckets, bucket_bytes
        self.changes: dict[str, list[SchemaChange]] = {}
        self.moves: list[tuple[str, str]] = []

    # --- versions

    def _names(self, spark: SparkSession) -> Numbered:
        return Numbered(Folder(spark, self.path), "_names")

    def _folder(self, spark: SparkSession, table: str, before: int | None = None) -> str:
        """The folder of a table: its name, or that of the table's first name."""
        found = self._names(spark).latest(before)
        return json.loads(found[1]).get(table, table) if found else table

    def _manifests(self, spark: SparkSession, table: str, before: int | None = None) -> Numbered:
        return Numbered(Folder(spark, f"{self.path}/{self._folder(spark, table, before)}"), "_manifests")

    def versions(self, spark: SparkSession, table: str) -> list[int]:
        """Numbers of the whole versions, rising."""
        return self._manifests(spark, table).numbers()

    def manifest(self, spark: SparkSession, table: str, before: int | None = None) -> Manifest | None:
        """The latest version, or the one before a batch."""
        found = self._manifests(spark, table, before).latest(before)
        return Manifest(json.loads(found[1])) if found else None

    def read(self, spark: SparkSession, table: str, before: int | None = None) -> DataFrame | None:
        """The current rows, or those before a batch; None before the first one."""
        m = self.manifest(spark, table, before)
        return None if m is None else self._rows(spark, f"{self.path}/{self._folder(spark, table, before)}", m)

    def _rows(self, spark: SparkSession, folder: str, m: Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of some buckets, or of all."""
        wanted = sorted({d for b, d in m.files.items() if buckets is None or int(b) in set(buckets)})
        if not wanted:
            return spark.createDataFrame([], m.row)
        stored = T.StructType([T.StructField(f"c{i}", _type(m.types[str(i)])) for i in m.identities()])
        rows = spark.read.schema(stored).parquet(*[f"{folder}/{d}" for d in wanted])
        return rows.select(*[self._value(f, m) for f in m.fields])

    @staticmethod
    def _value(f: dict, m: Manifest) -> Column:
        kinds = [_type(m.types[str(i)]) for i in f["ids"]]
        values = [F.col(f"c{i}") if kind == kinds[0] else strict_cast(F.col(f"c{i}"), kinds[0], f["name"]) for i, kind in zip(f["ids"], kinds)]
        return F.coalesce(*values).alias(f["name"], metadata=m.types[str(f["ids"][0])]["meta"])

    # --- schema changes

    def alter(self, table: str, changes: Sequence[SchemaChange], commands: Sequence[str] = ()) -> None:
        """Schema changes that the next batch brings to the table; a renamed table goes by its new name from here on."""
        for c in changes:
            if c.action == "rename_table":
                own, to = table, c.to
                self.moves.append((own, to))
                for held in (self.keys, self.changes):
                    if own in held:
                        held[to] = held.pop(own)
                table = to
                continue
            self.changes.setdefault(table, []).append(c)
            if c.action == "rename" and table in self.keys:
                self.keys[table] = self.keys[table].renamed({c.column: c.to})

    def _move(self, spark: SparkSession, batch: int) -> None:
        """Brings renamed tables into the list of names, as of this batch."""
        names = self._names(spark)
        found = names.latest(batch)
        now = json.loads(found[1]) if found else {}
        for own, to in self.moves:
            folder = now.pop(own, own)
            now[own] = f"{own}.{uuid.uuid4().hex}"  # a new table of the old name gets a folder of its own
            now[to] = folder
        names.put(batch, json.dumps(now))
        self.moves = []

    # --- batches

    @staticmethod
    def _bucket(n: int, values: Sequence[Column]) -> Column:
        """The bucket by the texts of values, which other types of the same number leave as they are."""
        return F.pmod(F.xxhash64(*[c.cast("string") for c in values]), F.lit(n)).cast("int")

    def _touched(self, changes: DataFrame, key: model.ReplicationKey, n: int, names: Sequence[str]) -> tuple[list[int], bool]:
        """Buckets of the rows that the changes are about, and of those that they make, and whether any change gives a row another key.

        One row comes back, with no more numbers than there are buckets.
        """
        rows = changes.where(F.col("_op").isin(*model.DATA_OPERATIONS))
        if key.type == model.FULL:
            filled = [F.when(F.array_contains("_toasted", c), model.field("old", c)).otherwise(model.field("new", c)) for c in names]
            whole = lambda s: self._bucket(n, [model.field(s, c) for c in names])
            moved, old = F.col("_op") == model.UPDATE, F.when(F.col("old").isNotNull(), whole("old"))
            made = F.when(F.col("new").isNotNull(), F.when(F.col("old").isNotNull(), self._bucket(n, filled)).otherwise(whole("new")))
        else:
            at, moved = target_key(list(key.columns)), changes_key(list(key.columns))
            old = self._bucket(n, [at.getField(c) for c in key.columns])
            kept = [F.when(F.array_contains("_toasted", c), model.field("old", c)).otherwise(model.field("new", c)) for c in key.columns]
            made = F.when(moved, self._bucket(n, kept))
        found = rows.select(moved.alias("moved"), old.alias("old"), made.alias("made")).agg(F.collect_set("old").alias("old"), F.collect_set("made").alias("made"), F.max("moved").alias("moved")).first()
        return sorted({*found["old"], *found["made"]}), bool(found["moved"])

    def write(self, changes: DataFrame, table: str, batch: int = 0) -> None:
        spark, key = changes.sparkSession, self.keys.get(table)
        if key is None or not key.is_valid():
            raise ValueError(f"{table} has no replication key")
        if self.moves:
            self._move(spark, batch)
        folder = f"{self.path}/{self._folder(spark, table)}"
        files = Folder(spark, folder)
        manifests = Numbered(files, "_manifests")
        found = manifests.latest(batch)
        was = Manifest(json.loads(found[1])) if found else None
        m = copy.deepcopy(was) if was is not None else Manifest()
        for c in self.changes.get(table, []):
            m.apply(c)
        for f in model.row_type(changes):
            m.add(f)
        if was is not None:
            changes = model.widened(changes, m.row)
        if not m.buckets or sum(m.bytes.values()) > m.buckets * self.bucket_bytes:
            n = max(m.buckets, self.buckets)
            while sum(m.bytes.values()) > n * self.bucket_bytes:
                n *= 2
        else:
            n = m.buckets
        if was is None or not was.files:  # no bucket is there to be read
            self._write(changes, m, was, key, n, files, manifests, batch)
        else:
            changes = changes.persist()  # read for the buckets first, then for the rows
            try:
                self._write(changes, m, was, key, n, files, manifests, batch)
            finally:
                changes.unpersist()
        self.changes.pop(table, None)  # a batch that fails before here finds them again
        self._clean(files, manifests)

    def _write(self, changes: DataFrame, m: Manifest, was: Manifest | None, key: model.ReplicationKey, n: int, files: Folder, manifests: Numbered, batch: int) -> None:
        spark, folder = changes.sparkSession, files.path
        if was is None or not was.files:
            touched, moved = list(range(n)), True  # whether keys change, replay sees
        else:
            touched, moved = self._touched(changes, key, n, [f["name"] for f in m.fields])
        full = key.type == model.FULL
        if was is not None and (n != was.buckets or self._moved(was, m, key)):
            touched = list(range(n))  # buckets mean other rows now
        if touched:
            held = self._rows(spark, folder, m, touched if was is not None and n == was.buckets else None) if was is not None else None
            rows = replay_rows(changes, held) if full else replay(changes, list(key.columns), held, self.on_conflict, moved)
            self._put(rows, files, m, key, n, touched, batch)
        m.buckets = n
        manifests.put(batch, m.text())

    @staticmethod
    def _moved(was: Manifest, m: Manifest, key: model.ReplicationKey) -> bool:
        """Whether the columns that buckets go by are others than those the buckets were made by."""
        if key.type == model.FULL:
            return bool(was.files) and [f["ids"] for f in was.fields] != [f["ids"] for f in m.fields]
        known = {f["ids"][0] for f in was.fields}
        return bool(was.files) and any(f["name"] in key.columns and f["ids"][0] not in known for f in m.fields)

    def _put(self, rows: DataFrame, files: Folder, m: Manifest, key: model.ReplicationKey, n: int, touched: Sequence[int], batch: int) -> None:
        """Writes the touched buckets, and enters them."""
        columns = [f["name"] for f in m.fields] if key.type == model.FULL else key.columns
        bucket = self._bucket(n, [F.col(f"`{c}`") for c in columns])
        stored = rows.select(bucket.alias("b"), *[F.col(f"`{f['name']}`").cast(_type(m.types[str(f["ids"][0])])).alias(f"c{f['ids'][0]}") for f in m.fields])
        folder = f"v={batch}.{uuid.uuid4().hex[:8]}"
        # A bucket is a file, or several from as many tasks where it is large; small ones share a task.
        stored.hint("rebalance", F.col("b")).write.partitionBy("b").parquet(f"{files.path}/{folder}")
        sizes = files.sizes(folder)
        if len(touched) == n:
            m.files, m.bytes = {}, {}
        for b in touched:
            m.files.pop(str(b), None), m.bytes.pop(str(b), None)
        for name, size in sizes.items():
            b = name.partition("=")[2]
            m.files[b], m.bytes[b] = f"{folder}/{name}", size

    def _clean(self, files: Folder, manifests: Numbered) -> None:
        """Deletes folders that none of the kept versions names."""
        manifests.keep(self.keep)
        kept: set[str] = set()
        for k in manifests.numbers():
            kept |= {d.partition("/")[0] for d in json.loads(manifests.read(k))["files"].values()}
        for name in files.names():
            if name.startswith("v=") and name not in kept:
                files.delete(name)


def bytes_of(manifests: Sequence[Manifest]) -> int:
    """Bytes of all data that some versions name."""
    return sum(reduce(lambda a, m: a | {m.files[b]: m.bytes[b] for b in m.files}, manifests, {}).values())
