"""Replay of one table as a stream with state: the last row of each key lives in the state store.

Each batch's changes of a key are folded in order over the row that the store holds, and what they come to is
one change a key: an INSERT, UPDATE or DELETE of a whole row. So a sink gets one change for each key however often it
changed, without reading its target. The store is RocksDB's, so rows need not fit in memory; it is part of the
checkpoint, and a query that stops goes on where it was.

A call into Python and each look at the store cost some milliseconds, so keys go by buckets, a hash of the key:
the store has for each bucket its rows as one Arrow batch, and a call folds all changes of a bucket. Changes are
packed by bucket before the shuffle, so that no single value of a row passes between the processes. A batch reads
and writes the buckets that its keys fall on; ``buckets`` is fixed when a checkpoint begins, about one for each
fifty thousand keys that the table will have. Checkpoints of one key an entry, the former layout, are not read.

A deleted key leaves its position behind, so that changes that a log tells twice are known as such; a timer
forgets it after ``forget_ms``.

Defined results: changes at or below the last position of their key are repeats and do nothing; an INSERT of
a key that is there and an UPDATE or DELETE of one that is not do nothing; columns that an UPDATE leaves out
stay. An UPDATE that gives its row another key is a DELETE and an INSERT; left-out columns of such a row lie
under the other key, so it raises (``replay`` folds linked keys, and is the way for tables that have them).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import Row

from changeflow import model
from changeflow.operators.replay import changes_key, target_key
from changeflow.sinks.base import Sink

#: Milliseconds for which the position of a deleted key is remembered.
FORGET_MS = 24 * 3600 * 1000
#: Buckets of a table's keys, and changes and bytes that a task holds while it packs them.
BUCKETS, PACK, PACK_BYTES = 1024, 1 << 17, 64 << 20
#: Rows of a bucket, held ones and changes, that are folded at once, about; and packed buckets that leave a task at once.
SLICE, SENT = 1 << 14, 64
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_BOUNDED = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _hashable(v: object) -> object:
    if isinstance(v, list):
        return tuple(map(_hashable, v))
    if isinstance(v, dict):
        return tuple((k, _hashable(x)) for k, x in v.items())
    return ("NaN",) if v != v else v


def _keys(t: pa.Table, names: Sequence[str]) -> list:
    """Keys of rows as values that a dictionary takes."""
    columns = []
    for n in names:
        values = t.column(n).to_pylist()
        kind = t.schema.field(n).type
        columns.append([_hashable(v) for v in values] if pa.types.is_nested(kind) or pa.types.is_floating(kind) else values)
    return columns[0] if len(columns) == 1 else list(zip(*columns))


def _bytes(*tables: pa.Table) -> bytes:
    """Tables of one schema in Arrow's stream format."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, tables[0].schema) as w:
        for t in tables:
            w.write_table(t)
    return sink.getvalue().to_pybytes()


def _sliced(t: pa.Table, keys: Sequence[str], n: int) -> Iterator[pa.Table]:
    """A table in ``n`` parts by a hash of the key, each in the order of the table."""
    if n == 1:
        yield t
        return
    own = np.concatenate([np.empty(0, "int64"), *[np.array([hash((k,)) % n for k in _keys(t.slice(a, SLICE), keys)], "int64") for a in range(0, t.num_rows, SLICE)]])
    order = np.argsort(own, kind="stable")
    for places in np.split(order, np.searchsorted(own[order], np.arange(1, n))):
        yield t.take(pa.array(places, pa.int64()))


def packed(schema: pa.Schema):
    """Puts changes into a row (_b, changes) for each bucket and each few that a task holds at once; ``schema`` is that of the changes."""

    def put(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        held.clear()
        t = t.take(pc.sort_indices(t.column("_b"))).combine_chunks()
        own = t.column("_b").to_numpy()
        cuts = np.flatnonzero(np.diff(own)) + 1
        body = t.select(schema.names).cast(schema)
        for some in np.array_split(np.stack([np.r_[0, cuts], np.r_[cuts, len(own)]], axis=1), len(cuts) // SENT + 1):
            texts = [b"".join(x.serialize().to_pybytes() for x in body.slice(a, b - a).combine_chunks().to_batches()) for a, b in some]
            yield pa.RecordBatch.from_arrays([pa.array(own[some[:, 0]], pa.int32()), pa.array(texts, pa.binary())], names=["_b", "changes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            del batch
            if rows >= PACK or size >= PACK_BYTES:
                yield from put(held)
                rows = size = 0
        if held:
            yield from put(held)
        pa.default_memory_pool().release_unused()

    return run


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in batch.column("net"):
            yield from pa.ipc.open_stream(text.as_buffer())


class LastRows(StatefulProcessor):
    """State of a bucket: its keys (_k0, ...), whether each is alive, its position, when a dead one may go, and its row by column names.

    ``changes`` is the type of the changes: META without what is told otherwise, ``_part``, ``_there`` (whether
    there is a new row), keys and the new row's columns as v0, ...; ``out`` is the type of net changes.
    """

    def __init__(self, row: T.StructType, keys: int, changes: T.StructType, out: T.StructType, forget_ms: int) -> None:
        self.row, self.changes, self.out, self.forget_ms = row, changes, out, forget_ms
        self.keys = [f"_k{i}" for i in range(keys)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rows", T.StructType([T.StructField("held", T.BinaryType())]))
        self.given, self.told = to_arrow_schema(self.changes), to_arrow_schema(self.out)
        self.values = [f"v{i}" for i in range(len(self.row))]
        typed = [*[self.given.field(n) for n in self.keys], *[pa.field(f"={n}", self.given.field(v).type) for n, v in zip(self.row.names, self.values)]]
        self.kept = pa.schema([("alive", pa.bool_()), ("seq", pa.int64()), ("until", pa.int64()), *typed])

    def _held(self) -> pa.Table:
        """The bucket's rows; columns that it was kept without are null."""
        found = self.state.get()
        if found is None:
            return self.kept.empty_table()
        t = pa.ipc.open_stream(bytes(found[0])).read_all()
        return pa.table([t.column(f.name).cast(f.type) if f.name in t.schema.names else pa.nulls(t.num_rows, f.type) for f in self.kept], schema=self.kept)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        news = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(bytes(r["changes"])), self.given) for r in rows])
        news = news.take(pc.sort_indices(news, sort_keys=[("_seq", "ascending"), ("_part", "ascending")])).combine_chunks()
        held, now_ms = self._held(), timerValues.getCurrentProcessingTimeInMs()
        # Keys are folded a slice after the other, so that what is made of them as Python's values does not grow with the bucket.
        slices = -(-(held.num_rows + news.num_rows) // SLICE)
        parts: list[pa.Table] = []
        touched = False
        for own, given in zip(_sliced(held, self.keys, slices), _sliced(news, self.keys, slices)):
            kept, net = self._fold(own, given, now_ms)
            parts += kept or [own]
            touched |= kept is not None
            if net is not None:
                yield Row(net=_bytes(net))
        if touched:
            self._keep(parts)

    def _fold(self, held: pa.Table, news: pa.Table, now_ms: int) -> tuple[list[pa.Table] | None, pa.Table | None]:
        """The rows to hold after changes in their order, None if no change is new; and what they come to, if anything."""
        n = held.num_rows
        at = {k: j for j, k in enumerate(_keys(held, self.keys))}
        alive, reached = held.column("alive").to_pylist(), held.column("seq").to_pylist()
        # A row is where its values are: a place in the held rows with the new ones behind them, or a place for each column.
        touched: dict = {}  # key: [row before the batch, row now, place of the last change]
        given = zip(_keys(news, self.keys), news.column("_seq").to_pylist(), news.column("_op").to_pylist(), news.column("_toasted").to_pylist(), news.column("_there").to_pylist())
        for i, (k, seq, op, out, there) in enumerate(given):
            j = at.get(k)
            if j is not None and seq <= reached[j]:
                continue
            t = touched.get(k)
            if t is None:
                was = j if j is not None and alive[j] else None
                t = touched[k] = [was, was, i]
            t[2], now = i, t[1]
            if op == model.INSERT:
                if now is None and there:
                    t[1] = n + i
            elif op == model.UPDATE:
                if now is not None:
                    if out:
                        left = set(out)
                        t[1] = tuple((now if isinstance(now, int) else now[c]) if f.name in left else n + i for c, f in enumerate(self.row))
                    else:
                        t[1] = n + i
            else:
                t[1] = None
        if not touched:
            return None, None
        rows_of = pa.table([pa.concat_arrays([*held.column(f"={f.name}").chunks, *news.column(v).chunks]) for f, v in zip(self.row, self.values)], names=self.values)
        last = np.array([t[2] for t in touched.values()])
        before, after = [t[0] for t in touched.values()], [t[1] for t in touched.values()]
        gone = np.array([a is None for a in after])
        # The bucket: what was not touched, and the touched keys.
        stay = np.setdiff1d(np.arange(n), np.array([at[k] for k in touched if k in at], dtype="int64"))
        stay = held.take(stay).filter(pc.fill_null(pc.greater(pc.take(held.column("until"), pa.array(stay)), now_ms), True))
        seqs = news.column("_seq").take(last)
        until = pa.array(np.where(gone, now_ms + self.forget_ms, 0), pa.int64(), mask=~gone)
        made = pa.table([pa.array(~gone), seqs, until, *[news.column(k).take(last) for k in self.keys], *self._side(rows_of, after)], schema=self.kept)
        # What it comes to.
        some = np.array([not (a is None and b is None) for a, b in zip(after, before)])
        if not some.any():
            return [stay, made], None
        ops = [model.DELETE if a is None else model.UPDATE if b is not None else model.INSERT for a, b, s in zip(after, before, some) if s]
        place = last[some]
        side = lambda which: self._struct(rows_of, [x for x, s in zip(which, some) if s])
        columns = {"_seq": news.column("_seq").take(place), "_op": pa.array(ops, pa.string()), "_toasted": pa.array([[]] * len(ops), pa.list_(pa.string())), "new": side(after), "old": side(before)}
        net = [columns[f.name] if f.name in columns else news.column(f.name).take(place) for f in self.told]
        net = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in net]
        return [stay, made], pa.table([c.cast(f.type) for c, f in zip(net, self.told)], schema=self.told)

    def _side(self, rows_of: pa.Table, which: list) -> list:
        """The columns of rows by their places; null where there is no row."""
        none = np.array([x is None for x in which], dtype=bool)
        whole = np.array([x if isinstance(x, int) else 0 for x in which], dtype="int64")
        parted = [(k, x) for k, x in enumerate(which) if isinstance(x, tuple)]
        out = []
        for c, name in enumerate(self.values):
            place = whole
            if parted:
                place = whole.copy()
                for k, x in parted:
                    place[k] = x[c]
            out.append(rows_of.column(name).take(pa.array(place, mask=none)).combine_chunks())
        return out

    def _struct(self, rows_of: pa.Table, which: list) -> pa.StructArray:
        kind = self.told.field("new").type
        columns = [c.cast(kind.field(k).type) for k, c in enumerate(self._side(rows_of, which))]
        return pa.StructArray.from_arrays(columns, fields=[kind.field(k) for k in range(kind.num_fields)], mask=pa.array([x is None for x in which], pa.bool_()))

    def _keep(self, parts: list[pa.Table]) -> None:
        """Puts a bucket's rows; a timer comes when the first of its dead keys may go."""
        if any(t.num_rows for t in parts):
            self.state.update((_bytes(*parts),))
            first = pc.min(pa.chunked_array([c for t in parts for c in t.column("until").chunks], pa.int64())).as_py()
            if first is not None:
                self.handle.registerTimer(first)
        else:
            self.state.clear()

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held()
        self._keep([held.filter(pc.fill_null(pc.greater(held.column("until"), timerValues.getCurrentProcessingTimeInMs()), True))])
        return iter(())

    def close(self) -> None:
        pass


def net_changes(changes: DataFrame, keys: Sequence[str], forget_ms: int = FORGET_MS, buckets: int = BUCKETS) -> DataFrame:
    """What a stream of typed changes of one table comes to, a change a key and batch."""
    keys, row = list(keys), model.row_type(changes)
    data = changes.where(F.col("_op").isin(*model.DATA_OPERATIONS))
    moved = changes_key(keys)
    left_out = F.raise_error(F.lit("an UPDATE of a key leaves columns out; replay the table by components instead"))
    whole = F.when(F.size("_toasted") > 0, left_out.cast(row)).otherwise(F.col("new"))
    own = lambda op, part, new, key: F.struct(op.alias("_op"), F.lit(part).alias("_part"), new.alias("new"), key.alias("_k"))
    none = F.lit(None).cast(row)
    at = F.struct(*[model.field("new", k).alias(k) for k in keys])
    parts = F.when(moved, F.array(own(F.lit(model.DELETE), 0, none, target_key(keys)), own(F.lit(model.INSERT), 1, whole, at))).otherwise(F.array(own(F.col("_op"), 0, F.col("new"), target_key(keys))))
    meta = [c for c in model.META if c != "_op"]
    told = data.select(*meta, F.explode(parts).alias("p")).select(*meta, "p._op", "p._part", F.col("p.new").isNotNull().alias("_there"), F.col("p.new").alias("new"), F.col("p._k").alias("_k"))
    told = told.select(*meta, "_op", "_part", "_there", *[F.col("_k").getField(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[model.field("new", f.name).alias(f"v{i}") for i, f in enumerate(row)])
    out = T.StructType([changes.schema[c] for c in model.META] + [T.StructField("new", row), T.StructField("old", row)])
    hashed = told.select("*", F.pmod(F.xxhash64(*[f"_k{i}" for i in range(len(keys))]), F.lit(buckets)).cast("int").alias("_b"))
    rows = hashed.mapInArrow(packed(to_arrow_schema(told.schema)), "_b int, changes binary")
    return rows.groupBy("_b").transformWithState(LastRows(row, len(keys), told.schema, out, forget_ms), "net binary", "Update", "ProcessingTime").mapInArrow(unpacked, out)


def replay_stream(changes: DataFrame, table: str, keys: Sequence[str], sink: Sink, checkpoint: str, once: bool = False, flush_ms: int = 500, buckets: int = BUCKETS) -> StreamingQuery:
    """Delivers the net changes of a streaming table; a batch that comes again after a failure has its number."""

    def deliver(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)  # a sink reads it more than once, and the state should be folded once
        try:
            sink.write(batch, table, number)
        finally:
            batch.unpersist()

    spark: SparkSession = changes.sparkSession
    # Timers ask for batches without data for ever, so a run over what there is does without; they fire with the next data.
    # Rows of packed changes and of net changes are long, so that few of them go between processes at once.
    settings = {_PROVIDER: _ROCKS, _RECORDS: "2000", _BYTES: str(8 << 20)} | ({_NO_DATA: "false"} if once else {})
    if spark.conf.get(_BOUNDED, None) is None:  # the stores of an executor's partitions share one bound, else each has memory of its own
        settings[_BOUNDED] = "true"
    was = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:  # a query keeps the settings that it starts with
        writer = net_changes(changes, keys, buckets=buckets).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(deliver)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{flush_ms} milliseconds")).start()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
