"""The logical replication protocol (output plugin pgoutput, version 1): decoding, and a Python data source.

``Decoder`` turns the frames of a replication connection into committed changes: a transaction's changes
are held from Begin to Commit and come out in order, with a running ``_seq``. The data source
``changeflow_pgoutput`` reads a capture (see ``frames``), as batches or streams, by many tasks. As a stream it
also follows a live connection, the option ``transport`` (see ``Transport``), through the folder ``spool``.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from importlib import import_module
from typing import Protocol

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition, SimpleDataSourceStreamReader

from changeflow.model import DELETE, INSERT, UPDATE
from changeflow.operators.ddl import ORDINAL_BITS  # changes of a transaction fit between two bytes of the log: commits are 40 bytes apart at least
from changeflow.sources.frames import SIZE, Capture, Range, Walk, frames_of, spooled

#: Day zero of times in the protocol (fixed value).
EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)
SCHEMA = (
    "_seq long, _lsn string, _commit_lsn string, _op string, _schema string, _table string, _key struct<type:string,columns:array<string>>, _emitted_at timestamp, "
    "_toasted array<string>, columns array<struct<name:string,oid:int>>, new array<string>, old array<string>"
)


def lsn_text(n: int) -> str:
    """A log position as two hexadecimal numbers."""
    return f"{n >> 32:X}/{n & 0xFFFFFFFF:X}"


def lsn_number(text: str) -> int:
    """The number of a log position; 0 for an empty or broken one."""
    try:
        high, low = text.split("/")
        return int(high, 16) << 32 | int(low, 16)
    except ValueError:
        return 0


@dataclass
class Relation:
    schema: str
    table: str
    identity: str
    columns: list[tuple[str, int, bool]]  # name, type number, part of the key

    def __post_init__(self) -> None:
        """What all changes of the relation say alike, in the same objects."""
        self.names = [c[0] for c in self.columns]
        keys = [c[0] for c in self.columns if c[2]]
        self.key = ("FULL", []) if self.identity == "f" or not keys else ("UNIQUE" if self.identity == "i" else "PRIMARY KEY", keys)
        self.typed = [(c[0], c[1]) for c in self.columns]


@dataclass
class Decoder:
    """Frames in, committed changes out. ``reply`` is true after a keepalive that asks for feedback.

    ``_seq`` is the commit's log position, shifted to make room for the change's place in the transaction, so
    that a decoder that starts at a later position goes on in the same order.
    """

    seq: int = 0
    relations: dict[int, Relation] = field(default_factory=dict)
    buffer: list[dict] = field(default_factory=list)
    received: int = 0
    committed: int = 0
    reply: bool = False
    ignored: dict[str, int] = field(default_factory=dict)

    def frame(self, data: bytes) -> list[dict]:
        """The changes that a frame (XLogData or keepalive) commits."""
        kind = data[:1]
        if kind == b"k":
            end, _, reply = struct.unpack(">qqB", data[1:18])
            self.received, self.reply = max(self.received, end), bool(reply)
            return []
        if kind != b"w":
            raise ValueError(f"unknown frame {kind!r}")
        start, _, _ = struct.unpack(">qqq", data[1:25])
        self.received = max(self.received, start)
        return self.message(data[25:], start)

    def message(self, m: bytes, lsn: int = 0) -> list[dict]:
        kind = chr(m[0])
        if kind == "R":
            self._relation(m)
        elif kind == "B":
            self.buffer = []
        elif kind in "IUD":
            self._change(kind, m, lsn)
        elif kind == "C":
            return self._commit(m)
        else:  # truncation, types, origins and messages are not replicated
            self.ignored[kind] = self.ignored.get(kind, 0) + 1
        return []

    def _relation(self, m: bytes) -> None:
        number = struct.unpack(">I", m[1:5])[0]
        schema, table, rest = m[5:].split(b"\0", 2)
        identity, count = chr(rest[0]), struct.unpack(">H", rest[1:3])[0]
        columns, at = [], 3
        for _ in range(count):
            end = rest.index(b"\0", at + 1)
            columns.append((rest[at + 1 : end].decode(), struct.unpack(">I", rest[end + 1 : end + 5])[0], bool(rest[at] & 1)))
            at = end + 9
        self.relations[number] = Relation(schema.decode(), table.decode(), identity, columns)

    @staticmethod
    def _tuple(m: bytes, at: int) -> tuple[list[str | None], list[int], int]:
        """(values, places of unchanged ones, next byte)."""
        (count,) = struct.unpack_from(">H", m, at)
        at += 2
        values, same = [], []
        for i in range(count):
            kind = m[at]
            at += 1
            if kind == 0x74:  # t: a text
                n = int.from_bytes(m[at : at + 4], "big")
                at += 4
                values.append(m[at : at + n].decode("utf-8", "replace"))
                at += n
            else:
                values.append(None)
                if kind == 0x75:  # u: unchanged
                    same.append(i)
        return values, same, at

    def _change(self, kind: str, m: bytes, lsn: int) -> None:
        number = struct.unpack(">I", m[1:5])[0]
        relation = self.relations.get(number)
        if relation is None:
            raise ValueError(f"a change of the unknown relation {number}")
        at, new, old, same = 5, None, None, []
        if kind in "UD" and m[at : at + 1] in (b"K", b"O"):
            old, _, at = self._tuple(m, at + 1)
        if kind in "IU":
            if m[at : at + 1] != b"N":
                raise ValueError("a change without its new row")
            new, same, at = self._tuple(m, at + 1)
        self.buffer.append(
            {
                "_lsn": lsn_text(lsn), "_op": {"I": INSERT, "U": UPDATE, "D": DELETE}[kind], "_schema": relation.schema, "_table": relation.table, "_key": relation.key,
                "_toasted": [relation.names[i] for i in same] if kind == "U" else [], "columns": relation.typed, "new": new, "old": old,
            }
        )

    def _commit(self, m: bytes) -> list[dict]:
        commit, _, at = struct.unpack(">qqq", m[2:26])
        self.committed = commit
        self.seq = max(self.seq, commit << ORDINAL_BITS)
        return self.stamped(commit, at)

    def stamped(self, commit: int, at: int) -> list[dict]:
        """The changes that wait, with what their commit says."""
        done, self.buffer = self.buffer, []
        position, moment = lsn_text(commit), EPOCH + timedelta(microseconds=at)
        for c in done:
            c["_seq"], c["_commit_lsn"], c["_emitted_at"] = self.seq, position, moment
            self.seq += 1
        return done

    def feedback(self, now: datetime | None = None, reply: bool = False) -> bytes:
        """The standby status frame: everything up to the last committed position is safe."""
        passed = int(((now or datetime.now(timezone.utc)) - EPOCH) / timedelta(microseconds=1))
        return b"r" + struct.pack(">qqqqB", self.committed + 1, self.committed + 1, self.committed + 1, passed, reply)


#: Changes of one Arrow batch, and ranges of a batch read, about.
BATCH, RANGES = 4096, 512
_TEXTS = pa.list_(pa.string())
_ARROW = pa.schema(
    [("_seq", pa.int64()), *[(n, pa.string()) for n in ("_lsn", "_commit_lsn", "_op", "_schema", "_table")], ("_key", pa.struct([("type", pa.string()), ("columns", _TEXTS)]))]
    + [("_emitted_at", pa.timestamp("us", "UTC")), ("_toasted", _TEXTS), ("columns", pa.list_(pa.struct([("name", pa.string()), ("oid", pa.int32())]))), ("new", _TEXTS), ("old", _TEXTS)]
)
_NAMES = ["_seq", "_lsn", "_commit_lsn", "_op", "_schema", "_table", "_key", "_emitted_at", "_toasted", "columns", "new", "old"]


def rows(changes: Iterable[dict]) -> Iterator[tuple]:
    for c in changes:
        yield tuple(c[n] for n in _NAMES)


def split_frames(data: bytes) -> Iterator[bytes]:
    """The frames of a file; a torn one at the end is left for later."""
    at = 0
    while at + 4 <= len(data):
        n = struct.unpack(">I", data[at : at + 4])[0]
        if at + 4 + n > len(data):
            return
        yield data[at + 4 : at + 4 + n]
        at += 4 + n


def decode_range(part: Range) -> Iterator[pa.RecordBatch]:
    """The changes of a part of a capture, a few thousand at a time."""
    held: list[dict] = []
    for change in _changes(part):
        held.append(change)
        if len(held) == BATCH:
            yield _arrow(held)
            held = []
    if held:
        yield _arrow(held)


def _changes(part: Range) -> Iterator[dict]:
    decoder = Decoder(seq=part.seq)
    for m in part.relations:
        decoder.message(m)
    for frame in frames_of(part):
        done = decoder.frame(frame)
        if part.commit is not None and decoder.buffer:  # within one transaction: nothing waits for its end
            decoder.committed, done = part.commit[0], decoder.stamped(*part.commit)
        if done and decoder.committed > part.starting:
            yield from done


def _arrow(changes: list[dict]) -> pa.RecordBatch:
    columns = {n: [c[n] for c in changes] for n in _NAMES}
    columns["_key"] = _alike(columns["_key"], lambda v: {"type": v[0], "columns": v[1]}, _ARROW.field("_key").type)
    columns["columns"] = _alike(columns["columns"], lambda v: [{"name": n, "oid": oid} for n, oid in v], _ARROW.field("columns").type)
    columns["_emitted_at"] = _alike(columns["_emitted_at"], lambda v: v, _ARROW.field("_emitted_at").type)
    return pa.RecordBatch.from_arrays([c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in _ARROW], schema=_ARROW)


def _alike(values: list, form: Callable, kind: pa.DataType) -> pa.Array:
    """An array of values many of which are the same object, each of which is converted once."""
    own: dict[int, tuple[int, object]] = {}
    places = [own.setdefault(id(v), (len(own), v))[0] for v in values]
    return pa.array([form(v) for _, v in own.values()], kind).take(pa.array(places, pa.int32()))


class _Batch(DataSourceReader):
    """Ranges of the capture that there is."""

    def __init__(self, options: dict) -> None:
        self.walk = _walk(options)

    def partitions(self) -> list[InputPartition]:
        # A task has its price, and ranges are streamed: their number stays below RANGES however large the capture is.
        self.walk.size = max(self.walk.size, self.walk.total() // RANGES)
        self.walk.run(self.walk.initial(), ordinal_bits=ORDINAL_BITS)
        return self.walk.ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return decode_range(partition)


def _walk(options: dict) -> Walk:
    return Walk(options.get("path") or options["spool"], lsn_number(options.get("startinglsn", options.get("startingLsn", ""))), int(options.get("rangebytes", options.get("rangeBytes", SIZE))))


class RangeStream(DataSourceStreamReader):
    """Offsets lie between committed transactions; the ranges between two of them are decoded by tasks.

    With ``transport`` and ``spool`` a live connection's transactions go into a folder that executors see, and
    are read from there; the server is told that they are safe when the batch that has them is done, and files
    that no offset needs any more go then.
    """

    def __init__(self, options: dict) -> None:
        self.most, self.walk = int(options.get("maxtransactions", options.get("maxTransactions", 0))) or None, _walk(options)
        self.options, self.live = options, bool(options.get("transport"))
        self._connection: Transport | None = None
        self.at: dict | None = None
        self.end: dict | None = None

    @property
    def transport(self) -> Transport:
        """Connected where offsets are asked for only: tasks get this reader too."""
        if self._connection is None:
            self._connection = _transport(self.options)
        return self._connection

    def initialOffset(self) -> dict:
        self.at = self.walk.initial()
        return self.at

    def latestOffset(self) -> dict:
        # After a restart it is not known where the last batch ended, so the first one takes all there is.
        start, most = self.at or self.walk.initial(), self.most if self.at is not None else None
        if self.live:
            self.end = self._last(self.end or start)
            spooled(self.transport.poll, self.walk.path, self.end["committed"])
        return self._last(start, most)

    def _last(self, start: dict, most: int | None = None) -> dict:
        return Walk(self.walk.path, self.walk.starting, self.walk.size).run(start, most, ordinal_bits=ORDINAL_BITS)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        own = Walk(self.walk.path, self.walk.starting, self.walk.size)
        own.run(start, upto=end, ordinal_bits=ORDINAL_BITS)
        self.at = end
        return own.ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return decode_range(partition)

    def commit(self, end: dict) -> None:
        if self.live:
            self.transport.feedback(Decoder(committed=end["committed"]).feedback())
            capture = Capture(self.walk.path)
            for name in capture.files():
                if name < end["file"]:
                    capture.remove(name)


def _transport(options: dict) -> Transport | None:
    if not (named := options.get("transport")):
        return None
    module, _, name = named.partition(":")
    return getattr(import_module(module), name)(options)


class Transport(Protocol):
    """A replication connection. The option ``transport`` names what makes one of the options, as ``module:name``."""

    def poll(self, after: int) -> Iterable[bytes]:
        """The frames that there are of the transactions that commit after a log position."""

    def feedback(self, status: bytes) -> None:
        """Sends a standby status, after which the server may forget what it confirms."""


class _Stream(SimpleDataSourceStreamReader):
    """A live connection without a folder to spool to: its rows pass through the driver, so ``RangeStream`` is the way for all but a trickle.

    Offsets lie between committed transactions, so that a batch never parts one.

    An offset has the place in the file, the position of the last commit, the running ``_seq`` and the
    relations known there, so that a batch reads on from it and nothing before it.
    """

    def __init__(self, options: dict) -> None:
        self.most = int(options.get("maxtransactions", options.get("maxTransactions", 1000)))
        self.starting = lsn_number(options.get("startinglsn", options.get("startingLsn", "")))
        self.path, self.transport = options.get("path"), _transport(options)

    def initialOffset(self) -> dict:
        return {"byte": 0, "committed": self.starting, "seq": 0, "relations": []}

    def _frames(self, start: dict) -> Iterator[tuple[bytes, int]]:
        """Frames from an offset on, each with the place after it."""
        if self.transport is not None:
            yield from ((frame, 0) for frame in self.transport.poll(start["committed"]))
            return
        with open(self.path, "rb") as f:
            f.seek(start["byte"])
            at = start["byte"]
            while len(head := f.read(4)) == 4:
                n = struct.unpack(">I", head)[0]
                if len(frame := f.read(n)) < n:
                    return  # torn: left for later
                at += 4 + n
                yield frame, at

    def _between(self, start: dict, end: dict | None) -> tuple[list[tuple], dict]:
        known = {r[0]: Relation(*r[1:4], [tuple(c) for c in r[4]]) for r in start["relations"]}
        decoder, out, at, n = Decoder(seq=start["seq"], relations=known, committed=start["committed"]), [], start, 0
        for frame, byte in self._frames(start):
            done = decoder.frame(frame)
            if frame[:1] == b"w" and frame[25:26] == b"C":
                if decoder.committed > self.starting:
                    out += rows(done)
                held = [[k, r.schema, r.table, r.identity, [list(c) for c in r.columns]] for k, r in decoder.relations.items()]
                at, n = {"byte": byte, "committed": decoder.committed, "seq": decoder.seq, "relations": held}, n + 1
                if n == self.most if end is None else (byte, decoder.committed) >= (end["byte"], end["committed"]):
                    break
        return out, at

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        found, end = self._between(start, None)
        return iter(found), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._between(start, end)[0])

    def commit(self, end: dict) -> None:
        """Tells the server that everything up to the offset is safe."""
        if self.transport is not None:
            self.transport.feedback(Decoder(committed=end["committed"]).feedback())


class PgOutputDataSource(DataSource):
    """``spark.dataSource.register(PgOutputDataSource)``, then ``spark.read[Stream].format("changeflow_pgoutput").option("path", ...)``."""

    @classmethod
    def name(cls) -> str:
        return "changeflow_pgoutput"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        if not self.options.get("path") and not self.options.get("spool"):
            return super().streamReader(schema)  # raises what makes Spark ask for the simple reader
        return RangeStream(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Stream(self.options)
