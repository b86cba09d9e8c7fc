"""Captures of protocol frames cut into ranges, live connections by way of a spool, and replay with state."""

import random
import struct

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from changeflow import model
from changeflow.functions import codecs
from changeflow.sinks.table import TableSink
from changeflow.sources import frames, pgoutput
from changeflow.sources.capture import to_frames, write_capture
from changeflow.streaming import stateful
from changeflow.streaming.stateful import net_changes, replay_stream

from test_sources_sinks import BEGIN, FIRST, KEY, SECOND, _commit, _frame, _relation, _text


def _insert(k, number=1):
    return b"I" + struct.pack(">I", number) + b"N" + _text(str(k), f"name {k}", "x" * (k % 50))


def _whole(paths):
    """The changes by one decoder over all frames, one after the other."""
    decoder, out = pgoutput.Decoder(), []
    for p in paths:
        for frame in pgoutput.split_frames(p.read_bytes()):
            out += pgoutput.rows(decoder.frame(frame))
    return out


def _by_ranges(path, size, starting=0, **run):
    walk = frames.Walk(str(path), starting, size)
    end = walk.run(walk.initial(), **run)
    return walk.ranges, end, [tuple(c[n] for n in pgoutput._NAMES) for r in walk.ranges for c in pgoutput._changes(r)]


@pytest.fixture
def folder(tmp_path):
    """Three files: small transactions, a large one, a relation that changes its columns, keepalives, long rows, a torn end."""
    rnd, lsn, path = random.Random(7), 1000, tmp_path / "capture"
    path.mkdir()
    wide = _relation(columns=((1, "id", 23), (0, "name", 25), (0, "big", 25), (0, "more", 25)))
    for name in "abc":
        with open(path / name, "wb") as f:
            put = lambda raw: f.write(struct.pack(">I", len(raw)) + raw)
            for t in range(12):
                changes = [_insert(rnd.randrange(1000)) for _ in range(700 if (name, t) == ("b", 5) else rnd.randrange(5))]
                if name == "b" and t >= 3 or name == "c":
                    changes = [c[:6] + struct.pack(">H", 4) + c[8:] + _text("m")[2:] for c in changes]
                head = [BEGIN] + ([_relation()] if (name, t) == ("a", 0) else [wide] if (name, t) == ("b", 3) else [])
                for m in [*head, *changes, b"T" + b"\0" * 9, *([_insert(0)[:6] + _text("5", "n", "y" * 3_000_000, "m")] if (name, t) == ("c", 4) else [])]:
                    put(_frame(m, lsn))
                    if rnd.random() < 0.1:
                        put(b"k" + struct.pack(">qqB", lsn, 0, 0))
                lsn += 100
                put(_frame(_commit(lsn), lsn))
            if name == "c":
                f.write(struct.pack(">I", 500) + b"torn")
    return path


@pytest.mark.parametrize("size", [1, 300, 5000, 1 << 16, 1 << 30])
def test_ranges_give_what_one_decoder_gives(folder, size):
    expected = _whole(sorted(folder.iterdir()))
    ranges, end, got = _by_ranges(folder, size)
    assert got == expected and len(got) > 700 and end["file"] == "c"
    if size == 5000:
        assert sum(r.commit is not None for r in ranges) > 5  # parts of the large transaction
        assert max(r.end - r.begin for r in ranges if r.file == "b") < 3 * size
    assert _by_ranges(folder, size, starting=1800)[2] == [r for r in expected if pgoutput.lsn_number(r[2]) > 1800]


def test_offsets_part_no_transaction(folder):
    """Reading on from any offset gives the rest, and the same rows again."""
    expected, got, walk = _whole(sorted(folder.iterdir())), [], frames.Walk(str(folder), 0, 2000)
    at, rounds = walk.initial(), 0
    while True:
        end = frames.Walk(str(folder), 0, 2000).run(at, most=5)
        if end == at:
            break
        for _ in range(2):
            between = frames.Walk(str(folder), 0, 2000)
            assert between.run(at, upto=end) == end
            rows = [tuple(c[n] for n in pgoutput._NAMES) for r in between.ranges for c in pgoutput._changes(r)]
        got, at, rounds = got + rows, end, rounds + 1
    assert got == expected and rounds == 8


def test_many_tasks_decode(spark, folder):
    spark.dataSource.register(pgoutput.PgOutputDataSource)
    got = spark.read.format("changeflow_pgoutput").option("path", str(folder)).option("rangeBytes", 5000).load()
    assert got.rdd.getNumPartitions() > 10
    expected = _whole(sorted(folder.iterdir()))
    assert [r["_seq"] for r in got.select("_seq").orderBy("_seq").collect()] == [r[0] for r in expected]
    assert got.select(F.sum(F.size("new"))).first()[0] == sum(len(r[10]) for r in expected)


def _indexed(folder, to):
    """The capture again, written with indexes; what is torn at its end goes."""
    for p in sorted(folder.iterdir()):
        frames.Capture(str(to)).add_frames(p.name, map(frames.framed, pgoutput.split_frames(p.read_bytes())))
    return to


@pytest.mark.parametrize("size", [1, 300, 5000, 1 << 16, 1 << 30])
def test_an_index_gives_what_frames_give(folder, tmp_path, monkeypatch, size):
    monkeypatch.setattr(frames, "STEP", 1500)
    path, expected = _indexed(folder, tmp_path / "indexed"), _whole(sorted(folder.iterdir()))
    blocks = [b for n in "abc" for b in frames.Capture(str(path)).blocks(n, frames.BITS).values()]
    assert len(blocks) >= 10 and any("cuts" in b for b in blocks)
    ranges, end, got = _by_ranges(path, size)
    assert got == expected and end == _by_ranges(folder, size)[1]
    assert _by_ranges(path, size, starting=1800)[2] == [r for r in expected if pgoutput.lsn_number(r[2]) > 1800]
    at, got = frames.Walk(str(path)).initial(), []
    while (end := frames.Walk(str(path), 0, size).run(at, most=5)) != at:  # offsets within blocks too
        between = frames.Walk(str(path), 0, size)
        assert between.run(at, upto=end) == end
        got, at = got + [tuple(c[n] for n in pgoutput._NAMES) for r in between.ranges for c in pgoutput._changes(r)], end
    assert got == expected


def test_planning_reads_no_frames(folder, tmp_path, monkeypatch):
    """The driver plans by the index alone; ranges are no more than tasks are worth."""
    path, expected = _indexed(folder, tmp_path / "indexed"), len(_whole(sorted(folder.iterdir())))
    monkeypatch.setattr(frames, "heads", lambda f, at: iter([]))
    monkeypatch.setattr(pgoutput, "RANGES", 4)
    reader = pgoutput._Batch({"path": str(path), "rangeBytes": "300"})
    parts = reader.partitions()
    assert len(parts) <= 4 + 3 and sum(b.num_rows for p in parts for b in reader.read(p)) == expected


class Server:
    """Keeps transactions until they are confirmed, tells its relations in each session, and sends a part of one that is not done."""

    log = [(100, [*FIRST, _commit(100)]), (200, [*SECOND, _commit(200)])]
    confirmed, polls = [], []

    def __init__(self, options):
        self.told = False

    def poll(self, after):
        self.polls.append(after)
        yield b"k" + struct.pack(">qqB", 500, 0, 1)
        for lsn, messages in self.log:
            if lsn > after:
                if not self.told:
                    yield _frame(_relation(), lsn)
                    self.told = True
                yield from (_frame(m, lsn) for m in messages)
        yield _frame(BEGIN, 900)

    def feedback(self, status):
        self.confirmed.append(struct.unpack(">q", status[1:9])[0])


def test_a_connection_is_spooled(tmp_path, monkeypatch):
    import sys
    import types

    monkeypatch.setitem(sys.modules, "fake_spool", types.SimpleNamespace(connect=Server))
    options = {"transport": "fake_spool:connect", "spool": str(tmp_path / "spool")}
    rows = lambda reader, a, b: sum((batch.num_rows for r in reader.partitions(a, b) for batch in reader.read(r)), 0)
    reader = pgoutput.RangeStream(options)
    start = reader.initialOffset()
    end = reader.latestOffset()
    assert end["committed"] == 200 and rows(reader, start, end) == 5 and Server.confirmed == []
    assert reader.latestOffset() == end
    # A session that starts anew goes on after what is spooled, and does not touch files that offsets name.
    Server.log.append((300, [BEGIN, b"I" + struct.pack(">I", 1) + b"N" + _text("9", None, ""), _commit(300)]))
    again = pgoutput.RangeStream(options)
    assert rows(again, start, end) == 5
    later = again.latestOffset()
    assert Server.polls[-1] == 200 and later["committed"] == 300 and rows(again, end, later) == 1
    again.commit(later)
    assert Server.confirmed == [301] and len(list((tmp_path / "spool").iterdir())) == 1
    assert again.latestOffset() == later


def test_frames_of_changes(spark, tmp_path):
    """What goes into frames comes out, old rows, left-out columns, nulls and empty texts included."""
    row = "struct<id:int,name:string,big:string>"
    told = [(0, "INSERT", [], (1, "añn", ""), None), (1, "UPDATE", ["big"], (1, None, None), None), (2, "UPDATE", [], (2, "b", "c"), (1, None, None)), (3, "DELETE", [], None, (2, None, None))]
    changes = spark.createDataFrame(told, f"_seq long, _op string, _toasted array<string>, new {row}, old {row}")
    assert write_capture(to_frames(changes, F.lit(500) + F.col("_seq").bitwiseAND(F.lit(2)) * 50, "users", ["id"], "app"), str(tmp_path / "c"), 4) > 0
    spark.dataSource.register(pgoutput.PgOutputDataSource)
    got = spark.read.format("changeflow_pgoutput").option("path", str(tmp_path / "c")).load().orderBy("_seq").collect()
    assert [(r["_op"], r["_toasted"], r["new"], r["old"]) for r in got] == [
        ("INSERT", [], ["1", "añn", ""], None), ("UPDATE", ["big"], ["1", None, None], None), ("UPDATE", [], ["2", "b", "c"], ["1", None, None]), ("DELETE", [], None, ["2", None, None]),
    ]
    assert {(r["_schema"], r["_table"], r["_key"]["type"], *r["_key"]["columns"]) for r in got} == {("app", "users", "PRIMARY KEY", "id")}
    assert write_capture(to_frames(changes.where("false"), F.lit(1), "users", ["id"]), str(tmp_path / "none")) == 0


# --- state


def _log(spark, path, *changes):
    row = "struct<id:int,name:string,big:string>"
    spark.createDataFrame(list(changes), f"_seq long, _op string, _toasted array<string>, new {row}, old {row}").select(
        "_seq", F.lit("").alias("_lsn"), F.lit("").alias("_commit_lsn"), "_op", F.lit("public").alias("_schema"), F.lit("users").alias("_table"), KEY.column().alias("_key"),
        F.lit(None).cast("timestamp").alias("_emitted_at"), "_toasted", "new", "old",
    ).write.mode("append").parquet(path)


def test_state_goes_on(spark, tmp_path):
    """Repeats, left-out columns, deleted and returned keys, and a key that changes, over three runs."""
    path, out = str(tmp_path / "log"), TableSink(str(tmp_path / "out"), {"users": KEY})

    def run():
        stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        replay_stream(stream, "users", ["id"], out, str(tmp_path / "state"), once=True).awaitTermination()
        return sorted(map(tuple, out.read(spark, "users").collect()))

    _log(spark, path, (1, "INSERT", [], (1, "a", "x"), None), (2, "INSERT", [], (2, "b", "y"), None), (3, "INSERT", [], (1, "no", "no"), None), (4, "UPDATE", [], (7, "no", ""), None))
    assert run() == [(1, "a", "x"), (2, "b", "y")]
    _log(spark, path, (1, "INSERT", [], (1, "again", ""), None), (5, "UPDATE", ["big"], (1, "A", None), None), (6, "DELETE", [], None, (2, None, None)), (7, "UPDATE", [], (3, "A3", "z"), (1, None, None)))
    assert run() == [(3, "A3", "z")]
    _log(spark, path, (6, "DELETE", [], None, (3, None, None)), (2, "INSERT", [], (2, "told twice", ""), None), (8, "INSERT", [], (1, "new", None), None), (9, "UPDATE", ["name"], (3, None, "w"), None))
    assert run() == [(1, "new", None), (3, "A3", "w")]
    _log(spark, path, (10, "UPDATE", ["big"], (4, "q", None), (3, None, None)))
    with pytest.raises(Exception, match="leaves columns out"):
        run()


def test_state_is_kept_by_buckets(spark, tmp_path):
    """What is looked up in the store are buckets, not keys, and the rows are those that a fold in order gives."""
    path, out, rows = str(tmp_path / "log"), TableSink(str(tmp_path / "out"), {"users": KEY}), {}
    random.seed(5)
    for run in range(3):
        told = []
        for seq in range(1000 * run, 1000 * run + 1000):
            k, op, kept = random.randrange(300), random.choice(("INSERT", "UPDATE", "UPDATE", "DELETE")), random.random() < 0.5
            told.append((seq, op, ["big"] if op == "UPDATE" and kept else [], None if op == "DELETE" else (k, f"n{seq}", None if kept else f"b{seq}"), (k, None, None) if op == "DELETE" else None))
            if op == "INSERT":
                rows.setdefault(k, (k, f"n{seq}", None if kept else f"b{seq}"))
            elif op == "UPDATE" and k in rows:
                rows[k] = (k, f"n{seq}", rows[k][2] if kept else f"b{seq}")
            elif op == "DELETE":
                rows.pop(k, None)
        _log(spark, path, *told)
        stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        query = replay_stream(stream, "users", ["id"], out, str(tmp_path / "state"), once=True, buckets=4)
        query.awaitTermination()
        assert sorted(map(tuple, out.read(spark, "users").collect())) == sorted(rows.values())
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 4


class _Held:
    """A bucket's state and its handle."""

    value = None

    def getValueState(self, *_):
        return self

    def registerTimer(self, _):
        pass

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def getCurrentProcessingTimeInMs(self):
        return 0


def test_a_large_bucket_is_folded_by_slices(spark, tmp_path):
    """What is made of a bucket at once does not grow with it, and its rows are those that a fold in order gives."""
    _log(spark, str(tmp_path), (1, "INSERT", [], (1, "a", "x"), None))
    out = spark.read.parquet(str(tmp_path)).select(*model.META, "new", "old").schema
    row = out["new"].dataType
    meta = [out[c] for c in model.META if c != "_op"]
    kind = T.StructType([*meta, out["_op"], *T._parse_datatype_string("_part int, _there boolean, _k0 int"), *[T.StructField(f"v{i}", f.dataType) for i, f in enumerate(row)]])
    fold, schema, rows, random_ = stateful.LastRows(row, 1, kind, out, 1000), to_arrow_schema(kind), {}, random.Random(3)
    fold.init(held := _Held())
    for run in range(2):
        told = []
        for seq in range(60_000 * run, 60_000 * run + 60_000):
            k, op, kept = random_.randrange(40_000) * 1024, random_.choice(("INSERT", "INSERT", "UPDATE", "DELETE")), random_.random() < 0.5
            new = None if op == "DELETE" else (k, f"n{seq}", None if kept else f"b{seq}")
            told.append({"_seq": seq, "_op": op, "_toasted": ["big"] if op == "UPDATE" and kept else [], "_part": 0, "_there": new is not None, "_k0": k} | {f"v{i}": new and new[i] for i in range(3)})
            if op == "INSERT":
                rows.setdefault(k, new)
            elif op == "UPDATE" and k in rows:
                rows[k] = (k, new[1], rows[k][2] if kept else new[2])
            elif op == "DELETE":
                rows.pop(k, None)
        was = {} if run == 0 else now
        random_.shuffle(told)
        packs = [pa.RecordBatch.from_pylist(told[a : a + 500], schema).serialize().to_pybytes() for a in range(0, len(told), 500)]
        net = [pa.ipc.open_stream(r["net"]).read_all() for r in fold.handleInputRows((0,), iter([Row(_b=0, changes=p) for p in packs]), held)]
        assert len(net) > 3 and max(t.num_rows for t in net) < 1.2 * stateful.SLICE
        now = dict(was)
        for c in pa.concat_tables(net).to_pylist():
            old = c["old"] and tuple(c["old"].values())
            k = (c["new"] or c["old"])["id"]
            assert was.get(k) == old
            now[k] = tuple(c["new"].values()) if c["new"] else now.pop(k) and None
        assert {k: v for k, v in now.items() if v} == rows
        now = dict(rows)


def test_packed_changes_leave_a_few_buckets_at_a_time():
    schema = pa.schema([("v", pa.int64())])
    given = pa.RecordBatch.from_pydict({"_b": pa.array([i % 1000 for i in range(5000)], pa.int32()), "v": list(range(5000))})
    sent = list(stateful.packed(schema)(iter([given])))
    assert max(b.num_rows for b in sent) <= stateful.SENT
    got = {(b, v) for batch in sent for b, text in zip(*batch.to_pydict().values()) for v in pa.ipc.read_record_batch(pa.py_buffer(text), schema).column("v").to_pylist()}
    assert got == {(i % 1000, i) for i in range(5000)}


def test_memory_of_a_replay_is_bounded(spark, tmp_path):
    """Stores share one bound, Arrow batches are small, and a batch that a sink reads again waits on disk."""
    seen = {}

    class Looks:
        def write(self, batch, table, number):
            conf = batch.sparkSession.conf
            seen.update(bounded=conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", None), bytes=conf.get("spark.sql.execution.arrow.maxBytesPerBatch"), memory=batch.storageLevel.useMemory, rows=batch.count())

    _log(spark, str(tmp_path / "log"), (1, "INSERT", [], (1, "a", "x"), None))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "log")).schema).parquet(str(tmp_path / "log"))
    replay_stream(stream, "users", ["id"], Looks(), str(tmp_path / "state"), once=True, buckets=4).awaitTermination()
    assert seen["bounded"] == "true" and int(seen["bytes"].rstrip("b")) <= 8 << 20 and not seen["memory"] and seen["rows"] == 1
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", None) is None


def test_net_changes_have_the_form_of_changes(spark, tmp_path):
    _log(spark, str(tmp_path), (1, "INSERT", [], (1, "a", "x"), None))
    held = spark.read.parquet(str(tmp_path))
    out = net_changes(spark.readStream.schema(held.schema).parquet(str(tmp_path)), ["id"])
    assert out.columns == [*model.META, "new", "old"] and out.schema["new"].dataType == held.schema["new"].dataType


# --- texts of the protocol that no table has


@pytest.mark.parametrize(
    "decode,texts,expected",
    [
        (codecs.decode_bool, ["t", "f", "TRUE", "yes", None, ""], [True, False, True, None, None, None]),
        (codecs.decode_int, ["12", "-7", " 5", "1.5", "9223372036854775807", "9223372036854775808"], [12, -7, None, None, 9223372036854775807, None]),
        (codecs.decode_float, ["1.5", "null", "abc", "-2e2", None], [1.5, None, None, -200.0, None]),
        (lambda c: codecs.decode_numeric(c, 18, 3).cast("string"), ["12345.678", "x", "-0.5"], ["12345.678", None, "-0.500"]),
        (lambda c: F.hex(codecs.decode_bytea(c)), ["\\xdead", "raw", "\\x", "\\xzz"], ["DEAD", "726177", "", None]),
        (lambda c: codecs.decode_date(c).cast("string"), ["2024-02-29", "2023-02-29", "2024-02-29 00:00:00"], ["2024-02-29", None, None]),
        (lambda c: codecs.decode_timestamp(c).cast("string"), ["2024-01-02 03:04:05", "2024-01-02 03:04:05+02", "2024-01-02T03:04:05.5Z", "2024-01-02", "12:34", "2024-01-02 03:04:05+05:30"], ["2024-01-02 03:04:05", "2024-01-02 01:04:05", "2024-01-02 03:04:05.5", None, None, "2024-01-01 21:34:05"]),
        (lambda c: codecs.decode_array(c, "int4"), ["{1,2,3}", "{}", "{a}", "{5,NULL}"], [[1, 2, 3], [], None, [5, None]]),
        (codecs.array_elements, ['{a,"b,c","q\\"t",NULL}', "{}", "no array", '{"NULL",x}'], [["a", "b,c", 'q"t', None], [], None, ["NULL", "x"]]),
    ],
)
def test_decoded_texts(spark, decode, texts, expected):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, v string").select("i", decode(F.col("v")).alias("x")).orderBy("i").collect()
    assert [r["x"] for r in rows] == expected
