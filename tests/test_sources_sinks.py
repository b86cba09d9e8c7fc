"""Protocol decoding, the change log, sinks, streams, schema changes and configuration."""

import json
import struct
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import config, model, pgtypes
from changeflow.cli import main
from changeflow.functions.codecs import decode, encode
from changeflow.operators import ddl
from changeflow.plans.pipeline import Pipeline
from changeflow.sinks import create
from changeflow.sinks.base import message
from changeflow.sinks.table import TableSink
from changeflow.sources import changelog, pgoutput, registry, snapshot
from changeflow.sources.jdbc import key_from_rows, publication_name
from changeflow.streaming.retry import with_retry
from changeflow.streaming.worker import Worker

# --- the replication protocol


def _text(*values):
    out = struct.pack(">H", len(values))
    for v in values:
        out += b"n" if v is None else b"u" if v is ... else b"t" + struct.pack(">I", len(v.encode())) + v.encode()
    return out


def _relation(number=1, identity=b"d", columns=((1, "id", 23), (0, "name", 25), (0, "big", 25))):
    body = b"R" + struct.pack(">I", number) + b"app\0users\0" + identity + struct.pack(">H", len(columns))
    for key, name, oid in columns:
        body += bytes([key]) + name.encode() + b"\0" + struct.pack(">Ii", oid, -1)
    return body


def _frame(message, lsn=1):
    return b"w" + struct.pack(">qqq", lsn, lsn, 0) + message


def _commit(lsn):
    return b"C\0" + struct.pack(">qqq", lsn, lsn + 8, 1_000_000)


BEGIN = b"B" + struct.pack(">qqI", 0, 0, 1)
FIRST = [BEGIN, _relation(), b"I" + struct.pack(">I", 1) + b"N" + _text("1", "ann", "x" * 10), b"I" + struct.pack(">I", 1) + b"N" + _text("2", None, "")]
SECOND = [BEGIN, b"U" + struct.pack(">I", 1) + b"N" + _text("1", "bob", ...), b"U" + struct.pack(">I", 1) + b"K" + _text("2", None, None) + b"N" + _text("3", "cy", "z"), b"T" + b"\0" * 9, b"D" + struct.pack(">I", 1) + b"K" + _text("3", None, None)]


def test_decoder():
    d = pgoutput.Decoder()
    for m in FIRST:
        assert d.frame(_frame(m)) == []
    done = d.frame(_frame(_commit(0x1_0000_00FF)))
    assert [(c["_op"], c["_seq"], c["new"]) for c in done] == [("INSERT", 0x1_0000_00FF << 14, ["1", "ann", "x" * 10]), ("INSERT", (0x1_0000_00FF << 14) + 1, ["2", None, ""])]
    assert done[0]["_commit_lsn"] == "1/FF" and done[0]["_key"] == ("PRIMARY KEY", ["id"]) and done[0]["columns"][0] == ("id", 23)
    for m in SECOND:
        d.frame(_frame(m))
    done = d.frame(_frame(_commit(0x1_0000_01FF)))
    assert [c["_op"] for c in done] == ["UPDATE", "UPDATE", "DELETE"] and done[0]["_toasted"] == ["big"] and done[0]["old"] is None
    assert done[1]["old"] == ["2", None, None] and done[2]["new"] is None and d.ignored == {"T": 1}
    assert struct.unpack(">q", d.feedback()[1:9])[0] == 0x1_0000_01FF + 1
    assert d.frame(b"k" + struct.pack(">qqB", 5, 0, 1)) == [] and d.reply
    with pytest.raises(ValueError):
        d.message(b"I" + struct.pack(">I", 9) + b"N" + _text("1"))
    assert pgoutput.lsn_number("1/FF") == 0x1_0000_00FF and pgoutput.lsn_number("") == 0 and pgoutput.lsn_text(0x1_0000_00FF) == "1/FF"


def _frames(path, *transactions):
    with open(path, "wb") as f:
        for k, t in enumerate(transactions):
            for m in [*t, _commit(100 + k)]:
                raw = _frame(m, 10 + k)
                f.write(struct.pack(">I", len(raw)) + raw)
        f.write(struct.pack(">I", 500) + b"torn")


ROW = T.StructType([T.StructField("id", T.IntegerType(), True, {"pg_oid": 23}), T.StructField("name", T.StringType(), True, {"pg_oid": 25}), T.StructField("big", T.StringType(), True, {"pg_oid": 25})])
KEY = model.ReplicationKey(model.PRIMARY_KEY, ("id",))


def test_protocol_source_to_table(spark, tmp_path):
    _frames(tmp_path / "frames", FIRST, SECOND)
    spark.dataSource.register(pgoutput.PgOutputDataSource)
    changes = spark.read.format("changeflow_pgoutput").option("path", str(tmp_path / "frames")).load()
    assert changes.count() == 5
    assert spark.read.format("changeflow_pgoutput").option("path", str(tmp_path / "frames")).option("startingLsn", "0/64").load().count() == 3
    stream = spark.readStream.format("changeflow_pgoutput").option("path", str(tmp_path / "frames")).option("maxTransactions", 1).load()
    log = str(tmp_path / "log")
    q = stream.withColumn("_group", F.lit("g")).writeStream.foreachBatch(lambda df, n: changelog.append(df, log)).option("checkpointLocation", str(tmp_path / "c1")).trigger(processingTime="0 seconds").start()
    q.processAllAvailable()
    q.stop()
    sink = TableSink(str(tmp_path / "out"), {"users": KEY})
    for _ in range(2):  # the second run finds nothing new
        Worker(log, "g", {"users": ROW}, sink, schema="app").start(spark, str(tmp_path / "c2"), once=True).awaitTermination()
    assert [tuple(r) for r in sink.read(spark, "users").collect()] == [(1, "bob", "x" * 10)]


def test_stream_offsets(tmp_path):
    """Batches read on from the last commit, know its relations, and come again alike; a start position skips what is before it."""
    _frames(tmp_path / "frames", FIRST, SECOND)
    stream = pgoutput._Stream({"path": str(tmp_path / "frames"), "maxTransactions": 1})
    start = stream.initialOffset()
    one, middle = stream.read(start)
    two, end = stream.read(middle)
    one, two = list(one), list(two)
    assert len(one) == 2 and len(two) == 3 and 0 < middle["byte"] < end["byte"] and stream.read(end)[1] == end
    assert list(stream.readBetweenOffsets(start, middle)) == one and list(stream.readBetweenOffsets(middle, end)) == two
    assert json.loads(json.dumps(middle)) == json.loads(json.dumps(stream.read(json.loads(json.dumps(start)))[1]))
    assert [r[0] for r in one + two] == sorted(r[0] for r in one + two)
    late = pgoutput._Stream({"path": str(tmp_path / "frames"), "startingLsn": "0/64"})
    assert list(late.read(late.initialOffset())[0]) == two


def test_live_transport(monkeypatch):
    """A server that keeps transactions until they are confirmed, and sends those after the position asked for."""
    import sys
    import types

    sent = []

    class Server:
        def __init__(self, options):
            self.log = [(100 + k, [*t, _commit(100 + k)]) for k, t in enumerate((FIRST, SECOND))]

        def poll(self, after):
            yield b"k" + struct.pack(">qqB", 500, 0, 1)
            for lsn, messages in self.log:
                if lsn > after:
                    yield from (_frame(m, lsn) for m in messages)

        def feedback(self, status):
            sent.append(struct.unpack(">q", status[1:9])[0])

    monkeypatch.setitem(sys.modules, "fake_server", types.SimpleNamespace(connect=Server))
    stream = pgoutput._Stream({"transport": "fake_server:connect", "maxTransactions": 1})
    one, middle = stream.read(stream.initialOffset())
    two, end = stream.read(middle)
    assert len(list(one)) == 2 and len(list(two)) == 3 and end["committed"] == 101
    assert len(list(stream.readBetweenOffsets(stream.initialOffset(), end))) == 5
    stream.commit(middle), stream.commit(end)
    assert sent == [101, 102] and stream.read(end)[1] == end


# --- codecs and the log


@pytest.mark.parametrize(
    "name,text,back",
    [("bool", "t", "true"), ("int4", "7", "7"), ("int8", "-9", "-9"), ("numeric", "1.500", None), ("text", "", ""), ("bytea", "\\xdeadbeef", "\\xdeadbeef"), ("date", "2024-02-29", "2024-02-29"), ("timestamp", "2024-01-01 00:00:00.5", "2024-01-01T00:00:00.5Z"), ("text[]", '{a,"b,c",NULL,""}', '{a,"b,c",NULL,""}'), ("int4[]", "{1,NULL,3}", "{1,NULL,3}"), ("bool[]", "{t,f}", "{true,false}"), ("uuid", "x-y", "x-y")],
)
def test_codecs(spark, name, text, back):
    oid = pgtypes.OIDS[name]
    got = spark.createDataFrame([(text,)], "v string").select(encode(decode(F.col("v"), oid), oid)).first()[0]
    assert got == back if back is not None else float(got) == float(text)


def test_type_names():
    assert pgtypes.type_name(25) == "text" and pgtypes.type_name(99999) == "unknown_99999" and pgtypes.type_oid("none") == 0
    assert len(pgtypes.OIDS) == 35 and pgtypes.kind_of(ROW["name"]) == pgtypes.TEXT


def test_log_keeps_nulls_and_empty_texts_and_new_columns(spark, tmp_path):
    rows = spark.createDataFrame([(1, "", None), (2, None, "z")], ROW)
    changelog.append(changelog.to_wire(snapshot.snapshot(rows, "users", KEY), "g"), str(tmp_path))
    wider = T.StructType([*ROW, T.StructField("later", T.LongType())])
    back = changelog.from_wire(changelog.read(spark, str(tmp_path), "g"), "users", wider).select("new.*").orderBy("id")
    assert [tuple(r) for r in back.collect()] == [(1, "", None, None), (2, None, "z", None)]
    assert changelog.read(spark, str(tmp_path), "other").count() == 0


# --- sinks


def _changes(spark):
    return snapshot.snapshot(spark.createDataFrame([(1, "ann", None), (2, "bob", "x")], ROW), "users", KEY, lsn="0/1")


def test_json_form(spark):
    got = [json.loads(r[0]) for r in _changes(spark).select(message(_changes(spark))).collect()]
    assert got[0]["NewTuple"] == {"id": 1, "name": "ann", "big": None} and "OldTuple" not in got[0]
    assert got[0]["Type"] == "INSERT" and got[0]["ReplicationKey"] == {"Type": "PRIMARY KEY", "Columns": ["id"]} and got[0]["LSN"] == "0/1" and got[0]["EmittedAt"].endswith("Z")
    binary = spark.createDataFrame([(bytearray(b"\x01\x02"),)], "b binary")
    assert json.loads(snapshot.snapshot(binary, "t").select(message(snapshot.snapshot(binary, "t"))).first()[0])["NewTuple"]["b"] == "AQI="


def test_console_and_files(spark, tmp_path, capsys):
    create("stdout").write(_changes(spark), "users")
    assert len([json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]) == 2
    sink = create("file", path=str(tmp_path), max_records_per_file=1)
    for _ in range(2):
        sink.write(_changes(spark), "users", 1)
    sink.write(_changes(spark), "users", 2)
    assert spark.read.text(str(tmp_path / "users")).count() == 4
    with pytest.raises(ValueError):
        create("carrier pigeon")


def test_webhook(spark):
    got, fail = [], [True]

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            if fail and fail.pop():
                self.send_response(500)
            else:
                got.append(json.loads(body)["NewTuple"]["id"])
                self.send_response(204)
            self.end_headers()

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    create("webhook", url=f"http://127.0.0.1:{server.server_port}/").write(_changes(spark), "users")
    server.shutdown()
    assert sorted(got) == [1, 2]


def test_jdbc(spark):
    url, options = "jdbc:derby:memory:changeflow;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    sink = create("postgres", url=url, keys={"users": KEY}, options=options)
    sink.write(_changes(spark), "users")
    row = "struct<id:int,name:string,big:string>"
    more = [(5, "INSERT", [], (1, "other", "o"), None), (6, "UPDATE", ["big"], (2, "bea", None), None), (7, "INSERT", [], (4, "new", None), None), (8, "DELETE", [], None, (1, None, None))]
    sink.write(spark.createDataFrame(more, f"_seq long, _op string, _toasted array<string>, new {row}, old {row}"), "users")
    assert sorted(tuple(r) for r in sink.read(spark, "users").collect()) == [(2, "bea", "x"), (4, "new", None)]
    with pytest.raises(ValueError):
        sink.write(_changes(spark), "nokey")


def test_table_versions(spark, tmp_path):
    sink = TableSink(str(tmp_path), {"users": KEY, "rows": model.ReplicationKey(model.FULL)})
    sink.write(_changes(spark), "users", 0)
    sink.alter("users", ddl.parse('ALTER TABLE users ADD COLUMN extra bigint'))
    for _ in range(2):
        sink.write(_changes(spark).where("new.id = 1"), "users", 1)
    assert sorted(sink.read(spark, "users").columns) == ["big", "extra", "id", "name"] or sink.read(spark, "users").count() == 2
    sink.write(_changes(spark), "users", 2)
    assert sink.versions(spark, "users") == [1, 2]
    sink.write(_changes(spark), "rows", 0)
    assert sink.read(spark, "rows").count() == 2 and sink.read(spark, "nothing") is None


def test_bad_batches_go_to_dead_letters(spark, tmp_path):
    log = str(tmp_path / "log")
    changelog.append(changelog.to_wire(_changes(spark), "g"), log)

    class Broken:
        def write(self, changes, table, batch=0):
            raise RuntimeError("no")

    Worker(log, "g", {"users": ROW}, Broken(), dead_letters=str(tmp_path / "dead")).start(spark, str(tmp_path / "c"), once=True).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "dead/users")).count() == 2


# --- schema changes


@pytest.mark.parametrize(
    "command,expected",
    [
        ("ALTER TABLE app.users ADD COLUMN email varchar(255) NOT NULL DEFAULT ''", [("add", "app.users", "email", "string")]),
        ("alter table users add if not exists n numeric(10,2), drop column \"Old Name\" cascade;", [("add", "users", "n", "decimal(10,2)"), ("drop", "users", "Old Name", "")]),
        ("ALTER TABLE users RENAME COLUMN a TO b", [("rename", "users", "a", "b")]),
        ("ALTER TABLE ONLY users RENAME TO people", [("rename_table", "users", "", "people")]),
        ("ALTER TABLE users ALTER COLUMN a TYPE timestamp with time zone USING a::timestamptz", [("retype", "users", "a", "timestamp")]),
        ("ALTER TABLE users ALTER a SET DEFAULT 3", [("default", "users", "a", "")]),
        ("ALTER TABLE users ADD tags text[]", [("add", "users", "tags", "array<string>")]),
        ("ALTER TABLE users ADD CONSTRAINT c UNIQUE (a)", [("none", "users", "", "")]),
        ("CREATE INDEX CONCURRENTLY i ON users (a)", [("none", "", "", "")]),
    ],
)
def test_parse(command, expected):
    assert [(c.action, c.table, c.column, c.to) for c in ddl.parse(command)] == expected


def test_evolve(spark):
    df = spark.createDataFrame([(1, "2")], "a int, b string")
    out = ddl.evolve(df, ddl.parse("ALTER TABLE t ADD c date, DROP COLUMN gone, RENAME a TO z, ALTER b TYPE int"))
    assert out.dtypes == [("z", "int"), ("b", "int"), ("c", "date")] and out.first()["b"] == 2


def test_poller(spark):
    from changeflow.streaming.ddl_poll import DdlPoller

    rows = [(1, "ALTER TABLE", "table", "app.users", "ALTER TABLE app.users ADD a int", "2024-01-01"), (2, "ALTER TABLE", "table column", "app.users.a", "ALTER TABLE app.users ADD a int", "2024-01-01"), (3, "ALTER TABLE", "table", "app.other", "ALTER TABLE app.other ADD a int", "2024-01-02")]
    left, published = list(rows), []
    frame = lambda: spark.createDataFrame(left, "id long, event_type string, object_type string, object_identity string, ddl_command string, created_at string")
    poller = DdlPoller(frame, lambda c: published.extend(r["new"]["ddl_command"] for r in c.collect()), lambda ids: left.__setitem__(slice(None), [r for r in left if r[0] not in ids]), ["app.users"])
    assert poller.poll() == 1 and published == [rows[0][4]] and left == [] and poller.poll() == 0
    poller.start(30)
    poller.stop()


def _wire(spark, log, changes, group="g"):
    changelog.append(changelog.to_wire(changes, group), log)


def _ddl(spark, *commands):
    rows = [(i, "ALTER TABLE", kind, identity, command, "2024-01-01") for i, (kind, identity, command) in enumerate(commands)]
    log = spark.createDataFrame(rows, "id long, event_type string, object_type string, object_identity string, ddl_command string, created_at string")
    return ddl.as_changes(log.withColumn("created_at", F.col("created_at").cast("timestamp")))


def test_schema_changes_lose_no_rows(spark, tmp_path):
    """Renamed and added columns, rows from before a change that come after it, tables that come later, and restarts."""
    log, state = str(tmp_path / "log"), str(tmp_path / "state")
    sink = TableSink(str(tmp_path / "out"), {})
    key = model.ReplicationKey(model.PRIMARY_KEY, ("id",))

    def run():
        Worker(log, "g", None, sink, schema="app").start(spark, state, once=True).awaitTermination()

    def change(op, columns, *rows, at):
        made = spark.createDataFrame(rows, columns)
        new = F.struct(*made.columns)
        return model.envelope(made, "users", op=op, new=new, old=F.lit(None).cast(made.schema.simpleString()), seq=F.lit(at), key=key, schema="app")

    _wire(spark, log, snapshot.snapshot(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, data string"), "users", key, "app"))
    run()
    _wire(spark, log, _ddl(spark, ("table column", "app.users.data", "ALTER TABLE app.users RENAME COLUMN data TO body"), ("table", "app.users", "ALTER TABLE app.users ADD COLUMN note text")))
    run()
    assert sorted(map(tuple, sink.read(spark, "users").select("id", "body", "note").collect())) == [(1, "a", None), (2, "b", None), (3, "c", None)]
    _wire(spark, log, change("UPDATE", "id int, body string, note string", (1, "A", "n"), at=10))
    _wire(spark, log, change("UPDATE", "id int, data string", (2, "B"), at=5))  # from before the change
    _wire(spark, log, snapshot.snapshot(spark.createDataFrame([(7, 1.5)], "id int, x double"), "later", key, "app"))
    run()
    out = sink.read(spark, "users")
    assert set(out.columns) == {"id", "body", "note"} and sorted(map(tuple, out.select("id", "body", "note").collect())) == [(1, "A", "n"), (2, "B", None), (3, "c", None)]
    assert [tuple(r) for r in sink.read(spark, "later").collect()] == [(7, 1.5)]
    # Rows under a new name that come before the command, and a dropped column.
    _wire(spark, log, change("UPDATE", "id int, text string, note string", (3, "C", "m"), at=20))
    run()
    _wire(spark, log, _ddl(spark, ("table column", "app.users.body", "ALTER TABLE app.users RENAME body TO text"), ("table column", "app.users.note", "ALTER TABLE app.users DROP COLUMN note")))
    run()
    assert sorted(map(tuple, sink.read(spark, "users").select("id", "text").collect())) == [(1, "A"), (2, "B"), (3, "C")] and sink.read(spark, "users").columns == ["id", "text"]


def test_schema_changes_are_lines(spark, tmp_path, capsys):
    log = str(tmp_path / "log")
    _wire(spark, log, _ddl(spark, ("table", "app.users", "ALTER TABLE app.users ADD COLUMN note text")))
    Worker(log, "g", None, create("stdout"), schema="app").start(spark, str(tmp_path / "s"), once=True).awaitTermination()
    assert '"Type":"DDL"' in capsys.readouterr().out
    Worker(log, "g", None, create("file", path=str(tmp_path / "lines")), schema="app").start(spark, str(tmp_path / "t"), once=True).awaitTermination()
    assert "ADD COLUMN note" in spark.read.text(str(tmp_path / "lines" / "users_ddl")).first()["value"]


def test_poller_keeps_rows_that_commit_late(spark):
    from changeflow.streaming.ddl_poll import DdlPoller

    columns = "id long, event_type string, object_type string, object_identity string, ddl_command string, created_at string"
    row = lambda i: (i, "ALTER TABLE", "table", "app.users", f"ALTER TABLE app.users ADD c{i} int", "2024-01-01")
    left, told = [row(2), row(5)], []

    def delete(ids):
        left.append(row(3))  # commits while the poll runs
        left[:] = [r for r in left if r[0] not in ids]

    poller = DdlPoller(lambda: spark.createDataFrame(left, columns), lambda c: told.extend(r["_seq"] for r in c.collect()), delete)
    assert poller.poll() == 2 and [r[0] for r in left] == [3]
    assert poller.poll() == 1 and sorted(told) == [2, 3, 5]


# --- ranges, keys, modes, configuration, retries


def test_ranges_and_keys():
    assert snapshot.page_ranges(0) == [] and snapshot.page_ranges(2500) == [(0, 1000), (1000, 2000), (2000, None)]
    assert snapshot.range_predicates(1500) == ["ctid >= '(0,0)'::tid AND ctid < '(1000,0)'::tid", "ctid >= '(1000,0)'::tid"]
    row = lambda i, p, u, c, k, d="d": {"index_id": i, "is_primary": p, "is_unique": u, "column_name": c, "place": k, "identity": d}
    assert key_from_rows([row(2, False, True, "u", 1), row(1, True, True, "b", 2), row(1, True, True, "a", 1)]) == model.ReplicationKey(model.PRIMARY_KEY, ("a", "b"))
    assert key_from_rows([row(3, False, True, "v", 1), row(2, False, True, "u", 1)]).columns == ("u",)
    assert key_from_rows([row(None, None, None, None, None, "f")]) == model.ReplicationKey() and key_from_rows([row(None, None, None, None, None)]) is None
    assert publication_name("a-b") == "changeflow_a_b_publication" and not model.ReplicationKey(model.UNIQUE).is_valid()
    assert snapshot.qualified(["a", "x.b"], []) == ["public.a", "x.b"] and snapshot.qualified([], ["c"]) == ["public.c"]


def test_modes(spark):
    assert registry.mode_of(False, False) == "stream" and registry.mode_of(True, False) == "copy"
    with pytest.raises(ValueError):
        registry.mode_of(True, True)
    a = _changes(spark)
    assert registry.capture("copy-and-stream", {"users": a}, {"users": a})["users"].count() == 4
    assert registry.capture("copy", {"users": a}, {})["users"].count() == 2
    failed = snapshot.write_snapshots({"a": a, "b": a}, lambda t, c: 1 / (t == "a"))
    assert list(failed) == ["b"]


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("group: file\nbatch-size: 5\ntables: [a, b]\ncopy: true\n")
    s = config.settings({"group": "flag"}, str(tmp_path / "c.yaml"), {"CHANGEFLOW_GROUP": "env", "CHANGEFLOW_BATCH_SIZE": "7"})
    assert (s.group, s.batch_size, s.tables, s.copy) == ("flag", 7, ["a", "b"], True)
    with pytest.raises(ValueError, match="webhook-url"):
        s.require(config.REQUIRED["webhook"])
    (tmp_path / "r.yaml").write_text("users: []\n")
    with pytest.raises(ValueError):
        config.load_rules(str(tmp_path / "r.yaml"))


def test_commands(spark, tmp_path, capsys):
    assert main(["version"]) == 0 and "changeflow" in capsys.readouterr().out
    src = tmp_path / "src"
    spark.createDataFrame([(1, "ann"), (2, "bo")], "id long, name string").write.parquet(str(src / "users.parquet"))
    (tmp_path / "keys.yaml").write_text("users: {type: PRIMARY KEY, columns: [id]}\n")
    (tmp_path / "rules.yaml").write_text("tables:\n  users:\n    - {type: filter, column: id, parameters: {operator: gt, value: 1}}\n")
    (tmp_path / "routes.yaml").write_text("users:\n  destination_table: people\n  column_mappings: [{source: id, destination: person_id}]\n")
    main(["replicator", "--group", "g", "--copy", "--source-dir", str(src), "--log-dir", str(tmp_path / "log"), "--keys-config", str(tmp_path / "keys.yaml")])
    main(["worker", "table", "--group", "g", "--log-dir", str(tmp_path / "log"), "--table-output-dir", str(tmp_path / "out"), "--rules-config", str(tmp_path / "rules.yaml"), "--routing-config", str(tmp_path / "routes.yaml"), "--once"])
    got = TableSink(str(tmp_path / "out"), {}).read(spark, "people")
    assert [r.asDict() for r in got.collect()] == [{"person_id": 2, "name": "bo"}]


def test_retry():
    waits, calls = [], []

    def run():
        calls.append(1)
        if len(calls) < 4:
            raise OSError("later")
        return "done"

    assert with_retry(run, 5, 1, 3, sleep=waits.append) == "done" and waits == [1, 2, 3]
    with pytest.raises(OSError):
        with_retry(lambda: (_ for _ in ()).throw(OSError("x")), 2, 1, 1, sleep=waits.append)


def test_pipeline_fans_in(spark):
    from changeflow.operators.routing import Router

    p = Pipeline(router=Router({"a": {"destination_table": "all"}, "b": {"destination_table": "all"}}))
    out = p.run_all({"a": _changes(spark), "b": _changes(spark), "c": _changes(spark)})
    assert sorted(out) == ["all", "c"] and out["all"].count() == 4
    assert p.key("a", KEY) == KEY


def test_a_large_bucket_is_written_by_many_tasks(spark, tmp_path):
    """However few buckets a table has, no task writes more of one than Spark's advised size."""
    rows = spark.range(0, 40000, 1, 8).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("name"))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    was = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sink = TableSink(str(tmp_path), {"t": KEY}, buckets=1)
        sink.write(snapshot.snapshot(rows, "t", KEY), "t", 0)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(list(tmp_path.rglob("*.parquet"))) > 1
    assert sink.read(spark, "t").exceptAll(rows).count() == 0 and sink.read(spark, "t").count() == 40000
