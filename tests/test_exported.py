"""Copies by an exported snapshot against a server on a real socket."""

import re
import socket
import struct
import threading

from pyspark.sql import types as T

from changeflow import model
from changeflow.cli import main
from changeflow.operators.replay import replay
from changeflow.sources import changelog, exported
from changeflow.sources.connection import ServerError, Session, _values

from test_sources_sinks import BEGIN, _commit, _frame, _relation, _text

import pytest

SNAPSHOT, LSN = "00000003-0000001B-1", "0/64"
#: Rows by page; what a text can hold that COPY escapes.
ROWS = [(i, f"name\t{i}\n\\x" if i % 7 == 0 else None if i % 5 == 0 else f"é{i}", "") for i in range(1000)]


class Server:
    """Answers sessions' statements, and notes them by session in the order of their coming."""

    def __init__(self):
        self.listener, self.said, self.lock, self.replicated = socket.create_server(("127.0.0.1", 0)), [], threading.Lock(), []
        self.port, self.sessions = self.listener.getsockname()[1], 0
        threading.Thread(target=self._accept, daemon=True).start()

    def _accept(self):
        while True:
            c, _ = self.listener.accept()
            self.sessions += 1
            threading.Thread(target=self._serve, args=(c, self.sessions), daemon=True).start()

    def _serve(self, c, number):
        def take(n):
            out = b""
            while len(out) < n:
                more = c.recv(n - len(out))
                if not more:
                    raise ConnectionError
                out += more
            return out

        send = lambda kind, body=b"": c.sendall(kind + struct.pack(">I", len(body) + 4) + body)
        try:
            body = take(struct.unpack(">I", take(4))[0] - 4)
            send(b"R", struct.pack(">I", 0)), send(b"Z", b"I")
            while True:
                kind = take(1)
                body = take(struct.unpack(">I", take(4))[0] - 4)
                if kind != b"Q":
                    continue
                sql = body[:-1].decode()
                with self.lock:
                    self.said.append((number, sql))
                if sql.startswith("START_REPLICATION"):
                    send(b"W", b"\0\0\0")
                    for m in (BEGIN, _relation(), b"U" + struct.pack(">I", 1) + b"N" + _text("3", "streamed", ...), b"D" + struct.pack(">I", 1) + b"K" + _text("4", None, None), _commit(300)):
                        send(b"d", _frame(m, 300))
                    continue
                if sql.startswith("COPY"):
                    lo, hi = re.search(r">= '\((\d+)", sql), re.search(r"< '\((\d+)", sql)
                    a, b = int(lo[1]) if lo else 0, int(hi[1]) if hi else 10**9
                    send(b"H", b"\0\0\0")
                    escape = lambda v: "\\N" if v is None else v.replace("\\", "\\\\").replace("\t", "\\t").replace("\n", "\\n")
                    text = b"".join("\t".join(escape(v if v is None else str(v)) for v in r).encode() + b"\n" for r in ROWS if a <= r[0] // 100 < b)
                    for k in range(0, len(text), 777):  # not by rows
                        send(b"d", text[k : k + 777])
                    send(b"c")
                elif "broken" in sql:
                    send(b"E", b"SERROR\0C42601\0Msyntax error\0\0")
                else:
                    for row in self._rows(sql):
                        send(b"D", struct.pack(">H", len(row)) + b"".join(struct.pack(">i", -1) if v is None else struct.pack(">i", len(v.encode())) + v.encode() for v in row))
                send(b"C", b"DONE\0"), send(b"Z", b"T")
        except (ConnectionError, OSError):
            c.close()

    @staticmethod
    def _rows(sql):
        if "pg_export_snapshot" in sql:
            return [(SNAPSHOT, LSN)]
        if "pg_attribute WHERE" in sql:
            return [("id", "23"), ("name", "25"), ("big", "25")]
        if "relpages" in sql:
            return [("10",)]
        if "pg_index" in sql:
            return [("1", "t", "t", "id", "1", "d")]
        if "information_schema" in sql:
            return [("users",)]
        return []


def _options(server):
    return {"host": "127.0.0.1", "port": str(server.port), "dbname": "d", "user": "u", "password": ""}


ROW = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("big", T.StringType())])


def test_all_tasks_take_over_one_snapshot(spark, tmp_path):
    server, log = Server(), str(tmp_path / "log")
    from pyspark.sql import functions as F

    lsn = exported.copy(spark, _options(server), "app", [], lambda t, wire: changelog.append(wire.withColumn("_group", F.lit("g")), log), workers=3, per_range=2)
    got = changelog.from_wire(changelog.read(spark, log, "g"), "users", ROW, "app")
    assert lsn == LSN and sorted(tuple(r["new"]) for r in got.collect()) == sorted(ROWS)
    assert {(r["_seq"], r["_lsn"], r["_op"], *r["_key"]["columns"]) for r in got.collect()} == {(model.BEFORE, LSN, "INSERT", "id")}
    by: dict = {}
    for number, sql in server.said:
        by.setdefault(number, []).append(sql)
    tasks = [s for s in by.values() if any(x.startswith("COPY") for x in s)]
    assert len(tasks) == 5 and all(s[1] == f"SET TRANSACTION SNAPSHOT '{SNAPSHOT}'" and s[0].startswith("BEGIN ISOLATION LEVEL REPEATABLE READ") for s in tasks)
    assert server.said[-1][1] == "COMMIT" and by[server.said[-1][0]][0].startswith("BEGIN")  # the snapshot stays open until all is copied


def test_the_stream_goes_on_from_the_snapshot(spark, tmp_path):
    server, log = Server(), str(tmp_path / "log")
    main(["replicator", "--group", "g", "--copy-and-stream", "--host", "127.0.0.1", "--port", str(server.port), "--dbname", "d", "--user", "u", "--schema", "app", "--tables", "users", "--log-dir", log, "--once"])
    assert [s for _, s in server.said if s.startswith("START")][0].startswith('START_REPLICATION SLOT "changeflow_g_slot" LOGICAL 0/64 ')
    rows = replay(changelog.from_wire(changelog.read(spark, log, "g"), "users", ROW, "app"), ["id"])
    expected = {r[0]: r for r in ROWS if r[0] != 4} | {3: (3, "streamed", "")}
    assert sorted(tuple(r) for r in rows.collect()) == sorted(expected.values())


def test_statements():
    session = Session(_options(Server()))
    assert session.query("SELECT relpages") == [("10",)] and session.query("SELECT nothing") == []
    with pytest.raises(ServerError, match="42601"):
        session.query("broken")
    assert _values(rb"a\tb" + b"\t" + rb"\N" + b"\t" + rb"\\N\b" + b"\t") == ["a\tb", None, "\\N\b", ""]
