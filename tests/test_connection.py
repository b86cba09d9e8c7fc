"""The replication client against a server on a real socket."""

import base64
import hashlib
import hmac
import socket
import struct
import threading

import pytest

from changeflow.cli import main, stream_options
from changeflow.config import settings
from changeflow.sources import changelog, frames
from changeflow.sources.connection import Connection, ServerError

from test_sources_sinks import BEGIN, FIRST, SECOND, _commit, _frame, _relation, _text

USER, PASSWORD = "ann", "pässword"


class Server(threading.Thread):
    """Plays one script a session: authentication, then what is sent after START_REPLICATION."""

    def __init__(self, *sessions):
        super().__init__(daemon=True)
        self.listener = socket.create_server(("127.0.0.1", 0))
        self.port, self.sessions, self.started, self.confirmed, self.errors = self.listener.getsockname()[1], sessions, [], [], []
        self.start()

    def run(self):
        for auth, script in self.sessions:
            self.c, _ = self.listener.accept()
            try:
                getattr(self, auth)()
                script(self)
            except Exception as e:  # told by the test
                self.errors.append(e)
            self.c.close()

    def _take(self, n):
        out = b""
        while len(out) < n:
            more = self.c.recv(n - len(out))
            if not more:
                raise ConnectionError
            out += more
        return out

    def message(self):
        kind = self._take(1)
        return kind, self._take(struct.unpack(">I", self._take(4))[0] - 4)

    def send(self, kind, body=b""):
        self.c.sendall(kind + struct.pack(">I", len(body) + 4) + body)

    def startup(self):
        body = self._take(struct.unpack(">I", self._take(4))[0] - 4)
        assert struct.unpack(">I", body[:4])[0] == 196608 and b"replication\0database\0" in body and b"user\0" + USER.encode() in body

    def ready(self):
        self.send(b"R", struct.pack(">I", 0))
        self.send(b"S", b"server_version\x0017\0")
        self.send(b"K", b"\0" * 8)
        self.send(b"Z", b"I")
        kind, body = self.message()
        assert kind == b"Q"
        self.started.append(body.decode())
        self.send(b"W", b"\0\0\0")

    def scram(self):
        self.startup()
        self.send(b"R", struct.pack(">I", 10) + b"SCRAM-SHA-256-PLUS\0SCRAM-SHA-256\0\0")
        _, body = self.message()
        bare = body.split(b"n,,")[1].decode()
        salt, nonce = b"salt" * 4, bare.split("r=")[1] + "more"
        first = f"r={nonce},s={base64.b64encode(salt).decode()},i=4096"
        self.send(b"R", struct.pack(">I", 11) + first.encode())
        _, body = self.message()
        plain, _, proof = body.decode().rpartition(",p=")
        salted = hashlib.pbkdf2_hmac("sha256", PASSWORD.encode(), salt, 4096)
        key, signed = hmac.digest(salted, b"Client Key", "sha256"), f"{bare},{first},{plain}".encode()
        mine = bytes(a ^ b for a, b in zip(base64.b64decode(proof), hmac.digest(hashlib.sha256(key).digest(), signed, "sha256")))
        if mine != key:
            self.send(b"E", b"SFATAL\0C28P01\0Mpassword authentication failed\0\0")
            return
        self.send(b"R", struct.pack(">I", 12) + b"v=" + base64.b64encode(hmac.digest(hmac.digest(salted, b"Server Key", "sha256"), signed, "sha256")))
        self.ready()

    def md5(self):
        self.startup()
        self.send(b"R", struct.pack(">I", 5) + b"abcd")
        inner = hashlib.md5((PASSWORD + USER).encode()).hexdigest()
        assert self.message()[1] == b"md5" + hashlib.md5(inner.encode() + b"abcd").hexdigest().encode() + b"\0"
        self.ready()

    def cleartext(self):
        self.startup()
        self.send(b"R", struct.pack(">I", 3))
        assert self.message()[1] == PASSWORD.encode() + b"\0"
        self.ready()

    def copy(self, *messages, lsn=1):
        for m in messages:
            self.send(b"d", _frame(m, lsn))

    def status(self):
        kind, body = self.message()
        assert kind == b"d" and body[:1] == b"r"
        self.confirmed.append(struct.unpack(">q", body[1:9])[0])


def _options(server, **more):
    return {"host": "127.0.0.1", "port": str(server.port), "dbname": "d", "user": USER, "password": PASSWORD, "slot": "s", "publication": "it's", "idle": "0.3"} | more


def test_a_connection_that_breaks(tmp_path):
    def first(s):
        s.status()
        s.send(b"d", b"k" + struct.pack(">qqB", 500, 0, 1))
        s.status()
        s.copy(*FIRST, _commit(100))
        s.copy(*SECOND[:2])  # and the connection breaks within a transaction

    def second(s):
        s.status()
        s.copy(BEGIN, _relation(), *FIRST[2:], _commit(100))  # sent again, with what a new session tells
        s.copy(*SECOND, _commit(200))
        s.status()

    server = Server(("scram", first), ("md5", second))
    connection, path = Connection(_options(server)), str(tmp_path / "spool")
    assert frames.spooled(connection.poll, path, 0) == 100
    assert frames.spooled(connection.poll, path, 100) == 200
    connection.feedback(b"r" + struct.pack(">qqqqB", 201, 201, 201, 0, 0))
    server.join(5)
    assert server.errors == [] and server.confirmed[-1] == 201 and [t.split(" (")[0] for t in server.started] == ['START_REPLICATION SLOT "s" LOGICAL 0/0', 'START_REPLICATION SLOT "s" LOGICAL 0/64']
    assert "publication_names 'it''s'" in server.started[0]
    walk = frames.Walk(path)
    assert walk.run(walk.initial())["committed"] == 200
    from changeflow.sources import pgoutput

    assert sum(batch.num_rows for r in walk.ranges for batch in pgoutput.decode_range(r)) == 5
    connection.close()


def test_idle_servers_and_wrong_passwords():
    server = Server(("cleartext", lambda s: (s.status(), s.copy(*FIRST, _commit(100)), s.message())), ("scram", lambda s: None))
    connection = Connection(_options(server))
    assert len(list(connection.poll(0))) == len(FIRST) + 1 and list(connection.poll(100)) == []
    connection.close()
    with pytest.raises(ServerError, match="28P01"):
        list(Connection(_options(server, password="no")).poll(0))


def test_the_command_follows_a_server(spark, tmp_path):
    """``replicator --host`` takes what a server sends into the log, and a second run goes on where the first one ended.

    Spark tells a source that a batch is done when the next one begins, so the second run confirms the first one's.
    """

    def first(s):
        s.status()
        s.copy(*FIRST, _commit(100))
        with pytest.raises(ConnectionError):
            s.message()

    def second(s):
        s.status()
        s.copy(BEGIN, _relation(), b"I" + struct.pack(">I", 1) + b"N" + _text("9", "z", ""), _commit(300))
        s.status()

    server, log = Server(("scram", first), ("scram", second)), str(tmp_path / "log")
    flags = ["replicator", "--group", "g-1", "--host", "127.0.0.1", "--port", str(server.port), "--dbname", "d", "--user", USER, "--password", PASSWORD, "--log-dir", log, "--once"]
    for n in (2, 3):
        main(flags)
        got = changelog.read(spark, log, "g-1")
        assert got.count() == n and {r["_table"] for r in got.select("_table").collect()} == {"users"}
    server.join(5)
    assert [t.split(" (")[0] for t in server.started] == ['START_REPLICATION SLOT "changeflow_g_1_slot" LOGICAL 0/0', 'START_REPLICATION SLOT "changeflow_g_1_slot" LOGICAL 0/64']
    assert server.errors == [] and server.confirmed[-1] == 101


def test_options_of_the_stream():
    given = {"group": "g", "log_dir": "/l", "source_dir": "/s", "starting_lsn": "0/64"}
    assert stream_options(settings(given, env={})) == {"path": "/s/frames", "startingLsn": "0/64"}
    named = stream_options(settings(given | {"host": "h", "port": 1, "spool_dir": "/x"}, env={}))
    assert (named["spool"], named["port"], named["startingLsn"], named["transport"]) == ("/x", "1", "0/64", "changeflow.sources.connection:Connection")
    with pytest.raises(ValueError):
        main(["replicator", "--group", "g", "--log-dir", "/l"])


def test_a_poller_that_keeps_failing_is_told():
    from changeflow.streaming.ddl_poll import DdlPoller

    def read():
        raise OSError("gone")

    poller = DdlPoller(read, print, print)
    thread = poller.start(0.01)
    for _ in range(200):
        if poller.failures >= 3:
            break
        thread.join(0.05)
    poller.check(10**9)
    with pytest.raises(OSError):
        poller.check(3)
    poller._stop.set()
