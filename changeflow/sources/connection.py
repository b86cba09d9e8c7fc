"""Connections to a PostgreSQL server: sessions for statements and copies, and the ``transport`` of the protocol source.

The server sends the write-ahead log of a publication over one connection, each transaction when it has
committed. ``poll`` hands on the frames that there are and stops between transactions; a connection that
breaks is made anew from the last position that was taken over, so nothing is lost, and what was sent of an
unfinished transaction is sent again. Positions are confirmed by ``feedback`` only, which the source calls
when a batch is done; keepalives that ask for an answer repeat what was confirmed last.
"""

from __future__ import annotations

import base64
import hashlib
import hmac
import os
import re
import socket
import ssl
import struct
import time
from collections.abc import Iterator, Mapping

from changeflow.sources.pgoutput import Decoder, lsn_text
from changeflow.streaming.retry import with_retry

#: Codes of the wire protocol (fixed values): version 3.0, the request for TLS, and kinds of authentication.
VERSION, TLS = 196608, 80877103
OK, CLEARTEXT, MD5, SASL, SASL_GO_ON, SASL_DONE = 0, 3, 5, 10, 11, 12


class ServerError(RuntimeError):
    """What a server answers instead of doing it; trying again does not help."""


class Wire:
    """A connection's messages and its opening. Options: host, port, dbname, user, password, sslmode (disable or require), tries."""

    #: What the start-up message has besides user and database.
    startup: dict[str, str] = {}

    def __init__(self, options: Mapping[str, str]) -> None:
        self.get = lambda name, default="": options.get(name, options.get(name.lower(), default))
        self.host, self.port, self.dbname = self.get("host", "localhost"), int(self.get("port", "5432")), self.get("dbname")
        self.user, self.password, self.sslmode, self.tries = self.get("user"), self.get("password"), self.get("sslmode", "disable"), int(self.get("tries", "5"))
        self.socket: socket.socket | None = None
        self.held = b""

    # --- messages

    def _send(self, kind: bytes, body: bytes) -> None:
        self.socket.sendall(kind + struct.pack(">I", len(body) + 4) + body)

    def _take(self, n: int, until: float | None = None) -> bytes | None:
        """So many bytes, or nothing if none of them has come by a time."""
        while len(self.held) < n:
            self.socket.settimeout(None if until is None or self.held else max(0.001, until - time.monotonic()))
            try:
                more = self.socket.recv(1 << 16)
            except TimeoutError:
                return None
            if not more:
                raise ConnectionError("the server closed the connection")
            self.held += more
        taken, self.held = self.held[:n], self.held[n:]
        return taken

    def _message(self, until: float | None = None) -> tuple[bytes, bytes] | None:
        """(kind, body) of the next message; notices and parameters are passed over, errors raised."""
        while True:
            head = self._take(5, until)
            if head is None:
                return None
            body = self._take(struct.unpack(">I", head[1:])[0] - 4)
            if head[:1] == b"E":
                fields = {f[:1]: f[1:].decode("utf-8", "replace") for f in body.split(b"\0") if f}
                self.close()
                gone = fields.get(b"C", "").startswith(("57P", "08"))  # the server stops or the connection fails
                raise (ConnectionError if gone else ServerError)(f"{fields.get(b'C', '')} {fields.get(b'M', '')}")
            if head[:1] not in b"NSK":
                return head[:1], body

    # --- opening

    def _open(self) -> None:
        self.close()
        self.socket, self.held = socket.create_connection((self.host, self.port), timeout=30), b""
        if self.sslmode != "disable":
            self.socket.sendall(struct.pack(">II", 8, TLS))
            if self._take(1) != b"S":
                raise ServerError("the server has no TLS")
            self.socket = ssl.create_default_context().wrap_socket(self.socket, server_hostname=self.host)
        named = {"user": self.user, "database": self.dbname} | self.startup
        body = struct.pack(">I", VERSION) + b"".join(k.encode() + b"\0" + v.encode() + b"\0" for k, v in named.items()) + b"\0"
        self.socket.sendall(struct.pack(">I", len(body) + 4) + body)
        self._authenticate()
        while self._message()[0] != b"Z":
            pass

    def _authenticate(self) -> None:
        scram = None
        while True:
            kind, body = self._message()
            if kind != b"R":
                raise ServerError(f"unexpected message {kind!r}")
            (asked,) = struct.unpack(">I", body[:4])
            if asked == OK:
                return
            if asked == CLEARTEXT:
                self._send(b"p", self.password.encode() + b"\0")
            elif asked == MD5:
                inner = hashlib.md5((self.password + self.user).encode()).hexdigest()
                self._send(b"p", b"md5" + hashlib.md5(inner.encode() + body[4:8]).hexdigest().encode() + b"\0")
            elif asked == SASL and b"SCRAM-SHA-256" in body[4:].split(b"\0"):
                scram = Scram(self.password)
                first = scram.first()
                self._send(b"p", b"SCRAM-SHA-256\0" + struct.pack(">I", len(first)) + first)
            elif asked == SASL_GO_ON and scram is not None:
                self._send(b"p", scram.final(body[4:]))
            elif asked == SASL_DONE and scram is not None:
                scram.check(body[4:])
            else:
                raise ServerError(f"no way to authenticate by method {asked}")

    def close(self) -> None:
        if self.socket is not None:
            self.socket.close()
            self.socket = None


class Session(Wire):
    """Statements, one after the other, on a connection that opens with the first one."""

    def query(self, sql: str) -> list[tuple[str | None, ...]]:
        """The rows of a statement, as texts: for metadata, which is little."""
        if self.socket is None:
            with_retry(self._open, self.tries, 0.2, 10.0, lambda e: isinstance(e, OSError))
        self._send(b"Q", sql.encode() + b"\0")
        rows: list[tuple[str | None, ...]] = []
        while (found := self._message())[0] != b"Z":
            if found[0] == b"D":
                values, at = [], 2
                for _ in range(struct.unpack(">H", found[1][:2])[0]):
                    (n,) = struct.unpack_from(">i", found[1], at)
                    values.append(None if n < 0 else found[1][at + 4 : at + 4 + n].decode())
                    at += 4 + max(n, 0)
                rows.append(tuple(values))
        return rows

    def copy(self, sql: str) -> Iterator[list[str | None]]:
        """The rows of a COPY to the client in its text form, as they come."""
        self._send(b"Q", sql.encode() + b"\0")
        held = b""
        while (found := self._message())[0] != b"Z":
            if found[0] == b"d":
                *lines, held = (held + found[1]).split(b"\n")
                yield from (_values(line) for line in lines)


#: Letters behind a backslash in COPY's text form (fixed values).
_ESCAPED = {b"b": b"\b", b"f": b"\f", b"n": b"\n", b"r": b"\r", b"t": b"\t", b"v": b"\v"}
_BACKSLASH = re.compile(rb"\\(.)", re.S)


def _values(line: bytes) -> list[str | None]:
    plain = lambda v: _BACKSLASH.sub(lambda m: _ESCAPED.get(m[1], m[1]), v) if b"\\" in v else v
    return [None if v == b"\\N" else plain(v).decode("utf-8", "replace") for v in line.split(b"\t")]


class Connection(Wire):
    """The transport. Options more: slot, publication, idle (seconds without a frame after which a poll ends), mostBytes."""

    startup = {"replication": "database"}

    def __init__(self, options: Mapping[str, str]) -> None:
        super().__init__(options)
        self.slot, self.publication = self.get("slot"), self.get("publication")
        self.idle, self.most = float(self.get("idle", "1")), int(self.get("mostBytes", str(1 << 28)))
        self.at = 0
        self.status = Decoder().feedback()

    def _follow(self, after: int) -> None:
        self._open()
        publication = self.publication.replace("'", "''")
        self._send(b"Q", f"START_REPLICATION SLOT \"{self.slot}\" LOGICAL {lsn_text(after)} (proto_version '1', publication_names '{publication}')".encode() + b"\0")
        while (kind := self._message()[0]) != b"W":
            if kind == b"Z":
                raise ServerError("the server does not start replication")
        self.at = after

    def poll(self, after: int) -> Iterator[bytes]:
        """The frames of transactions that commit after a position, until the server is silent between two of them."""
        if self.socket is None or self.at != after:
            with_retry(lambda: self._follow(after), self.tries, 0.2, 10.0, lambda e: isinstance(e, OSError))
            self._status()
        inside, n = False, 0
        try:
            while True:
                found = self._message(None if inside else time.monotonic() + self.idle)
                if found is None or found[0] == b"c":
                    return
                if found[0] != b"d":
                    continue
                frame = found[1]
                if frame[:1] == b"k":
                    if frame[17]:
                        self._status()
                    continue
                n, inside = n + len(frame), frame[25:26] != b"C"
                if not inside:
                    self.at = struct.unpack_from(">q", frame, 27)[0]
                yield frame
                if not inside and n >= self.most:
                    return
        except OSError:  # what came of an unfinished transaction comes again on the next connection
            self.close()

    def _status(self) -> None:
        self._send(b"d", self.status)

    def feedback(self, status: bytes) -> None:
        self.status = status
        if self.socket is not None:
            try:
                self._status()
            except OSError:  # told again on the next connection
                self.close()


class Scram:
    """The client's side of SCRAM-SHA-256 without channel binding."""

    def __init__(self, password: str, nonce: str | None = None) -> None:
        self.password, self.nonce = password, nonce or base64.b64encode(os.urandom(18)).decode()
        self.bare, self.proof = f"n=,r={self.nonce}", b""

    def first(self) -> bytes:
        return b"n,," + self.bare.encode()

    def final(self, challenge: bytes) -> bytes:
        told = dict(part.split("=", 1) for part in challenge.decode().split(","))
        if not told["r"].startswith(self.nonce):
            raise ServerError("the server answers another login")
        salted = hashlib.pbkdf2_hmac("sha256", self.password.encode(), base64.b64decode(told["s"]), int(told["i"]))
        key = hmac.digest(salted, b"Client Key", "sha256")
        plain = f"c=biws,r={told['r']}"
        signed = ",".join([self.bare, challenge.decode(), plain]).encode()
        mine = bytes(a ^ b for a, b in zip(key, hmac.digest(hashlib.sha256(key).digest(), signed, "sha256")))
        self.proof = hmac.digest(hmac.digest(salted, b"Server Key", "sha256"), signed, "sha256")
        return f"{plain},p={base64.b64encode(mine).decode()}".encode()

    def check(self, answer: bytes) -> None:
        if not hmac.compare_digest(b"v=" + base64.b64encode(self.proof), answer):
            raise ServerError("the server does not know the password")
