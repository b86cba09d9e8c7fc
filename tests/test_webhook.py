"""Posts by key in order, side by side, and none twice after a failure."""

import json
import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from changeflow import model
from changeflow.sinks import create


@pytest.fixture
def server():
    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            with self.server.lock:
                refuse = self.server.refuse(body)
                if not refuse:
                    self.server.got.append((body["NewTuple"]["id"], body["NewTuple"]["n"], self.headers["Idempotency-Key"], threading.get_ident()))
            self.send_response(500 if refuse else 204)
            self.end_headers()

        def log_message(self, *a):
            pass

    made = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    made.got, made.lock, made.refuse = [], threading.Lock(), lambda body: False
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield made
    made.shutdown()


def _changes(spark, keys=40, each=12, key=("id",)):
    rows = spark.range(keys * each).selectExpr(f"id % {keys} AS id", f"cast(id div {keys} as int) AS n").select("id", "n", F.struct("id", "n").alias("new"), (F.col("n") * 1000 + F.col("id")).alias("at"))
    kind = model.ReplicationKey(model.PRIMARY_KEY, key) if key else model.ReplicationKey()
    row = rows.select("id", "n").schema
    return model.envelope(rows, "t", op="INSERT", new=F.col("new"), old=F.lit(None).cast(row), seq=F.col("at"), key=kind, row=row).orderBy(F.rand(3))


def _sink(server, **more):
    return create("webhook", url=f"http://127.0.0.1:{server.server_port}/", tries=2, **more)


def _in_order(got):
    last = {}
    for k, n, *_ in got:
        assert n == last.get(k, -1) + 1
        last[k] = n
    return len(last)


def test_each_key_in_order(spark, server):
    _sink(server).write(_changes(spark), "t")
    assert len(server.got) == 480 and _in_order(server.got) == 40 and len({k for _, _, k, _ in server.got}) == 480
    first = [k for k, *_ in server.got[:40]]
    assert len({k for k in first}) < 40 or first != sorted(first)  # several tasks


@pytest.mark.parametrize("key,order", [(("id",), "all"), ((), "key")])
def test_one_order_for_all(spark, server, key, order):
    _sink(server, order=order).write(_changes(spark, 10, 3, key), "t")
    assert [(n, k) for k, n, *_ in server.got] == sorted((n, k) for k, n, *_ in server.got) and len(server.got) == 30


def test_nothing_twice_after_a_failure(spark, server, tmp_path):
    sink = _sink(server, progress=str(tmp_path / "posted"), tasks=3)
    server.refuse = lambda body: body["NewTuple"]["n"] == 7
    for _ in range(2):
        with pytest.raises(Exception, match="webhook failed"):
            sink.write(_changes(spark), "t", 5)
    assert 0 < len(server.got) < 480
    server.refuse = lambda body: False
    for _ in range(2):  # the second time there is nothing left to post
        sink.write(_changes(spark), "t", 5)
    assert set(Counter((k, n) for k, n, *_ in server.got).values()) == {1} and len(server.got) == 480 and _in_order(server.got) == 40
    sink.write(_changes(spark), "t", 6)
    assert len(server.got) == 960 and all(p.name.startswith("t.6.") for p in (tmp_path / "posted").iterdir())


def test_orders():
    with pytest.raises(ValueError):
        create("webhook", url="x", order="some")
