"""A sink that posts each change as JSON.

Changes of a key are posted in their order by one task, and keys side by side: rows are dealt by the key's
hash over so many tasks, each sorted by position. A task that fails notes how far it got, and so does every
task now and then, in the folder ``progress``; a batch that comes again has the same rows in the same tasks
and goes on from there. What an executor posted between its last note and its end is posted twice, which
receivers can tell by the header ``Idempotency-Key`` (table, position and place of the change).
"""

from __future__ import annotations

import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import model
from changeflow.sinks.base import message
from changeflow.sources.frames import Capture

#: Posts between two notes of a task.
NOTED = 100


def post(url: str, body: str, tries: int, timeout: float, key: str = "") -> None:
    """Posts until the answer is one of success, at once after a failure, so many times."""
    last: Exception | None = None
    headers = {"Content-Type": "application/json"} | ({"Idempotency-Key": key} if key else {})
    for _ in range(tries):
        try:
            request = urllib.request.Request(url, body.encode(), headers, method="POST")
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                if 200 <= answer.status < 300:
                    return
                last = RuntimeError(f"status {answer.status}")
        except OSError as e:
            last = e
    raise RuntimeError(f"the webhook failed {tries} times: {last}")


class Progress:
    """How many posts of a batch a task has behind it, in a file of its own."""

    def __init__(self, path: str | None, name: str) -> None:
        self.capture, self.name = Capture(path) if path else None, name

    def read(self) -> int:
        if self.capture is None or self.name not in self.capture.files():
            return 0
        with self.capture.open(self.name) as f:
            return int(f.read())

    def note(self, n: int) -> None:
        if self.capture is not None:
            self.capture.add(self.name, [str(n).encode()])


def key_hash(changes: DataFrame) -> Column:
    """A hash of the values of a change's key, the old ones of a DELETE or UPDATE that has them; null for whole-row identity."""
    told = F.when((F.col("_op") != model.INSERT) & F.col("old").isNotNull(), "old").otherwise("new")
    value = lambda name: F.when(told == "old", model.field("old", name).cast("string")).otherwise(model.field("new", name).cast("string"))
    of_key = [F.when(F.array_contains("_key.columns", f.name), F.concat(F.lit("="), F.coalesce(value(f.name), F.lit("")))) for f in model.row_type(changes)]
    return F.when(F.size("_key.columns") > 0, F.xxhash64(*of_key))


class WebhookSink:
    """One POST a change. ``order``: ``key`` (the changes of each key in order, tables without a key whole), ``all`` (one task) or ``none``."""

    lines = True

    def __init__(self, url: str, tries: int = 3, timeout: float = 10.0, order: str = "key", tasks: int = 8, progress: str | None = None) -> None:
        if order not in ("key", "all", "none"):
            raise ValueError(f"order is key, all or none, not {order!r}")
        self.url, self.tries, self.timeout, self.order, self.tasks, self.progress = url, tries, timeout, order, tasks, progress

    def write(self, changes: DataFrame, table: str, batch: int = 0) -> None:
        url, tries, timeout, progress = self.url, self.tries, self.timeout, self.progress
        dealt = {"key": key_hash(changes), "all": F.lit(0), "none": F.xxhash64("_seq")}[self.order]
        lines = changes.select(F.col("_seq").alias("seq"), message(changes).alias("value"), dealt.alias("dealt"))
        lines = lines.repartition(self.tasks, "dealt").sortWithinPartitions("seq", "value").select("seq", "value")

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            noted = Progress(progress, f"{table}.{batch}.{TaskContext.get().partitionId()}")
            n, done = 0, noted.read()
            try:
                for b in batches:
                    for seq, line in zip(b.column(0).to_pylist(), b.column(1)):
                        if n >= done:
                            post(url, line.as_py(), tries, timeout, f"{table}:{seq}:{batch}:{n}")
                            if (n + 1) % NOTED == 0:
                                noted.note(n + 1)
                        n += 1
            except Exception:
                noted.note(max(n, done))
                raise
            if n > done:
                noted.note(n)
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["sent"])

        lines.mapInArrow(send, "sent long").agg({"sent": "sum"}).collect()
        if progress is not None:  # notes of batches before: this one may still come again
            capture = Capture(progress)
            for name in capture.files():
                if name.startswith(f"{table}.") and name.rsplit(".", 2)[1] != str(batch):
                    capture.remove(name)
