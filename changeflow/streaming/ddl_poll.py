"""Polling the schema-change log of a source."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.operators import ddl

#: Seconds between polls (default of the option).
INTERVAL = 1.0
#: Rows of the log that a poll takes.
MOST = 1000


class DdlPoller:
    """Reads the log, publishes what is tracked and not repeated, in order, then has the processed rows deleted.

    ``read`` gives the log as a DataFrame, ``publish`` takes DDL changes, ``delete`` takes the ids that were
    read: others may commit later with lower ids, and stay for the next poll. A poll takes ``most`` rows, the
    oldest first. A poll that fails in the background is told by ``error`` and ``stop``, and tried again.
    """

    def __init__(self, read: Callable[[], DataFrame], publish: Callable[[DataFrame], None], delete: Callable[[list[int]], None], tables: Sequence[str] = (), most: int = MOST) -> None:
        self.read, self.publish, self.delete, self.tables, self.most = read, publish, delete, tuple(tables), most
        self.error: Exception | None = None
        self.failures = 0
        self._stop = threading.Event()

    def poll(self) -> int:
        """One poll; the number of published changes."""
        log = self.read()
        ids = [r["id"] for r in log.select("id").orderBy("id").limit(self.most).collect()]
        if not ids:
            return 0
        changes = ddl.as_changes(ddl.deduplicated(ddl.tracked(log.where(F.col("id").isin(ids)), self.tables)))
        n = changes.count()
        if n:
            self.publish(changes)
        self.delete(ids)
        return n

    def start(self, interval: float = INTERVAL) -> threading.Thread:
        """Polls in the background until ``stop``."""

        def run() -> None:
            while not self._stop.wait(interval):
                try:
                    self.poll()
                    self.error, self.failures = None, 0
                except Exception as e:  # nothing was deleted, so the next poll reads the rows again
                    self.error, self.failures = e, self.failures + 1

        thread = threading.Thread(target=run, daemon=True)
        thread.start()
        return thread

    def check(self, most: int = 10) -> None:
        """Raises what made so many polls in a row fail."""
        if self.error is not None and self.failures >= most:
            raise self.error

    def stop(self) -> None:
        """No further poll; one more goes over what is left."""
        self._stop.set()
        self.poll()
