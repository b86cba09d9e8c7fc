"""Console and JSON-lines sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.sinks.base import message


class ConsoleSink:
    """One JSON line a change on the driver's standard output, in order; for looking, it streams a partition at a time."""

    #: Schema changes are lines like others.
    lines = True

    def write(self, changes: DataFrame, table: str, batch: int = 0) -> None:
        for r in changes.select("_seq", message(changes).alias("value")).orderBy("_seq").select("value").toLocalIterator():
            print(r["value"])


class JsonLinesSink:
    """JSON lines in folders by UTC hour, so many a file. A batch that is written again replaces its own files."""

    lines = True

    def __init__(self, path: str, max_records_per_file: int = 500_000) -> None:
        self.path, self.most = path, max_records_per_file

    def write(self, changes: DataFrame, table: str, batch: int = 0) -> None:
        lines = changes.select(F.lit(batch).alias("_batch"), F.date_format(F.coalesce("_emitted_at", F.current_timestamp()), "yyyyMMddHH").alias("_hour"), message(changes).alias("value"))
        lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", self.most).partitionBy("_batch", "_hour").text(f"{self.path}/{table}")
