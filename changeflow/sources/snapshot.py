"""Snapshots: whole tables as INSERT changes, in ranges that are read in parallel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow import model

#: Pages in one range of a table copy, and connections that a copy opens at most (defaults of the options).
PAGES_PER_RANGE, MOST_CONNECTIONS = 1000, 20


def page_ranges(pages: int, per_range: int = PAGES_PER_RANGE) -> list[tuple[int, int | None]]:
    """(first, one past the last) page of each range, the last one open; no pages, no range."""
    starts = list(range(0, pages, per_range))
    return [(a, a + per_range if a + per_range < pages else None) for a in starts]


def range_predicates(pages: int, per_range: int = PAGES_PER_RANGE) -> list[str]:
    """A WHERE condition on the physical row address for each range, one task each for ``spark.read.jdbc(predicates=...)``."""
    return [f"ctid >= '({a},0)'::tid" + ("" if b is None else f" AND ctid < '({b},0)'::tid") for a, b in page_ranges(pages, per_range)]


def snapshot(rows: DataFrame, table: str, key: model.ReplicationKey | None = None, schema: str = "public", lsn: str = "") -> DataFrame:
    """Every row as an INSERT before all streamed changes. Rows of a copy bear no log position; ``lsn`` stamps the snapshot's."""
    return model.envelope(rows, table, key=key, schema=schema, lsn=lsn, seq=F.lit(model.BEFORE))


def copy_tables(spark: SparkSession, paths: Mapping[str, str], keys: Mapping[str, model.ReplicationKey] | None = None, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Snapshots of tables of files; file splits are the ranges."""
    return {t: snapshot(spark.read.format(fmt).load(p), t, (keys or {}).get(t)) for t, p in paths.items()}


def write_snapshots(snapshots: Mapping[str, DataFrame], write, workers: int = 4) -> dict[str, str]:
    """Runs ``write(table, changes)`` for the tables side by side; the errors of all of them, by table."""
    failed: dict[str, str] = {}

    def one(item: tuple[str, DataFrame]) -> None:
        try:
            write(*item)
        except Exception as e:
            failed[item[0]] = str(e)

    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        list(pool.map(one, snapshots.items()))
    return failed


def qualified(tables: Sequence[str] | None, available: Sequence[str], schema: str = "public") -> list[str]:
    """Tables as ``schema.table``: the listed ones, or all that there are."""
    return [t if "." in t else f"{schema}.{t}" for t in (tables or available)]


def discover(spark: SparkSession, schema: str = "default") -> list[str]:
    """Tables of a catalogue schema."""
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)
