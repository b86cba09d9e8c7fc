"""Capture modes by name: stream, copy, or copy and stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow import model

MODES = ("stream", "copy", "copy-and-stream")


def mode_of(copy: bool, copy_and_stream: bool) -> str:
    """The mode of two flags that exclude each other; streaming without them."""
    if copy and copy_and_stream:
        raise ValueError("copy and copy-and-stream exclude each other")
    return "copy" if copy else "copy-and-stream" if copy_and_stream else "stream"


def capture(mode: str, snapshots: Mapping[str, DataFrame], streams: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The changes of each table. A snapshot comes before the stream; changes that it already holds are absorbed by replay, where an INSERT of a row that is there does nothing."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "copy":
        return dict(snapshots)
    if mode == "stream":
        return dict(streams)
    out = dict(snapshots)
    for table, stream in streams.items():
        out[table] = out[table].withColumn("_seq", F.lit(model.BEFORE).cast("long")).unionByName(stream) if table in out else stream
    return out

