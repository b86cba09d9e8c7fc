"""Shared plumbing of the corpus operators: session facts, checkpoints, Arrow mapping."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.session import checkpointed, ensure_checkpoint_dir

__all__ = ["Memory", "arrow_schema", "bound", "checkpointed", "cuts_of", "ensure_checkpoint_dir", "fresh", "give_back", "leave_state", "map_rows", "settled", "small_batches", "table", "worker_state"]


class Memory:
    """A dictionary of bounded size in two generations: what was used since the last change of generation stays.

    Callers look in ``young`` themselves, and ask ``recall`` for what is not there.
    """

    def __init__(self, size: int) -> None:
        self.size, self.young, self.old = size, {}, {}

    def recall(self, key: str):
        if (found := self.old.get(key)) is not None:
            self.young[key] = found
        return found

    def turn(self) -> None:
        """Between texts: starts a generation if this one is full."""
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}


def give_back() -> None:
    """Returns memory that is not in use to the system, so that what one operator freed is there for the next worker."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not with every C library
        pass


_STATE: dict[object, object] = {}


def worker_state(key: object, make: Callable[[], object]) -> object:
    """What ``make`` builds, once in a Python worker; it stays until another operator's state is asked for, so that a worker holds one."""
    if key not in _STATE:
        if _STATE:
            _STATE.clear()
            gc.collect()
        give_back()
        _STATE[key] = make()
    return _STATE[key]


def leave_state() -> None:
    """For operators without a state: lets go of the one that a worker holds from an operator before."""
    if _STATE:
        _STATE.clear()
        gc.collect()
        give_back()


def cuts_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different ASCII-blank-separated cuts of a batch's texts, the number of each cut in order, and where each text's cuts begin (and the last ones end).

    Arrow splits and numbers them without a Python object for each cut. Null texts have none.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    flat, ends = lists.flatten(), np.asarray(lists.offsets)
    some = np.asarray(pc.binary_length(flat)) > 0
    if not some.all():
        ends = np.r_[0, np.cumsum(some)][ends - ends[0]]
        flat = flat.filter(pa.array(some))
    coded = flat.dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices), ends - ends[0]


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    was = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, was)


def small_batches(spark: SparkSession, rows: int):
    """Arrow batches of so many rows at most in what runs inside, for rows that are long."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def settled(df: DataFrame) -> DataFrame:
    """``checkpointed``, after which the shuffle files that led to it go at once, and not when the driver happens to collect its garbage."""
    with _setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        return checkpointed(df.select("*"))  # a plan of its own, made under this setting


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row: in a lambda, an expression from outside is computed for each element anew."""
    return F.transform(F.array(value), use)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: Iterable[str], base: str) -> str:
    """A column name like ``base`` that none of ``columns`` has (names compare without case)."""
    taken, name = {c.lower() for c in columns}, base
    while name.lower() in taken:
        name += "_"
    return name


def arrow_schema(schema: str | T.StructType) -> pa.Schema:
    """The Arrow schema of a Spark schema; a string is parsed, which needs the driver."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict]]], schema: str) -> DataFrame:
    """``mapInArrow`` with a per-task set-up.

    ``make`` runs once a task on the executor and returns a function from a batch to dictionaries of
    columns, so that a task holds one batch and what ``make`` built, whatever the partition's size.
    """

    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            if work is None:
                work = make()
            for columns in work(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in out], schema=out
                )

    return df.mapInArrow(run, schema)
