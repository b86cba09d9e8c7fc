"""Changes as protocol frames, and captures of them: the way back from ``pgoutput``, by column expressions.

Captures made so hold what a server would send for the same changes, and serve to move changes between
systems that speak the protocol, and to test readers on as many rows as a table has.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow import model, pgtypes
from changeflow.functions.codecs import encode
from changeflow.sources.frames import Capture, framed


def _number(c: Column | int, size: int) -> Column:
    """An unsigned number of so many bytes, in hexadecimal digits."""
    return F.lpad(F.hex(c if isinstance(c, Column) else F.lit(c)), 2 * size, "0")


def _text(c: Column) -> Column:
    return F.hex(F.encode(c, "UTF-8"))


def _tuple(changes: DataFrame, side: str, toasted: bool) -> Column:
    row = model.row_type(changes)
    parts = [_number(len(row), 2)]
    for f in row:
        text = encode(model.field(side, f.name), pgtypes.oid_of(f))
        told = F.when(text.isNull(), "6E").otherwise(F.concat(F.lit("74"), _number(F.octet_length(text), 4), _text(text)))
        parts.append(F.when(F.array_contains("_toasted", f.name), "75").otherwise(told) if toasted else told)
    return F.concat(*parts)


def _relation(changes: DataFrame, number: int, schema: str, table: str, keys: Sequence[str], identity: str) -> str:
    row, z = model.row_type(changes), b"\0"
    columns = [bytes([f.name in keys]) + f.name.encode() + z + pgtypes.oid_of(f).to_bytes(4, "big") + b"\xff" * 4 for f in row]
    return (b"R" + number.to_bytes(4, "big") + schema.encode() + z + table.encode() + z + identity.encode() + len(row).to_bytes(2, "big") + b"".join(columns)).hex()


def to_frames(changes: DataFrame, commit: Column, table: str, keys: Sequence[str], schema: str = "public", number: int = 1, identity: str = "d", moment: int = 0) -> DataFrame:
    """(commit, part, ordinal, frame) of typed changes of one table; those of one ``commit`` position are a transaction, in the order of ``_seq``.

    Only the first transaction tells the relation, as a server does. ``moment`` is the time of all commits, in
    microseconds from 2000 on. Old rows go whole for ``identity`` f, else as a key; UPDATEs without one send none.
    """
    changes = changes.withColumn("commit", commit)
    mark = "4F" if identity == "f" else "4B"
    new, old = F.concat(F.lit("4E"), _tuple(changes, "new", True)), F.concat(F.lit(mark), _tuple(changes, "old", False))
    of = F.when(F.col("_op") == model.INSERT, "49").when(F.col("_op") == model.UPDATE, "55").otherwise("44")
    said = F.concat(of, _number(number, 4), F.when(F.col("old").isNotNull(), old).otherwise(""), F.when(F.col("_op") != model.DELETE, new).otherwise(""))
    row = lambda df, part, ordinal, text: df.select("commit", F.lit(part).alias("part"), ordinal.cast("long").alias("ordinal"), text.alias("message"))
    commits = changes.select("commit").distinct()
    time = _number(moment, 8)
    begin = row(commits, 0, F.lit(0), F.concat(F.lit("42"), _number(F.col("commit"), 8), time, _number(1, 4)))
    first = row(commits.agg(F.min("commit").alias("commit")).where("commit IS NOT NULL"), 1, F.lit(0), F.lit(_relation(changes, number, schema, table, keys, identity)))
    done = row(commits, 3, F.lit(0), F.concat(F.lit("4300"), _number(F.col("commit"), 8), _number(F.col("commit") + 8, 8), time))
    messages = begin.unionByName(first).unionByName(row(changes, 2, F.col("_seq"), said)).unionByName(done)
    position = _number(F.col("commit"), 8)
    return messages.select("commit", "part", "ordinal", F.unhex(F.concat(F.lit("77"), position, position, time, F.col("message"))).alias("frame"))


def write_capture(frames: DataFrame, path: str, files: int | None = None) -> int:
    """Writes frames as so many files of whole transactions at most, each by one task; the number of bytes. Without ``files`` their number grows with the frames.

    A file is named by its first commit, so a task that runs again writes the same one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        head = next(batches, None)
        if head is None:
            return

        def parts() -> Iterator[bytes]:
            for batch in itertools.chain([head], batches):
                yield from (framed(f) for f in batch.column("frame").to_pylist())

        n = Capture(path).add_frames(f"{head.column('commit')[0].as_py():016x}.frames", parts())
        yield pa.RecordBatch.from_pydict({"n": [n]}, schema=pa.schema([("n", pa.int64())]))

    ordered = frames.repartitionByRange(*([files] if files is not None else []), "commit").sortWithinPartitions("commit", "part", "ordinal")
    return sum(r["n"] for r in ordered.mapInArrow(run, "n long").collect())  # a row a file
