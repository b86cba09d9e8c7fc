"""Replay: the rows of a table after its changes, in their order.

By key: an INSERT of a key that is there does nothing, an UPDATE or DELETE of one that is not there does
nothing, an UPDATE keeps the columns it left out. Keys that no UPDATE changes have a closed form in window
functions over (key, _seq), all of them running ones with one sort and no buffering. Keys that an UPDATE
changes are linked; linked keys are components, found distributed, and folded in order, many components to a call.

By whole row (FULL): the table is a multiset; DELETE and UPDATE act on every copy of the old row. Without
UPDATEs the rows that stay are the INSERTs after the last DELETE of the same row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow import model
from changeflow.operators.graph import components
from changeflow.session import checkpointed


class DuplicateKey(ValueError):
    """An UPDATE gave a row the key of another row."""


#: Linked keys in one call of a fold, about.
FOLD = 8192


def _fold_buckets(folded: DataFrame, linked: DataFrame, row: T.StructType, keys: list[str] | None, on_conflict: str) -> DataFrame:
    """Folds components by buckets, so that a call takes many of them; what one does concerns no other."""
    buckets = max(1, -(-linked.count() // FOLD))
    return folded.withColumn("_b", F.pmod(F.xxhash64("component"), F.lit(buckets))).groupBy("_b").applyInArrow(_fold(row, keys, on_conflict), row)


def _key(side: str, keys: list[str]) -> Column:
    return F.struct(*[model.field(side, k).alias(k) for k in keys])


def target_key(keys: list[str]) -> Column:
    """The key of the row that a change is about: the old row's where there is one, for DELETE and UPDATE, else the new row's."""
    return F.when((F.col("_op") != model.INSERT) & F.col("old").isNotNull(), _key("old", keys)).otherwise(_key("new", keys))


def changes_key(keys: list[str]) -> Column:
    """Whether an UPDATE gives its row another key."""
    differs = F.lit(False)
    for k in keys:
        differs = differs | (~model.field("old", k).eqNullSafe(model.field("new", k)) & ~F.array_contains("_toasted", k))
    return (F.col("_op") == model.UPDATE) & F.col("old").isNotNull() & F.col("new").isNotNull() & differs


def with_base(changes: DataFrame, base: DataFrame | None) -> DataFrame:
    """Puts the rows of the target before the changes, as INSERTs."""
    if base is None:
        return changes
    row = model.row_type(changes)
    as_rows = base.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in row])
    first = model.envelope(as_rows, "", seq=F.lit(-(2**62)), emitted_at=F.lit(None).cast("timestamp"))
    return changes.unionByName(first.select(*changes.columns) if set(changes.columns) <= set(first.columns) else first, allowMissingColumns=True)


def effective(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Changes of data with ``effective``: whether each did anything, for changes that keep keys."""
    kept = changes.where(F.col("_op").isin(*model.DATA_OPERATIONS)).withColumn("_k", target_key(keys))
    before = Window.partitionBy("_k").orderBy("_seq").rowsBetween(Window.unboundedPreceding, -1)
    alive = F.coalesce(F.last(F.when(F.col("_op") != model.UPDATE, F.col("_op")), ignorenulls=True).over(before) == model.INSERT, F.lit(False))
    return kept.withColumn("effective", F.when(F.col("_op") == model.INSERT, ~alive).otherwise(alive))


def _closed(changes: DataFrame, keys: list[str]) -> DataFrame:
    row = model.row_type(changes)
    done = effective(changes, keys).where("effective")
    so_far = Window.partitionBy("_k").orderBy("_seq").rowsBetween(Window.unboundedPreceding, 0)
    # An INSERT that has an effect sets every column, so nothing of a row deleted before it is carried
    # over. A struct around each value tells NULL from left out.
    sets = lambda name: (F.col("_op") == model.INSERT) | ((F.col("_op") == model.UPDATE) & ~F.array_contains("_toasted", name))
    carried = [F.last(F.when(sets(f.name), F.struct(model.field("new", f.name).alias("v"))), ignorenulls=True).over(so_far)["v"].alias(f.name) for f in row]
    last = F.lead("_seq").over(Window.partitionBy("_k").orderBy("_seq")).isNull()
    return done.select("_op", last.alias("_last"), *carried).where(F.col("_last") & (F.col("_op") != model.DELETE)).select(*[f"`{f.name}`" for f in row])


def _fold(row: T.StructType, keys: list[str] | None, on_conflict: str):
    """Rows after the changes of whole components, in their order."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, names = to_arrow_schema(row), row.names
    freeze = lambda v: tuple(map(freeze, v)) if isinstance(v, list) else tuple(sorted((k, freeze(x)) for k, x in v.items())) if isinstance(v, dict) else v
    of = lambda r: tuple(freeze(r[k]) for k in (keys if keys is not None else names))

    def run(table: pa.Table) -> pa.Table:
        state: dict[tuple, list] = {}  # key: [row, copies]
        for c in sorted(table.select(["_seq", "_op", "_toasted", "new", "old"]).to_pylist(), key=lambda c: c["_seq"]):
            op, new, old = c["_op"], c["new"], c["old"]
            if op == model.INSERT:
                if keys is None:
                    state.setdefault(of(new), [new, 0])[1] += 1
                else:
                    state.setdefault(of(new), [new, 1])
                continue
            at = of(old if old is not None else new)
            if at not in state:
                continue
            if op == model.DELETE:
                del state[at]
                continue
            was, copies = state[at]
            made = {n: was[n] if n in c["_toasted"] else new[n] for n in names}
            to = of(made)
            if to != at and to in state and keys is not None:
                if on_conflict == "raise":
                    raise DuplicateKey(f"an UPDATE gives a row the key {to} of another row, at _seq {c['_seq']}")
                continue
            del state[at]
            if to in state:
                state[to][1] += copies
            else:
                state[to] = [made, copies]
        return pa.Table.from_pylist([r for r, n in state.values() for _ in range(n)], schema=schema)

    return run


def replay(changes: DataFrame, keys: list[str], base: DataFrame | None = None, on_conflict: str = "raise", moves: bool = True) -> DataFrame:
    """The table's rows after ``changes`` over ``base``, for a primary or unique key.

    ``on_conflict``: ``raise`` or ``skip`` for an UPDATE that gives a row the key of another one. ``moves`` is
    false where it is known that no UPDATE changes a key.
    """
    row = model.row_type(changes)
    changes = with_base(changes, base)
    if not moves:
        return _closed(changes, keys)
    moved = changes.where(changes_key(keys)).select(F.xxhash64(_key("old", keys)).alias("a"), F.xxhash64(_key("new", keys)).alias("b"))
    moved = checkpointed(moved)
    if not moved.limit(1).count():
        return _closed(changes, keys)
    # A hash stands for a key: were two keys to share one, their components would be folded together, which changes nothing.
    linked = checkpointed(components(moved))
    hashed = changes.where(F.col("_op").isin(*model.DATA_OPERATIONS)).withColumn("_h", F.xxhash64(target_key(keys)))
    folded = hashed.join(linked, F.col("_h") == F.col("node")).select("component", "_seq", "_op", "_toasted", "new", "old")
    rest = hashed.join(linked, F.col("_h") == F.col("node"), "left_anti").drop("_h")
    return _closed(rest, keys).unionByName(_fold_buckets(folded, linked, row, keys, on_conflict))


def replay_rows(changes: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """The table's rows after ``changes`` over ``base``, for whole-row identity."""
    row = model.row_type(changes)
    changes = with_base(changes, base).where(F.col("_op").isin(*model.DATA_OPERATIONS))
    whole = F.when((F.col("_op") == model.INSERT) | F.col("old").isNull(), F.col("new")).otherwise(F.col("old"))
    filled = F.struct(*[F.when(F.array_contains("_toasted", f.name), model.field("old", f.name)).otherwise(model.field("new", f.name)).alias(f.name) for f in row])
    rows = changes.withColumn("_h", F.xxhash64(whole))
    moved = checkpointed(rows.where(F.col("_op") == model.UPDATE).select(F.col("_h").alias("a"), F.xxhash64(filled).alias("b")))
    kept = lambda part: _rows_closed(part, whole, row)
    if not moved.limit(1).count():
        return kept(rows)
    linked = checkpointed(components(moved).unionByName(moved.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))).groupBy("node").agg(F.min("component").alias("component")))
    folded = rows.join(linked, F.col("_h") == F.col("node")).select("component", "_seq", "_op", "_toasted", "new", "old")
    rest = rows.join(linked, F.col("_h") == F.col("node"), "left_anti")
    return kept(rest).unionByName(_fold_buckets(folded, linked, row, None, "raise"))


def _rows_closed(rows: DataFrame, whole: Column, row: T.StructType) -> DataFrame:
    deleted = F.max(F.when(F.col("_op") == model.DELETE, F.col("_seq")))
    # Aggregates before they meet: one row for each deleted value, however many copies there are.
    gone = rows.where(F.col("_op") == model.DELETE).groupBy(whole.alias("gone")).agg(deleted.alias("at"))
    there = rows.where(F.col("_op") == model.INSERT).select(F.col("new"), "_seq")
    left = there.join(gone, F.col("new").eqNullSafe(F.col("gone")), "left").where(F.col("at").isNull() | (F.col("_seq") > F.col("at")))
    return left.select(*[model.field("new", f.name).alias(f.name) for f in row])
