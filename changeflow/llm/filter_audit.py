"""Operator 13: what each filter of a chain removes, for every order of the filters.

Method: each document has a mask, the filters that it fails. Histograms of masks, of all documents and of
each label, are the rows of an incidence matrix: for five filters 32 columns. Integer matrices of 32 by 600
(120 orders of five steps) say whether a mask is kept after a step, removed by it, or failed there but gone
before; one more tells the masks with this filter alone. Their products with the rows are all counts of all
orders at once, and sums over orders give each filter's part (Shapley's value times the orders). No
document is filtered twice, and no order is run.

Distribution: filters are column expressions, so documents are read once. A filter for copies (a text that
has a smaller id somewhere) needs no comparing of documents: rows are counted by (SHA-256 of the text,
part, id), then by (text, part) with the counts at the smallest id, then the smallest id of the text is
joined to its parts; all sums are made in tasks before they travel, so a text with a third of all rows is a
few rows a task. Only hashes, ids and masks travel. Masks are counted by (part, mask), so a large part is
32 rows a task. A part is one row of numbers for the product, which tasks make for a few parts at a time;
parts may be as many as they like.

Defined results: a null text is empty; a null part and an empty one are the same part, named by the empty
text; a null id has no label, is no copy of anything and makes no copies; rows with the smallest id of a
text are no copies, all of them if they repeat; of several label rows of an id one is enough; labels of ids
that are not there and null labels count nothing; very long texts are read whole; an empty table gives an
empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import arrow_schema

BLANKS = r"[\x20\x09-\x0D]+"
#: Filters at most (orders grow as their factorial), and parts whose products a task makes at once.
MOST, AT_ONCE = 6, 64
#: Salts of null ids, which would otherwise meet in one task of the join with labels.
SALTS = 1024


def words_of(text: Column) -> Column:
    """The words of a text: maximal runs of characters that are no ASCII blanks."""
    return F.array_remove(F.split(text, BLANKS), "")


def outcomes(names: str) -> tuple[list[tuple[str, int]], dict[str, np.ndarray], np.ndarray]:
    """The (order, step from 1) of each column, the integer matrices (masks by columns) of each outcome, and the number of each column's filter.

    Bit k of a mask is set if the filter ``names[k]`` fails.
    """
    orders = list(itertools.permutations(range(len(names))))
    columns = [("".join(names[f] for f in order), step + 1) for order in orders for step in range(len(names))]
    mine = np.array([f for order in orders for f in order])
    before = np.array([sum(1 << f for f in order[:step]) for order in orders for step in range(len(names))])
    mask, own = np.arange(1 << len(names))[:, None], 1 << mine
    fails, gone = (mask & own) != 0, (mask & before) != 0
    made = {"kept": ~fails & ~gone, "removed": fails & ~gone, "redundant": fails & gone, "unique_fails": mask == own}
    return columns, {k: m.astype(np.int64) for k, m in made.items()}, mine


def masks(docs: DataFrame, filters: dict[str, Column], copies: str | None, labels: DataFrame | None, tallies: dict[str, Column], part: str, id_col: str, text_col: str) -> DataFrame:
    """(part, mask, n, and a count for each of ``tallies``) of all documents; the bit of ``copies`` is the last one."""
    own = list(tallies)
    text = F.coalesce(F.col(text_col), F.lit(""))
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(filters.values())), F.lit(0))
    rows = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(id_col).cast("long").alias("id"),
        mask.cast("int").alias("mask"),
        (F.unhex(F.sha2(text, 256)) if copies else F.lit(None).cast("binary")).alias("text"),
    )
    rows = rows.groupBy("text", "part", "id", "mask").agg(F.count("*").alias("n"))
    if labels is not None and own:
        known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("lid")).agg(*[F.max(F.when(c, 1).otherwise(0)).alias(f"is_{t}") for t, c in tallies.items()])
        # A null id meets no label; its salt only deals such rows over tasks.
        salt = F.when(F.col("id").isNull(), 1 + F.pmod(F.xxhash64("text", "part", "mask"), F.lit(SALTS))).otherwise(0)
        rows = rows.withColumn("salt", salt).join(known.withColumn("no_salt", F.lit(0).cast("long")), (F.col("id") == F.col("lid")) & (F.col("salt") == F.col("no_salt")), "left")
    counts = [F.col("n")] + [(F.col("n") * F.coalesce(F.col(f"is_{t}"), F.lit(0)) if labels is not None else F.lit(0).cast("long")).alias(t) for t in own]
    rows = rows.select("text", "part", "id", "mask", *counts)
    names = ["n", *own]
    if copies:
        # The counts of a text in a part, and those of its rows with the smallest id there.
        by = ["text", F.col("id").isNull().alias("no_id"), "part"]
        texts = rows.groupBy("text", "part", "id").agg(F.first("mask").alias("mask"), *[F.sum(c).alias(c) for c in names])
        texts = texts.groupBy(*by).agg(F.first("mask").alias("mask"), F.min(F.struct("id", *names)).alias("first"), *[F.sum(c).alias(c) for c in names])
        least = texts.groupBy("text", "no_id").agg(F.min("first.id").alias("least")).select(F.col("text").alias("of_text"), F.col("no_id").alias("of_no_id"), "least")
        texts = texts.join(least, (F.col("text") == F.col("of_text")) & (F.col("no_id") == F.col("of_no_id")))
        here = F.when(F.col("first.id").eqNullSafe(F.col("least")), 1).otherwise(0)
        kept = F.struct("mask", *[(F.col(f"first.{c}") * here).alias(c) for c in names])
        again = F.struct((F.col("mask") + (1 << len(filters))).alias("mask"), *[(F.col(c) - F.col(f"first.{c}") * here).alias(c) for c in names])
        rows = texts.select("part", F.explode(F.array(kept, again)).alias("row")).select("part", "row.*")
    return rows.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in names])


def audit(
    docs: DataFrame,
    filters: dict[str, Column],
    copies: str | None = None,
    labels: DataFrame | None = None,
    tallies: dict[str, Column] | None = None,
    part: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row for each part, order of the filters and step.

    ``filters`` has by a letter the condition under which a document fails; ``copies`` is the letter of a
    filter that a text fails if it also stands under a smaller id. ``tallies`` has conditions over ``labels``
    by the name of the column that counts such documents where they are removed. Columns: part,
    filter_order (letters), step (from 1), kept, removed, redundant (failed, but removed before),
    unique_fails (failed by this filter alone), the tallies, and shapley: what this step's filter removes,
    summed over all orders.
    """
    letters = "".join(filters) + (copies or "")
    if not letters or len(letters) > MOST or len(set(letters)) != len([*filters, *(copies or "")]):
        raise ValueError(f"one to {MOST} filters, each under a letter of its own")
    tallies = tallies or {}
    names = ["n", *tallies]
    held = masks(docs, filters, copies, labels, tallies, part, id_col, text_col)
    rows = held.groupBy("part").agg(F.collect_list(F.struct("mask", *names)).alias("masks"))  # a row for each mask at most
    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, " + "".join(f"`{t}` long, " for t in tallies) + "shapley long"
    return rows.mapInArrow(_product("".join(sorted(letters)), letters, names, arrow_schema(schema)), schema)


def _product(ordered: str, letters: str, names: list[str], schema: pa.Schema):
    """Multiplies the rows of some parts at a time; orders are named and listed by the letters in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, matrix, mine = outcomes(ordered)
        width = 1 << len(ordered)
        # Bits stand in the order in which filters were given; columns of the product in that of letters.
        place = np.zeros(width, np.int64)
        for k, letter in enumerate(letters):
            place += (np.arange(width) >> k & 1) << ordered.index(letter)
        total = np.stack([matrix["removed"][:, mine == f].sum(1) for f in range(len(ordered))], 1)
        order, step = pa.array([c[0] for c in columns]), pa.array([c[1] for c in columns], pa.int32())
        for batch in batches:
            for lo in range(0, batch.num_rows, AT_ONCE):
                some = batch.slice(lo, AT_ONCE)
                n, lists = some.num_rows, some.column(1)
                flat = lists.flatten()
                at, owner = place[flat.field("mask").to_numpy()], np.repeat(np.arange(n), np.diff(np.asarray(lists.offsets)))
                held = np.zeros((len(names), n, width), np.int64)
                for k, name in enumerate(names):
                    held[k][owner, at] = flat.field(name).to_numpy(zero_copy_only=False)
                made = {name: held[0] @ m for name, m in matrix.items()}
                lost = [held[k] @ matrix["removed"] for k in range(1, len(names))]
                shapley = (held[0] @ total)[:, mine]
                take = pa.array(np.tile(np.arange(len(columns)), n))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(np.repeat(np.arange(n), len(columns)))), order.take(take), step.take(take)]
                    + [pa.array(m.ravel()) for m in [*made.values(), *lost, shapley]],
                    schema=schema,
                )

    return run
