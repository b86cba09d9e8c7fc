"""Operator 8: mixing sources to target weights by Poisson replication.

Method: a source with n documents and target share w of T output documents repeats each of its
documents w * T / n times on average. A document's count inverts the Poisson distribution of that mean
at a number in [0, 1) hashed from the seed and the document id; the rows are exploded by the count and
dealt out by another hash of seed, id and copy number, and sorted by it inside partitions, which is a
global shuffle without a sampling pass.

Hash: the first 13 hexadecimal digits of MD5 over ``seed:id``, so that plain SQL can repeat it. Means over 600 are split in equal parts below that, whose counts add up.

Scale: the counts of a source are pre-aggregated in each task; documents meet the rates by broadcast
if the number of sources is below a checked bound, else by a shuffled join that adaptive execution
splits at hot sources. The one large shuffle carries the output itself, evenly by its hash.

Defined results: a null source is a source of its own; sources without a target weight get none; a
null id hashes as an empty one; rows that repeat draw the same count; null, empty and very long texts are rows
like others; rows whose hashes tie stand in any order; an empty table gives an empty table; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import checkpointed, fresh

#: Rates of so many sources are broadcast at most; each is a row of about 50 bytes.
MOST_BROADCAST = 50_000
#: The largest mean that is inverted in one piece.
LARGEST_MEAN = 600.0
#: So many copies of a document are made in one task at most, where the rates are such that more are likely.
MOST_COPIES = 2000


def hashed_unit(text: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_count(unit: Column, mean: Column) -> Column:
    """The smallest k whose Poisson distribution function exceeds ``unit``, by summing terms upwards."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("sum"), F.lit(0).cast("long").alias("k"))

    def step(s: Column, i: Column) -> Column:
        term = s["term"] * mean / i
        go = s["sum"] <= unit
        return F.struct(F.when(go, term).otherwise(s["term"]).alias("term"), F.when(go, s["sum"] + term).otherwise(s["sum"]).alias("sum"), F.when(go, s["k"] + 1).otherwise(s["k"]).alias("k"))

    # Most documents are settled by the first term, without a loop.
    summed = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["k"])
    return F.when(unit < F.exp(-mean), F.lit(0).cast("long")).otherwise(summed)


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, total: int | None = None, source_col: str = "source") -> DataFrame:
    """(source, n, rate): weights None gives every source the same share; total None keeps the number of documents."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        share = F.lit(1.0) / F.col("sources")
        summary = counts.agg(F.count("*").alias("sources"), F.sum("n").alias("docs")).first()
        wanted = counts.withColumn("sources", F.lit(max(summary["sources"], 1))).withColumn("docs", F.lit(summary["docs"] or 0))
    else:
        whole = sum(weights.values()) or 1.0
        summary = counts.agg(F.sum("n").alias("docs")).first()
        named = docs.sparkSession.createDataFrame([(k, float(v) / whole) for k, v in weights.items()], "named string, share double")
        wanted = counts.join(named, F.col("source").eqNullSafe(F.col("named")), "left").withColumn("docs", F.lit(summary["docs"] or 0))
        share = F.coalesce(F.col("share"), F.lit(0.0))
    whole_rows = F.lit(float(total)) if total is not None else F.col("docs").cast("double")
    return wanted.select("source", "n", (share * whole_rows / F.col("n")).alias("rate"))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    total: int | None = None,
    seed: int = 7,
    id_col: str = "doc_id",
    source_col: str = "source",
    copy_col: str | None = "copy",
    rate_col: str | None = None,
) -> DataFrame:
    """All columns of ``docs``, each row repeated by its Poisson count, in globally shuffled order; copies count from 1 in ``copy_col``."""
    by = checkpointed(rates(docs, weights, total, source_col))
    few = by.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    names = docs.columns
    src, rate, count, order, copy, unit, block = (fresh([*names, copy_col or "", rate_col or ""], f"mix_{x}") for x in ("source", "rate", "count", "order", "copy", "unit", "block"))
    by = by.select(F.col("source").alias(src), F.col("rate").alias(rate))
    joined = docs.join(F.broadcast(by) if few else by, F.col(source_col).eqNullSafe(F.col(src)), "inner")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    parts = F.greatest(F.ceil(F.col(rate) / LARGEST_MEAN), F.lit(1).cast("long"))
    small = poisson_count(F.col(unit), F.col(rate))
    large = F.aggregate(
        F.sequence(F.lit(1).cast("long"), parts), F.lit(0).cast("long"), lambda s, i: s + poisson_count(hashed_unit(F.concat(key, F.lit("/"), i.cast("string"))), F.col(rate) / parts)
    )
    counted = joined.withColumn(unit, hashed_unit(key)).withColumn(count, F.when(F.col(rate) <= LARGEST_MEAN, small).otherwise(large)).where(F.col(count) > 0)
    one = F.lit(1).cast("long")
    copies = counted.select("*", F.explode(F.sequence(one, F.col(count))).alias(copy))
    if (by.agg(F.max(rate)).first()[0] or 0) > MOST_COPIES / 2:  # documents of many copies are cut into blocks that go to tasks of their own
        first = F.col(block) * MOST_COPIES + 1
        blocks = counted.where(F.col(count) > MOST_COPIES).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / MOST_COPIES))).alias(block))
        blocks = blocks.repartition(F.xxhash64(F.col(id_col).cast("string"), F.col(block)))
        many = blocks.select("*", F.explode(F.sequence(first, F.least(first + MOST_COPIES - 1, F.col(count)))).alias(copy)).drop(block)
        copies = counted.where(F.col(count) <= MOST_COPIES).select("*", F.explode(F.sequence(one, F.col(count))).alias(copy)).unionByName(many)
    dealt = copies.withColumn(order, F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), F.col(copy)))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = dealt.repartition(n, F.col(order)).sortWithinPartitions(order)
    extra = [F.col(have).alias(want) for have, want in ((copy, copy_col), (rate, rate_col)) if want]
    return out.select(*names, *extra)
