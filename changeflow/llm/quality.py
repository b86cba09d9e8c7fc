"""Operator 3: quality by perplexity under an interpolated modified Kneser-Ney n-gram model.

Method: n-grams of ``ORDER`` characters (UTF-16 units, runs of blanks as one, across words, the beginning
padded), whatever the script; the vocabulary is what trusted text holds, and the tables grow with it. They are trained on all
trusted documents but one in ``HELD``, which give the thresholds: a quantile, times a margin, of the
perplexities of trusted documents of the language that the model has not read.

Training: n-grams are counted in each task and added up by n-gram; continuation counts of the lower orders,
sums of contexts and the discounts are sharded aggregations, those of all orders in one. What is kept is a
table of own shares by n-gram and of interpolation weights by context, for each order.

Scoring: a slice is about ``SLICE`` bytes of a task's documents. A first scan tells the different n-grams of
each slice, which meet the tables of all orders in one sharded join on the n-grams and contexts that they
ask for (those of one unit or none are broadcast); a second scan packs the slices, which get the logarithms by a join on the slice and add them up for each document. So the exchange
holds each n-gram once a slice, not once a document; nothing is broadcast that grows, and no table is
collected. Both scans have to see the rows in the same order, as scans of files do; where they do not, a
check on every n-gram raises an error. A task holds one slice and its n-grams; a slice ends with the
document that fills it, so a longer one makes a slice with what stands before it.

Defined results: null and empty texts have perplexity null and are kept; very long texts are read whole; a
null language is a language of its own; languages with fewer than ``FEW`` trusted documents that the model
has not read take the threshold over all; without trusted text, or without any to set a threshold by, all is
kept; a perplexity that equals the threshold is kept; rows that repeat come out as often; an empty table
gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.common import arrow_schema, checkpointed, fresh, give_back, leave_state, map_rows

#: Four units of 16 bits are one code.
ORDER, UNIT = 4, 16
#: Documents over this quantile of trusted perplexities, times the margin, are of low quality.
QUANTILE, MARGIN, FEW, HELD = 0.98, 1.05, 20, 4
#: So many trusted ids are broadcast at most; beyond, documents meet them by a shuffled join.
MOST_BROADCAST = 500_000
#: Bytes of text in a slice, and rows of a batch that are read at once.
SLICE, ROWS = 1 << 24, 1 << 7
#: Rows of the model's tables in a task, at least.
PER_TASK = 1 << 18


def codes(text: str | None) -> np.ndarray:
    """The code of the n-gram that ends at each unit of the text."""
    units = np.frombuffer(" ".join((text or "").split()).encode("utf-16-le", "surrogatepass"), "<u2").astype(np.uint64)
    padded = np.concatenate([np.zeros(ORDER - 1, np.uint64), units])
    out = padded[: len(units)].copy()
    for k in range(1, ORDER):
        out <<= np.uint64(UNIT)
        out |= padded[k : k + len(units)]
    return out.view(np.int64)


def codes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all texts in a row, and how many each has."""
    each = [codes(t.as_py()) for t in texts]
    return np.concatenate(each) if each else np.empty(0, np.int64), np.array([len(c) for c in each], np.int64)


def discounts(n: dict[int, int]) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from the numbers of n-grams with counts one to four."""
    n1, n2, n3, n4 = (n.get(k, 0) for k in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1, d2 = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return min(max(d1, 0.01), 0.99), min(max(d2, 0.01), 1.99), min(max(d3, 0.01), 2.99)


def suffix(code: Column, k: int) -> Column:
    """The last k units of a code."""
    return code.bitwiseAND(F.lit((1 << UNIT * k) - 1)) if k < ORDER else code


def context(code: Column) -> Column:
    """All but the last unit of a code."""
    return F.shiftrightunsigned(code, UNIT)


@dataclass
class Model:
    """(k, own, code, value): the own share of each k-gram, or else the interpolation weight of a context in order k. None without trusted text."""

    table: DataFrame | None
    units: int = 0

    def part(self, k: int, own: bool, key: str, value: str) -> DataFrame:
        rows = self.table.where((F.col("k") == k) & (F.col("own") == F.lit(own))).select(F.col("code").alias(key), F.col("value").alias(value))
        return F.broadcast(rows) if k - (not own) <= 1 else rows  # keys of one unit: 65536 rows at most

    def log_p(self, asked: DataFrame) -> DataFrame:
        """(code, log_p): the natural logarithm of the probability of the last unit after the others, for each different code."""
        rows, p = asked.select("code").distinct(), F.lit(1.0 / (self.units + 1))
        keys = {(k, own): suffix(F.col("code"), k) if own else context(suffix(F.col("code"), k)) for k in range(1, ORDER + 1) for own in (True, False)}
        large = {at: key for at, key in keys.items() if at[0] - (not at[1]) > 1}
        sought = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(own).alias("own"), key.alias("key")) for (k, own), key in large.items()])
        met = rows.select("code", F.explode(sought).alias("s")).select("code", "s.k", "s.own", "s.key").join(self.table.withColumnRenamed("code", "key"), ["k", "own", "key"], "left")
        rows = met.groupBy("code").agg(*[F.max(F.when((F.col("k") == k) & (F.col("own") == F.lit(own)), F.col("value"))).alias(f"own{k}" if own else f"spare{k}") for k, own in large])
        for (k, own), key in keys.items():
            if (k, own) not in large:
                rows = rows.withColumn("key", key).join(self.part(k, own, "key", f"own{k}" if own else f"spare{k}"), "key", "left").drop("key")
        for k in range(1, ORDER + 1):
            p = F.coalesce(f"own{k}", F.lit(0.0)) + F.coalesce(f"spare{k}", F.lit(1.0)) * p
        return rows.select("code", F.log(p).alias("log_p"))


def _gathered(rows: DataFrame, most: int) -> DataFrame:
    """``rows``, ``most`` at most, in tasks of ``PER_TASK`` or more of them, as long as all cores have one: each task of a shuffle makes files of its own."""
    return rows.coalesce(max(-(-most // PER_TASK), rows.sparkSession.sparkContext.defaultParallelism))


def kneser_ney(counts: DataFrame) -> Model:
    """The model from a table (code, n) of counts."""
    most = counts.count()
    last = counts.select("code", "n")
    orders = last.select(F.lit(ORDER).alias("k"), "code", "n")
    for k in range(ORDER - 1, 0, -1):  # continuation counts: how many different units stand before the shorter n-gram
        last = _gathered(last, most).groupBy(suffix(F.col("code"), k).alias("code")).agg(F.count("*").alias("n"))
        orders = orders.unionByName(last.select(F.lit(k).alias("k"), "code", "n"))
    orders = checkpointed(_gathered(orders, ORDER * most))
    many = {k: {} for k in range(1, ORDER + 1)}
    for r in orders.groupBy("k", F.least("n", F.lit(5)).alias("n")).agg(F.count("*").alias("m")).collect():  # five rows an order
        many[r["k"]][r["n"]] = r["m"]
    if not many[1]:
        return Model(None)
    taken = F.lit(None).cast("double")
    for k in many:
        d1, d2, d3 = discounts(many[k])
        taken = F.when(F.col("k") == k, F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)).otherwise(taken)
    rows = orders.withColumn("ctx", context(F.col("code"))).withColumn("taken", taken)
    sums = rows.groupBy("k", "ctx").agg(F.sum("n").alias("whole"), F.sum("taken").alias("gone"))
    own = rows.join(sums, ["k", "ctx"]).select("k", F.lit(True).alias("own"), "code", ((F.col("n") - F.col("taken")) / F.col("whole")).alias("value"))
    spare = sums.select("k", F.lit(False).alias("own"), F.col("ctx").alias("code"), (F.col("gone") / F.col("whole")).alias("value"))
    return Model(checkpointed(_gathered(own.unionByName(spare), 2 * ORDER * most)), sum(many[1].values()))


def fit_model(trusted_text: DataFrame) -> Model:
    """The model of a one-column table of texts: all of them, whatever their number."""

    def counted():
        leave_state()

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            for k in range(0, batch.num_rows, ROWS):
                some, n = np.unique(codes_of(batch.column(0).slice(k, ROWS))[0], return_counts=True)
                yield {"code": some, "n": n}

        return work

    return kneser_ney(checkpointed(map_rows(trusted_text, counted, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))))


def _cut(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(slice, part of a batch): slices end with the row that fills them, wherever batches end, so that two scans of the same rows cut alike."""
    from pyspark import TaskContext

    number, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        lo, before = 0, 0
        while lo < batch.num_rows:
            full = int(np.searchsorted(ends, before + SLICE - size, "left")) + 1
            hi = min(full, lo + ROWS, batch.num_rows)
            yield number, batch.slice(lo, hi - lo)
            size += int(ends[hi - 1]) - before
            lo, before = hi, int(ends[hi - 1])
            if size >= SLICE:
                number, size = number + 1, 0


def _asked(at: int):
    """The different codes of each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_state()
        held, last = [], None

        def row() -> pa.RecordBatch:
            found = np.unique(np.concatenate(held))
            give_back()
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.array(found))], names=["slice", "codes"])

        for number, part in _cut(batches, at):
            if last is not None and number != last:
                yield row()
                held = []
            last = number
            held.append(np.unique(codes_of(part.column(at))[0]))
            if len(held) > 64:
                held = [np.unique(np.concatenate(held))]
        if last is not None:
            yield row()

    return run


def _packed(at: int):
    """Each slice as an Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_state()
        sink = writer = last = None

        def row() -> pa.RecordBatch:
            writer.close()
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["slice", "payload"])

        for number, part in _cut(batches, at):
            if writer is not None and number != last:
                yield row()
                writer = None
                give_back()
            if writer is None:
                sink = pa.BufferOutputStream()
                writer = pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6)))
            last = number
            writer.write_batch(part)
        if writer is not None:
            yield row()

    return run


def _scored(text_col: str, keep: list[str], schema: pa.Schema):
    def run(key: tuple, group: pa.Table, told: pa.Table) -> pa.Table:
        leave_state()
        known, log_p = told.column("code").to_numpy(), told.column("log_p").to_numpy()
        by = np.argsort(known, kind="stable")
        known, log_p = known[by], log_p[by]
        batches = []
        for payload in group.column("payload"):
            for batch in pa.ipc.open_stream(payload.as_buffer()):
                found, sizes = codes_of(batch.column(batch.schema.get_field_index(text_col)))
                place = np.minimum(np.searchsorted(known, found), max(0, len(known) - 1))
                if len(found) and not (len(known) and (known[place] == found).all()):
                    raise ValueError("two scans of the documents differ: write them to a table first")
                sums, ends = np.r_[0.0, np.cumsum(log_p[place])] if len(found) else np.zeros(1), np.cumsum(sizes)
                mean = (sums[ends] - sums[ends - sizes]) / np.maximum(sizes, 1)
                made = pa.array(np.exp(-mean), mask=sizes == 0)
                columns = [*[batch.column(batch.schema.get_field_index(c)) for c in keep], made]
                batches.append(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema))
        give_back()
        return pa.Table.from_batches(batches, schema)

    return run


def perplexities(docs: DataFrame, model: Model, text_col: str = "text", name: str = "perplexity", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all, if none are named) with one of perplexities at the end."""
    keep = keep if keep is not None else docs.columns
    if model.table is None:
        return docs.select(*[F.col(f"`{c}`") for c in keep], F.lit(None).cast("double").alias(name))
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(name, T.DoubleType())])
    docs = _few_tasks(docs, text_col)
    asked = checkpointed(docs.mapInArrow(_asked(docs.columns.index(text_col)), "slice long, codes array<long>"))
    asked = asked.select(F.col("slice").alias("of"), F.explode("codes").alias("code"))
    told = asked.join(model.log_p(asked), "code").select("of", "code", "log_p")
    slices = docs.mapInArrow(_packed(docs.columns.index(text_col)), "slice long, payload binary")
    return slices.groupBy("slice").cogroup(told.groupBy("of")).applyInArrow(_scored(text_col, keep, arrow_schema(schema)), schema)


def _few_tasks(docs: DataFrame, text_col: str) -> DataFrame:
    """Small partitions joined to some of a slice each, as long as all cores have one: each n-gram travels once a slice."""
    whole = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    wanted = max(-(-whole // SLICE), docs.sparkSession.sparkContext.defaultParallelism)
    return docs.coalesce(wanted) if docs.rdd.getNumPartitions() > wanted else docs


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Ids that a label calls good and none calls bad."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    return rows.groupBy(F.col(id_col).cast("long").alias("trusted_id")).agg(F.min(label_col).alias("q")).where("q >= 1").select("trusted_id")


@dataclass
class Fitted:
    """The model, (of_lang, own): the threshold of each language with enough trusted documents, and the one for the others."""

    model: Model
    by_lang: DataFrame
    over_all: float | None


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", quantile: float = QUANTILE, margin: float = MARGIN) -> Fitted:
    """The model and the thresholds, from all trusted documents of ``docs``."""
    trusted = checkpointed(trusted_ids(labels))
    small = trusted.count() <= MOST_BROADCAST
    few = F.broadcast(trusted) if small else trusted
    rows = docs.select(F.col(id_col).cast("long").alias("trusted_id"), F.col(text_col).alias("t"), F.col(lang_col).alias("of_lang")).join(few, "trusted_id")
    held = F.pmod(F.xxhash64("trusted_id"), F.lit(HELD)) == 0
    model = fit_model(rows.where(~held).select("t"))
    unread = rows.where(held).select("t", "of_lang")
    unread = unread if small else checkpointed(unread)  # a shuffled join gives no steady order
    good = checkpointed(perplexities(unread, model, "t", "p", ["of_lang"]).where("p IS NOT NULL"))
    limit = (F.percentile_approx("p", quantile, 10_000) * margin).alias("own")
    by_lang = good.groupBy("of_lang").agg(limit, F.count("*").alias("n")).where(F.col("n") >= FEW).select("of_lang", "own")
    return Fitted(model, checkpointed(by_lang), good.agg(limit).first()["own"])


def judged(scored: DataFrame, fitted: Fitted, lang_col: str, name: str, limit: str) -> DataFrame:
    """Adds the threshold that holds for the row's language."""
    lang, own = fresh(scored.columns, "of_lang"), fresh([*scored.columns, limit], "own")
    by_lang = fitted.by_lang.select(F.col("of_lang").alias(lang), F.col("own").alias(own))
    few = F.broadcast(by_lang) if by_lang.limit(10_001).count() <= 10_000 else by_lang  # a row for each language
    joined = scored.join(few, F.col(lang_col).eqNullSafe(F.col(lang)), "left")
    return joined.withColumn(limit, F.coalesce(F.col(own), F.lit(fitted.over_all).cast("double"))).drop(lang, own)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang, perplexity, threshold, kept) of every row."""
    fitted = fit(docs, labels, id_col, text_col, lang_col)
    scored = perplexities(docs.select(id_col, text_col, lang_col), fitted.model, text_col, "perplexity", [id_col, lang_col])
    told = judged(scored, fitted, lang_col, "perplexity", "threshold")
    return told.select(id_col, lang_col, "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"))


def reject(docs: DataFrame, fitted: Fitted, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are."""
    name = fresh(docs.columns, "perplexity")
    limit = fresh([*docs.columns, name], "threshold")
    told = judged(perplexities(docs, fitted.model, text_col, name), fitted, lang_col, name, limit)
    return told.where(F.coalesce(F.col(name) <= F.col(limit), F.lit(True))).select(*[F.col(f"`{c}`") for c in docs.columns])
