"""Operator 5: SimHash near-duplicates by multi-index hashing.

Fingerprint: words are runs of anything but ASCII blanks after lower-casing A-Z; each shingle of
``width`` words, repeats included, is hashed by XXH64 (UTF-8, seed 42); a bit is set if it is set in over
half the hashes.

Method: the 64 bits are cut into ``segments``. If two fingerprints differ in at most r bits, then for
radii that add up to r - segments + 1, some segment differs by at most its radius (else r + 1 bits would
differ). Each fingerprint stands in a table under the value of each segment and looks up the small
Hamming ball of that radius around it; rows that meet under a value have their complete distance
verified. Radii for r = 4 and three segments are 1, 1 and 0: 46 look-ups a fingerprint.

Distribution: equal fingerprints are one class. Table and look-up rows (two longs each) are dealt by
segment value and sorted; a task streams them, compares within a value by numpy and gives back a
spanning forest, never the pairs. Values that hold over ``HOT`` fingerprints are found by a count
beforehand and cut: their table rows are dealt over salts, to each of which the look-ups go.

Defined results: null and empty texts have fingerprint zero, which links like any other; very long texts
are hashed whole; a bit that exactly half of the hashes set is 0; rows with a null
id have no part and are left out (``keep_one`` keeps them); rows that repeat come out as often, with the
same component; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import checkpointed, fresh, map_rows
from changeflow.llm.components import connected_components, stars

BITS, SEED, HOT = 64, 42, 50_000
#: Pairs compared at once in a task.
AT_ONCE = 1 << 21


def fingerprint(text: str | None, width: int = 4) -> int:
    """The 64-bit fingerprint, unsigned."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    n = len(words)
    if not n:
        return 0
    hashed = xxhash.xxh64_intdigest
    if n <= width:
        return hashed(b" ".join(words), SEED)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    first, last = (ends - sizes)[: n - width + 1].tolist(), ends[width - 1 :].tolist()
    return majority(np.array([hashed(joined[a:b], SEED) for a, b in zip(first, last)], "<u8"))


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; zero without any."""
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, of each row with an id."""

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            fps = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], np.uint64)
            yield {"doc_id": batch.column(0), "fp": fps.view(np.int64)}

        return work

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(rows, make, "doc_id long, fp long")


def layout(radius: int, segments: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment; a radius below zero means that the segment needs no table."""
    spare = radius - segments + 1
    out, shift = [], 0
    for k in range(segments):
        width = BITS // segments + (k < BITS % segments)
        out.append((shift, width, spare // segments + (k < spare % segments)))
        shift += width
    return out


def ball(width: int, radius: int) -> np.ndarray:
    """The masks of up to ``radius`` of ``width`` bits, the empty one first."""
    return np.array([sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)], np.uint64)


def _tables(plan: list[tuple[int, int, int]]):
    def make():
        parts = [(k, np.uint64(s), np.uint64((1 << w) - 1), ball(w, r)) for k, (s, w, r) in enumerate(plan) if r >= 0]

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            every = batch.column(0).to_numpy().view(np.uint64)
            for lo in range(0, len(every), 1 << 14):
                fps = every[lo : lo + (1 << 14)]
                for k, shift, mask, masks in parts:
                    value = (fps >> shift) & mask
                    keys = (value[:, None] ^ masks[None, :]) | np.uint64(k << 56)
                    own = np.zeros(keys.shape, bool)
                    own[:, 0] = True
                    yield {"key": keys.ravel().view(np.int64), "fp": np.repeat(fps, len(masks)).view(np.int64), "own": own.ravel()}

        return work

    return make


def _verify(radius: int):
    """Links between the table rows and all rows under each (key, salt), from rows sorted by them."""

    def near(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        on = (np.bitwise_count((a ^ b).view(np.uint64)) <= radius) & (a != b)
        return a[on], b[on]

    def links(key: np.ndarray, salt: np.ndarray, fp: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])])
        sizes = np.diff(np.r_[starts, len(key)])
        table = np.flatnonzero(own)
        run = np.searchsorted(starts, table, "right") - 1
        n = sizes[run]
        table, run, n = table[n > 1], run[n > 1], n[n > 1]
        us, vs = [], []

        def keep(a: np.ndarray, b: np.ndarray) -> None:
            if len(a):
                u, v = stars(a, b)
                us.append(u), vs.append(v)

        at = 0
        while at < len(table):
            upto = at + max(1, int(np.searchsorted(np.cumsum(n[at:]), AT_ONCE, "right")))
            t, r, m = table[at:upto], run[at:upto], n[at:upto]
            if len(t) == 1 and m[0] > AT_ONCE:
                for lo in range(starts[r[0]], starts[r[0]] + m[0], AT_ONCE):
                    part = fp[lo : min(lo + AT_ONCE, starts[r[0]] + m[0])]
                    keep(*near(np.full(len(part), fp[t[0]]), part))
            else:
                left = np.repeat(fp[t], m)
                right = np.repeat(starts[r], m) + np.arange(len(left)) - np.repeat(np.cumsum(m) - m, m)
                keep(*near(left, fp[right]))
            at = upto
        if not us:
            return (np.empty(0, np.int64),) * 2
        return stars(np.concatenate(us), np.concatenate(vs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(now[0]):
                continue
            if held is not None:
                now = [np.concatenate(p) for p in zip(held, now)]
            # The last value's rows wait for the next batch.
            cut = int(np.searchsorted(now[0], now[0][-1], "left"))
            last = now[1][-1]
            cut += int(np.searchsorted(now[1][cut:], last, "left"))
            held = [c[cut:] for c in now]
            if cut:
                u, v = links(*[c[:cut] for c in now])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        if held is not None:
            u, v = links(*held)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return run


def fingerprint_links(classes: DataFrame, radius: int = 4, segments: int = 3) -> DataFrame:
    """(u, v): a spanning forest of the links between the distinct fingerprints in the column fp."""
    plan = layout(radius, segments)
    rows = map_rows(classes.select("fp"), _tables(plan), "key long, fp long, own boolean")
    # A table row for each segment is enough for the count: hot values are few, at most 3 N / HOT.
    own = None
    for k, (shift, width, r) in enumerate(plan):
        if r >= 0:
            part = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)).bitwiseOR(F.lit(k << 56))
            own = classes.select(part.alias("key")) if own is None else own.unionByName(classes.select(part.alias("key")))
    hot = checkpointed(own.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("key", F.ceil(F.col("n") / HOT).cast("int").alias("salts")))
    if hot.limit(1).count():
        rows = rows.join(hot, "key", "left")
        every = F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)
        mine = F.array(F.pmod(F.xxhash64("fp"), F.coalesce("salts", F.lit(1))).cast("int"))
        # A table row is compared in one salt, and stands as a look-up in the others.
        rows = rows.withColumn("salt", F.explode(every)).withColumn("own", F.col("own") & (F.col("salt") == mine[0])).select("key", "salt", "fp", "own")
    else:
        rows = rows.select("key", F.lit(0).alias("salt"), "fp", "own")
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "key", "salt").sortWithinPartitions("key", "salt")
    return dealt.mapInArrow(_verify(radius), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4, segments: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of each row with an id; the component is the smallest id reachable by links."""
    prints = checkpointed(fingerprints(docs, id_col, text_col, width))
    classes = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    joined = connected_components(fingerprint_links(classes, radius, segments), contract=False)
    known = classes.join(joined, F.col("fp") == F.col("node"), "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    smallest = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = checkpointed(known.join(smallest, "component").select("fp", "component_id"))
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4, segments: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the document with the smallest id; of rows that share that id, the first by text."""
    from pyspark.sql import Window

    found = near_duplicates(docs, id_col, text_col, width, radius, segments)
    one, rank = fresh(docs.columns, "kept_id"), fresh(docs.columns, "kept_rank")
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias(one)).distinct()
    rest = docs.where(F.col(id_col).isNotNull()).join(kept, F.col(id_col).cast("long") == F.col(one), "left_semi")
    first = Window.partitionBy(F.col(id_col).cast("long")).orderBy(F.col(text_col).asc_nulls_first())
    rest = rest.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1).drop(rank)
    return rest.unionByName(docs.where(F.col(id_col).isNull()))
