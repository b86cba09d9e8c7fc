"""Near-duplicates of the pipeline: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 at least.

Shingles: words as in ``simhash.fingerprint``; each run of ``width`` words (the whole text, if it has no more)
is hashed by XXH64 (UTF-8, seed 42); a text is the set of these hashes, and its fingerprint the SimHash of
the set.

Method: SimHash with the multi-index of ``simhash``: ``SEGMENTS`` segments, of which one differs by at most a
bit if fingerprints differ in at most ``RADIUS``. The index is sought under each value and its ball, and
what meets there within ``REACH`` bits of the whole fingerprint is verified on the complete sets; what
verifies makes components. The distance follows the angle of two sets, so no radius that an index can look
up holds all pairs of similarity 0.8: these differ in about ten of 64 bits and often in 15. Hence an exact
way for the rest: all pairs of differing components that share one of ``BANDS`` bands of ``ROWS`` minima are
verified likewise. Texts of similarity 0.8 share no band with a chance of (1 - 0.8^4)^32 = 5e-8. Pairs of
one component need no comparing, so nothing is lost.

Before pairs travel to the sets, parity sketches refute most: a bit of a sketch is the parity of the set's
hashes that fall on it, so two sketches differ in no more bits than their sets in elements. More differing bits
than similar sets could have elements rule a pair out for certain, and lose none. With two bits an element and
more, what a sketch lets through mostly has a similarity over 0.75. So a group of texts that are like each
other, but not enough, is compared where its band value is, and gives next to no rows.

Distribution: equal sets are one class. Index rows and band rows are dealt by value and sorted. Index values
with over ``CROWD`` classes are cut by class, and of a value's rows each meets the first ``FIRST`` near ones
only, so that a large group costs no pairs of all its members; the bands link what this parts. Band values
with over ``HOT`` classes are cut over salts that lose no pair. Both are found by a count. Sketches go to band
values under which two components stand, and complete sets to pairs that no sketch refutes. The comparing of
sketches under one band value still takes time by the square of the classes there, and pairs of differing
components just below the bound are verified one by one.

Defined results: texts without words are copies of each other; very long texts are read whole; a similarity
that equals the bound links; rows with a null id have no part and are
kept; of rows that repeat one stays; rows that share an id but are no near-duplicates both stay; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm import simhash
from changeflow.llm.common import checkpointed, fresh, give_back, leave_state, map_rows, small_batches
from changeflow.llm.components import connected_components

WIDTH, SIMILAR = 5, 0.8
BANDS, ROWS, SEED, HOT = 32, 4, 42, 20_000
#: The index of fingerprints: differing bits that it surely finds, and those up to which what it finds is verified.
SEGMENTS, RADIUS, REACH = 4, 7, 12
CROWD, FIRST = 1024, 3
MOST_BROADCAST = 200_000
#: Bits of a sketch at least; it has two for each element, rounded up to a power of two.
SKETCH = 512
#: Pairs compared, hashes taken minima of, and bytes of sketches compared at once in a task.
AT_ONCE, HASHES, BYTES = 1 << 20, 1 << 11, 1 << 23
#: Rows of a batch whose sets are held at once.
SLICE = 1 << 9
_RANDOM = np.random.default_rng(SEED)
_XORS, _FACTORS, _MIX = (_RANDOM.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1) for n in (BANDS * ROWS, BANDS * ROWS, ROWS))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The different hashes of the text's shingles, sorted."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashed, joined = xxhash.xxh64_intdigest, b" ".join(words)
    if n <= width:
        return np.array([hashed(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    first, last = (ends - sizes)[: n - width + 1].tolist(), ends[width - 1 :].tolist()
    return np.unique(np.array([hashed(joined[a:b], SEED) for a, b in zip(first, last)], np.uint64))


def class_of(found: np.ndarray) -> int:
    """A signed hash of the set."""
    import xxhash

    return xxhash.xxh64_intdigest(found.tobytes(), SEED) - 2**63


def bands(found: np.ndarray) -> np.ndarray:
    """The band values of a set, signed; none of an empty one."""
    if not len(found):
        return np.empty(0, np.int64)
    low = np.full(BANDS * ROWS, np.uint64(2**64 - 1))
    for k in range(0, len(found), HASHES):
        np.minimum(low, ((found[None, k : k + HASHES] ^ _XORS[:, None]) * _FACTORS[:, None]).min(1), out=low)
    mixed = (low.reshape(BANDS, ROWS) >> np.uint64(7)) * _MIX
    return (np.bitwise_xor.reduce(mixed, 1) ^ (np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))).view(np.int64)


def sketch(found: np.ndarray) -> bytes:
    """The parities of the set's hashes by their lowest bits."""
    bits = SKETCH
    while bits < 2 * len(found):
        bits *= 2
    return np.packbits((np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """The sketch that the same set has in ``size`` bytes."""
    out = np.frombuffer(sketch, np.uint64)
    while out.nbytes > size:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def possible(left: np.ndarray, right: np.ndarray, size: np.ndarray, sketches: np.ndarray, similar: float) -> np.ndarray:
    """Whether the sets of the rows left[i] and right[i] can be similar, by their sizes and sketches; False is certain."""
    on = np.minimum(size[left], size[right]) >= similar * np.maximum(size[left], size[right])
    at = np.flatnonzero(on)
    wide = np.fromiter(map(len, sketches), np.int64, len(sketches))
    wide = np.minimum(wide[left[at]], wide[right[at]])
    for w in np.unique(wide).tolist():
        own = at[wide == w]
        met = np.zeros(len(size), bool)
        met[left[own]] = met[right[own]] = True
        held, place = np.stack([folded(s, w) for s in sketches[met]]), np.cumsum(met) - 1
        for k in range(0, len(own), BYTES // w):
            some = own[k : k + BYTES // w]
            differ = np.bitwise_count(held[place[left[some]]] ^ held[place[right[some]]]).sum(1, dtype=np.int64)
            on[some] = differ * (1 + similar) <= (1 - similar) * (size[left[some]].astype(np.int64) + size[right[some]]) + 1e-6
    return on


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts, after each of which unused memory goes back."""
    for k in range(0, batch.num_rows, SLICE):
        yield batch.slice(k, SLICE)
        give_back()


def _read(width: int):
    def make():
        leave_state()

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            for part in slices(batch):
                sets = [shingles(t.as_py(), width) for t in part.column(1)]
                fps = np.array([simhash.majority(s) for s in sets], np.uint64).view(np.int64)
                yield {"th": part.column(0), "cls": [class_of(s) for s in sets], "size": [len(s) for s in sets], "fp": fps, "bands": [bands(s) for s in sets], "sketch": [sketch(s) for s in sets]}

        return work

    return make


def _sets(width: int):
    def make():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            for part in slices(batch):
                sets = [shingles(t.as_py(), width) for t in part.column(0)]
                yield {"cls": [class_of(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]}

        return work

    return make


def _sought(plan: list[tuple[int, int, int]]):
    """The rows of the index: a class under each segment's value, its own, and under the ball around it."""

    def make():
        parts = [(k, np.uint64(s), np.uint64((1 << w) - 1), simhash.ball(w, r)) for k, (s, w, r) in enumerate(plan) if r >= 0]

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            for lo in range(0, batch.num_rows, 1 << 13):
                cls, fp = (batch.column(c).slice(lo, 1 << 13).to_numpy() for c in (0, 1))
                for k, shift, mask, masks in parts:
                    value = (fp.view(np.uint64) >> shift) & mask
                    keys = (value[:, None] ^ masks[None, :]) | np.uint64(k << 56)
                    own = np.zeros(keys.shape, bool)
                    own[:, 0] = True
                    yield {"key": keys.ravel().view(np.int64), "cls": np.repeat(cls, len(masks)), "fp": np.repeat(fp, len(masks)), "own": own.ravel()}

        return work

    return make


def _near(reach: int):
    """Pairs (a, b) of classes whose fingerprints are near, from rows (key, salt, cls, fp, own) sorted by the first three: each with the first own ones of its value."""

    def pairs(key: np.ndarray, salt: np.ndarray, cls: np.ndarray, fp: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])])
        sizes = np.diff(np.r_[starts, len(key)])
        run, seen = np.repeat(np.arange(len(starts)), sizes), np.zeros(len(key), np.int64)
        at = np.flatnonzero(own)
        n = sizes[run[at]]
        at, n = at[n > 1], n[n > 1]
        ends, k = np.cumsum(n), 0
        while k < len(at):
            upto = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + AT_ONCE, "right")))
            t, m = at[k:upto], n[k:upto]
            left = np.repeat(t, m)
            right = np.repeat(starts[run[t]] - np.cumsum(m) + m, m) + np.arange(len(left))
            on = (np.bitwise_count((fp[left] ^ fp[right]).view(np.uint64)) <= reach) & (cls[left] != cls[right])
            left, right = left[on], right[on]
            by = np.argsort(right, kind="stable")
            left, right = left[by], right[by]
            rows, first, many = np.unique(right, return_index=True, return_counts=True)
            on = np.arange(len(right)) - np.repeat(first, many) + seen[right] < FIRST
            seen[rows] += many
            a, b = cls[left[on]], cls[right[on]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
            k = upto

    return _by_value(pairs)


def _meet(similar: float):
    """Pairs (a, b) of classes of differing components that sizes and sketches allow to be similar, from rows (band, salt, cls, size, sketch, comp, own) sorted by the first three: of every two under each value."""

    def pairs(band: np.ndarray, salt: np.ndarray, cls: np.ndarray, size: np.ndarray, sketches: np.ndarray, comp: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, (band[1:] != band[:-1]) | (salt[1:] != salt[:-1])])
        sizes = np.diff(np.r_[starts, len(band)])

        def fine(left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
            apart = comp[left] != comp[right]
            left, right = left[apart], right[apart]
            on = possible(left, right, size, sketches, similar)
            a, b = cls[left[on]], cls[right[on]]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        run = np.repeat(np.arange(len(starts)), sizes)
        at = np.flatnonzero(own)
        n = (starts + sizes)[run[at]] - at - 1
        at, n = at[n > 0], n[n > 0]
        ends, k = np.cumsum(n), 0
        while k < len(at):
            upto = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + AT_ONCE, "right")))
            t, m = at[k:upto], n[k:upto]
            left = np.repeat(t, m)
            yield fine(left, left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(m) - m, m))
            k = upto

    return _by_value(pairs)


def _by_value(pairs):
    """Gives ``pairs`` the columns of whole values, from rows sorted by the first two columns."""

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
            cut += int(np.searchsorted(now[1][cut:], now[1][-1], "left"))
            held = [c[cut:] for c in now]
            if cut:
                yield from pairs(*[c[:cut] for c in now])
        if held is not None:
            yield from pairs(*held)
        del held
        give_back()  # the worker stays

    return run


def _unrefuted(similar: float):
    def make():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            n, (size, sketches) = batch.num_rows, (np.concatenate([batch.column(c).to_numpy(zero_copy_only=False) for c in both]) for both in ((2, 4), (3, 5)))
            on = pa.array(possible(np.arange(n), n + np.arange(n), size, sketches, similar))
            yield {"a": batch.column(0).filter(on), "b": batch.column(1).filter(on)}

        return work

    return make


def _verified(similar: float):
    def make():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            us, vs = [], []
            (a, b), lists = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)), [batch.column(k) for k in (2, 3)]
            for k in range(len(a)):
                x, y = (c[k].values.to_numpy(zero_copy_only=False) for c in lists)
                both = len(x) + len(y) - len(np.union1d(x, y))
                if both >= similar * (len(x) + len(y) - both):
                    us.append(a[k]), vs.append(b[k])
            yield {"u": us, "v": vs}
            give_back()

        return work

    return make


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else df


def links_of(met: DataFrame, classes: DataFrame, texts: DataFrame, width: int, similar: float) -> DataFrame:
    """(u, v): the pairs of the checkpointed ``met`` that are similar."""
    if not met.limit(1).count():
        return met.select(F.col("a").alias("u"), F.col("b").alias("v"))
    ends = met.select(F.col("a").alias("cls")).unionByName(met.select(F.col("b").alias("cls"))).distinct()
    wanted = checkpointed(classes.join(ends, "cls", "left_semi").select(F.col("th").alias("wanted")))
    found = texts.join(_few(wanted), F.col("th") == F.col("wanted"), "left_semi").select("text")
    spark = met.sparkSession
    with small_batches(spark, SLICE):
        sets = checkpointed(map_rows(found, _sets(width), "cls long, shingles array<long>").dropDuplicates(["cls"]))
    first, second = (sets.select(F.col("cls").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab")
    joined = met.join(first, "a").join(second, "b").select("a", "b", "of_a", "of_b")
    with small_batches(spark, SLICE):  # two sets a row
        return checkpointed(map_rows(joined, _verified(similar), "u long, v long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similar: float = SIMILAR) -> DataFrame:
    """(th, grp): the group of each text, by the hash of the text, of rows with an id."""
    texts = docs.where(F.col(id_col).isNotNull()).select(F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    prints = checkpointed(map_rows(texts, _read(width), "th long, cls long, size int, fp long, bands array<long>, sketch binary"))
    classes = checkpointed(prints.groupBy("cls").agg(F.min("th").alias("th"), *[F.first(c).alias(c) for c in ("size", "fp", "bands", "sketch")]))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def met(rows: DataFrame, by: str, pairs) -> DataFrame:
        return rows.repartition(n, by, "salt").sortWithinPartitions(by, "salt", "cls").mapInArrow(pairs, "a long, b long")

    plan, some = simhash.layout(RADIUS, SEGMENTS), classes.where("size > 0")
    values = F.array(*[F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << bits) - 1)).bitwiseOR(F.lit(k << 56)) for k, (shift, bits, _) in enumerate(plan)])
    crowded = checkpointed(some.select(F.explode(values).alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("key", F.ceil(F.col("n") / CROWD).cast("int").alias("salts")))
    rows = map_rows(some.select("cls", "fp"), _sought(plan), "key long, cls long, fp long, own boolean")
    if crowded.limit(1).count():
        rows = rows.join(_few(crowded), "key", "left").withColumn("salt", F.pmod(F.xxhash64("cls"), F.coalesce("salts", F.lit(1))))
    else:
        rows = rows.withColumn("salt", F.lit(0))
    near = checkpointed(met(rows.select("key", "salt", "cls", "fp", "own"), "key", _near(REACH)).distinct())
    for c in "ab":
        near = near.join(classes.select(F.col("cls").alias(c), F.col("size").alias(f"size_{c}"), F.col("sketch").alias(f"sketch_{c}")), c)
    with small_batches(docs.sparkSession, SLICE):
        near = checkpointed(map_rows(near.select("a", "b", "size_a", "sketch_a", "size_b", "sketch_b"), _unrefuted(similar), "a long, b long"))
    linked = links_of(near, classes, texts, width, similar)
    known = checkpointed(connected_components(linked, contract=False))

    rows = classes.join(_few(known), F.col("cls") == F.col("node"), "left").select("cls", "size", "sketch", "bands", F.coalesce("component", "cls").alias("comp"))
    values = rows.select(F.explode("bands").alias("band"), "cls", "comp")
    shared = checkpointed(values.groupBy("band").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("band", F.ceil(F.col("n") / HOT).cast("int").alias("salts")))
    dealt = values.select("band", "cls").join(_few(shared), "band").withColumn("mine", F.pmod(F.xxhash64("cls"), F.col("salts"))).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    dealt = dealt.join(rows.drop("bands"), "cls").withColumn("own", F.col("salt") == F.col("mine"))  # a class is compared with those behind it in one salt
    more = checkpointed(met(dealt.select("band", "salt", "cls", "size", "sketch", "comp", "own"), "band", _meet(similar)).distinct())
    more = links_of(more, classes, texts, width, similar)
    joined = known
    if more.limit(1).count():  # links between components: their graph is far smaller than that of the classes
        names = known.select(F.col("node"), F.col("component"))
        for c in "uv":
            more = more.join(_few(names.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))), c, "left").withColumn(f"of_{c}", F.coalesce(f"of_{c}", c))
        over = checkpointed(connected_components(more.select("of_u", "of_v"), contract=False)).select(F.col("node").alias("component"), F.col("component").alias("top"))
        renamed = names.join(_few(over), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
        single = over.select(F.col("component").alias("node"), F.col("top").alias("component"))  # those that had no link before, and names of components
        joined = checkpointed(renamed.unionByName(single).distinct())
    named = prints.select("th", "cls").distinct()
    return named.join(_few(joined), F.col("cls") == F.col("node"), "left").select("th", F.coalesce("component", "cls").alias("grp"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, similar: float = SIMILAR) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest id, and of those the smallest hash of the text."""
    groups = checkpointed(near_duplicates(docs, id_col, text_col, width, similar))
    one, th, rank = (fresh(docs.columns, c) for c in ("kept_id", "kept_text", "kept_rank"))
    rows = docs.where(F.col(id_col).isNotNull())
    ids = rows.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"))
    best = ids.join(groups, "th").groupBy("grp").agg(F.min(F.struct("id", "th")).alias("best"))
    kept = best.select(F.col("best.id").alias("best_id"), F.col("best.th").alias("best_th"))
    rows = rows.withColumn(one, F.col(id_col).cast("long")).withColumn(th, F.xxhash64(text_col))
    rest = rows.join(kept, (F.col(one) == F.col("best_id")) & (F.col(th) == F.col("best_th")), "left_semi")
    rest = rest.withColumn(rank, F.row_number().over(Window.partitionBy(one, th).orderBy(th))).where(F.col(rank) == 1).drop(one, th, rank)
    return rest.unionByName(docs.where(F.col(id_col).isNull()))
