"""Operator 2: embedding near-duplicates inside labels by PCA-ordered tiled comparison.

Method: unit vectors are rotated to principal components (fitted on at most ``SAMPLE`` rows; a rotation
keeps every product, so the sample touches speed only). A pair of tiles adds the products of the leading
dimensions first; what the rest can add is at most the product of the suffix norms, and pairs whose sum
with that bound stays under the threshold stop. Those left go on through further dimensions, and the
last ones are decided by the double precision cosine of the vectors as they came.

Distribution: exact copies are one class with a weight. Unit vectors within the threshold differ by at
most ``sqrt(2 - 2 t)`` along the first component, so labels are cut into slabs of that width and a slab
meets itself and its neighbour only; a hash cuts slabs into tiles of about ``TILE`` classes, so that no
label, slab or group of copies needs one task. A pair of tiles gives back link counts and a spanning
forest, at most a row for each of its classes, however many links there are.

Defined results: rows with a null id are left out; vectors are compared whole, however long. A vector that is null, zero or holds null or
non-finite components, or whose label is null, has no links and is its own component. Vectors of
different length do not link. Rows that repeat are vectors of their own: they link, and share the
component; rows of one id with different vectors link each for itself. A cosine that equals the threshold
links. Other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import checkpointed, map_rows
from changeflow.llm.components import connected_components, stars

TILE, SAMPLE = 2048, 4096
#: Added to bounds before pairs stop; far above rounding, far below any effect on speed.
SLACK = 1e-9


def principal_axes(sample: list[list[float]]) -> np.ndarray:
    """Rows are the principal axes of the unit vectors in the sample, the widest first."""
    x = np.array(sample, float)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    _, axes = np.linalg.eigh(x.T @ x)
    return axes[:, ::-1].T


def unit(x: np.ndarray) -> np.ndarray:
    """Rows over their norms, scaled first so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def tile_links(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into a, into b) of cosine >= threshold, in pieces; with ``same`` each pair of the one tile once."""
    d = a.shape[1]
    ua, ub = unit(a), unit(b)
    ra, rb = ua @ axes.T, ub @ axes.T
    cuts = sorted({min(d, max(1, d // 4)), min(d, max(1, d // 2)), d})
    suffix = lambda r, k: np.sqrt(np.maximum((r[:, k:] ** 2).sum(1), 0))
    for lo in range(0, len(a), 512):
        rows = slice(lo, lo + 512)
        lead = ra[rows, : cuts[0]] @ rb[:, : cuts[0]].T
        left = lead + suffix(ra[rows], cuts[0])[:, None] * suffix(rb, cuts[0])[None, :] >= threshold - SLACK
        if same:
            left &= np.arange(lo, min(lo + 512, len(a)))[:, None] < np.arange(len(b))[None, :]
        i, j = np.nonzero(left)
        part = lead[i, j]
        for k0, k1 in zip(cuts, cuts[1:]):
            sa, sb = suffix(ra[rows], k1), suffix(rb, k1)
            kept_i, kept_j, kept_p = [], [], []
            for s in range(0, len(i), 1 << 18):
                x, y = i[s : s + (1 << 18)], j[s : s + (1 << 18)]
                p = part[s : s + (1 << 18)] + np.einsum("nd,nd->n", ra[lo + x, k0:k1], rb[y, k0:k1])
                on = p + sa[x] * sb[y] >= threshold - SLACK
                kept_i.append(x[on]), kept_j.append(y[on]), kept_p.append(p[on])
            i, j, part = (np.concatenate(v) if v else v0[:0] for v, v0 in ((kept_i, i), (kept_j, j), (kept_p, part)))
        for s in range(0, len(i), 1 << 18):
            x, y = lo + i[s : s + (1 << 18)], j[s : s + (1 << 18)]
            va, vb = a[x], b[y]
            cos = np.einsum("nd,nd->n", va, vb) / np.sqrt(np.einsum("nd,nd->n", va, va) * np.einsum("nd,nd->n", vb, vb))
            odd = ~np.isfinite(cos) | (cos == 0)
            if odd.any():  # squares that overflow or vanish
                cos[odd] = np.einsum("nd,nd->n", ua[x[odd]], ub[y[odd]])
            on = cos >= threshold
            if on.any():
                yield x[on], y[on]


def _compare(axes: dict[int, np.ndarray], threshold: float):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        t1, t2 = key[0].as_py(), key[1].as_py()
        tile, cid = table.column("tile").to_numpy(), table.column("cid").to_numpy()
        weight = table.column("n").to_numpy()
        x = np.array(table.column("v").to_pylist(), float)
        first, second = np.flatnonzero(tile == t1), np.flatnonzero(tile == t2)
        links, us, vs = np.zeros(len(cid), np.int64), [], []
        if len(first) and len(second):
            a, b = x[first], x[second]
            turn = axes.get(x.shape[1])
            for i, j in tile_links(a, b, np.eye(x.shape[1]) if turn is None else turn, threshold, t1 == t2):
                i, j = first[i], second[j]
                np.add.at(links, i, weight[j])
                np.add.at(links, j, weight[i])
                u, v = stars(cid[i], cid[j])
                us.append(u), vs.append(v)
        u, v = stars(np.concatenate(us), np.concatenate(vs)) if us else (np.empty(0, np.int64),) * 2
        some = np.flatnonzero(links)
        return pa.table(
            {
                "cid": pa.array(np.concatenate([cid[some], u]), pa.int64()),
                "links": pa.array(np.concatenate([links[some], np.zeros(len(u), np.int64)]), pa.int64()),
                "other": pa.array(np.concatenate([cid[some], v]), pa.int64()),
            }
        )

    return run


def near_duplicate_vectors(rows: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row with an id."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold lies over 0 and up to 1")
    vec = F.col(vec_col)
    fine = vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    ok = F.coalesce(fine, F.lit(False)) & F.col(label_col).isNotNull()
    every = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.when(ok, F.col(label_col)).alias("label"), F.when(ok, vec).alias("v"))
    able = every.where(F.col("v").isNotNull())
    classes = able.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))

    sample: dict[int, list] = {}
    for r in able.orderBy(F.xxhash64("vec_id"), "vec_id").select("v").limit(SAMPLE).collect():  # a bounded sample: it turns axes, no more
        sample.setdefault(len(r["v"]), []).append(r["v"])
    axes = {d: principal_axes(x) for d, x in sample.items() if len(x) > 1}

    reach = max(math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK, 0.02)

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            v = batch.column(1)
            size = np.array([len(x) for x in v], np.int64)
            slab = np.zeros(len(batch), np.int64)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                x = unit(np.array([v[i].as_py() for i in at], float))
                slab[at] = np.floor((x @ axes[int(d)][0] if int(d) in axes else x[:, 0]) / reach)
            yield {"label": batch.column(0), "v": v, "rep": batch.column(2), "n": batch.column(3), "d": size, "slab": slab}

        return work

    kinds = {f.name: f.dataType.simpleString() for f in every.schema}
    classes = map_rows(classes, make, f"label {kinds['label']}, v {kinds['v']}, rep long, n long, d long, slab long")
    classes = checkpointed(classes.withColumn("cid", F.monotonically_increasing_id()))  # ids may repeat: a class has a number of its own
    crowd = checkpointed(classes.groupBy("label", "d", "slab").agg(F.ceil(F.count("*") / TILE).alias("parts")))
    names = ["label", "d", "slab"]
    own = crowd.groupBy("label", "d").agg(F.min("slab").alias("least"))
    tiles = crowd.join(own, ["label", "d"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    tiles = tiles.select(*names, "parts", "part").withColumn("tile", F.xxhash64("label", "d", "slab", "part"))
    tiles = checkpointed(tiles)
    few = lambda t: F.broadcast(t) if t.limit(100_001).count() <= 100_000 else t  # noqa: E731  a row for each 2048 classes at most, or for each label and slab

    # Each tile's pairs: with later tiles of its slab, itself, and all tiles of the next slab.
    here, there = tiles.select(*names, "part", F.col("tile").alias("t1")), tiles.select("label", "d", F.col("slab").alias("slab2"), F.col("part").alias("part2"), F.col("tile").alias("t2"))
    reached = here.withColumn("slab2", F.explode(F.array(F.col("slab"), F.col("slab") + 1)))
    pairs = reached.join(there, ["label", "d", "slab2"]).where((F.col("slab2") > F.col("slab")) | (F.col("part2") >= F.col("part"))).select("t1", "t2")
    sides = checkpointed(pairs.select("t1", "t2", F.col("t1").alias("tile")).unionByName(pairs.where("t1 <> t2").select("t1", "t2", F.col("t2").alias("tile"))))

    placed = classes.join(few(crowd), names).withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")))
    placed = placed.select("cid", "n", "v", F.xxhash64("label", "d", "slab", "part").alias("tile"))
    met = placed.join(few(sides), "tile").groupBy("t1", "t2").applyInArrow(_compare(axes, threshold), "cid long, links long, other long")
    met = checkpointed(met)
    links = met.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = checkpointed(connected_components(met.where("cid <> other").select("cid", "other")))
    smallest = joined.join(classes.select(F.col("cid").alias("node"), "rep"), "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = joined.join(smallest, "component").select(F.col("node").alias("cid"), "component_id")
    known = classes.select("cid", "rep", "n", "label", "v").join(links, "cid", "left").join(of_class, "cid", "left")
    known = checkpointed(known.select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")))
    told = able.join(known, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = every.where(F.col("v").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return told.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
