"""Operator 9: exact top-k inner-product search with cover trees over queries and data.

Method: dual trees. A task indexes a chunk of queries and a block of data by cover trees (nested
centres, children chosen farthest first and hence apart, each with its covering radius) and walks them
together. No score between two nodes exceeds ``<q, p> + r_q |p| + r_p |q| + r_q r_p``; a pair of nodes
goes when that is below the worst kth score of the query node.

Distribution: up to 256 pivots, a bounded sample, cut queries and data into cells, and a hash cuts the
cells into blocks of about ``BLOCK`` rows, hot cells into more. Chunks of queries first meet one block
of their own cell, which gives every query a first kth score; then they meet those other blocks whose
root bound reaches the chunk's worst kth score. Rows of both sides travel once for each pair of blocks
that is left; no table of scores is made but k rows a query and block, and only those that reach the
query's first kth score.

Scores are of integers floor(scale * x), x as double, and exact: in double arithmetic where that holds
every sum, else in Python integers, cut to the range of a long.

Defined results: vectors that are null, or hold null or non-finite components, and rows with null ids
take no part; vectors meet only those of the same length; every row of data counts, repeats too, but those
of the query's own id; query rows that repeat exactly are one query, and an id with different vectors is
one query for each; equal scores go to the smaller id; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import checkpointed, map_rows

BLOCK, PIVOTS, LEAF, FANOUT = 8192, 256, 128, 16
EXACT = float(2**53)
LONG = 2**63


class CoverTree:
    """Points in an order in which every node is a range; centre, radius, range and children of each node."""

    def __init__(self, points: np.ndarray) -> None:
        self.order = np.arange(len(points))
        self.center: list[np.ndarray] = []
        self.radius: list[float] = []
        self.norm: list[float] = []
        self.range: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        if len(points):
            self._add(points, 0, len(points), points[0])
        self.centers = np.array(self.center).reshape(len(self.center), points.shape[1])
        self.radii, self.norms = np.array(self.radius), np.array(self.norm)

    def _add(self, points: np.ndarray, lo: int, hi: int, center: np.ndarray) -> int:
        todo: list[tuple[int, int, np.ndarray, int | None]] = [(lo, hi, center, None)]
        while todo:
            lo, hi, center, parent = todo.pop()
            at, own = len(self.center), self.order[lo:hi]
            far = np.linalg.norm(points[own] - center, axis=1)
            radius = float(far.max())
            self.center.append(center)
            self.radius.append(radius)
            self.norm.append(float(np.linalg.norm(center)))
            self.range.append((lo, hi))
            self.children.append([])
            if parent is not None:
                self.children[parent].append(at)
            if hi - lo <= LEAF or not radius > 0 or not math.isfinite(radius):
                continue
            nearest, owner, centers = far, np.zeros(hi - lo, int), [center]
            while len(centers) < FANOUT and nearest.max() > radius / 2:
                c = points[own[int(nearest.argmax())]]
                d = np.linalg.norm(points[own] - c, axis=1)
                closer = d < nearest
                owner[closer], nearest = len(centers), np.minimum(nearest, d)
                centers.append(c)
            by = np.argsort(owner, kind="stable")
            self.order[lo:hi] = own[by]
            sizes = np.bincount(owner, minlength=len(centers))
            start = lo
            for c, n in zip(centers, sizes):
                if n:
                    todo.append((start, start + int(n), c, at))
                start += int(n)
        return 0


class Best:
    """The k highest (score, -id) of each query so far."""

    def __init__(self, floors: np.ndarray, k: int) -> None:
        n = len(floors)
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = floors  # a score that k candidates elsewhere reach, or minus infinity

    def worst(self, rows: np.ndarray) -> float:
        return float(np.maximum(self.scores[rows, -1], self.floor[rows]).min())

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, banned: np.ndarray) -> None:
        s = np.where(banned | (scores < self.floor[rows, None]), -np.inf, scores)
        hit = (s.max(axis=1) >= self.scores[rows, -1]) & (s.max(axis=1) > -np.inf)
        if not hit.any():
            return
        rows, s = rows[hit], s[hit]
        both = np.concatenate([self.scores[rows], s], axis=1)
        names = np.concatenate([self.ids[rows], np.where(np.isneginf(s), np.iinfo(np.int64).max, ids[None, :])], axis=1)
        top = np.lexsort((names, -both), axis=-1)[:, : self.k]
        self.scores[rows], self.ids[rows] = np.take_along_axis(both, top, 1), np.take_along_axis(names, top, 1)


def search(queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int) -> Best:
    """The k best data rows of every query by walking both cover trees; ids equal to the query's own are left out."""
    best = Best(floors, k)
    if not len(queries) or not len(data):
        return best
    a, b = CoverTree(queries), CoverTree(data)

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            top = b.centers[nodes] @ a.centers[q] + a.radii[q] * b.norms[nodes] + b.radii[nodes] * a.norms[q] + a.radii[q] * b.radii[nodes]
            return top + np.abs(top) * 1e-9 + 1.0

    todo = [(0, np.zeros(1, int))]
    while todo:
        q, front = todo.pop()
        rows = a.order[slice(*a.range[q])]
        while True:
            top = bounds(q, front)
            keep = ~(top < best.worst(rows))
            front, top = front[keep], top[keep]
            wide = [n for n in front if b.children[n] and (not a.children[q] or b.radii[n] >= a.radii[q])]
            if not wide:
                break
            flat = set(wide)
            front = np.array([n for n in front if n not in flat] + [c for n in wide for c in b.children[n]], int)
        if a.children[q]:
            todo += [(c, front) for c in a.children[q]]
            continue
        for n in front[np.argsort(-top, kind="stable")]:
            if bounds(q, np.array([n]))[0] < best.worst(rows):
                continue
            own = b.order[slice(*b.range[n])]
            best.offer(rows, queries[rows] @ data[own].T, ids[own], query_ids[rows][:, None] == ids[own][None, :])
    return best


def exact_search(query: list[int], query_id: int, data: list[list[int]], ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The same for integers whose products no double holds: every row in Python integers, as (id, score)."""
    scored = ((max(-LONG, min(LONG - 1, sum(x * y for x, y in zip(query, v)))), i) for v, i in zip(data, ids.tolist()) if i != query_id)
    return [(i, s) for s, i in heapq.nsmallest(k, scored, key=lambda p: (-p[0], p[1]))]


def _clean(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    v = F.col(vec_col)
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return df.where(F.col(id_col).isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), whole.alias("x"))


def _celled(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Adds the cell (the nearest pivot of the same length) and the distance to it."""

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            xs, n = batch.column(1), len(batch)
            size = np.array([len(x) for x in xs], int)
            cell, dist = np.zeros(n, np.int64), np.zeros(n)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                x = np.array([xs[i].as_py() for i in at], np.float64).reshape(len(at), d)
                p = pivots.get(int(d), np.zeros((1, d)))
                with np.errstate(all="ignore"):
                    far = np.sqrt(np.maximum((x**2).sum(1)[:, None] - 2 * x @ p.T + (p**2).sum(1)[None, :], 0))
                near = np.argmin(np.nan_to_num(far, nan=np.inf), axis=1)
                cell[at], dist[at] = d * PIVOTS + near, np.linalg.norm(x - p[near], axis=1)
            yield {"id": batch.column(0), "x": xs, "cell": cell, "dist": dist}

        return work

    return map_rows(rows, make, "id long, x array<long>, cell long, dist double")


def _blocked(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Adds the block of each row: its cell, cut by a hash of the id into parts of about BLOCK rows."""
    counts = rows.groupBy("cell").agg(F.count("*").alias("n"))
    parts = checkpointed(counts.select("cell", F.ceil(F.col("n") / BLOCK).alias("parts")))
    total = parts.agg(F.sum("parts")).first()[0] or 0
    few = F.broadcast(parts) if parts.limit(100_001).count() <= 100_000 else parts  # cells: at most 256 for each length of vectors
    part = F.pmod(F.xxhash64("id", F.lit(name)), F.col("parts"))
    return rows.join(few, "cell").withColumn(name, F.col("cell") * (1 << 30) + part).drop("parts"), int(total)


def _pair_search(k: int):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"qk": [], "query_id": [], "vec_id": [], "score": []}
        right = right.select(["id", "x"])
        if left.num_rows and right.num_rows:
            q, v = left.column("x").to_pylist(), right.column("x").to_pylist()
            qid, vid, qk = left.column("qid").to_numpy(), right.column("id").to_numpy(), left.column("qk").to_numpy()
            floors = left.column("floor").to_numpy()
            most = lambda xs: max((max(map(abs, x), default=0) for x in xs), default=0)
            d = len(q[0])
            if most(q) * most(v) * max(d, 1) < EXACT and most(q) < EXACT and most(v) < EXACT:
                best = search(np.array(q, float).reshape(len(q), d), qid, floors, np.array(v, float).reshape(len(v), d), vid, k)
                full = ~np.isneginf(best.scores)
                row, _ = np.nonzero(full)
                out = {"qk": qk[row], "query_id": qid[row], "vec_id": best.ids[full], "score": best.scores[full].astype(np.int64)}
            else:
                for name, one, x in zip(qk.tolist(), qid.tolist(), q):
                    for vec, score in exact_search(x, one, v, vid, k):
                        for n, c in zip(out, (name, one, vec, score)):
                            out[n].append(c)
        return pa.table({n: pa.array(c, pa.int64()) for n, c in out.items()})

    return run


def top_k(rows: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of every query row with other rows."""
    spark = rows.sparkSession
    data = _clean(rows, id_col, vec_col, scale)
    asked = _clean(rows.where(is_query), id_col, vec_col, scale).distinct()
    n = data.count()
    wanted = max(1, min(PIVOTS, math.ceil(n / BLOCK)))
    pivots: dict[int, list] = {}
    for r in data.orderBy(F.xxhash64("id"), "id").limit(wanted).collect():  # at most PIVOTS rows
        pivots.setdefault(len(r["x"]), []).append(r["x"])
    held = {d: np.array(p, float).reshape(len(p), d) for d, p in pivots.items()}
    data, blocks = _blocked(checkpointed(_celled(data, held)), "block")
    asked, chunks = _blocked(checkpointed(_celled(asked, held)), "chunk")
    if not blocks or not chunks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    data, asked = checkpointed(data), checkpointed(asked.withColumn("qk", F.monotonically_increasing_id()))

    # One row for each pair of a chunk and a block of the same length, with the bound of their roots.
    mine = data.groupBy("block", "cell").agg(F.max("dist").alias("r_b"))
    theirs = asked.groupBy("chunk", "cell").agg(F.max("dist").alias("r_c"))
    shelves = max(1, math.ceil(blocks / 256))
    shelf = mine.withColumn("shelf", F.pmod(F.xxhash64("block"), F.lit(shelves)).cast("int"))
    spread = theirs.withColumnRenamed("cell", "cell_c").withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))))
    pairs = checkpointed(spread.join(shelf, "shelf").where(F.floor(F.col("cell") / PIVOTS) == F.floor(F.col("cell_c") / PIVOTS)))
    norms = {d: (p @ p.T).tolist() for d, p in held.items()}
    products = spark.createDataFrame(
        [(d * PIVOTS + i, d * PIVOTS + j, float(m[i][j]), math.sqrt(m[i][i]), math.sqrt(m[j][j])) for d, m in norms.items() for i in range(len(m)) for j in range(len(m))],
        "cell long, cell_c long, dot double, norm_b double, norm_c double",
    )  # at most PIVOTS squared rows
    bound = F.col("dot") + F.col("r_c") * F.col("norm_b") + F.col("r_b") * F.col("norm_c") + F.col("r_b") * F.col("r_c")
    pairs = pairs.join(F.broadcast(products), ["cell", "cell_c"], "left").withColumn("bound", bound + F.abs(bound) * 1e-9 + 1.0).select("chunk", "block", "cell", "cell_c", "bound")

    def met(chosen: DataFrame, floors: DataFrame) -> DataFrame:
        left = asked.join(floors, "qk", "left").select("qk", F.col("id").alias("qid"), "x", "chunk", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
        left = left.join(chosen.select("chunk", "block"), "chunk").select("qk", "qid", "x", "floor", "chunk", "block")
        right = data.join(chosen.select("chunk", "block"), "block").select("id", "x", "chunk", "block")
        return left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(_pair_search(k), "qk long, query_id long, vec_id long, score long")

    own = F.col("cell") == F.col("cell_c")
    first_of = pairs.where(own).groupBy("chunk").agg(F.min("block").alias("block"))
    none = spark.createDataFrame([], "qk long, floor double")
    first = checkpointed(met(first_of, none))
    kth = first.groupBy("qk").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("floor")).where(F.col("n") >= k).select("qk", "floor")
    kth = checkpointed(kth)
    worst = asked.join(kth, "qk", "left").groupBy("chunk").agg(F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("worst"))
    rest = pairs.join(first_of, ["chunk", "block"], "left_anti").join(worst, "chunk").where(F.col("bound").isNull() | F.isnan("bound") | (F.col("bound") >= F.col("worst")))
    found = first.unionByName(met(checkpointed(rest.select("chunk", "block")), kth))  # a query and a row meet once
    from pyspark.sql import Window

    by = Window.partitionBy("qk").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
