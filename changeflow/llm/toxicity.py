"""Operator 6: toxicity by the nearest labelled examples.

Method: examples and documents are TF-IDF vectors over all words of the examples. A weight is
``(1 + ln tf) * ln(N / df) * gain``, where the gain is the information that a word's presence gives on the
label, counted by the different words to its left at most, so that copies of one passage lend it none. No
word is left out: one that tells nothing has a small weight. (Without the gain the nearest examples are
those of like ordinary words; README has the figures.) The examples stand in an inverted index. For a
document the postings of its rarer words are added up; those of common words are cut into blocks of
``BLOCK`` like examples with the largest weight of each word, and are opened only for examples whose sum,
together with the block maxima, reaches the kth cosine so far. Cosines of neighbours are exact. Votes are weighted by
``1 / (SOFT + 1 - cosine)`` with a prior vote for the share of toxic rows. A logistic curve, fitted on
votes of examples under models of the other folds, turns votes into scores: the probability of label 1
among rows of which the part ``PRIOR`` is toxic, for missing a toxic document costs more than a second
look at a clean one.

Fit: at most ``PER_CLASS`` rows of each label, the first by a hash of the id, and of each label at most
``CHARS`` characters, rows that would go beyond left out: the documented bounds of the sample and of the
index that is broadcast. Fitting scans the documents once. Tasks cut the examples' texts into words, Spark
counts these, and the votes of each fold come from a task of its own; the driver gets no text, only word
counts and vectors as flat arrays, and computes nothing of the size of the sample. Scoring is one pass
without a shuffle; a task holds the index, a slice of a batch and a bounded memory of words.

Defined results: a row with a null id is scored like others and never learnt; null and empty texts have no words and get the score of examples without words; very long
texts are read whole; without examples of both labels the score is the share of toxic rows (0 without
rows); label rows whose document or label is missing are left out, an id with several labels counts as
toxic if one says so, and of several texts of one id the first in order is the example; equal cosines go
to the example that stands first in the index; rows that repeat come out as often; an empty table gives an
empty table; the score reads the text only; other columns are ignored.
"""

from __future__ import annotations

import gc
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import Memory, arrow_schema, checkpointed, cuts_of, give_back, leave_state, map_rows, worker_state

PER_CLASS, CHARS = 2000, 1 << 23
NEIGHBOURS, SOFT, PRIOR_VOTE, BLOCK = 9, 0.1, 0.5, 32
#: Entries of each generation of the memory of cuts in a Python worker, and texts that are read at once.
REMEMBERED, SLICE = 150_000, 512
#: Words of over a fourth of the examples are common ones; the curve's votes come from so many folds; the share of toxic rows that scores are calibrated to.
COMMON, FOLDS, PRIOR = 4, 4, 0.3
WORD = re.compile(r"\w+")


def gains(with_word: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The information (nats) on the class that the presence of each word gives: counts by class and word, and rows of each class."""

    def entropy(counts: np.ndarray) -> np.ndarray:
        whole = np.maximum(counts.sum(0), 1e-300)
        share = counts / whole
        return -(share * np.log(np.where(share > 0, share, 1.0))).sum(0)

    n = of.sum()
    there = with_word.sum(0)
    rest = of[:, None] - with_word
    return np.maximum(0.0, entropy(of[:, None])[0] - there / n * entropy(with_word) - (n - there) / n * entropy(rest))


@dataclass
class Model:
    """The examples' vectors; every field is bounded by PER_CLASS and CHARS."""

    share: float
    words: pa.Array = field(default_factory=lambda: pa.array([], pa.string()))
    weight: np.ndarray = field(default_factory=lambda: np.empty(0))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    toxic: np.ndarray = field(default_factory=lambda: np.empty(0))
    begin: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    at: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.empty(0))
    curve: tuple[float, float] | None = None
    bare: float = 0.0
    token: str = field(default_factory=lambda: uuid.uuid4().hex)

    def vector(self, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit vector of word counts: word numbers and weights, or nothing if no word weighs."""
        w = (1 + np.log(n)) * self.weight[at]
        norm = math.sqrt(float(w @ w))
        return (at, w / norm) if norm > 0 else (at[:0], w[:0])


class Counts:
    """The word counts of examples as flat arrays, by example and number of the word, and models of parts of them."""

    def __init__(self, words: pa.Array, ids: np.ndarray, toxic: np.ndarray, owner: np.ndarray, word: np.ndarray, n: np.ndarray) -> None:
        self.words, self.ids, self.toxic, self.owner, self.word, self.n = words, ids, toxic, owner, word, n
        self.fold = np.empty(len(ids), np.int64)
        self.fold[np.lexsort((ids, toxic))] = np.arange(len(ids)) % FOLDS

    def units(self, part: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The unit vectors of the examples of ``part``, a mask: examples, words and values; and each example's word of most weight, -1 for none."""
        some = part[self.owner]
        owner, word = self.owner[some], self.word[some]
        w = (1 + np.log(self.n[some])) * weight[word]
        norm = np.sqrt(np.bincount(owner, w * w, len(self.ids)))
        on = w > 0
        owner, word, value = owner[on], word[on], w[on] / norm[owner[on]]
        top = np.full(len(self.ids), -1)
        by = np.lexsort((value, owner))
        last = by[np.flatnonzero(np.r_[owner[by][1:] != owner[by][:-1], True])] if len(by) else by
        top[owner[last]] = word[last]
        return owner, word, value, top

    def model(self, part: np.ndarray, share: float, weight: np.ndarray) -> Model:
        """The model of the examples of ``part``, without a curve."""
        model = Model(share, self.words, weight)
        owner, word, value, top = self.units(part, weight)
        # Like examples stand together, so that blocks differ in their maxima: by label and word of most weight.
        order = np.lexsort((self.ids, top, self.toxic))
        order = order[part[order]]
        place = np.empty(len(self.ids), np.int64)
        place[order] = np.arange(len(order))
        by = np.lexsort((word, place[owner]))
        model.ids, model.toxic = self.ids[order], self.toxic[order].astype(float)
        model.begin = np.r_[0, np.cumsum(np.bincount(place[owner], minlength=len(order)))]
        model.at, model.value = word[by].astype(np.int32), value[by]
        return model

    def vectors(self, part: np.ndarray, model: Model) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
        """The vectors that the examples of ``part`` have under a model."""
        edges = np.searchsorted(self.owner, np.arange(len(self.ids) + 1))
        for i in np.flatnonzero(part):
            yield i, model.vector(self.word[edges[i] : edges[i + 1]], self.n[edges[i] : edges[i + 1]])

    def votes(self, part: np.ndarray, index: Index) -> np.ndarray:
        """The votes on the examples of ``part`` by an index; -1 for no neighbours, and for the others."""
        votes = np.full(len(self.ids), -1.0)
        for i, v in self.vectors(part, index.model):
            cos, who = index.neighbours(*v)
            if len(cos):
                votes[i] = index.vote(cos, who)
        return votes


def weights(have: np.ndarray, apart: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The weight of each word: examples with it and different words to its left, by class and word, and examples of each class."""
    return np.log(of.sum() / np.maximum(have.sum(0), 1)) * gains(np.minimum(have, apart), of)


class Sample(Counts):
    """The words of examples that are at hand as Python rows."""

    def __init__(self, rows: list[tuple[int, int, str]]) -> None:
        number: dict[str, int] = {}
        words, sizes = [], []
        for _, _, text in rows:
            own = [number.setdefault(w, len(number)) for w in WORD.findall(text.lower())]
            words += own
            sizes.append(len(own))
        size = max(1, len(number))
        word, owner = np.array(words, np.int64), np.repeat(np.arange(len(rows)), sizes)
        left = np.r_[size, word[:-1]] if len(word) else word
        left[np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])[: len(word)]] = size
        keys, n = np.unique(owner * size + word, return_counts=True)
        super().__init__(pa.array(list(number), pa.string()), np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), *np.divmod(keys, size), n)
        #: (left word, word) of each example, once each.
        self.pairs = np.unique(np.stack([owner, word * (size + 1) + left], 1), axis=0) if len(word) else np.empty((0, 2), np.int64)

    def weights(self, part: np.ndarray) -> np.ndarray:
        """The weight of each word by the examples of ``part``, a mask."""
        size, on = len(self.words), part[self.owner]
        have = np.stack([np.bincount(self.word[on & (self.toxic[self.owner] == y)], minlength=size) for y in (0, 1)]).astype(float)
        mine = self.pairs[part[self.pairs[:, 0]]]
        apart = np.stack([np.bincount(np.unique(mine[self.toxic[mine[:, 0]] == y, 1]) // (size + 1), minlength=size) for y in (0, 1)])
        return weights(have, apart, np.array([np.sum(part & (self.toxic == y)) for y in (0, 1)], float))

    def model(self, part: np.ndarray, share: float) -> Model:
        return super().model(part, share, self.weights(part))


def build(rows: list[tuple[int, int, str]], share: float) -> Model:
    """The model of (id, toxic, text) examples in one process, as ``fit`` makes it; without both labels only the share.

    The curve is fitted on votes under models of the other folds, which saw neither the example nor its words.
    """
    sample = Sample(rows)
    if not (sample.toxic == 0).any() or not sample.toxic.any():
        return Model(share)
    model = sample.model(np.ones(len(rows), bool), share)
    votes = np.full(len(rows), -1.0)
    for k in range(FOLDS):
        votes = np.maximum(votes, sample.votes(sample.fold == k, Index(sample.model(sample.fold != k, share))))
    return calibrated(model, votes, sample.toxic.astype(float))


def calibrated(model: Model, votes: np.ndarray, y: np.ndarray) -> Model:
    """The model with the curve of votes (-1: none) on examples of labels ``y``."""
    weight = np.where(y > 0, PRIOR / y.mean(), (1 - PRIOR) / (1 - y.mean()))
    none = votes < 0
    model.bare = float(((weight * y)[none].sum() + PRIOR) / (weight[none].sum() + 1))
    model.curve = logistic(votes[~none], y[~none], weight[~none])
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the weighted logistic regression of y on x with a penalty of half the squared slope; slopes below 0 are 0."""

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum()) + a * a / 2 + 1e-6 * b * b

    a = b = 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        g, h = weight * (p - y), weight * p * (1 - p)
        da, db = np.linalg.solve([[(h * x * x).sum() + 1, (h * x).sum()], [(h * x).sum(), h.sum() + 2e-6]], [(g * x).sum() + a, g.sum() + 2e-6 * b])
        step, now = 1.0, loss(a, b)
        while step > 1e-6 and loss(a - step * da, b - step * db) > now:
            step /= 2
        a, b = a - step * da, b - step * db
        if abs(da) + abs(db) < 1e-10:
            break
    return max(0.0, float(a)), float(b)


class Index:
    """A model's inverted index with block maxima, and its search.

    Postings of rare words are read whole. Those of common words are cut into blocks of BLOCK examples with
    the largest weight in each, and are opened only for examples whose part from rare words and block maxima
    reaches the kth cosine; so no common word's list is read for the others, and no cosine is estimated.
    """

    def __init__(self, model: Model) -> None:
        self.model, n, size = model, len(model.ids), len(model.words)
        blocks = -(-n // BLOCK)
        example = np.repeat(np.arange(n), np.diff(model.begin))
        frequent = np.bincount(model.at, minlength=size) >= max(BLOCK, n // COMMON)
        self.row = np.full(size, -1, np.int64)
        self.row[frequent] = np.arange(int(frequent.sum()))
        is_common = frequent[model.at]
        #: Common words by example, and the maxima of blocks.
        self.common = np.zeros((n, int(frequent.sum())))
        self.common[example[is_common], self.row[model.at[is_common]]] = model.value[is_common]
        padded = np.zeros((blocks * BLOCK, self.common.shape[1]))
        padded[:n] = self.common
        self.maxima = np.ascontiguousarray(padded.reshape(blocks, BLOCK, self.common.shape[1]).max(1).T)
        self.block = np.arange(n) // BLOCK
        by = np.argsort(model.at[~is_common], kind="stable")
        self.example, self.value = example[~is_common][by], model.value[~is_common][by]
        self.begin = np.r_[0, np.cumsum(np.bincount(model.at[~is_common], minlength=size))]

    def neighbours(self, at: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(cosines, examples): the k of highest cosine over zero, ties to the earlier one."""
        n = len(self.model.ids)
        if not len(at) or not n:
            return np.empty(0), np.empty(0, np.int64)
        row = self.row[at]
        often = row >= 0
        lo, hi = self.begin[at], self.begin[at + 1]
        m = hi - lo
        entries = np.repeat(lo - np.cumsum(m) + m, m) + np.arange(int(m.sum()))
        part = np.bincount(self.example[entries], np.repeat(w, m) * self.value[entries], n)
        row, weight = row[often], w[often]
        bound = part + (weight @ self.maxima[row])[self.block]
        kth = np.partition(part, n - k)[n - k] if n > k else 0.0
        who = np.flatnonzero((bound >= kth - 1e-11) & (bound > 0))
        while len(who) > 4 * k:  # the best by bound tell a closer kth
            first = who[np.argpartition(-bound[who], 2 * k)[: 2 * k]]
            exact = part[first] + self.common[first[:, None], row] @ weight
            closer = np.partition(exact, k)[k]
            fewer = who[bound[who] >= closer - 1e-11]
            if closer <= kth or len(fewer) == len(who):
                break
            who, kth = fewer, closer
        cos = np.round(part[who] + self.common[who[:, None], row] @ weight, 12)
        who, cos = who[cos > 0], cos[cos > 0]
        best = np.lexsort((who, -cos))[:k]
        return cos[best], who[best]

    def vote(self, cos: np.ndarray, who: np.ndarray) -> float:
        """The distance-weighted share of toxic neighbours, with a prior vote."""
        w = 1 / (SOFT + 1 - np.minimum(cos, 1.0))
        return float((PRIOR_VOTE * self.model.share + w @ self.model.toxic[who]) / (PRIOR_VOTE + w.sum()))


def learnable(id_col: str | Column = "doc_id") -> Column:
    """Rows whose labels may be learnt: crc32 of the id as text, modulo 3, is not 1."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % 3 != 1


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = PER_CLASS, chars: int = CHARS) -> Model:
    """The model of at most ``per_class`` rows and ``chars`` characters of each label among those that may be learnt."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & learnable(id_col)).groupBy(F.col(id_col).cast("long").alias("lid")).agg(F.max(F.when(F.col(label_col) > 0, 1).otherwise(0)).alias("y"))
    known = checkpointed(known)
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if len(sizes) < 2:
        return Model(share)
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("lid"), "lid").limit(per_class) for y in (0, 1)]
    chosen = checkpointed(parts[0].unionByName(parts[1]))
    # At most two times per_class rows of two numbers: the documents' scan needs no shuffle.
    texts = docs.where(F.col(text_col).isNotNull()).join(F.broadcast(chosen), F.col(id_col).cast("long") == F.col("lid")).groupBy("lid", "y").agg(F.min(text_col).alias("t"))
    texts = checkpointed(texts.where(F.length("t") <= chars))
    # Windows over so many rows of numbers; texts stay where they are.
    upto = Window.partitionBy("y").orderBy(F.xxhash64("lid"), "lid")
    bounded = texts.select("lid", "y", F.length("t").alias("size")).withColumn("upto", F.sum("size").over(upto)).where(F.col("upto") <= chars)
    place = lambda *by: F.row_number().over(Window.orderBy(*by)) - 1
    ranked = checkpointed(bounded.select("lid", "y", place("lid").alias("rank"), (place("y", "lid") % FOLDS).alias("fold")))
    of = np.zeros((2, FOLDS))
    for r in ranked.groupBy("y", "fold").agg(F.count("*").alias("n")).collect():
        of[r["y"], r["fold"]] = r["n"]
    if not of.sum(1).all():
        return Model(share)
    words = texts.join(F.broadcast(ranked.select("lid", "rank", "fold")), "lid").select("rank", "y", "fold", "t")
    words = words.repartition(texts.sparkSession.sparkContext.defaultParallelism, "rank").mapInArrow(_words, WORDS).persist(StorageLevel.DISK_ONLY)
    try:
        return _fitted(ranked, words, np.c_[of.sum(1)[:, None] - of, of.sum(1)], share)
    finally:
        words.unpersist()
        gc.collect()
        give_back()


#: The words of an example, once each: where the word is met (example, position), how often, and the different words to its left (the first word has an empty one).
WORDS = "rank int, y int, fold int, met long, word string, n int, left array<string>"


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    leave_state()
    for batch in batches:
        for rank, y, fold, text in zip(*(c.to_pylist() for c in batch.columns)):
            number: dict[str, int] = {}
            word = np.array([number.setdefault(w, len(number)) for w in WORD.findall(text.lower())], np.int64)
            if not (size := len(number)):
                continue
            names = pa.array([*number, ""], pa.string())
            _, first, n = np.unique(word, return_index=True, return_counts=True)
            of, left = np.divmod(np.unique(word * (size + 1) + np.r_[size, word[:-1]]), size + 1)
            lists = pa.ListArray.from_arrays(np.searchsorted(of, np.arange(size + 1)).astype(np.int32), names.take(pa.array(left)))
            one = [pa.array(np.full(size, v, np.int32)) for v in (rank, y, fold)]
            yield pa.RecordBatch.from_arrays([*one, pa.array((rank << 32) + first), names[:size], pa.array(n.astype(np.int32)), lists], ["rank", "y", "fold", "met", "word", "n", "left"])


def _fitted(ranked: DataFrame, words: DataFrame, of: np.ndarray, share: float) -> Model:
    """The model of ``ranked`` examples with ``words``; ``of`` counts those of each class without each fold, and lastly all."""
    # Each count without each fold, and lastly of all: one pass gives the weights of all models.
    without = [(y, k) for y in (0, 1) for k in range(FOLDS + 1)]
    have = words.groupBy("word").agg(F.min("met").alias("met"), F.array(*[F.count_if((F.col("y") == y) & (F.col("fold") != k)) for y, k in without]).alias("have"))
    lefts = words.select("word", "y", F.explode("left").alias("l"), F.expr("shiftleft(1, fold)").alias("folds")).groupBy("word", "y", "l").agg(F.bit_or("folds").alias("folds"))
    apart = lefts.groupBy("word").agg(F.array(*[F.count_if((F.col("y") == y) & (F.col("folds").bitwiseAND(~(1 << k)) != 0)) for y, k in without]).alias("apart"))

    def make():
        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            have, apart = (np.asarray(batch.column(c).flatten()).reshape(-1, 2, FOLDS + 1).astype(float) for c in (2, 3))
            of_all = [weights(have[:, :, k].T, apart[:, :, k].T, of[:, k]) for k in range(FOLDS + 1)]
            yield {"met": batch.column(0), "word": batch.column(1)} | {f"w{k}": w for k, w in enumerate(of_all)}

        return work

    weighed = map_rows(have.join(apart, "word").select("met", "word", "have", "apart"), make, "met long, word string, " + ", ".join(f"w{k} double" for k in range(FOLDS + 1)))
    # Words are numbered as they are met; the driver gets numbers, and each different word once.
    of_words = weighed.orderBy("met").toArrow()
    met, weight = of_words["met"].to_numpy(), [of_words[f"w{k}"].to_numpy() for k in range(FOLDS + 1)]
    names = pa.concat_arrays(of_words["word"].chunks) if len(met) else pa.array([], pa.string())
    del of_words
    entries = words.select("rank", F.min("met").over(Window.partitionBy("word")).alias("met"), "n").orderBy("rank", "met").toArrow()
    who = ranked.select("lid", "y").orderBy("rank").toArrow()
    counts = Counts(names, who["lid"].to_numpy(), who["y"].to_numpy(), entries["rank"].to_numpy(), np.searchsorted(met, entries["met"].to_numpy()).astype(np.int32), entries["n"].to_numpy())
    del entries
    held, token = ranked.sparkSession.sparkContext.broadcast((counts, weight)), uuid.uuid4().hex
    del counts, met
    out = arrow_schema(VECTORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, weight = held.value
            rank = np.asarray(batch.column(0))
            mine = np.isin(np.arange(len(counts.ids)), rank)
            votes = np.full(len(counts.ids), -1.0)
            for k in np.unique(counts.fold[rank]):
                index = worker_state(("votes", token, k), lambda: Index(counts.model(counts.fold != k, share, weight[k])))
                votes = np.maximum(votes, counts.votes(mine & (counts.fold == k), index))
            owner, word, value, top = counts.units(mine, weight[FOLDS])
            # Examples in the order of their numbers, as the entries are.
            rank = np.flatnonzero(mine)
            ends = pa.array(np.searchsorted(owner, np.r_[rank, len(counts.ids)]).astype(np.int32))
            columns = [counts.ids[rank], counts.toxic[rank], top[rank], votes[rank], pa.ListArray.from_arrays(ends, pa.array(word.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(value))]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c).cast(f.type) for c, f in zip(columns, out)], schema=out)

    # Like examples stand together, as in ``Counts.model``.
    found = ranked.select("rank", "fold").repartitionByRange(FOLDS, "fold").mapInArrow(run, VECTORS).orderBy("y", "top", "lid").toArrow()
    held.destroy()
    y = found["y"].to_numpy().astype(float)
    flat = lambda c: np.concatenate([x.flatten().to_numpy() for x in found[c].chunks])
    begin = np.r_[0, np.cumsum(np.concatenate([x.value_lengths().to_numpy() for x in found["at"].chunks]))]
    ids = found["lid"].to_numpy()
    by = np.argsort(ids)
    return calibrated(Model(share, names, weight[FOLDS], ids, y, begin, flat("at"), flat("value")), found["vote"].to_numpy()[by], y[by])


#: The unit vectors of examples and the votes on them.
VECTORS = "lid long, y int, top int, vote double, at array<int>, value array<double>"


class Scorer:
    """Scores texts by a model, with a bounded memory of the words of blank-separated cuts."""

    def __init__(self, model: Model) -> None:
        self.model, self.index, self.known = model, Index(model), Memory(REMEMBERED)
        some = np.flatnonzero(model.weight > 0)
        self.number = dict(zip(model.words.take(pa.array(some)).to_pylist(), some.tolist()))

    def vectors(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The numbers of each text's words and their counts."""
        cuts, codes, ends = cuts_of(texts)
        self.known.turn()
        known, recall, number, own = self.known.young, self.known.recall, self.number, []
        for cut in cuts:
            found = known.get(cut)
            if found is None and (found := recall(cut)) is None:
                found = known[cut] = tuple([number[w] for w in WORD.findall(cut.lower()) if w in number])
            own.append(found)
        n = np.fromiter(map(len, own), np.int64, len(own))
        flat = np.fromiter((t for f in own for t in f), np.int64, int(n.sum()))
        begin, m = np.cumsum(n) - n, n[codes]
        words = flat[np.repeat(begin[codes] - np.cumsum(m) + m, m) + np.arange(int(m.sum()))]
        text = np.repeat(np.repeat(np.arange(len(texts)), np.diff(ends)), m)
        size = max(1, len(self.model.words))
        keys, counts = np.unique(text * size + words, return_counts=True)
        edges = np.searchsorted(keys, np.arange(len(texts) + 1) * size)
        for a, b in zip(edges[:-1], edges[1:]):
            yield keys[a:b] % size, counts[a:b]

    def scores(self, texts: pa.Array) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """The calibrated score of each text, and the cosines and numbers of the neighbours behind it."""
        none = np.empty(0), np.empty(0, np.int64)
        if self.model.curve is None:
            yield from ((self.model.share if self.model.ids.size == 0 else self.model.bare, *none) for _ in range(len(texts)))
            return
        for k in range(0, len(texts), SLICE):
            give_back()
            for at, n in self.vectors(texts.slice(k, SLICE)):
                cos, who = self.index.neighbours(*self.model.vector(at, n))
                slope, offset = self.model.curve
                yield (1 / (1 + math.exp(-slope * self.index.vote(cos, who) - offset)) if len(cos) else self.model.bare), cos, who


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, evidence): evidence holds the neighbours' ids, labels and cosines, nearest first."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by PER_CLASS and CHARS

    def make():
        scorer = worker_state(("toxicity", held.value.token), lambda: Scorer(held.value))

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            m, found = scorer.model, list(scorer.scores(batch.column(1)))
            ends = np.r_[0, np.cumsum([len(c) for _, c, _ in found])].astype(np.int32)
            who = np.concatenate([w for _, _, w in found]) if found else np.empty(0, np.int64)
            near = pa.StructArray.from_arrays([pa.array(m.ids[who], pa.int64()), pa.array(m.toxic[who].astype(np.int32)), pa.array(np.concatenate([c for _, c, _ in found]) if found else [], pa.float64())], ["doc_id", "toxic", "cosine"])
            yield {id_col: batch.column(0), "score": [s for s, _, _ in found], "evidence": pa.ListArray.from_arrays(pa.array(ends), near)}

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, score double, evidence array<struct<doc_id:long,toxic:int,cosine:double>>")


def reject(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score stays under the threshold, all columns as they are."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_state(("toxicity", held.value.token), lambda: Scorer(held.value))
        for batch in batches:
            yield batch.filter(pa.array([s < threshold for s, _, _ in scorer.scores(batch.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
