"""Operator 11: runs of repeated word sequences in texts, and texts without the repeats.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and ``TIMES`` periods long, that
no neighbouring word extends with this period.

Method (Main and Lorentz): words become numbers. A stretch is halved; runs across its middle with period p
are told by how far the text agrees with itself at a distance of p, onwards and backwards from the middle,
which Z-functions of both halves say for all p in one pass. Halves are treated likewise, down to stretches
too short for a run. A run lies whole in the first stretch whose middle it crosses, so only periods of up to
a quarter of the stretch are looked at, and what could still be extended beyond a stretch is a piece of a run
found elsewhere and goes. Intervals that several periods give keep the smallest: all others are multiples.

Before that, stretches are cut where no run can be: each word of a run occurs ``TIMES`` times in it at
least, so words that occur less often in a stretch part it, and this is repeated while it helps. Ordinary
prose falls apart so in a few passes over arrays, and loses no run.

Distribution: one pass without a shuffle; texts are independent. A task holds the texts of one slice of a
batch, by characters, and a very long text alone; time is n log n of what the cuts leave.

Defined results: words are maximal runs of characters other than ASCII blanks; null and empty texts have no
words, no run and an empty text left; very long texts are treated whole; of runs with equal length by period
the first one is the strongest, then the one with the smaller period; repeated rows come out as often; an
empty table gives an empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from changeflow.llm.common import give_back, leave_state, map_rows

#: Words and periods of a run at least.
LEAST, TIMES = 6, 4
#: Bytes of text that a task treats at once; a longer text stands alone.
SLICE = 1 << 22


def z_function(s: list[int], upto: int) -> list[int]:
    """For each i up to ``upto``: how many words at i agree with those at the beginning."""
    n, z, left, right = len(s), [0] * (upto + 1), 0, 0
    for i in range(1, upto + 1):
        k = 0
        if i < right:
            k = z[i - left]
            if k > right - i:
                k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def agreements(s: list[int], z: list[int], t: list[int]) -> list[int]:
    """For each i: how many words of ``t`` at i agree with those at the beginning of ``s``, whose Z-function up to the length of ``t`` is ``z``."""
    n, m, found, left, right = len(s), len(t), [], 0, 0
    for i in range(m):
        k = 0
        if i < right:
            k = z[i - left]
            if k > right - i:
                k = right - i
        while i + k < m and k < n and s[k] == t[i + k]:
            k += 1
        found.append(k)
        if i + k > right:
            left, right = i, i + k
    return found


def runs_of(s: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence of numbers, by start, then period."""
    n, found, todo = len(s), {}, [(0, len(s))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < LEAST:
            continue
        mid, most = (lo + hi) // 2, (hi - lo) // TIMES
        todo += [(lo, mid), (mid, hi)]
        after, before = s[mid:hi], s[lo:mid][::-1]
        # Agreement at a distance of p: from the middle onwards (on) and backwards (back), of words on one side,
        # and of the p words on one side of the middle with those on the other.
        on, back = z_function(after, min(most, len(after))), z_function(before, min(most, len(before)))
        ahead = agreements(after, on, before[:most][::-1])
        behind = agreements(before, back, after[:most][::-1])
        for p in range(1, most + 1):
            over, under = ahead[-p], behind[-p]
            if over == p:
                over += on[p]
            if under == p:
                under += back[p]
            for start, end in ((mid - under, mid + on[p] + p), (mid - p - back[p], mid + over)):
                if end - start < LEAST or end - start < TIMES * p:
                    continue
                if (start and s[start - 1] == s[start - 1 + p]) or (end < n and s[end] == s[end - p]):
                    continue  # a piece
                if found.get((start, end), p) >= p:
                    found[start, end] = p
    return sorted(((a, b - a, p) for (a, b), p in found.items()), key=lambda r: (r[0], r[2]))


def stretches(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(begin, end) of the stretches in which runs can be, of sequences that begin at each of ``ends`` but the last."""
    at, piece = np.arange(len(words)), np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    kinds = int(words.max()) + 1 if len(words) else 1
    while len(at):
        _, which, many = np.unique(piece * kinds + words[at], return_inverse=True, return_counts=True)
        stay = many[which] >= TIMES
        was = len(at)
        at, piece = at[stay], piece[stay]
        cut = np.r_[True, (np.diff(at) > 1) | (np.diff(piece) > 0)] if len(at) else np.empty(0, bool)
        piece = np.cumsum(cut) - 1
        long = np.bincount(piece) >= LEAST if len(at) else np.empty(0, bool)
        on = long[piece]
        at, piece = at[on], (np.cumsum(long) - 1)[piece[on]]
        if len(at) >= was - was // 8:  # as good as settled; what is left too long costs time, not results
            break
    first = np.flatnonzero(np.r_[True, np.diff(piece) > 0]) if len(at) else np.empty(0, np.int64)
    last = np.r_[first[1:], len(at)] - 1 if len(first) else first
    return np.stack([at[first], at[last] + 1], 1)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length by period, compared as fractions."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def treat(texts: pa.Array) -> tuple[list[int], list[list[tuple[int, int, int]]], pa.Array]:
    """The number of words, the runs and the text without repeats, of each text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, ends = lists.flatten(), np.asarray(lists.offsets).astype(np.int64)
    some = np.asarray(pc.binary_length(flat)) > 0
    ends = np.r_[0, np.cumsum(some)][ends - ends[0]]
    flat = flat.filter(pa.array(some))
    words = np.asarray(flat.dictionary_encode().indices)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    change = np.zeros(len(words) + 1, np.int64)
    for a, b in stretches(words, ends).tolist():
        found = runs_of(words[a:b].tolist())
        if found:
            text = int(np.searchsorted(ends, a, "right")) - 1
            base = int(ends[text])
            runs[text] += [(a - base + start, length, period) for start, length, period in found]
            for start, length, period in found:
                change[a + start + period] += 1
                change[a + start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    left = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(kept)][ends].astype(np.int32)), flat.filter(pa.array(kept)))
    return np.diff(ends).tolist(), runs, pc.binary_join(left, pa.scalar(" ", pa.large_string()))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, strongest, collapsed): runs by start and period, the one of greatest length by period, and the words left, joined by one space.

    A word goes if a run has it after its first period.
    """
    run = "struct<start:long,length:long,period:long>"

    def make():
        leave_state()

        def work(batch: pa.RecordBatch) -> Iterator[dict]:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0)).astype(np.int64)
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), SLICE, "right")) + lo)
                n, runs, left = treat(batch.column(1).slice(lo, hi - lo))
                named = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
                best = [r and dict(zip(("start", "length", "period"), r)) for r in map(strongest, runs)]
                yield {id_col: batch.column(0).slice(lo, hi - lo), "n_words": n, "runs": named, "strongest": best, "collapsed": left}
                lo = hi
                give_back()

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(id_col, text_col), make, f"`{id_col}` {kind}, n_words long, runs array<{run}>, strongest {run}, collapsed string")
