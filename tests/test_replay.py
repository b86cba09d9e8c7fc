"""Replay against a sequential simulator on random changes."""

import random

import pytest

from changeflow.operators.replay import DuplicateKey, replay, replay_rows

ROW = "struct<id:int,a:string,b:int>"
SCHEMA = f"_seq long, _op string, _toasted array<string>, new {ROW}, old {ROW}"


def _simulate(changes, full=False):
    state = {}
    key = (lambda r: r) if full else (lambda r: r[0])
    for _, op, toasted, new, old in sorted(changes):
        if op == "INSERT":
            if full:
                state.setdefault(key(new), [new, 0])[1] += 1
            else:
                state.setdefault(key(new), [new, 1])
            continue
        at = key(old or new)
        if at not in state:
            continue
        was, n = state.pop(at)
        if op == "UPDATE":
            made = tuple(w if c in toasted else v for c, w, v in zip(("id", "a", "b"), was, new))
            if key(made) in state and not full:
                state[at] = [was, n]
                continue
            state.setdefault(key(made), [made, 0])[1] += n
    return sorted((r for r, n in state.values() for _ in range(n)), key=str)


def _random(seed, n, keys, moves, full=False):
    rnd = random.Random(seed)
    row = lambda k: (k, rnd.choice(["x", "y", None] if not full else ["x", None]), rnd.randrange(3 if full else 100))
    out = []
    for s in range(n):
        k, op = rnd.randrange(keys), rnd.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"])
        new, old, toasted = row(k), None, []
        if op == "UPDATE":
            toasted = [c for c in ("a", "b") if rnd.random() < 0.3] if not full else []
            if full or rnd.random() < moves:
                old, new = (row(k), row(rnd.randrange(keys))) if full else ((k, None, None), row(rnd.randrange(keys)))
        elif op == "DELETE":
            old, new = (row(k) if full else (k, None, None)), None
        out.append((s, op, toasted, new, old))
    return out


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,moves", [(1, 0.0), (2, 0.02), (3, 0.2)])
def test_by_key(spark, seed, moves):
    changes = _random(seed, 1500, 60, moves)
    df = spark.createDataFrame(changes, SCHEMA)
    assert _rows(replay(df, ["id"], on_conflict="skip")) == sorted(_simulate(changes), key=str)


def test_in_two_batches(spark):
    changes = _random(5, 800, 40, 0.05)
    df = spark.createDataFrame(changes, SCHEMA)
    half = replay(df.where("_seq < 400"), ["id"], on_conflict="skip")
    assert _rows(replay(df.where("_seq >= 400"), ["id"], base=half, on_conflict="skip")) == sorted(_simulate(changes), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_whole_rows(spark, seed):
    changes = _random(seed, 600, 6, 0, full=True)
    df = spark.createDataFrame(changes, SCHEMA)
    assert _rows(replay_rows(df)) == sorted(_simulate(changes, full=True), key=str)
    plain = [c for c in changes if c[1] != "UPDATE"]
    assert _rows(replay_rows(spark.createDataFrame(plain, SCHEMA))) == sorted(_simulate(plain, full=True), key=str)


def test_conflict_is_an_error(spark):
    df = spark.createDataFrame([(0, "INSERT", [], (1, "a", 1), None), (1, "INSERT", [], (2, "b", 2), None), (2, "UPDATE", [], (2, "c", 3), (1, None, None))], SCHEMA)
    with pytest.raises(Exception, match=DuplicateKey.__name__):
        replay(df, ["id"]).collect()


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert replay(df, ["id"]).count() == 0 and replay_rows(df).count() == 0
