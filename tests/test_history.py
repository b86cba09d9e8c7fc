"""What names mean at a position, tables that rewrite what a batch touches, and schema changes on targets."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from changeflow import model
from changeflow.files import Folder, Numbered
from changeflow.operators import ddl
from changeflow.operators.history import Catalog, TableHistory
from changeflow.operators.routing import Router
from changeflow.operators.rules import RuleEngine
from changeflow.plans.pipeline import Pipeline
from changeflow.sinks import create
from changeflow.sinks.table import Manifest, TableSink, bytes_of
from changeflow.sources import changelog, snapshot
from changeflow.streaming.worker import Worker

KEY = model.ReplicationKey(model.PRIMARY_KEY, ("id",))


def _reads(history, names, at):
    """The current name by a row's names."""
    found = [r for r in history.readings([names]) if r.since <= at < r.until]
    assert len(found) == 1
    return dict(zip(names, found[0].renamed))


def test_names_by_position(spark):
    h = TableHistory("t")
    h.meet([("id", 23), ("a", 25), ("c", 20)])
    h.apply(ddl.parse("ALTER TABLE t RENAME a TO b, ADD a int"), 100)
    h.apply(ddl.parse("ALTER TABLE t RENAME b TO x") + ddl.parse("ALTER TABLE t RENAME c TO b") + ddl.parse("ALTER TABLE t RENAME x TO c"), 200)
    h.apply(ddl.parse("ALTER TABLE t DROP a"), 300)
    h.apply(ddl.parse("ALTER TABLE t ADD a text"), 400)
    assert h.row.names == ["id", "c", "b", "a"]
    assert _reads(h, ("id", "a", "c"), 50) == {"id": "id", "a": "c", "c": "b"}
    assert _reads(h, ("id", "b", "c", "a"), 150) == {"id": "id", "b": "c", "c": "b", "a": None}
    # The same names in the same order: before the column went, and after another came.
    assert _reads(h, ("id", "c", "b", "a"), 250)["a"] is None and _reads(h, ("id", "c", "b", "a"), 450)["a"] == "a"
    assert _reads(h, ("id", "c", "b"), 350) == {"id": "id", "c": "c", "b": "b"}
    again = TableHistory.restored(__import__("json").loads(__import__("json").dumps(h.state())))
    assert again == h


def test_random_histories(spark):
    """Rows of every version of random schema changes are read as a log of identities tells."""
    rnd = random.Random(4)
    for _ in range(200):
        h = TableHistory("t")
        now, fresh, told = [(0, "id"), (1, "a"), (2, "b")], itertools.count(3), []
        h.meet([(n, 25) for _, n in now])
        told.append((0, list(now)))
        for at in range(10, 10 + 10 * rnd.randrange(1, 6), 10):
            kind, taken = rnd.choice(["rename", "add", "drop"]), {n for _, n in now}
            free = [n for n in "abcd" if n not in taken]
            if kind == "rename" and len(now) > 1 and free:
                k, to = rnd.randrange(1, len(now)), rnd.choice(free)
                h.apply(ddl.parse(f"ALTER TABLE t RENAME {now[k][1]} TO {to}"), at)
                now[k] = (now[k][0], to)
            elif kind == "add" and free:
                now.append((next(fresh), free[0]))
                h.apply(ddl.parse(f"ALTER TABLE t ADD {free[0]} text"), at)
            elif kind == "drop" and len(now) > 2:
                h.apply(ddl.parse(f"ALTER TABLE t DROP {now.pop()[1]}"), at)
            told.append((at, list(now)))
        assert h.row.names == [n for _, n in now]
        last = dict(now)
        for at, columns in told:
            assert _reads(h, tuple(n for _, n in columns), at + 5) == {n: last.get(i) for i, n in columns}


def test_tables_by_position(spark):
    c = Catalog()
    c.table("a").meet([("id", 23)])
    c.table("b").meet([("id", 23), ("x", 25)])
    first, second = c.table("a"), c.table("b")
    for k, command in enumerate(["ALTER TABLE a RENAME TO t", "ALTER TABLE b RENAME TO a", "ALTER TABLE t RENAME TO b"]):
        assert c.apply("any", command, 100 + k) is not None and c.apply("any", command, 100 + k) is None
    assert (c.table("a", 50), c.table("b", 50), c.table("a", 200), c.table("b", 200)) == (first, second, second, first)
    assert (first.name, first.earlier, second.name) == ("b", ["a", "t"], "a")
    assert [n for n, _, _ in c.names_of(first)] == ["a", "b", "t"]
    third = c.table("t", 300)
    assert third not in (first, second) and c.table("t", 101) is first
    assert Catalog.restored(c.state()).state() == c.state()


# --- the worker


def _change(spark, op, columns, *rows, at, table="users"):
    made = spark.createDataFrame(list(rows), columns)
    whole, none = F.struct(*made.columns), F.lit(None).cast(made.schema)
    return model.envelope(made, table, op=op, new=none if op == "DELETE" else whole, old=whole if op == "DELETE" else none, seq=F.lit(at), key=KEY)


def _command(spark, at, *commands, table="users", position=True):
    rows = [(k, "ALTER TABLE", "table", f"public.{table}", c, "2024-01-01", at + k if position else None) for k, c in enumerate(commands)]
    log = spark.createDataFrame(rows, "id long, event_type string, object_type string, object_identity string, ddl_command string, created_at string, position long")
    return ddl.as_changes(log.withColumn("created_at", F.col("created_at").cast("timestamp")))


class Run:
    def __init__(self, spark, tmp_path, pipeline=None):
        self.spark, self.log, self.state, self.pipeline = spark, str(tmp_path / "log"), str(tmp_path / "state"), pipeline
        self.sink = TableSink(str(tmp_path / "out"), {})

    def add(self, *changes):
        for c in changes:
            changelog.append(changelog.to_wire(c, "g"), self.log)

    def work(self):
        Worker(self.log, "g", None, self.sink, self.pipeline).start(self.spark, self.state, once=True).awaitTermination()

    def rows(self, table, *columns):
        return sorted(map(tuple, self.sink.read(self.spark, table).select(*columns).collect()), key=str)


@pytest.mark.parametrize("together", [True, False])
@pytest.mark.parametrize("position", [True, False])
def test_a_name_given_up_and_given_again(spark, tmp_path, together, position):
    run = Run(spark, tmp_path)
    run.add(snapshot.snapshot(spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string"), "users", KEY))
    if not together:
        run.work()
    run.add(_command(spark, 5, "ALTER TABLE users RENAME a TO b", "ALTER TABLE users ADD a text", position=position))
    run.work()
    assert run.rows("users", "id", "b", "a") == [(1, "x", None), (2, "y", None)]
    run.add(_change(spark, "INSERT", "id int, b string, a string", (3, "p", "q"), at=9 << 14))
    run.work()
    assert run.rows("users", "id", "b", "a") == [(1, "x", None), (2, "y", None), (3, "p", "q")]


def test_renamed_tables_keep_rules_and_rows(spark, tmp_path):
    rules = RuleEngine({"users": [{"type": "transform", "column": "name", "parameters": {"type": "mask", "mask_char": "*"}}]})
    run = Run(spark, tmp_path, Pipeline(rules))
    run.add(snapshot.snapshot(spark.createDataFrame([(1, "anna"), (2, "bert")], "id int, name string"), "users", KEY))
    run.work()
    run.add(_command(spark, 5, "ALTER TABLE users RENAME TO people", table="people"), _change(spark, "INSERT", "id int, name string", (3, "carl"), at=9 << 14, table="people"))
    run.work()
    assert run.rows("people", "id", "name") == [(1, "a**a"), (2, "b**t"), (3, "c**l")] and run.sink.read(spark, "users") is None
    # A new table of the old name is another table.
    run.add(_change(spark, "INSERT", "id int, name string", (1, "dora"), at=20 << 14, table="users"), _change(spark, "DELETE", "id int, name string", (1, None), at=21 << 14, table="people"))
    run.work()
    assert run.rows("people", "id", "name") == [(2, "b**t"), (3, "c**l")] and run.rows("users", "id", "name") == [(1, "d**a")]


def test_renamed_tables_keep_routes(spark, tmp_path):
    run = Run(spark, tmp_path, Pipeline(router=Router({"users": {"destination_table": "kept"}})))
    run.add(snapshot.snapshot(spark.createDataFrame([(1, "anna")], "id int, name string"), "users", KEY), _command(spark, 5, "ALTER TABLE users RENAME TO people", table="people"))
    run.add(_change(spark, "INSERT", "id int, name string", (3, "carl"), at=9 << 14, table="people"))
    run.work()
    assert run.rows("kept", "id", "name") == [(1, "anna"), (3, "carl")]


def test_sources_of_one_target_in_one_batch(spark, tmp_path):
    run = Run(spark, tmp_path, Pipeline(router=Router({"a": {"destination_table": "all"}, "b": {"destination_table": "all"}})))
    for k, t in enumerate("ab"):
        run.add(snapshot.snapshot(spark.createDataFrame([(k, t)], "id int, name string"), t, KEY))
    run.work()
    assert run.rows("all", "id", "name") == [(0, "a"), (1, "b")]


def test_values_that_a_new_type_cannot_hold_raise(spark, tmp_path):
    sink = TableSink(str(tmp_path), {"t": KEY})
    sink.write(snapshot.snapshot(spark.createDataFrame([(1, "12"), (2, None)], "id int, v string"), "t", KEY), "t", 0)
    sink.alter("t", ddl.parse("ALTER TABLE t ALTER v TYPE int"))
    sink.write(snapshot.snapshot(spark.createDataFrame([(3, 5)], "id int, v int"), "t", KEY), "t", 1)
    assert sorted(map(tuple, sink.read(spark, "t").collect())) == [(1, 12), (2, None), (3, 5)]
    sink.alter("t", ddl.parse("ALTER TABLE t ALTER v TYPE text"))
    sink.write(snapshot.snapshot(spark.createDataFrame([(4, "12a")], "id int, v string"), "t", KEY), "t", 2)
    assert sorted(map(tuple, sink.read(spark, "t").collect())) == [(1, "12"), (2, None), (3, "5"), (4, "12a")]
    sink.alter("t", ddl.parse("ALTER TABLE t ALTER v TYPE int"))
    sink.write(snapshot.snapshot(spark.createDataFrame([], "id int, v int"), "t", KEY), "t", 3)
    with pytest.raises(Exception, match="cannot hold"):
        sink.read(spark, "t").collect()
    with pytest.raises(Exception, match="cannot hold"):
        ddl.evolve(spark.createDataFrame([("12a",)], "b string"), ddl.parse("ALTER TABLE t ALTER b TYPE int")).collect()


# --- tables


def _rows(spark, n, of="id * 2"):
    return spark.range(n).selectExpr("cast(id as int) AS id", f"cast({of} as string) AS v")


def _update(spark, ids, v):
    made = spark.createDataFrame([(i, v) for i in ids], "id int, v string")
    return model.envelope(made, "t", op="UPDATE", new=F.struct("id", "v"), old=F.lit(None).cast(made.schema), seq=F.lit(1), key=KEY)


def test_a_batch_writes_what_it_touches(spark, tmp_path):
    sink = TableSink(str(tmp_path), {"t": KEY}, buckets=64, keep=10)
    sink.write(snapshot.snapshot(_rows(spark, 20_000), "t", KEY), "t", 0)
    first = sink.manifest(spark, "t")
    assert len(first.files) == 64
    for k, ids in enumerate(([7], range(100, 110), [30_000]), 1):
        sink.write(_update(spark, ids, f"new {k}"), "t", k)
    second = sink.manifest(spark, "t", before=2)
    assert len(set(second.files.items()) - set(first.files.items())) == 1
    assert bytes_of([first, second]) - bytes_of([first]) < bytes_of([first]) / 30  # one of 64 buckets
    assert len(set(sink.manifest(spark, "t", before=3).files.items()) - set(second.files.items())) <= 10
    got = {r["id"]: r["v"] for r in sink.read(spark, "t").collect()}
    assert got == {i: "new 1" if i == 7 else "new 2" if 100 <= i < 110 else str(2 * i) for i in range(20_000)}
    assert sink.read(spark, "t", before=1).where("v like 'new%'").count() == 0


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    sink = TableSink(str(tmp_path), {"t": KEY}, keep=3)
    sink.write(snapshot.snapshot(_rows(spark, 100), "t", KEY), "t", 0)
    insert = snapshot.snapshot(_rows(spark, 130), "t", KEY)
    for _ in range(3):
        sink.write(insert, "t", 1)
        assert sink.read(spark, "t").count() == 130 and sink.versions(spark, "t") == [0, 1]
    # One that failed between its files and its manifest leaves nothing that counts, and goes with the next.
    (tmp_path / "t" / "v=2.lost").mkdir()
    sink.write(_update(spark, [5], "x"), "t", 2)
    assert sink.read(spark, "t").where("v = 'x'").count() == 1 and not (tmp_path / "t" / "v=2.lost").exists()


def test_buckets_double(spark, tmp_path):
    sink = TableSink(str(tmp_path), {"t": KEY}, buckets=2, bucket_bytes=2000)
    sink.write(snapshot.snapshot(_rows(spark, 3000), "t", KEY), "t", 0)
    sink.write(_update(spark, [5], "x"), "t", 1)
    m = sink.manifest(spark, "t")
    assert m.buckets >= 8 and len(m.files) == m.buckets
    sink.write(_update(spark, [6], "x"), "t", 2)
    assert {r["id"] for r in sink.read(spark, "t").where("v = 'x'").collect()} == {5, 6} and sink.read(spark, "t").count() == 3000


def test_whole_rows_and_keys_that_change(spark, tmp_path):
    """Random batches on whole-row and keyed tables end as one replay of all changes does."""
    from changeflow.operators.replay import replay, replay_rows

    rnd, full = random.Random(3), model.ReplicationKey(model.FULL)
    sink = TableSink(str(tmp_path), {"t": KEY, "w": full}, buckets=16, on_conflict="skip")
    row, seq, told = "struct<id:int,v:string>", itertools.count(), {"t": [], "w": []}
    for batch in range(4):
        for table in told:
            made = []
            for _ in range(40):
                a, b = (rnd.randrange(30), rnd.choice("pqr")), (rnd.randrange(30), rnd.choice("pqr"))
                op = rnd.choice(["INSERT", "INSERT", "UPDATE", "DELETE"])
                made.append((next(seq), op, [], None if op == "DELETE" else a, None if op == "INSERT" else b))
            told[table] += made
            sink.write(spark.createDataFrame(made, f"_seq long, _op string, _toasted array<string>, new {row}, old {row}"), table, batch)
    for table, made in told.items():
        changes = spark.createDataFrame(made, f"_seq long, _op string, _toasted array<string>, new {row}, old {row}")
        whole = replay(changes, ["id"], on_conflict="skip") if table == "t" else replay_rows(changes)
        assert sorted(map(tuple, sink.read(spark, table).collect())) == sorted(map(tuple, whole.collect()))


def test_small_files(spark, tmp_path):
    kept = Numbered(Folder(spark, str(tmp_path / "deep")), "n")
    assert kept.latest() is None and kept.numbers() == []
    for n in (-1, 3, 10):
        kept.put(n, f"é {n}")
    kept.put(3, "again")
    assert kept.numbers() == [-1, 3, 10] and kept.latest() == (10, "é 10") and kept.latest(10) == (3, "again") and kept.latest(-1) is None
    kept.keep(1)
    assert kept.numbers() == [10]
    assert Manifest().row.names == []


# --- schema changes on JDBC targets


def test_commands_on_a_target(spark):
    """Commands about what is not there pass, others that fail raise; repeated ones do nothing; CONCURRENTLY has no transaction."""
    url, options = "jdbc:derby:memory:commands;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    sink = create("postgres", url=url, keys={"users": KEY}, options=options)
    sink.write(snapshot.snapshot(spark.createDataFrame([(1, "ann")], "id int, name string"), "users", KEY), "users")
    run = lambda command: sink.alter("users", ddl.parse(command), [command])
    for _ in range(2):
        run('ALTER TABLE "users" ADD COLUMN "age" int')
    assert sink.read(spark, "users").columns == ["id", "name", "age"]
    run('ALTER TABLE "nobody" DROP COLUMN "x"')
    run('DROP INDEX "no_index"')
    with pytest.raises(Exception):
        run('ALTER TABLE "users" ADD COLUMN "broken" no_such_type')
    told = []
    sink.execute = lambda spark, statements, transaction=True: told.append((statements, transaction))
    run("CREATE INDEX CONCURRENTLY i ON users (name)")
    run("CREATE INDEX i ON users (name)")
    assert [t for _, t in told] == [False, True]
    assert sink.exists(spark, "users") and not sink.exists(spark, "others") and not sink.exists(spark, "user_")


def test_created_tables_have_their_keys(spark):
    """The target itself refuses a second equal key; keys with nulls are met; nothing is left of what was staged."""
    url, options = "jdbc:derby:memory:keys;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    unique = model.ReplicationKey(model.UNIQUE, ("code",))
    sink = create("postgres", url=url, keys={"users": KEY, "codes": unique}, options=options)
    users = snapshot.snapshot(spark.createDataFrame([(1, "ann")], "id int, name string"), "users", KEY)
    codes = snapshot.snapshot(spark.createDataFrame([(7, 1), (None, 2)], "code int, n int"), "codes", unique)
    for _ in range(2):
        sink.write(users, "users"), sink.write(codes, "codes")
    for sql in ('INSERT INTO "users" VALUES (1, NULL)', 'INSERT INTO "users" VALUES (NULL, NULL)', 'INSERT INTO "codes" VALUES (7, 9)'):
        with pytest.raises(Exception):
            sink.execute(spark, [sql])
    row = "struct<code:int,n:int>"
    told = [(5, "UPDATE", [], (None, 22), (None, 2)), (6, "DELETE", [], None, (7, None))]
    sink.write(spark.createDataFrame(told, f"_seq long, _op string, _toasted array<string>, new {row}, old {row}"), "codes")
    assert [tuple(r) for r in sink.read(spark, "codes").collect()] == [(None, 22)]
    tables = spark.read.jdbc(url, "(SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T') t", properties=options)
    assert sorted(r[0] for r in tables.collect()) == ["codes", "users"]
