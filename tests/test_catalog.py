"""Every query of the catalogue against its SQL in DuckDB, on the smallest of the driver's tables."""

import math
import os
from collections import Counter
from datetime import datetime, timezone

import pytest

from changeflow.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, datetime):
        return v.astimezone(timezone.utc).replace(tzinfo=None) if v.tzinfo else v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    found = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    stamps = {f.name for f in df.schema if f.dataType.typeName() == "timestamp"}
    ours = Counter(tuple(_plain(r[n].astimezone(timezone.utc) if n in stamps and r[n] is not None else r[n]) for n in names) for r in df.collect())
    assert ours == Counter(tuple(map(_plain, r)) for r in found.fetchall())


def test_the_only_query_without_sql(spark):
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"mask_utf8_bytes"}
    rows = catalog.queries()["mask_utf8_bytes"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").withColumnRenamed("text", "was"), "doc_id").collect()
    for r in rows:
        raw = r["was"].encode()
        assert r["text"] == (r["was"] if len(raw) <= 2 else bytes([raw[0]]).decode("latin-1") + "*" * (len(raw) - 2) + bytes([raw[-1]]).decode("latin-1"))


def test_replays_of_captures_decode_once(spark):
    """What a replay reads more than once is stored; a single reader decodes as it goes."""
    plan = lambda name: catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "changeflow_pgoutput" in plan("decode_frames")
    assert not any("changeflow_pgoutput" in plan(name) for name in ("decode_replay", "copy_and_stream_decoded"))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(catalog.queries()) <= set(__spark_entry__.queries())


def test_nothing_else_needs_the_corpus_operators():
    """No module outside ``llm`` names it, but the guarded import of the entry."""
    import ast
    from pathlib import Path

    root = Path(catalog.__file__).parents[2]
    for path in (root / "changeflow").rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, (ast.Import, ast.ImportFrom)):
                assert "llm" not in ast.dump(node), path
