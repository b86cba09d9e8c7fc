"""The pipeline on a small table: what each stage must keep and drop."""

import hashlib
import math
import os
import random
import struct
import sys
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeflow.llm import quality

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from test_documents import _count, _kneser_ney, _plain_toxicity  # noqa: E402
from test_shingles import _groups  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_stages(spark):
    sys.path.insert(0, ROOT)
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "mixing", "bpe"]
    before, kept = docs, docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, before, SF)
        assert kept.columns == docs.columns
        kept.createOrReplaceTempView(name)
        assert 0 < kept.count() <= before.count()
        assert kept.join(before, kept.columns, "left_anti").count() == 0
        before = kept
    out = corpus_pipeline.run(spark, SF)
    ids = {r["doc_id"] for r in before.collect()}
    assert {r["doc_id"] for r in out.collect()} <= ids and out.count() > 0.5 * len(ids)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_every_query_runs(spark):
    from changeflow.llm import queries

    for name, run in queries.queries().items():
        df = run(spark, SF)
        assert df.columns and df.count() > 0, name


def _corpus():
    """Prose in two languages, toxic, symbol-ridden and copied documents, empty texts and clashing ids, with labels."""
    rnd = random.Random(12)
    syllables = ["ta", "ri", "mon", "del", "sa", "ke", "vo", "lu"]
    word = lambda: "".join(rnd.choices(syllables, k=rnd.randrange(1, 4)))
    rows, labels = [], []
    for i in range(260):
        words = [word() for _ in range(60)]
        toxic = i % 6 == 0
        if toxic:
            for k in rnd.sample(range(60), 6):
                words[k] = rnd.choice(["rotten", "vile", "filthy"])
        if i % 17 == 3:
            words = [w.upper() + "$%#" for w in words]
        rows.append((i, " ".join(words), ["en", "en", "fr"][i % 3], ["a", "b", None][i % 4 % 3]))
        if i % 5:
            labels.append((i, 0 if i % 17 == 3 else 1, int(toxic)))
    for k in range(30):  # near copies and copies
        i, text, lang, source = rows[k + 100]
        words = text.split()
        if k % 3:
            words[-k % 7] += "x"
        rows.append((1000 + k, " ".join(words), lang, source))
    rows += [(2000, None, "en", "a"), (2001, "", "en", "a"), (2002, " \n", None, "b"), (7, "an other text under a known id " + word(), "en", "b"), (None, "no id " + word(), "en", "a")]
    return rows, [*labels, (None, 1, 0), (5, None, None)]


def _expected(spark, rows, labels):
    """The five stages by sets, dictionaries and the public tokenizer."""
    learn = lambda i: zlib.crc32(str(i).encode()) % 3 != 1
    toxic = {i: t for i, _, t in labels if i is not None and t is not None and learn(i)}
    texts = {}
    for i, t, *_ in rows:
        if i in toxic and t is not None:
            texts[i] = min(t, texts.get(i, t))
    score = _plain_toxicity([(i, toxic[i], t) for i, t in sorted(texts.items())], sum(toxic.values()) / len(toxic))
    rows = [r for r in rows if score(r[1] or "") < 0.7]

    marks = {}
    for i, q, _ in labels:
        if i is not None and q is not None:
            marks[i] = min(q, marks.get(i, q))
    held = dict(spark.createDataFrame([(i,) for i in marks], "i long").select("i", F.pmod(F.xxhash64("i"), F.lit(quality.HELD)) == 0).collect())
    good = [r for r in rows if marks.get(r[0]) == 1]
    _, perplexity = _kneser_ney([r[1] for r in good if r[1] and not held[r[0]]])
    unread = [(r[2], perplexity(r[1])) for r in good if held[r[0]] and (r[1] or "").split()]
    of = lambda x: sorted(x)[math.ceil(quality.QUANTILE * len(x)) - 1] * quality.MARGIN
    limit = {lang: of(x) for lang in {u[0] for u in unread} if len(x := [p for g, p in unread if g == lang]) >= quality.FEW}
    over_all = of([p for _, p in unread])
    rows = [r for r in rows if not (r[1] or "").split() or perplexity(r[1]) <= limit.get(r[2], over_all)]

    named = [r for r in rows if r[0] is not None]
    group, best = _groups([(r[0], r[1]) for r in named]), {}
    hashed = dict(spark.createDataFrame([(k, r[1]) for k, r in enumerate(named)], "k long, t string").select("k", F.xxhash64("t")).collect())
    for k, g in enumerate(group):
        best[g] = min(best.get(g, k), k, key=lambda j: (named[j][0], hashed[j]))
    rows = [named[k] for k in best.values()] + [r for r in rows if r[0] is None]

    sizes = Counter(r[3] for r in rows)
    counts = [(_count(7, "" if r[0] is None else r[0], (1 / len(sizes)) * len(rows) / sizes[r[3]]), r) for r in rows]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation(), tokenizer.no_padding()
    out = []
    for n, (i, t, *_) in counts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        out += [(i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())] * n
    return sorted(out, key=str)


def test_pipeline_by_brute_force(spark, docs_of, tmp_path):
    sys.path.insert(0, ROOT)
    import corpus_pipeline

    rows, labels = _corpus()
    docs = docs_of(rows).withColumn("score", F.lit("clash")).withColumn("perplexity", F.lit(1)).withColumn("copy", F.lit(None).cast("int"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = sorted((tuple(r) for r in out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()), key=str)
    assert got == _expected(spark, rows, labels) and 50 < len({r[0] for r in got}) < len(rows)


def test_pipeline_over_empty_tables(spark, docs_of, tmp_path):
    sys.path.insert(0, ROOT)
    import corpus_pipeline

    docs_of([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
