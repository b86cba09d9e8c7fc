"""Other columns, whatever their names, change nothing and clash with nothing."""

import public_tokenizers
from pyspark.sql import functions as F

from changeflow.llm import periodic, simhash
from changeflow.llm.bpe import bpe_encode
from changeflow.llm.token_counts import token_counts

ROWS = [(1, "one two three four five"), (2, "one two three four five"), (3, None), (None, "go " * 8)]
NAMES = ["fp", "component_id", "component", "cls", "th", "node", "n_tokens", "ids", "token_ids", "decoded", "row", "runs", "u", "v", "a", "b", "key", "salt", "own", "text2"]


def _same(spark, run):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string")
    wide = plain.select(*[F.lit("x").alias(n) for n in NAMES[:10]], "doc_id", *[F.lit(7).alias(n) for n in NAMES[10:]], "text")
    assert sorted(map(str, run(wide).collect())) == sorted(map(str, run(plain).collect()))


def test_token_counts(spark):
    _same(spark, lambda df: token_counts(df, public_tokenizers.path("piece_bpe_32k.model")))


def test_bpe(spark):
    _same(spark, lambda df: bpe_encode(df, public_tokenizers.path("word_bpe_49k.json"), digest=True))


def test_simhash(spark):
    _same(spark, lambda df: simhash.near_duplicates(df, width=4, radius=4).select("doc_id", "fp", "component_id"))


def test_periodic(spark):
    _same(spark, periodic.find_runs)
