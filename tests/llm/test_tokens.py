"""Token counts and BPE against the public libraries."""

from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, normalizers

from changeflow.llm import bpe
from changeflow.llm.bpe import Codec, bpe_encode
from changeflow.llm.token_counts import SPACE, Counter, read_pieces, token_counts

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
COUNTER = Counter(read_pieces(open(PIECES, "rb").read()))
CODEC = Codec(open(WORDS, "rb").read())
LIBRARY = Tokenizer.from_file(WORDS)
UNIGRAM = Tokenizer(models.Unigram(read_pieces(open(PIECES, "rb").read()), unk_id=0, byte_fallback=True))
UNIGRAM.normalizer = normalizers.Sequence([normalizers.Prepend(SPACE), normalizers.Replace(" ", SPACE)])

PARTS = st.lists(
    st.sampled_from(["a", "the", "ing", "th", " ", "  ", "\n", "\t", "é", "é", "Σ", "ΑΣ", "İ", "中", "😀", "'s", "'RE", "1", "42", "!!", "<|endoftext|>", "<|startoftext|>", "</w>", "<unk>", "<0x41>", SPACE, "\x1c", " ", "͸", "ꟛ", "x" * 60])
    | st.text(max_size=6),
    max_size=14,
).map("".join)


@settings(max_examples=400, deadline=None)
@given(PARTS)
def test_counts_match_the_library(text):
    assert COUNTER.count(text) == len(UNIGRAM.encode(text).ids)


@settings(max_examples=400, deadline=None)
@given(PARTS)
def test_bpe_matches_the_library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    n, raw, decoded = next(CODEC.encode([text]))
    assert np.frombuffer(raw, "<u4").tolist() == ids and n == len(ids)
    assert decoded == LIBRARY.decode(ids, skip_special_tokens=False) == CODEC.decode(raw)


def test_proposals_are_checked_not_trusted():
    words = ["".join(np.random.default_rng(s).choice(list("aeinorst"), 12)) for s in range(2000)]
    before = CODEC.exact_words
    for word, ids in zip(words, CODEC.encode_words(words)):
        assert ids == CODEC.merge(CODEC.word_symbols(word)) == CODEC._merge_long(CODEC.word_symbols(word))
    assert 0 < CODEC.exact_words - before < len(words)


def test_long_texts():
    for text in ("a" * 30_000, "ab " * 20_000, "x" * 5_000 + " y"):
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert next(CODEC.encode([text]))[0] == len(ids)
        assert COUNTER.count(text) == len(UNIGRAM.encode(text).ids)


ROWS = [(1, "Hello world"), (2, ""), (3, None), (1, "Hello world"), (None, "x")]


@pytest.mark.parametrize("run,path", [(token_counts, PIECES), (bpe_encode, WORDS)])
def test_edges(spark, docs_of, run, path):
    out = run(docs_of(ROWS).withColumnRenamed("n_chars", "n_tokens"), path).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["1", "1", "2", "3", "None"]
    assert {r["doc_id"]: r["n_tokens"] for r in out}[2] == 0 == {r["doc_id"]: r["n_tokens"] for r in out}[3]
    assert run(docs_of([]), path).count() == 0


def test_digests(docs_of):
    plain, digest = (bpe_encode(docs_of(ROWS[:1]), WORDS, digest=d).first() for d in (False, True))
    assert digest["ids_sha256"] == sha256(plain["ids"]).hexdigest() and digest["decoded_sha256"] == sha256(plain["decoded"].encode()).hexdigest()


def test_the_encoder_remembers_ids_of_short_cuts_only():
    codec = Codec(open(WORDS, "rb").read())
    texts = ["a plain text, " + "long" * 100 + str(k) + " \u0565\u0580\u0587" for k in range(50)]
    for _ in range(2):
        for text, (n, raw, decoded) in zip(texts, codec.encode(texts)):
            ids = LIBRARY.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(raw, "<u4").tolist() == ids and decoded == LIBRARY.decode(ids, skip_special_tokens=False)
    for held in (codec.known.young, codec.words.young):
        assert held and max(map(len, held)) <= bpe.LONGEST and all(type(v) is bytes for v in held.values())
    assert codec.parts.get_vocab_size() == 0


def test_texts_encoded_at_once_are_bounded_by_their_length(monkeypatch):
    monkeypatch.setattr(bpe, "AT_ONCE", 10)
    assert list(bpe.spans(pa.array(["x" * 4, None, "x" * 6, "x" * 30, "", "x" * 11, "x"]))) == [(0, 3), (3, 1), (4, 1), (5, 1), (6, 1)]
    assert list(bpe.spans(pa.array([""] * 2500))) == [(0, 1024), (1024, 1024), (2048, 452)]
    assert list(bpe.spans(pa.array([], pa.string()))) == []


def test_memory_of_texts_without_blanks():
    """A long cut takes a fixed number of bytes a character, and is not remembered."""
    import tracemalloc

    counter = Counter(read_pieces(open(PIECES, "rb").read()))
    text = "abcdefghijklmnopqrst" * 10_000
    tracemalloc.start()
    assert counter.count(text) == len(UNIGRAM.encode(text).ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(text) + (1 << 20)
    assert all(len(k) <= 64 for k in counter.known.young)
    assert counter.count("short words") == len(UNIGRAM.encode("short words").ids) and "words" in counter.known.young
