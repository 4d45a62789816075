import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from supplyscope.llm import token_counts as tc
from tests.llm.helpers import AWKWARD, LONG, docs

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    tok = Tokenizer.from_file(PATH)
    tok.no_truncation()
    tok.no_padding()
    return lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)


TEXTS = ["It's they'll WE'RE x'd 's", "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>", "é ́ cafẹ́ Å",
         "1 22 333abc4", "  　x\u0085y", "漢字。かな、ABC", "\U0001f600\U0001f600 ‍", "Σας ΣΑΣ İstanbul",
         "\x00a\x1cb\x1fc", "-- -- ... !!!", "w" * 5000, "한국어 한", "﻿bom", "a\r\n\tb"]


def test_whole_texts_against_the_library(spark, whole):
    rows = AWKWARD + [(100 + i, t, "z") for i, t in enumerate(TEXTS)]
    got = tc.token_counts(docs(spark, rows), PATH, limit=100).collect()
    want = sorted(((i, len((t or "").encode()), whole(t), whole(t) > 100) for i, t, _ in rows), key=str)
    assert sorted(map(tuple, got), key=str) == want
    assert [f.name for f in tc.token_counts(docs(spark, rows), PATH).schema] == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=6), st.integers(1, 40))
def test_any_batch_size_gives_the_same_lengths(texts, size):
    c = tc.load_counter(PATH)
    assert tc.lengths(c, [t.encode() for t in texts], size).tolist() == c.lengths(texts)


def test_cuts_keep_all_bytes_and_stand_at_boundaries():
    text = ("one two three,four" * 50 + "x" * 300 + ".y" * 10).encode()
    parts = list(tc.cut(text, 16))
    assert b"".join(parts) == text and len(parts) > 20
    assert all(p[-1:].isspace() or p[-1:] in b".,;:!?" for p in parts[:-1])
    assert list(tc.cut(b"x" * 100, 16)) == [b"x" * 100]               # no boundary: whole


def test_tokenizers_that_keep_white_space_get_whole_texts():
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        c = tc.load_counter(public_tokenizers.path(name))
        texts = ["two  blanks here", "", " a", LONG]
        assert not c.additive
        assert tc.lengths(c, [t.encode() for t in texts], 16).tolist() == c.lengths(texts)


def test_empty_table(spark):
    assert tc.token_counts(docs(spark, []), PATH).collect() == []


def test_query_reads_the_whole_table(spark, whole):
    from supplyscope.llm.queries import op11_token_counts

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, op11_token_counts(spark, sf).collect()))
    assert got == sorted((r[0], len((r[1] or "").encode()), whole(r[1]), whole(r[1]) > 2048) for r in rows)
