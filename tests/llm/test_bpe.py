import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import public_tokenizers
from linkloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.encoder(bpe.read_vocabulary(PATH))


def check(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    own = OWN.encode(text)
    assert own.tolist() == ids
    assert OWN.decode(own) == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize(
    "text",
    ["", " ", "Hello  WORLD's it'll", "ΑΣ σς İı ǅ", "<|endoftext|>a<|startoftext|> <|endoftext", "中文かな 한국", "x" * 5000, "ab" * 3000,
     "1234 ½ ² ٣", "é é ́", "\x00\x1c\x85\xa0 ", "!!!???...<<>>", "</w> w</w>", "😀👍🏽"],
)
def test_same_as_library(text):
    check(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("abcdeinrst' \t.,!?019éÀßΣσİ½²中한́<|>/w😀")), max_size=60))
def test_same_as_library_on_mixed_text(text):
    check(text)


def test_whole_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.digests(docs, PATH, tokens=True).collect():
        ids = LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.tokens == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_rows_of_any_kind(spark):
    schema = "doc_id long, text string, tokens string, n_tokens long"
    rows = [(None, None, "x", 1), (1, "", None, None), (2, "a b", "x", 1), (2, "a b", "x", 1), (3, "long word " * 40_000, "x", 1)]
    found = bpe.digests(spark.createDataFrame(rows, schema), PATH).collect()
    nothing = hashlib.sha256(b"").hexdigest()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in found) == [(0, 0), (1, 0), (2, 2), (2, 2), (3, 80_000)]
    assert all(r.ids_sha256 == r.decoded_sha256 == nothing for r in found if r.n_tokens == 0)
    assert bpe.digests(spark.createDataFrame([], schema), PATH).collect() == []
    back = bpe.decode(bpe.encode(spark.createDataFrame(rows, schema), PATH), PATH).collect()
    assert {r.text for r in back if r.doc_id == 2} == {"a</w> b</w>"}
