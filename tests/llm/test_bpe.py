import hashlib
import random

import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from tabvitals.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.load(PATH))


def test_given_texts(library, coder):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet")["text"].to_pylist()
    ours = list(coder.encoded(texts))
    theirs = library.encode_batch(texts, add_special_tokens=False)
    assert [o for o, t in zip(ours, theirs, strict=True) if o != t.ids] == []
    assert [coder.decoded(o) for o in ours] == texts


def test_odd_texts(library, coder):
    rnd = random.Random(1)
    pool = list(" \n\t\r\v\f  aabAB'sdtlrevm109!!$é日本 \xa0́‍😀\x85\x1c\x1d\x1e\x1f​᠎﻿²Ⅷ٣ſK")
    pool += ["<|endoftext|>", "'ll", "'re", " the", "  ", "\n\n "]
    texts = ["".join(rnd.choices(pool, k=rnd.randint(0, 30))) for _ in range(4000)]
    texts += ["a" * 3000, "ab" * 2000 + " " * 500, "aaaaaaaaa aaa aa"]
    for text, ours in zip(texts, coder.encoded(texts), strict=True):
        theirs = library.encode(text, add_special_tokens=False).ids
        assert ours == theirs, repr(text)
        assert coder.decoded(ours) == library.decode(theirs, skip_special_tokens=False)


def test_bytes_that_are_no_text(library, coder):
    rnd = random.Random(2)
    for _ in range(300):
        ids = [rnd.randrange(50257) for _ in range(rnd.randint(0, 6))]
        assert coder.decoded(ids) == library.decode(ids, skip_special_tokens=False)


def test_kept_words_are_bounded(coder):
    small = bpe.Coder(coder.vocabulary, kept_words=10)
    texts = [f"word{i} and word{i + 1}" for i in range(100)]
    for i in range(0, 100, 5):
        assert list(small.encoded(texts[i : i + 5])) == list(coder.encoded(texts[i : i + 5]))
        assert len(small.known) <= 10 + 15


def test_frames(spark, library):
    rows = [(1, None, "a"), (2, "", "b"), (3, "Hello <|endoftext|> world", "c"), (None, "x y", "d")]
    rows += [(5, "same text", "e")] * 2 + [(6, "long " * 50_000, "f")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    vocabulary = bpe.load(PATH)
    ids = bpe.encoded(frame, vocabulary)
    back = bpe.decoded(ids, vocabulary).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(k), t or "") for k, t, _ in rows)
    found = bpe.coded(frame, vocabulary).collect()
    by_key = {k: t or "" for k, t, _ in rows}
    assert len(found) == len(rows)
    for r in found:
        theirs = library.encode(by_key[r.doc_id], add_special_tokens=False).ids
        assert r.ids == theirs and r.n_tokens == len(theirs)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, theirs)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(by_key[r.doc_id].encode()).hexdigest()
    assert bpe.coded(frame.limit(0), vocabulary).count() == 0
