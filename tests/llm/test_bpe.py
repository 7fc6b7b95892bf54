import hashlib
import random

import cases
import public_tokenizers
import pytest
from strata.llm import bpe, queries
from strata.llm.common import prepare
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def path():
    return str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library(path):
    return Tokenizer.from_file(path)


def test_random_words_encode_as_the_library_does(path, library):
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(path)))
    draw = random.Random(7)
    syllables = ["the", "ing", "tion", " ", "é", "ñ", "ß", "a", "b", "0", "12", "\n", "  ", "aaaa", "'s", "!", "漢", "\U0001f600", "<|endoftext|>", "abab"]
    texts = ["".join(draw.choices(syllables, k=draw.randint(0, 40))) for _ in range(2000)]
    texts += ["a" * n for n in range(1, 60)] + ["abcabc" * n for n in range(1, 20)]
    got = [list(memoryview(p).cast("i")) for p in encoder.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_word_table_that_overflows_gives_the_same(path, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(path)))
    for text in ["one two three four five", "six two", "one one seven eight nine"]:
        assert list(memoryview(encoder.encode([text])[0]).cast("i")) == library.encode(text).ids


@pytest.mark.parametrize("source", ["driver", "edge"])
def test_query_against_the_library(spark, tmp_path, library, source):
    docs = cases.driver_docs(spark) if source == "driver" else cases.edge_docs(spark)
    folder = cases.written(spark, tmp_path, documents=docs)
    got = sorted(map(tuple, queries.QUERIES["op1_bpe"](spark, folder).collect()), key=repr)
    sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
    want = []
    for row in docs.select("doc_id", "text").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        want.append((row.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=repr)


def test_decode_is_the_round_trip_and_takes_odd_ids(spark, path, library):
    prepare(spark)
    both = bpe.decode(bpe.encode(cases.edge_docs(spark), path), path).collect()
    assert sorted(r.decoded for r in both) == sorted(r.text or "" for r in cases.edge_docs(spark).collect())
    odd = spark.createDataFrame([(1, [464, 99999999, -1]), (2, None), (3, [])], "doc_id bigint, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(odd, path).collect()} == {1: "The", 2: None, 3: ""}


def test_empty_table(spark, path):
    assert bpe.decode(bpe.encode(cases.empty_docs(spark), path), path).collect() == []


def test_no_shuffle(spark, tmp_path):
    folder = cases.written(spark, tmp_path, documents=cases.driver_docs(spark))
    assert "Exchange" not in queries.QUERIES["op1_bpe"](spark, folder)._jdf.queryExecution().toString()
