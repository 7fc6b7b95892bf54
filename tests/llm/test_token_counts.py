import random

import cases
import public_tokenizers
import pytest
from strata.llm import queries, token_counts
from strata.llm.common import prepare
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def path():
    return str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library(path):
    return Tokenizer.from_file(path)


def expected(library, docs):
    rows = []
    for row in docs.select("doc_id", "text").collect():
        text = row.text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        rows.append((row.doc_id, len(text.encode()), n, n > 512))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("source", ["driver", "edge"])
def test_query_against_the_library(spark, tmp_path, library, source):
    docs = cases.driver_docs(spark) if source == "driver" else cases.edge_docs(spark)
    folder = cases.written(spark, tmp_path, documents=docs)
    got = queries.QUERIES["op11_token_counts"](spark, folder)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(library, docs)


def test_random_texts_and_every_white_space(path, library):
    lengths = token_counts.Lengths(token_counts.read_vocabulary(path), b"")
    draw = random.Random(3)
    spaces = [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x202F, 0x205F, 0x3000, 0x200B)]
    parts = [*spaces, " ", " ", "the", "'s", "'S", "12", "٣", "é", "漢字", "!", "\U0001f600", "_", "ǅ", "²", "<|endoftext|>", "<|endof", "\x00", "́"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(3000)]
    assert lengths.count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_caches_that_overflow_and_long_words_give_the_same(path, library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 4)
    monkeypatch.setattr(token_counts, "CACHED_CHARS", 6)
    lengths = token_counts.Lengths(token_counts.read_vocabulary(path), token_counts.pack({" two": 1, "one": 1}))
    texts = ["one two three four", "unquestionably one unquestionably", "five six seven eight nine ten", "two one", ""]
    for chosen in ([t] for t in texts):
        assert lengths.count(chosen) == [len(library.encode(t).ids) for t in chosen]
    assert lengths.count(texts) == [len(library.encode(t).ids) for t in texts]
    assert not any(len(w) > 6 for w in lengths.known)


def test_first_tier_holds_the_frequent_ones_within_its_bound(spark, path):
    prepare(spark)
    packed = token_counts.frequent(cases.driver_docs(spark), token_counts.read_vocabulary(path), count=50)
    table = token_counts.unpack(packed)
    assert 0 < len(table) <= 50 and {" the", "."} <= set(table)
    assert token_counts.pack(table) == packed
    assert len(packed) <= 50 * (4 * token_counts.FREQUENT_CHARS + 3)


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        token_counts.Splitter(token_counts.read_vocabulary(str(public_tokenizers.path("word_bpe_49k.json"))))


def test_empty_table_and_no_shuffle(spark, tmp_path, path):
    prepare(spark)
    assert token_counts.count_tokens(cases.empty_docs(spark), path).collect() == []
    folder = cases.written(spark, tmp_path, documents=cases.driver_docs(spark))
    assert "Exchange" not in queries.QUERIES["op11_token_counts"](spark, folder)._jdf.queryExecution().toString()
