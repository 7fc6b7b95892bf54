import random

import cases
import pytest
from strata.llm import decontaminate as dec
from strata.llm import queries


def least_distance(item, text):
    """Plain dynamic programme: least edits of item and any part of text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != c), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def spoiled(draw, text, edits):
    chars = list(text)
    for _ in range(edits):
        at, how = draw.randrange(len(chars)), draw.randrange(3)
        if how == 0:
            chars[at] = draw.choice("abcxyz")
        elif how == 1:
            del chars[at]
        else:
            chars.insert(at, draw.choice("abcxyz"))
    return "".join(chars)


def test_search_against_dynamic_programme():
    draw = random.Random(1)
    for _ in range(150):
        item = "".join(draw.choices("ab c", k=draw.randint(24, 80))).strip()
        text = "".join(draw.choices("ab c", k=60)) + spoiled(draw, item, draw.randint(0, 8)) + "".join(draw.choices("ab c", k=60))
        pattern = dec.Pattern(item)
        found = pattern.search(text)
        least = least_distance(item, text)
        assert bool(found) == (least <= pattern.budget)
        if found:
            assert min(d for *_, d in found) == least
            for start, end, d in found:
                assert least_distance(text[start:end], item[: len(item)]) <= d


def test_every_passage_within_the_budget_is_found():
    draw = random.Random(2)
    items = ["".join(draw.choices(["the ", "ing", "tion ", "re", "qu", "a"], k=60)).strip() for _ in range(20)]
    matcher = dec.Matcher(list(enumerate(map(dec.normal, items))))
    for n, item in enumerate(items):
        for edits in (0, 1, 5, dec.budget(len(dec.normal(item)))):
            text = dec.normal("before it " + spoiled(draw, dec.normal(item), edits) + " after it")
            want = {i for i, x in enumerate(items) if least_distance(dec.normal(x), text) <= dec.budget(len(dec.normal(x)))}
            assert {m[0] for m in matcher.find(text)} == want and n in want


def test_pieces_are_one_more_than_the_budget():
    for length in range(1, 400):
        item = "x" * length
        cut = dec.pieces(item)
        assert len(cut) == dec.budget(length) + 1 and "".join(p for _, p in cut) == item
        assert length < 2 * dec.PIECE or min(len(p) for _, p in cut) >= dec.PIECE


@pytest.mark.parametrize("block", [dec.BLOCK_CHARS, 300])
def test_query_against_brute_force(spark, monkeypatch, block):
    """Exact passages by text search; all others by the distance of what was found."""
    monkeypatch.setattr(dec, "BLOCK_CHARS", block)
    items = {r.item_id: dec.normal(r.text) for r in spark.read.parquet(f"{cases.SF}/benchmark.parquet").collect()}
    docs = {r.doc_id: dec.normal(r.text or "") for r in cases.driver_docs(spark).collect()}
    rows = queries.QUERIES["op6_decontaminate"](spark, cases.SF).collect()
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert {(r.doc_id, r.item_id) for r in rows if r.distance == 0} == exact
    for r in rows:
        assert least_distance(items[r.item_id], docs[r.doc_id][r.start : r.end]) == r.distance <= dec.budget(len(items[r.item_id]))


def test_edges_and_drop(spark):
    docs = cases.edge_docs(spark)
    items = spark.createDataFrame([(1, "other line"), (2, None), (3, ""), (4, "and " * 10), (5, "OTHER   LINE")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in dec.find(docs, items).collect()}
    assert found == {(9, 1), (9, 5), (7, 4)}
    kept = dec.drop(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    none = items.limit(0)
    assert dec.find(docs, none).collect() == [] and dec.drop(docs, none).count() == docs.count()
    assert dec.find(cases.empty_docs(spark), items).collect() == []


def test_short_items_stand_as_words(spark):
    texts = ["I said yesterday", "the eyes have it", "Yes, it is", "oh yes", "yes", "42nd", "no 42!"]
    items = spark.createDataFrame([(1, "yes"), (2, "42")], "item_id bigint, text string")
    kept = {r.doc_id for r in dec.drop(cases.docs(spark, texts), items).collect()}
    assert kept == {0, 1, 5}
    assert {(r.doc_id, r.item_id) for r in dec.find(cases.docs(spark, texts), items).collect()} == {(2, 1), (3, 1), (4, 1), (6, 2)}
