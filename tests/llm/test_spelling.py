import random
import re
from collections import Counter
from zlib import crc32

import cases
import pytest
from strata.llm import queries, spelling
from strata.llm.common import prepare, stage


def is_near(a, b):
    """By trying: replace at the first difference, or leave a letter of the longer one out."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, min_length=6, min_count=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            check = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if check % 199 == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def brute_groups(words, ratio=5):
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and v != w and is_near(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@pytest.mark.parametrize("source", ["driver", "edge"])
def test_query_against_brute_force(spark, tmp_path, source):
    docs = cases.driver_docs(spark) if source == "driver" else cases.edge_docs(spark)
    if source == "edge":
        more = [(i, "Couleur colour color Color colour coloür ×÷×÷×÷ Éclairs", None, None, None) for i in range(400)]
        names = [c for c in docs.columns if c not in cases.docs(spark, []).columns]
        docs = docs.unionByName(spark.createDataFrame(more, cases.SCHEMA).selectExpr("*", *[f"'x' as `{n}`" for n in names]))
    folder = cases.written(spark, tmp_path, documents=docs)
    words = brute_words(tuple(r) for r in docs.select("doc_id", "text").collect())
    assert words
    assert rows_of(queries.QUERIES["op12_spelling"](spark, folder)) == brute_groups(words)


@pytest.mark.parametrize("block", [2, 7, 256])
def test_dense_groups_cut_into_blocks(spark, monkeypatch, block):
    """Words over two letters: nearly all share buckets; ties and long chains abound."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    prepare(spark)
    draw = random.Random(block)
    words = {"".join(draw.choices("abé", k=draw.randint(1, 8))): draw.choice([5, 5, 5, 25, 25, 125, 700, 4000]) for _ in range(400)}
    words |= {"a" * n: 5**n for n in range(1, 14)}
    df = stage(spark.createDataFrame(list(words.items()), "word string, n bigint"), "words")
    assert rows_of(spelling.group(df)) == brute_groups(words)


def test_cells_across_batches_and_odd_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_ROWS", 3)
    prepare(spark)
    words = {"x" * 5000: 5, "x" * 5001: 50, "x" * 4999 + "y": 7, "\U0001f600bcdef": 9, "\U0001f601bcdef": 90, "zz": 1, "z": 10}
    words |= {f"common{c}": 5 for c in "abcdefghijklmnop"}
    df = stage(spark.createDataFrame(list(words.items()), "word string, n bigint"), "words")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert rows_of(spelling.group(df)) == brute_groups(words)
    finally:
        prepare(spark)


def test_counts_are_handed_on_when_many(spark, monkeypatch):
    prepare(spark)
    docs = cases.driver_docs(spark)
    whole = {r.word: r.n for r in spelling.count_words(docs).collect()}
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    assert {r.word: r.n for r in spelling.count_words(docs).collect()} == whole


def test_empty_table(spark):
    prepare(spark)
    assert rows_of(spelling.group(stage(spelling.count_words(cases.empty_docs(spark)), "none"))) == []


def test_no_cross_join(spark):
    prepare(spark)
    df = stage(spark.createDataFrame([("abcdef", 5)], "word string, n bigint"), "words")
    plan = spelling.near_words(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
