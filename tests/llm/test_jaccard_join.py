import random
from collections import defaultdict

import cases
import numpy as np
import pytest
from strata.llm import jaccard_join as jj
from strata.llm import queries
from strata.llm.common import prepare


def grams(text):
    words = (text or "").lower().split()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute(rows):
    """(doc_id, class_id, n_copies, n_linked_texts, n_links) by comparing all pairs of texts."""
    sets, ids = {}, defaultdict(list)
    for doc_id, text in rows:
        text = text or ""
        sets[text] = grams(text)
        ids[text].append(doc_id)
    texts = [t for t in sets if sets[t]]
    linked = defaultdict(list)
    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) < 0.8 * max(len(x), len(y)):
                continue
            both = len(x & y)
            if both >= 0.8 * (len(x) + len(y) - both) - 1e-9:
                linked[a].append(b)
                linked[b].append(a)
    label = {}
    for t in texts:
        if t in label:
            continue
        group, waiting = set(), [t]
        while waiting:
            x = waiting.pop()
            if x not in group:
                group.add(x)
                waiting += linked[x]
        least = min((d for x in group for d in ids[x] if d is not None), default=None)
        label.update(dict.fromkeys(group, least))
    out = []
    for doc_id, text in rows:
        text = text or ""
        copies = len(ids[text]) - 1 if sets[text] else 0
        out.append((doc_id, label[text] if sets[text] else doc_id, copies, len(linked[text]), copies + sum(len(ids[b]) for b in linked[text])))
    return sorted(out, key=repr)


def near_copies(count=60, words=60):
    """A group of near copies of one text, chains of drifting texts, and copies."""
    draw = random.Random(6)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    base = [word() for _ in range(words)]
    texts = []
    for _ in range(count):
        own = list(base)
        own[draw.randrange(words)] = word()
        texts.append(" ".join(own))
    drift = [word() for _ in range(words)]
    for _ in range(15):
        texts.append(" ".join(drift))
        drift[draw.randrange(words)] = word()
    return texts + texts[:20] + ["one two", "one two", "One  two", "three", None, None, "", "  "]


@pytest.mark.parametrize("source", ["driver", "edge", "near"])
def test_query_against_brute_force(spark, tmp_path, source):
    docs = {"driver": cases.driver_docs, "edge": cases.edge_docs, "near": lambda s: cases.docs(s, near_copies())}[source](spark)
    folder = cases.written(spark, tmp_path, documents=docs)
    got = sorted(map(tuple, queries.QUERIES["op3_jaccard_join"](spark, folder).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_small_blocks_give_the_same(spark, monkeypatch):
    prepare(spark)
    docs = cases.docs(spark, near_copies())
    monkeypatch.setattr(jj, "BLOCK_ROWS", 7)
    got = sorted(map(tuple, jj.join(docs).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_bands_reach_the_recall():
    for similarity, recall in [(0.8, 0.99999), (0.8, 0.99), (0.5, 0.99), (0.95, 0.999)]:
        bands, rows = jj.bands_for(similarity, recall)
        assert bands * rows <= jj.MOST_HASHES and 1 - (1 - similarity**rows) ** bands >= recall
    with pytest.raises(ValueError):
        jj.bands_for(0.01, 0.999999)


def test_minhash_estimates_similarity():
    draw = np.random.default_rng(3)
    seeds = jj.seeds_of(96)
    for share in (0.3, 0.6, 0.9):
        common = draw.integers(0, 2**63, 2000, dtype=np.uint64)
        own = [np.unique(np.concatenate([common, draw.integers(0, 2**63, int(2000 * (1 - share) / share / 2), dtype=np.uint64)])) for _ in range(2)]
        a, b = (jj.band_hashes(jj.mix(x), seeds, 96) for x in own)
        assert abs(sum(x == y for x, y in zip(a, b)) / 96 - share) < 0.2


def test_shared_counts(monkeypatch):
    monkeypatch.setattr(jj, "COLUMNS", 5)
    draw = random.Random(8)
    sets = [np.array(sorted(draw.sample(range(60), draw.randint(1, 40))), dtype=np.int64) for _ in range(20)]
    got = jj.shared_counts(sets)
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert all(got[i][j] == want[i][j] for i in range(20) for j in range(20) if i != j)


def test_keep_one(spark):
    prepare(spark)
    docs = cases.docs(spark, near_copies())
    docs = docs.union(docs.where("doc_id < 3"))
    kept = jj.keep_one(docs)
    assert kept.columns == docs.columns
    classes = {c for d, c, *_ in brute([(r.doc_id, r.text) for r in docs.collect() if grams(r.text)])}
    rows = kept.collect()
    assert sorted(r.doc_id for r in rows if grams(r.text)) == sorted(classes)
    assert sum(not grams(r.text) for r in rows) == sum(not grams(r.text) for r in docs.collect())
    edge = cases.edge_docs(spark)
    assert jj.keep_one(edge).columns == edge.columns


def test_empty_table(spark):
    prepare(spark)
    assert jj.join(cases.empty_docs(spark)).collect() == []
    assert jj.keep_one(cases.empty_docs(spark)).collect() == []


def test_components(spark):
    prepare(spark)
    names = [f"{i:03d}".encode() for i in range(40)]
    chain = [(names[i], names[i + 1]) for i in range(0, 29)] + [(names[30], names[39]), (names[35], names[39])]
    edges = spark.createDataFrame(chain, "a binary, b binary")
    nodes = spark.createDataFrame([(n,) for n in names[:31] + [names[35], names[39]]], "key binary")
    got = {bytes(r.key): bytes(r.label) for r in jj.components(nodes, edges).collect()}
    assert all(got[n] == names[0] for n in names[:30]) and {got[names[i]] for i in (30, 35, 39)} == {names[30]}


def test_rows_of_separators_only_all_stay(spark):
    """Characters that Python takes for white space and Java does not."""
    prepare(spark)
    texts = ["\x1c\x1d", "\x1e", "\x1f \x85", "\u3000", "a b c d e f", "a b c d e f"]
    assert sorted(r.doc_id for r in jj.keep_one(cases.docs(spark, texts)).collect()) == [0, 1, 2, 3, 4]
