import random
import zlib
from collections import Counter, defaultdict
from math import isclose, log10

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F
from strata.llm import language_model as lm
from strata.llm import queries
from strata.llm.common import prepare


def lowered(text):
    return (text or "").encode().lower().decode()


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute(rows):
    """Scores by the recursion over contexts, with all counts in one place."""
    words, counts = Counter(), Counter()
    after = defaultdict(set)
    for doc_id, text in rows:
        if is_held(doc_id):
            continue
        words.update([*lowered(text).encode().split(), b""])
        signs = ["S"] * 3 + list(lowered(text)) + ["E" * 2]
        for i in range(3, len(signs)):
            for k in range(4):
                context, x = tuple(signs[i - k : i]), signs[i]
                counts[context, x] += 1
                after[context].add(x)
    totals = Counter()
    for (context, _), n in counts.items():
        totals[context] += n

    def chance(context, x):
        lower = chance(context[1:], x) if context else lm.UNSEEN
        if not totals[context]:
            return lower
        seen = max(counts[context, x] - lm.DISCOUNT, 0) / totals[context]
        return seen + lm.DISCOUNT * len(after[context]) / totals[context] * lower

    n, v = sum(words.values()), len(words)
    out = []
    for doc_id, text in rows:
        own = [*lowered(text).encode().split(), b""]
        signs = ["S"] * 3 + list(lowered(text)) + ["E" * 2]
        score = sum(log10(chance(tuple(signs[i - 3 : i]), signs[i])) for i in range(3, len(signs)))
        base = sum(log10((words[w] + 1) / (n + v + 1)) for w in own)
        out.append((repr(doc_id), is_held(doc_id), len(own), sum(words[w] > 0 for w in own), n, base, score))
    return sorted(out)


@pytest.mark.parametrize("block,dense", [(lm.BLOCK_CHARS, lm.DENSE), (3000, 0)])
@pytest.mark.parametrize("source", ["driver", "edge"])
def test_query_against_brute_force(spark, tmp_path, monkeypatch, source, block, dense):
    monkeypatch.setattr(lm, "BLOCK_CHARS", block)
    monkeypatch.setattr(lm, "DENSE", dense)
    docs = cases.driver_docs(spark).orderBy("doc_id").limit(60) if source == "driver" else cases.edge_docs(spark).where("text is null or length(text) < 20000")
    folder = cases.written(spark, tmp_path, documents=docs)
    got = sorted((repr(r[0]), *r[1:]) for r in queries.QUERIES["op8_language_model"](spark, folder).collect())
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and isclose(g[6], w[6], rel_tol=1e-7, abs_tol=1e-7), (g, w)


def test_lanes_and_many_letters_change_nothing(monkeypatch):
    draw = random.Random(2)
    texts = ["".join(draw.choices("abcd ef", k=n)) for n in (0, 1, 2, 3, 255, 256, 257, 700)]
    points, begins = lm.points_of(texts)
    counts = lm._gram_counts(points, np.ones(len(points), bool))
    contexts, kinds = Counter(), Counter()
    for g, n in counts.items():
        contexts[g[:-4]] += n
        kinds[g[:-4]] += 1
    grams = [(g, counts.get(g, 0), contexts.get(g), kinds.get(g)) for g in counts.keys() | contexts.keys()]
    whole = lm.Automaton(grams).score(points, begins)
    monkeypatch.setattr(lm, "LANE", 7)
    assert np.allclose(whole, lm.Automaton(grams).score(points, begins))
    alone = [lm.Automaton(grams).score(*lm.points_of([t]))[0] for t in texts]
    assert np.allclose(whole, alone)


def test_gram_counts_with_few_and_many_letters(monkeypatch):
    texts = ["abcab", "", "cab", "".join(map(chr, range(0x4E00, 0x4E00 + 900)))]
    many = ["".join(map(chr, range(0x10000, 0x10000 + 50_000))), "ab"]
    for own in (texts, many):
        points, begins = lm.points_of(own)
        trained = np.repeat([True, True, False, True][: len(own)], np.diff(np.append(begins, len(points))))
        want = Counter()
        for i in range(len(points)):
            if points[i] != lm.START:
                for k in range(lm.ORDER):
                    want[points[i - k : i + 1].tobytes()] += int(trained[i])
        assert lm._gram_counts(points, trained) == want


def test_held_out_text_is_likelier_than_its_shuffle(spark):
    """The model knows the order of characters, of texts it has not learned from."""
    prepare(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = [r for r in docs.collect() if is_held(r.doc_id) and len(r.text) > 500][:30]
    draw = random.Random(1)
    mixed = [(-r.doc_id - 1, "".join(draw.sample(r.text, len(r.text)))) for r in held]
    more = spark.createDataFrame(mixed, docs.schema)
    out = F.col("doc_id").isin([r.doc_id for r in held]) | (F.col("doc_id") < 0)
    scores = {r.doc_id: r.score for r in lm.score(docs.unionByName(more), out).where(out).collect()}
    assert all(scores[r.doc_id] > 0.8 * scores[-r.doc_id - 1] for r in held)


def test_empty_table_and_nothing_to_learn_from(spark):
    prepare(spark)
    assert lm.score(cases.empty_docs(spark), F.lit(False)).collect() == []
    row = lm.score(cases.docs(spark, ["ab"]), F.lit(True)).first()
    assert isclose(row.score, 3 * log10(lm.UNSEEN), rel_tol=1e-9) and row.train_tokens == 0 and row.n_known == 0
