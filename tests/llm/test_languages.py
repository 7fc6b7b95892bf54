import zlib

import cases
import numpy as np
from pyspark.sql import functions as F
from strata.llm import languages, queries


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang", "text")
    rows = queries.QUERIES["op9_languages"](spark, d).join(lang, "doc_id").collect()
    assert len(rows) == lang.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held)


def test_kernel_against_brute_force():
    texts = ["The the thing", "Das Ding", "à é", "x"]
    sets = []
    for t in texts:
        plain = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        sets.append({plain[i : i + n] for n in (1, 2, 3) for i in range(len(plain) - n + 1)})
    want = np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in sets[:2]] for a in sets])
    codes = [languages.grams(t) for t in texts]
    assert np.allclose(languages.Space.of(codes[:2]).kernel(codes), want)


def test_product_in_parts_and_a_text_longer_than_a_part(monkeypatch):
    texts = [languages.grams(t) for t in ["the thing " * 40, "das ding", "".join(map(chr, range(0x4E00, 0x5E00))), "x"]]
    whole = languages.Space.of(texts[:3]).kernel(texts)
    monkeypatch.setattr(languages, "PRODUCT", 10)
    assert np.array_equal(languages.Space.of(texts[:3]).kernel(texts), whole)


def test_memory_of_long_texts_of_many_signs():
    """120 texts of 20 000 Chinese characters: the model and a group's product stay small."""
    import tracemalloc

    draw = np.random.default_rng(1)
    texts = [languages.grams("".join(map(chr, draw.integers(0x4E00, 0x9FFF, 20_000)))) for _ in range(120)]
    tracemalloc.start()
    space = languages.Space.of(texts[:96])
    values = space.kernel(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(np.diag(values[:96]), 1)
    assert space.size_bytes < 150e6 and peak < 500e6


def test_many_languages_and_long_landmarks(spark, monkeypatch):
    monkeypatch.setattr(languages, "ALL_LANDMARKS", 6)
    monkeypatch.setattr(languages, "LANDMARK_BYTES", 60)
    words = {"aa": "abc", "bb": "xyz", "cc": "mno"}
    docs = [(i, " ".join([words[k]] * (3 + i % 40)), k) for k in words for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = languages.fit(df)
    assert len(model.space.sizes) <= 6
    assert all(r.lang_pred == k for k in words for r in languages.predict(df.where(F.col("lang") == k), model).collect())
    # No text is short enough: the long ones serve.
    assert languages.fit(df.where(F.length("text") > 80)).languages == ["aa", "bb", "cc"]


def test_edges(spark, tmp_path):
    folder = cases.written(spark, tmp_path, documents=cases.edge_docs(spark))
    rows = queries.QUERIES["op9_languages"](spark, folder).collect()
    assert len(rows) == cases.edge_docs(spark).count()
    by = {(r.doc_id): r for r in rows}
    assert by[0].lang_pred == by[1].lang_pred == by[2].lang_pred == "und" and by[0].score == 0
    assert by[3].lang_pred == "en"


def test_nothing_to_learn_from(spark):
    docs = cases.docs(spark, ["one", None])
    assert languages.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert [r.lang_pred for r in languages.predict(docs, None).collect()] == ["und", "und"]
    assert languages.predict(cases.empty_docs(spark), None).collect() == []
