import sys
from pathlib import Path

import cases

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from test_decontaminate import dec  # noqa: E402
from test_jaccard_join import brute as classes_of  # noqa: E402


def test_stages_in_turn(spark):
    docs = cases.driver_docs(spark)
    items = [dec.normal(r.text) for r in spark.read.parquet(f"{cases.SF}/benchmark.parquet").collect()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(step(spark, docs, cases.SF).collect(), docs.schema)
        after = {r.doc_id: r for r in docs.collect()}
        assert after.keys() <= before.keys() and 0 < len(after)
        if name == "jaccard_join":
            assert sorted(after) == sorted({c for _, c, *_ in classes_of([(r.doc_id, r.text) for r in before.values()])})
        if name == "decontamination":
            assert not any(i in dec.normal(r.text) for r in after.values() for i in items)
            assert all(any(i in dec.normal(before[d].text) for i in items) for d in before.keys() - after.keys())
        if name == "personal_data":
            assert after.keys() == before.keys() and not any("@mail" in r.text for r in after.values())
        else:
            assert all(after[d] == before[d] for d in after)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, cases.SF)
    whole = corpus_pipeline.run(spark, cases.SF)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, last.collect()))


def test_edge_rows_and_empty_table(spark, tmp_path):
    items = spark.read.parquet(f"{cases.SF}/benchmark.parquet")
    folder = cases.written(spark, tmp_path / "edge", documents=cases.edge_docs(spark), benchmark=items)
    assert corpus_pipeline.run(spark, folder).count() >= 0
    folder = cases.written(spark, tmp_path / "none", documents=cases.empty_docs(spark), benchmark=items)
    assert corpus_pipeline.run(spark, folder).collect() == []
