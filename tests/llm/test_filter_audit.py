import re
from itertools import permutations

import cases
import compare
import pytest
from strata.llm import filter_audit, queries
from strata.llm.common import prepare

LABELS = "doc_id bigint, quality int, toxic int"


def brute(rows, labels):
    """Document by document, order by order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    judged = []
    for doc_id, text, part in rows:
        text = text or ""
        words = re.findall(r"[^ \t-\r]+", text)
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
        fails += "E" * (doc_id is not None and doc_id > first[text])
        judged.append((part or "", fails, doc_id in good, doc_id in toxic))
    out, removed_by = {}, {}
    for part in {p for p, *_ in judged}:
        own = [j[1:] for j in judged if j[0] == part]
        for order in map("".join, permutations("ABCDE")):
            there = [True] * len(own)
            for step, letter in enumerate(order, 1):
                counts = [0] * 6
                for i, (fails, is_good, is_toxic) in enumerate(own):
                    failing = letter in fails
                    counts[0] += there[i] and not failing
                    counts[1] += there[i] and failing
                    counts[2] += failing and not there[i]
                    counts[3] += fails == letter
                    counts[4] += there[i] and failing and is_good
                    counts[5] += there[i] and failing and is_toxic
                    there[i] = there[i] and not failing
                out[part, order, step] = counts
                removed_by[part, letter] = removed_by.get((part, letter), 0) + counts[1]
    return sorted((*key, *counts, removed_by[key[0], key[1][key[2] - 1]]) for key, counts in out.items())


def result(df):
    return sorted(tuple(r) for r in df.select("part", "filter_order", "step", *filter_audit.COUNTS, "shapley").collect())


def label_rows():
    return [(1, 1, 0), (3, None, 1), (4, 1, 1), (4, 0, 0), (5, 1, None), (None, 1, 1), (900, 1, 1)]


def test_edge_rows_against_brute_force(spark, tmp_path):
    docs = cases.edge_docs(spark)
    texts = ["word " * 300, "A B C " * 100, "plain words " * 120, "plain words " * 120, "cost $5 " + "of it all " * 90]
    texts += [" ".join(f"w{i}" for i in range(250))] * 3 + [" ".join(f"x{i}" for i in range(199))]
    more = spark.createDataFrame([(100 + i, t, "fr", None, None) for i, t in enumerate(texts)], cases.SCHEMA)
    names = [c for c in docs.columns if c not in more.columns]
    docs = docs.unionByName(more.selectExpr("*", *[f"'x' as `{n}`" for n in names]))
    labels = spark.createDataFrame(label_rows() + [(102, 1, 0), (103, 1, 1)], LABELS)
    folder = cases.written(spark, tmp_path, documents=docs, labels=labels.selectExpr("*", "'c' as lang", "1 as n"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    assert result(queries.QUERIES["op13_filter_audit"](spark, folder)) == brute(rows, [tuple(r) for r in labels.collect()])


def test_driver_rows_against_brute_force_and_sql(spark):
    got = queries.QUERIES["op13_filter_audit"](spark, cases.SF)
    docs, labels = cases.driver_docs(spark), spark.read.parquet(f"{cases.SF}/labels.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    assert result(got) == brute(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert compare.differences(got, compare.connect(cases.SF), queries.ORACLES["op13_filter_audit"]) == []


@pytest.mark.parametrize("labels", [[], [(1, 1, 1)]])
def test_empty_tables(spark, tmp_path, labels):
    folder = cases.written(spark, tmp_path, documents=cases.empty_docs(spark), labels=spark.createDataFrame(labels, LABELS))
    assert queries.QUERIES["op13_filter_audit"](spark, folder).collect() == []


def test_other_sets_of_filters(spark):
    prepare(spark)
    cells = spark.createDataFrame([("p", m, g, 0, 1 + m) for m in range(4) for g in (0, 1)], "part string, mask int, good int, toxic int, n bigint")
    got = {tuple(r)[:3]: r for r in filter_audit.audit(cells, "XY").collect()}
    assert set(got) == {("p", o, s) for o in ("XY", "YX") for s in (1, 2)}
    assert got["p", "XY", 2].kept == 2 and got["p", "XY", 1].removed == 12 and got["p", "XY", 1].good_lost == 6
    assert got["p", "XY", 1].shapley == 12 + 4


def test_texts_are_read_once_and_no_python(spark):
    plan = queries.QUERIES["op13_filter_audit"](spark, cases.SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan
