import random
import re
import unicodedata
from collections import Counter

import cases
import pytest
from pyspark.sql import functions as F
from strata.llm import quality_rules, queries
from strata.llm.common import stage

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    n, repeat = len(words), len(covered)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat,
        n < 50 or 100 * repeat > 50 * n,
    )


@pytest.mark.parametrize("source", ["driver", "edge"])
def test_base_counts_against_brute_force(spark, tmp_path, source):
    docs = cases.driver_docs(spark) if source == "driver" else cases.edge_docs(spark)
    folder = cases.written(spark, tmp_path, documents=docs)
    rows = queries.QUERIES["op5_quality"](spark, folder).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows), key=repr)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert not any(r.kept and r.base_failed for r in rows)
    assert all(0 <= r.quality <= 1 for r in rows)


def test_verdicts_agree_with_labels(spark):
    """Documents labelled bad go, good ones of some length stay."""
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    rows = queries.QUERIES["op5_quality"](spark, d).join(labels, "doc_id").collect()
    good = [r for r in rows if r.label == 1 and not r.base_failed]
    bad = [r for r in rows if r.label == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)


def test_fit_finds_a_rule_that_votes_at_random(spark):
    """A rule that calls every third document bad, whatever its kind, loses its weight and no verdict."""
    df = stage(quality_rules.features(cases.driver_docs(spark)), "counts")
    honest = quality_rules.fit(df)
    noisy = df.withColumn("n_bangs", F.when(F.col("doc_id") % 3 == 0, F.col("n_words")).otherwise(F.col("n_bangs")))
    model = quality_rules.fit(noisy)
    weight = lambda m: m.on_bad["bangs"][1] / m.on_good["bangs"][1]
    assert model.on_good["bangs"][1] > 0.1 > honest.on_good["bangs"][1]
    assert weight(model) < weight(honest) / 3
    kept = {r.doc_id for r in quality_rules.judge(df, honest).where("kept").collect()}
    still = {r.doc_id for r in quality_rules.judge(noisy, model).where("kept").collect()}
    assert len(kept & still) >= 0.98 * len(kept)


def test_keep_good_keeps_columns_and_rows(spark):
    docs = cases.driver_docs(spark)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.exceptAll(docs).count() == 0
    assert 0 < kept.count() < docs.count()
    edge = cases.edge_docs(spark)
    assert quality_rules.keep_good(edge).columns == edge.columns


def test_empty_table_and_no_python(spark):
    empty = cases.empty_docs(spark)
    assert quality_rules.fit(quality_rules.features(empty)) == quality_rules.START
    assert quality_rules.keep_good(empty).collect() == []
    plan = quality_rules.keep_good(cases.driver_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


WORDS = {
    "hindi": ("यह एक साफ़ सुंदर दिन और हम सब मिलकर गाँव की नदी के किनारे टहलने जाते हैं लोग बहुत अच्छे", "।"),
    "arabic": ("هَلْ تَعْرِفُ المَدِينَةَ القَدِيمَةَ زُرْنَاهَا في الصَّيْفِ نَعَمْ أَعْرِفُهَا جَيِّدًا وأُحِبُّ شَوَارِعَهَا", "؟"),
    "accents": (unicodedata.normalize("NFD", "été élèves étaient très fatigués après fête école où été déjà là"), "."),
    "thai": ("วันนี้ อากาศ ดีมาก และ พวกเรา ทุกคน ไป เดินเล่น ริม แม่น้ำ หมู่บ้าน เงียบสงบ ผู้คน ใจดี ยิ้มแย้ม เสมอ", ""),
    "chinese": ("今天 天气 很好 我们 河边 散步 村子 很安静 人们 都很 友好 孩子们 院子里 玩耍", "。"),
    # No good vote and no bad one: three words of four are prose, and sentences are longer than 100 words.
    "figures": ("section of act 12 court held on page 77 claim for days under rule 41(b) may stand so long as no 3.5", ""),
}


def test_clean_texts_stay_in_every_script_and_without_a_good_vote(spark):
    draw = random.Random(4)
    word = lambda n: "".join(draw.choices(WORDS[n][0].split(), k=8 if n in ("thai", "chinese") else 1))
    sentence = lambda n: " ".join(word(n) for _ in range(12)) + WORDS[n][1]
    clean = [" ".join(sentence(n) for _ in range(14)) + " end." * (not WORDS[n][1]) for n in WORDS]
    junk = ["#$% &*| <<>> x9 " * 30, "CLICK HERE NOW " * 40, "x9 7q #1 @@ 4k " * 30]
    docs = cases.driver_docs(spark).unionByName(cases.docs(spark, clean + junk, -100))
    df = stage(quality_rules.features(docs), "counts")
    rows = {r.doc_id: r for r in quality_rules.judge(df, quality_rules.fit(df)).where("doc_id < 0").collect()}
    assert not any(rows[i - 100].base_failed for i in range(len(clean)))
    assert [name for i, name in enumerate(WORDS) if not rows[i - 100].kept] == []
    assert not any(rows[i - 100].kept for i in range(len(clean), len(clean + junk)))
