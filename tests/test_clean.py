from datetime import date

import pytest
from helpers import T1, T2, T3, as_set, raw, raw_row, reference
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators.clean import curate_reference, curate_statistics
from strata.operators.incremental import EPOCH, newer_than, watermark
from strata.schemas import CURATED_STATISTICS


def test_keys_regions_and_sources(spark):
    df = raw(
        spark,
        raw_row(video_id=None),
        raw_row(video_id=""),
        raw_row("v1", region=" US "),
        raw_row("v2", source="somewhere"),
        raw_row("v3", trending_date_raw="yesterday"),
        raw_row("v4", source="kaggle_historical", trending_date_raw="17.14.11"),
        raw_row("v5", source="kaggle_historical", trending_date_raw="17.31.02"),
        raw_row("v6", source="kaggle_historical", trending_date_raw=T1),
    )
    got = as_set(curate_statistics(df), "video_id", "region", "trending_date_parsed")
    assert got == {("v1", "us", date(2024, 1, 5)), ("v4", "us", date(2017, 11, 14))}
    assert curate_statistics(df).schema.names == CURATED_STATISTICS.names


def test_strict_dates_raise(spark):
    bad = raw(spark, raw_row("v3", trending_date_raw="yesterday"))
    with pytest.raises(Exception, match="unreadable trending date"):
        curate_statistics(bad, strict=True).collect()
    assert curate_statistics(raw(spark, raw_row("v2", source="somewhere")), strict=True).count() == 0


def test_date_forms(spark):
    texts = ["2024-01-05T23:30:00-05:00", "2024-01-05", "2024-13-05", "2024-01-05 10:00:00", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(C.iso_date(F.col("t"))).collect()]
    assert got == [date(2024, 1, 5), date(2024, 1, 5), None, None, None, None]
    df = spark.createDataFrame([("69.01.02",), ("70.01.02",), ("96.29.02",), ("00.29.02",)], "t string")
    got = [r[0] for r in df.select(C.history_date(F.col("t"))).collect()]
    assert got == [date(2069, 2, 1), date(1970, 2, 1), date(1996, 2, 29), date(2000, 2, 29)]


def test_metrics_and_defaults(spark):
    rows = [
        raw_row("a", views=200),
        raw_row("b", views=0),
        raw_row("c", views=None, likes=None, comment_count=None),
        raw_row("d", views=-5),
    ]
    got = as_set(curate_statistics(raw(spark, *rows)), "video_id", "views", "likes", "dislikes", "like_ratio", "engagement_rate")
    assert got == {
        ("a", 200, 10, None, 0.05, 0.075),
        ("b", 0, 10, None, 0.0, 0.0),
        ("c", 0, 0, None, 0.0, 0.0),
        ("d", -5, 10, None, 0.0, 0.0),
    }


def test_latest_wins_and_ties_are_settled(spark):
    rows = [
        raw_row("a", views=1, _ingestion_timestamp=T1),
        raw_row("a", views=2, _ingestion_timestamp=T2),
        raw_row("b", views=3, _source_file="f2"),
        raw_row("b", views=4, _source_file="f1"),
        raw_row("b", region="gb", views=5),
    ]
    for order in (rows, rows[::-1]):
        got = as_set(curate_statistics(raw(spark, *order)), "video_id", "region", "views")
        assert got == {("a", "us", 2), ("b", "us", 4), ("b", "gb", 5)}


def test_texts_are_cast_tolerantly(spark):
    base = raw(spark, raw_row("a"), raw_row("b"), raw_row("c"))
    texts = base.withColumn(
        "views", F.when(F.col("video_id") == "a", "12.0").when(F.col("video_id") == "b", "abc").otherwise("7")
    )
    assert as_set(curate_statistics(texts), "video_id", "views") == {("a", 0), ("b", 0), ("c", 7)}


def test_reference_latest_per_region_case_free(spark):
    ref = reference(
        spark, ("1", "Old", "US", T1), ("1", "New", "us", T2), ("1", "Brit", "gb", T1), (None, "x", "us", T3)
    )
    assert as_set(curate_reference(ref), "id", "region", "category_name") == {("1", "us", "New"), ("1", "gb", "Brit")}


def test_watermark_is_strict_unless_inclusive(spark):
    df = raw(spark, raw_row("a", ts=T1), raw_row("b", ts=T2), raw_row("c", ts=T3))
    assert watermark(df.where("false")) == EPOCH
    assert watermark(df) == T3
    assert as_set(newer_than(df, T2), "video_id") == {("c",)}
    assert as_set(newer_than(df, T2, inclusive=True), "video_id") == {("b",), ("c",)}
    assert newer_than(df, None).count() == 3
    dated = df.withColumn("ingest_date", F.substring("_ingestion_timestamp", 1, 10))
    assert as_set(newer_than(dated, T1), "video_id") == {("b",), ("c",)}
