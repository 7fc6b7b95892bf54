from datetime import date

import pytest
from helpers import T1, T3, as_set, raw, raw_row, reference
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import enrich, rank
from strata.operators.clean import curate_reference, curate_statistics
from strata.plans import serve


@pytest.fixture
def stats(spark):
    rows = [
        raw_row("v1", views=100, channel_title="a", category_id="10"),
        raw_row("v1", views=300, channel_title="a", category_id="10", ts=T3),
        raw_row("v2", views=400, channel_title="b", category_id="29"),
        raw_row("v3", views=100, channel_title=None, category_id=None),
        raw_row("v4", views=0, channel_title="z", region="gb", category_id="29"),
    ]
    return curate_statistics(raw(spark, *rows)).cache()


@pytest.fixture
def lookup(spark):
    return curate_reference(reference(spark, ("10", "Music", "US", T1), ("29", "Nonprofits", "us", T1)))


def test_lookup_is_by_region_and_unmatched_is_unknown(stats, lookup):
    got = as_set(enrich.with_category(stats, lookup), "video_id", "region", "category_name")
    assert got == {
        ("v1", "us", "Music"), ("v2", "us", "Nonprofits"), ("v3", "us", "Unknown"), ("v4", "gb", "Unknown"),
    }
    assert as_set(enrich.with_category(stats, None), "category_name") == {("Unknown",)}


def test_trending_both_ways_agree(stats):
    a = enrich.trending_analytics(stats, keyed=True)
    b = enrich.trending_analytics(stats, keyed=False)
    assert sorted(a.collect()) == sorted(b.collect())
    got = as_set(a, "region", "trending_date_parsed", "total_videos", "total_views")
    assert got == {("us", date(2024, 1, 5), 3, 600), ("us", date(2024, 1, 6), 1, 300), ("gb", date(2024, 1, 5), 1, 0)}


def test_channels_rank_and_drop_nameless(stats, lookup):
    mart = enrich.channel_analytics(stats, lookup)
    got = {(r.channel_title, r.region, r.total_videos, r.total_views, tuple(r.categories), r.rank_in_region) for r in mart.collect()}
    assert got == {
        ("a", "us", 1, 400, ("Music",), 1),
        ("b", "us", 1, 400, ("Nonprofits",), 2),
        ("z", "gb", 1, 0, ("Unknown",), 1),
    }


def test_shares_sum_to_100_and_zero_day_is_null(stats, lookup):
    mart = enrich.category_analytics(stats, lookup, keyed=True).cache()
    sums = mart.groupBy("region", "trending_date_parsed").agg(F.sum("view_share_pct").alias("s")).collect()
    assert {(r.region, None if r.s is None else round(r.s, 9)) for r in sums} == {("us", 100.0), ("gb", None)}
    null_category = mart.where("category_id is null").collect()
    assert [(r.category_name, r.total_videos) for r in null_category] == [("Unknown", 1)]


def test_mart_totals_agree(stats, lookup):
    named = stats.where("channel_title is not null")
    by_channel = enrich.channel_rollup(named, lookup).agg(F.sum("total_views")).first()[0]
    by_category = enrich.category_rollup(named, lookup).agg(F.sum("total_views")).first()[0]
    by_day = enrich.trending_analytics(named).agg(F.sum("total_views")).first()[0]
    assert by_channel == by_category == by_day == 800


@pytest.mark.parametrize("partitions,adaptive", [(1, True), (7, False), (40, False)])
def test_spread_rank_equals_window_rank(spark, partitions, adaptive):
    """A hot group of two thirds of the rows, half of the measures tied, some null."""
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.enabled", str(adaptive).lower())
    try:
        _compare_rank(spark)
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def _compare_rank(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 40 != 2, F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 7 != 0, F.col("id") * 7919 % 1000).alias("m"),
        F.concat(F.lit("n"), F.col("id")).alias("t"),
    )
    w = Window.partitionBy("g").orderBy(F.col("m").desc_nulls_last(), "t")
    want = as_set(df.withColumn("r", F.row_number().over(w)), "g", "t", "r")
    got = rank.rank_within(df, ["g"], "m", "t", "r")
    assert got.columns == ["g", "m", "t", "r"]
    assert as_set(got, "g", "t", "r") == want
    top = rank.top_within(df, ["g"], "m", "t", "r", 5)
    assert as_set(top, "g", "t", "r") == {x for x in want if x[2] <= 5}


def test_serving(spark, stats, lookup):
    marts = {
        "trending_analytics": enrich.trending_analytics(stats),
        "channel_analytics": enrich.channel_analytics(stats, lookup),
        "category_analytics": enrich.category_analytics(stats, lookup),
    }
    top = serve.rows(serve.query("top_channels", marts), 1000)
    assert [(r["region"], r["channel_title"]) for r in top] == [("gb", "z"), ("us", "a"), ("us", "b")]
    text = serve.rows(serve.query("top_categories", marts), 1000, as_text=True)
    assert text[-1]["view_share_pct"] == "" and text[0]["total_views"] == "400"
    assert serve.rows(serve.query("trending_summary", marts).where("false"), 1000) == []
    with pytest.raises(serve.TooManyRows):
        serve.rows(spark.range(3), 2)
    with pytest.raises(serve.UnknownQuery):
        serve.query("drop_tables", marts)
    assert "categories" not in serve.extract("channel_analytics", marts["channel_analytics"]).columns
    assert serve.kpis(marts["trending_analytics"]).first()["total_videos"] == 5
    assert [r["channel_title"] for r in serve.region_top(marts["channel_analytics"], "US", ["channel_title"]).collect()] == ["a", "b"]
