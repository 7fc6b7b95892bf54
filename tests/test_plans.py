"""The physical plans the jobs are meant to have."""

from pathlib import Path

import pytest
from helpers import T1, as_set, raw, raw_row, reference

from strata.operators import enrich
from strata.operators.clean import curate_reference, curate_statistics
from strata.operators.rank import top_within
from strata.session import stage
from strata.tables import Table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stats(spark):
    rows = [raw_row(f"v{i}", region=["us", "gb"][i % 2], category_id=str(i % 4), views=i) for i in range(40)]
    return stage(curate_statistics(raw(spark, *rows)), "plans")


@pytest.fixture(scope="module")
def lookup(spark):
    return stage(curate_reference(reference(spark, ("1", "One", "us", T1), ("2", "Two", "gb", T1))), "plans")


def test_key_filter_reaches_the_scan_and_dedup_is_limited_before_the_shuffle(spark):
    staged = stage(raw(spark, raw_row("a"), raw_row("b")), "plans")
    text = plan(curate_statistics(staged))
    assert "PushedFilters: [IsNotNull(video_id), Not(EqualTo(video_id,))]" in text
    before, after = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert before < text.index("Exchange hashpartitioning") < after


def test_small_lookup_is_broadcast_and_large_one_is_not_with_equal_results(spark, stats, lookup):
    small = enrich.channel_rollup(stats, lookup)
    assert "BroadcastHashJoin" in plan(small)
    want = sorted(small.collect())
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = enrich.channel_rollup(stats, lookup)
        assert "SortMergeJoin" in plan(large) and "BroadcastHashJoin" not in plan(large)
        assert sorted(large.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_keyed_daily_totals_take_one_narrow_shuffle(stats):
    text = plan(enrich.trending_analytics(stats, keyed=True))
    assert text.count("Exchange") == 1 and "partial_sum" in text
    schema = text[text.index("ReadSchema") :]
    assert "title" not in schema and "description" not in schema


def test_top_k_is_limited_before_the_shuffle(stats):
    text = plan(top_within(enrich.channel_totals(stats), ["region"], "total_views", "channel_title", "r", 10))
    assert text.count("WindowGroupLimit") == 2


def test_region_read_is_pruned(spark, tmp_path, stats):
    table = Table(spark, str(tmp_path / "t"), ["region"])
    table.replace(stats)
    assert "PartitionFilters: [isnotnull(region" in plan(table.read(["us"]))
    assert as_set(table.read(["us"]), "region") == {("us",)}



def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """The rebalance hint splits a region far above the advisory size, and keeps the small ones whole."""
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB", "spark.sql.shuffle.partitions": "64"}
    saved = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        table = Table(spark, str(tmp_path / "t"), ["region"])
        df = spark.range(0, 200_000, numPartitions=8).selectExpr(
            "md5(cast(id as string)) as v", "if(id % 3 < 2, 'hot', concat('r', id % 50)) as region"
        )
        assert table.replace(df) == 200_000
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)
    files_of = {d.name: len(list(d.glob("*.parquet"))) for d in Path(table.data_path).glob("region=*")}
    assert files_of.pop("region=hot") > 4
    assert sorted(files_of.values())[len(files_of) // 2] == 1
    assert table.read().count() == 200_000
