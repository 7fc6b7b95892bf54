from datetime import datetime, timezone

import pytest
from helpers import T1, raw, raw_row
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.clean import curate_statistics
from strata.schemas import CURATED_STATISTICS

NOW = datetime(2024, 1, 6, 10, tzinfo=timezone.utc)


@pytest.fixture
def good(spark):
    return curate_statistics(raw(spark, *[raw_row(f"v{i}") for i in range(20)]))


def statuses(report):
    return {(r["check_name"], r["column_name"]): r["status"] for r in report.collect()}


def test_good_table_passes(good):
    rows = quality.gate(quality.check_curated(good))
    assert len(rows) == 7 + len(CURATED_STATISTICS)


def test_each_check_can_fail(good):
    few = good.limit(9)
    assert statuses(quality.run(few, "t", [quality.row_count(10)]))["row_count", None] == "error"
    i = F.substring("video_id", 2, 9).cast("int")
    for n_null, want in [(1, "pass"), (2, "error")]:
        holes = good.withColumn("title", F.when(i >= n_null, F.col("title")))
        report = quality.run(holes, "t", [quality.null_percentage("title")])
        assert statuses(report)["null_percentage", "title"] == want
        assert quality.failing_null_percentage(holes, "title").count() == (want == "error")
    holes = good.withColumn("video_id", F.when(i > 0, F.col("video_id")))
    assert statuses(quality.run(holes, "t", [quality.not_null("video_id")]))["not_null", "video_id"] == "error"
    for value, want in [(-1, "error"), (0, "pass"), (50_000_000_000, "pass"), (50_000_000_001, "error"), (None, "pass")]:
        odd = good.withColumn("views", F.lit(value).cast("bigint"))
        assert statuses(quality.run(odd, "t", [quality.value_range("views")]))["value_range", "views"] == want
    assert statuses(quality.run(good, "t", [quality.not_null("gone")]))["not_null", "gone"] == "error"


def test_empty_table(good):
    none = good.where("false")
    got = statuses(quality.run(none, "t", [quality.null_percentage("title"), quality.not_null("title"), quality.row_count()]))
    assert got == {("null_percentage", "title"): "pass", ("not_null", "title"): "pass", ("row_count", None): "error"}


@pytest.mark.parametrize("hour,want", [(9, "pass"), (11, "warn")])
def test_freshness_levels(good, hour, want):
    check = quality.freshness("_ingestion_timestamp", NOW.replace(hour=hour))
    assert statuses(quality.run(good, "t", [check]))["freshness", "_ingestion_timestamp"] == want


def test_freshness_error_and_lenient(good):
    late = datetime(2024, 1, 8, tzinfo=timezone.utc)
    assert statuses(quality.run(good, "t", [quality.freshness("_ingestion_timestamp", late)])) == {
        ("freshness", "_ingestion_timestamp"): "error"
    }
    unreadable = good.withColumn("_ingestion_timestamp", F.lit("soon"))
    for lenient, want in [(False, "error"), (True, "pass")]:
        check = quality.freshness("_ingestion_timestamp", NOW, lenient=lenient)
        assert statuses(quality.run(unreadable, "t", [check]))["freshness", "_ingestion_timestamp"] == want


def test_contract(good):
    changed = good.drop("tags").withColumn("views", F.col("views").cast("int"))
    bad = quality.schema_contract(changed, "t", CURATED_STATISTICS).where("not passed")
    assert {r["column_name"] for r in bad.collect()} == {"tags", "views"}
    assert quality.required_columns(good, "t", ["video_id", "x", "y"]).where("not passed").count() == 2


def test_unreadable_table_is_a_record_and_others_go_on(spark, good):
    def missing():
        raise FileNotFoundError("gone")

    report = quality.run_all(
        spark, {"a": missing, "b": lambda: good}, lambda df, name: quality.run(df, name, [quality.row_count()])
    )
    assert {(r["table_name"], r["check_name"], r["passed"]) for r in report.collect()} == {
        ("a", "read_table", False), ("b", "row_count", True),
    }
    total = quality.verdict(report).first()
    assert (total["quality_passed"], total["checks_passed"], total["checks_total"]) == (False, 1, 2)
    with pytest.raises(quality.QualityError) as caught:
        quality.gate(report)
    assert [f["table_name"] for f in caught.value.failed] == ["a"]


def test_legacy_checks(good):
    got = statuses(quality.check_legacy(good.withColumn("views", F.lit(-1).cast("bigint")), "clean_statistics", NOW))
    assert got["value_range_negative", "views"] == "error" and got["value_range_extreme", "views"] == "pass"
    assert got["freshness", "_ingestion_timestamp"] == "pass" and got["schema", None] == "pass"
    bare = good.select("video_id", "views", "region")
    got = statuses(quality.check_legacy(bare, "clean_statistics", NOW, sample=15))
    assert got["null_percentage", "title"] == "error" and got["schema", "title"] == "error"
    assert got["freshness", None] == "pass" and got["row_count", None] == "pass"


def test_checks_take_one_scan(good):
    plan = quality.run(good.sparkSession.read.schema(good.schema).parquet(_saved(good)), "t", quality.curated_checks())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1


def _saved(df):
    from strata.session import scratch_path

    path = scratch_path(df.sparkSession, "quality")
    df.write.parquet(path)
    return path


def test_raw_timestamps_are_one_format():
    from strata.sources.landing import iso_now

    assert iso_now(datetime(2024, 1, 5, 10, tzinfo=timezone.utc)) == T1
