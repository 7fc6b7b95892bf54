import json
from datetime import date
from pathlib import Path

import pytest
from helpers import T1, T2, T3, as_set, raw, raw_row
from pyspark.sql import functions as F

from strata import files
from strata.operators.clean import curate_statistics
from strata.schemas import CURATED_KEY
from strata.tables import KeyProblem, Lake, Table

LAYOUT = ["region", "trending_date_parsed"]


def curated(spark, *rows):
    return curate_statistics(raw(spark, *rows))


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, str(tmp_path / "t"), LAYOUT)


def test_append_and_pruned_read(spark, table):
    assert table.append(curated(spark, raw_row("a"), raw_row("b", region="gb"))) == 2
    assert table.append(curated(spark, raw_row("c"))) == 1
    assert table.append(curated(spark, raw_row("c")).where("false")) == 0
    assert as_set(table.read(["us"]), "video_id") == {("a",), ("c",)}
    assert table.read().dtypes == curated(spark, raw_row("a")).dtypes


def test_unknown_table(table):
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()


def test_upsert_replaces_and_inserts(spark, table):
    table.upsert(curated(spark, raw_row("a", views=1), raw_row("b", views=1, region="gb")), CURATED_KEY)
    before = {f.name for f in Path(table.data_path).rglob("region=gb/**/*.parquet")}
    table.upsert(curated(spark, raw_row("a", views=2, ts=T2), raw_row("c", views=3, ts=T3)), CURATED_KEY)
    assert as_set(table.read(), "video_id", "views", "trending_date_parsed") == {
        ("a", 2, date(2024, 1, 5)), ("b", 1, date(2024, 1, 5)), ("c", 3, date(2024, 1, 6)),
    }
    after = {f.name for f in Path(table.data_path).rglob("region=gb/**/*.parquet")}
    assert before == after, "a partition the batch does not touch is not rewritten"


def test_upsert_equals_dedup_of_everything(spark, table):
    rows = [
        raw_row(f"v{i % 17}", region=["us", "gb", "de"][i % 3], views=i, ts=f"2024-01-0{1 + i // 25}T00:00:{i % 25:02d}.000000+00:00")
        for i in range(100)
    ]
    for start in range(0, 100, 30):
        table.upsert(curated(spark, *rows[start : start + 30]), CURATED_KEY)
    assert sorted(table.read().collect()) == sorted(curated(spark, *rows).collect())


def test_upsert_twice_changes_nothing(spark, table):
    batch = curated(spark, raw_row("a"), raw_row("b"))
    table.upsert(batch, CURATED_KEY)
    table.upsert(batch, CURATED_KEY)
    assert table.upsert(batch.where("false"), CURATED_KEY) == 0
    assert sorted(table.read().collect()) == sorted(batch.collect())


@pytest.mark.parametrize("first", [True, False])
def test_upsert_rejects_bad_keys(spark, table, first):
    good = curated(spark, raw_row("a"))
    if not first:
        table.upsert(good, CURATED_KEY)
    bad_batches = [
        good.withColumn("region", F.lit(None).cast("string")),
        good.unionByName(good),
        *([] if first else [good.withColumn("region", F.lit(""))]),
    ]
    for bad in bad_batches:
        with pytest.raises(KeyProblem):
            table.upsert(bad, CURATED_KEY)
    assert table.exists() is not first
    if not first:
        assert sorted(table.read().collect()) == sorted(good.collect())


def test_new_column_is_appended(spark, table):
    table.upsert(curated(spark, raw_row("a")), CURATED_KEY)
    wider = curate_statistics(raw(spark, raw_row("b")).withColumn("lang", F.lit("en")))
    table.upsert(wider, CURATED_KEY)
    assert table.read().columns[-1] == "lang"
    assert as_set(table.read(), "video_id", "lang") == {("a", None), ("b", "en")}
    table.upsert(curated(spark, raw_row("c")), CURATED_KEY)
    assert as_set(table.read(), "video_id", "lang") == {("a", None), ("b", "en"), ("c", None)}


def test_interrupted_upsert_is_completed_by_the_next(spark, table, monkeypatch):
    table.upsert(curated(spark, raw_row("a", views=1), raw_row("x", views=9)), CURATED_KEY)
    real = Table._apply_pending

    def die(self):
        if files.exists(self.spark, f"{self.path}/_pending.json"):
            raise RuntimeError("driver lost")
        real(self)

    monkeypatch.setattr(Table, "_apply_pending", die)
    with pytest.raises(RuntimeError):
        table.upsert(curated(spark, raw_row("a", views=2, ts=T2)), CURATED_KEY)
    assert as_set(table.read(), "video_id", "views") == {("a", 1), ("x", 9)}
    monkeypatch.setattr(Table, "_apply_pending", real)
    table.upsert(curated(spark, raw_row("b", views=3)), CURATED_KEY)
    assert as_set(table.read(), "video_id", "views") == {("a", 2), ("b", 3), ("x", 9)}


def test_replace_switches_and_can_read_itself(spark, table):
    table.replace(curated(spark, raw_row("a")))
    first = table.data_path
    table.replace(table.read().withColumn("views", F.col("views") + 1))
    assert table.data_path != first
    assert as_set(table.read(), "video_id", "views") == {("a", 101)}


def test_failed_replace_leaves_old_data(spark, table):
    table.replace(curated(spark, raw_row("a")))
    broken = curated(spark, raw_row("b")).withColumn("views", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception, match="boom"):
        table.replace(broken)
    assert as_set(table.read(), "video_id") == {("a",)}


def test_register_in_catalog(spark, table):
    table.replace(curated(spark, raw_row("a")), register="enriched.t1")
    table.replace(curated(spark, raw_row("b"), raw_row("c", region="gb")), register="enriched.t1")
    assert spark.table("enriched.t1").where("region = 'us'").select("video_id").first()[0] == "b"
    assert spark.table("enriched.t1").count() == 2


def test_partition_overwrite_with_new_column(spark, tmp_path):
    table = Table(spark, str(tmp_path / "p"), ["region"])
    table.overwrite_partitions(spark.createDataFrame([("us", 1), ("gb", 2)], "region string, v int"))
    table.overwrite_partitions(spark.createDataFrame([("us", 5, "n")], "region string, v int, note string"))
    assert as_set(table.read(), "region", "v", "note") == {("us", 5, "n"), ("gb", 2, None)}


def test_layer_names_are_literal(spark):
    lake = Lake(spark, "/lake/", {"enriched": " enriched_db "})
    assert lake.path("enriched", "m") == "/lake/enriched_db/m"
    assert lake.path("raw", "m") == "/lake/raw/m"


def test_descriptor_is_plain(spark, table):
    table.replace(curated(spark, raw_row("a")))
    text = files.read_text(spark, f"{table.path}/_table.json")
    assert json.loads(text)["partition_by"] == LAYOUT


def test_unpartitioned_upsert(spark, tmp_path):
    table = Table(spark, str(tmp_path / "flat"))
    table.upsert(curated(spark, raw_row("a", views=1), raw_row("x", views=9)), CURATED_KEY)
    table.upsert(curated(spark, raw_row("a", views=2, ts=T2), raw_row("b", views=3, ts=T3)), CURATED_KEY)
    assert as_set(table.read(), "video_id", "views") == {("a", 2), ("x", 9), ("b", 3)}


def test_partition_columns_must_be_in_the_key(spark, table):
    with pytest.raises(ValueError):
        table.upsert(curated(spark, raw_row("a")), ["video_id"])
