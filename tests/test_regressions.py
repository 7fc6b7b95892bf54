"""Cases that once lost rows or brought old ones back."""

from __future__ import annotations

import os
import time

import pytest
from helpers import T1, T2, document, item, raw, raw_row, write_json

from strata import files
from strata.operators import quality
from strata.operators.clean import curate_statistics
from strata.plans import serve
from strata.schemas import CURATED_KEY
from strata.sources import landing
from strata.streaming import ingest
from strata.tables import Table


def curated(spark, *rows):
    return curate_statistics(raw(spark, *rows))


def test_new_file_with_an_old_time_is_ingested(spark, tmp_path):
    where = [str(tmp_path / x) for x in ("landing", "raw", "check")]
    write_json(tmp_path / "landing/region=us/a.json", document([item("a")]))
    ingest.ingest_available(spark, *where, T1)
    late = tmp_path / "landing/region=us/b.json"
    write_json(late, document([item("b")]))
    old = time.time() - 30 * 86400
    os.utime(late, (old, old))
    ingest.ingest_available(spark, *where, T1)
    assert sorted(r.video_id for r in ingest.read_ingested(spark, where[1]).collect()) == ["a", "b"]


def test_older_row_does_not_replace_a_newer_one(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), ["region", "trending_date_parsed"])
    order = ["_ingestion_timestamp"]
    table.upsert(curated(spark, raw_row("a", views=500, ts=T2)), CURATED_KEY, order)
    table.upsert(curated(spark, raw_row("a", views=1, ts=T1), raw_row("b", views=2, ts=T1)), CURATED_KEY, order)
    assert {(r.video_id, r.views) for r in table.read().collect()} == {("a", 500), ("b", 2)}
    table.upsert(curated(spark, raw_row("a", views=7, ts=T2)), CURATED_KEY, order)
    assert {(r.video_id, r.views) for r in table.read().collect()} == {("a", 7), ("b", 2)}


def test_interrupted_upsert_is_settled_before_the_next_write(spark, tmp_path, monkeypatch):
    table = Table(spark, str(tmp_path / "t"), ["region", "trending_date_parsed"])
    table.upsert(curated(spark, raw_row("a", views=1)), CURATED_KEY)
    with monkeypatch.context() as broken:
        real, calls = Table._apply_pending, []

        def apply(self):
            calls.append(1)
            if len(calls) > 1:
                raise RuntimeError("lost")
            real(self)

        broken.setattr(Table, "_apply_pending", apply)
        with pytest.raises(RuntimeError):
            table.upsert(curated(spark, raw_row("a", views=2)), CURATED_KEY)
    table.replace(curated(spark, raw_row("c", views=3)))
    assert not files.exists(spark, f"{table.path}/_pending.json")
    table.upsert(curated(spark, raw_row("c", views=4)), CURATED_KEY)
    assert {(r.video_id, r.views) for r in table.read().collect()} == {("c", 4)}


def test_times_are_stored_in_one_form(spark, tmp_path):
    for name, ts in [("a", "2024-01-05T10:00:00Z"), ("b", "2024-01-05T12:00:00.9+02:00"), ("c", "junk")]:
        write_json(tmp_path / f"region=us/{name}.json", document([item(name)], ts=ts))
    rows = landing.normalize_snapshots(landing.read_documents(spark, str(tmp_path), landing.SNAPSHOT_DOCUMENT), T2).collect()
    assert {r.video_id: r._ingestion_timestamp for r in rows} == {
        "a": "2024-01-05T10:00:00.000000+00:00",
        "b": "2024-01-05T10:00:00.900000+00:00",
        "c": "junk",
    }


def test_file_that_breaks_while_it_is_read_fails_its_table_only(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "bad"))
    for part in (tmp_path / "bad").glob("part-*"):
        part.write_bytes(b"PAR1 no parquet PAR1")
    tables = {n: lambda n=n: spark.read.schema("id bigint").parquet(str(tmp_path / n)) for n in ("good", "bad")}
    counts = {r.table_name: r.row_count for r in serve.row_counts(spark, tables).collect()}
    assert counts == {"good": "3", "bad": "n/a"}
    checks = lambda df, name: quality.run(df, name, [quality.row_count(1)])
    report = {r.table_name: r.passed for r in quality.run_all(spark, tables, checks).collect()}
    assert report == {"good": True, "bad": False}
