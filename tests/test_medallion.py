from datetime import datetime, timezone

import pytest
from helpers import T1, T2, T3, as_set, document, item, write_json

from strata.operators import legacy
from strata.operators.quality import QualityError
from strata.plans.medallion import Landing, Medallion, NothingLanded, RunReport
from strata.plans.older import OlderMedallion
from strata.tables import Lake

NOW = datetime(2024, 1, 5, 12, tzinfo=timezone.utc)
CATEGORIES = [{"id": "10", "snippet": {"title": "Music"}}, {"id": "29", "snippet": {"title": "Nonprofits"}}]


@pytest.fixture
def source(tmp_path):
    stats, ref = tmp_path / "stats", tmp_path / "ref"
    write_json(stats / "region=us/date=2024-01-05/hour=10/a.json", document([item(f"v{i}", views=str(i * 10)) for i in range(12)]))
    write_json(stats / "region=us/broken.json", "{")
    write_json(ref / "region=US/US_category_id.json", {"items": CATEGORIES})
    return Landing(str(stats), str(ref))


@pytest.fixture
def jobs(spark, tmp_path):
    return Medallion(spark, Lake(spark, str(tmp_path / "lake")))


@pytest.mark.parametrize("rescan", [False, True])
def test_run_twice_changes_nothing_then_new_data_arrives(spark, tmp_path, source, jobs, rescan):
    report = jobs.run(source, NOW, rescan=rescan)
    assert report.quarantined == 1
    assert [q["key"].rsplit("/", 1)[1] for q in jobs.quarantine.read().collect()] == ["broken.json"]
    assert report.rows["curated_statistics"] == 12 and report.rows["channel_analytics"] == 1
    curated = sorted(jobs.statistics.read().collect())
    marts = {name: sorted(df.collect()) for name, df in jobs.read_marts().items()}
    assert jobs.run(source, NOW, rescan=rescan).rows["curated_statistics"] == 0
    assert sorted(jobs.statistics.read().collect()) == curated
    assert {name: sorted(df.collect()) for name, df in jobs.read_marts().items()} == marts
    assert jobs.read_raw().count() == (24 if rescan else 12)

    write_json(tmp_path / "stats/region=us/date=2024-01-05/hour=11/b.json", document([item("v1", views="999"), item("new")], ts=T2))
    assert jobs.run(source, NOW, rescan=rescan).rows["curated_statistics"] == 2
    got = {r["video_id"]: r["views"] for r in jobs.statistics.read().collect()}
    assert len(got) == 13 and got["v1"] == 999 and got["v2"] == 20
    channel = jobs.read_marts()["channel_analytics"].first()
    assert (channel["total_videos"], channel["categories"], channel["rank_in_region"]) == (13, ["Music"], 1)


def test_extracts_and_warnings(tmp_path, source, jobs):
    write_json(tmp_path / "stats/region=us/neg.json", document([item("neg", views="-1", channel="c9")]))
    with pytest.raises(QualityError):
        jobs.run(source, NOW)
    report = RunReport()
    jobs.build_marts(report)
    assert jobs.refresh_extracts() == {n: report.rows[n] for n in jobs.extracts}
    assert "categories" not in jobs.extracts["channel_analytics"].read().columns


def test_older_jobs(spark, tmp_path, source):
    jobs = OlderMedallion(spark, Lake(spark, str(tmp_path / "old")), "gold_old")
    texts = ", ".join(f"{n} string" for n in legacy.OUTPUT)
    blank = dict.fromkeys(legacy.OUTPUT)
    rows = [
        blank | {"video_id": f"v{i}", "region": r, "title": "t", "channel_title": "c", "views": "5",
                 "trending_date": "24.05.01", "category_id": "10"}
        for i, r in enumerate(["us"] * 12 + ["gb", "de"])
    ]
    bronze = spark.createDataFrame([tuple(r[n] for n in legacy.OUTPUT) for r in rows], texts)
    assert jobs.clean_statistics(bronze.where("false"), NOW, "j") == {"read": 0, "written": 0}
    counts = jobs.clean_statistics(bronze, NOW, "j")
    assert (counts["read"], counts["written"], counts["negative_views"]) == (13, 13, 0)
    assert jobs.build_gold(NOW)["trending_analytics"] == 2
    assert spark.table("gold_old.channel_analytics").select("categories").first()[0] == ["Unknown"]
    write_json(tmp_path / "ref/region=gb/none.json", {"items": []})
    assert [f["_source_file"].rsplit("/", 1)[1] for f in jobs.clean_reference(source.reference, "2024-01-05T00:00:00").collect()] == ["none.json"]
    jobs.build_gold(NOW)
    assert spark.table("gold_old.channel_analytics").select("categories").first()[0] == ["Music"]
    with pytest.raises(QualityError) as caught:
        jobs.check(NOW)
    assert {(f["table_name"], f["check_name"]) for f in caught.value.failed} == {("clean_reference_data", "row_count")}


def test_changed_days_gives_the_full_marts(tmp_path, source, jobs):
    older = [item(f"o{i}", category="29") for i in range(12)]
    write_json(tmp_path / "stats/region=us/old.json", document(older, ts="2024-01-04T10:00:00.000000+00:00"))
    jobs.run(source, NOW, changed_days=True)
    write_json(tmp_path / "stats/region=us/b.json", document([item("v1", views="999"), item("new", channel="c2")], ts=T2))
    write_json(tmp_path / "stats/region=gb/b.json", document([item("g")], region="gb", ts=T2))
    jobs.run(source, NOW, changed_days=True)
    partial = {name: sorted(df.collect()) for name, df in jobs.read_marts().items()}
    assert len(partial["trending_analytics"]) == 3
    jobs.build_marts(RunReport())
    assert {name: sorted(df.collect()) for name, df in jobs.read_marts().items()} == partial


def test_gate_blocks_the_marts(tmp_path, source, jobs):
    write_json(tmp_path / "stats/region=gb/x.json", document([item(f"w{i}", channel=None) for i in range(3)], region="gb"))
    with pytest.raises(QualityError) as caught:
        jobs.run(source, NOW)
    assert [(f["check_name"], f["column_name"]) for f in caught.value.failed] == [("null_percentage", "channel_title")]
    assert not any(table.exists() for table in jobs.marts.values())


def test_stale_raw_fails_after_the_marts(source, jobs):
    with pytest.raises(QualityError) as caught:
        jobs.run(source, datetime(2024, 1, 9, tzinfo=timezone.utc))
    assert caught.value.failed[0]["check_name"] == "freshness"
    assert all(table.exists() for table in jobs.marts.values())


@pytest.mark.parametrize("rescan", [False, True])
def test_nothing_landed_is_an_error(tmp_path, jobs, rescan):
    for name in ("s", "r"):
        (tmp_path / name).mkdir()
    with pytest.raises(NothingLanded):
        jobs.run(Landing(str(tmp_path / "s"), str(tmp_path / "r")), NOW, rescan=rescan)


def test_history_is_loaded_beside_snapshots(tmp_path, source, jobs):
    folder = tmp_path / "hist/region=us"
    folder.mkdir(parents=True)
    (folder / "USvideos.csv").write_text(
        "video_id,trending_date,title,channel_title,category_id,views,likes,dislikes,comment_count\n"
        "h1,17.14.11,T,C,10,100,1,2,3\n"
    )
    with_history = Landing(source.statistics, source.reference, str(tmp_path / "hist"))
    jobs.run(with_history, NOW)
    got = as_set(jobs.statistics.read().where("source = 'kaggle_historical'"), "video_id", "dislikes", "views")
    assert got == {("h1", 2, 100)}
    assert jobs.statistics.read().count() == 13


def test_repaired_file_needs_inclusive(tmp_path, source, jobs):
    jobs.run(source, NOW)
    write_json(tmp_path / "stats/region=us/late.json", document([item("late")], ts=T1))
    jobs.run(source, NOW)
    assert jobs.statistics.read().where("video_id = 'late'").count() == 0
    jobs.run(source, NOW, inclusive=True)
    assert jobs.statistics.read().where("video_id = 'late'").count() == 1


def test_reference_documents_are_taken_once_by_content(tmp_path, source, jobs):
    jobs.run(source, NOW)
    assert jobs.raw_reference.read().count() == 2
    assert jobs.run(source, NOW).rows["raw_reference_data"] == 0
    assert jobs.raw_reference.read().count() == 2
    changed = [{"id": "10", "snippet": {"title": "Songs"}}, CATEGORIES[1]]
    write_json(tmp_path / "ref/region=US/US_category_id.json", document(changed, ts=T3))
    assert jobs.run(source, NOW).rows["raw_reference_data"] == 2
    assert ("Songs",) in as_set(jobs.reference.read(), "category_name")
    assert jobs.run(source, NOW, rescan=True).rows["raw_reference_data"] == 2


def test_renamed_category_reaches_days_without_new_rows(tmp_path, source, jobs):
    older = [item(f"o{i}", category="29") for i in range(12)]
    write_json(tmp_path / "stats/region=us/old.json", document(older, ts="2024-01-04T10:00:00.000000+00:00"))
    jobs.run(source, NOW, changed_days=True)
    renamed = [CATEGORIES[0], {"id": "29", "snippet": {"title": "Charities"}}]
    write_json(tmp_path / "ref/region=US/new.json", document(renamed, region="US", ts=T3))
    jobs.run(source, NOW, changed_days=True)
    partial = {name: sorted(df.collect()) for name, df in jobs.read_marts().items()}
    assert "Charities" in {r["category_name"] for r in partial["category_analytics"]}
    jobs.build_marts(RunReport())
    assert {name: sorted(df.collect()) for name, df in jobs.read_marts().items()} == partial


def test_mark_is_read_without_a_scan_and_lags_safely(spark, source, jobs, monkeypatch):
    from strata import files
    from strata.plans import medallion

    jobs.run(source, NOW)
    assert files.read_text(spark, jobs.mark_path) == T1
    monkeypatch.setattr(medallion, "watermark", lambda table: pytest.fail("scanned"))
    assert jobs.run(source, NOW).rows["curated_statistics"] == 0
    # As after a run that died between the upsert and the mark.
    files.write_text(spark, jobs.mark_path, "1970-01-01T00:00:00Z")
    before = sorted(jobs.statistics.read().collect())
    jobs.run(source, NOW)
    assert sorted(jobs.statistics.read().collect()) == before
    assert files.read_text(spark, jobs.mark_path) == T1


def test_report_counts_what_a_default_run_landed(tmp_path, source, jobs):
    (tmp_path / "stats/region=gb").mkdir()
    (tmp_path / "stats/region=gb/v.csv").write_text("video_id,trending_date,title,channel_title,views\nh1,17.14.11,T,C,5\nh2,17.14.11,T,C,5,x,y\n")
    report = jobs.run(source, NOW)
    assert report.rows["raw_statistics"] == 13 and report.landed == {"us": 12, "gb": 1} and report.quarantined == 2
    files = {r["file"].rsplit("/", 1)[1]: (r["rows"], r["quarantined"]) for r in jobs.landed_counters().collect()}
    assert files == {"a.json": (12, 0), "broken.json": (0, 1), "v.csv": (1, 1)}
    report = jobs.run(source, NOW)
    assert report.rows["raw_statistics"] == 0 and report.landed == {}


@pytest.mark.parametrize("rescan", [False, True])
def test_a_time_that_is_none_does_not_fail_later_runs(tmp_path, source, jobs, rescan):
    write_json(tmp_path / "stats/region=us/odd.json", document([item("odd")], ts="not known"))
    for _ in range(2):
        jobs.run(source, NOW, rescan=rescan)
    assert jobs.read_raw().where("video_id = 'odd'").select("_ingestion_timestamp").first()[0] == "not known"
    assert jobs.statistics.read().where("video_id = 'odd'").count() == 0


@pytest.mark.parametrize("rescan", [False, True])
def test_csv_alone_is_something_landed(tmp_path, jobs, rescan):
    for name in ("s/region=us", "r"):
        (tmp_path / name).mkdir(parents=True)
    (tmp_path / "s/region=us/v.csv").write_text("video_id,views\n")
    source = Landing(str(tmp_path / "s"), str(tmp_path / "r"))
    with pytest.raises(QualityError):
        jobs.run(source, NOW, rescan=rescan)
