import pytest
from helpers import T2, as_set, document, item, write_json

from strata.schemas import COUNTERS, CURATED_KEY, QUARANTINE
from strata.streaming import ingest
from strata.tables import Table

RUN = "2024-03-01T00:00:00.000000+00:00"


def test_files_are_taken_once_in_bounded_batches(spark, tmp_path):
    landing, raw, checkpoint = (str(tmp_path / n) for n in ("landing", "raw", "check"))
    for i in range(5):
        write_json(tmp_path / f"landing/region=us/{i}.json", document([item(f"v{i}")]))
    write_json(tmp_path / "landing/region=us/bad.json", "{ nope")

    def run():
        ingest.ingest_available(spark, landing, raw, checkpoint, RUN, files_per_batch=2)
        return ingest.read_ingested(spark, raw).count()

    assert run() == 5
    assert run() == 5
    write_json(tmp_path / "landing/region=gb/new.json", document([item("n1"), item("n2")], region="gb"))
    assert run() == 7


def test_records_and_counters_are_kept_once_and_by_file(spark, tmp_path):
    landing, raw, checkpoint, bad, counters = (str(tmp_path / n) for n in ("landing", "raw", "check", "bad", "counters"))
    for i in range(3):
        write_json(tmp_path / f"landing/region=us/{i}.json", document([item(f"v{i}"), item(f"w{i}")]))
    write_json(tmp_path / "landing/region=us/bad.json", "{ nope")
    (tmp_path / "landing/region=gb").mkdir()
    (tmp_path / "landing/region=gb/[1] b.csv").write_text("video_id,views\nc,1\nd,1,2\ne,3\n")
    (tmp_path / "landing/region=gb/c.txt").write_text("not taken")

    def run():
        taken = ingest.ingest_available(spark, landing, raw, checkpoint, RUN, files_per_batch=2, quarantine_path=bad, counters_path=counters)
        rows = ingest.read_batches(spark, counters, COUNTERS, taken).collect()
        return {(r["region"], r["file"].rsplit("/", 1)[1]): (r["rows"], r["quarantined"]) for r in rows}

    assert run() == {
        ("us", "0.json"): (2, 0), ("us", "1.json"): (2, 0), ("us", "2.json"): (2, 0),
        ("us", "bad.json"): (0, 1), ("gb", "[1] b.csv"): (2, 1),
    }
    assert run() == {}
    assert ingest.read_ingested(spark, raw).count() == 8
    assert sorted(r["content"].strip() for r in ingest.read_batches(spark, bad, QUARANTINE).collect()) == ["d,1,2", "{ nope"]
    (tmp_path / "landing/region=gb/late.csv").write_text("views,video_id\n7,f\n")
    assert run() == {("gb", "late.csv"): (1, 0)}
    assert ingest.read_ingested(spark, raw).count() == 9


def test_batch_that_failed_is_taken_again_without_repeats(spark, tmp_path, monkeypatch):
    landing, raw, checkpoint = (str(tmp_path / n) for n in ("landing", "raw", "check"))
    for i in range(4):
        write_json(tmp_path / f"landing/region=us/{i}.json", document([item(f"v{i}")]))
    real, calls = ingest._write_batch, []

    def write(df, path, *rest):
        real(df, path, *rest)
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("driver lost")

    monkeypatch.setattr(ingest, "_write_batch", write)
    with pytest.raises(Exception, match="driver lost"):
        ingest.ingest_available(spark, landing, raw, checkpoint, RUN, files_per_batch=2)
    monkeypatch.setattr(ingest, "_write_batch", real)
    ingest.ingest_available(spark, landing, raw, checkpoint, RUN, files_per_batch=2)
    assert sorted(r.video_id for r in ingest.read_ingested(spark, raw).collect()) == ["v0", "v1", "v2", "v3"]


def test_region_with_nearly_all_rows_is_written_by_several_tasks(spark, tmp_path):
    """The batch's writers follow its own sizes; a small region keeps one file."""
    path = tmp_path / "landing"
    lines = spark.range(0, 60_000, numPartitions=8).selectExpr(
        "array(named_struct('id', concat('v', id), 'snippet', named_struct('title', md5(cast(id as string))))) as items",
        "if(id % 50 < 49, 'hot', 'cold') as region",
    )
    lines.write.partitionBy("region").json(str(path))
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.shuffle.partitions": "64"}
    saved = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        ingest.ingest_available(spark, str(path), str(tmp_path / "raw"), str(tmp_path / "check"), RUN, multi_line=False)
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)
    files = {r: len(list((tmp_path / "raw").glob(f"batch=*/region={r}/*/*.parquet"))) for r in ("hot", "cold")}
    assert files["hot"] >= 4 and files["cold"] == 1
    assert ingest.read_ingested(spark, str(tmp_path / "raw")).count() == 60_000


def test_streamed_upsert_equals_batch(spark, tmp_path):
    landing, raw, checkpoint = (str(tmp_path / n) for n in ("landing", "raw", "check"))
    table = Table(spark, str(tmp_path / "table"), ["region", "trending_date_parsed"])

    def run():
        ingest.ingest_available(spark, landing, raw, checkpoint, RUN)
        ingest.upsert_available(spark, raw, table, str(tmp_path / "upsert"))

    write_json(tmp_path / "landing/region=us/1.json", document([item("a", views="1"), item("b", views="2")]))
    run()
    write_json(tmp_path / "landing/region=us/2.json", document([item("a", views="10"), item("c")], ts=T2))
    run()
    run()
    assert as_set(table.read(), "video_id", "views") == {("a", 10), ("b", 2), ("c", 100)}
    assert table.read().groupBy(*CURATED_KEY).count().where("count > 1").count() == 0
