from datetime import datetime, timezone

from helpers import T1, T2, as_set, document, item, write_json
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.schemas import REFERENCE_DOCUMENT, SNAPSHOT_DOCUMENT
from strata.sources import landing

RUN = "2024-03-01T00:00:00.000000+00:00"
NOW = datetime(2024, 3, 1, 5, tzinfo=timezone.utc)


def test_snapshot_documents(spark, tmp_path):
    write_json(tmp_path / "region=us/date=2024-01-05/hour=10/a.json", document([item("v1"), item("v2")]))
    bare = {"id": "v3"}
    no_tags = item("v4")
    no_tags["snippet"]["tags"] = []
    write_json(tmp_path / "region=gb/b.json", {"items": [bare, no_tags]})
    write_json(tmp_path / "elsewhere/c.json", {"items": [item("v5", views="abc")]})
    write_json(tmp_path / "region=us/d.json", {"kind": "no items here"})
    write_json(tmp_path / "region=us/e.json", "this is not JSON {")
    write_json(tmp_path / "region=us/f.txt", "other suffix")
    rows = {r["video_id"]: r for r in landing.read_snapshots(spark, str(tmp_path), RUN).collect()}
    assert sorted(rows) == ["v1", "v2", "v3", "v4", "v5"]
    assert rows["v1"]["region"] == "us" and rows["v1"]["_ingestion_timestamp"] == T1
    assert rows["v1"]["tags"] == "a,b" and rows["v1"]["views"] == 100 and rows["v1"]["dislikes"] is None
    assert rows["v1"]["trending_date_raw"] == T1 and rows["v1"]["source"] == C.API_SOURCE
    assert rows["v3"]["region"] == "gb" and rows["v3"]["_ingestion_timestamp"] == RUN
    assert rows["v3"]["title"] is None and rows["v3"]["views"] is None
    assert rows["v4"]["tags"] is None
    assert rows["v5"]["region"] == "unknown" and rows["v5"]["views"] is None
    assert rows["v5"]["_source_file"].endswith("elsewhere/c.json")


def test_quarantine_names_the_bad_file_only(spark, tmp_path):
    write_json(tmp_path / "region=us/good.json", document([item("v1")]))
    write_json(tmp_path / "region=us/bad file.json", "{ broken")
    docs = landing.read_documents(spark, str(tmp_path), SNAPSHOT_DOCUMENT)
    bad = landing.quarantine(docs).collect()
    assert [r["key"].rsplit("/", 1)[1] for r in bad] == ["bad file.json"]
    assert "broken" in bad[0]["content"]


def test_paths_are_decoded_and_first_region_wins(spark):
    df = spark.createDataFrame(
        [("s3://b/region=us/x.json",), ("a/region=gb/region=us/x",), ("a/b",), ("myregion=us/a",), ("region=/x",)],
        "p string",
    )
    got = [r[0] for r in df.select(C.region_from_path(F.col("p"))).collect()]
    assert got == ["us", "gb", "unknown", "unknown", "unknown"]


def test_reference_documents(spark, tmp_path):
    cat = {"id": "10", "snippet": {"title": "Music", "assignable": True, "channelId": "x"}}
    write_json(tmp_path / "region=us/US_category_id.json", {"kind": "k", "items": [cat]})
    write_json(tmp_path / "region=gb/GB.json", document([cat | {"id": "11"}], region="gb", ts=T2))
    got = as_set(landing.read_reference(spark, str(tmp_path), RUN), "id", "title", "region", "source", "_ingestion_timestamp")
    assert got == {("10", "Music", "us", C.HISTORY_SOURCE, RUN), ("11", "Music", "gb", C.API_SOURCE, T2)}
    only = landing.read_reference(spark, [str(tmp_path / "region=us/US_category_id.json")], RUN)
    assert as_set(only, "id") == {("10",)}


def test_empty_reference_files(spark, tmp_path):
    write_json(tmp_path / "region=us/full.json", {"items": [{"id": "1"}]})
    write_json(tmp_path / "region=gb/none.json", {"items": []})
    docs = landing.read_documents(spark, str(tmp_path), REFERENCE_DOCUMENT)
    assert [r["_source_file"].rsplit("/", 1)[1] for r in landing.empty_reference_files(docs).collect()] == ["none.json"]


def test_history_csv(spark, tmp_path):
    folder = tmp_path / "region=de"
    folder.mkdir()
    (folder / "DEvideos.csv").write_bytes(
        b"video_id,trending_date,title,category_id,views,likes,extra\n"
        b'v1,17.14.11,"he said ""hi"", twice",10,100,5,x\n'
        b'v2,17.14.11,"two\nlines",NA,12.0,,x\n'
        b"v3,17.14.11,bad \xff byte,10,abc,nan,x\n"
    )
    rows = {r["video_id"]: r for r in landing.read_history_csv(spark, str(tmp_path), RUN).collect()}
    assert rows["v1"]["title"] == 'he said "hi", twice' and rows["v1"]["views"] == 100
    assert rows["v2"]["title"] == "two\nlines" and rows["v2"]["category_id"] is None and rows["v2"]["views"] == 12
    assert rows["v3"]["title"] == "bad � byte" and rows["v3"]["views"] is None and rows["v3"]["likes"] is None
    assert rows["v1"]["channel_title"] is None and rows["v1"]["comment_count"] is None
    assert rows["v1"]["region"] == "de" and rows["v1"]["source"] == C.HISTORY_SOURCE
    assert rows["v1"]["trending_date_raw"] == "17.14.11"


def test_csv_files_of_any_header_and_broken_ones(spark, tmp_path):
    texts = {
        "us/a.csv": "video_id,views\na,1\n",
        "gb/b[1] {x}.csv": '\ufeffviews,video_id,title,views\r\n2,b,"T,\nU",9\r\n',
        "de/short.csv": "video_id,title,views\nc,C\nd\n",
        "de/long.csv": 'video_id,views\ne,5\nf,"6","x, ""y"", z"\ng,7\n',
        "fr/other.csv": '\n"video_id", title \nh,H\n',
        "fr/header only.csv": "video_id,views\n",
        "fr/none.csv": "",
        "fr/blank.csv": "\n\n",
        "fr/no.txt": "video_id\nz\n",
    }
    for name, text in texts.items():
        (tmp_path / f"region={name}").parent.mkdir(exist_ok=True)
        (tmp_path / f"region={name}").write_bytes(text.encode())
    rows, bad = landing.read_history(spark, str(tmp_path), RUN)
    assert as_set(rows, "video_id", "views", "region", "title") == {
        ("a", 1, "us", None), ("b", 2, "gb", "T,\nU"), ("c", None, "de", "C"), ("d", None, "de", None),
        ("e", 5, "de", None), ("g", 7, "de", None), ("h", None, "fr", "H"),
    }
    lost = {(r["key"].rsplit("/", 1)[1], r["error"], (r["content"] or "").strip()) for r in bad.collect()}
    assert lost == {
        ("long.csv", "3 cells under a header of 2", 'f,"6","x, ""y"", z"'),
        ("blank.csv", "no header", ""),
    }
    assert as_set(landing.read_history_csv(spark, [str(tmp_path / "region=us"), str(tmp_path / "region=fr")], RUN), "video_id") == {("a",), ("h",)}


def test_no_csv_file_gives_no_rows(spark, tmp_path):
    (tmp_path / "x.json").write_text("{}")
    rows, bad = landing.read_history(spark, str(tmp_path), RUN)
    assert rows.collect() == bad.collect() == []


def test_folder_is_read_by_suffix(spark, tmp_path):
    write_json(tmp_path / "region=us/a.json", document([item("j")]))
    (tmp_path / "region=us/b.csv").write_text("video_id,views\nc,1\n")
    (tmp_path / "region=us/c.parquet").write_text("nothing")
    (tmp_path / "region=us/d.CSV.gz").write_text("nothing")
    for paths in (str(tmp_path), [str(p) for p in (tmp_path / "region=us").iterdir()]):
        rows, bad = landing.read_landed(spark, paths, RUN)
        assert as_set(rows, "video_id", "source") == {("j", C.API_SOURCE), ("c", C.HISTORY_SOURCE)}
        assert bad.collect() == []
    rows, bad = landing.read_landed(spark, [], RUN)
    assert rows.collect() == bad.collect() == []


def test_a_mistyped_field_costs_that_field_only(spark, tmp_path):
    odd_tags = item("v1")
    odd_tags["snippet"]["tags"] = "a b"
    odd_views = item("v2", views=[1, 2])
    odd_title = item("v3")
    odd_title["snippet"]["title"] = {"x": 1}
    no_object = item("v4") | {"snippet": 7, "statistics": "many"}
    files = {
        "a.json": document([odd_tags, item("v0"), odd_views]),
        "b.json": {"items": [odd_title, "text", None, no_object, {"id": 5}], "_pipeline_metadata": "gone"},
        "c.json": {"items": "no list"},
        "d.json": document([item("v6")]) | {"_pipeline_metadata": {"region": "gb", "ingestion_timestamp": T2, "video_count": "one"}},
        "e.json": '{"items": [{"id": "cut"}], "_pipeline_metadata": {"region": ',
        "f.json": [document([odd_tags | {"id": "v7"}]), document([item("v8")])],
    }
    for name, content in files.items():
        import json

        write_json(tmp_path / f"region=de/{name}", content if isinstance(content, (str, dict)) else json.dumps(content))
    docs = landing.read_documents(spark, str(tmp_path), SNAPSHOT_DOCUMENT)
    rows = {r["video_id"]: r for r in landing.normalize_snapshots(docs, RUN).collect()}
    assert sorted(rows) == ["5", "v0", "v1", "v2", "v3", "v4", "v6", "v7", "v8"]
    assert rows["v1"]["tags"] is None and rows["v1"]["title"] == "title v1" and rows["v1"]["views"] == 100
    assert rows["v0"]["tags"] == "a,b" and rows["v0"]["region"] == "us" and rows["v0"]["_ingestion_timestamp"] == T1
    assert rows["v2"]["views"] is None and rows["v2"]["likes"] == 10 and rows["v2"]["tags"] == "a,b"
    assert rows["v4"]["title"] is None and rows["v4"]["views"] is None and rows["v4"]["region"] == "de"
    assert rows["5"]["_ingestion_timestamp"] == RUN
    assert rows["v6"]["region"] == "gb" and rows["v6"]["_ingestion_timestamp"] == T2
    lost = {}
    for r in landing.quarantine(docs).collect():
        lost.setdefault(r["key"].rsplit("/", 1)[1], set()).add(r["error"])
    # A list where a text is declared is read as its JSON text, which is no number of views.
    assert lost["a.json"] == {"item 1: snippet.tags"}
    assert lost["b.json"] >= {"item 2: not an object", "item 4: snippet, statistics", "_pipeline_metadata: not an object"}
    assert lost["c.json"] == lost["e.json"] == {"not a readable JSON document"}
    assert lost["d.json"] == {"_pipeline_metadata: video_count"}
    assert lost["f.json"] == {"document only partly readable"}
    assert {"region", "content"} - set(landing.quarantine(docs).columns) == {"region"}


def test_mistyped_reference_item(spark, tmp_path):
    odd = {"id": "10", "snippet": {"title": "Music", "assignable": "yes"}}
    write_json(tmp_path / "region=us/r.json", {"kind": "k", "items": [odd, {"id": "11", "snippet": {"title": "Film"}}]})
    assert as_set(landing.read_reference(spark, str(tmp_path), RUN), "id", "title") == {("10", "Music"), ("11", "Film")}


def test_union_of_nothing_is_empty_with_schema(spark):
    from strata.schemas import RAW_STATISTICS

    assert landing.union_shapes(spark, [], RAW_STATISTICS).schema == RAW_STATISTICS


def test_land_regions_isolates_failures(spark, tmp_path):
    def snapshots(region):
        if region == "de":
            raise OSError("quota")
        return spark.sql(
            "select named_struct('id','v','snippet',named_struct('title','t'),"
            "'statistics',named_struct('viewCount','1')) as item from range(3)"
        )

    def categories(region):
        if region == "fr":
            raise OSError("down")
        return spark.sql("select named_struct('id','1','snippet',named_struct('title','T')) as item")

    stats, ref = str(tmp_path / "stats"), str(tmp_path / "ref")
    report = landing.land_regions([" US ", "de", "fr"], snapshots, categories, stats, ref, NOW)
    assert report.success == ["us"]
    assert [(f["region"], f["type"]) for f in report.failed] == [("de", "trending"), ("fr", "categories")]
    docs = landing.read_documents(spark, stats, SNAPSHOT_DOCUMENT, multi_line=False)
    meta = docs.select("_pipeline_metadata.*").distinct().collect()
    assert {(m["region"], m["video_count"], m["ingestion_id"]) for m in meta} == {
        ("us", 3, "20240301_050000"),
        ("fr", 3, "20240301_050000"),
    }
    assert (tmp_path / "stats/region=us/date=2024-03-01/hour=05").is_dir()
    assert as_set(landing.read_reference(spark, ref, RUN, multi_line=False), "region") == {("us",)}


def test_landing_leaves_a_region_spread_over_tasks(spark, tmp_path, monkeypatch):
    region = F.when(F.col("id") % 10 != 0, " US ").alias("region")
    item = F.struct(F.col("id").cast("string").alias("id"), F.struct(F.lit("t").alias("title")).alias("snippet"))
    items = spark.range(0, 800, 1, 8).select(region, item.alias("item"))
    written, write = [], landing._write_documents
    monkeypatch.setattr(landing, "_write_documents", lambda docs, *more: [written.append(docs), write(docs, *more)])
    # As with tables too large to be broadcast by their size.
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        landing.land_snapshots(items, str(tmp_path), NOW)
        tasks = written[0].groupBy("region", F.spark_partition_id().alias("task")).count()
        assert as_set(tasks, "region", "count") == {("us", 90), ("unknown", 10)} and tasks.count() == 16
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    docs = landing.read_documents(spark, str(tmp_path), SNAPSHOT_DOCUMENT, multi_line=False)
    got = docs.groupBy("_pipeline_metadata.region", "_pipeline_metadata.video_count").count()
    assert as_set(got, "region", "video_count", "count") == {("us", 720, 720), ("unknown", 80, 80)}
    assert docs.select(F.explode("items.id")).distinct().count() == 800
