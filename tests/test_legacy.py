from datetime import date, datetime, timezone

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from strata.operators import legacy
from strata.session import stage

NOW = datetime(2018, 6, 2, 3, tzinfo=timezone.utc)


def flat(spark, *rows):
    names = legacy.OUTPUT
    base = dict.fromkeys(names, None) | {"region": " US ", "trending_date": "17.14.11", "channel_title": "c"}
    return spark.createDataFrame([tuple((base | r)[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names))


def test_flat_shape(spark):
    df = flat(
        spark,
        {"video_id": None},
        {"video_id": "", "views": "8", "likes": "1", "dislikes": "1", "comment_count": "1"},
        {"video_id": "a", "views": "3", "likes": "1", "comments_disabled": "True", "category_id": "10"},
        {"video_id": "b", "trending_date": "2018-01-02", "views": "12.0"},
        {"video_id": "c", "trending_date": "soon"},
    )
    out = legacy.clean(df, NOW, "job")
    got = as_set(out, "video_id", "region", "trending_date_parsed", "views", "dislikes", "like_ratio", "engagement_rate")
    assert got == {
        ("", "us", date(2017, 11, 14), 8, 1, 12.5, 37.5),
        ("a", "us", date(2017, 11, 14), 3, 0, 33.3333, 33.3333),
        ("b", "us", date(2018, 1, 2), 12, 0, 0.0, 0.0),
        ("c", "us", None, 0, 0, 0.0, 0.0),
    }
    row = out.where("video_id = 'a'").first()
    assert row["comments_disabled"] is True and row["category_id"] == 10 and row["_job_name"] == "job"


@pytest.mark.parametrize("sep", [".", "__"])
def test_api_shape(spark, sep):
    names = ["id", f"snippet{sep}title", f"snippet{sep}channelTitle", f"snippet{sep}categoryId",
             f"snippet{sep}publishedAt", f"statistics{sep}viewCount", f"statistics{sep}likeCount",
             f"statistics{sep}commentCount", f"snippet{sep}description", "region"]
    df = spark.createDataFrame([("v", "T", "C", "10", "p", "100", "20", "5", "d", "US")], names)
    row = legacy.clean(df, NOW, "job").first()
    assert (row["title"], row["category_id"], row["views"], row["dislikes"]) == ("T", 10, 100, 0)
    assert row["trending_date"] == "18.02.06" and row["trending_date_parsed"] == date(2018, 6, 2)
    assert row["like_ratio"] == 20.0 and row["engagement_rate"] == 25.0
    assert row["tags"] is None and row["thumbnail_link"] is None and row["ratings_disabled"] is False


def test_lookup_by_id_alone(spark):
    ref = spark.createDataFrame([("10", "Music", "us"), ("10", "Music", "gb"), ("29", "Non", "us")], ["id", "t", "region"])
    stats = spark.createDataFrame([("10",), ("29",), ("5",)], "category_id string")
    for name in ("snippet.title", "snippet_title"):
        lookup = legacy.build_lookup(ref.withColumnRenamed("t", name))
        got = as_set(legacy.named(stats.selectExpr("cast(category_id as bigint) as category_id"), lookup), "category_id", "category_name")
        assert got == {(10, "Music"), (29, "Non"), (5, "Unknown")}
    assert legacy.build_lookup(ref) is None and legacy.build_lookup(None) is None
    assert as_set(legacy.named(stats, None), "category_name") == {("Unknown",)}


def test_nameless_channels_stay_and_null_day_has_a_share(spark):
    df = flat(
        spark,
        {"video_id": "a", "views": "3", "channel_title": None, "category_id": "1", "trending_date": "x"},
        {"video_id": "b", "views": "1", "category_id": "2", "trending_date": "x"},
    )
    stats = legacy.clean(df, NOW, "job")
    assert as_set(legacy.channel(stats, None, NOW), "channel_title", "rank_in_region", "times_trending") == {
        (None, 1, 0), ("c", 2, 0),
    }
    assert as_set(legacy.category(stats, None, NOW), "category_id", "view_share_pct") == {(1, 75.0), (2, 25.0)}
    day = legacy.trending(stats, None, NOW).first()
    assert (day["total_videos"], day["max_views"], day["unique_channels"]) == (2, 3, 1)


def test_keep_last_reference_row(spark):
    df = spark.createDataFrame(
        [("1", "old", "f", 1), ("1", "new", "f", 2), ("1", "other", "g", 1)], ["id", "snippet.title", "_source_file", "pos"]
    )
    got = {(r[1], r[2]) for r in legacy.latest_reference(df, "pos").collect()}
    assert got == {("new", "f"), ("other", "g")}


def test_one_video_in_two_categories_counts_once_in_its_channel(spark):
    df = flat(
        spark,
        {"video_id": "a", "views": "3", "category_id": "1"},
        {"video_id": "a", "views": "5", "category_id": "2", "trending_date": "17.15.11"},
        {"video_id": "b", "views": "1", "category_id": "2", "trending_date": "17.15.11"},
        {"video_id": "c", "views": "2", "category_id": "2", "trending_date": "17.15.11", "channel_title": "d"},
    )
    lookup = spark.createDataFrame([(1, "One"), (2, "Two")], "category_id bigint, category_name string")
    stats = legacy.clean(df, NOW, "job")
    got = as_set(legacy.channel(stats, lookup, NOW).selectExpr("*", "array_join(categories, '+') as c"), "channel_title", "total_videos", "total_views", "peak_views", "times_trending", "c")
    assert got == {("c", 2, 9, 5, 3, "One+Two"), ("d", 1, 2, 2, 1, "Two")}
    got = as_set(legacy.category(stats, lookup, NOW), "category_name", "video_count", "unique_channels", "view_share_pct")
    assert got == {("One", 1, 1, 100.0), ("Two", 3, 2, 100.0)}


@pytest.mark.parametrize("mart", [legacy.channel, legacy.category])
def test_names_are_joined_above_the_aggregate(spark, mart):
    """No join stands below the aggregate that reads the base rows."""
    stats = stage(legacy.clean(flat(spark, {"video_id": "a", "category_id": "1"}), NOW, "job"), "older")
    lookup = stage(spark.createDataFrame([(1, "One")], "category_id bigint, category_name string"), "older")
    lines = mart(stats, lookup, NOW)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "Relation" in line and "video_id" in line:
            above, at = [], depth(line)
            for earlier in reversed(lines[:i]):
                if depth(earlier) < at:
                    at = depth(earlier)
                    above.append(earlier.lstrip(" :+-").split(" ")[0].split("(")[0])
            assert above.index("Aggregate") < (above.index("Join") if "Join" in above else len(above))


def test_flat_reference(spark, tmp_path):
    from helpers import write_json

    from strata.sources import landing

    write_json(tmp_path / "region=us/r.json", {"items": [{"id": "1", "snippet": {"title": "Film", "assignable": True}}]})
    flat_rows = landing.flat_reference(spark, str(tmp_path), "now")
    assert flat_rows.select(F.col("`snippet.title`"), F.col("`snippet.assignable`"), "region").first() == ("Film", True, "us")
    write_json(tmp_path / "region=gb/r.json", {"kind": "k1", "etag": "e1"})
    got = as_set(landing.flat_reference(spark, str(tmp_path), "now"), "kind", "id")
    assert got == {(None, "1"), ("k1", None)}


def test_flatten_finds_any_keys(spark, tmp_path):
    from helpers import write_json

    from strata.sources import landing

    items = [
        {"id": "1", "n": 1, "a b": {"c`d": "x", "e'f": {"g": True}}, "list": [1, "z"], "mixed": 1, "deep": {"x": None}, "p.q": "dot", "o'b\"k": {"": 5}},
        {"id": 2, "n": 2.5, "list": [], "mixed": {"k": "v"}, "p": {"q": "nested"}, "big": 12345678901234567890, "_source_file": "own"},
        7,
    ]
    write_json(tmp_path / "a.json", {"items": items})
    write_json(tmp_path / "b.json", {"only": "itself"})
    write_json(tmp_path / "c.json", {"items": []})
    write_json(tmp_path / "d.json", "{ broken")
    df = landing.flatten_items(landing.read_items(spark, str(tmp_path)))
    rows = {(r["id"], r["only"]): r.asDict() for r in df.collect()}
    one, two = rows["1", None], rows["2", None]
    assert len(rows) == 3 and rows[None, "itself"]["position"] == 0
    assert one["a b.c`d"] == "x" and one["a b.e'f.g"] is True and one["list"] == '[1,"z"]' and two["list"] == "[]"
    assert (one["n"], two["n"]) == (1.0, 2.5) or (float(one["n"]), float(two["n"])) == (1.0, 2.5)
    assert (one["p.q"], two["p.q"]) == ("dot", "nested")
    assert one["o'b\"k."] == 5
    assert two["_source_file"] == "own" and two["mixed"] == '{"k":"v"}' and one["mixed"] == "1"


def test_schema_texts_are_read():
    from strata.sources.landing import leaf_columns

    text = "OBJECT<`a b`: OBJECT<`c``d`: STRING, e: ARRAY<OBJECT<x: BIGINT>>>, n: DECIMAL(2,1), z: VOID, o: OBJECT<>>"
    assert leaf_columns(text) == {
        ("a b", "c`d"): "STRING", ("a b", "e"): "ARRAY<OBJECT<x: BIGINT>>", ("n",): "DECIMAL(2,1)", ("z",): "VOID",
    }
    assert leaf_columns("") == leaf_columns("VOID") == leaf_columns("OBJECT<>") == {}
