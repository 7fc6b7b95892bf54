"""The driver's tables in the shapes the library works on.

``events`` plays the raw statistics log, ``lineitem`` with its dimensions the
curated statistics, ``part`` and ``customer`` the raw category reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import columns as C

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in their JSON properties, read once per row."""
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def _channel() -> Column:
    """Some users have no channel name."""
    number = F.col("user_id") % 23
    return F.when(number != 0, F.concat(F.lit("channel "), number.cast("string")))


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw statistics: even events from the API, odd ones historical."""
    iso = C.utc_iso(F.col("ts"))
    from_api = F.col("event_id") % 2 == 0
    return _events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("video_id"),
        F.concat(F.lit("video "), F.col("user_id").cast("string")).alias("title"),
        _channel().alias("channel_title"),
        (F.col("k") % 40).cast("string").alias("category_id"),
        iso.alias("publish_time"),
        F.when(from_api, iso).otherwise(F.date_format("ts", "yy.dd.MM")).alias("trending_date_raw"),
        F.lit(None).cast("string").alias("tags"),
        F.col("k").alias("views"),
        F.floor("value").cast("bigint").alias("likes"),
        F.when(~from_api, F.col("k") % 7).alias("dislikes"),
        (F.col("k") % 13).alias("comment_count"),
        F.col("props").alias("description"),
        F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")).alias("region"),
        F.when(from_api, C.API_SOURCE).otherwise(C.HISTORY_SOURCE).alias("source"),
        iso.alias("_ingestion_timestamp"),
        F.concat(F.lit("events/"), F.col("event_type")).alias("_source_file"),
    )


def events_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat historical shape of the older profile, every column a text."""
    even = F.col("event_id") % 2 == 0
    flag = F.when(even, "True").otherwise("False")
    return _events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("video_id"),
        F.when(even, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yy.dd.MM"))
        .alias("trending_date"),
        F.concat(F.lit("video "), F.col("user_id").cast("string")).alias("title"),
        _channel().alias("channel_title"),
        (F.col("k") % 40).cast("string").alias("category_id"),
        C.utc_iso(F.col("ts")).alias("publish_time"),
        F.lit(None).cast("string").alias("tags"),
        F.col("k").cast("string").alias("views"),
        F.floor("value").cast("string").alias("likes"),
        F.when(~even, (F.col("k") % 7).cast("string")).alias("dislikes"),
        (F.col("k") % 13).cast("string").alias("comment_count"),
        F.lit(None).cast("string").alias("thumbnail_link"),
        flag.alias("comments_disabled"),
        flag.alias("ratings_disabled"),
        flag.alias("video_error_or_removed"),
        F.col("props").alias("description"),
        F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")).alias("region"),
    )


def snapshot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshot items of the API shape, one struct per row."""
    event_tags = F.when(F.col("event_id") % 3 == 0, F.array(F.col("event_type"), F.lit("t"))).when(
        F.col("event_id") % 3 == 1, F.array().cast("array<string>")
    )
    return _events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit(" "), F.upper("event_type"), F.lit(" ")).alias("region"),
        F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.struct(
                F.concat(F.lit("video "), F.col("user_id").cast("string")).alias("title"),
                _channel().alias("channelTitle"),
                (F.col("k") % 40).cast("string").alias("categoryId"),
                C.utc_iso(F.col("ts")).alias("publishedAt"),
                event_tags.alias("tags"),
                F.col("props").alias("description"),
            ).alias("snippet"),
            F.struct(
                F.col("k").cast("string").alias("viewCount"),
                F.floor("value").cast("string").alias("likeCount"),
                F.when(F.col("event_id") % 5 != 0, (F.col("k") % 13).cast("string")).alias("commentCount"),
            ).alias("statistics"),
        ).alias("item"),
    )


def part_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw category rows for the event regions, in upper case and repeated."""
    region = F.element_at(F.array(*[F.lit(t) for t in EVENT_TYPES]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "part").select(
        F.col("p_size").cast("string").alias("id"),
        F.concat_ws(" ", "p_brand", "p_type").alias("title"),
        F.upper(region).alias("region"),
        F.lit(C.HISTORY_SOURCE).alias("source"),
        C.utc_iso(F.timestamp_seconds(F.lit(1704067200) + F.col("p_partkey"))).alias("_ingestion_timestamp"),
        F.concat(F.lit("part/"), F.col("p_brand")).alias("_source_file"),
    )


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation key to region name."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_nationkey", "r_name")


def customer_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw category rows for the geographic regions."""
    return (
        table(spark, sf_dir, "customer")
        .join(_regions(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            (F.col("c_custkey") % 40 + 1).cast("string").alias("id"),
            F.concat_ws(" ", "c_mktsegment", F.col("c_custkey") % 4).alias("title"),
            F.col("r_name").alias("region"),
            F.lit(C.API_SOURCE).alias("source"),
            C.utc_iso(F.timestamp_seconds(F.lit(1704067200) + F.col("c_custkey"))).alias("_ingestion_timestamp"),
            F.lit("customer").alias("_source_file"),
        )
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated-shaped rows: suppliers are channels, parts are videos.

    Suppliers and parts are joined as plain scans, so Spark sees their size and
    broadcasts them only where they are small.
    """
    views = F.col("l_quantity").cast("bigint")
    likes = F.col("l_linenumber").cast("bigint")
    comments = F.round(F.col("l_discount") * 100).cast("bigint")
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(_regions(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("l_partkey").cast("string").alias("video_id"),
            F.col("s_name").alias("channel_title"),
            F.col("p_size").cast("string").alias("category_id"),
            F.lower("r_name").alias("region"),
            F.to_date("l_shipdate").alias("trending_date_parsed"),
            views.alias("views"),
            likes.alias("likes"),
            comments.alias("comment_count"),
            C.ratio(likes, views).alias("like_ratio"),
            C.ratio(likes + comments, views).alias("engagement_rate"),
        )
    )
