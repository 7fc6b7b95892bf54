"""Raw rows to curated rows: filter, type, derive, keep the latest per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.schemas import CURATED_KEY, CURATED_REFERENCE, CURATED_STATISTICS


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The newest row of each key; equal ages are settled by ``tie``, ascending.

    The ``rn = 1`` filter lets Spark cut every map task down to one row per key
    before the shuffle, so a key with a large part of all rows is no hot spot.
    """
    order: list[Column] = [F.col(c).desc_nulls_last() for c in newest_first]
    order += [F.col(c).asc_nulls_first() for c in tie]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(window)).where("rn = 1").drop("rn")


def with_key(raw: DataFrame) -> DataFrame:
    return raw.where("video_id is not null and video_id != ''")


def normalize(raw: DataFrame, strict: bool = False) -> DataFrame:
    return raw.select(
        "video_id",
        "title",
        "channel_title",
        "category_id",
        "publish_time",
        C.clean_region(F.col("region")).alias("region"),
        "source",
        C.trending_date(F.col("source"), F.col("trending_date_raw"), strict).alias("trending_date_parsed"),
        "tags",
        F.coalesce(C.tolerant_long(F.col("views")), F.lit(0)).alias("views"),
        F.coalesce(C.tolerant_long(F.col("likes")), F.lit(0)).alias("likes"),
        C.tolerant_long(F.col("dislikes")).alias("dislikes"),
        F.coalesce(C.tolerant_long(F.col("comment_count")), F.lit(0)).alias("comment_count"),
        "description",
        "_ingestion_timestamp",
        "_source_file",
        *_extra(raw),
    )


def _extra(raw: DataFrame) -> list[Column]:
    """Columns beyond the contract ride along, so a table can grow by them."""
    known = set(CURATED_STATISTICS.names) | {"trending_date_raw", "ingest_date"}
    return [F.col(c) for c in raw.columns if c not in known]


def with_metrics(df: DataFrame) -> DataFrame:
    views = F.col("views")
    return df.where(F.col("trending_date_parsed").isNotNull()).select(
        "*",
        C.ratio(F.col("likes"), views).alias("like_ratio"),
        C.ratio(F.col("likes") + F.col("comment_count"), views).alias("engagement_rate"),
    )


def curate_statistics(raw: DataFrame, strict: bool = False) -> DataFrame:
    """One row per (video, region, day), in the curated contract's columns."""
    typed = with_metrics(normalize(with_key(raw), strict))
    columns = [*CURATED_STATISTICS.names, *[c for c in typed.columns if c not in CURATED_STATISTICS.names]]
    others = [c for c in columns if c not in {*CURATED_KEY, "_ingestion_timestamp", "_source_file"}]
    newest = latest_per_key(typed, CURATED_KEY, ["_ingestion_timestamp"], ["_source_file", *others])
    return newest.select(columns)


def curate_reference(raw: DataFrame) -> DataFrame:
    """Latest title per (id, region).  Regions are cleaned as in the statistics."""
    rows = raw.where(F.col("id").isNotNull()).select(
        "id",
        F.col("title").alias("category_name"),
        C.clean_region(F.col("region")).alias("region"),
        "_ingestion_timestamp",
        "_source_file",
    )
    newest = latest_per_key(rows, ["id", "region"], ["_ingestion_timestamp"], ["_source_file", "category_name"])
    return newest.select(CURATED_REFERENCE.names)


def counted(df: DataFrame, observation: Observation) -> DataFrame:
    """Count rows while they pass; read the number after the next action.

    For reports: rows of a map task that is run again are counted again.
    """
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def warnings(df: DataFrame, observation: Observation) -> DataFrame:
    """Null counts and negative views, collected by the write that follows."""
    nulls = [
        F.count_if(F.col(c).isNull()).alias(f"{c}_nulls")
        for c in ("video_id", "title", "channel_title", "views")
        if c in df.columns
    ]
    return df.observe(observation, *nulls, F.count_if(F.col("views") < 0).alias("negative_views"))
