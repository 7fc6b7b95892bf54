"""Declared schemas of every layer.  Nothing is inferred from data."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


def _longs(*names: str) -> list[StructField]:
    return [StructField(name, LongType()) for name in names]


METADATA = StructType(
    [
        *_strings("ingestion_id", "region", "ingestion_timestamp"),
        StructField("video_count", LongType()),
        *_strings("source"),
    ]
)

SNAPSHOT_ITEM = StructType(
    [
        *_strings("id"),
        StructField(
            "snippet",
            StructType(
                [
                    *_strings("title", "channelTitle", "categoryId", "publishedAt"),
                    StructField("tags", ArrayType(StringType())),
                    *_strings("description"),
                ]
            ),
        ),
        StructField("statistics", StructType(_strings("viewCount", "likeCount", "commentCount"))),
    ]
)

REFERENCE_ITEM = StructType(
    [
        *_strings("kind", "etag", "id"),
        StructField(
            "snippet",
            StructType([*_strings("channelId", "title"), StructField("assignable", BooleanType())]),
        ),
    ]
)

CORRUPT = "_corrupt_record"


def landed_document(item: StructType) -> StructType:
    return StructType(
        [
            StructField("items", ArrayType(item)),
            StructField("_pipeline_metadata", METADATA),
            StructField(CORRUPT, StringType()),
        ]
    )


SNAPSHOT_DOCUMENT = landed_document(SNAPSHOT_ITEM)
REFERENCE_DOCUMENT = StructType([*_strings("kind", "etag"), *landed_document(REFERENCE_ITEM).fields])

QUARANTINE = StructType(_strings("key", "error", "content"))

# What an ingest landed, per region and file.
COUNTERS = StructType([*_strings("region", "file"), *_longs("rows", "quarantined")])

RAW_STATISTICS = StructType(
    [
        *_strings(
            "video_id", "title", "channel_title", "category_id", "publish_time", "trending_date_raw", "tags"
        ),
        *_longs("views", "likes", "dislikes", "comment_count"),
        *_strings("description", "region", "source", "_ingestion_timestamp", "_source_file"),
    ]
)

RAW_REFERENCE = StructType(_strings("id", "title", "region", "source", "_ingestion_timestamp", "_source_file"))

CURATED_STATISTICS = StructType(
    [
        *_strings("video_id", "title", "channel_title", "category_id", "publish_time", "region", "source"),
        StructField("trending_date_parsed", DateType()),
        *_strings("tags"),
        *_longs("views", "likes", "dislikes", "comment_count"),
        *_strings("description"),
        StructField("like_ratio", DoubleType()),
        StructField("engagement_rate", DoubleType()),
        *_strings("_ingestion_timestamp", "_source_file"),
    ]
)

CURATED_REFERENCE = StructType(_strings("id", "category_name", "region", "_ingestion_timestamp", "_source_file"))

CURATED_KEY = ["video_id", "region", "trending_date_parsed"]
