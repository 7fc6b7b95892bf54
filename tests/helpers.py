"""Hand-written fixture rows."""

from __future__ import annotations

import json
from pathlib import Path

from strata.schemas import RAW_REFERENCE, RAW_STATISTICS

T1 = "2024-01-05T10:00:00.000000+00:00"
T2 = "2024-01-05T11:00:00.000000+00:00"
T3 = "2024-01-06T10:00:00.000000+00:00"


def raw_row(video_id="v1", region="us", ts=T1, views=100, source="youtube_api_v3", **more):
    row = {
        "video_id": video_id, "title": "t", "channel_title": "c1", "category_id": "10", "publish_time": ts,
        "trending_date_raw": ts, "tags": None, "views": views, "likes": 10, "dislikes": None,
        "comment_count": 5, "description": "d", "region": region, "source": source,
        "_ingestion_timestamp": ts, "_source_file": "f1",
    }
    row |= more
    return tuple(row[name] for name in RAW_STATISTICS.names)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_STATISTICS)


def reference(spark, *rows):
    """Rows of (id, title, region, timestamp)."""
    full = [(i, t, r, "youtube_api_v3", ts, "ref.json") for i, t, r, ts in rows]
    return spark.createDataFrame(full, RAW_REFERENCE)


def write_json(path: Path, document) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=2, ensure_ascii=False)
    path.write_text(text, encoding="utf-8")


def item(video_id, views="100", category="10", channel="c1", **more):
    return {
        "id": video_id,
        "snippet": {
            "title": f"title {video_id}", "channelTitle": channel, "categoryId": category,
            "publishedAt": "2024-01-01T00:00:00Z", "tags": ["a", "b"], "description": "d",
        },
        "statistics": {"viewCount": views, "likeCount": "10", "commentCount": "5"},
    } | more


def document(items, region="us", ts=T1):
    return {
        "items": items,
        "_pipeline_metadata": {
            "ingestion_id": "x", "region": region, "ingestion_timestamp": ts,
            "video_count": len(items), "source": "youtube_data_api_v3",
        },
    }


def as_set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}
