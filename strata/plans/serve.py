"""Fixed queries and extracts over the marts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Marts = Mapping[str, DataFrame]


def top_channels(marts: Marts) -> DataFrame:
    return (
        marts["channel_analytics"]
        .where("rank_in_region <= 10")
        .select("channel_title", "region", "total_views", "avg_engagement_rate", "rank_in_region")
        .orderBy("region", "rank_in_region")
        .limit(50)
    )


def top_categories(marts: Marts) -> DataFrame:
    """Ties in views are settled by region, day and category id."""
    return (
        marts["category_analytics"]
        .orderBy(F.desc("total_views"), "region", "trending_date_parsed", "category_id")
        .limit(20)
        .select("category_name", "region", "total_views", "view_share_pct")
    )


def trending_summary(marts: Marts) -> DataFrame:
    return (
        marts["trending_analytics"]
        .select("region", "trending_date_parsed", "total_videos", "total_views", "avg_engagement_rate")
        .orderBy(F.desc("trending_date_parsed"), "region")
        .limit(20)
    )


QUERIES: dict[str, Callable[[Marts], DataFrame]] = {
    "top_channels": top_channels,
    "top_categories": top_categories,
    "trending_summary": trending_summary,
}


class UnknownQuery(KeyError):
    pass


def query(name: str, marts: Marts) -> DataFrame:
    if name not in QUERIES:
        raise UnknownQuery(f"{name}: choose one of {sorted(QUERIES)}")
    return QUERIES[name](marts)


class TooManyRows(ValueError):
    """A result is larger than its client can take."""


def rows(df: DataFrame, most: int, as_text: bool = False) -> list[dict]:
    """All rows for a client; as texts, with '' for null, on request.

    ``most`` is what the client can take: a larger result raises, nothing is cut.
    """
    if as_text:
        df = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
    found = df.limit(most + 1).collect()
    if len(found) > most:
        raise TooManyRows(f"more than {most} rows")
    return [row.asDict() for row in found]


def region_top(channels: DataFrame, region: str, columns: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` channels of one region by views."""
    return (
        channels.where(F.col("region") == region.strip().lower())
        .orderBy(F.desc("total_views"), "channel_title")
        .limit(n)
        .select(*columns)
    )


def share_by_category(categories: DataFrame, regions: Sequence[str]) -> DataFrame:
    """The category mart once more by (category, region), over all days."""
    return (
        categories.where(F.col("region").isin([r.strip().lower() for r in regions]))
        .groupBy("category_name", "region")
        .agg(F.sum("total_views").alias("total_views"), F.avg("view_share_pct").alias("avg_view_share"))
        .orderBy(F.desc("total_views"), "category_name", "region")
    )


def daily_counts(trending: DataFrame, columns: Sequence[str]) -> DataFrame:
    return trending.select(*columns).orderBy(F.desc("trending_date_parsed"), F.desc("total_videos"), "region")


def kpis(trending: DataFrame) -> DataFrame:
    """Headline figures; engagement is the plain mean of the daily means."""
    return trending.agg(
        F.sum("total_views").alias("total_views"),
        F.sum("total_videos").alias("total_videos"),
        F.avg("avg_engagement_rate").alias("avg_engagement_rate"),
    )


def views_by(mart: DataFrame, dimension: str, limit: int | None = None) -> DataFrame:
    """Views summed by one dimension, largest first."""
    out = (
        mart.groupBy(dimension)
        .agg(F.sum("total_views").alias("total_views"))
        .orderBy(F.desc("total_views"), dimension)
    )
    return out if limit is None else out.limit(limit)


# Columns of the BI extracts.
EXTRACTS = {
    "trending_analytics": [
        "region", "trending_date_parsed", "total_videos", "total_views",
        "total_likes", "total_comments", "avg_engagement_rate", "avg_like_ratio",
    ],
    "channel_analytics": [
        "channel_title", "region", "total_videos", "total_views", "avg_engagement_rate", "rank_in_region",
    ],
    "category_analytics": [
        "region", "trending_date_parsed", "category_id", "category_name",
        "total_videos", "total_views", "view_share_pct",
    ],
}


def extract(name: str, mart: DataFrame) -> DataFrame:
    return mart.select(*EXTRACTS[name])


def row_counts(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Row count per table as text; ``n/a`` for one that cannot be read.

    Each table is counted here, so files that break while they are read count too.
    """
    found = []
    for name, read in tables.items():
        try:
            found.append((name, str(read().agg(F.count(F.lit(1))).first()[0])))
        except Exception:  # a mart that is absent or broken is reported, not raised
            found.append((name, "n/a"))
    return spark.createDataFrame(found, "table_name string, row_count string")
