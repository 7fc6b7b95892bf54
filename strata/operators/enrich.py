"""Category lookup and the three marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.rank import rank_within

UNKNOWN = "Unknown"
DAY = ["region", "trending_date_parsed"]


def with_category(stats: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Left join of the category name on (category id, region).

    No broadcast is forced: the lookup is broadcast when its measured size is
    under Spark's threshold, and otherwise the join is a shuffle whose hot keys
    adaptive execution splits.
    """
    if lookup is None or not {"id", "region", "category_name"} <= set(lookup.columns):
        return stats.withColumn("category_name", F.lit(UNKNOWN))
    names = lookup.select(F.col("id").alias("category_id"), "region", F.col("category_name").alias("_name"))
    return (
        stats.join(names, ["category_id", "region"], "left")
        .withColumn("category_name", F.coalesce("_name", F.lit(UNKNOWN)))
        .drop("_name")
    )


def _videos(keyed: bool) -> Column:
    """Distinct videos of a (region, day) or finer group.

    In a table keyed by (video, region, day) each video occurs once in such a
    group, so a plain count gives the same number without the distinct shuffle.
    """
    return F.count("video_id") if keyed else F.count_distinct("video_id")


def trending_analytics(stats: DataFrame, keyed: bool = False) -> DataFrame:
    """Daily totals per region.  ``keyed``: rows are unique per curated key."""
    return stats.groupBy(*DAY).agg(
        _videos(keyed).alias("total_videos"),
        F.sum("views").alias("total_views"),
        F.sum("likes").alias("total_likes"),
        F.sum("comment_count").alias("total_comments"),
        F.avg("engagement_rate").alias("avg_engagement_rate"),
        F.avg("like_ratio").alias("avg_like_ratio"),
    )


def channel_totals(stats: DataFrame) -> DataFrame:
    """Totals per (channel, region); rows without a channel are left out."""
    named = stats.where(F.col("channel_title").isNotNull())
    return named.groupBy("channel_title", "region").agg(
        F.count_distinct("video_id").alias("total_videos"),
        F.sum("views").alias("total_views"),
        F.avg("engagement_rate").alias("avg_engagement_rate"),
    )


def category_sets(named: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sorted distinct category names per group, duplicates removed first."""
    return (
        named.select(*by, "category_name")
        .distinct()
        .groupBy(*by)
        .agg(F.array_sort(F.collect_set("category_name")).alias("categories"))
    )


def channel_rollup(stats: DataFrame, lookup: DataFrame | None) -> DataFrame:
    """Totals and category names per (channel, region), not ranked yet.

    The names come from a scan of their own: in one aggregation with the
    distinct count, the set would turn all of it into sorting, and names would
    have to be joined to every row instead of once per (channel, category).
    """
    keys = ["channel_title", "region"]
    found = stats.where(F.col("channel_title").isNotNull()).select(*keys, "category_id").distinct()
    sets = category_sets(with_category(found, lookup), keys)
    # A row without a region has no lookup entry, and no match here either.
    none = F.array(F.lit(UNKNOWN))
    return (
        channel_totals(stats).join(sets, keys, "left").withColumn("categories", F.coalesce("categories", none))
    )


def channel_analytics(stats: DataFrame, lookup: DataFrame | None) -> DataFrame:
    return rank_within(channel_rollup(stats, lookup), ["region"], "total_views", "channel_title", "rank_in_region")


def category_rollup(stats: DataFrame, lookup: DataFrame | None, keyed: bool = False) -> DataFrame:
    """Totals per (region, day, category).

    The lookup has one row per (id, region), so names are joined to the few
    aggregated rows instead of to every video row.
    """
    totals = stats.groupBy(*DAY, "category_id").agg(
        _videos(keyed).alias("total_videos"), F.sum("views").alias("total_views")
    )
    return with_category(totals, lookup).select(*DAY, "category_id", "category_name", "total_videos", "total_views")


def category_analytics(stats: DataFrame, lookup: DataFrame | None, keyed: bool = False) -> DataFrame:
    return share_of_total(category_rollup(stats, lookup, keyed), DAY, "total_views", "view_share_pct")


def lookup_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(region, category id) whose name is not the same in two lookups, or is in one only."""
    names = ["id", "region", "category_name"]
    one, other = before.select(*names), after.select(*names)
    changed = one.exceptAll(other).unionByName(other.exceptAll(one))
    return changed.select("region", F.col("id").alias("category_id")).distinct()


def changed_days(stats: DataFrame, since: str, renamed: DataFrame) -> DataFrame:
    """(region, day) with rows as new as ``since`` or with a category that ``renamed`` lists."""
    newer = stats.where(F.col("_ingestion_timestamp") >= since).select(*DAY)
    named = stats.join(renamed, ["region", "category_id"], "left_semi").select(*DAY)
    return newer.unionByName(named).distinct()


def refreshed(mart: DataFrame, days: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """A daily mart with the rows of ``days`` (region, day) rebuilt."""
    return mart.join(days, DAY, "left_anti").unionByName(rebuilt)


def share_of_total(df: DataFrame, by: Sequence[str], measure: str, out: str, digits: int | None = None) -> DataFrame:
    """Percentage of ``measure`` in its group's total; null where that is 0.

    ``df`` is an aggregate with one row per category of a group, so a group is
    small and the total is a window over it.
    """
    total = F.sum(measure).over(Window.partitionBy(*by))
    share = F.try_divide(F.col(measure).cast("double") * 100.0, total)
    return df.withColumn(out, share if digits is None else F.round(share, digits))
