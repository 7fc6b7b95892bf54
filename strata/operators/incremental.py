"""High-water mark over ingestion timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCH = "1970-01-01T00:00:00Z"


def watermark(target: DataFrame) -> str:
    """Largest ingestion timestamp in the target; reads that one column."""
    return target.agg(F.coalesce(F.max("_ingestion_timestamp"), F.lit(EPOCH)).alias("m")).first()["m"]


def newer_than(raw: DataFrame, mark: str | None, inclusive: bool = False) -> DataFrame:
    """Raw rows after the mark; all of them when there is none (first build).

    The comparison is of texts, as timestamps are stored in one UTC format.
    ``inclusive`` also takes rows at the mark, for files repaired after a run;
    the keyed upsert makes taking them twice harmless.  A raw table laid out by
    ``ingest_date`` is pruned to the days from the mark on.
    """
    if mark is None:
        return raw
    ts = F.col("_ingestion_timestamp")
    newer = raw.where(ts >= mark if inclusive else ts > mark)
    return newer.where(F.col("ingest_date") >= mark[:10]) if "ingest_date" in raw.columns else newer


def with_ingest_date(raw: DataFrame) -> DataFrame:
    """The day of the ingestion timestamp, ``unknown`` for a text that does not begin with one."""
    day = F.substring("_ingestion_timestamp", 1, 10)
    return raw.withColumn("ingest_date", F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day).otherwise("unknown"))
