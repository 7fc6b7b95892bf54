"""Row number within groups that may each hold a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import stage

# monotonically_increasing_id() holds the partition number above this bit and
# the row's place in its partition below it.
PLACE_BITS = 33


def _order(measure: str, tie: str) -> list[Column]:
    return [F.col(measure).desc_nulls_last(), F.col(tie).asc_nulls_first()]


def top_within(df: DataFrame, by: Sequence[str], measure: str, tie: str, out: str, k: int) -> DataFrame:
    """The first ``k`` of each group.  Map tasks keep ``k`` rows per group before
    the shuffle, so group size does not matter."""
    number = F.row_number().over(Window.partitionBy(*by).orderBy(*_order(measure, tie)))
    return df.withColumn(out, number.cast("bigint")).where(F.col(out) <= k)


def rank_within(df: DataFrame, by: Sequence[str], measure: str, tie: str, out: str) -> DataFrame:
    """Number rows 1..n per group by ``measure`` descending, then ``tie``.

    A window would sort each group in one task.  Here all rows are range
    partitioned and sorted by (group, measure, tie) and stored with their place
    in that order, so a group of any size spreads over partitions.  Within a
    partition a group's rows are consecutive; a row's number is its place after
    the group's first place there, plus the group's rows in earlier partitions.
    Only that small table per (group, partition) is cumulated.
    """
    order = [*[F.col(c).asc_nulls_first() for c in by], *_order(measure, tie)]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(placed.withColumn("_at", F.monotonically_increasing_id()), "rank")

    part = F.shiftright("_at", PLACE_BITS)
    runs = rows.groupBy(*by, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    shifts = runs.select(*by, "_part", (before - F.col("_first") + 1).alias("_shift"))

    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by]
    same.append(F.shiftright("r._at", PLACE_BITS) == F.col("s._part"))
    return (
        rows.alias("r")
        .join(shifts.alias("s"), same)
        .select(*[F.col(f"r.{c}") for c in df.columns], (F.col("r._at") + F.col("s._shift")).alias(out))
    )
