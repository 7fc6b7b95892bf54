"""Data-quality checks: one aggregation pass per table, one row per check."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from strata.schemas import CURATED_STATISTICS

MAX_VIEWS = 50_000_000_000

REPORT = StructType(
    [
        StructField("table_name", StringType()),
        StructField("check_name", StringType()),
        StructField("column_name", StringType()),
        StructField("value", DoubleType()),
        StructField("threshold", DoubleType()),
        StructField("status", StringType()),
        StructField("passed", BooleanType()),
    ]
)


class QualityError(RuntimeError):
    """At least one check failed; the steps after the gate must not run."""

    def __init__(self, failed: list[dict]):
        self.failed = failed
        super().__init__(f"{len(failed)} check(s) failed: {failed}")


@dataclass(frozen=True)
class Check:
    """``value`` aggregates the table to a number, ``status`` judges it."""

    name: str
    column: str | None
    value: Column
    threshold: float | None
    status: Callable[[Column], Column]


def _passes_if(condition: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda v: F.when(condition(v), "pass").otherwise("error")


def row_count(minimum: int = 10) -> Check:
    return Check("row_count", None, F.count(F.lit(1)), minimum, _passes_if(lambda v: v >= minimum))


def null_share(column: str) -> Column:
    """Percentage of nulls; null for an empty table."""
    nulls = F.count_if(F.col(column).isNull()).cast("double")
    return F.try_divide(nulls * 100.0, F.count(F.lit(1)))


def null_percentage(column: str, threshold: float = 5.0) -> Check:
    """Fails only when strictly more than ``threshold`` percent are null."""
    share = F.coalesce(null_share(column), F.lit(0.0))
    return Check("null_percentage", column, share, threshold, _passes_if(lambda v: v <= threshold))


def not_null(column: str) -> Check:
    return Check("not_null", column, F.count_if(F.col(column).isNull()), 0, _passes_if(lambda v: v == 0))


def value_range(column: str, low: int = 0, high: int = MAX_VIEWS) -> Check:
    """Counts values outside [low, high]; nulls are inside."""
    outside = F.count_if((F.col(column) < low) | (F.col(column) > high))
    return Check("value_range", column, outside, 0, _passes_if(lambda v: v == 0))


def freshness(
    column: str, now: datetime, warn_hours: float = 24, error_hours: float = 48, lenient: bool = False
) -> Check:
    """Age in hours of the newest timestamp.

    No readable timestamp is an error, or a pass in the older, lenient form.
    """
    newest = F.max(F.try_to_timestamp(F.col(column).cast("string")))
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(newest)) / 3_600_000_000.0

    def status(v: Column) -> Column:
        judged = F.when(v > error_hours, "error").when(v > warn_hours, "warn").otherwise("pass")
        return F.when(v.isNull(), "pass" if lenient else "error").otherwise(judged)

    return Check("freshness", column, age, error_hours, status)


def failing_null_percentage(df: DataFrame, column: str, threshold: float = 5.0) -> DataFrame:
    """The check as a test query: a row when it fails, none when it passes."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(column).isNull()).alias("null_rows"),
        null_share(column).alias("null_percentage"),
    ).where(F.col("null_percentage") > threshold)


def _record(table: str, check: str, column: str | None, ok: bool) -> tuple:
    return (table, check, column, None, None, "pass" if ok else "error", ok)


def run(df: DataFrame, table: str, checks: Sequence[Check], sample: int | None = None) -> DataFrame:
    """Report rows for all checks from a single scan of the table.

    A check of a column the table lacks is a failed record.  ``sample`` bounds
    the rows looked at, as the older checks did; the default is all of them.
    """
    if sample is not None:
        df = df.limit(sample)
    present = [c for c in checks if c.column is None or c.column in df.columns]
    absent = [c for c in checks if not (c.column is None or c.column in df.columns)]
    report = df.sparkSession.createDataFrame([_record(table, c.name, c.column, False) for c in absent], REPORT)
    if not present:
        return report
    values = df.agg(*[c.value.cast("double").alias(f"v{i}") for i, c in enumerate(present)])
    records = []
    for i, c in enumerate(present):
        status = c.status(F.col(f"v{i}"))
        records.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c.name).alias("check_name"),
                F.lit(c.column).cast("string").alias("column_name"),
                F.col(f"v{i}").alias("value"),
                F.lit(c.threshold).cast("double").alias("threshold"),
                status.alias("status"),
                (status != "error").alias("passed"),
            )
        )
    rows = values.select(F.inline(F.array(*records)))
    return rows.unionByName(report) if absent else rows


def schema_contract(df: DataFrame, table: str, contract: StructType) -> DataFrame:
    """One row per contract column: present with the declared type or not."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    rows = [_record(table, "schema", f.name, actual.get(f.name) == f.dataType) for f in contract.fields]
    return df.sparkSession.createDataFrame(rows, REPORT)


def contract_violations(df: DataFrame, contract: StructType) -> DataFrame:
    """Per contract column: ``violations``, the rows whose value is absent from
    ``df``'s columns or is none of the declared type, and ``passed``."""
    have = set(df.columns)
    counts = []
    for f in contract.fields:
        value = F.col(f"`{f.name}`")
        bad = F.lit(True) if f.name not in have else value.isNotNull() & value.try_cast(f.dataType).isNull()
        counts.append(F.count_if(bad).alias(f.name))
    records = [
        F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("violations"), (F.col(f"`{f.name}`") == 0).alias("passed"))
        for f in contract.fields
    ]
    return df.agg(*counts).select(F.inline(F.array(*records)))


def required_columns(df: DataFrame, table: str, expected: Sequence[str]) -> DataFrame:
    """Failed records for expected columns the table lacks, else one passed."""
    missing = sorted(set(expected) - set(df.columns))
    rows = [_record(table, "schema", name, False) for name in missing] or [_record(table, "schema", None, True)]
    return df.sparkSession.createDataFrame(rows, REPORT)


def run_all(
    spark: SparkSession, tables: dict[str, Callable[[], DataFrame]], checks: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """Check several tables; one that cannot be read is a failed record.

    Each table's checks, a row each, run here, so files that break while they are
    read fail their own table only.
    """
    found: list[tuple] = []
    for name, read in tables.items():
        try:
            found += [tuple(r) for r in checks(read(), name).select(REPORT.names).collect()]
        except Exception:  # any reason for not reading counts as this table's failure
            found.append(_record(name, "read_table", None, False))
    return spark.createDataFrame(found, REPORT)


def verdict(report: DataFrame) -> DataFrame:
    return report.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("quality_passed"),
        F.count_if("passed").alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
    )


def gate(report: DataFrame) -> list[dict]:
    """Raise if a check failed, else return the report (a row per check)."""
    rows = [row.asDict() for row in report.collect()]
    failed = [row for row in rows if not row["passed"]]
    if failed:
        raise QualityError(failed)
    return rows


def curated_checks() -> list[Check]:
    return [
        row_count(10),
        not_null("video_id"),
        null_percentage("title"),
        null_percentage("channel_title"),
        not_null("region"),
        not_null("trending_date_parsed"),
        value_range("views"),
    ]


def check_curated(df: DataFrame, table: str = "curated_statistics") -> DataFrame:
    return run(df, table, curated_checks()).unionByName(schema_contract(df, table, CURATED_STATISTICS))


# Columns that must not be null in the smaller curated table and the marts.
REQUIRED = {
    "curated_reference_data": ["id", "region"],
    "trending_analytics": ["region", "trending_date_parsed"],
    "channel_analytics": ["channel_title", "region", "rank_in_region"],
    "category_analytics": ["region", "category_name"],
}


def check_required(df: DataFrame, table: str) -> DataFrame:
    return run(df, table, [not_null(c) for c in REQUIRED[table]])


# Critical columns of the older check set.
LEGACY_CRITICAL = {
    "clean_statistics": ["video_id", "title", "channel_title", "views", "region"],
    "clean_reference_data": ["id", "region"],
}


def check_legacy(df: DataFrame, table: str, now: datetime, sample: int | None = None) -> DataFrame:
    critical = LEGACY_CRITICAL.get(table, [])
    checks = [row_count(10), *[null_percentage(c) for c in critical]]
    if table == "clean_statistics" and "views" in df.columns:
        negative = F.count_if(F.col("views") < 0)
        extreme = F.count_if(F.col("views") > MAX_VIEWS)
        checks += [
            Check("value_range_negative", "views", negative, 0, _passes_if(lambda v: v == 0)),
            Check("value_range_extreme", "views", extreme, 0, _passes_if(lambda v: v == 0)),
        ]
    stamp = next((c for c in ("_processed_at", "_ingestion_timestamp") if c in df.columns), None)
    if stamp:
        checks.append(freshness(stamp, now, warn_hours=48, error_hours=48, lenient=True))
    report = run(df, table, checks, sample).unionByName(required_columns(df, table, critical))
    if not stamp:
        record = [_record(table, "freshness", None, True)]
        report = report.unionByName(df.sparkSession.createDataFrame(record, REPORT))
    return report
