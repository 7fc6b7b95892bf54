"""Column expressions shared by the jobs.  All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two source tags of raw rows.
API_SOURCE = "youtube_api_v3"
HISTORY_SOURCE = "kaggle_historical"
DAY_MONTH = r"^\d{2}\.\d{2}\.\d{2}$"

# The cell texts that the pandas CSV reader documents as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def na_to_null(col: Column) -> Column:
    return F.when(~col.isin(NA_TOKENS), col)


def source_file() -> Column:
    """Decoded path of the file a row was read from."""
    path = F.col("_metadata.file_path")
    return F.coalesce(F.try_url_decode(path), path)


def region_from_path(path: Column) -> Column:
    """Value of the first ``region=`` path segment, ``unknown`` without one.

    An empty value is ``unknown`` too: a partition folder cannot hold it.
    """
    value = F.regexp_extract(path, r"(?:^|/)region=([^/]*)", 1)
    return F.coalesce(F.nullif(value, F.lit("")), F.lit("unknown"))


def clean_region(col: Column) -> Column:
    return F.lower(F.trim(col))


def joined_tags(tags: Column) -> Column:
    """Comma-joined tags; a missing or empty list is null, not an empty text."""
    return F.when(F.size(tags) > 0, F.array_join(tags, ","))


def utc_iso(ts: Column) -> Column:
    """One fixed-width UTC text per instant, so text order is time order."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def iso_date(text: Column) -> Column:
    """Calendar day as written in an ISO-8601 text, null if it is not one."""
    valid = text.rlike(r"^\d{4}-\d{2}-\d{2}(T.*)?$") & F.try_to_timestamp(text).isNotNull()
    return F.when(valid, F.substring(text, 1, 10).try_cast("date"))


def history_date(text: Column) -> Column:
    """``yy.dd.MM`` with two-digit years read as 1970-2069.

    Rearranged to ISO text and cast, which is far cheaper than a format-driven
    parse and fixes the century, where Spark's ``yy`` means 2000-2099.
    """
    year = F.substring(text, 1, 2)
    century = F.when(year >= "70", "19").otherwise("20")
    iso = F.concat(century, year, F.lit("-"), F.substring(text, 7, 2), F.lit("-"), F.substring(text, 4, 2))
    return F.when(text.rlike(DAY_MONTH), iso.try_cast("date"))


def trending_date(source: Column, text: Column, strict: bool = False) -> Column:
    """Parse by source; a source that is not known gives null.

    ``strict`` makes a text that its source's format cannot read an error.
    """
    parsed = F.when(source == API_SOURCE, iso_date(text)).when(source == HISTORY_SOURCE, history_date(text))
    if not strict:
        return parsed
    unreadable = source.isin(API_SOURCE, HISTORY_SOURCE) & text.isNotNull() & parsed.isNull()
    problem = F.raise_error(F.concat(F.lit("unreadable trending date: "), text)).cast("date")
    return F.when(unreadable, problem).otherwise(parsed)


def legacy_date(text: Column) -> Column:
    """Format chosen by shape, as the older job did: ``yy.dd.MM`` or ISO."""
    iso = F.concat(
        F.lit("20"), F.substring(text, 1, 2), F.lit("-"), F.substring(text, 7, 2), F.lit("-"), F.substring(text, 4, 2)
    )
    return F.when(text.rlike(DAY_MONTH), iso.try_cast("date")).otherwise(text.try_cast("date"))


def tolerant_long(col: Column) -> Column:
    return col.try_cast("bigint")


def truncating_long(text: Column) -> Column:
    """Whole part of a numeric text, null for anything else."""
    whole = F.regexp_extract(F.trim(text.cast("string")), r"^([+-]?\d+)(\.\d*)?$", 1)
    return F.nullif(whole, F.lit("")).try_cast("bigint")


def ratio(part: Column, views: Column) -> Column:
    return F.when(views > 0, part.cast("double") / views).otherwise(F.lit(0.0))


def percent(part: Column, views: Column) -> Column:
    return F.when(views > 0, F.round(part.cast("double") / views * 100, 4)).otherwise(F.lit(0.0))


def column_or_null(df: DataFrame, name: str, data_type: str = "string") -> Column:
    """The named column, or a typed null where the input does not have it."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(data_type)
