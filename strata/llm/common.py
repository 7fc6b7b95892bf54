"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata import session

# Rows of one Arrow batch sent to Python; texts are then taken in slices of at
# most SLICE_CHARS characters (one text at least).
BATCH_ROWS = 512
SLICE_CHARS = 2_000_000

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the jobs, with small Arrow batches for long texts."""
    session.apply_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back; its shuffle files go at once.

    A later loss of an executor re-reads the files instead of re-running ``df``.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return session.stage(df, label)
    finally:
        conf.set(CLEANUP, before)


def or_empty(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def numbered(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str | None]]:
    """``docs`` with columns named by place, so that no name can clash, and the new names of ``names``.

    A name that is not there has none.  ``toDF(*docs.columns)`` undoes it.
    """
    places = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*places.values()), [places.get(name) for name in names]


def slices(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each stay within SLICE_CHARS."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start = total = 0
        for i, n in enumerate(lengths):
            if i > start and total + n > SLICE_CHARS:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


def smallest(df: DataFrame, group: str, order: list[Column], count: int, spread: int = 64) -> DataFrame:
    """The ``count`` first rows of each group by ``order``, whose first column is a hash.

    Taken first within ``spread`` parts of a group, so that what meets in one
    task is bounded by ``spread * count`` rows and not by the number of tasks.
    """
    part = Window.partitionBy(group, F.pmod(order[0], F.lit(spread))).orderBy(*order)
    whole = Window.partitionBy(group).orderBy(*order)
    for window in (part, whole):
        df = df.withColumn("_at", F.row_number().over(window)).where(F.col("_at") <= count).drop("_at")
    return df
