"""Take-once ingest of newly landed files, and the upsert that follows it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata import files
from strata.functions import columns as C
from strata.operators.clean import curate_statistics
from strata.operators.incremental import with_ingest_date
from strata.schemas import COUNTERS, CURATED_KEY, QUARANTINE, RAW_STATISTICS
from strata.sources import landing as sources
from strata.tables import Table

RAW_LAYOUT = ["region", "ingest_date"]
INGESTED = StructType([*RAW_STATISTICS.fields, StructField("ingest_date", StringType())])

# Older than any landing: a file source forgets, and then never reads, files
# whose time lies further than this behind the newest one.
ANY_AGE = "36500d"
# Files of the stream by name, time and size.  Their content is left to the batch.
FILE_LIST = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_available(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    checkpoint: str,
    run_ts: str,
    multi_line: bool = True,
    files_per_batch: int = 10_000,
    quarantine_path: str | None = None,
    counters_path: str | None = None,
) -> list[int]:
    """Append files that no earlier run has seen, then stop.  Gives the batches taken.

    The stream follows file names: ``.json`` and ``.csv`` of one folder tree, whatever
    their age beside the newest one seen.  A batch of at most ``files_per_batch``
    files is then read and written like any table, so its writers follow its
    own sizes: rows of a region and day are brought together, and a region far larger
    than the rest is split.  Each batch has a folder of its own, which a batch that is
    run again after a failure replaces: every file is appended exactly once.

    What cannot be read goes to ``quarantine_path`` in the same pass over the
    plan's files; ``counters_path`` gets the rows and records of each file.
    """
    taken: list[int] = []

    def take(batch: DataFrame, number: int) -> None:
        names = [row[0] for row in batch.select(C.source_file()).collect()]
        rows, bad = sources.read_landed(spark, names, run_ts, multi_line)
        _write_batch(with_ingest_date(rows), raw_path, number, RAW_LAYOUT)
        if quarantine_path:
            _write_batch(bad, quarantine_path, number)
        if counters_path:
            _write_batch(_count(spark, names, raw_path, quarantine_path, number), counters_path, number)
        taken.append(number)

    new = (
        spark.readStream.format("binaryFile")
        .schema(FILE_LIST)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", ANY_AGE)
        .option("pathGlobFilter", "*.{json,csv}")
        .option("recursiveFileLookup", True)
        .load(landing)
    )
    _run_to_end(new.select("path", "_metadata").writeStream.foreachBatch(take).option("checkpointLocation", checkpoint))
    return taken


def _folder(path: str, number: int) -> str:
    return f"{path}/batch={number}"


def _write_batch(df: DataFrame, path: str, number: int, layout: list[str] | None = None) -> None:
    spread = df.hint("rebalance", *layout) if layout else df
    spread.write.mode("overwrite").partitionBy(*layout or []).parquet(_folder(path, number))


def _count(spark: SparkSession, names: list[str], raw_path: str, quarantine_path: str | None, number: int) -> DataFrame:
    """Counters of each file of a batch, files without a row included, from what was just written."""
    listed = spark.createDataFrame([(n,) for n in names], "file string")
    rows = spark.read.schema(INGESTED).parquet(_folder(raw_path, number))
    rows = rows.groupBy(F.col("_source_file").alias("file"), "region").agg(F.count(F.lit(1)).alias("rows"))
    bad = spark.createDataFrame([], QUARANTINE)
    if quarantine_path:
        bad = spark.read.schema(QUARANTINE).parquet(_folder(quarantine_path, number))
    bad = bad.groupBy(F.col("key").alias("file")).agg(F.count(F.lit(1)).alias("quarantined"))
    none = F.lit(0).cast("bigint")
    # The lines of a file may be of several regions; its records count with the first.
    first = F.col("region").eqNullSafe(F.min("region").over(Window.partitionBy("file")))
    return (
        listed.join(rows, "file", "left")
        .join(bad, "file", "left")
        .select(
            F.coalesce("region", C.region_from_path(F.col("file"))).alias("region"),
            "file",
            F.coalesce("rows", none).alias("rows"),
            F.when(first, F.coalesce("quarantined", none)).otherwise(none).alias("quarantined"),
        )
    )


def read_batches(spark: SparkSession, path: str, schema: StructType, batches: list[int] | None = None) -> DataFrame:
    """Rows of all batches, or of the given ones only."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("basePath", path).parquet(path)
    if batches is not None:
        df = df.where(F.col("batch").isin(batches)) if "batch" in df.columns else df.where("false")
    return df.select(*schema.names)


def read_ingested(spark: SparkSession, raw_path: str) -> DataFrame:
    return read_batches(spark, raw_path, INGESTED)


def has_ingested(spark: SparkSession, raw_path: str) -> bool:
    return files.exists(spark, raw_path)


def upsert_available(
    spark: SparkSession, raw_path: str, table: Table, checkpoint: str, files_per_batch: int = 10_000
) -> None:
    """Bring rows newly added to the raw log into the curated table.

    A batch that is run again after a failure upserts the same rows again, which
    changes nothing.  An older row never replaces a newer one, whatever the order
    in which their files land.
    """

    def apply(batch: DataFrame, _: int) -> None:
        table.upsert(curate_statistics(batch), CURATED_KEY, ["_ingestion_timestamp"])

    reader = spark.readStream.schema(INGESTED).option("maxFilesPerTrigger", files_per_batch).option("maxFileAge", ANY_AGE)
    raw = reader.parquet(raw_path).select(*RAW_STATISTICS.names)
    _run_to_end(raw.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint))


def _run_to_end(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
