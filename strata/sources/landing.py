"""Readers and writers of the landing area.

Every landed shape ends as one of two declared raw schemas.  A landed document
is ``{"items": [...], "_pipeline_metadata": {...}}``.  Documents fetched from
outside are one JSON value per file (``multi_line=True``).  What ``land_*``
writes has one item per line (``multi_line=False``), so a region of any size is
spread over tasks and its files can be split on reading.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, VariantType

from strata.functions import columns as C
from strata.schemas import (
    CORRUPT,
    QUARANTINE,
    RAW_STATISTICS,
    REFERENCE_DOCUMENT,
    SNAPSHOT_DOCUMENT,
)

Paths = str | Sequence[str]


def iso_now(now: datetime | None = None) -> str:
    now = now or datetime.now(timezone.utc)
    return now.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f+00:00")


# ── reading ────────────────────────────────────────────────────────────────


def read_documents(
    spark: SparkSession,
    paths: Paths,
    schema: StructType,
    multi_line: bool = True,
    glob: str = "*.json",
    whole: str | None = None,
) -> DataFrame:
    """Landed documents with their file.  Files of other names are left out.

    ``whole`` names a variant column of the schema that takes each document as it is.
    """
    reader = (
        spark.read.schema(schema)
        .options(**{"singleVariantColumn": whole} if whole else {})
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
    )
    docs = reader.json(paths if isinstance(paths, str) else list(paths))
    return docs.select("*", C.source_file().alias("_source_file"))


def literal_path(path: str) -> str:
    """A file's name as a path that Spark does not read as a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


# Mistyped documents.  Spark's JSON reader keeps the text of a document in which
# some value is not of the declared type.  Such a text is parsed once more as a
# variant, from which each declared field is read by itself: a value of another
# type costs that field, an item that is no object costs that item.


def _is_object(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("OBJECT")


def _from_variant(value: Column, data_type: DataType, path: str = "$") -> Column:
    """The value as the declared type, with null for each field of another type."""
    if isinstance(data_type, StructType):
        return F.struct(*[_from_variant(value, f.dataType, f"{path}.{f.name}").alias(f.name) for f in data_type.fields])
    return F.try_variant_get(value, path, data_type.simpleString())


def _lost_fields(value: Column, data_type: DataType, path: str = "$") -> list[Column]:
    """Per declared field its path if the value there is not of its type, else null."""
    there = F.try_variant_get(value, path, "variant")
    given = there.isNotNull() & ~F.is_variant_null(there)
    name = F.lit(path.removeprefix("$.") if path != "$" else "not an object")
    if not isinstance(data_type, StructType):
        return [F.when(given & F.try_variant_get(value, path, data_type.simpleString()).isNull(), name)]
    own = F.when((given if path != "$" else F.lit(True)) & ~F.coalesce(_is_object(there), F.lit(False)), name)
    return [own, *[c for f in data_type.fields for c in _lost_fields(value, f.dataType, f"{path}.{f.name}")]]


def _lost(value: Column, data_type: DataType) -> Column:
    return F.array_compact(F.array(*_lost_fields(value, data_type)))


def _reparsed() -> Column:
    """The document as a variant, only where the declared schema did not fit it."""
    return F.when(F.col(CORRUPT).isNotNull(), F.try_parse_json(F.col(CORRUPT)))


def _listed() -> Column:
    return F.try_variant_get(_reparsed(), "$.items", "array<variant>")


def mended(docs: DataFrame) -> DataFrame:
    """Documents with every item that can be read; those without any have null items."""
    item = docs.schema["items"].dataType.elementType
    read = F.transform(F.filter("_listed", _is_object), lambda v: _from_variant(v, item))
    meta = F.try_variant_get(_reparsed(), "$._pipeline_metadata", "variant")
    meta = F.when(_is_object(meta), _from_variant(meta, docs.schema["_pipeline_metadata"].dataType))
    # A text that is no JSON at all may have been cut off anywhere, so nothing of it is taken.
    partly = F.when(F.col(CORRUPT).isNull() | _reparsed().isNotNull(), F.col("items"))
    return (
        docs.withColumn("_listed", _listed())
        .withColumn("items", F.coalesce(read, partly))
        .withColumn("_pipeline_metadata", F.when(F.col("_listed").isNotNull(), meta).otherwise(F.col("_pipeline_metadata")))
        .drop("_listed")
    )


def quarantine(docs: DataFrame) -> DataFrame:
    """What cannot be read, with its text: none is lost silently.

    A record per unreadable document (a file, or a line), and one per item of a
    readable document that lost a field or is no object.
    """
    item = docs.schema["items"].dataType.elementType
    record = lambda error, content: F.struct(error.alias("error"), content.alias("content"))
    whole = lambda text: F.array(record(F.lit(text), F.col(CORRUPT)))

    def of_item(value: Column, place: Column) -> Column:
        fields = F.array_join(_lost(value, item), ", ")
        error = F.concat(F.lit("item "), (place + 1).cast("string"), F.lit(": "), fields)
        return F.when(fields != "", record(error, F.to_json(value)))

    meta = F.try_variant_get(_reparsed(), "$._pipeline_metadata", "variant")
    fields = F.array_join(_lost(meta, docs.schema["_pipeline_metadata"].dataType), ", ")
    of_meta = F.when(
        meta.isNotNull() & ~F.is_variant_null(meta) & (fields != ""),
        record(F.concat(F.lit("_pipeline_metadata: "), fields), F.to_json(meta)),
    )
    found = F.array_compact(F.concat(F.transform("_listed", of_item), F.array(of_meta)))
    partly = whole("document only partly readable")
    problems = (
        F.when(F.col("_listed").isNotNull(), F.when(F.size(found) > 0, found).otherwise(partly))
        .when(F.col("items").isNotNull() & _reparsed().isNotNull(), partly)
        .otherwise(whole("not a readable JSON document"))
    )
    # A scan checks the fields that it reads, and Spark refuses one of nothing but the
    # corrupt-record column.  So the filter looks at all of a document.
    reads_all = F.coalesce(F.length(F.to_json(F.struct("items", "_pipeline_metadata"))), F.lit(0)) >= 0
    bad = docs.where(F.col(CORRUPT).isNotNull() & reads_all).withColumn("_listed", _listed())
    return bad.select(F.col("_source_file").alias("key"), F.explode(problems).alias("p")).select("key", "p.*")


def _region(meta: str = "_pipeline_metadata") -> Column:
    return F.coalesce(F.nullif(F.col(f"{meta}.region"), F.lit("")), C.region_from_path(F.col("_source_file")))


def _timestamp(run_ts: str, meta: str = "_pipeline_metadata") -> Column:
    """The document's time in the one stored form, so that text order is time order.

    A text that is no time stays as it is; an absent one is the run's time.
    """
    written = C.utc_iso(F.try_to_timestamp(F.col(f"{meta}.ingestion_timestamp")))
    return F.coalesce(written, F.col(f"{meta}.ingestion_timestamp"), F.lit(run_ts))


def normalize_snapshots(docs: DataFrame, run_ts: str) -> DataFrame:
    """One raw statistics row per readable item.  No items, or a corrupt file: no rows."""
    items = mended(docs).select(
        F.explode("items").alias("i"),
        _region().alias("region"),
        _timestamp(run_ts).alias("ts"),
        "_source_file",
    )
    return items.select(
        F.col("i.id").alias("video_id"),
        F.col("i.snippet.title").alias("title"),
        F.col("i.snippet.channelTitle").alias("channel_title"),
        F.col("i.snippet.categoryId").alias("category_id"),
        F.col("i.snippet.publishedAt").alias("publish_time"),
        F.col("ts").alias("trending_date_raw"),
        C.joined_tags(F.col("i.snippet.tags")).alias("tags"),
        C.tolerant_long(F.col("i.statistics.viewCount")).alias("views"),
        C.tolerant_long(F.col("i.statistics.likeCount")).alias("likes"),
        F.lit(None).cast("bigint").alias("dislikes"),
        C.tolerant_long(F.col("i.statistics.commentCount")).alias("comment_count"),
        F.col("i.snippet.description").alias("description"),
        "region",
        F.lit(C.API_SOURCE).alias("source"),
        F.col("ts").alias("_ingestion_timestamp"),
        "_source_file",
    )


def read_snapshots(spark: SparkSession, paths: Paths, run_ts: str, multi_line: bool = True) -> DataFrame:
    return normalize_snapshots(read_documents(spark, paths, SNAPSHOT_DOCUMENT, multi_line), run_ts)


def normalize_reference(docs: DataFrame, run_ts: str) -> DataFrame:
    """One raw reference row per category item."""
    from_api = F.col("_pipeline_metadata").isNotNull()
    items = mended(docs).select(
        F.explode("items").alias("i"),
        _region().alias("region"),
        F.when(from_api, C.API_SOURCE).otherwise(C.HISTORY_SOURCE).alias("source"),
        _timestamp(run_ts).alias("_ingestion_timestamp"),
        "_source_file",
    )
    return items.select(
        F.col("i.id").alias("id"),
        F.col("i.snippet.title").alias("title"),
        "region",
        "source",
        "_ingestion_timestamp",
        "_source_file",
    )


def read_reference(spark: SparkSession, paths: Paths, run_ts: str, multi_line: bool = True) -> DataFrame:
    """A folder is scanned whole; a list of files reads just those."""
    return normalize_reference(read_documents(spark, paths, REFERENCE_DOCUMENT, multi_line), run_ts)


def empty_reference_files(docs: DataFrame) -> DataFrame:
    """Files whose document holds no item at all (an error in the older job)."""
    return (
        docs.groupBy("_source_file")
        .agg(F.sum(F.when(F.col("items").isNull(), 0).otherwise(F.size("items"))).alias("n_items"))
        .where(F.col("n_items") == 0)
    )


def read_items(spark: SparkSession, paths: Paths, multi_line: bool = True, glob: str = "*.json") -> DataFrame:
    """Items of any shape: ``item`` (a variant), its ``position`` and ``_source_file``.

    A document without an item list counts as one item itself.  Items that are no
    objects have no fields and are left out.
    """
    docs = read_documents(spark, paths, StructType([StructField("doc", VariantType()), StructField(CORRUPT, StringType())]), multi_line, glob=glob, whole="doc")
    listed = F.try_variant_get("doc", "$.items", "array<variant>")
    items = F.coalesce(listed, F.array("doc"))
    found = docs.where(F.col("doc").isNotNull()).select(F.posexplode(items).alias("position", "item"), "_source_file")
    return found.where(_is_object(F.col("item")))


# Variant types that a column can have as they are; any other is kept as JSON text.
PLAIN = re.compile(r"(BIGINT|DOUBLE|BOOLEAN|STRING|DECIMAL\(\d+,\d+\))")
MAX_COLUMNS = 5_000


def leaf_columns(schema: str) -> dict[tuple[str, ...], str]:
    """Path and type of every field that is no object, from a variant schema's text."""
    found: dict[tuple[str, ...], str] = {}
    word = re.compile(r"`((?:[^`]|``)*)`|([^:<>`, ]+)")

    def fields(at: int, path: tuple[str, ...]) -> int:
        # ``at`` is behind "OBJECT<"; gives the place behind its ">".
        while schema[at] != ">":
            match = word.match(schema, at)
            name = match[2] if match[1] is None else match[1].replace("``", "`")
            at = match.end() + 2
            if schema.startswith("OBJECT<", at):
                at = fields(at + len("OBJECT<"), (*path, name))
            else:
                start, depth = at, 0
                while depth or schema[at] not in ",>":
                    depth += {"<": 1, "(": 1, ">": -1, ")": -1}.get(schema[at], 0)
                    at += 1
                found[*path, name] = schema[start:at]
            if schema[at] == ",":
                at += 2
        return at + 1

    if schema.startswith("OBJECT<"):
        fields(len("OBJECT<"), ())
    return found


def _field(value: Column, path: Sequence[str]) -> Column:
    """The variant at a path of any names, also those that a path text cannot write."""
    text = "$"
    for name in path:
        quote = next((q for q in "'\"" if q not in name), None)
        if name and quote:
            text += f"[{quote}{name}{quote}]"
        else:
            value, text = F.try_element_at(F.try_variant_get(value, text, "map<string,variant>"), F.lit(name)), "$"
    return F.try_variant_get(value, text, "variant")


def flatten_items(items: DataFrame) -> DataFrame:
    """Every field found in the data as a column of its own, named by its dotted path.

    The columns come from one aggregate over all items.  Numbers, truths and texts
    keep their type where all items agree; lists and mixed fields are JSON texts, as is
    an object that is something else in another item.  A field whose name holds a dot
    shares the column of the path that reads the same.  The other columns of
    ``items`` stay where no field has their name.
    """
    schema = items.agg(F.schema_of_variant_agg("item").alias("s")).first()["s"] or ""
    leaves = leaf_columns(schema)
    if len(leaves) > MAX_COLUMNS:
        raise ValueError(f"{len(leaves)} fields: the items look like maps keyed by values, not like records")
    columns: dict[str, list[Column]] = {}
    types: dict[str, set[str]] = {}
    for path, kind in leaves.items():
        columns.setdefault(".".join(path), []).append(_field(F.col("item"), path))
        types.setdefault(".".join(path), set()).add(kind)

    def one(name: str) -> Column:
        value = F.coalesce(*columns[name])
        kind = next(iter(types[name])) if len(types[name]) == 1 else "VARIANT"
        if PLAIN.fullmatch(kind):
            return F.try_variant_get(value, "$", kind.lower()).alias(name)
        text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
        return F.when(~F.is_variant_null(value), F.coalesce(text, F.to_json(value))).alias(name)

    kept = [F.col(f"`{c}`") for c in items.columns if c != "item" and c not in columns]
    return items.select(*[one(name) for name in columns], *kept)


def flat_reference(spark: SparkSession, paths: Paths, run_ts: str, multi_line: bool = True) -> DataFrame:
    """Older reference shape: every item field as a dotted column, plus lineage.

    ``position`` is an item's place in its document.
    """
    lineage = {"_ingestion_timestamp": F.lit(run_ts), "region": C.region_from_path(F.col("_source_file"))}
    return flatten_items(read_items(spark, paths, multi_line)).withColumns(lineage)


# ── historical CSV ─────────────────────────────────────────────────────────


def csv_headers(spark: SparkSession, paths: Paths) -> DataFrame:
    """``_source_file`` and first line of every CSV file; null for one without a line.

    The lines are found by a scan that only cuts files into lines, which Spark splits
    whatever their size.
    """

    def read(form: str) -> DataFrame:
        reader = spark.read.format(form).option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
        return reader.load(paths if isinstance(paths, str) else list(paths))

    # Names only: the content column is not read.
    names = read("binaryFile").select(C.source_file().alias("_source_file"))
    first = read("text").where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
    lines = first.select(C.source_file().alias("_source_file"), "value").groupBy("_source_file").agg(F.first("value").alias("header"))
    return names.join(lines, "_source_file", "left")


def read_history(spark: SparkSession, paths: Paths, run_ts: str) -> tuple[DataFrame, DataFrame]:
    """Historical CSV files of any headers: raw statistics rows, and what cannot be read.

    Files are grouped by header and read per group, columns matched by name; one
    that is absent is null.  Of a name that occurs twice the first counts.  A row with
    fewer cells than the header has nulls for the rest; one with more is left out and
    recorded with its text, as is a file without a header; a file of no bytes is not seen
    by Spark's readers.  Bytes that are not UTF-8 become U+FFFD.  Only distinct headers and file names come to the driver.
    """
    groups = csv_headers(spark, paths).groupBy("header").agg(F.sort_array(F.collect_list("_source_file")).alias("files"))
    frames, bad = [], []
    for header, files in sorted(map(tuple, groups.collect()), key=repr):
        if header is None:
            lost = spark.createDataFrame([(f, "no header", None) for f in files], QUARANTINE)
            bad.append(lost)
            continue
        names = [name.strip() for name in next(csv.reader([header.removeprefix("\ufeff")]))]
        cells = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))]).add(CORRUPT, StringType())
        rows = (
            spark.read.schema(cells)
            .options(header=True, multiLine=True, escape='"', columnNameOfCorruptRecord=CORRUPT)
            .csv([literal_path(f) for f in files])
            .select("*", C.source_file().alias("_source_file"))
        )
        # Cells of a row whose number is not the header's, counted outside of quotes.
        outside = F.regexp_replace(CORRUPT, '"[^"]*"', "")
        n_cells = F.regexp_count(outside, F.lit(",")) + 1
        # As for JSON, the filter must also look at a cell.
        too_long = F.coalesce(n_cells, F.lit(0)) > len(names)
        reads_cell = F.coalesce(F.length("c0"), F.lit(0)) >= 0
        error = F.concat(n_cells.cast("string"), F.lit(f" cells under a header of {len(names)}"))
        bad.append(
            rows.where(too_long & reads_cell).select(F.col("_source_file").alias("key"), error.alias("error"), F.col(CORRUPT).alias("content"))
        )
        frames.append(normalize_history(rows.where(~too_long), names, run_ts))
    return union_shapes(spark, frames, RAW_STATISTICS), union_shapes(spark, bad, QUARANTINE)


def read_history_csv(spark: SparkSession, paths: Paths, run_ts: str) -> DataFrame:
    return read_history(spark, paths, run_ts)[0]


def normalize_history(rows: DataFrame, names: Sequence[str], run_ts: str) -> DataFrame:
    """Raw statistics of cells ``c0``, ``c1``, ... whose header is ``names``."""

    def text(name: str) -> Column:
        return C.na_to_null(F.col(f"c{names.index(name)}")) if name in names else F.lit(None).cast("string")

    def number(name: str) -> Column:
        return C.truncating_long(text(name)).alias(name)

    return rows.select(
        text("video_id").alias("video_id"),
        text("title").alias("title"),
        text("channel_title").alias("channel_title"),
        text("category_id").alias("category_id"),
        text("publish_time").alias("publish_time"),
        text("trending_date").alias("trending_date_raw"),
        text("tags").alias("tags"),
        number("views"),
        number("likes"),
        number("dislikes"),
        number("comment_count"),
        text("description").alias("description"),
        C.region_from_path(F.col("_source_file")).alias("region"),
        F.lit(C.HISTORY_SOURCE).alias("source"),
        F.lit(run_ts).alias("_ingestion_timestamp"),
        "_source_file",
    )


# ── both kinds in one folder ───────────────────────────────────────────────


def read_landed(spark: SparkSession, paths: Paths, run_ts: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Statistics of a folder, or of a list of files, by suffix: rows, and what cannot be read.

    ``.json`` files are snapshots, ``.csv`` files are history, others are left out.
    """
    chosen = lambda end: paths if isinstance(paths, str) else [p for p in paths if p.endswith(end)]
    frames, bad = [], []
    if chosen(".json"):
        files = chosen(".json")
        docs = read_documents(spark, files if isinstance(files, str) else [literal_path(f) for f in files], SNAPSHOT_DOCUMENT, multi_line)
        frames.append(normalize_snapshots(docs, run_ts))
        bad.append(quarantine(docs))
    if chosen(".csv"):
        files = chosen(".csv")
        rows, lost = read_history(spark, files if isinstance(files, str) else [literal_path(f) for f in files], run_ts)
        frames.append(rows)
        bad.append(lost)
    return union_shapes(spark, frames, RAW_STATISTICS), union_shapes(spark, bad, QUARANTINE)


def union_shapes(spark: SparkSession, frames: Sequence[DataFrame], schema: StructType) -> DataFrame:
    """All frames as one; without any, an empty frame of the schema."""
    out = spark.createDataFrame([], schema) if not frames else frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.select(schema.names)


def any_readable(spark: SparkSession, path: str, multi_line: bool = True) -> bool:
    """Whether a folder holds a readable snapshot document or a CSV file with a header."""
    docs = mended(read_documents(spark, path, SNAPSHOT_DOCUMENT, multi_line))
    if docs.where(F.col("items").isNotNull() | F.col(CORRUPT).isNull()).select("_source_file", "items").first():
        return True
    return csv_headers(spark, path).where(F.col("header").isNotNull()).first() is not None


# ── writing ────────────────────────────────────────────────────────────────


def _partition_columns(df: DataFrame, now: datetime) -> DataFrame:
    now = now.astimezone(timezone.utc)
    return df.withColumn("date", F.lit(now.strftime("%Y-%m-%d"))).withColumn("hour", F.lit(now.strftime("%H")))


def _metadata(now: datetime, video_count: Column | None) -> Column:
    now = now.astimezone(timezone.utc)
    fields = [
        F.lit(now.strftime("%Y%m%d_%H%M%S")).alias("ingestion_id"),
        F.col("region"),
        F.lit(iso_now(now)).alias("ingestion_timestamp"),
    ]
    if video_count is not None:
        fields.append(video_count.alias("video_count"))
    return F.struct(*fields, F.lit("youtube_data_api_v3").alias("source"))


def land_snapshots(df: DataFrame, path: str, now: datetime) -> None:
    """Write items (columns ``region`` and ``item``) as landed documents.

    Each line carries the whole metadata struct; its ``video_count`` is the
    region's item count, joined from a per-region aggregate.  Items without a
    region land under ``unknown``.

    The counts, a row per region folder, are broadcast whatever Spark takes their
    size to be: a shuffle by region would bring each region's items into one task.
    """
    region = F.coalesce(F.nullif(C.clean_region(F.col("region")), F.lit("")), F.lit("unknown"))
    items = df.select(region.alias("region"), "item")
    counts = items.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    docs = items.join(F.broadcast(counts), "region").select(
        "region",
        F.array("item").alias("items"),
        _metadata(now, F.col("n")).alias("_pipeline_metadata"),
    )
    _write_documents(_partition_columns(docs, now), path, ["date", "hour"], "append")


def land_reference(df: DataFrame, path: str, now: datetime) -> None:
    """As above for category items; a later run on the same day replaces it."""
    docs = df.select(C.clean_region(F.col("region")).alias("region"), "item").select(
        "region",
        F.array("item").alias("items"),
        _metadata(now, None).alias("_pipeline_metadata"),
    )
    _write_documents(_partition_columns(docs, now), path, ["date"], "overwrite")


def _write_documents(docs: DataFrame, path: str, time_columns: list[str], mode: str) -> None:
    layout = ["region", *time_columns]
    (
        docs.select(*layout, "items", "_pipeline_metadata")
        .hint("rebalance", *layout)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout)
        .json(path)
    )


@dataclass
class LandingReport:
    success: list[str] = field(default_factory=list)
    failed: list[dict] = field(default_factory=list)


def land_regions(
    regions: Sequence[str],
    snapshots: Callable[[str], DataFrame],
    categories: Callable[[str], DataFrame],
    statistics_path: str,
    reference_path: str,
    now: datetime,
) -> LandingReport:
    """Land region by region; one that fails is noted and the others go on.

    A region whose snapshot fails gets no category landing either.
    """
    report = LandingReport()
    for region in (r.strip().lower() for r in regions):
        steps = [
            ("trending", snapshots, land_snapshots, statistics_path),
            ("categories", categories, land_reference, reference_path),
        ]
        for kind, fetch, land, path in steps:
            try:
                land(fetch(region).withColumn("region", F.lit(region)), path, now)
            except Exception as problem:  # isolation is the point: any failure is that region's
                report.failed.append({"region": region, "type": kind, "error": str(problem)})
                break
        else:
            report.success.append(region)
    return report
