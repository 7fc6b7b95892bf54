"""One entry per operator group.  Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import enrich, legacy, quality
from strata.operators.clean import curate_reference, curate_statistics
from strata.operators.incremental import newer_than, watermark
from strata.operators.rank import top_within
from strata.plans import serve
from strata.plans.medallion import Landing, Medallion
from strata.plans.older import OlderMedallion
from strata.schemas import (
    COUNTERS,
    CURATED_KEY,
    CURATED_STATISTICS,
    RAW_STATISTICS,
    REFERENCE_DOCUMENT,
    SNAPSHOT_DOCUMENT,
    SNAPSHOT_ITEM,
)
from strata.session import apply_settings, scratch_path, stage
from strata.sources import landing
from strata.streaming import ingest
from strata.tables import Lake, Table
from workload import base

NOW = datetime(2024, 2, 1, 6, 30, 0, tzinfo=timezone.utc)
LATER = datetime(2024, 2, 1, 7, 30, 0, tzinfo=timezone.utc)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(apply_settings(spark), sf_dir.rstrip("/"))

    REGISTRY[fn.__name__] = run
    return run


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Means depend on summation order in their last bits; compare rounded.

    The nudge sends values that lie on a rounding tie the same way everywhere.
    """
    return df.withColumns({n: F.round(F.col(n) + 1e-9, digits) for n in names})


def _curated(spark: SparkSession, d: str) -> DataFrame:
    return curate_statistics(base.events_raw(spark, d))


def _event_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A stored table, as in a run: the joins then know how small it is."""
    return stage(curate_reference(base.part_reference(spark, d)), "lookup")


def _sales_lookup(spark: SparkSession, d: str) -> DataFrame:
    return stage(curate_reference(base.customer_reference(spark, d)), "lookup")


# ── curated ────────────────────────────────────────────────────────────────


@query
def latest_per_key(spark, d):
    return _curated(spark, d)


@query
def reference_dedup(spark, d):
    return curate_reference(base.part_reference(spark, d))


@query
def union_shapes(spark, d):
    raw = base.events_raw(spark, d)
    parts = [raw.where(F.col("source") == s) for s in (C.API_SOURCE, C.HISTORY_SOURCE)]
    return landing.union_shapes(spark, parts, RAW_STATISTICS)


@query
def date_parse_dual(spark, d):
    """Orders with their date rendered in one of the two source formats."""
    even = F.col("o_orderkey") % 2 == 0
    rendered = base.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(even, C.HISTORY_SOURCE).otherwise(C.API_SOURCE).alias("source"),
        F.when(even, F.date_format("o_orderdate", "yy.dd.MM"))
        .otherwise(C.utc_iso(F.col("o_orderdate")))
        .alias("text"),
    )
    return rendered.select(
        "o_orderkey", C.trending_date(F.col("source"), F.col("text")).alias("trending_date_parsed")
    ).where(F.col("trending_date_parsed").isNotNull())


@query
def upsert_result(spark, d):
    """Two incremental builds of a partitioned table, then its rows."""
    raw = base.events_raw(spark, d)
    target = Table(spark, scratch_path(spark, "upsert"), ["region", "trending_date_parsed"])
    first = raw.where(F.col("_ingestion_timestamp") < "2024-01-16T12:00:00.000000+00:00")
    target.upsert(curate_statistics(first), CURATED_KEY)
    target.upsert(curate_statistics(newer_than(raw, watermark(target.read()))), CURATED_KEY)
    return target.read()


@query
def overwrite_partitions(spark, d):
    """Orders by priority; the urgent and high ones are replaced."""
    orders = base.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    target = Table(spark, scratch_path(spark, "partitions"), ["o_orderpriority"])
    target.replace(orders)
    changed = orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    target.overwrite_partitions(changed.withColumn("note", F.lit("changed")))
    return target.read()


@query
def newer_than_mark(spark, d):
    """Raw rows after the high-water mark of the table built from part of them."""
    raw = base.events_raw(spark, d)
    first = raw.where(F.col("source") == C.HISTORY_SOURCE)
    target = Table(spark, scratch_path(spark, "mark"))
    target.upsert(curate_statistics(first.where(F.col("_ingestion_timestamp") < "2024-01-20")), CURATED_KEY)
    return newer_than(raw, watermark(target.read())).select("video_id", "region", "_ingestion_timestamp", "views")


@query
def region_scan(spark, d):
    """A table laid out by region, read for two of them (a pruned scan)."""
    target = Table(spark, scratch_path(spark, "regions"), ["region"])
    target.append(curate_reference(base.customer_reference(spark, d)))
    return target.read(["asia", "europe"])


# ── marts ──────────────────────────────────────────────────────────────────


@query
def daily_trending(spark, d):
    return _rounded(
        enrich.trending_analytics(_curated(spark, d), keyed=True), "avg_engagement_rate", "avg_like_ratio"
    )


@query
def channel_rank(spark, d):
    return _rounded(
        enrich.channel_analytics(base.sales(spark, d), _sales_lookup(spark, d)), "avg_engagement_rate"
    )


@query
def category_share(spark, d):
    return _rounded(
        enrich.category_analytics(_curated(spark, d), _event_lookup(spark, d), keyed=True), "view_share_pct"
    )


@query
def category_share_distinct(spark, d):
    """The same over rows that repeat a video within a day."""
    return _rounded(
        enrich.category_analytics(base.sales(spark, d), _sales_lookup(spark, d)), "view_share_pct"
    )


# ── serving ────────────────────────────────────────────────────────────────


@query
def top_channels(spark, d):
    totals = enrich.channel_totals(base.sales(spark, d))
    ranked = top_within(totals, ["region"], "total_views", "channel_title", "rank_in_region", 10)
    return _rounded(serve.query("top_channels", {"channel_analytics": ranked}), "avg_engagement_rate")


@query
def top_categories(spark, d):
    mart = enrich.category_analytics(_curated(spark, d), _event_lookup(spark, d), keyed=True)
    return _rounded(serve.query("top_categories", {"category_analytics": mart}), "view_share_pct")


@query
def trending_summary(spark, d):
    mart = enrich.trending_analytics(_curated(spark, d), keyed=True)
    return _rounded(serve.query("trending_summary", {"trending_analytics": mart}), "avg_engagement_rate")


@query
def daily_counts(spark, d):
    mart = legacy.trending(_legacy_clean(spark, d), None, NOW)
    out = serve.daily_counts(mart, ["region", "trending_date_parsed", "total_videos", "avg_views_per_video"])
    return _rounded(out, "avg_views_per_video")


@query
def region_top10(spark, d):
    totals = enrich.channel_totals(base.sales(spark, d))
    top = serve.region_top(totals, "AMERICA", ["channel_title", "total_views", "avg_engagement_rate"])
    return _rounded(top, "avg_engagement_rate")


@query
def kpi_totals(spark, d):
    kpis = serve.kpis(enrich.trending_analytics(_curated(spark, d), keyed=True))
    return _rounded(kpis, "avg_engagement_rate")


@query
def sum_by_channel(spark, d):
    totals = enrich.channel_totals(base.sales(spark, d))
    return serve.views_by(totals, "channel_title", limit=10)


@query
def sum_by_category(spark, d):
    return serve.views_by(enrich.category_rollup(base.sales(spark, d), _sales_lookup(spark, d)), "category_name")


@query
def sum_by_region(spark, d):
    return serve.views_by(enrich.trending_analytics(base.sales(spark, d)), "region")


@query
def share_reaggregated(spark, d):
    mart = enrich.category_analytics(_curated(spark, d), _event_lookup(spark, d), keyed=True)
    return _rounded(serve.share_by_category(mart, ["VIEW", "click", "Purchase"]), "avg_view_share")


@query
def bi_extract(spark, d):
    mart = enrich.channel_analytics(base.sales(spark, d), _sales_lookup(spark, d))
    return _rounded(serve.extract("channel_analytics", mart), "avg_engagement_rate")


@query
def mart_counts(spark, d):
    curated, lookup = stage(_curated(spark, d), "curated"), _event_lookup(spark, d)
    return serve.row_counts(
        spark,
        {
            "trending_analytics": lambda: enrich.trending_analytics(curated, keyed=True),
            "channel_analytics": lambda: enrich.channel_totals(curated),
            "category_analytics": lambda: enrich.category_rollup(curated, lookup, keyed=True),
            "not_there": Table(spark, scratch_path(spark, "none")).read,
        },
    )


# ── quality ────────────────────────────────────────────────────────────────


@query
def null_percentage(spark, d):
    """Share of documents without a label: a row only where above 5 percent."""
    documents, labels = base.table(spark, d, "documents"), base.table(spark, d, "labels")
    joined = documents.select("doc_id").join(labels, "doc_id", "left")
    return _rounded(quality.failing_null_percentage(joined, "quality"), "null_percentage")


@query
def quality_report(spark, d):
    checks = [
        *quality.curated_checks(),
        quality.null_percentage("dislikes"),
        quality.not_null("category_id"),
        quality.not_null("no_such_column"),
        quality.value_range("views", 10, 90),
        quality.freshness("_ingestion_timestamp", NOW),
    ]
    return _rounded(quality.run(_curated(spark, d), "curated_statistics", checks), "value")


@query
def quality_verdict(spark, d):
    raw = base.events_raw(spark, d)
    report = quality.run(
        raw, "raw", [quality.row_count(), quality.null_percentage("channel_title"), quality.not_null("tags")]
    )
    return quality.verdict(report)


@query
def contract_report(spark, d):
    """A table written with columns missing and texts among its views: violations per contract column."""
    views = F.col("views")
    raw = base.events_raw(spark, d).withColumn("views", F.when(views % 10 == 0, "n/a").otherwise(views.cast("string")))
    table = Table(spark, scratch_path(spark, "contract"))
    table.replace(raw)
    return quality.contract_violations(table.read(), CURATED_STATISTICS)


@query
def legacy_quality(spark, d):
    stats = _legacy_clean(spark, d)
    report = quality.check_legacy(stats, "clean_statistics", LATER)
    return _rounded(report.select("check_name", "column_name", "value", "passed"), "value", digits=2)


# ── older profile ──────────────────────────────────────────────────────────


def _legacy_clean(spark, d):
    return legacy.clean(base.events_legacy(spark, d), NOW, "clean")


def _legacy_lookup(spark, d):
    reference = base.part_reference(spark, d).withColumnRenamed("title", "snippet.title")
    return legacy.build_lookup(reference)


@query
def legacy_clean(spark, d):
    return _legacy_clean(spark, d).drop("_processed_at", "_job_name")


@query
def legacy_trending(spark, d):
    mart = legacy.trending(_legacy_clean(spark, d), None, NOW).drop("_aggregated_at")
    return _rounded(mart, "avg_views_per_video", "avg_like_ratio", "avg_engagement_rate", digits=4)


@query
def legacy_channel(spark, d):
    stats = stage(_legacy_clean(spark, d), "silver")
    mart = legacy.channel(stats, _legacy_lookup(spark, d), NOW).drop("_aggregated_at")
    return _rounded(mart, "avg_views_per_video", "avg_engagement_rate", digits=4)


@query
def legacy_category(spark, d):
    mart = legacy.category(_legacy_clean(spark, d), _legacy_lookup(spark, d), NOW).drop("_aggregated_at")
    return _rounded(mart, "avg_engagement_rate", digits=4)


@query
def legacy_reference(spark, d):
    """Category items flattened to dotted columns, the last per id and file kept."""
    flat = base.table(spark, d, "part").select(
        F.col("p_size").cast("string").alias("id"),
        F.col("p_name").alias("snippet.title"),
        F.col("p_brand").alias("_source_file"),
        F.col("p_partkey").alias("position"),
    )
    return legacy.latest_reference(flat, "position").withColumnRenamed("snippet.title", "title")


# ── landing ────────────────────────────────────────────────────────────────


@query
def json_flatten(spark, d):
    """Items as JSON texts, parsed with the declared schema and flattened."""
    texts = base.snapshot_items(spark, d).select("region", F.to_json("item").alias("text"))
    docs = texts.select(
        F.array(F.from_json("text", SNAPSHOT_ITEM)).alias("items"),
        F.struct(C.clean_region(F.col("region")).alias("region"), F.lit("t0").alias("ingestion_timestamp")).alias(
            "_pipeline_metadata"
        ),
        F.lit(None).cast("string").alias("_corrupt_record"),
        F.lit("inline").alias("_source_file"),
    )
    return landing.normalize_snapshots(docs, "unused")


@query
def csv_roundtrip(spark, d):
    """Documents through historical CSV files, texts with quotes and newlines."""
    path = scratch_path(spark, "csv")
    history = base.table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.lit("24.31.01").alias("trending_date"),
        F.concat(F.lit('say "'), F.col("source"), F.lit('", ok')).alias("title"),
        F.when(F.col("doc_id") % 3 == 0, "NA").otherwise(F.col("source")).alias("channel_title"),
        F.col("n_chars").cast("string").alias("views"),
        F.col("text").alias("description"),
        "lang",
    )
    (
        history.withColumnRenamed("lang", "region")
        .write.partitionBy("region")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    raw = landing.read_history_csv(spark, path, landing.iso_now(NOW))
    return raw.select(
        "video_id", "title", "channel_title", "category_id", "trending_date_raw", "views", "likes",
        "description", "region", "source",
    )


@query
def landing_write_read(spark, d):
    """Items landed, then read back with region, metadata and count."""
    path = scratch_path(spark, "landing")
    landing.land_snapshots(base.snapshot_items(spark, d).select("region", "item"), path, NOW)
    docs = landing.read_documents(spark, path, SNAPSHOT_DOCUMENT, multi_line=False)
    raw = landing.normalize_snapshots(docs.select("items", "_pipeline_metadata", "_corrupt_record", "_source_file"), "")
    counts = docs.select(
        F.col("_pipeline_metadata.region").alias("region"), F.col("_pipeline_metadata.video_count").alias("n")
    ).groupBy("region")
    per_region = counts.agg(F.max("n").alias("video_count"), F.count(F.lit(1)).alias("n_documents"))
    shown = raw.groupBy("region", "source", "_ingestion_timestamp").agg(
        F.count_distinct("video_id").alias("n_videos"),
        F.sum("views").alias("views"),
        F.sum("likes").alias("likes"),
        F.sum("comment_count").alias("comments"),
        F.count("tags").alias("n_tags"),
        F.bool_and(C.region_from_path(F.col("_source_file")) == F.col("region")).alias("path_agrees"),
    )
    return shown.join(per_region, "region")


@query
def reference_landing(spark, d):
    """Category items landed twice on one day: only the later landing stays."""
    path = scratch_path(spark, "reference")
    rows = base.part_reference(spark, d)
    item = F.struct(
        F.lit("kind").alias("kind"),
        F.col("id"),
        F.struct(F.col("title"), F.lit(True).alias("assignable")).alias("snippet"),
    )
    for now in (NOW, LATER):
        landing.land_reference(rows.select("region", item.alias("item")), path, now)
    docs = landing.read_documents(spark, path, REFERENCE_DOCUMENT, multi_line=False)
    return landing.normalize_reference(docs, "").drop("_source_file")


@query
def incremental_ingest(spark, d):
    """Two landings and three stream runs: every item is ingested once."""
    root = scratch_path(spark, "ingest")
    items = base.snapshot_items(spark, d)
    paths = f"{root}/landing", f"{root}/raw", f"{root}/checkpoint"

    def run() -> None:
        ingest.ingest_available(spark, *paths, landing.iso_now(NOW), multi_line=False)

    landing.land_snapshots(items.where("event_id % 2 = 0").select("region", "item"), paths[0], NOW)
    run()
    landing.land_snapshots(items.where("event_id % 2 = 1").select("region", "item"), paths[0], LATER)
    run()
    run()
    return ingest.read_ingested(spark, paths[1]).select(
        "video_id", "title", "channel_title", "tags", "views", "likes", "comment_count", "region", "ingest_date"
    )


@query
def bad_lines(spark, d):
    """Landed lines of which some are broken: rows of the good ones, texts of the bad."""
    path = scratch_path(spark, "lines")
    items = base.snapshot_items(spark, d)
    good = F.to_json(F.struct(F.array("item").alias("items")))
    broken = F.concat(F.lit('{"items": [{"id": '), F.col("event_id").cast("string"))
    lines = items.select(F.when(F.col("event_id") % 10 == 0, broken).otherwise(good).alias("value"))
    lines.write.text(f"{path}/region=xx")
    docs = landing.read_documents(spark, path, SNAPSHOT_DOCUMENT, multi_line=False, glob="*.txt")
    rows = landing.normalize_snapshots(docs, "t0").select("video_id", "region", F.lit(None).cast("string").alias("bad"))
    bad = landing.quarantine(docs).select(
        F.lit(None).cast("string").alias("video_id"), F.lit("").alias("region"), F.col("content").alias("bad")
    )
    return rows.unionByName(bad)


def _write_csv(df: DataFrame, path: str) -> None:
    """As historical files are: header, quotes doubled, texts with line breaks as they are."""
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("append").partitionBy("region").options(**options).csv(path)


def _history_cells(items: DataFrame) -> DataFrame:
    """Snapshot items as cells of the historical shape."""
    return items.select(
        F.col("item.id").alias("video_id"),
        F.lit("24.01.02").alias("trending_date"),
        F.col("item.snippet.title").alias("title"),
        F.col("item.snippet.channelTitle").alias("channel_title"),
        F.col("item.snippet.categoryId").alias("category_id"),
        F.col("item.statistics.viewCount").alias("views"),
        F.col("item.statistics.likeCount").alias("likes"),
        F.col("item.snippet.description").alias("description"),
        C.clean_region(F.col("region")).alias("region"),
    )


@query
def mixed_landing(spark, d):
    """One folder tree with JSON, CSV and other files; the stream takes each file once in three runs."""
    root = scratch_path(spark, "mixed")
    items = base.snapshot_items(spark, d)
    paths = f"{root}/landing", f"{root}/raw", f"{root}/checkpoint"
    first, second = items.where("event_id % 4 < 2"), items.where("event_id % 4 >= 2")
    for wave, now in ((first, NOW), (second, LATER)):
        landing.land_snapshots(wave.where("event_id % 2 = 0").select("region", "item"), paths[0], now)
        _write_csv(_history_cells(wave.where("event_id % 2 = 1")), paths[0])
        wave.select(F.col("item.id").alias("value")).write.mode("append").text(f"{paths[0]}/region=xx")
        ingest.ingest_available(spark, *paths, landing.iso_now(now), multi_line=False)
    ingest.ingest_available(spark, *paths, landing.iso_now(LATER), multi_line=False)
    return ingest.read_ingested(spark, paths[1]).select(
        "video_id", "title", "channel_title", "category_id", "trending_date_raw", "views", "likes", "description",
        "region", "source", "_ingestion_timestamp",
    )


@query
def csv_two_headers(spark, d):
    """CSV files of two headers in one folder beside broken ones: all good rows, and each bad one's text."""
    path = scratch_path(spark, "headers")
    docs = base.table(spark, d, "documents").withColumn("video_id", F.col("doc_id").cast("string"))
    views = F.col("n_chars").cast("string").alias("views")
    even, odd = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")
    _write_csv(even.select("video_id", F.col("text").alias("description"), views, F.col("lang").alias("region")), path)
    _write_csv(odd.select(views, F.col("source").alias("title"), "video_id", F.col("lang").alias("region")), path)
    # Lines as they are: a cell too few for one id in three, too many for another.
    more = F.when(F.col("doc_id") % 3 == 0, ",7").when(F.col("doc_id") % 3 == 1, ',7,"t, u"').otherwise(',7,"t, u",more')
    line = F.concat(F.lit("r"), F.col("video_id"), more).alias("video_id,views,title")
    docs.select(line).write.options(header=True, sep="\x01", quote="").csv(f"{path}/region=xx")
    rows, bad = landing.read_history(spark, path, landing.iso_now(NOW))
    kept = rows.select("video_id", "title", "views", "description", "region", F.lit(None).cast("string").alias("bad"))
    none = F.lit(None).cast("string")
    lost = bad.select(
        none.alias("video_id"), F.col("error").alias("title"), none.cast("bigint").alias("views"), none.alias("description"),
        C.region_from_path(F.col("key")).alias("region"), F.trim("content").alias("bad"),
    )
    return kept.unionByName(lost)


@query
def mistyped_item(spark, d):
    """Documents of up to 50 items, some with a field of another type: all items stay, and what each lost."""
    path = scratch_path(spark, "mistyped")
    items = base.snapshot_items(spark, d)
    number, mended = F.col("event_id"), F.to_json("item")
    odd_tags = F.to_json(F.col("item").withField("snippet", F.col("item.snippet").dropFields("tags").withField("tags", F.lit("a b"))))
    odd_views = F.to_json(F.col("item").withField("statistics.viewCount", F.array(F.lit(1))).withField("snippet", F.lit(7)))
    text = F.when(number % 10 == 0, odd_tags).when(number % 10 == 1, odd_views).otherwise(mended)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(number, text.alias("text")))), lambda x: x["text"])
    docs = items.groupBy(F.floor(number / 50)).agg(F.array_join(ordered, ",").alias("items"))
    docs.select(F.concat(F.lit('{"items": ['), "items", F.lit("]}"))).write.text(f"{path}/region=xx")
    read = landing.read_documents(spark, path, SNAPSHOT_DOCUMENT, multi_line=False, glob="*.txt")
    none = F.lit(None).cast("string")
    rows = landing.normalize_snapshots(read, "t0").select("video_id", "title", "tags", "views", "likes", none.alias("lost"))
    lost = landing.quarantine(read).select(
        F.get_json_object("content", "$.id").alias("video_id"),
        none.alias("title"), none.alias("tags"), none.cast("bigint").alias("views"), none.cast("bigint").alias("likes"),
        F.col("error").alias("lost"),
    )
    return rows.unionByName(lost)


@query
def legacy_flatten(spark, d):
    """Category documents with keys that vary from item to item, flattened to the columns that occur."""
    path = scratch_path(spark, "flatten")
    part = base.table(spark, d, "part")
    sizes = F.when(F.col("p_partkey") % 3 == 0, F.struct(F.col("p_size").alias("size"), F.col("p_type").alias("in")))
    item = F.struct(
        F.col("p_partkey").alias("id"),
        F.struct(F.col("p_name").alias("title"), (F.col("p_size") > 25).alias("assignable"), sizes.alias("box")).alias("snippet"),
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).alias("brand name"),
    )
    itself = F.to_json(item)
    listed = F.concat(F.lit('{"items": ['), itself, F.lit("]}"))
    part.select(F.when(F.col("p_partkey") % 5 == 0, itself).otherwise(listed)).write.text(f"{path}/region=xx")
    flat = landing.flatten_items(landing.read_items(spark, path, multi_line=False, glob="*.txt"))
    return flat.select(*[F.col(f"`{c}`").alias(c.replace(".", "_").replace(" ", "_")) for c in flat.columns if c != "_source_file"])


@query
def run_counters(spark, d):
    """Three runs of the stream over a growing landing area: rows and quarantine records by run and region."""
    root = scratch_path(spark, "counters")
    items = base.snapshot_items(spark, d)
    where = f"{root}/landing"
    runs = []
    waves = (items.where("event_id % 3 = 0"), NOW), (items.where("event_id % 3 > 0"), LATER), (None, LATER)
    for number, (rows, now) in enumerate(waves):
        if rows is not None:
            landing.land_snapshots(rows.where("event_id % 2 = 0").select("region", "item"), where, now)
            _write_csv(_history_cells(rows.where("event_id % 2 = 1")), where)
            broken = rows.where("event_id % 10 = 0").select(F.lit("no list").alias("items"), C.clean_region(F.col("region")).alias("region"))
            broken.write.mode("append").partitionBy("region").json(where)
        taken = ingest.ingest_available(
            spark, where, f"{root}/raw", f"{root}/checkpoint", landing.iso_now(now), multi_line=False,
            quarantine_path=f"{root}/bad", counters_path=f"{root}/counters",
        )
        counters = ingest.read_batches(spark, f"{root}/counters", COUNTERS, taken)
        sums = counters.groupBy("region").agg(F.sum("rows").alias("rows"), F.sum("quarantined").alias("quarantined"))
        runs.append(sums.withColumn("run", F.lit(number)))
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


def _two_waves(spark, d, times):
    root = scratch_path(spark, "streamed")
    events = base.table(spark, d, "events")
    table = Table(spark, f"{root}/table", ["region", "trending_date_parsed"])
    for half, now in times:
        totals = (
            events.where(F.col("event_id") % 2 == half)
            .groupBy("user_id", F.col("event_type").alias("region"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        item = F.struct(
            F.col("user_id").cast("string").alias("id"),
            F.struct(F.col("n").cast("string").alias("viewCount")).alias("statistics"),
        )
        landing.land_snapshots(totals.select("region", item.alias("item")), f"{root}/landing", now)
        ingest.ingest_available(
            spark, f"{root}/landing", f"{root}/raw", f"{root}/check", landing.iso_now(now), multi_line=False
        )
        ingest.upsert_available(spark, f"{root}/raw", table, f"{root}/upsert")
    return table.read().select("video_id", "region", "trending_date_parsed", "views", "_ingestion_timestamp")


@query
def streamed_upsert(spark, d):
    """Per-user totals landed in two waves; the later wave replaces the earlier."""
    return _two_waves(spark, d, [(0, NOW), (1, LATER)])


@query
def upsert_out_of_order(spark, d):
    """The same waves with the older one landing last: it replaces nothing newer."""
    return _two_waves(spark, d, [(1, LATER), (0, NOW)])


@query
def land_null_region(spark, d):
    """Items of which some have no region: all land, those under ``unknown``."""
    path = scratch_path(spark, "regions")
    items = base.snapshot_items(spark, d)
    region = F.when(F.col("event_id") % 3 != 0, F.col("region"))
    landing.land_snapshots(items.select(region.alias("region"), "item"), path, NOW)
    docs = landing.read_documents(spark, path, SNAPSHOT_DOCUMENT, multi_line=False)
    raw = landing.normalize_snapshots(docs, "")
    return raw.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("views").alias("views"))


@query
def whole_run(spark, d):
    """Landing to marts in one run, with its checks; the channel mart."""
    items = _named_items(spark, d).select("region", "item")
    jobs, source = _landed_run(spark, scratch_path(spark, "run"), items, _names(spark, d))
    jobs.run(source, NOW)
    return _rounded(jobs.read_marts()["channel_analytics"], "avg_engagement_rate")


def _landed_run(spark, root, items, names, now=NOW):
    landing.land_snapshots(items, f"{root}/stats", now)
    item = F.struct(F.col("id"), F.struct("title").alias("snippet"))
    landing.land_reference(names.select("region", item.alias("item")), f"{root}/ref", now)
    return Medallion(spark, Lake(spark, f"{root}/lake")), Landing(f"{root}/stats", f"{root}/ref", multi_line=False)


def _named_items(spark, d):
    """Items that all have a channel name, so that the null check lets a run go on."""
    channel = F.coalesce("item.snippet.channelTitle", F.lit("no name"))
    return base.snapshot_items(spark, d).select("event_id", "region", F.col("item").withField("snippet.channelTitle", channel).alias("item"))


def _names(spark, d):
    return base.part_reference(spark, d).groupBy("id", "region").agg(F.min("title").alias("title"))


@query
def mixed_timestamps(spark, d):
    """A run over landings of which one has a time that is none: the daily mart, and a second run adds nothing."""
    root = scratch_path(spark, "times")
    items = _named_items(spark, d).select("region", "item")
    jobs, source = _landed_run(spark, root, items, _names(spark, d))
    odd = items.select(
        C.clean_region(F.col("region")).alias("region"), F.array("item").alias("items"),
        F.struct(F.lit("not known").alias("ingestion_timestamp")).alias("_pipeline_metadata"),
    )
    odd.write.mode("append").partitionBy("region").json(f"{root}/stats")
    jobs.run(source, NOW)
    jobs.run(source, LATER)
    return _rounded(jobs.read_marts()["trending_analytics"], "avg_engagement_rate", "avg_like_ratio")


@query
def reference_twice(spark, d):
    """Category documents landed, loaded in two runs, one landing changed in between: each content once."""
    root = scratch_path(spark, "twice")
    names = _names(spark, d)
    jobs, source = _landed_run(spark, root, _named_items(spark, d).select("region", "item"), names)
    jobs.run(source, NOW)
    jobs.run(source, NOW)
    more = names.where("cast(id as int) % 2 = 0").withColumn("title", F.concat(F.lit("new "), "title"))
    item = F.struct(F.col("id"), F.struct("title").alias("snippet"))
    day_after = datetime(2024, 2, 2, 6, 30, 0, tzinfo=timezone.utc)
    landing.land_reference(more.select("region", item.alias("item")), f"{root}/ref", day_after)
    jobs.run(source, LATER)
    return jobs.raw_reference.read().drop("_source_file")


@query
def changed_days_equal(spark, d):
    """Marts of changed days after new rows and new category names: the category mart equals a full build."""
    root = scratch_path(spark, "changed")
    items, names = _named_items(spark, d), _names(spark, d)
    jobs, source = _landed_run(spark, root, items.where("event_id % 3 < 2").select("region", "item"), names)
    jobs.run(source, NOW, changed_days=True)
    day_after = datetime(2024, 2, 2, 6, 30, 0, tzinfo=timezone.utc)
    renamed = names.where("cast(id as int) % 7 = 0").withColumn("title", F.concat(F.lit("new "), "title"))
    jobs, source = _landed_run(spark, root, items.where("event_id % 3 = 2").select("region", "item"), renamed, day_after)
    jobs.run(source, day_after, changed_days=True)
    return _rounded(jobs.read_marts()["category_analytics"], "view_share_pct")


@query
def run_report(spark, d):
    """What a run says of itself: rows of each table, removed rows, warnings, rows landed by region."""
    root = scratch_path(spark, "report")
    items = _named_items(spark, d)
    title = F.when(F.col("event_id") % 50 != 0, F.col("item.snippet.title"))
    items = items.withColumn("item", F.col("item").withField("snippet.title", title))
    twice = items.unionByName(items.where("event_id % 4 = 0")).select("region", "item")
    jobs, source = _landed_run(spark, root, twice, _names(spark, d))
    report = jobs.run(source, NOW)
    rows = [*report.rows.items(), ("quarantined", report.quarantined)]
    rows += [(f"landed {region}", n) for region, n in report.landed.items()] + [(f"warning {name}", n) for name, n in report.warnings.items()]
    return spark.createDataFrame(rows, "name string, n bigint")


@query
def failing_gate(spark, d):
    """A run whose curated rows fail a check: the failed check, and that no mart was built."""
    root = scratch_path(spark, "gate")
    untitled = F.col("item").withField("snippet.title", F.lit(None).cast("string"))
    items = _named_items(spark, d).select("region", untitled.alias("item"))
    jobs, source = _landed_run(spark, root, items, _names(spark, d))
    try:
        jobs.run(source, NOW)
        failed = []
    except quality.QualityError as problem:
        failed = [(f["table_name"], f["check_name"], f["column_name"]) for f in problem.failed]
    marts = sum(table.exists() for table in jobs.marts.values())
    return spark.createDataFrame([(*f, marts) for f in failed], "table_name string, check_name string, column_name string, marts int")


@query
def older_run(spark, d):
    """The older profile from files to its registered channel table."""
    root = scratch_path(spark, "older")
    jobs = OlderMedallion(spark, Lake(spark, root), "strata_older")
    jobs.clean_statistics(base.events_legacy(spark, d).withColumn("region", F.lower(F.trim("region"))), NOW, "older", base.EVENT_TYPES)
    item = F.struct(F.col("id"), F.struct("title").alias("snippet"))
    landing.land_reference(_names(spark, d).select("region", item.alias("item")), f"{root}/ref", NOW)
    jobs.clean_reference(f"{root}/ref", "2024-02-01T06:30:00", multi_line=False)
    jobs.build_gold(NOW)
    return _rounded(spark.table("strata_older.channel_analytics").drop("_aggregated_at"), "avg_views_per_video", "avg_engagement_rate", digits=4)


@query
def api_shape(spark, d):
    """Flattened API columns, told from the flat shape by their names, through the older cleaning."""
    items = base.snapshot_items(spark, d).select("region", "item")
    flat = items.select(
        F.col("item.id").alias("id"),
        *[F.col(f"item.snippet.{c}").alias(f"snippet.{c}") for c in ("title", "channelTitle", "categoryId", "publishedAt")],
        *[F.col(f"item.statistics.{c}").alias(f"statistics__{c}") for c in ("viewCount", "likeCount", "commentCount")],
        "region",
    )
    cleaned = legacy.clean(flat, NOW, "api")
    return _rounded(cleaned.withColumn("_processed_at", C.utc_iso(F.col("_processed_at"))), "like_ratio", "engagement_rate", digits=4)


@query
def isolated_regions(spark, d):
    """Landing region by region, two of which fail: what landed, and what did not."""
    root = scratch_path(spark, "regions")
    items = base.snapshot_items(spark, d).withColumn("region", C.clean_region(F.col("region")))
    names = _names(spark, d).withColumn("region", F.lower("region"))

    def snapshots(region: str) -> DataFrame:
        if region == "error":
            raise OSError("no answer")
        return items.where(F.col("region") == region).select("item")

    def categories(region: str) -> DataFrame:
        if region == "signup":
            raise OSError("no answer")
        return names.where(F.col("region") == region).select(F.struct("id", F.struct("title").alias("snippet")).alias("item"))

    report = landing.land_regions([f" {r.upper()}" for r in base.EVENT_TYPES], snapshots, categories, f"{root}/stats", f"{root}/ref", NOW)
    told = [(r, "success") for r in report.success] + [(f["region"], f["type"]) for f in report.failed]
    told = spark.createDataFrame(told, "region string, outcome string")
    read = landing.read_snapshots(spark, f"{root}/stats", "t0", multi_line=False).groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    return told.join(read, "region", "left")


@query
def isolated_tables(spark, d):
    """Checks of several tables, one of which cannot be read."""
    curated = _curated(spark, d)
    tables = {
        "curated": lambda: curated,
        "daily": lambda: enrich.trending_analytics(curated, keyed=True),
        "absent": Table(spark, scratch_path(spark, "none")).read,
    }
    report = quality.run_all(spark, tables, lambda df, name: quality.run(df, name, [quality.row_count(3), quality.not_null("region")]))
    return report.select("table_name", "check_name", "column_name", "value", "passed")


@query
def sampled_check(spark, d):
    """Checks of a bounded sample, as the older profile made them."""
    checks = [quality.row_count(10), quality.not_null("video_id")]
    return quality.run(_curated(spark, d), "curated_statistics", checks, sample=500).select("check_name", "column_name", "value", "passed")


@query
def optional_lookup(spark, d):
    """The category mart where the lookup table is absent."""
    return _rounded(enrich.category_analytics(_curated(spark, d), None, keyed=True), "view_share_pct")


@query
def file_list(spark, d):
    """Category documents of the files that are named, out of a folder with more."""
    path = scratch_path(spark, "files")
    item = F.struct(F.col("id"), F.struct(F.col("title")).alias("snippet"))
    landing.land_reference(base.part_reference(spark, d).select("region", item.alias("item")), path, NOW)
    named = [f for region in ("view", "click") for f in spark.read.text(f"{path}/region={region}").inputFiles()]
    return landing.read_reference(spark, named, "", multi_line=False).drop("_source_file")


@query
def catalog_table(spark, d):
    """A mart in a layer of its own name, registered and read from the catalog, replaced once."""
    lake = Lake(spark, scratch_path(spark, "lake"), {"enriched": " marts "})
    mart = lake.table("enriched", "channels", ["region"])
    totals = enrich.channel_totals(base.sales(spark, d))
    mart.replace(totals.where("region = 'asia'"), register="strata_marts.channels")
    mart.replace(totals, register="strata_marts.channels")
    return _rounded(spark.table("strata_marts.channels"), "avg_engagement_rate")


@query
def client_rows(spark, d):
    """Region totals as a client gets them: texts, with nothing for null."""
    totals = serve.views_by(enrich.channel_totals(base.sales(spark, d)), "region")
    found = serve.rows(totals.withColumn("note", F.lit(None).cast("string")), 100, as_text=True)
    return spark.createDataFrame([(r["region"], r["total_views"], r["note"]) for r in found], "region string, total_views string, note string")
