"""The whole run, layer by layer: raw, curated, checks, enriched, freshness."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import files
from strata.operators import enrich, quality
from strata.operators.clean import counted, curate_reference, curate_statistics, warnings
from strata.operators.incremental import EPOCH, newer_than, watermark, with_ingest_date
from strata.plans import serve
from strata.schemas import CORRUPT, COUNTERS, CURATED_KEY, QUARANTINE, RAW_STATISTICS, REFERENCE_DOCUMENT
from strata.sources import landing
from strata.session import stage, staging
from strata.streaming import ingest
from strata.tables import Lake, Table

STATS_LAYOUT = ["region", "trending_date_parsed"]


class NothingLanded(RuntimeError):
    """Neither landing folder holds a readable file."""


@dataclass(frozen=True)
class Landing:
    statistics: str
    reference: str
    history: str | None = None
    multi_line: bool = True


@dataclass
class RunReport:
    rows: dict[str, int] = field(default_factory=dict)
    # Raw statistics rows that this run landed, by region; the table
    # ``landed_counters`` has them by file.
    landed: dict[str, int] = field(default_factory=dict)
    quarantined: int = 0
    checks: list[dict] = field(default_factory=list)
    warnings: dict[str, int] = field(default_factory=dict)


class Medallion:
    """Tables of one lake and the jobs between them."""

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark = spark
        self.raw_statistics = lake.table("raw", "raw_statistics", ingest.RAW_LAYOUT)
        self.raw_reference = lake.table("raw", "raw_reference_data", ["region"])
        self.live_path = lake.path("raw", "raw_statistics_live")
        self.live_checkpoint = lake.path("raw", "raw_statistics_live_checkpoint")
        self.bad_path = lake.path("raw", "quarantine_live")
        self.counters_path = lake.path("raw", "landed_counters")
        self.reference_ledger = lake.table("raw", "reference_ledger")
        self.quarantine = lake.table("raw", "quarantine")
        self.statistics = lake.table("curated", "curated_statistics", STATS_LAYOUT)
        self.reference = lake.table("curated", "curated_reference_data", ["region"])
        self.marts: dict[str, Table] = {
            name: lake.table("enriched", name, ["region"]) for name in serve.EXTRACTS
        }
        self.mark_path = lake.path("curated", "_statistics_mark")
        self.built_path = lake.path("enriched", "_built_through")
        self.built_lookup = lake.table("enriched", "_built_lookup")
        self.extracts = {name: lake.table("extract", name) for name in serve.EXTRACTS}

    # ── raw ────────────────────────────────────────────────────────────────

    def load_raw(self, source: Landing, now: datetime, rescan: bool, report: RunReport) -> None:
        """Append what is landed.

        ``rescan`` reads every landed file again on each run and appends it all;
        otherwise statistics files are taken once, by the stream of new files, and
        reference documents once, by their content.
        """
        run_ts = landing.iso_now(now)
        ref_docs = landing.read_documents(self.spark, source.reference, REFERENCE_DOCUMENT, source.multi_line)
        bad = landing.quarantine(ref_docs)
        frames = []
        if rescan:
            rows, lost = landing.read_landed(self.spark, source.statistics, run_ts, source.multi_line)
            frames.append(rows)
            bad = bad.unionByName(lost)
        else:
            taken = ingest.ingest_available(
                self.spark,
                source.statistics,
                self.live_path,
                self.live_checkpoint,
                run_ts,
                source.multi_line,
                quarantine_path=self.bad_path,
                counters_path=self.counters_path,
            )
            by_region = self.landed_counters(taken).groupBy("region").agg(F.sum("rows").alias("rows"))
            report.landed = {row["region"]: row["rows"] for row in by_region.collect()}
            bad = bad.unionByName(ingest.read_batches(self.spark, self.bad_path, QUARANTINE))
        report.rows["raw_statistics"] = sum(report.landed.values())
        if source.history:
            rows, lost = landing.read_history(self.spark, source.history, run_ts)
            frames.append(rows)
            bad = bad.unionByName(lost)
        if frames:
            batch = with_ingest_date(landing.union_shapes(self.spark, frames, RAW_STATISTICS))
            report.rows["raw_statistics"] += self.raw_statistics.append(batch)
        n_ref = self._load_reference(ref_docs, run_ts, rescan)
        report.rows["raw_reference_data"] = n_ref
        # How many; the table has each one's key, error and content.
        report.quarantined = self.quarantine.replace(bad)
        if not report.rows["raw_statistics"] and n_ref == 0 and not self._any_readable(ref_docs, source):
            raise NothingLanded(f"no readable file under {source.statistics} or {source.reference}")

    def _load_reference(self, docs: DataFrame, run_ts: str, rescan: bool) -> int:
        """Append category rows; a document whose content a run has taken before stays out.

        The ledger is written last: a run that dies in between takes the document
        again, and the curated table keeps one row per category anyway.
        """
        if rescan:
            return self.raw_reference.append(landing.normalize_reference(docs, run_ts))
        digest = F.sha2(F.to_json(F.struct("items", "_pipeline_metadata", CORRUPT)), 256)
        known = docs.withColumn("digest", digest)
        if self.reference_ledger.exists():
            known = known.join(self.reference_ledger.read(), ["_source_file", "digest"], "left_anti")
        with staging(self.spark):
            new = stage(known, "reference")
            rows = self.raw_reference.append(landing.normalize_reference(new.drop("digest"), run_ts))
            self.reference_ledger.append(new.select("_source_file", "digest").distinct())
        return rows

    def landed_counters(self, batches: list[int] | None = None) -> DataFrame:
        """Rows and quarantine records per region and file, of all runs or of some batches."""
        return ingest.read_batches(self.spark, self.counters_path, COUNTERS, batches)

    def _any_readable(self, ref_docs: DataFrame, source: Landing) -> bool:
        if landing.mended(ref_docs).where(F.col("items").isNotNull()).select("_source_file", "items").first():
            return True
        return landing.any_readable(self.spark, source.statistics, source.multi_line)

    def read_raw(self) -> DataFrame:
        """The append log: batch loads and live ingest together."""
        parts = []
        if self.raw_statistics.exists():
            parts.append(self.raw_statistics.read())
        if ingest.has_ingested(self.spark, self.live_path):
            parts.append(ingest.read_ingested(self.spark, self.live_path))
        return landing.union_shapes(self.spark, parts, ingest.INGESTED)

    # ── curated ────────────────────────────────────────────────────────────

    def build_statistics(self, report: RunReport, strict: bool = False, inclusive: bool = False) -> None:
        """Upsert what is newer than the high-water mark.

        The mark is kept beside the table, so no scan looks for it.  It is moved after
        the upsert: a run that dies in between takes the same rows again, which
        changes nothing.
        """
        mark = None
        if self.statistics.exists():
            mark = files.read_text(self.spark, self.mark_path) or watermark(self.statistics.read())
        read = Observation()
        fresh = counted(newer_than(self.read_raw(), mark, inclusive), read).drop("ingest_date")
        noted, newest = Observation(), Observation()
        curated = warnings(curate_statistics(fresh, strict), noted)
        curated = curated.observe(newest, F.max("_ingestion_timestamp").alias("mark"))
        written = self.statistics.upsert(curated, CURATED_KEY, ["_ingestion_timestamp"])
        found = max(mark or EPOCH, newest.get["mark"] or EPOCH)
        if found != mark:
            files.write_text(self.spark, self.mark_path, found)
        report.warnings = {name: n for name, n in noted.get.items() if n}
        report.rows["curated_statistics"] = written
        report.rows["removed_statistics"] = read.get["rows"] - written

    def build_reference(self, report: RunReport) -> None:
        report.rows["curated_reference_data"] = self.reference.replace(curate_reference(self.raw_reference.read()))

    # ── enriched ───────────────────────────────────────────────────────────

    def build_marts(self, report: RunReport, changed_days: bool = False) -> None:
        """Full refresh of the three marts.

        ``changed_days`` gives the same marts for statistics that only grew by
        newer ingestions: the two daily ones then read just the (region, day)
        partitions that changed, and keep their other rows.  A day has changed where
        it has rows as new as the last build, or rows of a category whose name
        is another than at the last build.
        """
        stats, lookup = self.statistics.read(), self.reference.read()
        mark = files.read_text(self.spark, self.mark_path) or watermark(stats)
        built = files.read_text(self.spark, self.built_path)
        with staging(self.spark):
            if changed_days and built and self.built_lookup.exists():
                renamed = enrich.lookup_changes(self.built_lookup.read(), lookup)
                days = stage(enrich.changed_days(stats, built, stage(renamed, "renamed")), "days")
                recent = stats.where(self.statistics.partitions_of(days))

                def daily(name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
                    return enrich.refreshed(self.marts[name].read(), days, build(recent))
            else:

                def daily(name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
                    return build(stats)

            marts: dict[str, Callable[[], DataFrame]] = {
                "trending_analytics": lambda: daily(
                    "trending_analytics", lambda s: enrich.trending_analytics(s, keyed=True)
                ),
                "channel_analytics": lambda: enrich.channel_analytics(stats, lookup),
                "category_analytics": lambda: daily(
                    "category_analytics", lambda s: enrich.category_analytics(s, lookup, keyed=True)
                ),
            }
            for name, mart in marts.items():
                report.rows[name] = self.marts[name].replace(mart())
        self.built_lookup.replace(lookup.select("id", "region", "category_name"))
        files.write_text(self.spark, self.built_path, mark)

    def refresh_extracts(self) -> dict[str, int]:
        """Rewrite the BI copies of the marts, without the array column."""
        return {
            name: self.extracts[name].replace(serve.extract(name, table.read())) for name, table in self.marts.items()
        }

    def check(self, tables: dict[str, Callable[[], DataFrame]]) -> list[dict]:
        checks = quality.run_all(
            self.spark,
            tables,
            lambda df, name: (
                quality.check_curated(df, name) if name == "curated_statistics" else quality.check_required(df, name)
            ),
        )
        return quality.gate(checks)

    def freshness(self, now: datetime) -> list[dict]:
        """Warns after 24 hours; older than 48 fails the run."""
        raw = self.read_raw()
        # The newest timestamp lies in the newest day; only that one is read.  The days
        # are values of the layout.  A text that is no day is no newest one.
        days = raw.select("ingest_date").distinct().where(F.col("ingest_date").try_cast("date").isNotNull())
        newest = raw.where(F.col("ingest_date") == days.agg(F.max("ingest_date")).first()[0])
        check = quality.freshness("_ingestion_timestamp", now)
        return quality.gate(quality.run(newest, "raw_statistics", [check]))

    def read_marts(self) -> dict[str, DataFrame]:
        return {name: table.read() for name, table in self.marts.items()}

    # ── the run ────────────────────────────────────────────────────────────

    def run(
        self,
        source: Landing,
        now: datetime,
        rescan: bool = False,
        strict: bool = False,
        inclusive: bool = False,
        changed_days: bool = False,
    ) -> RunReport:
        """A failed check raises before anything of the next layer is built."""
        report = RunReport()
        self.load_raw(source, now, rescan, report)
        # Independent of each other; both must succeed.
        with ThreadPoolExecutor(2) as pool:
            jobs = [
                pool.submit(self.build_statistics, report, strict, inclusive),
                pool.submit(self.build_reference, report),
            ]
            for job in jobs:
                job.result()
        report.checks += self.check(
            {
                "curated_statistics": self.statistics.read,
                "curated_reference_data": self.reference.read,
            }
        )
        self.build_marts(report, changed_days)
        report.checks += self.check({name: table.read for name, table in self.marts.items()})
        report.checks += self.freshness(now)
        return report
