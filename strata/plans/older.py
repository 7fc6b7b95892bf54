"""The older profile's jobs: two clean tables, five checks, three gold tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from strata.operators import legacy, quality
from strata.operators.clean import counted, warnings
from strata.schemas import REFERENCE_DOCUMENT
from strata.session import staging
from strata.sources import landing
from strata.tables import Lake, Table

# Regions the older statistics job reads.
REGIONS = ["ca", "gb", "us", "in"]

GOLD = {
    "trending_analytics": legacy.trending,
    "channel_analytics": legacy.channel,
    "category_analytics": legacy.category,
}


class OlderMedallion:
    def __init__(self, spark: SparkSession, lake: Lake, database: str = "gold"):
        self.spark = spark
        self.database = database
        self.statistics = lake.table("silver", "clean_statistics", ["region"])
        self.reference = lake.table("silver", "clean_reference_data", ["region"])
        self.gold: dict[str, Table] = {name: lake.table("gold", name, ["region"]) for name in GOLD}

    def clean_statistics(
        self, bronze: DataFrame, now: datetime, job_name: str, regions: Sequence[str] = REGIONS
    ) -> dict[str, int]:
        """Clean the given regions' rows; nothing read means nothing written."""
        rows = bronze.where(bronze["region"].isin(list(regions)))
        if rows.isEmpty():
            return {"read": 0, "written": 0}
        read, noted = Observation(), Observation()
        cleaned = legacy.clean(counted(rows, read), now, job_name)
        written = self.statistics.replace(warnings(cleaned, noted))
        return {"read": read.get["rows"], "written": written, **noted.get}

    def clean_reference(self, paths: str | Sequence[str], run_ts: str, multi_line: bool = True) -> DataFrame:
        """Flatten category files; regions that occur are replaced, others stay.

        Returns all files without any item, which are errors.
        """
        flat = landing.flat_reference(self.spark, paths, run_ts, multi_line)
        if "id" in flat.columns:
            flat = legacy.latest_reference(flat, "position")
        self.reference.overwrite_partitions(flat.drop("position"))
        docs = landing.read_documents(self.spark, paths, REFERENCE_DOCUMENT, multi_line)
        return landing.empty_reference_files(docs)

    def check(self, now: datetime, sample: int | None = None) -> list[dict]:
        """All checks of both clean tables; raises if one fails."""
        tables = {"clean_statistics": self.statistics.read, "clean_reference_data": self.reference.read}
        report = quality.run_all(
            self.spark, tables, lambda df, name: quality.check_legacy(df, name, now, sample)
        )
        return quality.gate(report)

    def build_gold(self, now: datetime) -> dict[str, int]:
        """Marts, registered in the catalog.  The reference table is optional."""
        lookup = legacy.build_lookup(self.reference.read()) if self.reference.exists() else None
        stats = self.statistics.read()
        with staging(self.spark):
            return {
                name: self.gold[name].replace(build(stats, lookup, now), register=f"{self.database}.{name}")
                for name, build in GOLD.items()
            }
