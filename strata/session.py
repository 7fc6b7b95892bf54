"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from strata import files

_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)

# Settings the jobs rely on.  All are runtime SQL settings, so they can be
# applied to a session somebody else has built.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(app_name: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return apply_settings(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local-mode session without that setting gets a temporary folder:
    there driver and executors are one process on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        made = tempfile.mkdtemp(prefix="strata-")
        spark.conf.set("spark.checkpoint.dir", made)
        return made
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/strata-{label}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Used where one intermediate result feeds several branches of a plan: the
    branches then read columns from files instead of recomputing the input,
    and a lost executor costs a re-read, not a re-run.  Like checkpoints, the
    files stay until somebody removes them; see ``staging``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    paths = _staged.get()
    if paths is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove what ``stage`` writes inside the block when the block ends."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in paths:
            files.delete(spark, path)
