"""Parquet tables: append, full refresh, partition overwrite, keyed upsert.

A table folder holds one live data folder and a small descriptor file naming it
with the declared schema and the partition columns.  Reads use the descriptor,
so they infer nothing, and a column added later reads as null from older files.
One writer at a time is assumed per table, any number of readers.  Every writer
first completes an upsert that was interrupted after its merge.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import files

DESCRIPTOR = "_table.json"
PENDING = "_pending"
PENDING_DESCRIPTOR = "_pending.json"
BATCH = "_batch"
SLOTS = ("data-0", "data-1")


class KeyProblem(ValueError):
    """An upsert batch has a null in a key column or two rows for one key."""


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in its order and types; absent ones are null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def evolved(current: StructType, incoming: StructType) -> StructType:
    """The current schema with columns it does not know appended."""
    known = set(current.names)
    return StructType([*current.fields, *[f for f in incoming.fields if f.name not in known]])


class Table:
    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)

    # ── state ──────────────────────────────────────────────────────────────

    def _descriptor(self) -> dict | None:
        text = files.read_text(self.spark, f"{self.path}/{DESCRIPTOR}")
        return json.loads(text) if text else None

    def _publish(self, data: str, schema: StructType) -> None:
        text = json.dumps({"data": data, "schema": schema.jsonValue(), "partition_by": self.partition_by})
        files.write_text(self.spark, f"{self.path}/{DESCRIPTOR}", text)

    def exists(self) -> bool:
        return self._descriptor() is not None

    @property
    def data_path(self) -> str:
        descriptor = self._descriptor()
        if descriptor is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return f"{self.path}/{descriptor['data']}"

    # ── reading ────────────────────────────────────────────────────────────

    def read(self, regions: Sequence[str] | None = None) -> DataFrame:
        descriptor = self._descriptor()
        if descriptor is None:
            raise FileNotFoundError(f"no table at {self.path}")
        schema = StructType.fromJson(descriptor["schema"])
        df = self.spark.read.schema(schema).parquet(f"{self.path}/{descriptor['data']}")
        df = df.select(*[f"`{name}`" for name in schema.names])
        return df if regions is None else df.where(F.col("region").isin(list(regions)))

    # ── writing ────────────────────────────────────────────────────────────

    def _write(
        self, df: DataFrame, path: str, mode: str, touched_only: bool = False, flat: bool = False
    ) -> int:
        """Write and return the row count, taken during the write itself.

        ``touched_only`` limits an overwrite to the partitions found in ``df``;
        ``flat`` leaves out the partition folders, for data that is soon re-read.

        The rebalance hint brings the rows of a partition together, so files are
        few, and lets Spark split a partition that is far larger than the rest.
        """
        counted = Observation()
        layout = [] if flat else self.partition_by
        if layout:
            df = df.hint("rebalance", *layout)
        (
            df.observe(counted, F.count(F.lit(1)).alias("rows"))
            .write.mode(mode)
            .option("compression", "snappy")
            .option("partitionOverwriteMode", "dynamic" if touched_only else "static")
            .partitionBy(*layout)
            .parquet(path)
        )
        return counted.get["rows"]

    def append(self, df: DataFrame) -> int:
        """Add rows.  Columns new to the table are added to its schema."""
        self._apply_pending()
        descriptor = self._descriptor()
        if descriptor is None:
            schema, data = df.schema, SLOTS[0]
        else:
            schema = evolved(StructType.fromJson(descriptor["schema"]), df.schema)
            data = descriptor["data"]
        rows = self._write(conform(df, schema), f"{self.path}/{data}", "append")
        if descriptor is None or schema.jsonValue() != descriptor["schema"]:
            self._publish(data, schema)
        return rows

    def replace(self, df: DataFrame, register: str | None = None) -> int:
        """Full refresh: fill the idle data folder, then make it the live one.

        Until the descriptor changes, readers and a failed run see the old data.
        """
        self._apply_pending()
        descriptor = self._descriptor()
        live = descriptor["data"] if descriptor else SLOTS[1]
        idle = SLOTS[1 - SLOTS.index(live)]
        rows = self._write(df, f"{self.path}/{idle}", "overwrite")
        self._publish(idle, df.schema)
        if register:
            self.register(register)
        return rows

    def overwrite_partitions(self, df: DataFrame) -> int:
        """Replace exactly the partitions that occur in ``df``."""
        self._apply_pending()
        descriptor = self._descriptor()
        if descriptor is None:
            return self.replace(df)
        schema = evolved(StructType.fromJson(descriptor["schema"]), df.schema)
        rows = self._write(conform(df, schema), f"{self.path}/{descriptor['data']}", "overwrite", touched_only=True)
        if schema.jsonValue() != descriptor["schema"]:
            self._publish(descriptor["data"], schema)
        return rows

    def register(self, name: str) -> None:
        """(Re)point a catalog table at the live data."""
        if "." in name:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.catalog.createTable(name, path=self.data_path, source="parquet")
        if self.partition_by:
            self.spark.catalog.recoverPartitions(name)

    # ── upsert ─────────────────────────────────────────────────────────────

    def upsert(self, batch: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> int:
        """Replace rows whose key occurs in ``batch``, insert the others.

        With ``order`` the row with the greatest values there stays, be it the old
        or the new one; the new one at equal values.

        Only partitions that the batch touches are read and rewritten, so the
        partition columns must be part of the key.  The merged partitions are
        first written beside the table; only then are they moved over the live
        ones.  A run that dies in between is completed by the next call.
        """
        if not set(self.partition_by) <= set(key):
            raise ValueError("partition columns must belong to the upsert key")
        descriptor = self._descriptor()
        if descriptor is None:
            first = f"{self.path}/{SLOTS[0]}"
            rows = self._write(batch, first, "overwrite")
            self._check_key(self.spark.read.schema(batch.schema).parquet(first), key)
            self._publish(SLOTS[0], batch.schema)
            return rows

        self._apply_pending()
        staged_path = f"{self.path}/{BATCH}"
        rows = self._write(batch, staged_path, "overwrite", flat=True)
        if rows:
            staged = self.spark.read.schema(batch.schema).parquet(staged_path)
            schema = evolved(StructType.fromJson(self._descriptor()["schema"]), batch.schema)
            touched = self.read().where(self.partitions_of(staged))
            both = conform(touched, schema).withColumn("_new", F.lit(0)).unionByName(
                conform(staged, schema).withColumn("_new", F.lit(1))
            )
            own = Window.partitionBy(*key)
            newest = own.orderBy(*[F.col(c).desc_nulls_last() for c in order], F.col("_new").desc())
            # One shuffle by key: for the newest row, and for keys that the batch may not have.
            placed = both.withColumn("_place", F.row_number().over(newest)).withColumn("_rows", F.sum("_new").over(own))
            checked = Observation()
            problem = (F.col("_new") == 1) & self._bad_key(key, F.col("_rows") > 1)
            placed = placed.observe(checked, F.max(F.when(problem, F.to_json(F.struct(*key)))).alias("key"))
            self._write(placed.where("_place = 1").drop("_place", "_rows", "_new"), f"{self.path}/{PENDING}", "overwrite")
            if checked.get["key"]:
                files.delete(self.spark, f"{self.path}/{PENDING}")
                raise KeyProblem(f"null or repeated upsert key {list(key)}, for example {checked.get['key']}")
            files.write_text(
                self.spark, f"{self.path}/{PENDING_DESCRIPTOR}", json.dumps({"schema": schema.jsonValue()})
            )
            self._apply_pending()
        files.delete(self.spark, staged_path)
        return rows

    def _bad_key(self, key: Sequence[str], repeated: Column) -> Column:
        bad = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key], repeated)
        for name in self.partition_by:
            # A partition folder cannot hold an empty text; it would come back as null.
            bad = bad | (F.col(name).cast("string") == "")
        return bad

    def _check_key(self, staged: DataFrame, key: Sequence[str]) -> None:
        counted = staged.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        found = counted.where(self._bad_key(key, F.col("n") > 1)).first()
        if found:
            raise KeyProblem(f"null or repeated upsert key {list(key)}, for example {found.asDict()}")

    def partitions_of(self, rows: DataFrame) -> Column:
        """Literal predicate for the partitions ``rows`` lie in, so scans are pruned.

        Only distinct partition values come to the driver: at most one row per
        table partition, which the driver lists anyway to plan a scan.
        """
        if not self.partition_by:
            return F.lit(True)
        *outer, last = self.partition_by
        found = rows.select(*self.partition_by).distinct().collect()
        groups: dict[tuple, list] = {}
        for row in found:
            groups.setdefault(tuple(row[c] for c in outer), []).append(row[last])
        terms = []
        for values, last_values in groups.items():
            same = [F.col(c) == F.lit(v) for c, v in zip(outer, values)]
            terms.append(reduce(lambda a, b: a & b, [*same, F.col(last).isin(last_values)]))
        return reduce(lambda a, b: a | b, terms, F.lit(False))

    def _apply_pending(self) -> None:
        """Move merged partitions into the live data.  What a lost run has moved is not moved again."""
        text = files.read_text(self.spark, f"{self.path}/{PENDING_DESCRIPTOR}")
        if not text:
            return
        schema = StructType.fromJson(json.loads(text)["schema"])
        data, pending = self._descriptor()["data"], f"{self.path}/{PENDING}"
        for folder in files.folders(self.spark, pending, len(self.partition_by)):
            files.replace(self.spark, f"{pending}/{folder}", f"{self.path}/{data}/{folder}")
        self._publish(data, schema)
        files.delete(self.spark, f"{self.path}/{PENDING_DESCRIPTOR}")
        files.delete(self.spark, pending)


class Lake:
    """Tables by layer.  A layer's folder name is used literally as given."""

    def __init__(self, spark: SparkSession, root: str, layers: dict[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.layers = layers or {}

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{self.layers.get(layer, layer).strip()}/{name}"

    def table(self, layer: str, name: str, partition_by: Sequence[str] = ()) -> Table:
        return Table(self.spark, self.path(layer, name), partition_by)
