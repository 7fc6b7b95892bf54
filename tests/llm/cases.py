"""Rows that every operator must take, and helpers."""

from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

EDGE_TEXTS = [
    None,
    "",
    " \t\n ",
    "a",
    "tie",
    "tie",
    "Ünïcode ñandú 漢字 \U0001f600 é ß",
    "And " * 3000,
    "x" * 200_000,
    "line\nline\n\nline\r\nother line\n",
    "<|endoftext|> a <|endoftext|>b  c   \n\n d 's 'll 12345 � \x00 \x1f",
]


def docs(spark, texts, first=0):
    rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def edge_docs(spark):
    """Edge texts, a repeated row, a null id, and columns with clashing names."""
    rows = [(i, t, "en" if i % 2 else None, None, None) for i, t in enumerate(EDGE_TEXTS)]
    rows += [(3, "a", "en", None, None), (None, "no id", "en", "s", 5), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    names = ["ids", "words", "low", "bands", "block", "start", "_counts", "key", "label", "item_id", "spans", "decoded", "n", "by"]
    names += ["_own", "_key", "_id", "_blank", "_extra", "_digest", "_words", "_lines", "_windows", "_sorted", "_once", "c0", "c1", "row"]
    return df.selectExpr("*", *[f"'clash' as `{n}`" for n in names])


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def written(spark, tmp_path, **tables):
    """A folder of Parquet tables for a query."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def driver_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
