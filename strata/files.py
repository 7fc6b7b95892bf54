"""Small control files on whatever file system Spark is configured for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _path(spark, path)
    return fs.exists(where)


def read_text(spark: SparkSession, path: str) -> str | None:
    where, fs = _path(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the target, then rename over it, so readers see old or new."""
    jvm = spark._jvm
    target, _ = _path(spark, path)
    beside, fs = _path(spark, f"{path}.new")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri() if target.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(beside, target, options)


def delete(spark: SparkSession, path: str) -> None:
    where, fs = _path(spark, path)
    fs.delete(where, True)


def folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Folders ``depth`` levels below ``path`` (at 0, itself if it is there), relative to it."""
    where, fs = _path(spark, path)
    if not fs.exists(where):
        return []
    found = [""]
    for _ in range(depth):
        below = []
        for parent in found:
            # A child's URI would escape names twice; its name is the folder's own.
            for status in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{parent}" if parent else path)):
                if status.isDirectory():
                    below.append(f"{parent}/{status.getPath().getName()}" if parent else status.getPath().getName())
        found = below
    return found


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put one folder in the place of another, which may be absent."""
    here, fs = _path(spark, source.rstrip("/"))
    there, _ = _path(spark, target.rstrip("/"))
    if fs.exists(there):
        fs.delete(there, True)
    else:
        fs.mkdirs(there.getParent())
    if not fs.rename(here, there):
        raise OSError(f"cannot move {source} to {target}")
