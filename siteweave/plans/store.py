"""Written tables that cut lineage, in the folder that the whole cluster shares."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; where none is set a temporary one is made, in a session on one machine only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
        if not found:
            if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
            spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
            found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession):
    """Shuffle files of what is written meanwhile are removed as soon as it is, not whenever the driver collects garbage.

    The setting is the session's: threads that share one should not plan queries while another writes.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, computed once, written as Parquet and read again."""
    path = new_path(df.sparkSession, name)
    with _shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    """The path in its file system, whichever that is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _place(spark, path)
    return system.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    system, at = _place(spark, path)
    system.delete(at, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    system, at = _place(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(at)) if system.exists(at) else []


def small_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if there is none."""
    if not exists(spark, path):
        return None
    row = spark.read.text(path, wholetext=True).first()
    return row[0] if row else ""


def switch(spark: SparkSession, path: str, text: str) -> None:
    """Replaces a small file in one step: readers see the old content or the new, nothing between."""
    jvm, new = spark._jvm, f"{path}.{uuid.uuid4().hex}"
    system, at = _place(spark, new)
    out = system.create(at, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(at, jvm.org.apache.hadoop.fs.Path(path), how)


def merged_in(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: it is sorted and merged in. By the few bytes of its compressed files it would be sent
    whole to the driver and to every task, where its rows take many times that."""
    return df.hint("merge")


def discard(df: DataFrame) -> None:
    """Removes a table that ``written`` has made and that nothing will read again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)
