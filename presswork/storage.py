"""Where jobs keep intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="presswork-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. It may be unset only where all run in one process."""
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master.split("[")[0] != "local":
        raise RuntimeError(f"spark.checkpoint.dir is not set: on {master} it must name a folder that driver and executors share")
    return _own_folder()


def dropped_at_exit(spark: SparkSession, folder: str) -> None:
    """The folder, which must be there, goes when the application ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings are these for a while, and then as they were."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cutter(spark: SparkSession, name: str) -> Callable[[DataFrame], DataFrame]:
    """A function that writes a frame into a shared folder of its own and reads it back, so that it has no lineage.

    Results are lazy and may read the tables: they go when the application ends.
    """
    base, made = f"{shared_folder(spark)}/presswork/{name}-{uuid.uuid4().hex}", []

    def cut(df: DataFrame) -> DataFrame:
        made.append(f"{base}/{len(made)}")
        df.write.parquet(made[-1])
        if len(made) == 1:
            dropped_at_exit(spark, base)
        return spark.read.schema(df.schema).parquet(made[-1])

    return cut
