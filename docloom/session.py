"""Session set-up and the shared folder for written stages."""

from __future__ import annotations

import contextlib
import functools
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

STAGE_CONF = "spark.checkpoint.dir"


def build_session(app: str = "docloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were tuned under.

    ``master`` is for tests and the bench; on a cluster it comes from submit.
    """
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # One batch of archives handed to Python holds about one of them.
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    }
    if master:
        builder = builder.master(master)
        settings.update(
            {
                "spark.driver.host": "127.0.0.1",
                "spark.driver.bindAddress": "127.0.0.1",
                "spark.ui.enabled": "false",
            }
        )
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for what is started inside; a stream takes them over when it starts."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder the cluster shares for written stages.

    Only a local session may fall back to a folder of this machine: on a
    cluster the executors could not all reach it.
    """
    root = spark.conf.get(STAGE_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {STAGE_CONF} to a folder all executors share")
        root = _local_root()
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes a stage to the shared folder and reads it back.

    For what is too dear to run once per reader; a written stage outlives lost
    executors, and later readers get column pruning.
    """
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a stage that nothing reads any more."""
    fs, where = file_system(spark, path)
    fs.delete(where, True)


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="docloom-")
