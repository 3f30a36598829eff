"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# What the models assume. Everything else is left to the cluster's own settings.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", app: str = "leadloom", **conf: str) -> SparkSession:
    """Single-process session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **REQUIRED,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.driver.memory": "8g",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, as the cluster names it.

    Only a session in a single process gets a temporary folder of its own when
    ``spark.checkpoint.dir`` is not set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current is not None:
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="leadloom-"))
    return spark.sparkContext.getCheckpointDir()


def _application_folder(spark: SparkSession) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/leadloom/{spark.sparkContext.applicationId}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


_forgetting: list[Callable[[], None]] = []


def on_release(forget: Callable[[], None]) -> Callable[[], None]:
    """Call forget whenever the shared folder is released."""
    _forgetting.append(forget)
    return forget


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release_shared(spark: SparkSession) -> None:
    """Delete what this application wrote below the shared folder.

    For the end of an application: results that still read from there break. Whoever keeps
    paths below the folder registers a function that forgets them with ``on_release``.
    """
    for forget in _forgetting:
        forget()
    delete_folder(spark, _application_folder(spark))
