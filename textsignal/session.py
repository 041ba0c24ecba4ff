"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "textsignal", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, named in ``spark.checkpoint.dir``.

    Only a session of one machine may do without: it gets a new temporary folder, remembered in the session.
    Elsewhere every executor would write to a disk of its own, so a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("textsignal.scratch.dir", None)
    if root:
        return root
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="textsignal-")
    spark.conf.set("textsignal.scratch.dir", root)
    return root


def run_folder(spark: SparkSession) -> str:
    """Folder below the scratch root that holds everything this application writes there."""
    return os.path.join(scratch_root(spark), f"textsignal-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the application's own folder; never reused."""
    return os.path.join(run_folder(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def clear_scratch(spark: SparkSession) -> bool:
    """Removes the application's intermediate tables; returns whether there were any.

    Results are lazy and read these tables, so an operator cannot remove its own.  The owner is the job that started the
    session: it calls this once its last result is written.  Other applications' folders are not touched.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_stored(df: DataFrame) -> None:
    """Removes the stored table that ``df`` reads, for an operator that knows it has no other reader."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
