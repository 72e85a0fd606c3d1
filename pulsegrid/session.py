"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", name: str = "pulsegrid", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_given: list[tuple[SparkSession, str]] = []


def clean_up() -> None:
    """Remove the folders given out so far. Call it before a session is stopped; at the end of the program it is
    called in any case."""
    for spark, path in _given:
        with contextlib.suppress(Exception):  # the session may have ended
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    _given.clear()


def workspace(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder named by ``spark.checkpoint.dir``; it goes when the program ends.

    A local session without that setting works beside its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    if not _given:
        atexit.register(clean_up)
    _given.append((spark, f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"))
    return _given[-1][1]
