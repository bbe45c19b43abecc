"""Session set-up shared by the tests, the bench and stand-alone use."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(app: str = "voxmill", cores: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session with the settings every query of this engine expects (UTC, AQE, Arrow)."""
    n = cores or os.cpu_count() or 4
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for cut lineage. A local session without one gets a folder of its own; a cluster must name it,
    as no executor can read what another wrote to its own disk."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        held = sc._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="voxmill-checkpoint-")
    sc.setCheckpointDir(found)
    return found


def table(spark: SparkSession, sf_dir: str, name: str):
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package's source, once a session; Python workers of a cluster may not have its folder."""
    sc = spark.sparkContext
    if sc.master.startswith("local[") or getattr(sc, "_voxmill_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="voxmill-ship-"), "voxmill_package.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    sc._voxmill_shipped = True


def spread(df):
    """A scan's rows over all cores, for work in Python workers that costs far more than moving a row.

    Only where the scan has fewer partitions than the session has cores: few or unsplittable files. Large inputs keep
    their own partitions and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
