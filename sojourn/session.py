"""Session helpers.

``get_session`` is for tests, the bench and local runs; on a cluster the job
receives the session the platform built.  ``shared_dir`` is the one place that
decides where intermediate tables and sink output go: the cluster's
``spark.checkpoint.dir`` (a shared file system), never a machine-local folder.
Without the setting a private temporary folder serves a local master (tests),
whose driver and executors are one process; any other master raises.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "sojourn") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    builder = builder.config("spark.driver.memory", os.environ.get("SOJOURN_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors (once per context), so tasks can import it wherever the
    driver was started from and without an installation on the workers."""
    sc = spark.sparkContext
    if getattr(sc, "_sojourn_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="sojourn-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "sojourn-code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    z.write(path, os.path.join(os.path.basename(root), os.path.relpath(path, root)))
    sc.addPyFile(archive)
    sc._sojourn_shipped = True


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session; only where it is unset and
    the master is local is a private temporary folder created, registered, and
    deleted when the process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share (master is {master})")
        base = tempfile.mkdtemp(prefix="sojourn-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/")
    return "/".join([base, "sojourn", *parts, uuid.uuid4().hex])
