"""Session defaults and shipping of the package to executors."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent

#: Settings the operators assume; all of them can be changed at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "newsloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` wins over them."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    return b.config(map=DEFAULTS | conf).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, once for each context.

    The archive is built on the driver and served by Spark's own file server, so executors need no shared
    copy of the repository.
    """
    sc = spark.sparkContext
    if getattr(sc, "_newsloom_shipped", False):
        return spark
    where = tempfile.mkdtemp(prefix="newsloom-ship-")  # stays: the file server reads it whenever an executor starts
    sc.addPyFile(shutil.make_archive(os.path.join(where, "newsloom"), "zip", PACKAGE.parent, PACKAGE.name))
    sc._newsloom_shipped = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the session, ``spark.checkpoint.dir``; a local one is made only on a local master where that is unset.

    On a cluster executors could not read each other's local disks, so there a missing setting is an error.
    """
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isEmpty():
        return sc._jsc.sc().getCheckpointDir().get()
    at = sc.getConf().get("spark.checkpoint.dir")
    if not at:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = f"file://{tempfile.gettempdir()}/newsloom-{uuid.uuid4().hex}"
    sc.setCheckpointDir(at)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def shared(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a checkpoint in the shared folder of the cluster."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
