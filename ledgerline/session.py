"""Session factory with the settings that the library's results depend on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "ledgerline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ANSI mode, UTC time and adaptive execution.

    Cluster settings (executors, memory, shuffle partitions) stay with the caller;
    pass them in `conf`.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share: spark.checkpoint.dir, or on a single
    machine that names none, a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir: names no folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{found}/{uuid.uuid4().hex}"


def written(df):
    """df as a table in the shared folder, for small results that a plan needs more than once."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
