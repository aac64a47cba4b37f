"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on in a session made elsewhere: UTC dates and
    adaptive execution that splits skewed joins even at the price of a further shuffle."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: str = "8", app: str = "pacegrid", extra: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus.replace("*", "8"))
    )
    for key, value in {**SQL_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    A temporary local folder is used only by a local master whose session names none, as in
    tests; on a cluster, executors could not see one another's files there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
