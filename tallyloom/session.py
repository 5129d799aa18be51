"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# What the jobs assume beyond Spark's defaults. Shuffle partitions are left to
# the cluster: AQE coalesces small ones and splits skewed ones.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # HotSpot leaves larger methods to the interpreter; better no whole-stage
    # code for a wide projection than code that is never compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # no call-site capture for every column expression
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", app: str = "tallyloom", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **RECOMMENDED,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, or where that is unset beside
    the session's tables, in its warehouse; all executors share either. The
    caller owns the folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/work"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def find_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    Enough where the nodes see the same folder or have the package installed;
    elsewhere it is shipped with the job as usual.
    """
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH")]))
