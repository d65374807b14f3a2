"""Session settings the library relies on.

On a cluster the session is built by the platform; ``build_session`` is for
local runs (tests, bench). Library code only *reads* settings from the
session it is given.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every run wants: adaptive execution re-plans joins from measured
# shuffle sizes, coalesces small partitions and splits skewed ones. Python
# call-site capture (error context only) costs four JVM round trips per API
# call while plans are built, so it is off.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "idbridge", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.driver.host", "127.0.0.1")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints and staged tables.

    Read from ``spark.checkpoint.dir``. An unset value is an error, since a
    machine-local folder does not survive the loss of that machine; tests set
    their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
