"""Writing results: copy-on-write table versions, JDBC appends, lineage cuts.

A repair touching several tables is published as one unit: every new table
version is written to its own new folder first, and a small manifest naming
all of them is written last. Readers follow the manifest, so a failure
part-way leaves the previous versions in force.
"""

from __future__ import annotations

import json
import uuid as _uuid

from pyspark.sql import DataFrame, SparkSession

from idbridge.session import checkpoint_dir
from idbridge.sources.readers import JdbcConnection


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``.

    Used when one result feeds two sinks (a random id must be drawn once) or
    when a long plan should not be recomputed after an executor is lost.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "errorifexists",
                partition_by: list[str] | None = None) -> str:
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_jdbc(df: DataFrame, conn: JdbcConnection, table: str, *, mode: str = "append",
               max_connections: int | None = None, batch_size: int = 10000) -> None:
    """Append (INSERT) or overwrite a database table.

    Each partition opens one connection; ``max_connections`` caps them by
    coalescing partitions (no shuffle) so the database is not flooded.
    """
    out = df.coalesce(max_connections) if max_connections else df
    (out.write.format("jdbc").options(**conn.options())
        .option("dbtable", table).option("batchsize", str(batch_size)).mode(mode).save())


def published(spark: SparkSession, root: str, run_id: str) -> bool:
    """Whether the manifest of ``run_id``, written last, is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_manifests/run={run_id}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, *,
            run_id: str | None = None, fmt: str = "parquet") -> dict[str, str]:
    """Write each table to ``root/<name>/run=<run_id>``, then the manifest.

    A version named by a manifest is never overwritten; files of a run that
    failed before its manifest are."""
    run_id = run_id or _uuid.uuid4().hex
    root = root.rstrip("/")
    if published(spark, root, run_id):
        raise ValueError(f"run {run_id} is published in {root}")
    paths = {name: write_table(df, f"{root}/{name}/run={run_id}", fmt=fmt, mode="overwrite")
             for name, df in tables.items()}
    manifest = spark.createDataFrame([(run_id, json.dumps(paths))], "run_id string, tables string")
    manifest.coalesce(1).write.mode("overwrite").json(f"{root}/_manifests/run={run_id}")
    return paths


def read_published(spark: SparkSession, root: str, run_id: str, name: str, fmt: str = "parquet") -> DataFrame:
    m = spark.read.json(f"{root.rstrip('/')}/_manifests/run={run_id}").first()
    return spark.read.format(fmt).load(json.loads(m["tables"])[name])
