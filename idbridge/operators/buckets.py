"""Tables kept in buckets of their key, so that an update rewrites only what it changes.

A table lies in ``root/<name>/run=<id>/<bucket column>=<k>`` folders, one per
bucket of ``xxhash64(key)``. A layout names the folder of every bucket. An update
is planned on the whole table, of which only the key, the matched column and the
column to be set are read; the buckets in which a row changes are then read in
full, updated by the same plan and written under a new run. The new layout
takes those folders and keeps all others: files of other buckets are neither
read in full nor written. A manifest with the layouts of all tables of a
repair is written last, so readers see all of it or none.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from idbridge.functions.keys import quoted
from idbridge.operators.apply import UpdatePlan


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


@dataclass(frozen=True)
class Layout:
    """Where the buckets of one version of a table lie."""

    name: str
    key: str
    buckets: int
    schema: str            # JSON of the stored columns
    paths: dict[int, str]  # bucket -> folder; buckets without rows have none

    def bucket(self, key: Column | None = None) -> Column:
        c = F.col(quoted(self.key)) if key is None else key
        return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession, only: list[int] | None = None) -> DataFrame:
        """The table, or its buckets ``only``."""
        schema = T.StructType.fromJson(json.loads(self.schema))
        paths = [p for b, p in sorted(self.paths.items()) if only is None or b in set(only)]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _write(spark: SparkSession, df: DataFrame, layout: Layout, root: str, run_id: str) -> dict[int, str]:
    column = "bucket"
    while column.lower() in {c.lower() for c in df.columns}:
        column += "_"
    path = f"{root.rstrip('/')}/{layout.name}/run={run_id}"
    (df.withColumn(column, layout.bucket()).repartition(layout.buckets, column)
     .write.mode("overwrite").partitionBy(column).parquet(path))
    return {int(f.rsplit("=", 1)[1]): f"{path}/{f}" for f in _folders(spark, path) if f.startswith(f"{column}=")}


def store_in_buckets(df: DataFrame, root: str, name: str, key: str, buckets: int, run_id: str) -> Layout:
    """Write ``df`` as the first version of a table in buckets."""
    layout = Layout(name, key, buckets, df.schema.json(), {})
    return Layout(name, key, buckets, layout.schema, _write(df.sparkSession, df, layout, root, run_id))


def rewrite_changed(spark: SparkSession, layout: Layout, plan_of: Callable[[DataFrame], UpdatePlan], root: str,
                    run_id: str) -> Layout:
    """The layout after the update that ``plan_of`` plans for any rows of the
    table. What a row becomes must depend on that row and on other tables only."""
    changes = plan_of(layout.read(spark)).changes
    touched = [r.b for r in changes.select(layout.bucket().alias("b")).distinct().collect()]  # one number per bucket
    if not touched:
        return layout
    new = _write(spark, plan_of(layout.read(spark, touched)).table, layout, root, run_id)
    return Layout(layout.name, layout.key, layout.buckets, layout.schema, {**layout.paths, **new})


def publish_layouts(spark: SparkSession, layouts: list[Layout], root: str, run_id: str) -> None:
    """The manifest of a version: the layouts of all its tables, written at once."""
    rows = [(x.name, x.key, x.buckets, x.schema, json.dumps(x.paths)) for x in layouts]
    df = spark.createDataFrame(rows, "name string, key string, buckets int, schema string, paths string")
    df.coalesce(1).write.mode("errorifexists").json(f"{root.rstrip('/')}/_layouts/run={run_id}")


def read_layouts(spark: SparkSession, root: str, run_id: str) -> dict[str, Layout]:
    rows = spark.read.json(f"{root.rstrip('/')}/_layouts/run={run_id}").collect()  # one row per table
    return {r["name"]: Layout(r["name"], r["key"], int(r["buckets"]), r["schema"],
                              {int(k): v for k, v in json.loads(r["paths"]).items()}) for r in rows}
