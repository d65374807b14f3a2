"""Intermediate tables in the folder that all executors and the driver share.

Operators cut lineage by writing a table here and reading it back, so a lost
executor costs the tasks it was running, not the stages before them.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a scratch folder of this
    machine only where it is unset in a local session (tests). On a cluster it must be set."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-store-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


class Store:
    """Named tables of one run, in a folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def put(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write ``df`` as Parquet and return the table read back."""
        self._n += 1
        path = f"{self.path}/{self._n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stored_at = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for df in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, which need not
    share the driver's folders or PYTHONPATH; once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_idbridge_shipped", None) != sc.applicationId:
        root = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="idbridge-")) / "idbridge.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(target))
        sc._idbridge_shipped = sc.applicationId


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Before a Python stage: ship the code and bound the Arrow batches. Texts
    may be long, so a batch is limited by rows and by bytes. Only lowers the
    session's settings; results do not depend on them."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def likely_rows(df: DataFrame, column: str, wanted: DataFrame, key: str, bits: int = 22,
                likely: bool = True) -> DataFrame:
    """``df`` without most of the rows whose ``column`` is not in ``wanted[key]``
    (``likely=False``: exactly the rows left out otherwise).

    A bit map of 2**bits hashed keys is broadcast as at most 2**bits / 64 rows
    (1 MB at any size of the input), so texts that no later join needs are not
    shuffled. It never loses a wanted row; the fuller it is, the more others
    pass, and the join behind it decides."""
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    word, at = F.floor(F.col("__s") / 64), F.expr("cast(__s % 64 as int)")
    table = (wanted.select(slot(F.col(key)).alias("__s")).groupBy(word.alias("__w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(__s % 64 as int)))").alias("__b")))
    own = [F.col(f"`{c}`") for c in df.columns]
    return (df.withColumn("__s", slot(F.col(column))).withColumn("__w", word)
            .join(F.broadcast(table), "__w", "inner" if likely else "left")
            .where(F.coalesce(F.call_function("bit_get", F.col("__b"), at), F.lit(0)) == int(likely)).select(*own))


def held_out(doc_id) -> "F.Column":
    """The rows kept from learning: crc32(doc_id as text) mod 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
