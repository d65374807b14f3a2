"""Totals kept up to date from batches of inserted and deleted rows.

A batch adds, per key, the measures of its inserted rows less those of its
deleted ones; a change of a row is a deletion and an insertion. Sums do not
depend on the order of batches, so late batches count as well. A batch is a
folder of its own: committing it again replaces what it said, and a
version that was not written to the end does not count. The totals are one
partial aggregate over the batches' rows, however large the tables are that
they came from; ``compact`` folds batches into one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from idbridge.functions.keys import quoted


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _names(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


@dataclass
class Ledger:
    """Signed totals per ``keys`` in the folder ``root``. ``measures``: name ->
    expression over a row; all are whole numbers. NULL is a key like any other."""

    spark: SparkSession
    root: str
    keys: dict[str, Column]
    measures: dict[str, Column] = field(default_factory=lambda: {"n": F.lit(1)})

    def _signed(self, rows: DataFrame, sign: int) -> DataFrame:
        return rows.select(*[e.alias(k) for k, e in self.keys.items()],
                           *[(e.cast("long") * sign).alias(m) for m, e in self.measures.items()])

    def _summed(self, rows: DataFrame) -> DataFrame:
        sums = rows.groupBy(*[quoted(k) for k in self.keys]).agg(*[F.sum(quoted(m)).alias(m) for m in self.measures])
        some = F.lit(False)
        for m in self.measures:
            some = some | (F.col(quoted(m)) != 0)
        return sums.where(some)

    def _folded(self) -> tuple[str | None, set[str]]:
        """The newest fold and the batches that it holds."""
        for fold in reversed(_names(self.spark, f"{self.root}/folds")):
            if _exists(self.spark, f"{self.root}/folds/{fold}/batches/_SUCCESS"):
                held = self.spark.read.json(f"{self.root}/folds/{fold}/batches").first()["ids"]
                return f"{self.root}/folds/{fold}/totals", set(json.loads(held))
        return None, set()

    def _open(self) -> dict[str, str]:
        """Batch -> folder of its last complete version, for batches not folded yet."""
        _, held = self._folded()
        out = {}
        for batch in _names(self.spark, f"{self.root}/batches"):
            path = f"{self.root}/batches/{batch}"
            done = [v for v in _names(self.spark, path) if _exists(self.spark, f"{path}/{v}/_SUCCESS")]
            if done and batch not in held:
                out[batch] = f"{path}/{done[-1]}"
        return out

    def commit(self, batch_id: str | int, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> bool:
        """Book one batch; again: in place of what it said before. A batch that
        is folded is closed: booking it again changes nothing and returns False."""
        name = f"batch={batch_id}"
        if name in self._folded()[1]:
            return False
        sides = [self._signed(rows, sign) for rows, sign in ((inserted, 1), (deleted, -1)) if rows is not None]
        if not sides:
            raise ValueError("a batch needs inserted or deleted rows")
        rows = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
        path = f"{self.root}/batches/{name}"
        nth = 1 + max((int(v[1:9]) for v in _names(self.spark, path)), default=0)
        self._summed(rows).write.parquet(f"{path}/v{nth:08d}-{uuid.uuid4().hex[:8]}")
        return True

    def totals(self) -> DataFrame:
        """Keys with a total other than zero, and their totals."""
        base, _ = self._folded()
        paths = [*([base] if base else []), *self._open().values()]
        if not paths:
            raise ValueError(f"no batch in {self.root}")
        return self._summed(self.spark.read.parquet(*paths))

    def compact(self) -> None:
        """Fold all open batches into one table; they are closed from then on."""
        base, held = self._folded()
        batches = self._open()
        if not batches:
            return
        nth = 1 + max((int(f[1:9]) for f in _names(self.spark, f"{self.root}/folds")), default=0)
        path = f"{self.root}/folds/f{nth:08d}-{uuid.uuid4().hex[:8]}"
        paths = [*([base] if base else []), *batches.values()]
        self._summed(self.spark.read.parquet(*paths)).write.parquet(f"{path}/totals")
        ids = json.dumps(sorted(held | set(batches)))
        self.spark.createDataFrame([(ids,)], "ids string").coalesce(1).write.json(f"{path}/batches")
