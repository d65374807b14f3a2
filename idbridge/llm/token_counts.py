"""Token totals by source, language and tokenizer, kept up to date by batches.

Two tables of the session's catalog, both partitioned by batch:

- the ledger: what a batch says of a document under a tokenizer (documents,
  tokens and characters, or nothing after a delete), by its source and language;
- the deltas: the batch's signed sums, one row per source, language and
  tokenizer: what its documents counted for before, taken off, and what they
  count for now.

Totals are the sum of all deltas. A batch overwrites its own partitions and
counts against the batches before it, so committing one again, after a failure or by
mistake, changes nothing. A batch that comes late, or says something else than
before, changes what later batches count against: their deltas are made anew,
all of them, so a run that was cut short is mended by the next try. The totals
are those of all batches replayed in the order of their numbers, whatever
order they came in.

What a batch touches is looked for first, by a semi join of the ledger's keys;
only those rows are aggregated and joined. Sums are made on the map side first.

Defined results: a change replaces all that earlier batches said of its
doc_id under its tokenizer; several rows of one doc_id in a batch add up; a
null doc_id, source, language or tokenizer is a value of its own; a null count is 0;
deleting what is not there changes nothing; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ("source", "lang", "tokenizer")
SUMS = ("docs", "tokens", "chars")


class TokenRollup:
    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.ledger, self.deltas = spark, f"{name}_ledger", f"{name}_deltas"
        if not spark.catalog.tableExists(self.deltas):
            spark.sql(f"""CREATE TABLE {self.ledger} (doc_id BIGINT, source STRING, lang STRING, tokenizer STRING,
                          docs BIGINT, tokens BIGINT, chars BIGINT, batch BIGINT) USING parquet PARTITIONED BY (batch)""")
            spark.sql(f"""CREATE TABLE {self.deltas} (source STRING, lang STRING, tokenizer STRING,
                          docs BIGINT, tokens BIGINT, chars BIGINT, batch BIGINT) USING parquet PARTITIONED BY (batch)""")

    def drop(self) -> None:
        for table in (self.deltas, self.ledger):
            self.spark.sql(f"DROP TABLE {table}")

    def _write(self, df: DataFrame, table: str, batch: int) -> None:
        """Replace the batch's partition, also by nothing."""
        cols = [c for c in self.spark.table(table).columns if c != "batch"]
        df.select(cols).createOrReplaceTempView(f"{table}_new")
        self.spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch = {batch}) SELECT * FROM {table}_new")
        self.spark.catalog.dropTempView(f"{table}_new")

    def _said(self, batch: int) -> DataFrame:
        return self.spark.table(self.ledger).where(F.col("batch") == batch)

    @staticmethod
    def _of(rows: DataFrame, keys: DataFrame) -> DataFrame:
        """The rows of the documents and tokenizers in ``keys``, null ones too."""
        k = keys.select(F.col("doc_id").alias("d"), F.col("tokenizer").alias("t")).distinct()
        return rows.join(k, rows.doc_id.eqNullSafe(k.d) & rows.tokenizer.eqNullSafe(k.t), "left_semi")

    def before(self, batch: int) -> DataFrame:
        """What the batches before ``batch`` left of the documents that it names."""
        said = self._of(self.spark.table(self.ledger).where(F.col("batch") < batch), self._said(batch))
        last = said.groupBy("doc_id", "tokenizer").agg(F.max("batch").alias("last")).toDF("d", "t", "last")
        return said.join(last, said.doc_id.eqNullSafe(last.d) & said.tokenizer.eqNullSafe(last.t)
                         & (said.batch == last.last)).drop("d", "t", "last")

    def _later(self, batch: int) -> list[int]:
        """Batches booked after ``batch``: one number per partition of the ledger."""
        names = [r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.ledger}").collect()]
        return sorted(n for n in (int(x.split("=")[1]) for x in names) if n > batch)

    def _book(self, batch: int) -> None:
        """The batch's deltas, from what it says and what was said before."""
        old = self.before(batch).select(*KEY, *[(-F.col(c)).alias(c) for c in SUMS])
        signed = self._said(batch).select(*KEY, *SUMS).unionAll(old)
        sums = signed.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in SUMS])
        self._write(sums.where(" or ".join(f"{c} != 0" for c in SUMS)), self.deltas, batch)

    def commit(self, batch: int, changes: DataFrame) -> None:
        """``changes`` (op: insert, revise or delete, doc_id, source, lang,
        tokenizer, tokens, chars) as batch number ``batch``."""
        gone = F.col("op") == "delete"
        rows = changes.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in KEY],
            F.when(gone, 0).otherwise(1).cast("bigint").alias("docs"),
            *[F.when(gone, 0).otherwise(F.coalesce(F.col(c).cast("bigint"), F.lit(0))).alias(c) for c in SUMS[1:]])
        rows = rows.groupBy("doc_id", *KEY).agg(*[F.sum(c).alias(c) for c in SUMS])
        self._write(rows, self.ledger, batch)
        for n in [batch, *self._later(batch)]:
            self._book(n)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens, chars over all batches."""
        return (self.spark.table(self.deltas).groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in SUMS])
                .where("docs != 0"))
