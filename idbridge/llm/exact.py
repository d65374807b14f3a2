"""Exact duplicates through a persistent digest index.

The index is a table bucketed and sorted by digest, partitioned by batch.
New rows are reduced to one row per digest, checked against the index by a
sort-merge anti join that reads the index without shuffling it, and the
digests it lacks are appended. DataFrame functions only.

Defined results: a null text is an empty one; a null doc_id takes part but is
the smallest id only of a group that has no other; repeated rows are rows of
one group; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Store


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(F.encode(normalised(text), "UTF-8"), 256))


class DigestIndex:
    """``digest -> keep_id`` of every text ever added.

    ``name``: a table of the session's catalog; created when missing.
    ``buckets``: files per batch; about one per 10 million expected digests,
    and at least the parallelism wanted for the join. A batch is a partition
    of the table: adding it again first overwrites what an earlier, perhaps
    half-done, attempt wrote, and gives the same result."""

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None):
        self.spark, self.name = spark, name
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE {name} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
                      f"PARTITIONED BY (batch) CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE {self.name}")

    def _register(self, docs: DataFrame, batch: str, store: Store) -> tuple[DataFrame, DataFrame]:
        """Rows (doc_id, digest) of ``docs``, and for each of their digests:
        first_id and group_size in the batch, keep_id, seen."""
        rows = store.put(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                     digest(F.col("text")).alias("digest")), "digests")
        groups = store.put(rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"),
                                                      F.count(F.lit(1)).alias("group_size")), "groups")
        before = self.rows().where(F.col("batch") != batch).select("digest")
        fresh = (groups.hint("merge").join(before.hint("merge"), "digest", "left_anti")
                 .select("digest", F.col("first_id").alias("keep_id"), F.lit(batch).alias("batch")))
        self._append(fresh)
        now = self.rows().select("digest", "keep_id", (F.col("batch") != batch).alias("seen"))
        known = groups.hint("merge").join(now.hint("merge"), "digest")
        return rows, store.put(known.select("digest", "keep_id", "group_size", "seen"), "known")

    def add(self, docs: DataFrame, batch: str, store: Store) -> DataFrame:
        """Add the rows of ``docs`` (doc_id, text) as ``batch``. Returns one
        row per row: doc_id, digest, keep_id (the first indexed row of equal
        text; within a batch the smallest doc_id), group_size (equal rows in
        this batch), seen (the text was in the index before this batch)."""
        rows, known = self._register(docs, batch, store)
        # both sides are shuffled here, so adaptive execution can split the rows of a hot digest
        return rows.join(known, "digest")

    def keep_new(self, docs: DataFrame, batch: str, store: Store) -> DataFrame:
        """Add ``docs`` and return those of its rows that stay, with their
        columns: one row of each text that the index lacked, the one with the
        smallest doc_id (any one of rows that repeat it)."""
        _, known = self._register(docs, batch, store)
        stay = known.where(~F.col("seen")).select(F.col("digest").alias("__own"), F.col("keep_id").alias("__keep"))
        # the join key holds the doc_id, so copies of a hot text spread over all tasks
        mark, own = "__digest", docs.columns
        return (docs.withColumn(mark, digest(F.col("text")))
                .join(stay, (F.col(mark) == F.col("__own"))
                      & F.col("doc_id").cast("bigint").eqNullSafe(F.col("__keep")), "left_semi")
                .dropDuplicates([mark, "doc_id"]).select(*[F.col(f"`{c}`") for c in own]))

    def _append(self, fresh: DataFrame) -> None:
        key = "spark.sql.sources.partitionOverwriteMode"
        mode = self.spark.conf.get(key)
        self.spark.conf.set(key, "dynamic")
        try:
            fresh.repartition(self.buckets, "digest").write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(key, mode)
