"""Where the reconciled tables come from.

A job asks a ``Tables`` object for a logical table and the columns it
needs; the reader returns a lazy DataFrame, so Catalyst prunes columns and
pushes filters into the parquet scan or the JDBC ``SELECT``. Two sources
feeding one plan (users from one database, members from another) is just
two ``Tables`` objects.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F, types as T

from idbridge.functions.keys import quoted
from idbridge.sources import fixtures
from idbridge.sources.schemas import SCHEMAS, check_schema, check_target

# JDBC URL prefix and driver class per database kind.
JDBC_KINDS = {
    "postgres": ("jdbc:postgresql://{host}:{port}/{database}", "org.postgresql.Driver"),
    "mysql": ("jdbc:mysql://{host}:{port}/{database}", "com.mysql.cj.jdbc.Driver"),
    "mariadb": ("jdbc:mariadb://{host}:{port}/{database}", "org.mariadb.jdbc.Driver"),
    "derby": ("jdbc:derby:{database}", "org.apache.derby.iapi.jdbc.AutoloadedDriver"),
}


@dataclass
class JdbcConnection:
    """Connection settings for one database.

    ``password_env`` names an environment variable holding the password, so
    the secret never sits in code or config; it is resolved on the driver
    when options are built and must be set.
    """

    kind: str
    database: str
    host: str = "localhost"
    port: int | None = None
    user: str | None = None
    password_env: str | None = None
    url: str | None = None
    extra: dict = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        if self.kind not in JDBC_KINDS:
            raise ValueError(f"Unsupported database kind {self.kind!r}; use one of {sorted(JDBC_KINDS)}")
        template, driver = JDBC_KINDS[self.kind]
        opts = {"url": self.url or template.format(host=self.host, port=self.port, database=self.database),
                "driver": driver}
        if self.user:
            opts["user"] = self.user
        if self.password_env:
            secret = os.environ.get(self.password_env, "")
            if not secret:
                raise RuntimeError(f"environment variable {self.password_env} is not set")
            opts["password"] = secret
        opts.update({k: str(v) for k, v in self.extra.items()})
        return opts


@dataclass
class Partitioning:
    """Parallel JDBC read: ``num`` range slices of a numeric column."""

    column: str
    lower: int
    upper: int
    num: int


@dataclass
class KeyRanges:
    """Parallel JDBC read by a string key: one task per range between ``cuts``
    (ascending, compared as the database does). For ids of hex digits,
    ``KeyRanges.hex("id", 64)`` cuts the space evenly.

    ``column`` is written into the predicates as given, quoted by the caller
    where the database needs it. Every row falls into exactly one range: rows
    below the first cut and NULL keys into the first."""

    column: str
    cuts: list[str]

    @classmethod
    def hex(cls, column: str, num: int) -> "KeyRanges":
        digits = 1
        while 16 ** digits < num:
            digits += 1
        return cls(column, [f"{i * 16 ** digits // num:0{digits}x}" for i in range(1, num)])

    def predicates(self) -> list[str]:
        return range_predicates(self.column, sorted(set(self.cuts)))


@dataclass
class BalancedRanges:
    """Parallel JDBC read by a key whose values need not be known: one query to
    the database finds ``num - 1`` cuts with equally many rows between them.

    ``column`` is a number or a text, written into the statements as given. Each row falls
    into one range; NULL keys fall into the first. A single value is never cut."""

    column: str
    num: int

    def sql(self, kind: str, table: str) -> str:
        """The cuts: every n-th key in the database's order."""
        c, some = self.column, f"FROM {table} WHERE {self.column} IS NOT NULL"
        if kind == "derby":  # numbers an ordered subquery; has no ORDER BY inside OVER
            numbered = f"SELECT k, ROW_NUMBER() OVER () AS rn FROM (SELECT {c} AS k {some} ORDER BY {c}) o"
        else:
            numbered = f"SELECT {c} AS k, ROW_NUMBER() OVER (ORDER BY {c}) AS rn {some}"
        # rows before the i-th cut: i * n / num, so the ranges differ by one row at most
        total = f"(SELECT COUNT(*) {some})"
        return (f"SELECT k FROM ({numbered}) x WHERE rn > 1 AND "
                f"(rn - 1) * {self.num} / {total} <> (rn - 2) * {self.num} / {total}")

    def predicates(self, spark: SparkSession, conn: JdbcConnection, table: str) -> list[str]:
        sql = self.sql(conn.kind, table).replace(" / ", " DIV ") if conn.kind in ("mysql", "mariadb") else \
            self.sql(conn.kind, table)
        found = spark.read.format("jdbc").options(**conn.options()).option("dbtable", f"({sql}) q").load()
        text = isinstance(found.schema[0].dataType, T.StringType)
        cuts = [r[0] for r in found.collect()]  # num - 1 at most
        return range_predicates(self.column, cuts, text)


def range_predicates(column: str, cuts: list, text: bool = True) -> list[str]:
    """Ranges between ascending ``cuts``; repeated cuts count once."""
    q = (lambda v: "'" + v.replace("'", "''") + "'") if text else str
    cuts = list(dict.fromkeys(cuts))
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {q(a)} AND {column} < {q(b)}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [f"{column} < {q(cuts[0])} OR {column} IS NULL", *between, f"{column} >= {q(cuts[-1])}"]


class Tables:
    """Source of logical tables; subclasses say where they live."""

    def raw(self, spark: SparkSession, name: str) -> DataFrame:
        raise NotImplementedError

    def table(self, spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
        return check_schema(self.raw(spark, name), name, columns)

    def target(self, spark: SparkSession, name: str, needed: list[str]) -> DataFrame:
        """A table to be updated: all stored columns, with their types."""
        return check_target(self.raw(spark, name), name, needed)


class FixtureTables(Tables):
    """Tables derived from the TPC-H-style parquet files in ``sf_dir``.

    Each view is registered once per session as a temp view holding its
    checked, analysed plan and file listing; later reads are one catalog
    lookup instead of rebuilding the projection expression by expression.
    """

    def __init__(self, sf_dir: str):
        self.sf_dir = sf_dir.rstrip("/")

    def _view_name(self, name: str) -> str:
        digest = hashlib.sha1(self.sf_dir.encode()).hexdigest()[:10]
        return f"idbridge_fixture_{digest}_{name}"

    def raw(self, spark, name):
        return fixtures.VIEWS[name](spark, self.sf_dir)

    def table(self, spark, name, columns=None):
        view = self._view_name(name)
        if not spark.catalog.tableExists(view):
            check_schema(self.raw(spark, name), name).createOrReplaceTempView(view)
        df = spark.table(view)
        return df.select(*columns) if columns else df

    def target(self, spark, name, needed):
        return check_target(self.table(spark, name), name, needed)


class ParquetTables(Tables):
    """One parquet folder (or file) per table under ``root``.

    ``names`` maps a logical name to a different folder, e.g. a
    schema-qualified ``sales/tickets``.
    """

    def __init__(self, root: str, names: dict[str, str] | None = None, fmt: str = "parquet"):
        self.root, self.names, self.fmt = root.rstrip("/"), names or {}, fmt

    def raw(self, spark, name):
        return spark.read.format(self.fmt).load(f"{self.root}/{self.names.get(name, name)}")


class JdbcTables(Tables):
    """Tables read through Spark's JDBC source.

    ``names`` maps logical names to qualified database names
    (``{"tickets": "sales.tickets"}``); ``partitions`` says per table how it
    is read by many tasks at once: ``Partitioning`` for a numeric column,
    ``KeyRanges`` for a string key, ``BalancedRanges`` for either, with cuts that the
    database finds. A table may be asked for by either name.
    """

    def __init__(self, conn: JdbcConnection, names: dict[str, str] | None = None,
                 partitions: dict[str, Partitioning | KeyRanges | BalancedRanges] | None = None, fetch_size: int = 10000):
        self.conn, self.names = conn, names or {}
        self.partitions, self.fetch_size = partitions or {}, fetch_size
        self._found: dict[str, list[str]] = {}

    def _logical(self, name: str) -> str:
        return next((k for k, v in self.names.items() if v == name), name) if name not in self.names else name

    def _reader(self, spark: SparkSession, name: str):
        r = spark.read.format("jdbc").options(**self.conn.options())
        r = r.option("fetchsize", str(self.fetch_size))
        p = self.partitions.get(name)
        if isinstance(p, Partitioning):
            r = (r.option("partitionColumn", p.column).option("lowerBound", str(p.lower))
                  .option("upperBound", str(p.upper)).option("numPartitions", str(p.num)))
        return r

    def raw(self, spark, name):
        name = self._logical(name)
        p, table = self.partitions.get(name), self.names.get(name, name)
        if isinstance(p, (KeyRanges, BalancedRanges)):
            if isinstance(p, KeyRanges):
                ranges = p.predicates()
            else:  # found once per reader
                if name not in self._found:
                    self._found[name] = p.predicates(spark, self.conn, table)
                ranges = self._found[name]
            opts = {**self.conn.options(), "fetchsize": str(self.fetch_size)}
            return spark.read.jdbc(opts.pop("url"), table, predicates=ranges, properties=opts)
        return self._reader(spark, name).option("dbtable", table).load()

    def query(self, spark: SparkSession, sql: str, partition: Partitioning | None = None) -> DataFrame:
        """A relation defined by SQL text that runs inside the database.

        Wrapped as ``dbtable="(sql) q"`` rather than the ``query`` option,
        because only ``dbtable`` combines with a partitioned read.
        """
        r = spark.read.format("jdbc").options(**self.conn.options()).option("fetchsize", str(self.fetch_size))
        if partition is not None:
            r = (r.option("partitionColumn", partition.column).option("lowerBound", str(partition.lower))
                  .option("upperBound", str(partition.upper)).option("numPartitions", str(partition.num)))
        return r.option("dbtable", f"({sql}) q").load()


class CatalogTables(Tables):
    """Tables of a database through Spark's JDBC catalog, which lets the database
    do what it can: filters, DISTINCT, GROUP BY with counts, limits and, where
    Spark knows the database to take them, joins. Jobs need no other plan for it.

    ``schema`` holds names without a schema of their own; ``names`` maps logical
    names as in ``JdbcTables``. Stored names are matched without regard to case.
    A table is read by one task; give very large ones to ``JdbcTables``. The
    session's settings hold the connection, its password included.
    """

    def __init__(self, conn: JdbcConnection, schema: str, names: dict[str, str] | None = None):
        self.conn, self.schema, self.names = conn, schema, names or {}

    def catalog(self, spark: SparkSession) -> str:
        """The name of the session's catalog for this connection, registered if need be."""
        options = {**self.conn.options(), "preferTimestampNTZ": "true",
                   **{f"pushDown{what}": "true" for what in ("Aggregate", "Limit", "Offset", "TableSample", "Join")}}
        name = "idbridge_" + hashlib.sha1(repr(sorted(options.items())).encode()).hexdigest()[:10]
        key = f"spark.sql.catalog.{name}"
        if spark.conf.get(key, None) is None:
            for k, v in options.items():
                spark.conf.set(f"{key}.{k}", v)
            spark.conf.set(key, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
        return name

    def raw(self, spark, name):
        stored = self.names.get(name, name)
        parts = stored.split(".") if "." in stored else [self.schema, stored]
        df = spark.table(".".join(quoted(p) for p in (self.catalog(spark), *parts)))
        logical = {c.lower(): c for c in SCHEMAS[name].fieldNames()} if name in SCHEMAS else {}
        return df.select(*[F.col(quoted(c)).alias(logical.get(c.lower(), c)) for c in df.columns])
