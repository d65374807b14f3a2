"""Changes made inside a database: staged rows, then one statement per table.

Spark computes what changes and stages it as a table of the database, written
by many tasks. What then touches the target is a single UPDATE or INSERT ...
SELECT per table, all in one transaction of one connection, so the database's
own locks and log make them visible together or not at all. No target row
leaves the database.

The staged list holds the old value too: a row is updated only if the target
still holds it, so a repeated run changes nothing and a value that was changed
meanwhile stays.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from idbridge.functions.keys import quoted
from idbridge.sources.readers import JdbcConnection

TEXT_TYPE = "VARCHAR(512)"  # of staged text; a longer value is an error of the database, never cut


@dataclass(frozen=True)
class Staged:
    """A staged table. ``read``: for every column, how a statement reads it from the table as ``s``."""

    table: str
    key: str
    read: dict[str, str]


@dataclass(frozen=True)
class StagedUpdate:
    """Rows ``key, old_<set_col>, new_<set_col>`` staged for ``table``."""

    table: str
    staged: Staged
    set_col: str

    def sql(self, name: Callable[[str], str]) -> str:
        key, col, read = name(self.staged.key), name(self.set_col), self.staged.read
        old, new = read[f"old_{self.set_col}"], read[f"new_{self.set_col}"]
        same = f"s.{key} = u.{key}"
        return (f"UPDATE {self.table} AS u SET {col} = (SELECT {new} FROM {self.staged.table} s WHERE {same}) "
                f"WHERE EXISTS (SELECT 1 FROM {self.staged.table} s WHERE {same} "
                f"AND (u.{col} = {old} OR (u.{col} IS NULL AND {old} IS NULL)))")


@dataclass(frozen=True)
class StagedInsert:
    """Staged rows that ``table`` does not hold yet, by the staged key."""

    table: str
    staged: Staged

    def sql(self, name: Callable[[str], str]) -> str:
        cols, key = ", ".join(map(name, self.staged.read)), name(self.staged.key)
        return (f"INSERT INTO {self.table} ({cols}) SELECT {', '.join(self.staged.read.values())} "
                f"FROM {self.staged.table} s WHERE NOT EXISTS (SELECT 1 FROM {self.table} t WHERE t.{key} = s.{key})")


class Database:
    """Statements over one JDBC connection, opened as Spark opens its own."""

    def __init__(self, spark: SparkSession, conn: JdbcConnection):
        self.spark, self.conn = spark, conn
        jvm = spark._jvm
        options = conn.options()
        url = options.pop("url")
        settings = jvm.java.util.HashMap()
        for k, v in options.items():
            settings.put(k, v)
        sql = jvm.org.apache.spark.sql
        self._options = sql.execution.datasources.jdbc.JDBCOptions(
            url, "unused", jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(settings))
        self._dialect = sql.jdbc.JdbcDialects.get(url)

    def name(self, column: str) -> str:
        """A column name quoted as the database does."""
        return self._dialect.quoteIdentifier(column)

    def run(self, statements: list[str]) -> list[int]:
        """Rows changed by each statement, in one transaction; an error in any undoes all."""
        connection = self._dialect.createConnectionFactory(self._options).apply(-1)
        try:
            connection.setAutoCommit(False)
            try:
                done = []
                for text in statements:
                    statement = connection.createStatement()
                    done.append(statement.executeUpdate(text))
                    statement.close()
                connection.commit()
                return done
            except Exception:
                connection.rollback()
                raise
        finally:
            connection.close()

    def stage(self, rows: DataFrame, table: str, key: str, *, max_connections: int = 8,
              text_type: str = TEXT_TYPE) -> Staged:
        """Write ``rows`` as ``table`` (overwritten), with a unique index on ``key``: the
        statements look rows up by it, and a key that repeats fails here, before
        anything is changed. Rows without a key are left out: no row equals them.

        A missing text is written as an empty one with a mark beside it, since not
        every database takes the untyped NULL that a text writer sends."""
        cols, kinds, read = [], [], {}
        for f in rows.schema.fields:
            c, read[f.name] = F.col(quoted(f.name)), f"s.{self.name(f.name)}"
            if not isinstance(f.dataType, T.StringType):
                cols.append(c)
                continue
            kinds.append(f"{quoted(f.name)} {text_type}")
            cols.append(F.coalesce(c, F.lit("")).alias(f.name))
            if f.name != key:
                mark = f"{f.name}_missing"
                while mark in rows.columns:
                    mark += "_"
                cols.append(c.isNull().cast("int").alias(mark))
                read[f.name] = f"CASE WHEN s.{self.name(mark)} = 0 THEN s.{self.name(f.name)} END"
        w = (rows.where(F.col(quoted(key)).isNotNull()).select(*cols).coalesce(max_connections)
             .write.format("jdbc").options(**self.conn.options())
             .option("dbtable", table).option("batchsize", "10000").mode("overwrite"))
        (w.option("createTableColumnTypes", ", ".join(kinds)) if kinds else w).save()
        self.run([f"CREATE UNIQUE INDEX {table.replace('.', '_')}_{key}_ix ON {table} ({self.name(key)})"])
        return Staged(table, key, read)

    def apply(self, changes: list[StagedUpdate | StagedInsert]) -> dict[str, int]:
        """All staged changes in one transaction: rows changed per table."""
        done = self.run([c.sql(self.name) for c in changes])
        return {c.table: n for c, n in zip(changes, done, strict=True)}
