"""Relational databases as a source and a sink, by JDBC."""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession

from lamina.operators.ids import numbered
from lamina.operators.latest import distinct_content
from lamina.sources.tables import Tables

#: How often a statement is tried that other writers' rows conflict with.
ATTEMPTS = 20

#: Column types where a text of any length would not do: those that are compared.
COMPARED = {"hash_key": "VARCHAR(128)", "pipeline_run_id": "VARCHAR(128)"}


def jdbc_url(url: str) -> tuple[str, dict[str, str]]:
    """The JDBC address and the user and password of a database URL; a JDBC address stays as it is."""
    url = url.strip()
    if url.startswith("jdbc:"):
        return url, {}
    parts = urlsplit(url)
    scheme = {"postgres": "postgresql"}.get(parts.scheme, parts.scheme)
    who = {k: unquote(v) for k, v in (("user", parts.username), ("password", parts.password)) if v}
    host = parts.hostname + (f":{parts.port}" if parts.port else "")
    return f"jdbc:{scheme}://{host}{parts.path}" + (f"?{parts.query}" if parts.query else ""), who


def url_from_environment() -> str:
    """DATABASE_URL, or an address of PGUSER, PGPASSWORD, PGHOST, PGPORT and PGDATABASE."""
    if url := (os.environ.get("DATABASE_URL") or "").strip():
        return url
    part = lambda name, default: os.environ.get(name, default)
    return f"postgresql://{part('PGUSER', 'postgres')}:{part('PGPASSWORD', 'postgres')}@{part('PGHOST', 'localhost')}:{part('PGPORT', '5432')}/{part('PGDATABASE', 'pipeline')}"


@dataclass
class Database:
    """Tables of a database, by schema and name. rows_per_task: how many rows of a numbered table one task reads."""

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    batch_size: int = 500
    rows_per_task: int = 1_000_000
    number: str = "bronze_row_id"

    @classmethod
    def from_environment(cls, spark: SparkSession) -> "Database":
        """The database of url_from_environment(); BATCH_SIZE rows are sent at a time."""
        url, properties = jdbc_url(url_from_environment())
        return cls(spark, url, properties, int(os.environ.get("BATCH_SIZE", "500")))

    @staticmethod
    def quoted(*names: str) -> str:
        return ".".join('"' + n.replace('"', '""') + '"' for n in names)

    def _connection(self):
        jvm = self.spark._jvm
        if driver := self.properties.get("driver"):
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
        given = jvm.java.util.Properties()
        for k, v in self.properties.items():
            given.setProperty(k, v)
        return jvm.java.sql.DriverManager.getConnection(self.url, given)

    def run(self, sql: str) -> int:
        """Runs one statement in a transaction of its own; the rows that it changed."""
        connection = self._connection()
        try:
            return connection.createStatement().executeUpdate(sql)
        finally:
            connection.close()

    def _until_free(self, sql: str) -> int:
        """Runs a statement again while another writer's rows conflict with it (SQL states of classes 23 and 40)."""
        for left in range(ATTEMPTS - 1, -1, -1):
            try:
                return self.run(sql)
            except Py4JJavaError as e:
                state = getattr(e.java_exception, "getSQLState", lambda: None)() or ""
                if not left or state[:2] not in ("23", "40"):
                    raise
        raise AssertionError

    def _found(self, table: str | None, layer: str) -> list[str]:
        connection = self._connection()
        try:
            rows, out = connection.getMetaData().getTables(None, layer, table or "%", None), []
            while rows.next():
                out.append(rows.getString("TABLE_NAME"))
            return sorted(out)
        finally:
            connection.close()

    def exists(self, layer: str, table: str) -> bool:
        return table in self._found(table.replace("_", "\\_") if "postgres" in self.url else None, layer)

    def list(self, layer: str) -> list[str]:
        return self._found(None, layer)

    def read(self, layer: str, table: str) -> DataFrame:
        """The table, by as many queries over ranges of its row numbers as it has rows for."""
        name, properties = self.quoted(layer, table), dict(self.properties)
        plain = self.spark.read.jdbc(self.url, name, properties=properties)
        if self.number not in plain.columns:
            return plain
        number = self.quoted(self.number)
        bounds = self.spark.read.jdbc(self.url, f"(SELECT min({number}) AS low, max({number}) AS high FROM {name}) bounds", properties=properties).toDF("low", "high").first()
        tasks = -(-(int(bounds.high) - int(bounds.low) + 1) // self.rows_per_task) if bounds.high is not None else 1
        if tasks < 2:
            return plain
        return self.spark.read.jdbc(self.url, name, column=number, lowerBound=int(bounds.low), upperBound=int(bounds.high) + 1, numPartitions=tasks, properties=properties)

    def _create(self, layer: str, table: str, df: DataFrame) -> None:
        types = {n: t for n, t in COMPARED.items() if n in df.columns}
        writer = df.limit(0).write.option("createTableColumnTypes", ", ".join(f"{n} {t}" for n, t in types.items())) if types else df.limit(0).write
        writer.mode("append").jdbc(self.url, self.quoted(layer, table), properties=dict(self.properties))

    def _constrain(self, layer: str, table: str, columns: list[str]) -> None:
        """Hashes and row numbers are unique by the database's own word, whoever writes. Null hashes are no conflict."""
        for c in ("hash_key", self.number):
            if c in columns:
                self.run(f"ALTER TABLE {self.quoted(layer, table)} ADD CONSTRAINT {self.quoted(f'{table}_{c}_once')} UNIQUE ({self.quoted(c)})")

    def append_new(self, layer: str, table: str, rows: DataFrame, order: Sequence[Column], number: str = "bronze_row_id", hash_col: str = "hash_key", drop: Sequence[str] = (), row: str | None = None) -> int:
        """Adds the rows of new content, of equal content the first in the order; how many. The database numbers them on from its greatest number."""
        delta = numbered(distinct_content(rows, hash_col, order), order, number).drop(*drop, *[row] if row else [])
        return self.append(layer, table, delta.select(number, *[c for c in delta.columns if c != number]), counted=number)

    def append(self, layer: str, table: str, df: DataFrame, batch: tuple[str, int] | None = None, counted: str | None = None) -> int:
        """Adds rows but those whose hash the table holds; how many were added.

        Tasks write to a table beside the target, batch_size rows at a time, and one statement moves its rows over. So a task
        that is run again, or a run that fails half way, leaves no part of the rows and none of them twice. Against other writers stand unique constraints: a conflicting
        hash is left out, or, where the database has no such clause, the statement is run again and then sees what has come between.

        batch: a stream and the number of its batch, which is not added again once rows carry its name as their run. counted: a column of numbers from 1 on,
        to which the table's greatest one is added.
        """
        if not self.layer_exists(layer):
            self.run(f"CREATE SCHEMA {self.quoted(layer)}")
        if not self.exists(layer, table):
            try:
                self._create(layer, table, df)
                self._constrain(layer, table, df.columns)
            except Exception:  # of two writers that find no table one makes it
                if not self.exists(layer, table):
                    raise
        aside = f"{table}_{uuid.uuid4().hex[:12]}"
        target, source = self.quoted(layer, table), self.quoted(layer, aside)
        try:
            self._create(layer, aside, df)
            df.write.mode("append").option("batchsize", self.batch_size).jdbc(self.url, source, properties=dict(self.properties))
            columns, where, ignore = ", ".join(map(self.quoted, df.columns)), [], ""
            if "hash_key" in df.columns:
                key = self.quoted("hash_key")
                where.append(f"(s.{key} IS NULL OR NOT EXISTS (SELECT 1 FROM {target} t WHERE t.{key} = s.{key}))")
                ignore = f" ON CONFLICT ({key}) DO NOTHING" if self.url.startswith("jdbc:postgresql") else ""
            if batch and "pipeline_run_id" in df.columns:
                run = self.quoted("pipeline_run_id")
                where.append(f"NOT EXISTS (SELECT 1 FROM {target} t WHERE t.{run} = '{batch[0]}-{batch[1]}')")
            values = [f"s.{self.quoted(c)}" + f" + (SELECT coalesce(max({self.quoted(c)}), 0) FROM {target})" * (c == counted) for c in df.columns]
            return self._until_free(f"INSERT INTO {target} ({columns}) SELECT {', '.join(values)} FROM {source} s" + " WHERE " * bool(where) + " AND ".join(where) + ignore)
        finally:
            if self.exists(layer, aside):
                self.run(f"DROP TABLE {source}")

    def layer_exists(self, layer: str) -> bool:
        connection = self._connection()
        try:
            rows = connection.getMetaData().getSchemas()
            while rows.next():
                if rows.getString("TABLE_SCHEM") == layer:
                    return True
            return False
        finally:
            connection.close()


@dataclass
class Layers:
    """Tables whose layers lie in different places; those that `places` lacks are in `rest`."""

    rest: Tables
    places: Mapping[str, Tables | Database]

    @property
    def spark(self) -> SparkSession:
        return self.rest.spark

    def _of(self, layer: str):
        return self.places.get(layer, self.rest)

    def exists(self, layer: str, table: str) -> bool:
        return self._of(layer).exists(layer, table)

    def list(self, layer: str) -> list[str]:
        return self._of(layer).list(layer)

    def read(self, layer: str, table: str) -> DataFrame:
        return self._of(layer).read(layer, table)

    def append(self, layer: str, table: str, df: DataFrame, batch: tuple[str, int] | None = None) -> int | None:
        return self._of(layer).append(layer, table, df, batch)

    def append_new(self, layer: str, table: str, rows: DataFrame, order: Sequence[Column], **names) -> int:
        return self._of(layer).append_new(layer, table, rows, order, **names)

    def replace(self, layer: str, table: str, df: DataFrame, check=None) -> DataFrame:
        return self._of(layer).replace(layer, table, df, check)

    def drop(self, layer: str, table: str) -> None:
        self._of(layer).drop(layer, table)

