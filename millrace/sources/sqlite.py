"""A Python data source for SQLite files: read-only, split by ranges of a text or integer key.

Options: path, table (or query, which then is one partition), key, splits, schema. Every partition opens the file read-only and immutable on
its executor, so the file must be reachable there.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Read settings.
PRAGMAS = ("PRAGMA query_only = 1", "PRAGMA mmap_size = 1073741824", "PRAGMA cache_size = -262144")


def _open(path: str) -> sqlite3.Connection:
    con = sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True, timeout=300)
    for p in PRAGMAS:
        con.execute(p)
    return con


def _quoted(name: str) -> str:
    """A name as an SQL identifier."""
    return '"' + name.replace('"', '""') + '"'


class _Range(InputPartition):
    def __init__(self, low, high):
        super().__init__((low, high))


class _Reader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.names, self.options = [f.name for f in schema.fields], options

    def partitions(self) -> list[InputPartition]:
        key, splits = self.options.get("key"), int(self.options.get("splits", 1))
        if not key or splits < 2:
            return [_Range(None, None)]
        con = _open(self.options["path"])
        name, table = _quoted(key), _quoted(self.options["table"])
        tiles = f"SELECT {name} AS k, ntile(?) OVER (ORDER BY {name}) AS t FROM (SELECT DISTINCT {name} FROM {table} WHERE {name} IS NOT NULL)"
        steps = con.execute(f"SELECT min(k) FROM ({tiles}) GROUP BY t ORDER BY t", (splits,)).fetchall()[1:]
        con.close()
        bounds = [None, *(s[0] for s in steps), None]
        return [_Range(a, b) for a, b in zip(bounds, bounds[1:], strict=False)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        low, high = partition.value
        key = _quoted(self.options.get("key") or "")
        source = f"({self.options['query']})" if "query" in self.options else _quoted(self.options["table"])
        where, values = [], []
        if low is not None:
            where.append(f"{key} >= ?")
            values.append(low)
        if high is not None:
            where.append(f"{key} < ?" if low is not None else f"({key} < ? OR {key} IS NULL)")
            values.append(high)
        sql = f"SELECT {', '.join(map(_quoted, self.names))} FROM {source}" + (" WHERE " + " AND ".join(where) if where else "")
        con = _open(self.options["path"])
        try:
            yield from con.execute(sql, values)
        finally:
            con.close()


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema) -> DataSourceReader:
        return _Reader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    from millrace.shipping import ship

    ship(spark)
    spark.dataSource.register(SqliteSource)


def read_sqlite(spark: SparkSession, path: str, table: str, schema: str, key: str | None = None, splits: int = 1):
    register(spark)
    reader = spark.read.format("sqlite").option("path", path).option("table", table).option("schema", schema)
    if key:
        reader = reader.option("key", key).option("splits", splits)
    return reader.load()
