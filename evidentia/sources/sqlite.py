"""Reader of SQLite evidence databases, a partition for each table."""

from __future__ import annotations

import json
import os
import sqlite3
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class SqliteSource(DataSource):
    """``spark.read.format("evidence_sqlite").option("path", ...)``: (table_name, row_json), tables in ``skip`` left out."""

    @classmethod
    def name(cls) -> str:
        return "evidence_sqlite"

    def schema(self) -> str:
        return "table_name string, row_json string"

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(self.options["path"], set(self.options.get("skip", "image_context").split(",")))


class TablePartition(InputPartition):
    def __init__(self, table: str):
        super().__init__(table)
        self.table = table


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, skip: set[str]):
        self.path, self.skip = path, skip

    def connect(self) -> sqlite3.Connection:
        if not os.path.exists(self.path):
            raise FileNotFoundError(self.path)
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)

    def partitions(self) -> list[TablePartition]:
        with self.connect() as db:
            names = [n for (n,) in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
        return [TablePartition(n) for n in names if n not in self.skip]

    def read(self, partition: TablePartition) -> Iterator[tuple[str, str]]:
        with self.connect() as db:
            db.row_factory = sqlite3.Row
            name = partition.table.replace('"', '""')
            for row in db.execute(f'SELECT * FROM "{name}"'):
                yield partition.table, json.dumps(dict(row), default=str)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SqliteSource)
