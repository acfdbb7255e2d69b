"""A7 table_write / A8 table_read: a named-table store over Parquet directories.

Names must match ``[A-Za-z_][A-Za-z0-9_]*`` (checked before any I/O); a write replaces the
table; reading a missing table raises ``StorageError``."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from domus import constants as C
from domus.errors import StorageError

_NAME = re.compile(C.TABLE_NAME_REGEX)


def safe_name(name: str) -> str:
    if not isinstance(name, str) or not _NAME.fullmatch(name) or "\n" in name:
        raise StorageError(f"{name!r} can't name a table")
    return name


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{safe_name(name)}"

    def write(self, name: str, df: DataFrame) -> None:
        """Create or replace ``name``."""
        df.write.mode("overwrite").parquet(self.path(name))

    def read(self, name: str) -> DataFrame:
        path = self.path(name)
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as exc:
            raise StorageError(f"table {name!r} can't be read: {exc}") from exc


def read_if_there(spark: SparkSession, path: str, schema: T.StructType, nested: bool = False) -> DataFrame | None:
    """A Parquet table, or None if its path does not exist; any other failure is raised, so that a table
    that can't be read is never taken for an empty one. ``nested``: its files may lie in folders of their own."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", nested).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
