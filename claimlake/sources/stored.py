"""The source tables of a claims warehouse as stored sets."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from claimlake.operators.heavy import key_counts
from claimlake.operators.joins import HEAVY_ROWS
from claimlake.schemas import DECLARED, SOURCE_TABLES
from claimlake.sources.readers import conform
from claimlake.sources.table_sets import TableSet, exists

#: Key of the payments that claims are matched to.
ACTIVITY_KEY = ["claim_id", "activity_id"]
_COUNTS = "remittance_activity_counts"


class StoredTables(Mapping):
    """The source tables by the names that jobs use, each read when first asked for.

    ``folder`` holds a set of tables as ``store_tables`` writes it, or a folder
    ``<source table>.parquet`` for each. Masters are projected to the columns that jobs read, and
    facts with declared columns are brought to them: values that do not convert and absent columns
    are NULL, and no row is left out. ``names`` replaces or adds source tables.
    """

    def __init__(self, spark: SparkSession, folder: str,
                 names: Mapping[str, tuple[str, tuple[str, ...]]] | None = None,
                 declared: Mapping[str, T.StructType] = DECLARED, heavy_rows: int = HEAVY_ROWS):
        self.spark, self.folder, self.heavy_rows = spark, folder.rstrip("/"), heavy_rows
        self._names = {**SOURCE_TABLES, **(names or {})}
        self._declared = declared
        self._paths = TableSet(spark, folder).paths()
        self._read: dict[str, DataFrame] = {}

    def _path(self, table: str) -> str:
        return self._paths.get(table, f"{self.folder}/{table}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            table, columns = self._names[name]
            df = self.spark.read.parquet(self._path(table))
            if columns:
                df = df.select(*columns)
            if name in self._declared:
                df = conform(df, self._declared[name]).drop("schema_violation")
            self._read[name] = df
        return self._read[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def payment_counts(self) -> DataFrame | None:
        """Counts of activities with many payments, as stored with the remittance."""
        path = self._path(_COUNTS)
        return self.spark.read.parquet(path) if exists(self.spark, path) else None


def store_tables(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str,
                 heavy_rows: int = HEAVY_ROWS) -> StoredTables:
    """Store the source tables as one set, with the counts of heavy activities, and return it.

    Every table is read once. Readers see all new tables or none.
    """
    store = TableSet(spark, folder)
    with store.commit() as commit:
        for name in tables:
            table, _ = SOURCE_TABLES[name]
            written = commit.write(table, tables[name], f"{table}.parquet")
            if name == "remittance":
                counts = key_counts(written, ACTIVITY_KEY, heavy_rows=heavy_rows)
                commit.write(_COUNTS, counts, f"{_COUNTS}.parquet")
    return StoredTables(spark, folder, heavy_rows=heavy_rows)
