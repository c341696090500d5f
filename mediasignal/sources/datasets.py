"""Named datasets: Parquet folders under one root, or catalog tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from mediasignal.operators.columns import select_available
from mediasignal.operators.dedupe import keep_first


@dataclass(frozen=True)
class Datasets:
    """Reads and writes datasets by name; without ``root`` names are catalog tables."""

    spark: SparkSession
    root: str | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, name: str, columns: Iterable[str] | None = None, dedupe_on: str | None = None,
             order: Sequence[str] | None = None, schema: StructType | None = None) -> DataFrame:
        """Read a dataset, keep the listed columns that exist, keep one row per key.

        ``order`` says which row is first; by default all columns, so the result
        does not depend on file order.
        """
        if self.root is None:
            df = self.spark.table(name)
        else:
            reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
            df = reader.parquet(self.path(name))
        if columns:
            df = select_available(df, columns)
        if dedupe_on and dedupe_on in df.columns:
            df = keep_first(df, dedupe_on, order or df.columns)
        return df

    def write(self, name: str, df: DataFrame, on_empty: str = "write",
              partition_by: str | None = None, probe: DataFrame | None = None) -> bool:
        """Overwrite a dataset. With ``on_empty="skip"`` an empty result leaves it as it was.

        ``probe`` is a frame that is empty exactly if ``df`` is and costs less to
        look at; the shuffles of ``df`` then run only once. With ``partition_by``
        only the partitions present in ``df`` are replaced. Returns whether
        anything was written.
        """
        if on_empty not in ("write", "skip"):
            raise ValueError(f"on_empty must be 'write' or 'skip', not {on_empty!r}")
        if on_empty == "skip" and (df if probe is None else probe).isEmpty():
            return False
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
        if self.root is None and partition_by and self.spark.catalog.tableExists(name):
            names = self.spark.table(name).columns
            df.select(*names).write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
        elif self.root is None:
            writer.format("parquet").saveAsTable(name)
        else:
            writer.parquet(self.path(name))
        return True

    def write_bucketed(self, name: str, df: DataFrame, key: str, buckets: int) -> DataFrame:
        """Overwrite the catalog table ``name`` with rows dealt to ``buckets`` files by hash of ``key`` and sorted by it.

        Tables of one key and one number of buckets join on the key, and keep one
        row of it, without a shuffle. One task writes one bucket, so there are no
        more files than that. With ``root`` the files lie there.
        """
        writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
        if self.root is not None:
            writer = writer.option("path", self.path(name))
        writer.saveAsTable(name)
        return self.spark.table(name)
