"""Parquet tables under one root folder, with a row count taken by each write."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tenantlens.schemas import PREVIEW_ROWS

MADE = "_made.json"
CODEC = "zstd"  # raw tables repeat the field names in each whole record


class TableStore:
    """Names such as ``gold.dim_user`` are folders ``<root>/gold/dim_user``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.audit: dict[str, dict[str, int]] = {}

    @property
    def index(self) -> TableStore:
        """Look-up tables that are derived from the others, beside them and not among
        their counts; what is lost there is made again."""
        return TableStore(self.spark, f"{self.root}/index")

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def exists(self, name: str) -> bool:
        """Whether the folder holds data files or partitions. What a first write
        that broke off has left beside them does not count, what it has
        finished does."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        data = jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/[^_.]*")
        return bool(data.getFileSystem(conf).globStatus(data))

    def bytes(self, name: str) -> int:
        """Size of the table's files."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(conf).getContentSummary(path).getLength()

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def made(self, name: str) -> dict:
        """What the table was made from, with its counts and the number of that write;
        nothing if it was not noted. The note lies in the table's folder, so that every
        later overwrite takes it away."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/{MADE}")
        files = path.getFileSystem(conf)
        if not (self.exists(name) and files.exists(path)):
            return {}
        stream = files.open(path)
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def note(self, name: str, source: str, counts: dict[str, int]) -> None:
        """Notes what the table was made from; to be called after its write."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path(name)}/{MADE}")
        made = {"source": source, "counts": counts, "write": uuid.uuid4().hex}
        stream = path.getFileSystem(conf).create(path, True)
        try:
            stream.write(json.dumps(made).encode())
        finally:
            stream.close()

    def overwrite(
        self,
        name: str,
        rows: DataFrame,
        partition_by: Sequence[str] = (),
        *,
        gather: bool = False,
    ) -> dict[str, int]:
        """Full refresh: replaces rows and columns of the table.

        ``gather`` brings the rows of a partition together before they are
        written. Rows that come from a table with the same partitions lie
        together already, unless a join has shuffled them.
        """
        if gather:
            rows = rows.hint("rebalance", *partition_by)
        return self._write(
            name, rows, "overwrite", partition_by, partitionOverwriteMode="static"
        )

    def append(
        self, name: str, rows: DataFrame, partition_by: Sequence[str] = ()
    ) -> dict[str, int]:
        """Adds rows. With partition columns the rows are gathered by them first,
        and a partition too big for one task is split over several files."""
        if partition_by:
            rows = rows.hint("rebalance", *partition_by)
        return self._write(name, rows, "append", partition_by)

    def append_as_is(
        self, name: str, rows: DataFrame, partition_by: Sequence[str] = ()
    ) -> dict[str, int]:
        """Adds rows in the order and in the tasks they come in."""
        return self._write(name, rows, "append", partition_by)

    def replace_partitions(
        self, name: str, rows: DataFrame, partition_by: Sequence[str]
    ) -> dict[str, int]:
        """Replaces the partitions the rows belong to, all others stay. Creates
        the table if there is none."""
        rows = rows.hint("rebalance", *partition_by)
        return self._write(
            name, rows, "overwrite", partition_by, partitionOverwriteMode="dynamic"
        )

    def _write(
        self,
        name: str,
        rows: DataFrame,
        mode: str,
        partition_by: Sequence[str],
        **options: str,
    ) -> dict[str, int]:
        observation = Observation(f"write {name}")
        observed = rows.observe(observation, F.count(F.lit(1)).alias("rows"))
        writer = observed.write.mode(mode).options(compression=CODEC, **options)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        result = {"rows": int(observation.get.get("rows") or 0)}
        self.audit[name] = result
        return result

    def create_views(self, names: Sequence[str]) -> None:
        """Temporary views named like the tables, ``gold.dim_user`` as
        ``gold_dim_user``, for SQL users."""
        for name in names:
            self.read(name).createOrReplaceTempView(name.replace(".", "_"))


def preview(rows: DataFrame, *order_by: str | Column, limit: int = PREVIEW_ROWS) -> DataFrame:
    """First rows; in a given order each task keeps only its own first rows."""
    return (rows.orderBy(*order_by) if order_by else rows).limit(limit)
