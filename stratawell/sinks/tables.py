"""Tables as Parquet folders: full refresh, append, window reload, upsert, retention.

Tables are partitioned by year only; entity and date are clustering keys. A folder per entity
and year would give many small files, and one huge one where an entity dominates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, types as T, functions as F

from stratawell.operators.dedupe import latest_per_key
from stratawell.session import materialize, shuffles_dropped
from stratawell.storage import any_file, delete, file_names, swap

COMPRESSION = "zstd"  # of stored tables: they take most of the disk


@dataclass(frozen=True)
class Lake:
    """Tables below one root, addressed as ``layer.table``."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table.replace('.', '/')}"

    def exists(self, table: str) -> bool:
        return any_file(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def read_if_present(self, table: str) -> DataFrame | None:
        return self.read(table) if self.exists(table) else None

    # ---- writes ------------------------------------------------------------------------------

    def create_if_missing(self, table: str, schema: T.StructType | str) -> None:
        if not self.exists(table):
            self.spark.createDataFrame([], schema).write.parquet(self.path(table))

    def append(self, table: str, df: DataFrame) -> None:
        with shuffles_dropped(self.spark):
            df.write.mode("append").parquet(self.path(table), compression=COMPRESSION)

    def refresh(
        self,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] = (),
    ) -> int:
        """Replace the whole table and return its row count.

        The new content is written next to the table and moved in once complete; a failed write
        leaves the old table as it was. The count comes from the write itself.
        """
        target, staging = self.path(table), self.path(table) + "__staging"
        counted = Observation()
        out = clustered(df, partition_by, cluster_by)
        out = out.observe(counted, F.count(F.lit(1)).alias("n"))
        with shuffles_dropped(self.spark):
            out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
                *partition_by
            ).parquet(staging, compression=COMPRESSION)
        swap(self.spark, staging, target)
        return counted.get["n"]

    def reload_from(
        self,
        table: str,
        batch: DataFrame,
        time: str,
        partition: str = "date_year",
        cluster_by: Sequence[str] = (),
    ) -> None:
        """Delete rows dated on or after the first date of the batch, then insert the batch.

        Only the partitions from that date on are rewritten. Rows without a date are stored beside
        the others; one that is stored already is not stored again. Running it twice with the same
        batch gives the same table.
        """
        batch = materialize(batch.withColumn(partition, F.year(time)))
        first, undated = batch.agg(F.min(time), F.count_if(F.col(time).isNull())).first()
        if first is None and not undated:
            return
        if not self.exists(table):
            self.refresh(table, batch, [partition], cluster_by)
            return
        old = self.read(table)
        batch = batch.select(*old.columns)
        kept, stale = old.limit(0), set()
        if first is not None:
            kept = old.filter((F.col(partition) == first.year) & (F.col(time) < F.lit(first)))
            written = self.years(batch, partition)
            if not kept.isEmpty():
                written.add(first.year)
            stale = self.years(old.filter(F.col(partition) >= first.year), partition) - written
        if undated:
            dateless = batch.filter(F.col(time).isNull())
            kept = kept.unionByName(old.filter(F.col(partition).isNull()).exceptAll(dateless))
        merged = kept.unionByName(batch)
        self.overwrite_partitions(table, merged, partition, cluster_by)
        for year in stale:
            self.drop_partition(table, partition, year)

    def upsert(
        self,
        table: str,
        batch: DataFrame,
        keys: Sequence[str],
        newest_first: Sequence,
        partition: str = "date_year",
        cluster_by: Sequence[str] = (),
    ) -> None:
        """Insert or replace by key. Only partitions the batch touches are rewritten.

        The partition has to follow from the key, so that a key never changes partition.
        """
        if not self.exists(table):
            self.refresh(table, latest_per_key(batch, keys, newest_first), [partition], cluster_by)
            return
        batch = materialize(batch)
        touched = self.years(batch, partition)
        here = F.col(partition).isin(list(touched))
        if not batch.filter(F.col(partition).isNull()).isEmpty():
            here = here | F.col(partition).isNull()
        old = self.read(table).filter(F.coalesce(here, F.lit(False)))
        marked = old.withColumn("_new", F.lit(0)).unionByName(
            batch.select(*old.columns).withColumn("_new", F.lit(1))
        )
        merged = latest_per_key(marked, keys, [F.desc("_new"), *newest_first]).drop("_new")
        self.overwrite_partitions(table, merged, partition, cluster_by)

    def retain_years(
        self, table: str, years: int, as_of_year: int, partition: str = "date_year"
    ) -> list[int]:
        """Drop whole partitions older than ``years`` years; returns what was dropped."""
        old = [y for y in self.years(self.read(table), partition) if y <= as_of_year - years]
        for year in old:
            self.drop_partition(table, partition, year)
        return sorted(old)

    def recluster(
        self, table: str, partition_by: Sequence[str], cluster_by: Sequence[str]
    ) -> None:
        """Rewrite a stored table so that each file covers a narrow range of the keys.

        The range shuffle samples its input first, which is cheap for a stored table. Partition
        and clustering keys are ranged together, so one large year or entity becomes many files.
        """
        keys = [*partition_by, *cluster_by]
        rows = self.read(table).repartitionByRange(*keys).sortWithinPartitions(*keys)
        staging = self.path(table) + "__staging"
        with shuffles_dropped(self.spark):
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
                *partition_by
            ).parquet(staging, compression=COMPRESSION)
        swap(self.spark, staging, self.path(table))

    # ---- partitions ----------------------------------------------------------------------------

    @staticmethod
    def years(df: DataFrame, partition: str = "date_year") -> set:
        """Distinct partition values, one per calendar year."""
        years = df.select(partition).filter(F.col(partition).isNotNull()).distinct()
        return {r[0] for r in years.collect()}

    def overwrite_partitions(
        self, table: str, df: DataFrame, partition: str, cluster_by: Sequence[str] = ()
    ) -> None:
        """Replace the partitions ``df`` has rows for; ``df`` may read the same table."""
        with shuffles_dropped(self.spark):
            clustered(df, [partition], cluster_by).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(partition).parquet(self.path(table), compression=COMPRESSION)

    def replace_partition(
        self, table: str, df: DataFrame, partition: str, value, cluster_by: Sequence[str] = ()
    ) -> None:
        """Make ``df`` the content of one partition; without rows the partition goes."""
        self.replace_partitions(table, df, partition, {value}, cluster_by)

    def replace_partitions(
        self, table: str, df: DataFrame, partition: str, values: set, cluster_by: Sequence[str] = ()
    ) -> None:
        """Make ``df``, which may read the same table, the content of these partitions; those without rows go.

        A partition that was written has new files. No copy of the rows is made to find out.
        """
        folders = {v: f"{self.path(table)}/{partition}={v}" for v in values}
        before = {v: file_names(self.spark, f) for v, f in folders.items()}
        self.overwrite_partitions(table, df, partition, cluster_by)
        for value, folder in folders.items():
            if file_names(self.spark, folder) == before[value]:
                self.drop_partition(table, partition, value)

    def drop_partition(self, table: str, partition: str, value) -> None:
        delete(self.spark, f"{self.path(table)}/{partition}={value}")


def clustered(
    df: DataFrame, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = ()
) -> DataFrame:
    """Order rows for the write: files of even size, sorted by the clustering keys.

    The rebalance lets Spark split a partition that is large and join those that are small, by
    their size at run time.
    """
    if not cluster_by:
        return df
    spread = df.hint("rebalance", *[F.col(c) for c in partition_by])
    return spread.sortWithinPartitions(*partition_by, *cluster_by)


def create_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
