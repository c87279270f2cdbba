"""Where tables live: one ``Layout`` maps (layer, table) to a path or a
catalog identifier, replacing the reference's per-job catalog settings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold")
#: Folder columns that a deduplicating stream adds (event day and micro-batch): no part of a table.
HELPERS = ("_event_date", "_batch")


@dataclass(frozen=True)
class Layout:
    """``warehouse`` root (any Hadoop URI: s3a://, abfss://, hdfs://, file:),
    table ``fmt`` and an optional V2 ``catalog`` (e.g. an Iceberg catalog).

    Without a catalog, tables are paths ``warehouse/layer/name`` and, when
    written "as tables", managed tables ``layer.name`` in the session catalog.
    """

    warehouse: str
    fmt: str = "parquet"
    catalog: str | None = None

    def path(self, layer: str, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{layer}/{name}"

    def ident(self, layer: str, name: str) -> str:
        return f"{self.catalog}.{layer}.{name}" if self.catalog else f"{layer}.{name}"

    def catalog_conf(self, impl: str = "org.apache.iceberg.spark.SparkCatalog",
                     catalog_type: str = "hadoop") -> dict[str, str]:
        """Session settings for the V2 catalog (pass to ``get_spark(conf=…)``).
        Object-store credentials come from the environment/instance profile,
        never from code."""
        if not self.catalog:
            return {}
        c = f"spark.sql.catalog.{self.catalog}"
        return {c: impl, f"{c}.type": catalog_type, f"{c}.warehouse": self.warehouse}


def read_table(spark: SparkSession, layout: Layout, layer: str, name: str, by: str = "path") -> DataFrame:
    """A1/A2/A3: scan by path, or by identifier through the catalog."""
    if by == "table" or layout.catalog:
        return spark.read.table(layout.ident(layer, name))
    df = spark.read.format(layout.fmt).load(layout.path(layer, name))
    return df.drop(*HELPERS)


def write_table(df: DataFrame, layout: Layout, layer: str, name: str, mode: str = "overwrite", by: str = "path",
                partition_by: Sequence[str] = (), properties: Mapping[str, str] | None = None) -> None:
    """B1/B2/B3/B4: overwrite a path, create-or-replace a V2 table, or
    overwrite a managed table. Writing and re-reading is also how layer runs
    cut lineage between jobs (a lost executor never replays upstream work)."""
    if layout.catalog:
        w = df.writeTo(layout.ident(layer, name)).using(layout.fmt)
        for k, v in (properties or {}).items():
            w = w.tableProperty(k, v)
        if partition_by:
            from pyspark.sql import functions as F
            w = w.partitionedBy(*[F.col(c) for c in partition_by])
        w.createOrReplace()
        return
    w = df.write.format(layout.fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    if by == "table":
        w.option("path", layout.path(layer, name)).saveAsTable(layout.ident(layer, name))
    else:
        w.save(layout.path(layer, name))


def table_exists(spark: SparkSession, layout: Layout, layer: str, name: str) -> bool:
    """Whether the table is in the catalog or, without a V2 catalog, its folder holds partitions or files."""
    if layout.catalog:
        return spark.catalog.tableExists(layout.ident(layer, name))
    path = spark._jvm.org.apache.hadoop.fs.Path(layout.path(layer, name))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(path) and any(s.getPath().getName()[0] not in "_." for s in system.listStatus(path))


def replace_partitions(df: DataFrame, layout: Layout, layer: str, name: str, partition_by: Sequence[str]) -> None:
    """Overwrite only the partitions that ``df`` has rows of; a table that is not there is created.

    No rows write nothing. Without a V2 catalog the partitions are swapped when the job commits, so ``df``
    may come from the same table; the output committer must support dynamic partition overwrite.
    """
    if layout.catalog:
        if table_exists(df.sparkSession, layout, layer, name):
            df.writeTo(layout.ident(layer, name)).overwritePartitions()
        else:
            write_table(df, layout, layer, name, partition_by=partition_by)
        return
    (df.write.format(layout.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).save(layout.path(layer, name)))


def drop_table(spark: SparkSession, layout: Layout, layer: str, name: str) -> None:
    """B5: the table's entry in the catalog and, without a V2 catalog, its files (through the Hadoop file system, so at any URI)."""
    spark.sql(f"DROP TABLE IF EXISTS {layout.ident(layer, name)}")
    if not layout.catalog:
        path = spark._jvm.org.apache.hadoop.fs.Path(layout.path(layer, name))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ensure_layer(spark: SparkSession, layout: Layout, layer: str) -> None:
    """B6: the layer's namespace (database) exists."""
    if layout.catalog:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {layout.catalog}.{layer}")
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{layout.warehouse.rstrip('/')}/{layer}'")


def literal_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A5: small local rows with an explicit schema (seeds, lookups)."""
    return spark.createDataFrame(rows, schema)
