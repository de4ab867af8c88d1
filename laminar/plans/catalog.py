"""Catalog setup: layer databases and tables generated from the contracts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import SparkSession

from laminar.schemas import DATABASES, TABLES, TableSpec, ddl
from laminar.sources.tables import table_path


def create_databases(spark: SparkSession, root: str | None = None, prefix: str = "") -> list[str]:
    for name, comment in DATABASES.items():
        # A database of a prefix has no folder of its own: dropping it must not drop tables' files.
        loc = f" LOCATION '{root.rstrip('/')}/{name}.db'" if root and not prefix else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{name} COMMENT '{comment}'{loc}")
    return [prefix + name for name in DATABASES]


def create_tables(spark: SparkSession, root: str | None = None, prefix: str = "") -> list[str]:
    """CREATE TABLE IF NOT EXISTS for all nine tables (Parquet, partitioned as declared), in
    the layer databases or, with a ``prefix``, in databases of that prefix."""
    create_databases(spark, root, prefix)
    for spec in TABLES.values():
        spark.sql(ddl(replace(spec, database=prefix + spec.database), table_path(root, spec) if root else None))
    return [prefix + spec.qualified for spec in TABLES.values()]


def drop_databases(spark: SparkSession, prefix: str) -> None:
    """Drop the databases of a prefix and the entries of their tables, which are external."""
    if not prefix:
        raise ValueError("the layer databases themselves are not dropped")
    for spec in TABLES.values():
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{spec.qualified}")
    for name in DATABASES:
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{name}")


def list_databases(spark: SparkSession) -> list[str]:
    return sorted(db.name for db in spark.catalog.listDatabases())


def setup(spark: SparkSession, root: str, replace: bool = False) -> list[str]:
    """Databases and tables over the storage root. With ``replace``, catalog entries of an
    earlier root are dropped first; the tables are external, so no file is touched."""
    if replace:
        create_databases(spark)
        for spec in TABLES.values():
            spark.sql(f"DROP TABLE IF EXISTS {spec.qualified}")
    return create_tables(spark, root)


def register(spark: SparkSession, specs: Iterable[TableSpec], day: str | None = None, prefix: str = "") -> None:
    """Make written day folders partitions of the catalog tables: the one of ``day``, or
    all folders (for a backfill). Tables that the catalog does not have are left out."""
    for spec in specs:
        name = prefix + spec.qualified
        if not spec.partition_by or not spark.catalog.tableExists(name):
            continue
        if day is not None and spec.partition_by == ("dt",):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (dt = '{day}')")
        else:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
