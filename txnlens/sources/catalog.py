"""Database and table management, and running queries into named tables."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from txnlens.sources import writers

_NAME = re.compile(r"^[A-Za-z0-9_]+(\.[A-Za-z0-9_]+)?$")


def _checked(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"not a table or database name: {name!r}")
    return name


def database_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.databaseExists(_checked(name))


def create_database(spark: SparkSession, name: str, exists_ok: bool = True) -> None:
    spark.sql(f"CREATE DATABASE {'IF NOT EXISTS ' if exists_ok else ''}{_checked(name)}")


def drop_database(spark: SparkSession, name: str, contents: bool = False) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {_checked(name)}{' CASCADE' if contents else ''}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(_checked(name))


def create_table(spark: SparkSession, name: str, schema, partition_by=(), cluster_by=()) -> None:
    """An empty table with the given columns, partitions and clustering.

    ``cluster_by`` is kept as a property of the table; ``writers.write_table`` sorts what it appends by it.
    """
    writer = spark.createDataFrame([], schema).write.format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(_checked(name))
    if cluster_by:
        columns = {f.name for f in spark.table(name).schema}
        if not set(cluster_by) <= columns:
            raise ValueError(f"cluster_by must name columns of {name}, not {sorted(set(cluster_by) - columns)}")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{writers.CLUSTERING}' = '{','.join(cluster_by)}')")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_checked(name)}")


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    spark.table(_checked(source)).write.saveAsTable(_checked(target))


def load_frame(spark: SparkSession, frame, table: str) -> None:
    """A pandas frame as a new table; an existing table is an error."""
    spark.createDataFrame(frame).write.mode("errorifexists").saveAsTable(_checked(table))


def run_query(spark: SparkSession, text: str, args: dict | None = None, table: str | None = None,
              disposition: str = "TRUNCATE", **layout) -> DataFrame:
    """Run parameterised SQL (``:name`` markers); with ``table``, store the result and return the table."""
    out = spark.sql(text, args=args or {})
    if table is None:
        return out
    writers.write_table(out, _checked(table), disposition, **layout)
    return spark.table(table)


def run_query_files(spark: SparkSession, folder: str, args: dict | None = None, database: str | None = None):
    """Run every ``.sql`` file of a folder into a table named after the file; returns the table names."""
    names = []
    for path in sorted(Path(folder).glob("*.sql")):
        name = f"{database}.{path.stem}" if database else path.stem
        run_query(spark, path.read_text(), args, table=name)
        names.append(name)
    return names
