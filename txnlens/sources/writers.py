"""Writing tables and files: dispositions, partitioning, clustering, schema evolution, export, scratch."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Write dispositions and export file suffixes.
DISPOSITIONS = {"TRUNCATE": "overwrite", "APPEND": "append", "EMPTY": "errorifexists"}
CLUSTERING = "txnlens.clusterBy"
SUFFIXES = {".csv": "csv", ".json": "json", ".parquet": "parquet"}


def cluster_rows(df: DataFrame, cluster_by) -> DataFrame:
    """Range-partition and sort so that files hold narrow ranges of the clustering columns."""
    return df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)


def clustering(spark: SparkSession, table: str) -> list[str]:
    """The columns a table was declared to be clustered by."""
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == CLUSTERING).first()
    return found["value"].split(",") if found else []


def write_table(df: DataFrame, table: str, disposition: str = "EMPTY", partition_by=None, cluster_by=None,
                relax_schema: bool = False, replace_partitions: bool = False) -> None:
    """Save as a managed table.

    TRUNCATE replaces the table (with ``replace_partitions``: only the partitions present in ``df``), APPEND
    adds, EMPTY needs the table to be absent or without rows. ``relax_schema`` lets an append bring new
    columns, which are NULL in existing rows, or leave out existing ones.
    """
    if disposition not in DISPOSITIONS:
        raise ValueError(f"disposition must be one of {sorted(DISPOSITIONS)}, not {disposition!r}")
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    mode = DISPOSITIONS[disposition]
    if disposition == "EMPTY" and exists:
        if not spark.table(table).isEmpty():
            raise ValueError(f"table {table} already has rows")
        # a table made for these columns keeps its layout
        mode = "append" if set(spark.table(table).columns) == set(df.columns) and not partition_by else "overwrite"
    if disposition == "APPEND" and exists:
        have = spark.table(table)
        if set(have.columns) != set(df.columns):
            if not relax_schema:
                raise ValueError(f"columns of {table} and of the appended rows differ")
            add_columns(spark, table, df)
            have = spark.table(table)
        df = align(df, have)
    if exists and not cluster_by:
        cluster_by = clustering(spark, table)
    if cluster_by:
        df = cluster_rows(df, [*(partition_by or []), *cluster_by])
    if disposition == "TRUNCATE" and exists and replace_partitions:
        key = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(key)
        spark.conf.set(key, "dynamic")
        try:
            df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(key, before)
        return
    if mode == "append" and exists:
        df.select(*spark.table(table).columns).write.insertInto(table)
        return
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def add_columns(spark: SparkSession, table: str, df: DataFrame) -> None:
    """Add to a stored table the columns it lacks (NULL in existing rows)."""
    have = set(spark.table(table).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def align(df: DataFrame, target: DataFrame) -> DataFrame:
    """The rows of ``df`` in the columns of ``target``; absent columns become NULL."""
    have = set(df.columns)
    return df.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.schema
    ])


def append_relaxed(base: DataFrame, extra: DataFrame) -> DataFrame:
    """Union by name under the merged schema: either side may lack columns of the other."""
    return base.unionByName(extra, allowMissingColumns=True)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by=None, cluster_by=None):
    if cluster_by:
        df = cluster_rows(df, cluster_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def export(df: DataFrame, path: str, fmt: str | None = None, mode: str = "errorifexists") -> None:
    """Export to files; the format comes from the argument or else from the path's suffix."""
    kind = (fmt or "").lower() or SUFFIXES.get(os.path.splitext(path)[1].lower())
    if kind not in SUFFIXES.values():
        raise ValueError(f"cannot tell a supported format from fmt={fmt!r}, path={path!r}")
    writer = df.write.mode(mode)
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)


def export_scores(scored: DataFrame, path: str, label: str, aux=(), fmt: str = "csv",
                  mode: str = "errorifexists") -> None:
    """Label, score and auxiliary fields of every dataset, one folder per dataset."""
    out = scored.select("dataset", *dict.fromkeys([label, "score", *aux]))
    writer = out.write.mode(mode).partitionBy("dataset")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` where the cluster names one, else the context's checkpoint folder. Only a local
    master without either gets a temporary folder; elsewhere a machine-local path would be lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="txnlens-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the scratch folder and read back: cuts lineage, outlives executors, keeps column pruning."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/txnlens/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """A broadcast hint only when the side was counted and is small; otherwise the plain frame."""
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df
