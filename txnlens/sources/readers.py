"""Loading files with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.sources.writers import materialize

CORRUPT = "_corrupt_record"


class BadRecordsError(ValueError):
    """More unreadable records than the caller allows."""


def read_json(spark: SparkSession, path, schema: T.StructType | None = None, max_bad_records: int | None = None):
    """Newline-delimited JSON; keys absent from a record become NULL.

    By default an unreadable record fails the read when it is reached. ``max_bad_records``: how many unreadable
    lines may be left out; lines are parsed once into a stored table, and BadRecordsError is raised above the
    budget. A budget needs a schema.
    """
    if max_bad_records is None:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.option("mode", "FAILFAST").json(path)
    if schema is None:
        raise ValueError("max_bad_records needs a schema")
    flagged = materialize(read_json_flagged(spark, path, schema), "json-lines")
    bad = flagged.where(F.col(CORRUPT).isNotNull()).count()
    if bad > max_bad_records:
        raise BadRecordsError(f"{bad} unreadable records, {max_bad_records} allowed")
    return flagged.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_json_flagged(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """NDJSON with the raw text of every unreadable line in a CORRUPT column."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    # The corrupt column cannot be selected on its own from a file scan; parsing the text keeps it usable.
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.select(parsed.alias("r")).select("r.*")


def parse_json_lines(lines: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Parse a text column of JSON records, keeping the text of unreadable ones in a CORRUPT column."""
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(column, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.select(parsed.alias("r")).select("r.*")


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """CSV with one header row; the schema is inferred when none is given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, *paths) -> DataFrame:
    return spark.read.parquet(*paths)


def load(spark: SparkSession, path, source_format: str, schema: T.StructType | None = None,
         max_bad_records: int | None = None) -> DataFrame:
    """Load one path or glob by format name (JSON, CSV, PARQUET)."""
    kind = source_format.upper()
    if kind == "JSON":
        return read_json(spark, path, schema, max_bad_records)
    if max_bad_records is not None:
        raise ValueError("max_bad_records applies to JSON only")
    if kind == "CSV":
        return read_csv(spark, path, schema)
    if kind == "PARQUET":
        return read_parquet(spark, path)
    raise ValueError(f"source_format must be JSON, CSV or PARQUET, not {source_format!r}")


def model_columns(df: DataFrame, features, label: str | None = None, aux=()) -> DataFrame:
    """Only the columns a model run needs; whole numbers are read as doubles."""
    wanted = list(dict.fromkeys([*features, *([label] if label else []), *aux]))
    whole = {f.name for f in df.schema if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType))}
    return df.select(*[F.col(c).cast("double").alias(c) if c in whole else F.col(c) for c in wanted])
