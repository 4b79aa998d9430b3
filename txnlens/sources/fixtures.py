"""Adapter: the supplied tables in the shape of session events and customer records.

Raw events carry no session id. A user's session ends after 24 idle hours; its first event is the login, and
purchases after it are transactions. Built with running aggregates, so one very active user stays parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.operators import running as R

IDLE_HOURS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sessionize(raw: DataFrame, hot_rows: int = R.HOT_ROWS) -> DataFrame:
    """Add ``is_new``, the session ordinal ``sess`` per user, and ``k0``, the first event's ``k``."""
    rows = raw.select(
        "event_id", "user_id", "ts", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    rows = R.split(rows, ["user_id"], F.unix_timestamp("ts"), hot_rows)
    order = ["ts", "event_id"]
    rows = R.running(rows, order, {"prev_ts": ("max", F.col("ts"))}, exclusive=True)
    gap = F.col("ts") - F.col("prev_ts")
    rows = rows.map(lambda df: df.withColumn(
        "is_new", F.when(gap <= F.expr(f"INTERVAL '{IDLE_HOURS}' HOUR"), 0).otherwise(1)))
    return R.running(rows, order, {
        "sess": ("sum", F.col("is_new")),
        "k0": ("last", F.when(F.col("is_new") == 1, F.col("k"))),
    }).done()


def events(spark: SparkSession, sf_dir: str, hot_rows: int = R.HOT_ROWS) -> DataFrame:
    """Session events in the layout of ``schemas.EVENTS``."""
    s = sessionize(table(spark, sf_dir, "events"), hot_rows)
    login = F.col("is_new") == 1
    txn = ~login & (F.col("event_type") == "purchase")
    digit = F.col("k") % 10
    account = (F.when(digit < 5, "checking").when(digit < 8, "savings").otherwise("credit_card"))
    user = F.col("user_id").cast("string")
    return s.select(
        F.when(F.col("k0") >= 90, 1).otherwise(0).cast("long").alias("fraudLabel"),
        F.lpad(F.col("event_id").cast("string"), 10, "0").alias("uniqueId"),
        user.alias("customerId"),
        F.concat(user, F.lit("-"), F.col("sess").cast("string")).alias("sessionId"),
        F.col("ts").alias("timestamp"),
        F.when(login, "login").when(F.col("event_type") == "purchase", "transaction")
        .otherwise(F.concat(F.lit("action_"), digit.cast("string"))).alias("action"),
        F.when(login, F.lit(-130.0) + F.lit(0.55) * F.col("k")).alias("longitude"),
        F.when(login, F.lit(30.0) + F.lit(0.22) * ((F.col("k") * 7) % 100)).alias("latitude"),
        F.when(txn, F.col("value")).alias("amount"),
        F.when(txn, account).alias("accountType"),
        F.when(txn, F.concat(F.lit("r"), (F.col("k") % 20).cast("string"))).alias("recipient"),
    )


def customer_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer records, one for every customer."""
    key = F.col("c_custkey")
    third = key % 3
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("customerId"),
        (F.lit(18) + key % 52).alias("age"),
        F.when(key % 2 == 0, "M").otherwise("F").alias("gender"),
        F.when(third == 0, "single").when(third == 1, "married").otherwise("divorced").alias("maritalStatus"),
        (F.lit(-130.0) + F.lit(0.55) * ((key * 13) % 100)).alias("homeLongitude"),
        (F.lit(30.0) + F.lit(0.22) * ((key * 29) % 100)).alias("homeLatitude"),
    )
