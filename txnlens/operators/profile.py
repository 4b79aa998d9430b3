"""Customer profiles: per snapshot date, statistics of a customer's transactions in the look-back before it."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens import schemas
from txnlens.functions.scalars import seconds_between
from txnlens.operators import running as R

CHUNK_ROWS = 100_000  # recipients of a customer that one array holds
QUANTILE_ACCURACY = 1_000_000  # a percentile is exact for groups below this size
MAX_BROADCAST_DAYS = 500_000  # calendar rows; monthly snapshots with a year of look-back need 365 each


def add_months(day: dt.date, months: int) -> dt.date:
    """Calendar month arithmetic; the day is clipped to the length of the target month."""
    first = dt.date(day.year + (day.month - 1 + months) // 12, (day.month - 1 + months) % 12 + 1, 1)
    after = dt.date(first.year + first.month // 12, first.month % 12 + 1, 1)
    return first.replace(day=min(day.day, (after - first).days))


def monthly_snapshots(start: dt.date, end: dt.date) -> list:
    """Snapshot dates: one month after ``start``, then monthly, until ``end`` is reached or passed."""
    out, day = [], start
    while day < end:
        day = add_months(day, 1)
        out.append(day)
    return out


def snapshot_calendar(spark: SparkSession, snapshots, lookback_days: int | None = None,
                      lookback_months: int = 12) -> DataFrame:
    """(date, profileDate, windowStart): every calendar day with each snapshot whose look-back covers it.

    Built from the schedule alone, snapshots x look-back days rows, whatever the data holds.
    """
    rows = []
    for snap in snapshots:
        first = snap - dt.timedelta(days=lookback_days) if lookback_days else add_months(snap, -lookback_months)
        rows += [(first + dt.timedelta(days=i), snap, first) for i in range((snap - first).days)]
    calendar = spark.createDataFrame(rows, "date date, profileDate date, windowStart date")
    return F.broadcast(calendar) if len(rows) <= MAX_BROADCAST_DAYS else calendar


def _stats(column, name):
    return [F.avg(column).alias(f"mean{name}"), F.stddev_samp(column).alias(f"std{name}")]


def amount_stats(accuracy: int = QUANTILE_ACCURACY):
    shares = [p / 100 for p in schemas.PERCENTILES]
    return [
        F.min("amount").alias("amountMin"), F.max("amount").alias("amountMax"),
        F.avg("amount").alias("amountAvg"), F.stddev_samp("amount").alias("amountStd"),
        F.percentile_approx("amount", shares, accuracy).alias("__q"),
    ]


def session_stats():
    seconds = seconds_between("sessionStart", "timestamp")
    out = _stats(seconds, "SecondsToTransaction")
    for name, running in schemas.SESSION_ACTION_STATS + schemas.SESSION_TXN_STATS:
        out += _stats(F.col(running), name)
    return out


def count_stats():
    # A session belongs to one customer, so its first transaction inside the look-back marks it.
    opens = F.col("previousTransactionDate").isNull() | (F.col("previousTransactionDate") < F.col("windowStart"))
    return [F.count_if(opens).alias("sessionCount"), F.count(F.lit(1)).alias("transactionCount")]


def _with_snapshots(tx: DataFrame, calendar: DataFrame) -> DataFrame:
    return tx.join(calendar, "date")


def per_customer(tx: DataFrame, hot_rows: int = R.HOT_ROWS) -> list:
    """Transactions as one or two frames to aggregate by customer and snapshot.

    A transaction falls in many snapshots. Shuffling rows once by customer and multiplying them afterwards
    moves each row once; aggregating first would move a wide partial row per snapshot. That holds for all
    customers but the few with more rows than one task should take: theirs stay where they are and are
    aggregated map-side first.
    """
    found = R.hot_keys(tx, ["customerId"], hot_rows)
    if found is None:
        return [tx.repartition("customerId")]
    # at most running.MAX_HOT_KEYS rows, so the list may be broadcast
    hot = F.broadcast(found[0].select("customerId"))
    return [tx.join(hot, "customerId", "left_anti").repartition("customerId"),
            tx.join(hot, "customerId", "left_semi")]


def _grouped(parts, calendar, aggs, keys=("profileDate", "customerId")):
    return reduce(DataFrame.unionByName,
                  [_with_snapshots(part, calendar).groupBy(*keys).agg(*aggs) for part in parts])


def _open_quantiles(df: DataFrame) -> DataFrame:
    cols = []
    for c in df.columns:
        if c == "__q":
            cols += [F.get("__q", F.lit(i)).alias(f"amountPercentile{p}") for i, p in enumerate(schemas.PERCENTILES)]
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def profile_amounts(tx, calendar, hot_rows: int = R.HOT_ROWS, accuracy: int = QUANTILE_ACCURACY) -> DataFrame:
    return _open_quantiles(_grouped(per_customer(tx, hot_rows), calendar, amount_stats(accuracy)))


def profile_session_stats(tx, calendar, hot_rows: int = R.HOT_ROWS) -> DataFrame:
    return _grouped(per_customer(tx, hot_rows), calendar, session_stats())


def profile_counts(tx, calendar, hot_rows: int = R.HOT_ROWS) -> DataFrame:
    return _grouped(per_customer(tx, hot_rows), calendar, count_stats())


def profile_recipients(tx, calendar, hot_rows: int = R.HOT_ROWS, parts=None) -> DataFrame:
    """Flat: past transaction count and first time per customer, snapshot and recipient."""
    aggs = [F.count(F.lit(1)).alias("txnCnt"), F.min("timestamp").alias("minTimestamp")]
    return _grouped(parts or per_customer(tx, hot_rows), calendar, aggs, ("profileDate", "customerId", "recipient"))


def nest_recipients(flat: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(profileDate, customerId, chunk, recipients): the recipients as arrays, each ordered by recipient.

    A list of up to ``chunk_rows`` recipients is one array, with ``chunk`` 0. Longer ones are dealt by a hash of the recipient to
    as many numbered arrays of about half that length as they need: a recipient is in exactly one of them.
    """
    keys = ["profileDate", "customerId"]
    found = R.hot_keys(flat, keys, chunk_rows)
    dealt = flat.withColumn("chunk", F.lit(0).cast("long"))
    if found is not None:
        hot, _, limit = found
        parts = hot.select(*keys, F.ceil(F.col("n") * 2 / limit).cast("long").alias("parts"))
        dealt = flat.join(F.broadcast(parts), keys, "left").withColumn(  # at most MAX_HOT_KEYS rows, see hot_keys
            "chunk", F.coalesce(F.pmod(F.xxhash64("recipient"), F.col("parts")), F.lit(0).cast("long"))).drop("parts")
    entry = F.struct("recipient", "txnCnt", "minTimestamp")
    return dealt.groupBy(*keys, "chunk").agg(F.sort_array(F.collect_list(entry)).alias("recipients"))


def profile(tx: DataFrame, calendar: DataFrame, recipients: DataFrame | None = None, nested: bool = False,
            hot_rows: int = R.HOT_ROWS, accuracy: int = QUANTILE_ACCURACY, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """All statistics of every snapshot in one job, with the number of distinct recipients.

    ``nested`` adds the recipients array of the stored layout, with ``chunk``: one row per customer and snapshot, or one
    for each chunk of a list longer than ``nest_recipients`` keeps in one array.
    """
    parts = per_customer(tx, hot_rows)
    stats = _open_quantiles(_grouped(parts, calendar, amount_stats(accuracy) + session_stats() + count_stats()))
    flat = profile_recipients(tx, calendar, parts=parts) if recipients is None else recipients
    # count skips the NULL recipient, as a distinct count does
    side = flat.groupBy("profileDate", "customerId").agg(F.count("recipient").alias("distinctRecipientCount"))
    out = stats.join(side, ["profileDate", "customerId"], "left")
    if nested:
        out = out.join(nest_recipients(flat, chunk_rows), ["profileDate", "customerId"], "left")
    ordered = [f.name for f in schemas.PROFILE if f.name != "recipients"]
    return out.select(*ordered, "distinctRecipientCount", *(["chunk", "recipients"] if nested else []))
