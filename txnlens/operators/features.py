"""The 106 features of a transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens import schemas
from txnlens.functions.scalars import (amount_mod, date_range, distance, one_hot, or_default,
                                       seconds_between, zscore)

_SECONDS = "secondsToTransaction"


def _seconds():
    return seconds_between("sessionStart", "timestamp")


def txn_columns():
    """Features of the transaction and its session, over a row of ``sessions.transactions``."""
    cols = {
        "longitude": or_default("longitude", 0.0),
        "latitude": or_default("latitude", 0.0),
        "amount": or_default("amount", -1.0),
    }
    for m in schemas.AMOUNT_MODULI:
        cols[f"amountMod{m}"] = or_default(amount_mod("amount", m), -1.0)
    cols["hour"] = or_default(F.hour("timestamp").cast("long"), -1)
    cols["dayOfWeek"] = or_default(F.dayofweek("timestamp").cast("long"), -1)
    cols["dayOfMonth"] = or_default(F.dayofmonth("timestamp").cast("long"), -1)
    for label, account in zip(schemas.ACCOUNT_LABELS, schemas.ACCOUNT_TYPES):
        cols[f"accountType{label}"] = one_hot("accountType", account)
    for name in ["transactionCount", *[f"action{i}Count" for i in range(10)], "actionCount"]:
        cols[name] = F.col(name)
    cols[_SECONDS] = _seconds()
    cols["avgActionDuration"] = _seconds() / F.col("actionCount")
    cols["amountSum"] = F.col("amountSum")
    cols["amountAvg"] = F.try_divide(F.col("amountSum"), F.col("amountCount"))
    cols["amountMin"] = F.col("amountMin")
    cols["amountMax"] = F.col("amountMax")
    cols["recipientTransactionCount"] = F.col("recipientTransactionCount")
    cols["distinctRecipientCount"] = F.col("distinctRecipientCount")
    cols["repeatedRecipientCount"] = F.col("transactionCount") - F.col("distinctRecipientCount")
    return [cols[n].alias(n) for n in schemas.TXN_FEATURES]


def profile_columns():
    """Features against the customer's profile, over a transaction joined with profile columns ``p_*``."""
    cols = {"profileRawInd": F.when(F.col("p_customerId").isNull(), 0).otherwise(1).cast("long")}

    def raw(name, default=-1.0):
        cols["profileRaw" + name[0].upper() + name[1:]] = or_default(f"p_{name}", default)

    for name in ["amountMin", "amountMax", "amountAvg", "amountStd"]:
        raw(name)
    for p in schemas.PERCENTILES:
        raw(f"amountPercentile{p}")
    cols["profileAmountZScore"] = zscore("amount", "p_amountAvg", "p_amountStd")
    raw("meanSecondsToTransaction")
    raw("stdSecondsToTransaction")
    cols["profileSecondsToTransactionZScore"] = zscore(
        _seconds(), "p_meanSecondsToTransaction", "p_stdSecondsToTransaction")
    raw("sessionCount", -1)
    raw("transactionCount", -1)
    for name, running in schemas.SESSION_ACTION_STATS + schemas.SESSION_TXN_STATS:
        raw(f"mean{name}")
        raw(f"std{name}")
        cols[f"profile{name}ZScore"] = zscore(running, f"p_mean{name}", f"p_std{name}")
    cols["profileRecipientTxnCount"] = or_default("p_recipientTxnCnt", 0)
    cols["profileDistinctRecipientCount"] = or_default("p_distinctRecipientCount", 0)
    return [cols[n].alias(n) for n in schemas.PROFILE_FEATURES]


def customer_columns():
    """Features of the customer record, over a transaction joined with its columns ``c_*``."""
    cols = {
        "age": or_default("c_age", -1),
        "genderMale": one_hot("c_gender", "M"),
        "homeLongitude": or_default("c_homeLongitude", 0.0),
        "homeLatitude": or_default("c_homeLatitude", 0.0),
        "distanceFromHome": F.coalesce(
            distance(F.col("c_homeLongitude"), F.col("c_homeLatitude"), F.col("longitude"), F.col("latitude")),
            F.lit(-1.0)),
    }
    for m in schemas.MARITAL_STATUSES:
        cols[f"maritalStatus{m.capitalize()}"] = one_hot("c_maritalStatus", m)
    return [cols[n].alias(n) for n in schemas.CUSTOMER_FEATURES]


def _ids(generated: bool):
    cols = [or_default("fraudLabel", 0).alias("fraudLabel"),
            *[F.col(c) for c in schemas.ID_FIELDS if c != "fraudLabel"]]
    return [F.current_date().alias("generatedDate"), *cols] if generated else cols


def _in_range(tx, start, end):
    return tx.where(date_range("date", start, end)) if (start or end) else tx


def features_txn(tx: DataFrame, start=None, end=None, generated: bool = False) -> DataFrame:
    """Id fields and the 35 transaction and session features."""
    return _in_range(tx, start, end).select(*_ids(generated), *txn_columns())


def existing_snapshots(tx: DataFrame, calendar: DataFrame) -> DataFrame:
    """Snapshot dates for which a profile has any row: those whose look-back holds a transaction."""
    return tx.select("date").distinct().join(calendar, "date").select("profileDate").distinct()


def asof_profile_date(tx: DataFrame, snapshots: DataFrame, end=None) -> DataFrame:
    """Add ``profileDate``: the latest snapshot date at or before the transaction's date, before ``end``.

    The date is the latest of anyone, not of the customer: a customer absent from it has no profile. The
    distinct snapshot dates (at most one per calendar day) reach the rows as one array from a scalar
    subquery, so there is no theta join and no ranking of rows.
    """
    dates = snapshots.select("profileDate").distinct()
    if end is not None:
        dates = dates.where(F.col("profileDate") < F.lit(end).cast("date"))
    listed = dates.agg(F.collect_list("profileDate").alias("dates")).scalar()
    # The subquery is resolved to a constant once per query; a date maps to its snapshot on distinct dates
    # only, then joins back by equality.
    days = (tx.select("date").distinct().withColumn("__dates", listed)
            .select("date", F.array_max(F.filter("__dates", lambda d: d <= F.col("date"))).alias("profileDate")))
    return tx.join(F.broadcast(days), "date", "left")  # a DATE has at most 366 values a year, each once here


def _profile_side(profile: DataFrame) -> DataFrame:
    keep = [c for c in profile.columns if c not in ("profileDate", "customerId", "recipients")]
    return profile.select("profileDate", "customerId", F.col("customerId").alias("p_customerId"),
                          *[F.col(c).alias(f"p_{c}") for c in keep])


def join_profile(tx: DataFrame, profile: DataFrame, recipients: DataFrame, end=None,
                 snapshots: DataFrame | None = None) -> DataFrame:
    """Transactions with their profile row and the past count for their recipient.

    ``profile`` needs ``distinctRecipientCount``; ``recipients`` is the flat table of
    (profileDate, customerId, recipient, txnCnt).
    """
    return join_profile_dated(asof_profile_date(tx, profile if snapshots is None else snapshots, end),
                              profile, recipients)


def join_profile_dated(dated: DataFrame, profile: DataFrame, recipients: DataFrame) -> DataFrame:
    """The same for transactions that already carry their ``profileDate``."""
    past = recipients.select("profileDate", "customerId", "recipient", F.col("txnCnt").alias("p_recipientTxnCnt"))
    return (dated.join(_profile_side(profile), ["customerId", "profileDate"], "left")
            .join(past, ["customerId", "profileDate", "recipient"], "left"))


def join_customer(tx: DataFrame, customer_info: DataFrame) -> DataFrame:
    keep = [c for c in customer_info.columns if c != "customerId"]
    side = customer_info.select("customerId", *[F.col(c).alias(f"c_{c}") for c in keep])
    return tx.join(side, "customerId", "left")


def features_profile(tx, profile, recipients, start=None, end=None, snapshots=None) -> DataFrame:
    """``uniqueId`` and the 63 features against the customer's profile."""
    joined = join_profile(_in_range(tx, start, end), profile, recipients, end, snapshots)
    return joined.select("uniqueId", *profile_columns())


def features_cust_info(tx, customer_info, start=None, end=None) -> DataFrame:
    """``uniqueId`` and the 8 features of the customer record."""
    return join_customer(_in_range(tx, start, end), customer_info).select("uniqueId", *customer_columns())


def combine(txn: DataFrame, profile: DataFrame, cust: DataFrame) -> DataFrame:
    """Join three stored feature tables by ``uniqueId``."""
    return txn.join(profile, "uniqueId", "left").join(cust, "uniqueId", "left")


def features(tx, profile, recipients, customer_info, start=None, end=None, snapshots=None,
             generated: bool = False) -> DataFrame:
    """Id fields and all 106 features in contract order.

    Each side extends the same row, so no feature table is joined back to another one.
    """
    joined = join_profile(_in_range(tx, start, end), profile, recipients, end, snapshots)
    joined = join_customer(joined, customer_info)
    return joined.select(*feature_columns(generated))


def feature_columns(generated: bool = False):
    """Id fields and the 106 features over a fully joined transaction."""
    return [*_ids(generated), *txn_columns(), *profile_columns(), *customer_columns()]


def split_sets(df: DataFrame, bounds: dict, column: str = "date") -> DataFrame:
    """Tag rows with the out-of-time set they fall in: ``bounds`` is name -> (start, end), half-open."""
    tag = F.lit(None).cast("string")
    for name, (lo, hi) in bounds.items():
        tag = F.when(date_range(F.col(column), F.lit(lo).cast("date"), F.lit(hi).cast("date")), name).otherwise(tag)
    return df.withColumn("dataset", tag).where(F.col("dataset").isNotNull())
