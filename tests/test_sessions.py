import datetime as dt

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from txnlens import schemas
from txnlens.functions import arrays as A
from txnlens.operators import features as FT
from txnlens.operators import profile as PR
from txnlens.operators import sessions as SE
from txnlens.sources import fixtures


def ev(uid, session, minute, action, lon=None, lat=None, amount=None, account=None, recipient=None, label=0):
    return (label, uid, "c1", session, dt.datetime(2024, 1, 2, 10, minute), action, lon, lat, amount, account, recipient)


@pytest.fixture(scope="module")
def events(spark):
    rows = [
        ev("1", "s1", 0, "login", 1.0, 2.0),
        ev("2", "s1", 1, "action_3"),
        ev("3", "s1", 2, "transaction", amount=10.25, account="checking", recipient="r1"),
        ev("4", "s1", 4, "transaction", amount=5.0, account="savings", recipient="r2"),
        ev("5", "s1", 9, "transaction", amount=None, account=None, recipient="r1"),
        ev("3", "s1", 2, "transaction", amount=10.25, account="checking", recipient="r1"),  # a copy
        ev("6", "s2", 0, "transaction", amount=1.0, account="credit_card"),  # no login, no recipient
        ev("7", "s2", 5, "login", 9.0, 9.0),
    ]
    return spark.createDataFrame(rows, schemas.EVENTS)


def test_transactions_by_hand(events):
    got = {r["uniqueId"]: r for r in SE.transactions(events).collect()}
    assert sorted(got) == ["3", "4", "5", "6"]
    assert (got["3"]["longitude"], got["3"]["latitude"]) == (1.0, 2.0)
    assert got["6"]["longitude"] is None  # the session's first row has none, and NULL is not skipped
    assert [got[i]["actionCount"] for i in "3456"] == [3, 4, 5, 1]
    assert [got[i]["transactionCount"] for i in "3456"] == [1, 2, 3, 1]
    assert [got[i]["recipientTransactionCount"] for i in "3456"] == [1, 1, 2, 0]
    assert [got[i]["distinctRecipientCount"] for i in "3456"] == [1, 2, 2, 0]
    assert got["5"]["amountSum"] == 15.25 and got["5"]["amountCount"] == 2 and got["5"]["amountMin"] == 5.0
    assert got["5"]["transactionFromCheckingCount"] == 1 and got["5"]["action3Count"] == 1


def test_features_txn_by_hand(events):
    got = {r["uniqueId"]: r for r in FT.features_txn(SE.transactions(events)).collect()}
    three, five = got["3"], got["5"]
    assert three["secondsToTransaction"] == 120 and three["avgActionDuration"] == 40.0
    assert three["amountMod1"] == 0.25 and three["amountMod100"] == 10.25
    assert (three["hour"], three["dayOfWeek"], three["dayOfMonth"]) == (10, 3, 2)
    assert five["amount"] == -1.0 and five["amountMod1"] == -1.0 and five["accountTypeChecking"] == 0
    assert five["amountAvg"] == 7.625 and five["repeatedRecipientCount"] == 1
    assert got["6"]["longitude"] == 0.0


def test_amount_cents_are_rounded_not_truncated(spark):
    from txnlens.functions.scalars import amount_mod
    df = spark.createDataFrame([(1.15,), (250.0,), (None,)], "amount double")
    assert [r[0] for r in df.select(amount_mod("amount", 1)).collect()] == [0.15, 0.0, None]


def test_range_is_half_open(events):
    start, end = dt.datetime(2024, 1, 2, 10, 1), dt.datetime(2024, 1, 2, 10, 4)
    assert [r["uniqueId"] for r in SE.transactions(events, start, end).collect()] == ["3"]


@pytest.mark.parametrize("hot_rows", [2, 7])
def test_hot_sessions_give_the_same_rows(tables, hot_rows):
    assert same_rows(SE.transactions(tables.events(), hot_rows=hot_rows), tables.transactions())
    assert same_rows(fixtures.events(tables.spark, tables.sf_dir, hot_rows), tables.events())


def test_nested_sessions_agree_with_running_aggregates(tables):
    nested = SE.nested_transactions(tables.events())
    txn = lambda e: e["action"] == "transaction"
    s = F.col("session")
    out = nested.select(
        "uniqueId", "longitude", F.size(s).cast("long").alias("actionCount"),
        A.count_where(s, txn).alias("transactionCount"),
        A.count_where(s, lambda e: e["action"] == "action_4").alias("action4Count"),
        A.sum_where(s, "amount", txn).alias("amountSum"), A.min_where(s, "amount", txn).alias("amountMin"),
        A.max_where(s, "amount", txn).alias("amountMax"),
        A.distinct_where(s, "recipient", txn).alias("distinctRecipientCount"),
        A.count_where(s, lambda e: txn(e) & (e["recipient"] == F.col("recipient"))).alias("recipientTransactionCount"))
    assert same_rows(out, tables.transactions().select(*out.columns), 6)


@pytest.mark.parametrize("chunk_rows", [1, 3])
def test_long_sessions_are_chunked_not_refused(tables, chunk_rows):
    whole = SE.nested_transactions(tables.events())
    assert whole.where("chunk <> 0").isEmpty()
    parts = SE.nested_transactions(tables.events(), chunk_rows=chunk_rows, hot_rows=5)
    assert parts.agg(F.max(F.size("session"))).first()[0] == chunk_rows
    again = parts.groupBy("uniqueId").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("chunk", "session"))), lambda c: c["session"])).alias("session"))
    a, b = whole.select("uniqueId", "session"), again
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("hot_rows", [2, 20])
def test_hot_customers_give_the_same_profiles(tables, hot_rows):
    tx, cal = tables.transactions(), tables.calendar()
    assert same_rows(PR.profile(tx, cal, hot_rows=hot_rows), tables.profile())
    assert same_rows(PR.profile_recipients(tx, cal, hot_rows), tables.recipients())


def test_long_recipient_lists_are_chunked_not_refused(tables):
    flat = tables.recipients()
    for chunk_rows in (10 ** 6, 2):
        nested = PR.nest_recipients(flat, chunk_rows)
        again = nested.select("profileDate", "customerId", F.explode("recipients").alias("r")).select(
            "profileDate", "customerId", "r.*").select(*flat.columns)
        assert flat.exceptAll(again).isEmpty() and again.count() == flat.count()
        assert (nested.where("chunk > 0").count() > 0) == (chunk_rows == 2)


def test_separate_feature_tables_combine_to_the_single_pass(tables):
    tx = tables.transactions()
    parts = FT.combine(FT.features_txn(tx),
                       FT.features_profile(tx, tables.profile(), tables.recipients(), snapshots=tables.snapshots()),
                       FT.features_cust_info(tx, tables.customer_info()))
    assert same_rows(parts, tables.features())
    assert [c for c in tables.features().columns if c not in schemas.ID_FIELDS] == schemas.FEATURES


def test_missing_profile_and_customer_take_defaults(tables):
    f = tables.features()
    none = f.where("profileRawInd = 0")
    assert none.count() > 0 and none.where("profileRawAmountAvg <> -1 OR profileAmountZScore <> -1 "
                                           "OR profileRecipientTxnCount <> 0").count() == 0
    no_cust = f.where("age = -1")
    assert no_cust.where("genderMale <> 0 OR distanceFromHome <> -1 OR homeLongitude <> 0").count() == 0


def test_latest_snapshot_is_the_latest_of_anyone(spark):
    tx = spark.createDataFrame([("t1", dt.date(2024, 1, 20)), ("t0", dt.date(2024, 1, 1))], "uniqueId string, date date")
    profile = spark.createDataFrame([("a", dt.date(2024, 1, 8)), ("b", dt.date(2024, 1, 15)), ("a", dt.date(2024, 1, 20)),
                                     ("a", dt.date(2024, 2, 1))], "customerId string, profileDate date")
    got = {r[0]: r[1] for r in FT.asof_profile_date(tx, profile, dt.date(2024, 1, 20)).select("uniqueId", "profileDate").collect()}
    assert got == {"t1": dt.date(2024, 1, 15), "t0": None}


def test_monthly_schedule():
    days = PR.monthly_snapshots(dt.date(2023, 1, 31), dt.date(2023, 4, 10))
    assert days == [dt.date(2023, 2, 28), dt.date(2023, 3, 28), dt.date(2023, 4, 28)]
    assert PR.add_months(dt.date(2024, 3, 31), -1) == dt.date(2024, 2, 29)


def test_recipient_lookup_in_nested_form(spark):
    df = spark.createDataFrame([([("r1", 2), ("r2", 5)], "r2"), ([("r1", 2)], "r9"), (None, "r1")],
                               "recipients array<struct<recipient string, txnCnt long>>, recipient string")
    got = [r[0] for r in df.select(A.lookup_first(F.col("recipients"), "recipient", F.col("recipient"), "txnCnt")).collect()]
    assert got == [5, None, None]
