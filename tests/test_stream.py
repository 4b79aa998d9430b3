import datetime as dt

import pytest
from conftest import same_rows
from pyspark.sql import Row
from pyspark.sql import functions as F

from txnlens import schemas
from txnlens.operators import features as FT
from txnlens.plans import tables as T
from txnlens.streaming import online as ON


def run(spark, stream, path):
    q = (stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def test_stream_equals_batch(tables, tmp_path):
    spark = tables.spark
    ON.use_rocksdb(spark)
    ON.publish(tables.events(), f"{tmp_path}/in", chunks=2, files_per_chunk=2)
    stream = ON.with_event_time(ON.replay(spark, f"{tmp_path}/in", 2), "20 days")
    features = ON.online_features(ON.online_transactions(stream), tables.profile(), tables.recipients(),
                                  tables.customer_info(), ON.snapshot_list(tables.profile(), T.PROFILE_END))
    run(spark, features, tmp_path)
    assert same_rows(tables.features(), spark.read.parquet(f"{tmp_path}/out"), 6)


def test_snapshots_written_while_the_stream_runs_are_used(tables, tmp_path):
    spark, days = tables.spark, sorted(T.SNAPSHOTS)
    ON.use_rocksdb(spark)
    ON.publish(tables.events(), f"{tmp_path}/in", chunks=3, files_per_chunk=1)
    profile, recipients = tables.profile(), tables.recipients()

    def store(day, mode="append"):
        for frame, name in ((profile, "profile"), (recipients, "recipients")):
            frame.where(F.col("profileDate") == F.lit(day)).write.mode(mode).parquet(f"{tmp_path}/{name}")

    store(days[0])
    seen = []

    def lookup():
        if seen:  # the stream runs: another snapshot is written before each further micro-batch
            store(days[min(len(seen), len(days) - 1)])
        now = spark.read.parquet(f"{tmp_path}/profile").select("profileDate", "customerId").distinct()
        seen.append(sorted({r[0] for r in now.collect()}))
        return (spark.read.parquet(f"{tmp_path}/profile"), spark.read.parquet(f"{tmp_path}/recipients"), tables.customer_info())

    tx = ON.online_transactions(ON.with_event_time(ON.replay(spark, f"{tmp_path}/in", 1), "20 days"))
    ON.feature_batches(tx, lookup, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert len(seen) >= 3 and len(seen[0]) == 1 and len(seen[2]) == 3
    for number, known in enumerate(seen):
        got = spark.read.parquet(f"{tmp_path}/out/batch={number}")
        part = tables.transactions().join(got.select("uniqueId"), "uniqueId", "left_semi")
        some = [x.where(F.col("profileDate").isin(known)) for x in (profile, recipients)]
        want = FT.features(part, *some, tables.customer_info(),
                           snapshots=spark.createDataFrame([(d,) for d in known], "profileDate date"))
        assert same_rows(want, got, 6), number
    assert spark.read.parquet(f"{tmp_path}/out").count() == tables.transactions().count()


def test_state_goes_on_between_batches_of_any_cut(tables, tmp_path):
    """The same rows whether a session's events come at once or in many micro-batches."""
    spark = tables.spark
    ON.use_rocksdb(spark)
    ON.publish(tables.events(), f"{tmp_path}/in", chunks=6, files_per_chunk=1)
    stream = ON.with_event_time(ON.replay(spark, f"{tmp_path}/in", 1), "20 days")
    run(spark, ON.online_transactions(stream), tmp_path)
    got = spark.read.parquet(f"{tmp_path}/out").drop(ON.EVENT_TIME)
    assert same_rows(tables.transactions(), got, 6)


def test_late_events_are_dropped_and_idle_sessions_forgotten(spark, tmp_path):
    def ev(uid, session, day, action, amount=None):
        return (0, uid, "c", session, dt.datetime(2024, 1, day, 12), action, 1.0, 2.0, amount, None, None)

    ON.use_rocksdb(spark)
    batches = [[ev("1", "s", 1, "login"), ev("2", "s", 1, "transaction", 5.0)],
               [ev("3", "t", 20, "login")],  # moves the watermark past the first session
               [ev("3b", "t", 20, "action_1")],  # rows are checked against the watermark of the batch before
               [ev("4", "s", 1, "transaction", 7.0)],  # late
               [ev("5", "s", 21, "transaction", 9.0)]]  # the session's state is gone, so it starts anew
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schemas.EVENTS).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    stream = ON.with_event_time(ON.replay(spark, f"{tmp_path}/in", 1), "1 hour")
    q = run(spark, ON.online_transactions(stream), tmp_path)
    got = {r["uniqueId"]: r["actionCount"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"2": 2, "5": 1}
    dropped = sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    assert dropped == 1


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_idle_time_counts_alike_in_every_zone(spark, tmp_path, zone):
    def ev(uid, session, day, hour, action, amount=None):
        return (0, uid, "c", session, dt.datetime(2024, 3, day, hour, 30), action, 1.0, 2.0, amount, None, None)

    ON.use_rocksdb(spark)
    # 17 idle hours across the change to summer time, while another session moves the watermark
    batches = [[ev("1", "s", 9, 12, "login")], [ev("2", "t", 10, 5, "login")], [ev("3", "t", 10, 5, "action_1")],
               [ev("4", "s", 10, 5, "action_2"), ev("5", "s", 10, 6, "transaction", 9.0)]]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for rows in batches:
            spark.createDataFrame(rows, schemas.EVENTS).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        stream = ON.with_event_time(ON.replay(spark, f"{tmp_path}/in", 1), "1 hour")
        run(spark, ON.online_transactions(stream), tmp_path)
        got = [r["actionCount"] for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [3]


def test_score_events_round_trip(tables, tmp_path):
    from txnlens.operators import parity as PV

    spark = tables.spark
    model = T.model(tables)
    tables.features().write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(tables.features().schema).parquet(f"{tmp_path}/in")
    events = ON.score_events(stream, model, "m1", T.MODEL_FEATURES)
    ON.sink_json(events, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    stored = spark.read.schema(schemas.ONLINE_SCORES).json(f"{tmp_path}/out")
    assert PV.feature_names(stored) == T.MODEL_FEATURES
    parsed = PV.parse_features(PV.latest_scores(stored), T.MODEL_FEATURES)
    joined = PV.full_join(tables.features().withColumn("score", F.lit(0.0)), parsed)
    assert joined.count() == tables.features().count()
    assert PV.feature_mismatch(joined, T.MODEL_FEATURES, 0.0).where("mismatch_rate > 0").count() == 0


class FakeState:
    """A value or map state that counts its calls."""

    def __init__(self):
        self.held, self.calls = {}, []

    def get(self):
        self.calls.append("get")
        return self.held.get(())

    def update(self, value):
        self.calls.append("update")
        self.held[()] = value

    def getValue(self, key):
        self.calls.append("getValue")
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls.append("updateValue")
        self.held[key] = value


class FakeHandle:
    def __init__(self):
        self.timers, self.totals, self.recipients = [], FakeState(), FakeState()

    def getValueState(self, name, schema):
        return self.totals

    def getMapState(self, name, key, value):
        return self.recipients

    def registerTimer(self, at):
        self.timers.append(at)


def test_a_session_costs_few_calls_of_the_state():
    event = Row(*[f.name for f in schemas.EVENTS], ON.EVENT_TIME, ON._MILLIS)

    def ev(uid, minute, action, amount=None, recipient=None):
        at = None if minute is None else dt.datetime(2024, 1, 1, 0, minute)
        values = {"fraudLabel": 0, "uniqueId": uid, "customerId": "c", "sessionId": "s", "timestamp": at, "action": action,
                  "longitude": 1.0, "latitude": float("nan"), "amount": amount, "accountType": "checking" if amount else None,
                  "recipient": recipient, ON.EVENT_TIME: at, ON._MILLIS: minute and minute * 60_000}
        return event(*[values[n] for n in event])

    handle, processor = FakeHandle(), ON.SessionProcessor()
    processor.init(handle)
    out = list(processor.handleInputRows(("s",), iter([
        ev("4", None, "transaction", 1.0, "b"), ev("3", 3, "transaction", 5.0, "a"), ev("2", 2, "transaction", 2.0, "a"),
        ev("1", 1, "login")]), None))
    assert [(r.uniqueId, r.actionCount, r.amountSum, r.recipientTransactionCount, r.distinctRecipientCount) for r in out] == [
        ("2", 2, 2.0, 1, 1), ("3", 3, 7.0, 2, 1), ("4", 4, 8.0, 1, 2)]
    assert [r.previousTransactionDate for r in out] == [None, dt.date(2024, 1, 1), dt.date(2024, 1, 1)]
    assert out[0].latitude is None and out[2].date is None and handle.timers == [3 * 60_000 + processor.idle_millis]
    assert handle.totals.calls == ["get", "update"] and handle.recipients.calls == ["updateValue"] * 2
    out = list(processor.handleInputRows(("s",), iter([ev("5", 5, "transaction", float("nan"), "a")]), None))
    assert [(r.amount, r.amountSum, r.amountCount, r.recipientTransactionCount, r.transactionFromCheckingCount) for r in out] == [
        (None, 8.0, 3, 3, 4)]
    assert handle.recipients.calls[2:] == ["getValue", "updateValue"]


def test_publish_tells_how_many_files(tables, tmp_path):
    assert ON.publish(tables.events(), f"{tmp_path}/in", chunks=3, files_per_chunk=2) == 6
    assert len(list((tmp_path / "in").glob("*.json"))) <= 6
