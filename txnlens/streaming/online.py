"""The online path: replay events, keep each session's state, emit features per transaction, score, publish.

The state of a session holds what ``sessions.running_state`` computes in batch, so both paths share the feature
expressions. Parity holds for input that arrives in order; an event behind the watermark is dropped and
counted in the query progress.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from txnlens import schemas
from txnlens.operators import features as FT
from txnlens.operators import model as ML
from txnlens.operators.parity import SEPARATOR
from txnlens.operators.sessions import RUNNING

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT_TIME = "eventTime"
_MILLIS = "eventMillis"
SLICE_ROWS = 5_000_000  # events of a replayed time slice, and of a file in it
FILE_ROWS = 100_000
BATCHES = 16  # micro-batches of a replay, about: each one joins the whole profile, so they must not grow with the events
_DATED = {"sessionStart": T.TimestampNTZType(), "previousTransactionDate": T.DateType(),
          "amountSum": T.DoubleType(), "amountMin": T.DoubleType(), "amountMax": T.DoubleType()}

OUTPUT = T.StructType(
    [f for f in schemas.EVENTS if f.name not in ("accountType", "recipient")]
    + [T.StructField("date", T.DateType()), T.StructField("accountType", T.StringType()),
       T.StructField("recipient", T.StringType())]
    + [T.StructField(n, _DATED.get(n, T.LongType())) for n in RUNNING]
    + [T.StructField(EVENT_TIME, T.TimestampType())]
)

_COUNTERS = (["actionCount", "transactionCount", "distinctRecipientCount", "amountCount"]
             + [f"action{i}Count" for i in range(10)]
             + [f"transactionFrom{label}Count" for label in schemas.ACCOUNT_LABELS])
_STATE = T.StructType(
    [T.StructField(n, T.LongType()) for n in _COUNTERS]
    + [T.StructField(n, T.DoubleType()) for n in ("longitude", "latitude", "amountSum", "amountMin", "amountMax")]
    + [T.StructField("sessionStart", T.LongType()), T.StructField("lastTransaction", T.LongType()),
       T.StructField("latest", T.LongType())]
)


def use_rocksdb(spark: SparkSession) -> None:
    """The session operator keeps state in RocksDB; the provider must be set before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def replay(spark: SparkSession, path: str, files_per_trigger: int = 1, schema: T.StructType = schemas.EVENTS) -> DataFrame:
    """NDJSON event files as a stream, so many files per micro-batch, oldest file first."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("latestFirst", False).json(path))


def publish(events: DataFrame, path: str, chunks: int | None = None, files_per_chunk: int | None = None,
            time_column: str = "timestamp") -> int:
    """Write events as NDJSON for a replay in order: one time slice after the other. Returns the number of files, at most.

    Within a slice a session stays in one file, so its events arrive in order however the files are spread
    over micro-batches. Slices are cut at quantiles of the event time; their number and that of their files follow the
    number of events where they are not given.
    """
    if chunks is None or files_per_chunk is None:
        rows = events.count()
        chunks = chunks or max(2, -(-rows // SLICE_ROWS))
        files_per_chunk = files_per_chunk or max(1, -(-rows // (chunks * FILE_ROWS)))
    seconds = F.unix_timestamp(time_column)
    cuts = events.agg(F.percentile_approx(seconds, [i / chunks for i in range(1, chunks)] or [1.0], 10_000)).first()[0]
    cuts = [None, *sorted(set(cuts))[: chunks - 1], None]
    for lo, hi in zip(cuts, cuts[1:]):
        part = events
        if lo is not None:
            part = part.where(seconds > lo)
        if hi is not None:
            part = part.where(seconds <= hi)
        (part.repartition(files_per_chunk, "sessionId").sortWithinPartitions(time_column)
         .write.mode("append").json(path))
    return (len(cuts) - 1) * files_per_chunk


def with_event_time(stream: DataFrame, delay: str) -> DataFrame:
    """Add a zoned copy of the timestamp and a watermark on it."""
    return stream.withColumn(EVENT_TIME, F.col("timestamp").cast("timestamp")).withWatermark(EVENT_TIME, delay)


class SessionProcessor(StatefulProcessor):
    """Running aggregates of one session. Recipients are a keyed map, so a lookup does not load them all.

    Most sessions have a few events, so events are taken as rows: a frame for each session would cost far more than its events.
    """

    idle_millis = 24 * 3600 * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.totals = handle.getValueState("totals", _STATE)
        self.recipients = handle.getMapState("recipients", "recipient string", "n long")

    def handleInputRows(self, key, rows, timerValues):
        """A row per transaction among a session's new events, in order, begun at what the state holds."""
        events = sorted(rows, key=_place)
        names = [f.name for f in _STATE]
        held = self.totals.get()
        if held is not None:
            s = dict(zip(names, held))
        else:  # first event of the session: its location, missing or not, is the login location
            first = events[0]
            s = {n: 0 for n in _COUNTERS} | {
                "longitude": _value(first["longitude"]), "latitude": _value(first["latitude"]), "amountSum": None,
                "amountMin": None, "amountMax": None, "sessionStart": _micros(first["timestamp"]), "lastTransaction": None, "latest": 0}
        start, counts, out = _time(s["sessionStart"]), {}, []
        for e in events:
            s["actionCount"] += 1
            if e["action"] in _ACTION_COUNTERS:
                s[_ACTION_COUNTERS[e["action"]]] += 1
            if e[_MILLIS] is not None:
                s["latest"] = max(s["latest"], e[_MILLIS])
            if e["action"] == "transaction":
                out.append(self._transaction(e, s, start, counts, held is not None))
        for recipient, n in counts.items():
            self.recipients.updateValue((recipient,), (n,))
        self.totals.update(tuple(s[n] for n in names))
        if s["latest"]:
            self.handle.registerTimer(s["latest"] + self.idle_millis)
        return iter(out)

    def _transaction(self, e: Row, s: dict, start: dt.datetime | None, counts: dict, known: bool) -> Row:
        """Count a transaction in ``s`` and in ``counts`` per recipient, which is looked up once where the session is known."""
        amount, recipient, at = _value(e["amount"]), e["recipient"], e["timestamp"]
        s["transactionCount"] += 1
        if e["accountType"] in _ACCOUNT_COUNTERS:
            s[_ACCOUNT_COUNTERS[e["accountType"]]] += 1
        if amount is not None:
            s["amountCount"] += 1
            s["amountSum"] = (s["amountSum"] or 0.0) + amount
            s["amountMin"] = amount if s["amountMin"] is None else min(s["amountMin"], amount)
            s["amountMax"] = amount if s["amountMax"] is None else max(s["amountMax"], amount)
        if recipient is not None:
            if recipient not in counts:
                past = self.recipients.getValue((recipient,)) if known else None
                counts[recipient] = past[0] if past else 0
            counts[recipient] += 1
            s["distinctRecipientCount"] += counts[recipient] == 1
        before, s["lastTransaction"] = _time(s["lastTransaction"]), _micros(at)
        own = {"amount": amount, "longitude": s["longitude"], "latitude": s["latitude"], "date": at and at.date(), "sessionStart": start,
               "recipientTransactionCount": 0 if recipient is None else counts[recipient],
               "previousTransactionDate": before and before.date()}
        return _OUT(*[own[n] if n in own else s[n] if n in s else e[n] for n in _OUT])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """Forget the session, unless events came after this timer was set (they set a later one)."""
        held = self.totals.get()
        if held is not None and dict(zip([f.name for f in _STATE], held))["latest"] + self.idle_millis <= (
                expiredTimerInfo.getExpiryTimeInMs()):
            self.totals.clear()
            self.recipients.clear()
        return iter(())

    def close(self) -> None:
        pass


_OUT = Row(*[f.name for f in OUTPUT])
_ACTION_COUNTERS = {a: f"action{i}Count" for i, a in enumerate(schemas.ACTIONS)}
_ACCOUNT_COUNTERS = {a: f"transactionFrom{label}Count" for label, a in zip(schemas.ACCOUNT_LABELS, schemas.ACCOUNT_TYPES)}
_EPOCH = dt.datetime(1970, 1, 1)


def _place(event: Row) -> tuple:
    """An event's place in its session: by time, then by id, missing ones last."""
    at, name = event["timestamp"], event["uniqueId"]
    return at is None, at or _EPOCH, name is None, name or ""


def _micros(at: dt.datetime | None) -> int | None:
    return None if at is None else (at - _EPOCH) // dt.timedelta(microseconds=1)


def _time(micros: int | None) -> dt.datetime | None:
    return None if micros is None else _EPOCH + dt.timedelta(microseconds=micros)


def _value(v):
    """None for NaN."""
    return None if v is None or v != v else v


def online_transactions(stream: DataFrame, idle_hours: int | None = None) -> DataFrame:
    """One row per transaction with the session so far, in the layout of the batch transactions.

    ``stream`` has the event-time column with a watermark. A session's state is dropped once it has been idle
    for ``idle_hours`` (24 by default) of event time.
    """
    processor = SessionProcessor()
    if idle_hours is not None:
        processor.idle_millis = idle_hours * 3600 * 1000
    # Python sees zoned times as local ones; watermark and timers count from the epoch
    timed = stream.withColumn(_MILLIS, F.unix_millis(EVENT_TIME))
    return timed.groupBy("sessionId").transformWithState(
        processor, outputStructType=OUTPUT, outputMode="append", timeMode="eventTime")


def with_snapshot(tx: DataFrame, snapshot_dates) -> DataFrame:
    """The latest of the given snapshot dates at or before each transaction (one date per calendar day at most)."""
    latest = F.lit(None).cast("date")
    for day in sorted(snapshot_dates):
        latest = F.when(F.col("date") >= F.lit(day), F.lit(day)).otherwise(latest)
    return tx.withColumn("profileDate", latest)


def online_features(tx: DataFrame, profile: DataFrame, recipients: DataFrame, customer_info: DataFrame,
                    snapshot_dates) -> DataFrame:
    """All 106 features per streamed transaction: static profile and customer tables joined to the stream."""
    joined = FT.join_profile_dated(with_snapshot(tx, snapshot_dates), profile, recipients)
    joined = FT.join_customer(joined, customer_info)
    return joined.select(*FT.feature_columns())


def feature_batches(tx: DataFrame, tables, path: str, checkpoint: str, end: dt.date | None = None):
    """Write the features of streamed transactions to ``path``, with the snapshots that exist when a micro-batch starts.

    ``tables()`` gives (profile, recipients, customer_info) and is called for every micro-batch, so a snapshot written while the
    stream runs is used from the next one on. The result is parquet, one folder ``batch=<number>`` each; a micro-batch
    that is repeated after a failure replaces its own folder. Returns the started query, which ends with the input.
    """
    def write(batch: DataFrame, number: int) -> None:
        profile, recipients, customer_info = tables()
        found = online_features(batch, profile, recipients, customer_info, snapshot_list(profile, end))
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (tx.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).outputMode("append").start())


def snapshot_list(profile: DataFrame, end: dt.date | None = None) -> list:
    """Distinct snapshot dates of a stored profile table."""
    dates = profile.select("profileDate").distinct()
    if end is not None:
        dates = dates.where(F.col("profileDate") < F.lit(end))
    return [r[0] for r in dates.collect()]  # at most one per calendar day


def score_events(features: DataFrame, model: Transformer, model_id: str, names=tuple(schemas.FEATURES)) -> DataFrame:
    """Score events: ids, score, and the feature names and values as two joined strings."""
    keep = ["fraudLabel", "uniqueId", "customerId", "sessionId", "timestamp", "action", "amount"]
    values = F.concat_ws(SEPARATOR, *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in names])
    rows = features.withColumn("featureValuesStr", values)
    scored = ML.score(model, rows, keep=[*keep, "featureValuesStr"])
    return scored.select(
        *keep[:5], F.localtimestamp().alias("scoreTimestamp"), "action", "amount",
        F.lit(model_id).alias("modelId"), "score", F.lit(SEPARATOR.join(names)).alias("featureNamesStr"),
        "featureValuesStr")


def first_scores(scores: DataFrame, delay: str, time_column: str = "timestamp") -> DataFrame:
    """On the stream: the first score of each transaction within the watermark delay."""
    timed = scores.withColumn(EVENT_TIME, F.col(time_column).cast("timestamp")).withWatermark(EVENT_TIME, delay)
    return timed.dropDuplicatesWithinWatermark(["uniqueId"])


def sink_json(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Append to NDJSON files; the checkpoint makes restarts pick up where they stopped."""
    writer = stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).outputMode("append").start()
