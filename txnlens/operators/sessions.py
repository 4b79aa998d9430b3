"""Events to transactions: dedupe, carry the login location, summarise the session so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlens import schemas
from txnlens.functions.scalars import date_range
from txnlens.operators import running as R
from txnlens.sources.writers import materialize

ORDER = ["timestamp", "uniqueId"]
CHUNK_ROWS = 10_000  # events of a session that one array holds

# Columns of the session so far that transactions carry, the current row included.
RUNNING = (
    ["actionCount", "transactionCount"]
    + [f"action{i}Count" for i in range(10)]
    + [f"transactionFrom{label}Count" for label in schemas.ACCOUNT_LABELS]
    + ["sessionStart", "amountSum", "amountCount", "amountMin", "amountMax",
       "recipientTransactionCount", "distinctRecipientCount", "previousTransactionDate"]
)


def in_range(events: DataFrame, start=None, end=None) -> DataFrame:
    return events.where(date_range("timestamp", start, end)) if (start or end) else events


def dedupe(events: DataFrame, start=None, end=None) -> DataFrame:
    """One row per ``uniqueId`` in the half-open time range, the earliest one.

    Spark limits each map task's output to one row per id before the shuffle (row_number = 1), so many
    copies of one id do not meet in one task.
    """
    rows = in_range(events, start, end)
    w = Window.partitionBy("uniqueId").orderBy("timestamp", "sessionId", "action")
    return (rows.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn"))


def is_txn():
    return F.col("action") == "transaction"


def _count(condition):
    return ("sum", F.when(condition, 1).otherwise(0).cast("long"))


def running_state(deduped: DataFrame, hot_rows: int = R.HOT_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """Every event with the login location and the running aggregates of its session.

    ``counted``: the events before deduplication, on which long sessions are found without repeating it.

    One shuffle on the session and two sorts: by (session, recipient) for the count of transactions to the
    recipient, then by session for the rest. A recipient counts as new where that count reaches one.
    """
    rows = R.split(deduped, ["sessionId"], F.unix_timestamp("timestamp"), hot_rows, counted).clustered()
    to_recipient = is_txn() & F.col("recipient").isNotNull()
    rows = R.running(rows, ORDER, {"recipientTransactionCount": _count(to_recipient)}, extra_keys=["recipient"])
    aggs = {
        "firstLongitude": ("first", F.col("longitude")),
        "firstLatitude": ("first", F.col("latitude")),
        "sessionStart": ("first", F.col("timestamp")),
        "actionCount": ("sum", F.lit(1).cast("long")),
        "transactionCount": _count(is_txn()),
    }
    for i, action in enumerate(schemas.ACTIONS):
        aggs[f"action{i}Count"] = _count(F.col("action") == action)
    for label, account in zip(schemas.ACCOUNT_LABELS, schemas.ACCOUNT_TYPES):
        aggs[f"transactionFrom{label}Count"] = _count(is_txn() & (F.col("accountType") == account))
    amount = F.when(is_txn(), F.col("amount"))
    aggs["amountSum"] = ("sum", amount)
    aggs["amountCount"] = _count(amount.isNotNull())
    aggs["amountMin"] = ("min", amount)
    aggs["amountMax"] = ("max", amount)
    aggs["distinctRecipientCount"] = _count(to_recipient & (F.col("recipientTransactionCount") == 1))
    rows = R.running(rows, ORDER, aggs)
    rows = R.running(rows, ORDER, {"previousTransactionDate": ("max", F.when(is_txn(), F.to_date("timestamp")))}, exclusive=True)
    return rows.done()


def transactions(events: DataFrame, start=None, end=None, hot_rows: int = R.HOT_ROWS) -> DataFrame:
    """Transaction rows with the login location and the running aggregates of the session so far."""
    state = running_state(dedupe(events, start, end), hot_rows, in_range(events, start, end))
    return state.where(is_txn()).select(
        "fraudLabel", "uniqueId", "customerId", "sessionId", "timestamp",
        F.to_date("timestamp").alias("date"), "action",
        F.col("firstLongitude").alias("longitude"), F.col("firstLatitude").alias("latitude"),
        "amount", "accountType", "recipient", *RUNNING,
    )


def numbered_events(events: DataFrame, start=None, end=None, hot_rows: int = R.HOT_ROWS) -> DataFrame:
    """Every event with its ``ordinal`` in the session, from 1, and the login location."""
    rows = R.split(dedupe(events, start, end), ["sessionId"], F.unix_timestamp("timestamp"), hot_rows,
                   in_range(events, start, end)).clustered()
    return R.running(rows, ORDER, {
        "ordinal": ("sum", F.lit(1).cast("long")), "firstLongitude": ("first", F.col("longitude")),
        "firstLatitude": ("first", F.col("latitude"))}).done()


def session_chunks(numbered: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(sessionId, chunk, entries): each session once, as numbered arrays of at most ``chunk_rows`` events in order.

    A chunk is gathered by (session, chunk), so the longest session is spread over as many tasks as it has chunks.
    """
    entry = F.struct(*[f.name for f in schemas.SESSION_ENTRY])
    chunk = F.floor((F.col("ordinal") - 1) / chunk_rows).alias("chunk")
    gathered = numbered.groupBy("sessionId", chunk).agg(
        F.sort_array(F.collect_list(F.struct("ordinal", entry.alias("entry")))).alias("entries"))
    return gathered.select("sessionId", "chunk", F.transform("entries", lambda e: e["entry"]).alias("entries"))


def nested_transactions(events: DataFrame, start=None, end=None, chunk_rows: int = CHUNK_ROWS,
                        hot_rows: int = R.HOT_ROWS) -> DataFrame:
    """Transactions with the session so far, the current event included, as ``array<struct>`` ``session``.

    A session of up to ``chunk_rows`` events gives one row per transaction, with ``chunk`` 0. A longer one is neither refused nor
    cut: its transactions have one row per chunk so far, and the arrays of a transaction in the order of ``chunk`` are its
    session. That form grows with the square of the longest session; ``session_chunks`` holds each event once, and
    ``transactions`` gives all that the features need.
    """
    numbered = materialize(numbered_events(events, start, end, hot_rows), "numbered-events")
    own = F.floor((F.col("ordinal") - 1) / chunk_rows)
    tx = numbered.where(is_txn()).withColumn("own", own).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), "own")))
    chunks = session_chunks(numbered, chunk_rows).withColumnsRenamed({"sessionId": "s", "chunk": "c"})
    met = tx.join(chunks, F.col("sessionId").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    part = F.when(F.col("chunk") < F.col("own"), F.col("entries")).otherwise(
        F.slice("entries", F.lit(1), (F.col("ordinal") - F.col("own") * chunk_rows).cast("int")))
    return met.select(
        "fraudLabel", "uniqueId", "customerId", "sessionId", "timestamp", F.to_date("timestamp").alias("date"), "action",
        F.col("firstLongitude").alias("longitude"), F.col("firstLatitude").alias("latitude"),
        "amount", "accountType", "recipient", "chunk", part.alias("session"))
