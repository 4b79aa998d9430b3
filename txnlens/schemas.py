"""Table layouts and the ordered feature list.

Fixed values: field names, types, nullability and the feature order are the contract that stored tables
and online score events share.
"""

from __future__ import annotations

from pyspark.sql import types as T

ACCOUNT_TYPES = ["checking", "savings", "credit_card"]
ACCOUNT_LABELS = ["Checking", "Savings", "CreditCard"]
ACTIONS = [f"action_{i}" for i in range(10)]
MARITAL_STATUSES = ["single", "married", "divorced"]
AMOUNT_MODULI = [1, 100, 250, 500, 1000]
PERCENTILES = [10, 25, 50, 75, 90]


def _field(name, dtype, required=False):
    return T.StructField(name, dtype, nullable=not required)


EVENTS = T.StructType([
    _field("fraudLabel", T.LongType()),
    _field("uniqueId", T.StringType(), True),
    _field("customerId", T.StringType(), True),
    _field("sessionId", T.StringType(), True),
    _field("timestamp", T.TimestampNTZType()),
    _field("action", T.StringType()),
    _field("longitude", T.DoubleType()),
    _field("latitude", T.DoubleType()),
    _field("amount", T.DoubleType()),
    _field("accountType", T.StringType()),
    _field("recipient", T.StringType()),
])

SESSION_ENTRY = T.StructType([
    f for f in EVENTS if f.name not in ("fraudLabel", "customerId", "sessionId")
])

CUSTOMER_INFO = T.StructType([
    _field("customerId", T.StringType(), True),
    _field("age", T.LongType(), True),
    _field("gender", T.StringType(), True),
    _field("maritalStatus", T.StringType()),
    _field("homeLongitude", T.DoubleType()),
    _field("homeLatitude", T.DoubleType()),
])

RECIPIENT_ENTRY = T.StructType([
    _field("recipient", T.StringType()),
    _field("txnCnt", T.LongType()),
    _field("minTimestamp", T.TimestampNTZType()),
])

# What a profile keeps per session-so-far quantity: (name in the profile, running column it summarises).
SESSION_ACTION_STATS = [("SessionActionCount", "actionCount")] + [
    (f"SessionAction{i}Count", f"action{i}Count") for i in range(10)
]
SESSION_TXN_STATS = [("SessionTransactionCount", "transactionCount")] + [
    (f"SessionTransactionFrom{label}Count", f"transactionFrom{label}Count") for label in ACCOUNT_LABELS
]

_PROFILE_AMOUNTS = ["amountMin", "amountMax", "amountAvg", "amountStd"] + [
    f"amountPercentile{p}" for p in PERCENTILES
]

PROFILE = T.StructType(
    [_field("profileDate", T.DateType(), True), _field("customerId", T.StringType(), True)]
    + [_field(n, T.DoubleType()) for n in _PROFILE_AMOUNTS]
    + [_field(n, T.DoubleType()) for n in ("meanSecondsToTransaction", "stdSecondsToTransaction")]
    + [_field(n, T.LongType()) for n in ("sessionCount", "transactionCount")]
    + [_field(f"{s}{n}", T.DoubleType())
       for stats in (SESSION_ACTION_STATS, SESSION_TXN_STATS) for s in ("mean", "std") for n, _ in stats]
    + [_field("recipients", T.ArrayType(RECIPIENT_ENTRY))]
)

BATCH_SCORES = T.StructType([
    _field("fraudLabel", T.DoubleType()),
    _field("score", T.DoubleType()),
    _field("uniqueId", T.StringType(), True),
    _field("amount", T.DoubleType()),
])

ONLINE_SCORES = T.StructType([
    _field("fraudLabel", T.LongType()),
    _field("uniqueId", T.StringType(), True),
    _field("customerId", T.StringType(), True),
    _field("sessionId", T.StringType(), True),
    _field("timestamp", T.TimestampNTZType()),
    _field("scoreTimestamp", T.TimestampNTZType()),
    _field("action", T.StringType()),
    _field("amount", T.DoubleType()),
    _field("modelId", T.StringType()),
    _field("score", T.DoubleType()),
    _field("featureNamesStr", T.StringType()),
    _field("featureValuesStr", T.StringType()),
])

ID_FIELDS = ["fraudLabel", "uniqueId", "customerId", "sessionId", "timestamp", "date", "action"]

TXN_FEATURES = (
    ["longitude", "latitude", "amount"]
    + [f"amountMod{m}" for m in AMOUNT_MODULI]
    + ["hour", "dayOfWeek", "dayOfMonth"]
    + [f"accountType{label}" for label in ACCOUNT_LABELS]
    + ["transactionCount"] + [f"action{i}Count" for i in range(10)] + ["actionCount"]
    + ["secondsToTransaction", "avgActionDuration"]
    + ["amountSum", "amountAvg", "amountMin", "amountMax"]
    + ["recipientTransactionCount", "distinctRecipientCount", "repeatedRecipientCount"]
)

PROFILE_FEATURES = (
    ["profileRawInd"]
    + ["profileRaw" + n[0].upper() + n[1:] for n in _PROFILE_AMOUNTS]
    + ["profileAmountZScore"]
    + ["profileRawMeanSecondsToTransaction", "profileRawStdSecondsToTransaction",
       "profileSecondsToTransactionZScore"]
    + ["profileRawSessionCount", "profileRawTransactionCount"]
    + [f"profileRaw{s}{n}" for s in ("Mean", "Std") for n, _ in SESSION_ACTION_STATS]
    + [f"profile{n}ZScore" for n, _ in SESSION_ACTION_STATS]
    + [f"profileRaw{s}{n}" for s in ("Mean", "Std") for n, _ in SESSION_TXN_STATS]
    + [f"profile{n}ZScore" for n, _ in SESSION_TXN_STATS]
    + ["profileRecipientTxnCount", "profileDistinctRecipientCount"]
)

CUSTOMER_FEATURES = (
    ["age", "genderMale"]
    + [f"maritalStatus{m.capitalize()}" for m in MARITAL_STATUSES]
    + ["homeLongitude", "homeLatitude", "distanceFromHome"]
)

FEATURES = TXN_FEATURES + PROFILE_FEATURES + CUSTOMER_FEATURES


def schema_from_fields(fields) -> T.StructType:
    """A ``StructType`` from warehouse-style field entries.

    ``fields`` is a list of ``{"name", "type", "mode"[, "fields"]}`` dicts, or a dict of name -> type.
    """
    if isinstance(fields, dict):
        fields = [{"name": n, "type": t} for n, t in fields.items()]
    # Warehouse type names and the Spark types they load as.
    scalar = {
        "STRING": T.StringType(), "INTEGER": T.LongType(), "INT64": T.LongType(),
        "FLOAT": T.DoubleType(), "FLOAT64": T.DoubleType(), "DATETIME": T.TimestampNTZType(),
        "TIMESTAMP": T.TimestampType(), "DATE": T.DateType(),
    }
    out = []
    for f in fields:
        kind = f["type"].upper()
        if kind in ("RECORD", "STRUCT"):
            dtype = schema_from_fields(f["fields"])
        elif kind in scalar:
            dtype = scalar[kind]
        else:
            raise ValueError(f"unsupported field type {f['type']!r} for {f['name']!r}")
        mode = f.get("mode", "NULLABLE").upper()
        if mode == "REPEATED":
            dtype = T.ArrayType(dtype)
        out.append(T.StructField(f["name"], dtype, nullable=mode != "REQUIRED"))
    return T.StructType(out)
