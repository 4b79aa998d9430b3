"""The stored tables of a run over one folder of supplied tables.

events and customer_info stand for the loaded raw tables; transactions, profile, recipients and features are
the derived tables that later steps read. Each is written once per session to the scratch folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens import schemas
from txnlens.operators import features as FT
from txnlens.operators import profile as PR
from txnlens.operators import sessions
from txnlens.sources import fixtures
from txnlens.sources.writers import materialize

# The supplied events span one month, so snapshots are weekly and the look-back is two weeks.
SNAPSHOTS = [dt.date(2024, 1, d) for d in (8, 15, 22, 29)]
PROFILE_END = dt.date(2024, 1, 29)
LOOKBACK_DAYS = 14
SETS = {
    "train": (dt.date(2024, 1, 8), dt.date(2024, 1, 22)),
    "validation": (dt.date(2024, 1, 22), dt.date(2024, 1, 26)),
    "test": (dt.date(2024, 1, 26), dt.date(2024, 1, 31)),
}

_stored: dict = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _once(self, name, build) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _stored:
            _stored[key] = materialize(build(), name)
        return _stored[key]

    def raw(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    def events(self) -> DataFrame:
        return self._once("events", lambda: fixtures.events(self.spark, self.sf_dir))

    def customer_info(self) -> DataFrame:
        return fixtures.customer_info(self.spark, self.sf_dir)

    def calendar(self) -> DataFrame:
        return PR.snapshot_calendar(self.spark, SNAPSHOTS, LOOKBACK_DAYS)

    def transactions(self) -> DataFrame:
        return self._once("transactions", lambda: sessions.transactions(self.events()))

    def snapshots(self) -> DataFrame:
        dates = FT.existing_snapshots(self.transactions(), self.calendar())
        return dates.where(F.col("profileDate") < F.lit(PROFILE_END))

    def recipients(self) -> DataFrame:
        return self._once("recipients", lambda: PR.profile_recipients(self.transactions(), self.calendar()))

    def profile(self) -> DataFrame:
        return self._once("profile", lambda: PR.profile(self.transactions(), self.calendar(), self.recipients()))

    def build_features(self) -> DataFrame:
        return FT.features(self.transactions(), self.profile(), self.recipients(), self.customer_info(),
                           snapshots=self.snapshots())

    def features(self) -> DataFrame:
        return self._once("features", self.build_features)

    def feature_sets(self) -> DataFrame:
        """Features of the three out-of-time sets, tagged with ``dataset``."""
        return FT.split_sets(self.features(), SETS)

    def scored(self) -> DataFrame:
        """(dataset, y, score, amount, uniqueId): a closed-form score that overlaps between the classes."""
        event_id = F.col("uniqueId").cast("long")
        score = (F.col("fraudLabel") * 2500 + (event_id * 7919) % 7500) / F.lit(10000.0)
        tx = FT.split_sets(self.transactions(), SETS)
        return tx.select("dataset", "uniqueId", F.col("fraudLabel").alias("y"), score.alias("score"), "amount")


FEATURE_COLUMNS = schemas.FEATURES


def batch_scores(t: Tables) -> DataFrame:
    """The batch side of the parity check: scores of the test set, without the first hour of each day."""
    test = t.scored().where("dataset = 'test'")
    hours = t.features().select("uniqueId", "hour")
    return test.join(hours, "uniqueId").where("hour <> 0").select(
        F.col("y").cast("double").alias("fraudLabel"), "score", "uniqueId", "amount")


def online_scores(t: Tables) -> DataFrame:
    """The online side, imitated: test-set features as strings, with deliberate differences.

    Monday transactions are scored again an hour later with a slightly higher score, savings transactions
    have a shifted amount, and the last hour of each day is missing.
    """
    f = t.feature_sets().where("dataset = 'test' AND hour <> 23")
    event_id = F.col("uniqueId").cast("long")
    score = (F.col("fraudLabel") * 2500 + (event_id * 7919) % 7500) / F.lit(10000.0)
    shifted = F.when(F.col("accountTypeSavings") == 1, F.col("amount") + 0.02).otherwise(F.col("amount"))
    values = [shifted if c == "amount" else F.col(c) for c in schemas.FEATURES]
    rows = f.select(
        "fraudLabel", "uniqueId", "customerId", "sessionId", "timestamp",
        F.col("timestamp").alias("scoreTimestamp"), "action", "amount", F.lit("1.0").alias("modelId"),
        score.alias("score"), F.lit(", ".join(schemas.FEATURES)).alias("featureNamesStr"),
        F.concat_ws(", ", *[v.cast("string") for v in values]).alias("featureValuesStr"), "dayOfWeek")
    again = rows.where("dayOfWeek = 2").withColumn(
        "scoreTimestamp", F.col("scoreTimestamp") + F.expr("INTERVAL '1' HOUR")).withColumn(
        "score", F.col("score") + 0.001)
    return rows.unionByName(again).drop("dayOfWeek")


def parity_joined(t: Tables) -> DataFrame:
    from txnlens.operators import parity

    batch = parity.batch_scores(batch_scores(t), t.feature_sets().where("dataset = 'test'").drop("dataset"))
    lo, hi = SETS["test"]
    return parity.full_join(batch, parity.parse_features(parity.latest_scores(online_scores(t), lo, hi)))


# The fixture's label is a function of the login position alone, so the position is left out of the model.
MODEL_FEATURES = [f for f in schemas.FEATURES if f not in ("longitude", "latitude")]
_models: dict = {}


def model(t: Tables):
    """A boosted-tree classifier fitted on the training set, once per session and folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _models:
        from txnlens.operators import model as ML

        train = t.feature_sets().where("dataset = 'train'")
        _models[key] = ML.fit(train, MODEL_FEATURES, "fraudLabel", "GBTClassifier",
                              {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.1, "seed": 33})
    return _models[key]


def model_scores(t: Tables) -> DataFrame:
    """(dataset, uniqueId, amount, y, score) of the fitted model, stored: evaluations read it more than once."""
    from txnlens.operators import model as ML

    return t._once("model_scores", lambda: ML.score(
        model(t), t.feature_sets(), keep=("dataset", "uniqueId", "amount"), label="fraudLabel"))
