"""Registered queries over fitted models, files, tables and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens import schemas
from txnlens.functions import arrays as A
from txnlens.functions.output import rounded
from txnlens.operators import calibrate as CA
from txnlens.operators import evaluate as EV
from txnlens.operators import explain as EX
from txnlens.operators import features as FT
from txnlens.operators import model as ML
from txnlens.operators import parity as PV
from txnlens.operators import profile as PR
from txnlens.plans import oracle as O
from txnlens.plans import tables as T
from txnlens.plans.registry import SQL, register
from txnlens.sources import catalog, readers, writers
from txnlens.streaming import online as ON

# ---------------------------------------------------------------- models


@register("model_scores")
def model_scores(t):
    return T.model_scores(t)


@register("model_metrics")
def model_metrics(t):
    return EV.metrics_table(T.model_scores(t))


@register("model_rounds")
def model_rounds(t):
    return ML.round_metrics(T.model(t), t.feature_sets(), "fraudLabel")


@register("model_optimal_rounds")
def model_optimal_rounds(t):
    return ML.optimal_rounds(ML.round_metrics(T.model(t), t.feature_sets(), "fraudLabel"))


def _few():
    return ["distanceFromHome", "amount", "hour", "actionCount", "secondsToTransaction", "profileAmountZScore"]


@register("model_kinds")
def model_kinds(t):
    """Every kind of model fitted on the training set: mean score per set."""
    sets, parts = t.feature_sets(), []
    small = {"GBTClassifier": {"n_estimators": 3}, "GBTRegressor": {"n_estimators": 3}, "MLPClassifier": {"maxIter": 5},
             "RandomForestClassifier": {"n_estimators": 3}, "RandomForestRegressor": {"n_estimators": 3},
             "KMeans": {"k": 2}}
    for kind in ML.KINDS:
        m = ML.fit(sets.where("dataset = 'train'"), T.MODEL_FEATURES, "fraudLabel", kind, {**small.get(kind, {})})
        parts.append(ML.score(m, sets).groupBy("dataset").agg(F.avg("score").alias("mean_score"))
                     .withColumn("kind", F.lit(kind)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("model_tuning")
def model_tuning(t):
    """Grid search by folds and random search, 50 trials, on the fixed validation set: (search, setting, log_loss)."""
    sets = t.feature_sets()
    train, valid = sets.where("dataset = 'train'"), sets.where("dataset = 'validation'")
    _, grid = ML.tune(train, None, T.MODEL_FEATURES, "fraudLabel", ML.grid({"max_depth": [2, 3, 4]}), "DecisionTreeClassifier",
                      folds=2, n_jobs=4)
    space = {"max_depth": {"function": "quniform", "params": {"low": 2, "high": 6, "q": 1}},
             "min_child_weight": {"function": "choice", "params": {"options": [1, 5, 25, 100]}}}
    _, random = ML.tune(train, valid, T.MODEL_FEATURES, "fraudLabel", ML.draws(space, 50, 33), "DecisionTreeClassifier", n_jobs=4)
    rows = [(n, str(s), float(v)) for n, found in (("grid", grid), ("random", random)) for s, v in found]
    return t.spark.createDataFrame(rows, "search string, setting string, log_loss double")


@register("model_roundtrip")
def model_roundtrip(t):
    """Scores of the saved and reloaded model next to those of the fitted one."""
    path = f"{writers.scratch_root(t.spark)}/txnlens/model-{uuid.uuid4().hex}"
    ML.save(T.model(t), path)
    again = ML.score(ML.load(path), t.feature_sets(), keep=("uniqueId",), name="reloaded")
    return T.model_scores(t).select("uniqueId", "score").join(again, "uniqueId")


@register("tree_importance")
def tree_importance(t):
    return EX.tree_importance(T.model(t), T.MODEL_FEATURES, t.spark)


@register("permutation_importance")
def permutation_importance(t):
    return EX.permutation_importance(T.model(t), t.feature_sets(), T.MODEL_FEATURES, "fraudLabel", repeats=5,
                                     metrics=("roc_auc", "average_precision", "neg_log_loss"), seed=33)


@register("partial_dependence")
def partial_dependence(t):
    return EX.partial_dependence(T.model(t), t.feature_sets(), _few(), T.MODEL_FEATURES, points=20)


@register("shapley_summary")
def shapley_summary(t):
    return EX.shapley_summary(EX.shapley_values(T.model(t), t.feature_sets(), T.MODEL_FEATURES, permutations=2))


@register("hash_sample", O.query("SELECT uniqueId, dataset FROM scored_ ORDER BY md5('33|' || uniqueId) LIMIT 100"))
def hash_sample(t):
    return EX.hash_sample(t.scored(), 100, seed=33).select("uniqueId", "dataset")


# ---------------------------------------------------------------- calibration

_BINS5 = "(" + " + ".join(f"CASE WHEN score > {i} * CAST(0.2 AS DOUBLE) THEN 1 ELSE 0 END" for i in range(1, 5)) + ")"
_REL = ("SELECT dataset, CAST({b} AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n, round(avg(score), 6) AS prob_score, "
        "round(avg(CAST(y AS DOUBLE)), 6) AS prob_true FROM {f} GROUP BY dataset, {b}")


@register("reliability_curve", O.query(_REL.format(b=_BINS5, f="scored_")))
def reliability_curve(t):
    return rounded(CA.reliability_curve(t.scored()))


@register("reliability_curve_quantile", O.query(_REL.format(
    b="len(list_filter(q, lambda e: e < score))",
    f="scored_ JOIN (SELECT dataset, quantile_cont(score, [0.2, 0.4, 0.6, 0.8]) AS q FROM scored_ GROUP BY dataset) "
      "USING (dataset)")))
def reliability_curve_quantile(t):
    return rounded(CA.reliability_curve(t.scored(), "quantile"))


def _calibrator(t, kind):
    return CA.fit(T.model_scores(t).where("dataset = 'validation'"), kind)


for _kind in CA.TYPES:
    register(f"calibrate_{_kind}")(lambda t, k=_kind: CA.apply(_calibrator(t, k), T.model_scores(t)))
    register(f"calibration_mapping_{_kind}")(lambda t, k=_kind: CA.mapping_table(_calibrator(t, k), t.spark))
    register(f"calibrated_metrics_{_kind}")(
        lambda t, k=_kind: EV.metrics_table(CA.calibrated(_calibrator(t, k), T.model_scores(t))))


@register("calibration_curves")
def calibration_curves(t):
    return CA.compare_curves(_calibrator(t, "isotonic"), T.model_scores(t))


# ---------------------------------------------------------------- files and tables

def _scratch(t, label):
    return f"{writers.scratch_root(t.spark)}/txnlens/{label}-{uuid.uuid4().hex}"


@register("io_glob_load", O.query(
    "SELECT CAST(profileDate AS VARCHAR) AS profileDate, CAST(count(*) AS BIGINT) AS n, "
    "round(sum(amountAvg), 4) AS total FROM prof_ GROUP BY profileDate"))
def io_glob_load(t):
    """One NDJSON folder per snapshot, loaded back through a glob into one table."""
    path = _scratch(t, "profiles")
    rows = t.profile().withColumn("snapshot", F.col("profileDate").cast("string"))
    writers.write_parquet(rows, path + "/stage", partition_by=["snapshot"])
    for day in T.SNAPSHOTS:  # the schedule, not the data
        part = t.spark.read.parquet(f"{path}/stage").where(F.col("snapshot") == str(day)).drop("snapshot")
        writers.export(part, f"{path}/profile_{day}.json")
    loaded = readers.load(t.spark, f"{path}/profile_*.json", "JSON", schemas.PROFILE)
    return loaded.groupBy(F.col("profileDate").cast("string").alias("profileDate")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amountAvg"), 4).alias("total"))


@register("io_csv_scores", O.query(
    "SELECT dataset, CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS positives, round(sum(score), 4) AS total "
    "FROM scored_ GROUP BY dataset"))
def io_csv_scores(t):
    """Score export, one CSV folder per data set with a header row, and back under the declared schema."""
    path = _scratch(t, "scores")
    scored = t.scored().withColumnRenamed("y", "fraudLabel")
    writers.export_scores(scored, path, "fraudLabel", aux=("uniqueId", "amount"))
    loaded = readers.read_csv(t.spark, path + "/dataset=*", schemas.BATCH_SCORES)
    loaded = loaded.withColumn("dataset", F.regexp_extract(F.input_file_name(), "dataset=([a-z]+)", 1))
    return loaded.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.sum("fraudLabel").cast("long").alias("positives"),
                                         F.round(F.sum("score"), 4).alias("total"))


@register("io_partitioned_profile", O.query(
    "SELECT CAST(profileDate AS VARCHAR) AS profileDate, CAST(count(*) AS BIGINT) AS n FROM prof_ GROUP BY profileDate"))
def io_partitioned_profile(t):
    """Profiles partitioned by date and clustered by customer inside a partition."""
    path = _scratch(t, "profile")
    writers.write_parquet(t.profile(), path, partition_by=["profileDate"], cluster_by=["profileDate", "customerId"])
    stored = t.spark.read.parquet(path)
    return stored.groupBy(F.col("profileDate").cast("string").alias("profileDate")).agg(F.count(F.lit(1)).alias("n"))


@register("io_tables", O.query(
    "SELECT 'truncated' AS step, CAST(count(*) AS BIGINT) AS n, 0::BIGINT AS with_channel FROM tx_ UNION ALL "
    "SELECT 'appended', 2 * count(*), 0 FROM tx_ UNION ALL "
    "SELECT 'relaxed', 3 * count(*), count(*) FROM tx_ UNION ALL "
    "SELECT 'copied', 3 * count(*), count(*) FROM tx_"))
def io_tables(t):
    """Write dispositions, an append that brings a column, and a copy, in a database of its own."""
    spark, db = t.spark, f"txnlens_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{_scratch(t, 'database')}'")
    name, rows = f"{db}.transactions", t.transactions().select("uniqueId", "customerId", "amount")

    def state(step, table):
        df = spark.table(table)
        with_channel = F.count("channel") if "channel" in df.columns else F.lit(0).cast("long")
        n, c = df.agg(F.count(F.lit(1)), with_channel).first()
        return step, n, c

    catalog.create_table(spark, name, rows.schema)
    writers.write_table(rows, name, "EMPTY")
    writers.write_table(rows, name, "TRUNCATE")
    steps = [state("truncated", name)]
    writers.write_table(rows, name, "APPEND")
    steps.append(state("appended", name))
    writers.write_table(rows.withColumn("channel", F.lit("web")), name, "APPEND", relax_schema=True)
    steps.append(state("relaxed", name))
    catalog.copy_table(spark, name, f"{db}.copied")
    steps.append(state("copied", f"{db}.copied"))
    catalog.drop_database(spark, db, contents=True)
    return spark.createDataFrame(steps, "step string, n long, with_channel long")


@register("query_to_table", O.query(
    "SELECT customerId, CAST(count(*) AS BIGINT) AS n, round(sum(amount), 4) AS total FROM tx_ "
    "WHERE day >= DATE '2024-01-08' AND day < DATE '2024-01-22' GROUP BY customerId"))
def query_to_table(t):
    """Parameterised SQL over a stored table."""
    t.transactions().createOrReplaceTempView("txnlens_transactions")
    lo, hi = T.SETS["train"]
    return catalog.run_query(
        t.spark, "SELECT customerId, count(*) AS n, round(sum(amount), 4) AS total FROM txnlens_transactions "
                 "WHERE date >= :start AND date < :end GROUP BY customerId", {"start": lo, "end": hi})


@register("train_validation_fold", O.query(
    "SELECT CAST(CASE dataset WHEN 'train' THEN -1 ELSE 0 END AS BIGINT) AS fold, CAST(count(*) AS BIGINT) AS n FROM scored_ "
    "WHERE dataset IN ('train', 'validation') GROUP BY 1"))
def train_validation_fold(t):
    """Training and validation rows together, marked -1 and 0."""
    both = FT.split_sets(t.transactions(), {k: T.SETS[k] for k in ("train", "validation")})
    return both.groupBy(F.when(F.col("dataset") == "train", -1).otherwise(0).cast("long").alias("fold")).agg(
        F.count(F.lit(1)).alias("n"))


@register("profile_nested", O.query(
    "SELECT CAST(profileDate AS VARCHAR) AS profileDate, customerId, CAST(count(*) AS BIGINT) AS recipients, "
    "CAST(sum(txnCnt) AS BIGINT) AS txns FROM recip_ GROUP BY profileDate, customerId"))
def profile_nested(t):
    """Recipients nested per customer and snapshot, measured through the array."""
    nested = PR.nest_recipients(t.recipients())
    total = F.aggregate("recipients", F.lit(0).cast("long"), lambda acc, r: acc + r["txnCnt"])
    return rounded(nested.groupBy("profileDate", "customerId").agg(
        F.sum(F.size("recipients")).alias("recipients"), F.sum(total).alias("txns")))


@register("profile_nested_join", O.query(
    "SELECT CAST(p.profileDate AS VARCHAR) AS profileDate, p.customerId, CAST(p.distinctRecipientCount AS BIGINT) AS known, "
    "CAST(count(r.recipient) AS BIGINT) AS recipients, CAST(sum(r.txnCnt) AS BIGINT) AS txns, "
    "strftime(min(r.minTimestamp), '%Y-%m-%d %H:%M:%S') AS first_seen FROM prof_ p LEFT JOIN recip_ r ON r.profileDate = p.profileDate "
    "AND r.customerId = p.customerId GROUP BY ALL"))
def profile_nested_join(t):
    """Profiles next to their recipients, in arrays of at most five so that some customers have several."""
    out = PR.profile(t.transactions(), t.calendar(), t.recipients(), nested=True, chunk_rows=5)
    txns = F.aggregate("recipients", F.lit(0).cast("long"), lambda acc, r: acc + r["txnCnt"])
    known = A.count_where(F.col("recipients"), lambda r: r["recipient"].isNotNull())
    found = out.groupBy("profileDate", "customerId", F.col("distinctRecipientCount").alias("known")).agg(
        F.sum(known).alias("recipients"), F.sum(txns).alias("txns"),
        F.min(F.array_min(F.transform("recipients", lambda r: r["minTimestamp"]))).alias("first_seen"))
    return rounded(found.withColumn("first_seen", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss")))


# ---------------------------------------------------------------- streams

def _run_stream(t) -> DataFrame:
    """Replay the events, compute features online, and return what the sink wrote."""
    ON.use_rocksdb(t.spark)
    path = _scratch(t, "stream")
    files = ON.publish(t.events(), f"{path}/in")
    # a time slice is half a month, so the watermark allows for that much disorder between files
    stream = ON.with_event_time(ON.replay(t.spark, f"{path}/in", max(4, -(-files // ON.BATCHES))), "20 days")
    tx = ON.online_transactions(stream)
    features = ON.online_features(tx, t.profile(), t.recipients(), t.customer_info(),
                                  ON.snapshot_list(t.profile(), T.PROFILE_END))
    query = (features.writeStream.format("parquet").option("path", f"{path}/out")
             .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return t.spark.read.parquet(f"{path}/out")


@register("stream_features", SQL["features_all"])
def stream_features(t):
    """The same 106 features from the streaming path."""
    return rounded(_run_stream(t).select(*schemas.ID_FIELDS, *schemas.FEATURES))


@register("stream_scores")
def stream_scores(t):
    """Online scoring of stored features as a stream to NDJSON, then the newest score per transaction."""
    path = _scratch(t, "score-events")
    features = t.features()
    writers.write_parquet(features, f"{path}/in")
    stream = t.spark.readStream.schema(features.schema).parquet(f"{path}/in")
    events = ON.score_events(stream, T.model(t), "1.0", T.MODEL_FEATURES)
    ON.sink_json(events, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    stored = readers.read_json(t.spark, f"{path}/out", schemas.ONLINE_SCORES)
    return PV.latest_scores(stored).select("uniqueId", "fraudLabel", "modelId", "score")


@register("stream_first_scores", O.query("SELECT uniqueId FROM scored_"))
def stream_first_scores(t):
    """Every transaction scored twice on the stream; the first score within the watermark is kept."""
    path = _scratch(t, "repeats")
    scored = t.scored().select("uniqueId", "score").join(t.transactions().select("uniqueId", "timestamp"), "uniqueId")
    writers.write_parquet(scored.unionByName(scored), f"{path}/in")
    stream = t.spark.readStream.schema(scored.schema).parquet(f"{path}/in")
    kept = ON.first_scores(stream, "60 days").select("uniqueId")
    query = (kept.writeStream.format("parquet").option("path", f"{path}/out")
             .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return t.spark.read.schema("uniqueId string").parquet(f"{path}/out")
