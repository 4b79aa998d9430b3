"""Registered queries: name -> function of (spark, sf_dir), with SQL where the result can be checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from txnlens import schemas
from txnlens.functions import arrays as A
from txnlens.functions.output import rounded
from txnlens.functions.scalars import amount_mod, or_default
from txnlens.operators import evaluate as EV
from txnlens.operators import features as FT
from txnlens.operators import monitor as MO
from txnlens.operators import parity as PV
from txnlens.operators import profile as PR
from txnlens.operators import sessions as SE
from txnlens.plans import oracle as O
from txnlens.plans import tables as T
from txnlens.plans.tables import Tables
from txnlens.sources import readers, writers

QUERIES: dict = {}
SQL: dict = {}
SET_NAMES = list(T.SETS)
YEARS = ["1995", "1996", "1997", "1998", "1999", "2000", "2001"]


def register(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql
        return build
    return add


def _count(expr, name):
    return f"CAST({expr} AS BIGINT) AS {name}"


# ---------------------------------------------------------------- events, sessions, features

_EVENT_COLS = "fraudLabel, uniqueId, customerId, sessionId, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, action, "
_EVENT_REST = "accountType, recipient"


def _event_view(df):
    return rounded(df.withColumn("seconds", F.unix_timestamp("timestamp")).select(
        "fraudLabel", "uniqueId", "customerId", "sessionId", "seconds", "action", "longitude", "latitude",
        "amount", "accountType", "recipient"))


_EVENTS_SQL = O.query("SELECT " + _count("fraudLabel", "fraudLabel") + ", uniqueId, customerId, sessionId, "
                      "CAST(floor(epoch(ts)) AS BIGINT) AS seconds, action, "
                      + ", ".join(O.r6(c, c) for c in ("longitude", "latitude", "amount"))
                      + ", accountType, recipient FROM ev_")


@register("events_deduped", _EVENTS_SQL)
def events_deduped(t):
    # every event twice, so the dedupe has work on each id
    return _event_view(SE.dedupe(t.events().unionByName(t.events())))


def _as_json_lines(df):
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


@register("io_events_roundtrip", _EVENTS_SQL)
def io_events_roundtrip(t):
    """Events out as NDJSON (absent keys for NULL) and back under the declared schema."""
    path = f"{writers.scratch_root(t.spark)}/txnlens/ndjson-{writers.uuid.uuid4().hex}"
    writers.export(t.events(), path, "json")
    return _event_view(readers.read_json(t.spark, path, schemas.EVENTS))


@register("io_bad_records", O.query(
    "SELECT CAST(count(*) FILTER (WHERE action <> 'login') AS BIGINT) AS readable, "
    "CAST(count(*) FILTER (WHERE action = 'login') AS BIGINT) AS unreadable FROM ev_"))
def io_bad_records(t):
    """Login lines lose their closing brace; a read whose budget is the number of logins leaves them out."""
    events = t.events()
    lines = events.select(F.to_json(F.struct(*events.columns)).alias("value"), "action")
    cut = F.when(F.col("action") == "login", F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    path = f"{writers.scratch_root(t.spark)}/txnlens/broken-{writers.uuid.uuid4().hex}"
    lines.select(cut.alias("value")).write.text(path)
    budget = events.where("action = 'login'").count()
    good = readers.read_json(t.spark, path, schemas.EVENTS, max_bad_records=budget)
    total = t.spark.read.text(path).agg(F.count(F.lit(1)).alias("n"))
    return good.agg(F.count(F.lit(1)).alias("readable")).crossJoin(total).select(
        "readable", (F.col("n") - F.col("readable")).alias("unreadable"))


@register("io_schema_evolution", O.query(
    "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(channel) AS BIGINT) AS with_channel, "
    "CAST(count(recipient) AS BIGINT) AS with_recipient FROM ("
    "SELECT uniqueId, recipient, NULL AS channel FROM ev_ UNION ALL "
    "SELECT uniqueId, NULL AS recipient, 'web' AS channel FROM ev_)"))
def io_schema_evolution(t):
    """Append rows that bring a column and lack another."""
    old = t.events().select("uniqueId", "recipient")
    new = t.events().select("uniqueId", F.lit("web").alias("channel"))
    return writers.append_relaxed(old, new).agg(
        F.count(F.lit(1)).alias("n"), F.count("channel").alias("with_channel"),
        F.count("recipient").alias("with_recipient"))


@register("transactions_flat", O.query(
    "SELECT " + _count("fraudLabel", "fraudLabel") + ", uniqueId, customerId, sessionId, "
    "CAST(day AS VARCHAR) AS date, " + O.r6("lon", "longitude") + ", " + O.r6("lat", "latitude")
    + ", " + O.r6("amount", "amount") + ", accountType, recipient FROM tx_"))
def transactions_flat(t):
    return rounded(SE.transactions(t.events()).select(
        "fraudLabel", "uniqueId", "customerId", "sessionId", "date", "longitude", "latitude", "amount",
        "accountType", "recipient"))


_NESTED_SQL = """SELECT uniqueId, CAST(actionCount AS BIGINT) AS session_size, CAST(transactionCount AS BIGINT) AS transactions,
  {amount}, {largest}, CAST(distinctRecipientCount AS BIGINT) AS recipients,
  uniqueId AS last_event, first_event
FROM tx_ JOIN (SELECT uniqueId AS id_, first_value(uniqueId) OVER (PARTITION BY sessionId ORDER BY ts, uniqueId)
               AS first_event FROM ev_) ON id_ = uniqueId"""


@register("session_nested", O.query(_NESTED_SQL.format(amount=O.r6("amountSum", "amount_sum"), largest=O.r6("amountMax", "amount_max"))))
def session_nested(t):
    """What the features read of a session, taken from the nested arrays themselves."""
    s, txn = F.col("session"), lambda e: e["action"] == "transaction"
    return rounded(SE.nested_transactions(t.events()).select(
        "uniqueId", F.size(s).cast("long").alias("session_size"), A.count_where(s, txn).alias("transactions"),
        A.sum_where(s, "amount", txn).alias("amount_sum"), A.max_where(s, "amount", txn).alias("amount_max"),
        A.distinct_where(s, "recipient", txn).alias("recipients"), A.element(s, -1)["uniqueId"].alias("last_event"),
        A.element(s, 1)["uniqueId"].alias("first_event")))


@register("session_chunks", O.query("""
SELECT sessionId, CAST(chunk AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS events,
  string_agg(uniqueId, ',' ORDER BY ts, uniqueId) AS ids
FROM (SELECT *, (row_number() OVER (PARTITION BY sessionId ORDER BY ts, uniqueId) - 1) // 4 AS chunk FROM ev_) GROUP BY sessionId, chunk"""))
def session_chunks(t):
    """Sessions as numbered arrays, here of four events so that most sessions have several."""
    chunks = SE.session_chunks(SE.numbered_events(t.events()), chunk_rows=4)
    ids = F.array_join(F.transform("entries", lambda e: e["uniqueId"]), ",")
    return chunks.select("sessionId", "chunk", F.size("entries").cast("long").alias("events"), ids.alias("ids"))


@register("session_array_sizes", O.query("SELECT uniqueId, " + _count("actionCount", "session_size") + " FROM tx_"))
def session_array_sizes(t):
    return SE.transactions(t.events()).select("uniqueId", F.col("actionCount").alias("session_size"))


def _tx_features(names):
    def build(t):
        return rounded(FT.features_txn(SE.transactions(t.events())).select("uniqueId", *names))
    return build


def _tx_sql(names):
    return O.query(f"SELECT uniqueId, {O.feature_list(names)} FROM tx_ t")


_ACTION_COUNTS = ["transactionCount", *[f"action{i}Count" for i in range(10)], "actionCount"]
_AMOUNTS = ["amountSum", "amountAvg", "amountMin", "amountMax"]
_RECIPIENTS = ["recipientTransactionCount", "distinctRecipientCount", "repeatedRecipientCount"]
_MODS = [f"amountMod{m}" for m in schemas.AMOUNT_MODULI]
for _name, _cols in {"session_action_counts": _ACTION_COUNTS, "session_amount_stats": _AMOUNTS,
                     "session_recipients": _RECIPIENTS, "txn_time_parts": ["hour", "dayOfWeek", "dayOfMonth"]}.items():
    register(_name, _tx_sql(_cols))(_tx_features(_cols))


@register("amount_mods", O.query(
    "SELECT uniqueId, " + ", ".join(O.r6(O.EXPRS[m], m) for m in _MODS) + " FROM ev_ t WHERE action = 'transaction'"))
def amount_mods(t):
    tx = t.events().where(SE.is_txn())
    return rounded(tx.select("uniqueId", *[
        or_default(amount_mod("amount", m), -1.0).alias(f"amountMod{m}") for m in schemas.AMOUNT_MODULI]))


_IDS = "CAST(coalesce(t.fraudLabel, 0) AS BIGINT) AS fraudLabel, t.uniqueId, t.customerId, t.sessionId, " \
       "CAST(floor(epoch(t.ts)) AS BIGINT) AS timestamp, CAST(t.day AS VARCHAR) AS date, t.action"


@register("features_txn", O.query(f"SELECT {_IDS}, {O.feature_list(schemas.TXN_FEATURES)} FROM tx_ t"))
def features_txn(t):
    return rounded(FT.features_txn(SE.transactions(t.events())))


# ---------------------------------------------------------------- profiles

def _prof_sql(names, whole=()):
    cols = ", ".join(_count(n, n) if n in whole else O.r6(n, n) for n in names)
    return O.query(f"SELECT CAST(profileDate AS VARCHAR) AS profileDate, customerId, {cols} FROM prof_")


_AMOUNT_NAMES = ["amountMin", "amountMax", "amountAvg", "amountStd"] + [
    f"amountPercentile{p}" for p in schemas.PERCENTILES]
_STAT_NAMES = ["meanSecondsToTransaction", "stdSecondsToTransaction"] + [
    f"{s}{n}" for n, _ in schemas.SESSION_ACTION_STATS + schemas.SESSION_TXN_STATS for s in ("mean", "std")]


@register("profile_amounts", _prof_sql(_AMOUNT_NAMES))
def profile_amounts(t):
    return rounded(PR.profile_amounts(t.transactions(), t.calendar()))


@register("profile_session_stats", _prof_sql(_STAT_NAMES))
def profile_session_stats(t):
    return rounded(PR.profile_session_stats(t.transactions(), t.calendar()))


@register("profile_counts", _prof_sql(["sessionCount", "transactionCount"], {"sessionCount", "transactionCount"}))
def profile_counts(t):
    return rounded(PR.profile_counts(t.transactions(), t.calendar()))


@register("profile_recipients", O.query(
    "SELECT CAST(profileDate AS VARCHAR) AS profileDate, customerId, recipient, " + _count("txnCnt", "txnCnt")
    + ", CAST(floor(epoch(minTimestamp)) AS BIGINT) AS minTimestamp FROM recip_"))
def profile_recipients(t):
    return rounded(PR.profile_recipients(t.transactions(), t.calendar()))


@register("profile_customer_orders",
          "SELECT o_custkey, min(o_totalprice) AS lowest, max(o_totalprice) AS highest, "
          "round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std, "
          "quantile_disc(o_totalprice, 0.5) AS median, count(*) AS n FROM orders GROUP BY o_custkey")
def profile_customer_orders(t):
    """The amount statistics over another fact table."""
    return t.raw("orders").groupBy("o_custkey").agg(
        F.min("o_totalprice").alias("lowest"), F.max("o_totalprice").alias("highest"),
        F.round(F.avg("o_totalprice"), 6).alias("mean"), F.round(F.stddev_samp("o_totalprice"), 6).alias("std"),
        F.percentile_approx("o_totalprice", 0.5, PR.QUANTILE_ACCURACY).alias("median"),
        F.count(F.lit(1)).alias("n"))


@register("asof_profile_date", O.query("SELECT uniqueId, CAST(profileDate AS VARCHAR) AS profileDate FROM dated_"))
def asof_profile_date(t):
    return rounded(FT.asof_profile_date(t.transactions(), t.profile(), T.PROFILE_END).select("uniqueId", "profileDate"))


@register("recipient_lookup", O.query(
    "SELECT t.uniqueId, CAST(coalesce(r.txnCnt, 0) AS BIGINT) AS txnCnt FROM dated_ t LEFT JOIN recip_ r "
    "ON t.customerId = r.customerId AND t.profileDate = r.profileDate AND t.recipient = r.recipient"))
def recipient_lookup(t):
    joined = FT.join_profile(t.transactions(), t.profile(), t.recipients(), snapshots=t.snapshots())
    return joined.select("uniqueId", or_default("p_recipientTxnCnt", 0).alias("txnCnt"))


def _joined_sql(names):
    return O.query(f"SELECT t.uniqueId, {O.feature_list(names)} {O._JOINED}")


@register("features_profile", _joined_sql(schemas.PROFILE_FEATURES))
def features_profile(t):
    return rounded(FT.features_profile(t.transactions(), t.profile(), t.recipients(), snapshots=t.snapshots()))


_ZSCORES = [n for n in schemas.PROFILE_FEATURES if n.endswith("ZScore")]


@register("profile_zscores", _joined_sql(_ZSCORES))
def profile_zscores(t):
    return rounded(FT.features_profile(t.transactions(), t.profile(), t.recipients(), snapshots=t.snapshots())
                   .select("uniqueId", *_ZSCORES))


@register("features_cust_info", O.query(
    f"SELECT t.uniqueId, {O.feature_list(schemas.CUSTOMER_FEATURES)} FROM tx_ t "
    "LEFT JOIN cust_ c ON t.customerId = c.customerId"))
def features_cust_info(t):
    return rounded(FT.features_cust_info(t.transactions(), t.customer_info()))


@register("features_all", O.query(f"SELECT {_IDS}, {O.feature_list(schemas.FEATURES)} {O._JOINED}"))
def features_all(t):
    """The flagship: all 106 features from events and customer records."""
    return rounded(t.build_features())


@register("split_counts", O.query(
    "SELECT dataset, CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS positives FROM scored_ GROUP BY dataset"))
def split_counts(t):
    return FT.split_sets(t.transactions(), T.SETS).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fraudLabel").alias("positives"))


# ---------------------------------------------------------------- parity

@register("parity_batch_scores", O.query(
    "SELECT uniqueId, round(score, 6) AS score, " + ", ".join(
        _count(n, n) if n in O.WHOLE else O.r6(n, n) for n in schemas.FEATURES) + " FROM batch_"))
def parity_batch_scores(t):
    test = t.feature_sets().where("dataset = 'test'").drop("dataset")
    return rounded(PV.batch_scores(T.batch_scores(t), test).select("uniqueId", "score", *schemas.FEATURES))


@register("latest_scores", O.query(
    "SELECT uniqueId, round(score_df, 6) AS score, CAST(floor(epoch(scoreTimestamp)) AS BIGINT) AS scoreTimestamp FROM online_"))
def latest_scores(t):
    lo, hi = T.SETS["test"]
    return rounded(PV.latest_scores(T.online_scores(t), lo, hi).select("uniqueId", "score", "scoreTimestamp"))


@register("parse_feature_string", O.query(
    "SELECT uniqueId, round(score_df, 6) AS score_df, " + ", ".join(
        O.r6(f"{c}_df", f"{c}_df") for c in schemas.FEATURES) + " FROM online_"))
def parse_feature_string(t):
    parsed = PV.parse_features(PV.latest_scores(T.online_scores(t)))
    return rounded(parsed.select("uniqueId", "score_df", *[f"{c}_df" for c in schemas.FEATURES]))


@register("parity_full_join", O.query(
    "SELECT b_id AS uniqueId, round(score, 6) AS score, round(score_df, 6) AS score_df, "
    "round(amount, 6) AS amount, round(amount_df, 6) AS amount_df, round(CAST(age AS DOUBLE), 6) AS age, "
    "round(age_df, 6) AS age_df FROM both_"))
def parity_full_join(t):
    return rounded(T.parity_joined(t).select("uniqueId", "score", "score_df", "amount", "amount_df",
                                             F.col("age").cast("double").alias("age"), "age_df"))


@register("join_rates", O.query(
    "SELECT round(1 - count(*) FILTER (WHERE score_df IS NULL) / CAST(count(score) AS DOUBLE), 6) AS batch_join_rate, "
    "round(1 - count(*) FILTER (WHERE score IS NULL) / CAST(count(score_df) AS DOUBLE), 6) AS online_join_rate FROM both_"))
def join_rates(t):
    return rounded(PV.join_rates(T.parity_joined(t)))


@register("feature_mismatch", O.query(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(count(*) FILTER (WHERE abs({c} - {c}_df) > 0.01) / CAST(count(*) AS DOUBLE), 6) "
    "AS mismatch_rate FROM both_" for c in schemas.FEATURES)))
def feature_mismatch(t):
    return rounded(PV.feature_mismatch(T.parity_joined(t)))


@register("score_diff_quantiles", O.query(
    "SELECT CAST(i AS BIGINT) AS position, round(q[i + 1], 6) AS quantile FROM (SELECT quantile_disc(abs(score - score_df), ["
    + ", ".join(str(i / 100) for i in range(101)) + "]) AS q FROM both_), range(0, 101) r(i)"))
def score_diff_quantiles(t):
    return rounded(PV.score_diff_quantiles(T.parity_joined(t)))


# ---------------------------------------------------------------- evaluation

@register("pr_curve", O.query(
    "SELECT dataset, score AS threshold, round(tp / CAST(tp + fp AS DOUBLE), 6) AS precision, "
    "round(tp / CAST(P AS DOUBLE), 6) AS recall FROM cum_ UNION ALL "
    "SELECT DISTINCT dataset, NULL, 1.0, 0.0 FROM cum_"))
def pr_curve(t):
    return rounded(EV.pr_curve(t.scored()))


@register("roc_curve", O.query(
    "SELECT dataset, score AS threshold, round(fp / CAST(N AS DOUBLE), 6) AS fpr, "
    "round(tp / CAST(P AS DOUBLE), 6) AS tpr FROM cum_ UNION ALL SELECT DISTINCT dataset, NULL, 0.0, 0.0 FROM cum_"))
def roc_curve(t):
    return rounded(EV.roc_curve(t.scored()))


@register("det_curve", O.query(
    "SELECT c.dataset, c.score AS threshold, round(fp / CAST(N AS DOUBLE), 6) AS fpr, "
    "round((P - tp) / CAST(P AS DOUBLE), 6) AS fnr FROM cum_ c JOIN ("
    "SELECT a.dataset, min(a.score) FILTER (WHERE a.fp = f.fp0) AS hi, max(a.score) FILTER (WHERE a.tp = a.P) AS lo "
    "FROM cum_ a JOIN (SELECT dataset, min(fp) AS fp0 FROM cum_ GROUP BY dataset) f USING (dataset) GROUP BY a.dataset) e "
    "USING (dataset) WHERE c.score BETWEEN e.lo AND e.hi"))
def det_curve(t):
    return rounded(EV.det_curve(t.scored()))


_PER_SET = {"roc_auc": ("roc_auc", "auc_"), "pr_auc": ("pr_auc", "prsum_"),
            "average_precision": ("average_precision", "prsum_"), "cap_ratio": ("accuracy_ratio", "cap_")}
for _name, (_col, _cte) in _PER_SET.items():
    register(_name, O.query(f"SELECT dataset, {O.r6(_col, _col)} FROM {_cte}"))(
        lambda t, c=_col: rounded(EV.curve_metrics(t.scored()).select("dataset", c)))


@register("cap_curve", O.query(
    "SELECT DISTINCT dataset, CAST(events AS BIGINT) AS events, CAST(positives AS BIGINT) AS positives FROM ("
    "SELECT dataset, fp - neg + tp AS events, tp AS positives FROM cum_ UNION ALL "
    "SELECT dataset, fp + tp, tp FROM cum_ UNION ALL SELECT dataset, 0, 0 FROM cum_)"))
def cap_curve(t):
    return rounded(EV.cap_curve(t.scored()))


@register("score_histogram", O.query(
    "SELECT dataset, CAST(y AS BIGINT) AS y, CAST(bin AS BIGINT) AS bin, round(bin * 0.02, 6) AS lower, "
    "CAST(count(*) AS BIGINT) AS n, round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY dataset, y) AS DOUBLE), 6) AS share "
    "FROM (SELECT dataset, y, least(len(list_filter(range(1, 51), lambda i: score >= i * CAST(0.02 AS DOUBLE))), 49) AS bin "
    "FROM scored_) GROUP BY dataset, y, bin"))
def score_histogram(t):
    return rounded(EV.score_histogram(t.scored()))


_THR = """SELECT g.dataset, g.i, count(s.score) FILTER (WHERE s.y = 1 AND up) AS tp, count(s.score) FILTER (WHERE s.y = 0 AND up) AS fp,
  count(s.score) FILTER (WHERE s.y = 1 AND NOT up) AS fn, count(s.score) FILTER (WHERE s.y = 0 AND NOT up) AS tn,
  sum(s.amount) FILTER (WHERE s.y = 1 AND up) AS a, sum(s.amount) FILTER (WHERE s.y = 1) AS a_all
FROM (SELECT * FROM (SELECT DISTINCT dataset FROM scored_), range(0, 100) r(i)) g
JOIN (SELECT *, unnest(range(0, 100)) AS i,
        score >= (unnest(range(0, 100)) - 1) * CAST(0.01 AS DOUBLE) + CAST(0.01 AS DOUBLE) AS up FROM scored_) s
  ON g.dataset = s.dataset AND g.i = s.i GROUP BY g.dataset, g.i"""


@register("threshold_table", O.query(
    "SELECT dataset, round(i * 0.01, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, "
    "CAST(tn AS BIGINT) AS tn, round(coalesce(a, 0), 6) AS amount_tp_sum, "
    "round(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 6) AS precision, round(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 6) AS recall, "
    "CASE WHEN tp = 0 AND fp > 0 THEN CAST('Infinity' AS DOUBLE) ELSE round(CAST(fp AS DOUBLE) / nullif(tp, 0), 6) END AS fp_to_tp, "
    "round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 6) AS accuracy, "
    "round(2.0 * CAST(tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 6) AS F1, "
    "round(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 6) AS specificity, "
    "round(1 - CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 6) AS fpr, "
    "round(coalesce(a, 0) / a_all, 6) AS amount_weighted_recall FROM thr_", {"thr_": _THR}))
def threshold_table(t):
    return rounded(EV.threshold_table(t.scored(), 0.01, aux=["amount"]))


@register("metrics_table", O.query(" UNION ALL ".join(
    f"SELECT dataset, '{title}' AS Metric, round({col}, 6) AS Value FROM {cte}" for title, col, cte in [
        ("ROC AUC", "roc_auc", "auc_"), ("Precision Recall AUC", "pr_auc", "prsum_"),
        ("Average Precision", "average_precision", "prsum_"), ("Accuracy Ratio", "accuracy_ratio", "cap_"),
        ("Log Loss (Cross Entropy)", "log_loss", "loss_"), ("Brier Score Loss", "brier_loss", "loss_")])))
def metrics_table(t):
    return rounded(EV.metrics_table(t.scored()))


@register("ks_statistic", O.query(
    "SELECT dataset, round(max(abs(tp / CAST(P AS DOUBLE) - fp / CAST(N AS DOUBLE))), 6) AS ks, "
    "CAST(any_value(N) AS BIGINT) AS n0, CAST(any_value(P) AS BIGINT) AS n1 FROM cum_ GROUP BY dataset"))
def ks_statistic(t):
    return rounded(EV.curve_metrics(t.scored()).select(
        "dataset", "ks", F.col("negatives").alias("n0"), F.col("positives").alias("n1")))


_KS_LAMBDA = "ks * sqrt(CAST(n0 AS DOUBLE) * n1 / (CAST(n0 AS DOUBLE) + n1))"


@register("ks_p_values", O.query(
    f"SELECT dataset, round(ks, 6) AS ks, n0, n1, round(CASE WHEN {_KS_LAMBDA} < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, 2 * list_sum("
    f"list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * k * k * pow({_KS_LAMBDA}, 2)))))) END, 6) "
    "AS p_value FROM (SELECT dataset, max(abs(tp / CAST(P AS DOUBLE) - fp / CAST(N AS DOUBLE))) AS ks, "
    "CAST(any_value(N) AS BIGINT) AS n0, CAST(any_value(P) AS BIGINT) AS n1 FROM cum_ GROUP BY dataset)"))
def ks_p_values(t):
    return rounded(EV.ks_statistic(t.scored()))


# ---------------------------------------------------------------- monitoring

def _lines(t):
    return t.raw("lineitem").select(
        F.year("l_shipdate").cast("string").alias("dataset"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("label"), *O.LINE_FEATURES)


_PSI_SELECT = "SELECT dataset1, dataset2, round(csi, 6) AS psi FROM csi_"
_CSI_SELECT = "SELECT dataset1, dataset2, feature, round(csi, 6) AS csi FROM csi_"
for _suffix, _legacy in (("", False), ("_legacy", True)):
    register(f"psi{_suffix}", O.query(_PSI_SELECT, O.csi_ctes("sval_", SET_NAMES, legacy=_legacy)))(
        lambda t, lg=_legacy: rounded(MO.psi(t.scored(), SET_NAMES, legacy=lg)))
    register(f"psi_quantiles{_suffix}", O.query(
        _PSI_SELECT, O.csi_ctes("sval_", SET_NAMES, "quantiles", _legacy)))(
        lambda t, lg=_legacy: rounded(MO.psi(t.scored(), SET_NAMES, bin_type="quantiles", legacy=lg)))
    register(f"csi_long{_suffix}", O.query(_CSI_SELECT, O.csi_ctes("lval_", YEARS, legacy=_legacy)))(
        lambda t, lg=_legacy: rounded(MO.csi_long(_lines(t), O.LINE_FEATURES, YEARS, legacy=lg)))


@register("csi_wide", O.query(
    "SELECT feature, " + ", ".join(
        f"round(max(csi) FILTER (WHERE dataset1 = '{a}' AND dataset2 = '{b}'), 6) AS \"{a}-{b}\""
        for a, b in MO.combinations(YEARS, 2)) + " FROM csi_ GROUP BY feature", O.csi_ctes("lval_", YEARS)))
def csi_wide(t):
    return rounded(MO.csi_wide(MO.csi_long(_lines(t), O.LINE_FEATURES, YEARS), O.LINE_FEATURES, YEARS))


@register("csi_features", O.query(
    "SELECT p.d1 AS dataset1, p.d2 AS dataset2, p.feature, round(coalesce(c.csi, 0), 6) AS csi FROM pe_ p LEFT JOIN csi_ c "
    "ON c.dataset1 = p.d1 AND c.dataset2 = p.d2 AND c.feature = p.feature", O.csi_ctes("fval_", SET_NAMES, legacy=True)))
def csi_features(t):
    """All 106 features between the three out-of-time sets, largest first."""
    return rounded(MO.csi_long(t.feature_sets(), schemas.FEATURES, SET_NAMES, legacy=True).orderBy(
        F.desc("csi"), "feature", "dataset1", "dataset2"))


_BIN_SELECT = ("SELECT dataset, feature, bin, round(lower, 6) AS lower, round(upper, 6) AS upper, "
               "CAST(cnt_0 + cnt_1 AS BIGINT) AS n FROM bc_")
for _name, _type in (("bins_fixed", "fixed"), ("bins_quantile", "quantiles")):
    register(_name, O.query(_BIN_SELECT, O.bin_ctes("lval_", _type)))(
        lambda t, ty=_type: _bin_table(t, ty))


def _bin_table(t, bin_type):
    grid, counts = MO.bin_table(_lines(t), O.LINE_FEATURES, bin_type)
    out = grid.join(counts, ["cell", "bin"], "left").fillna(0, ["n"])
    return rounded(out.select("dataset", "feature", "bin", "lower", "upper", "n"))


_WOE_SELECT = ("SELECT dataset, feature, bin, round(lower, 6) AS lower, round(upper, 6) AS upper, CAST(cnt_0 AS BIGINT) AS cnt_0, "
               "CAST(cnt_1 AS BIGINT) AS cnt_1, round(pct_0, 6) AS pct_0, round(pct_1, 6) AS pct_1, "
               "CASE WHEN isinf(woe) THEN woe ELSE round(woe, 6) END AS woe, round(adj_woe, 6) AS adj_woe FROM woe_")
_IV_SELECT = ("SELECT dataset, feature, round(sum(woe * (pct_1 - pct_0)), 6) AS iv, "
              "round(sum(adj_woe * (pct_1 - pct_0)), 6) AS adj_iv FROM woe_ GROUP BY dataset, feature")
for _suffix, _legacy in (("", False), ("_legacy", True)):
    _ctes = O.bin_ctes("lval_", "quantiles", _legacy)
    register(f"woe{_suffix}", O.query(_WOE_SELECT, _ctes))(
        lambda t, lg=_legacy: rounded(MO.woe(_lines(t), O.LINE_FEATURES, "label", legacy=lg)))
    register(f"iv{_suffix}", O.query(_IV_SELECT, _ctes))(
        lambda t, lg=_legacy: rounded(MO.iv(MO.woe(_lines(t), O.LINE_FEATURES, "label", legacy=lg)).orderBy(
            F.desc("adj_iv"))))


# No SQL: standard deviations differ in their last bit between engines, and quantile edges fall on such values.
@register("iv_features")
def iv_features(t):
    """Information value of all 106 features per out-of-time set."""
    woe = MO.woe(t.feature_sets(), schemas.FEATURES, "fraudLabel", legacy=True)
    return rounded(MO.iv(woe, schemas.FEATURES).orderBy(F.desc("adj_iv"), "feature", "dataset"))


_MATRIX_COLS = [*O.LINE_FEATURES, "o_totalprice"]


def _matrix_rows(t):
    orders = t.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    return t.raw("lineitem").select(F.year("l_shipdate").cast("string").alias("dataset"), "l_orderkey",
                                    *O.LINE_FEATURES).join(orders, "l_orderkey").drop("l_orderkey")


_MATRIX_FROM = ("FROM (SELECT CAST(year(l_shipdate) AS VARCHAR) AS dataset, * FROM lineitem JOIN orders "
                "ON l_orderkey = o_orderkey) GROUP BY dataset")


@register("gram_matrix", " UNION ALL ".join(
    f"SELECT dataset, '{a}' AS feature_1, '{b}' AS feature_2, CAST(count(*) AS BIGINT) AS n, "
    f"round(sum({a} * {b}) / sqrt(sum({a} * {a}) * sum({b} * {b})), 6) AS cosine {_MATRIX_FROM}"
    for i, a in enumerate(_MATRIX_COLS) for b in _MATRIX_COLS[i:]))
def gram_matrix(t):
    """Second moments, each divided by the norms of its two columns."""
    g = MO.gram(MO.cross_products(_matrix_rows(t), _MATRIX_COLS), _MATRIX_COLS)
    return rounded(g.select("dataset", "feature_1", "feature_2", "n",
                            F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy"))).alias("cosine")))


@register("corr_long", " UNION ALL ".join(
    f"SELECT dataset, '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), 6) AS correlation {_MATRIX_FROM}"
    for a in _MATRIX_COLS for b in _MATRIX_COLS if a != b))
def corr_long(t):
    return rounded(MO.corr_long(_matrix_rows(t), _MATRIX_COLS))


@register("corr_features", O.query(
    "SELECT a.dataset, a.feature AS feature_1, b.feature AS feature_2, round(CASE WHEN var_pop(a.value) > 0 AND var_pop(b.value) > 0 "
    "THEN corr(a.value, b.value) END, 6) AS correlation FROM fval_ a JOIN fval_ b ON a.dataset = b.dataset AND a.uniqueId = b.uniqueId "
    "AND a.feature <> b.feature GROUP BY ALL"))
def corr_features(t):
    """Correlations of all 106 features per out-of-time set."""
    return rounded(MO.corr_long(t.feature_sets(), schemas.FEATURES))


def _vif_sql(columns):
    """Pivot after pivot the matrix of second moments, columns scaled to norm one, is swept into its inverse."""
    k = len(columns)
    cells = [(i, j) for i in range(k) for j in range(k)]
    ctes = ["s0_ AS (SELECT dataset, " + ", ".join(
        f"sum({columns[i]} * {columns[j]}) / sqrt(sum({columns[i]} * {columns[i]}) * sum({columns[j]} * {columns[j]})) AS m{i}{j}"
        for i, j in cells) + f" {_MATRIX_FROM})"]
    for p in range(k):
        swept = []
        for i, j in cells:
            if i == j == p:
                cell = f"-1 / m{p}{p}"
            elif p in (i, j):
                cell = f"m{i}{j} / m{p}{p}"
            else:
                cell = f"m{i}{j} - m{i}{p} * m{p}{j} / m{p}{p}"
            swept.append(f"{cell} AS m{i}{j}")
        ctes.append(f"s{p + 1}_ AS (SELECT dataset, {', '.join(swept)} FROM s{p}_)")
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(
        f"SELECT dataset, '{c}' AS feature, round(-m{i}{i}, 6) AS vif FROM s{k}_" for i, c in enumerate(columns))


@register("vif", _vif_sql(_MATRIX_COLS))
def vif(t):
    return rounded(MO.vif(_matrix_rows(t), _MATRIX_COLS))


@register("vif_features")
def vif_features(t):
    """VIF of all 106 features per out-of-time set."""
    return MO.vif(t.feature_sets(), schemas.FEATURES)
