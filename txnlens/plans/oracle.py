"""SQL for DuckDB that computes each registered query from the supplied tables, independently of Spark.

Statements are assembled from named common table expressions; ``query(...)`` adds those a statement needs.
Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

import re

from txnlens import schemas
from txnlens.plans import tables as T


def _date(d):
    return f"DATE '{d.isoformat()}'"


def r6(expr, name):
    return f"round({expr}, 6) AS {name}"


_CTES: dict[str, str] = {}

_CTES["k0_"] = """
SELECT event_id, user_id, ts, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"""
_CTES["gaps_"] = """
SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL '24' HOUR
  THEN 0 ELSE 1 END AS is_new FROM k0_"""
_CTES["numbered_"] = """
SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sess FROM gaps_"""
_CTES["ranked_"] = """
SELECT *, row_number() OVER (PARTITION BY user_id, sess ORDER BY ts, event_id) AS rn,
  first_value(k) OVER (PARTITION BY user_id, sess ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k0 FROM numbered_"""
_CTES["ev_"] = """
SELECT CASE WHEN k0 >= 90 THEN 1 ELSE 0 END AS fraudLabel,
  lpad(CAST(event_id AS VARCHAR), 10, '0') AS uniqueId, event_id,
  CAST(user_id AS VARCHAR) AS customerId,
  concat(CAST(user_id AS VARCHAR), '-', CAST(sess AS VARCHAR)) AS sessionId, ts,
  CASE WHEN rn = 1 THEN 'login' WHEN event_type = 'purchase' THEN 'transaction'
       ELSE concat('action_', CAST(k % 10 AS VARCHAR)) END AS action,
  CASE WHEN rn = 1 THEN CAST(-130 AS DOUBLE) + CAST(0.55 AS DOUBLE) * k END AS longitude,
  CASE WHEN rn = 1 THEN CAST(30 AS DOUBLE) + CAST(0.22 AS DOUBLE) * ((k * 7) % 100) END AS latitude,
  CASE WHEN rn > 1 AND event_type = 'purchase' THEN value END AS amount,
  CASE WHEN rn > 1 AND event_type = 'purchase' THEN
    CASE WHEN k % 10 < 5 THEN 'checking' WHEN k % 10 < 8 THEN 'savings' ELSE 'credit_card' END END AS accountType,
  CASE WHEN rn > 1 AND event_type = 'purchase' THEN concat('r', CAST(k % 20 AS VARCHAR)) END AS recipient
FROM ranked_"""

_counts = ",\n  ".join(
    [f"count(*) FILTER (WHERE action = '{a}') OVER w AS action{i}Count" for i, a in enumerate(schemas.ACTIONS)]
    + [f"count(*) FILTER (WHERE action = 'transaction' AND accountType = '{a}') OVER w AS transactionFrom{lb}Count"
       for lb, a in zip(schemas.ACCOUNT_LABELS, schemas.ACCOUNT_TYPES)])
_CTES["state_"] = f"""
SELECT *, CAST(ts AS DATE) AS day, count(*) OVER w AS actionCount,
  count(*) FILTER (WHERE action = 'transaction') OVER w AS transactionCount,
  {_counts},
  first_value(ts) OVER w AS sessionStart,
  first_value(longitude) OVER w AS lon, first_value(latitude) OVER w AS lat,
  sum(amount) OVER w AS amountSum, avg(amount) OVER w AS amountAvg,
  min(amount) OVER w AS amountMin, max(amount) OVER w AS amountMax,
  count(DISTINCT recipient) OVER w AS distinctRecipientCount,
  count(recipient) OVER (PARTITION BY sessionId, recipient ORDER BY ts, uniqueId ROWS UNBOUNDED PRECEDING)
    AS recipientTransactionCount
FROM ev_ WINDOW w AS (PARTITION BY sessionId ORDER BY ts, uniqueId ROWS UNBOUNDED PRECEDING)"""
_CTES["tx_"] = """
SELECT *, date_diff('second', sessionStart, ts) AS seconds FROM state_ WHERE action = 'transaction'"""
_CTES["cust_"] = """
SELECT CAST(c_custkey AS VARCHAR) AS customerId, 18 + c_custkey % 52 AS age,
  CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  CASE c_custkey % 3 WHEN 0 THEN 'single' WHEN 1 THEN 'married' ELSE 'divorced' END AS maritalStatus,
  CAST(-130 AS DOUBLE) + CAST(0.55 AS DOUBLE) * ((13 * c_custkey) % 100) AS homeLongitude,
  CAST(30 AS DOUBLE) + CAST(0.22 AS DOUBLE) * ((29 * c_custkey) % 100) AS homeLatitude
FROM customer"""
_CTES["snaps_"] = "SELECT unnest([" + ", ".join(_date(d) for d in T.SNAPSHOTS) + "]) AS profileDate"
_CTES["covered_"] = f"""
SELECT s.profileDate, t.* FROM tx_ t JOIN snaps_ s
  ON t.day >= s.profileDate - {T.LOOKBACK_DAYS} AND t.day < s.profileDate"""

_AMOUNT_STATS = (["min(amount) AS amountMin", "max(amount) AS amountMax", "avg(amount) AS amountAvg",
                  "stddev_samp(amount) AS amountStd"]
                 + [f"quantile_disc(amount, {p / 100}) AS amountPercentile{p}" for p in schemas.PERCENTILES])
_SESSION_STATS = ["avg(seconds) AS meanSecondsToTransaction", "stddev_samp(seconds) AS stdSecondsToTransaction"]
for _n, _c in schemas.SESSION_ACTION_STATS + schemas.SESSION_TXN_STATS:
    _SESSION_STATS += [f"avg({_c}) AS mean{_n}", f"stddev_samp({_c}) AS std{_n}"]
_COUNT_STATS = ["count(DISTINCT sessionId) AS sessionCount", "count(*) AS transactionCount"]
_CTES["prof_"] = ("SELECT profileDate, customerId, "
                  + ", ".join(_AMOUNT_STATS + _SESSION_STATS + _COUNT_STATS)
                  + ", count(DISTINCT recipient) AS distinctRecipientCount FROM covered_ GROUP BY ALL")
_CTES["recip_"] = """
SELECT profileDate, customerId, recipient, count(*) AS txnCnt, min(ts) AS minTimestamp FROM covered_
GROUP BY profileDate, customerId, recipient"""
_CTES["dated_"] = f"""
SELECT t.*, (SELECT max(p.profileDate) FROM (SELECT DISTINCT profileDate FROM prof_) p
             WHERE p.profileDate <= t.day AND p.profileDate < {_date(T.PROFILE_END)}) AS profileDate FROM tx_ t"""


def _txn_select():
    out = {"longitude": "coalesce(t.lon, 0.0)", "latitude": "coalesce(t.lat, 0.0)", "amount": "coalesce(t.amount, -1.0)"}
    for m in schemas.AMOUNT_MODULI:
        out[f"amountMod{m}"] = f"coalesce((CAST(round(100 * t.amount) AS BIGINT) % {100 * m}) / 100.0, -1.0)"
    out["hour"] = "coalesce(hour(t.ts), -1)"
    out["dayOfWeek"] = "coalesce(dayofweek(t.ts) + 1, -1)"
    out["dayOfMonth"] = "coalesce(day(t.ts), -1)"
    for lb, a in zip(schemas.ACCOUNT_LABELS, schemas.ACCOUNT_TYPES):
        out[f"accountType{lb}"] = f"CASE WHEN t.accountType = '{a}' THEN 1 ELSE 0 END"
    for n in ["transactionCount"] + [f"action{i}Count" for i in range(10)] + [
            "actionCount", "amountSum", "amountAvg", "amountMin", "amountMax", "recipientTransactionCount",
            "distinctRecipientCount"]:
        out[n] = f"t.{n}"
    out["secondsToTransaction"] = "t.seconds"
    out["avgActionDuration"] = "CAST(t.seconds AS DOUBLE) / t.actionCount"
    out["repeatedRecipientCount"] = "t.transactionCount - t.distinctRecipientCount"
    return out


def _z(x, mean, std):
    return f"coalesce(({x} - p.{mean}) / nullif(p.{std}, 0), -1.0)"


def _profile_select():
    out = {"profileRawInd": "CASE WHEN p.customerId IS NULL THEN 0 ELSE 1 END"}

    def raw(n, default="-1.0"):
        out["profileRaw" + n[0].upper() + n[1:]] = f"coalesce(p.{n}, {default})"

    for n in ["amountMin", "amountMax", "amountAvg", "amountStd"] + [f"amountPercentile{p}" for p in schemas.PERCENTILES]:
        raw(n)
    out["profileAmountZScore"] = _z("t.amount", "amountAvg", "amountStd")
    raw("meanSecondsToTransaction")
    raw("stdSecondsToTransaction")
    out["profileSecondsToTransactionZScore"] = _z("t.seconds", "meanSecondsToTransaction", "stdSecondsToTransaction")
    raw("sessionCount", "-1")
    raw("transactionCount", "-1")
    for n, c in schemas.SESSION_ACTION_STATS + schemas.SESSION_TXN_STATS:
        raw(f"mean{n}")
        raw(f"std{n}")
        out[f"profile{n}ZScore"] = _z(f"t.{c}", f"mean{n}", f"std{n}")
    out["profileRecipientTxnCount"] = "coalesce(r.txnCnt, 0)"
    out["profileDistinctRecipientCount"] = "coalesce(p.distinctRecipientCount, 0)"
    return out


def _cust_select():
    out = {"age": "coalesce(c.age, -1)", "genderMale": "CASE WHEN c.gender = 'M' THEN 1 ELSE 0 END",
           "homeLongitude": "coalesce(c.homeLongitude, 0.0)", "homeLatitude": "coalesce(c.homeLatitude, 0.0)",
           "distanceFromHome": "coalesce(sqrt(pow(c.homeLongitude - t.lon, 2) + pow(c.homeLatitude - t.lat, 2)), -1.0)"}
    for m in schemas.MARITAL_STATUSES:
        out[f"maritalStatus{m.capitalize()}"] = f"CASE WHEN c.maritalStatus = '{m}' THEN 1 ELSE 0 END"
    return out


EXPRS = {**_txn_select(), **_profile_select(), **_cust_select()}
# Which features are doubles, and so are rounded.
WHOLE = ({"hour", "dayOfWeek", "dayOfMonth", "secondsToTransaction", "age", "genderMale", "profileRawInd",
          "profileRawSessionCount", "profileRawTransactionCount", "profileRecipientTxnCount",
          "profileDistinctRecipientCount", "recipientTransactionCount", "distinctRecipientCount",
          "repeatedRecipientCount", "transactionCount", "actionCount"}
         | {f"action{i}Count" for i in range(10)} | {f"accountType{a}" for a in schemas.ACCOUNT_LABELS}
         | {f"maritalStatus{m.capitalize()}" for m in schemas.MARITAL_STATUSES})


def feature_list(names):
    return ", ".join(f"CAST({EXPRS[n]} AS BIGINT) AS {n}" if n in WHOLE else r6(EXPRS[n], n) for n in names)


_JOINED = """FROM dated_ t LEFT JOIN prof_ p ON t.customerId = p.customerId AND t.profileDate = p.profileDate
LEFT JOIN recip_ r ON t.customerId = r.customerId AND t.profileDate = r.profileDate AND t.recipient = r.recipient
LEFT JOIN cust_ c ON t.customerId = c.customerId"""
_CTES["feat_"] = ("SELECT t.fraudLabel, t.uniqueId, t.event_id, t.customerId, t.sessionId, t.ts, t.day, t.action, "
                  + ", ".join(f"{EXPRS[n]} AS {n}" for n in schemas.FEATURES) + "\n" + _JOINED)
_when = "\n".join(f"  WHEN {{d}} >= {_date(lo)} AND {{d}} < {_date(hi)} THEN '{n}'" for n, (lo, hi) in T.SETS.items())
_CTES["featset_"] = f"SELECT * FROM (SELECT *, CASE {_when.format(d='day')} END AS dataset FROM feat_) WHERE dataset IS NOT NULL"
_CTES["fval_"] = ("SELECT dataset, uniqueId, fraudLabel AS label, unnest([" + ", ".join(f"'{n}'" for n in schemas.FEATURES)
                  + "]) AS feature, unnest([" + ", ".join(f"CAST({n} AS DOUBLE)" for n in schemas.FEATURES) + "]) AS value FROM featset_")
_CTES["scored_"] = f"""
SELECT * FROM (SELECT CASE {_when.format(d='day')} END AS dataset, uniqueId, event_id, fraudLabel AS y, amount, day, ts,
  (fraudLabel * 2500 + (event_id * 7919) % 7500) / CAST(10000 AS DOUBLE) AS score FROM tx_) WHERE dataset IS NOT NULL"""

# evaluation
_CTES["groups_"] = """
SELECT dataset, score, sum(y) AS pos, sum(1 - y) AS neg FROM scored_ GROUP BY dataset, score"""
_CTES["cum_"] = """
SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY dataset) AS P,
  sum(neg) OVER (PARTITION BY dataset) AS N
FROM groups_ WINDOW w AS (PARTITION BY dataset ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""
# pairwise ranking: every (positive, negative) pair, ties count one half
_CTES["auc_"] = """
SELECT a.dataset, sum(a.pos * b.neg * CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)
  / (any_value(t.P) * any_value(t.N)) AS roc_auc
FROM groups_ a JOIN groups_ b USING (dataset) JOIN (SELECT DISTINCT dataset, P, N FROM cum_) t USING (dataset)
GROUP BY a.dataset"""
_CTES["prlag_"] = """
SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS precision_, CAST(tp AS DOUBLE) / P AS recall_,
  lag(CAST(tp AS DOUBLE) / (tp + fp), 1, 1.0) OVER w AS precision0, lag(CAST(tp AS DOUBLE) / P, 1, 0.0) OVER w AS recall0
FROM cum_ WINDOW w AS (PARTITION BY dataset ORDER BY score DESC)"""
_CTES["prsum_"] = """
SELECT dataset, sum((recall_ - recall0) * (precision_ + precision0) / 2) AS pr_auc,
  sum((recall_ - recall0) * precision_) AS average_precision FROM prlag_ GROUP BY dataset"""
# row by row over the sorted list, positives first within a tie
_CTES["caprows_"] = """
SELECT dataset, y, sum(y) OVER (PARTITION BY dataset ORDER BY score DESC, y DESC, uniqueId ROWS UNBOUNDED PRECEDING)
  AS c FROM scored_"""
_CTES["cap_"] = """
SELECT dataset, (sum(c - y / CAST(2 AS DOUBLE)) - count(*) * sum(y) / 2.0)
  / (sum(y) * sum(y) / 2.0 + (count(*) - sum(y)) * sum(y) - count(*) * sum(y) / 2.0) AS accuracy_ratio
FROM caprows_ GROUP BY dataset"""
_CTES["loss_"] = """
SELECT dataset, -avg(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS log_loss, avg(pow(score - y, 2)) AS brier_loss
FROM (SELECT *, least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS p FROM scored_)
GROUP BY dataset"""

# parity
_lo, _hi = T.SETS["test"]
_CTES["batch_"] = "SELECT f.*, s.score FROM featset_ f JOIN scored_ s USING (uniqueId) WHERE f.dataset = 'test' AND f.hour <> 0"
_CTES["online_"] = """
SELECT f.uniqueId, f.ts, f.customerId,
  s.score + CASE WHEN f.dayOfWeek = 2 THEN 0.001 ELSE 0 END AS score_df,
  f.ts + CASE WHEN f.dayOfWeek = 2 THEN INTERVAL '1' HOUR ELSE INTERVAL '0' HOUR END AS scoreTimestamp,
  """ + ", ".join(
    ("f.amount + CASE WHEN f.accountTypeSavings = 1 THEN 0.02 ELSE 0 END" if c == "amount" else f"CAST(f.{c} AS DOUBLE)")
    + f" AS {c}_df" for c in schemas.FEATURES) + """
FROM featset_ f JOIN scored_ s USING (uniqueId) WHERE f.dataset = 'test' AND f.hour <> 23"""
_CTES["both_"] = ("SELECT b.uniqueId AS b_id, o.uniqueId AS o_id, b.score, o.score_df, "
                  + ", ".join(f"b.{c}, o.{c}_df" for c in schemas.FEATURES)
                  + " FROM batch_ b FULL OUTER JOIN online_ o ON b.uniqueId = o.uniqueId")

# stability on lineitem: data sets are ship years
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_CTES["line_"] = ("SELECT CAST(year(l_shipdate) AS VARCHAR) AS dataset, "
                  "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, * FROM lineitem")
_CTES["lval_"] = " UNION ALL ".join(
    f"SELECT dataset, label, '{c}' AS feature, {c} AS value FROM line_" for c in LINE_FEATURES)
_CTES["sval_"] = "SELECT dataset, y AS label, 'score' AS feature, score AS value FROM scored_"


def _edge_list(lo, hi, legacy):
    last = "" if legacy else f"WHEN i = 10 THEN {hi} "
    return f"list_transform(range(0, 11), lambda i: CASE {last}WHEN true THEN {lo} + ({hi} - {lo}) * i / 10 END)"


def _widened(edges, legacy):
    if not legacy:
        return edges
    return (f"list_transform({edges}, lambda e, i: e + CASE WHEN i = 1 OR i = len({edges}) THEN 1e-6 ELSE 0 END)")


def _bin(legacy):
    inside = ("CASE WHEN value > edges[1] AND value <= edges[len(edges)] "
              "THEN len(list_filter(edges, lambda e: e < value)) - 1 END")
    return inside if legacy else f"CASE WHEN value = edges[1] THEN 0 ELSE {inside} END"


def csi_ctes(source, order, bin_type="fixed", legacy=False):
    """Statement parts (name -> SQL) that end in csi_(dataset1, dataset2, feature, csi)."""
    names = ", ".join(f"('{n}', {i})" for i, n in enumerate(order))
    hi = "greatest(a.lo, b.hi)" if legacy else "greatest(a.hi, b.hi)"
    if bin_type == "fixed":
        edges = _edge_list("lo", "hi", legacy)
    else:
        edges = "q1"
        if not legacy:
            edges = "list_transform(q1, lambda e, i: CASE WHEN i = 1 THEN lo WHEN i = len(q1) THEN hi ELSE e END)"
    agg = "sum(d) / any_value(nb)" if legacy else "sum(d)"
    return {
        "ord_": f"SELECT * FROM (VALUES {names}) v(name, pos)",
        "ends_": f"""SELECT feature, dataset, min(value) AS lo, max(value) AS hi,
  list_sort(list_distinct(quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS q
FROM {source} GROUP BY feature, dataset""",
        "pe_": f"""SELECT feature, d1, d2, {_widened('e0', legacy)} AS edges FROM (
  SELECT *, {edges} AS e0 FROM (
    SELECT a.feature, a.dataset AS d1, b.dataset AS d2, a.q AS q1, least(a.lo, b.lo) AS lo, {hi} AS hi
    FROM ends_ a JOIN ends_ b ON a.feature = b.feature JOIN ord_ x ON x.name = a.dataset JOIN ord_ y ON y.name = b.dataset
    WHERE x.pos < y.pos))""",
        "pc_": f"""SELECT feature, d1, d2, bin, any_value(nb) AS nb, CAST(sum(s1) AS DOUBLE) AS c1, CAST(sum(s2) AS DOUBLE) AS c2 FROM (
  SELECT p.feature, d1, d2, len(edges) - 1 AS nb, CASE WHEN v.dataset = d1 THEN 1 ELSE 0 END AS s1,
    CASE WHEN v.dataset = d2 THEN 1 ELSE 0 END AS s2, {_bin(legacy)} AS bin
  FROM {source} v JOIN pe_ p ON v.feature = p.feature AND v.dataset IN (p.d1, p.d2)) WHERE bin IS NOT NULL
GROUP BY feature, d1, d2, bin""",
        "pr_": """SELECT *, CASE WHEN c1 = 0 THEN 1e-6 ELSE c1 / sum(c1) OVER w END AS r1,
  CASE WHEN c2 = 0 THEN 1e-6 ELSE c2 / sum(c2) OVER w END AS r2 FROM pc_ WINDOW w AS (PARTITION BY feature, d1, d2)""",
        "csi_": f"""SELECT d1 AS dataset1, d2 AS dataset2, feature, {agg} AS csi
FROM (SELECT *, (r1 - r2) * ln(r1 / r2) AS d FROM pr_) GROUP BY d1, d2, feature""",
    }


def bin_ctes(source, bin_type, legacy=False):
    """Parts that end in bc_(dataset, feature, bin, lower, upper, cnt_0, cnt_1) with empty bins included."""
    edges = _edge_list("lo", "hi", legacy) if bin_type == "fixed" else "q"
    return {
        "be_": f"""SELECT dataset, feature, {_widened('e0', legacy)} AS edges FROM (SELECT *, {edges} AS e0 FROM (
  SELECT dataset, feature, min(value) AS lo, max(value) AS hi,
    list_sort(list_distinct(quantile_cont(value, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]))) AS q
  FROM {source} GROUP BY dataset, feature))""",
        "bb_": f"""SELECT dataset, feature, bin, count(*) FILTER (WHERE label = 0) AS cnt_0,
  count(*) FILTER (WHERE label = 1) AS cnt_1
FROM (SELECT v.dataset, v.feature, label, {_bin(legacy)} AS bin FROM {source} v JOIN be_ USING (dataset, feature))
WHERE bin IS NOT NULL GROUP BY dataset, feature, bin""",
        "bc_": """SELECT g.dataset, g.feature, CAST(g.bin AS BIGINT) AS bin, g.lower, g.upper,
  coalesce(cnt_0, 0) AS cnt_0, coalesce(cnt_1, 0) AS cnt_1
FROM (SELECT dataset, feature, unnest(range(0, len(edges) - 1)) AS bin, unnest(edges[:-2]) AS lower,
        unnest(edges[2:]) AS upper FROM be_) g LEFT JOIN bb_ USING (dataset, feature, bin)""",
        "woe_": """SELECT dataset, feature, bin, lower, upper, cnt_0, cnt_1, p0 AS pct_0, p1 AS pct_1,
  CASE WHEN p0 = 0 AND p1 = 0 THEN NULL WHEN p1 = 0 THEN CAST('-Infinity' AS DOUBLE)
       WHEN p0 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE ln(p1 / p0) END AS woe,
  ln(((cnt_1 + 0.5) / s1) / ((cnt_0 + 0.5) / s0)) AS adj_woe
FROM (SELECT *, cnt_0 / s0 AS p0, cnt_1 / s1 AS p1 FROM (SELECT *, CAST(sum(cnt_0) OVER w AS DOUBLE) AS s0,
  CAST(sum(cnt_1) OVER w AS DOUBLE) AS s1 FROM bc_ WINDOW w AS (PARTITION BY dataset, feature)))""",
    }


def query(select: str, extra: dict | None = None) -> str:
    """``select`` with every common table expression it names, directly or through another one."""
    known = {**_CTES, **(extra or {})}
    needed: list[str] = []

    def visit(text):
        for name in re.findall(r"\b[a-z0-9]+_\b", text):
            if name in known and name not in needed:
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    if not needed:
        return select
    body = ",\n".join(f"{n} AS ({known[n].strip()})" for n in needed)
    return f"WITH {body}\n{select}"
