"""Queries for evaluation, score reports, risk segments and business figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from usertide.catalog.registry import query, rounded
from usertide.functions.numeric import evenly_spaced, right_closed_bin
from usertide.plans import evaluation, kpis, scoring

SCORED = ("scored",)
THRESHOLD = 0.3

CELLS = """count(*) FILTER (label = 0 AND score < {t}) AS tn, count(*) FILTER (label = 0 AND score >= {t}) AS fp,
  count(*) FILTER (label = 1 AND score < {t}) AS fn, count(*) FILTER (label = 1 AND score >= {t}) AS tp"""

AUC = """(SELECT (sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE)) FROM (
  SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY score)))"""

# Per distinct score, descending: rows of each class at or above it.
CURVE = """
SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tps, sum(neg) OVER (ORDER BY score DESC) AS fps,
  sum(pos) OVER () AS p, sum(neg) OVER () AS n,
  lead(pos) OVER (ORDER BY score DESC) AS next_pos, lead(neg) OVER (ORDER BY score DESC) AS next_neg,
  row_number() OVER (ORDER BY score DESC) AS position
FROM (SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY score)
"""

RANKED = """
SELECT *, (rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE)
  / count(*) OVER () * 100 AS percentile FROM scored
"""

BAND = "CASE WHEN percentile >= 80 THEN 'High Risk' WHEN percentile >= 40 THEN 'Medium Risk' ELSE 'Low Risk' END"


def _ratio(a: str, b: str) -> str:
    return f"coalesce({a} / nullif({b}, 0)::DOUBLE, 0)"


def _metrics(cells: str) -> str:
    return f"""
SELECT *, {_ratio("2 * precision_pos * recall_pos", "precision_pos + recall_pos")} AS f1_pos,
  {_ratio("2 * precision_neg * recall_neg", "precision_neg + recall_neg")} AS f1_neg FROM (
  SELECT *, {_ratio("tp", "tp + fp")} AS precision_pos, {_ratio("tp", "tp + fn")} AS recall_pos, tp + fn AS support_pos,
    {_ratio("tn", "tn + fn")} AS precision_neg, {_ratio("tn", "tn + fp")} AS recall_neg, tn + fp AS support_neg
  FROM ({cells}))
"""


REPORT_COLUMNS = """tn, fp, fn, tp, round(precision_pos, 6) AS precision_pos, round(recall_pos, 6) AS recall_pos,
  support_pos, round(precision_neg, 6) AS precision_neg, round(recall_neg, 6) AS recall_neg, support_neg,
  round(f1_pos, 6) AS f1_pos, round(f1_neg, 6) AS f1_neg"""


@query("confusion_matrix", f"SELECT {CELLS.format(t=THRESHOLD)} FROM scored", SCORED)
def _(v):
    return evaluation.confusion_matrix(v.scored(), THRESHOLD)


@query("classification_report",
       f"SELECT {REPORT_COLUMNS} FROM ({_metrics('SELECT ' + CELLS.format(t=THRESHOLD) + ' FROM scored')})", SCORED)
def _(v):
    return rounded(evaluation.add_class_metrics(evaluation.confusion_matrix(v.scored(), THRESHOLD)))


@query("roc_auc", f"SELECT round({AUC}, 6) AS auc", SCORED)
def _(v):
    return rounded(evaluation.roc_auc(v.scored()))


@query("evaluate_at_threshold", f"""
SELECT 0.3::DOUBLE AS threshold, round({AUC}, 6) AS auc, {REPORT_COLUMNS}
FROM ({_metrics('SELECT ' + CELLS.format(t=THRESHOLD) + ' FROM scored')})
""", SCORED)
def _(v):
    return rounded(evaluation.evaluate_at(v.scored(), THRESHOLD))


@query("roc_points", f"""
SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, 'inf'::DOUBLE AS threshold
UNION ALL SELECT round(fps / n, 6), round(tps / p, 6), score FROM ({CURVE})
WHERE position = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
""", SCORED)
def _(v):
    return rounded(evaluation.roc_points(v.scored()))


@query("pr_points", f"""
SELECT round(tps / p, 6) AS recall, round(tps / (tps + fps), 6) AS precision, score AS threshold FROM ({CURVE})
UNION ALL SELECT 0.0, 1.0, NULL
""", SCORED)
def _(v):
    return rounded(evaluation.pr_points(v.scored()))


# The rule in full: the lowest score reaching both minima, else the lowest score with the best F1.
PICK = """coalesce(min(CASE WHEN tps / p >= {r} AND tps / (tps + fps) >= {q} THEN score END),
  arg_max(score, (2 * tps / (p + tps + fps), -score)))"""


@query("pick_threshold", f"SELECT {PICK.format(r=0.6, q=0.15)} AS threshold FROM ({CURVE})", SCORED)
def _(v):
    return evaluation.pick_threshold(v.scored())


@query("pick_threshold_unreachable_minima",
       f"SELECT {PICK.format(r=0.6, q=0.5)} AS threshold FROM ({CURVE})", SCORED)
def _(v):
    return evaluation.pick_threshold(v.scored(), 0.6, 0.5)


@query("pick_threshold_best_f1", f"""
SELECT score AS threshold FROM ({CURVE}) ORDER BY 2 * tps / (p + tps + fps) DESC, score LIMIT 1
""", SCORED)
def _(v):
    return evaluation.pick_threshold(v.scored(), best_f1=True)


@query("threshold_by_segment", f"""
SELECT device, {PICK.format(r=0.6, q=0.4)} AS threshold FROM (
  SELECT device, score, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, sum(pos) OVER (PARTITION BY device) AS p
  FROM (SELECT device, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
        FROM scored s JOIN app_users u ON s.user_id = u.user_id GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY device ORDER BY score DESC))
GROUP BY device
""", ("scored", "app_users"))
def _(v):
    joined = v.scored().join(v.users().select("user_id", "device"), "user_id")
    return evaluation.pick_threshold(joined, 0.6, 0.4, by=["device"])


GRID = "SELECT CASE WHEN i = 59 THEN 0.99::DOUBLE ELSE 0.01::DOUBLE + i * ((0.99::DOUBLE - 0.01::DOUBLE) / 59) END AS t FROM range(60) r(i)"


@query("threshold_sweep", f"""
SELECT round(threshold, 6) AS threshold, round({AUC}, 6) AS auc, round(precision_pos, 6) AS precision_pos,
  round(recall_pos, 6) AS recall_pos, round(f1_pos, 6) AS f1_pos, tn, fp, fn, tp
FROM ({_metrics(f"SELECT t AS threshold, {CELLS.format(t='t')} FROM scored, ({GRID}) GROUP BY t")})
""", SCORED)
def _(v):
    return rounded(evaluation.threshold_sweep(v.scored(), 60))


@query("lift_by_decile", f"""
SELECT CAST(ceil(percentile / 100 * 10) AS INTEGER) AS decile, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives,
  round(avg(label), 6) AS rate, round(avg(label) / (SELECT avg(label) FROM scored), 6) AS lift
FROM ({RANKED}) GROUP BY 1
""", SCORED)
def _(v):
    return rounded(evaluation.lift_by_decile(v.scored()))


@query("label_scores", f"""
SELECT row_id, score, CASE WHEN score >= {THRESHOLD} THEN 1 ELSE 0 END AS pred_churn, 0.3::DOUBLE AS threshold_used,
  'orders' AS model_file, '2024-02-01T00:00:00' AS scored_at_utc FROM scored
""", SCORED)
def _(v):
    rows = v.scored().select("row_id", "score")
    return scoring.label_scores(rows, THRESHOLD, "orders", "2024-02-01T00:00:00")


@query("top_scores", "SELECT row_id, score FROM scored ORDER BY score DESC, row_id LIMIT 50", SCORED)
def _(v):
    return scoring.top_scores(v.scored(), 50, id_col="row_id").select("row_id", "score")


@query("top_scores_with_gaps", """
SELECT row_id, CASE WHEN row_id % 5 > 1 THEN score END AS score FROM scored ORDER BY score DESC NULLS LAST, row_id LIMIT 50
""".replace("ORDER BY score", "ORDER BY CASE WHEN row_id % 5 > 1 THEN score END"), SCORED)
def _(v):
    """Missing scores and NaN among the rows: both come last."""
    key = F.col("row_id") % 5
    rows = v.scored().withColumn("score", F.when(key == 0, F.lit(float("nan"))).when(key > 1, F.col("score")))
    return scoring.top_scores(rows, 50, id_col="row_id").select("row_id", "score")


@query("score_distribution", """
SELECT 'score' AS metric, count(*) AS n, round(avg(score), 3) AS mean, round(stddev_samp(score), 3) AS std,
  round(min(score), 3) AS min, round(quantile_cont(score, 0.1), 3) AS p10, round(quantile_cont(score, 0.25), 3) AS p25,
  round(quantile_cont(score, 0.5), 3) AS p50, round(quantile_cont(score, 0.75), 3) AS p75,
  round(quantile_cont(score, 0.9), 3) AS p90, round(max(score), 3) AS max
FROM scored
""", SCORED)
def _(v):
    return scoring.score_distribution(v.scored())


def _mean_by(column: str) -> str:
    return f"""
SELECT {column}, round(avg(score), 6) AS avg_churn_prob FROM scored s JOIN app_users u ON s.user_id = u.user_id
GROUP BY {column}"""


@query("churn_by_country", _mean_by("country"), ("scored", "app_users"))
def _(v):
    return rounded(scoring.mean_score_by(v.scored(), v.users(), "country"))


@query("churn_by_device", _mean_by("device"), ("scored", "app_users"))
def _(v):
    return rounded(scoring.mean_score_by(v.scored(), v.users(), "device"))


@query("churn_by_subscription", _mean_by("subscription_type"), ("scored", "app_users"))
def _(v):
    return rounded(scoring.mean_score_by(v.scored(), v.users(), None))


EDGES = "[" + ", ".join(f"{e!r}::DOUBLE" for e in evenly_spaced(0.0, 1.0, 11)) + "]"


@query("calibration_table", f"""
SELECT CAST(i AS INTEGER) AS bin, {EDGES}[i + 1] AS lower, {EDGES}[i + 2] AS upper,
  round(avg(label), 6) AS mean_outcome, count(label) AS n
FROM range(10) r(i) LEFT JOIN scored s
  ON (s.score > {EDGES}[i + 1] OR (i = 0 AND s.score = 0)) AND s.score <= {EDGES}[i + 2]
GROUP BY i
""", SCORED)
def _(v):
    table = scoring.calibration_table(v.scored())
    return table.withColumn("mean_outcome", F.round("mean_outcome", 6))


@query("interval_buckets", f"""
SELECT row_id, CAST(CASE WHEN score = 0 THEN 0 ELSE (SELECT count(*) FROM unnest({EDGES}) e(x) WHERE x < score) - 1 END
  AS INTEGER) AS bin FROM scored
""", SCORED)
def _(v):
    return v.scored().select("row_id", right_closed_bin(F.col("score"), evenly_spaced(0.0, 1.0, 11)).alias("bin"))


@query("risk_segments", f"""
SELECT row_id, user_id, label, score, round(percentile, 6) AS churn_percentile, {BAND} AS risk_segment FROM ({RANKED})
""", SCORED)
def _(v):
    return rounded(scoring.risk_segments(v.scored()))


@query("segmented_users", f"""
SELECT r.row_id, r.user_id, r.label, r.score, round(percentile, 6) AS churn_percentile, {BAND} AS risk_segment,
  u.country, u.device, u.language, u.subscription_type
FROM ({RANKED}) r JOIN app_users u ON r.user_id = u.user_id
""", ("scored", "app_users"))
def _(v):
    users = v.users().select("user_id", "country", "device", "language", "subscription_type")
    return rounded(scoring.segmented_users(v.scored(), users))


@query("segment_summary", f"""
SELECT {BAND} AS risk_segment, count(user_id) AS user_count,
  round(100.0::DOUBLE * count(user_id) / (SELECT count(*) FROM scored), 2) AS pct
FROM ({RANKED}) GROUP BY 1
""", SCORED)
def _(v):
    return scoring.segment_summary(v.scored())


@query("usage_kpis", """
SELECT 'plays_per_session' AS metric,
  round(count(*) FILTER (event_type = 'play') / count(DISTINCT (user_id, session_id)) FILTER (session_id IS NOT NULL), 6)
    AS value FROM app_events
UNION ALL SELECT 'next_rate', round(avg(x), 6)
  FROM (SELECT max(CASE WHEN event_type = 'next' THEN 1.0::DOUBLE ELSE 0 END) AS x FROM app_events GROUP BY user_id)
UNION ALL SELECT 'arpu', round(sum(credits_purchased) / count(*), 6) FROM app_users
UNION ALL SELECT 'arppu', round(sum(credits_purchased) / count(*) FILTER (credits_purchased > 0), 6) FROM app_users
UNION ALL SELECT 'premium_share', round(avg(CASE WHEN subscription_type = 'premium' THEN 1.0::DOUBLE ELSE 0 END), 6)
  FROM app_users
""", ("app_users", "app_events"))
def _(v):
    return rounded(kpis.usage_kpis(v.users(), v.events()))


@query("session_summary", """
SELECT count(*) AS sessions, round(avg(d), 4) AS mean_duration, round(quantile_cont(d, 0.95), 4) AS p95_duration,
  round(avg(x), 4) AS exit_rate
FROM (SELECT (epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) / 1e6 AS d,
        max(CASE WHEN event_type = 'exit' THEN 1.0::DOUBLE ELSE 0 END) AS x
      FROM app_events WHERE session_id IS NOT NULL GROUP BY user_id, session_id)
""", ("app_events",))
def _(v):
    return rounded(kpis.session_summary(v.events()), 4)


@query("retention_by_credits", """
SELECT round(a, 6) AS retention_above, round(b, 6) AS retention_rest, round(a / b, 6) AS ratio FROM (
  SELECT avg(CASE WHEN events_D30 > 0 THEN 1.0::DOUBLE ELSE 0 END) FILTER (credits_purchased > 20) AS a,
    avg(CASE WHEN events_D30 > 0 THEN 1.0::DOUBLE ELSE 0 END) FILTER (credits_purchased <= 20) AS b
  FROM metrics m JOIN app_users u ON m.user_id = u.user_id)
""", ("metrics", "app_users"))
def _(v):
    return rounded(kpis.retention_by_credits(v.users(), v.metrics()))
