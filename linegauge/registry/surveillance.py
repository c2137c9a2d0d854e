"""Drift and monitoring: three ten-day periods of events against the first as reference."""

import re

from pyspark.sql import functions as F

from linegauge.operators import drift, monitoring
from linegauge.operators.evaluate import tier_counts, risk_tier
from linegauge.operators.quantiles import histogram
from linegauge.registry.base import query, table
from linegauge.session import scratch_path

PERIODS = ["p2", "p3"]
WITH_EMPTY = [*PERIODS, "p4"]  # a period without rows must not disturb the others
CATEGORICAL, NUMERIC, INTERACTION = ["event_type", "hour_bucket"], ["value", "k"], ["is_error_late"]


def _events(spark, sf):
    c = F.col
    day2, day3 = (F.to_timestamp(F.lit(d)) for d in ("2024-01-11", "2024-01-21"))
    k = F.from_json("props", "struct<k:bigint>")["k"].cast("double")
    return table(spark, sf, "events").select(
        F.when(c("ts") < day2, "p1").when(c("ts") < day3, "p2").otherwise("p3").alias("period_label"), "event_type",
        F.when(F.hour("ts") < 12, "am").otherwise("pm").alias("hour_bucket"), "value", k.alias("k"),
        ((c("event_type") == "error") & (F.hour("ts") >= 18)).cast("int").alias("is_error_late"),
        (c("value") > 12).cast("int").alias("defect_flag"),
        (c("value") / (c("value") + 5)).alias("defect_probability"))


def _sides(spark, sf):
    e = _events(spark, sf)
    return e.where("period_label = 'p1'"), e.where("period_label <> 'p1'")


EVENTS = """
e AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 'p1' WHEN ts < TIMESTAMP '2024-01-21' THEN 'p2' ELSE 'p3' END
  AS period_label, event_type, CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS hour_bucket, value,
  CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS DOUBLE) AS k,
  CASE WHEN event_type = 'error' AND hour(ts) >= 18 THEN 1 ELSE 0 END AS is_error_late,
  CASE WHEN value > 12 THEN 1 ELSE 0 END AS defect_flag,
  value / (value + 5) AS defect_probability FROM events)
"""


def _js(col, as_text=True):
    v = f"coalesce(CAST({col} AS VARCHAR), 'UNKNOWN')"
    return f"""
SELECT period_label, '{col}' AS feature, sqrt(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END) / 2
  + sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2) AS distance,
  count(*) FILTER (WHERE p > 0) AS n_values FROM (
  SELECT per.period_label, u.v, (SELECT count(*) FROM e WHERE period_label = 'p1' AND {v} = u.v) /
      (SELECT count(*) FROM e WHERE period_label = 'p1') AS p,
    coalesce(c.n, 0) / t.n AS q
  FROM (SELECT DISTINCT period_label FROM e WHERE period_label <> 'p1') per
  CROSS JOIN (SELECT DISTINCT {v} AS v FROM e) u
  JOIN (SELECT period_label, count(*) AS n FROM e GROUP BY 1) t ON t.period_label = per.period_label
  LEFT JOIN (SELECT period_label, {v} AS v, count(*) AS n FROM e GROUP BY 1, 2) c
    ON c.period_label = per.period_label AND c.v = u.v) GROUP BY 1"""


def _w(col):
    return f"""
SELECT period_label, '{col}' AS feature, sum(abs(fr - fc) * (nx - v)) / greatest((SELECT stddev_pop({col}) FROM e
  WHERE period_label = 'p1'), 0.001) AS distance FROM (
  SELECT period_label, v, lead(v) OVER w AS nx,
    sum(nr) OVER w / sum(nr) OVER (PARTITION BY period_label) AS fr,
    sum(nc) OVER w / sum(nc) OVER (PARTITION BY period_label) AS fc
  FROM (SELECT period_label, v, sum(nr) AS nr, sum(nc) AS nc FROM (
    SELECT per.period_label, e.{col} AS v, 1 AS nr, 0 AS nc FROM e, (SELECT DISTINCT period_label FROM e
      WHERE period_label <> 'p1') per WHERE e.period_label = 'p1' UNION ALL
    SELECT period_label, {col}, 0, 1 FROM e WHERE period_label <> 'p1') GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY period_label ORDER BY v)) GROUP BY 1"""


@query("drift_js", "N1", f"WITH {EVENTS} SELECT period_label, feature, round(distance, 6) AS distance FROM ("
       f"{_js('event_type')} UNION ALL {_js('hour_bucket')})")
def drift_js(spark, sf):
    ref, cur = _sides(spark, sf)
    return drift.js_distance(ref, cur, CATEGORICAL, "period_label", PERIODS).withColumn("distance", F.round("distance", 6))


@query("drift_wasserstein", "N2", f"WITH {EVENTS} SELECT period_label, feature, round(distance, 6) AS distance FROM ("
       f"{_w('value')} UNION ALL {_w('k')})")
def drift_wasserstein(spark, sf):
    ref, cur = _sides(spark, sf)
    return drift.wasserstein(ref, cur, NUMERIC, "period_label", PERIODS).withColumn("distance", F.round("distance", 6))


def _edge(col):
    """The Wasserstein query of a column over its rows with a number, and null where a side has none."""
    rows = f"(SELECT * FROM x WHERE {col} IS NOT NULL AND NOT isnan({col})) e"
    found = re.sub(r"FROM e\b", f"FROM {rows}", _w(col))
    return f"""
SELECT p.period_label, '{col}' AS feature, round(distance, 6) AS distance
FROM (VALUES ('p2'), ('p3'), ('p4')) p(period_label) LEFT JOIN ({found}) USING (period_label)"""


@query("drift_edge_cases", "N2 N3", f"""
WITH {EVENTS}, x AS (SELECT period_label, value + 1700000000.0 AS far, CASE WHEN period_label <> 'p3' THEN value END AS gone,
  CASE WHEN k % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS odd FROM e)
{_edge('far')} UNION ALL {_edge('gone')} UNION ALL {_edge('odd')}
""")
def drift_edge_cases(spark, sf):
    """A large offset, a feature that one period lacks, NaN among the values, a period without rows."""
    rows = _events(spark, sf).select(
        "period_label", (F.col("value") + 1700000000.0).alias("far"),
        F.when(F.col("period_label") != "p3", F.col("value")).alias("gone"),
        F.when(F.col("k") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("odd"))
    out = drift.wasserstein(rows.where("period_label = 'p1'"), rows.where("period_label <> 'p1'"), ["far", "gone", "odd"],
                            "period_label", WITH_EMPTY)
    return out.withColumn("distance", F.round("distance", 6))


JS_NAME, W_NAME = "Jensen-Shannon distance", "Wasserstein distance (normed)"
DRIFT_SQL = f"""
fd AS (SELECT period_label, feature, CASE WHEN feature IN ('event_type', 'hour_bucket') THEN 'categorical'
  WHEN feature = 'is_error_late' THEN 'interaction' ELSE 'numerical' END AS feature_type, distance >= 0.02 AS
  drift_detected, round(distance, 4) AS drift_score, test_method, CAST(0.02 AS DOUBLE) AS threshold FROM (
  SELECT period_label, feature, distance, '{JS_NAME}' AS test_method FROM ({_js('event_type')}) UNION ALL
  SELECT period_label, feature, distance, '{JS_NAME}' FROM ({_js('hour_bucket')}) UNION ALL
  SELECT period_label, feature, distance, '{JS_NAME}' FROM ({_js('is_error_late')}) UNION ALL
  SELECT *, '{W_NAME}' FROM ({_w('value')}) UNION ALL SELECT *, '{W_NAME}' FROM ({_w('k')})))
"""


@query("feature_drift_table", "N3", f"WITH {EVENTS}, {DRIFT_SQL} SELECT * FROM fd")
def feature_drift_table(spark, sf):
    ref, cur = _sides(spark, sf)
    return drift.feature_drift(ref, cur, "period_label", PERIODS, CATEGORICAL, NUMERIC, INTERACTION, limit=0.02)


PRED_SQL = f"""
pd AS (SELECT period_label, n_scored, round(distance, 4) AS prediction_drift_score, CAST(0.1 AS DOUBLE) AS
  prediction_drift_threshold, distance >= 0.1 AS prediction_drift_detected,
  round((SELECT avg(defect_probability) FROM e WHERE period_label = 'p1'), 4) AS ref_pred_mean,
  round(cur_mean, 4) AS cur_pred_mean FROM ({_w('defect_probability')}) JOIN (SELECT period_label, count(*) AS n_scored,
  avg(defect_probability) AS cur_mean FROM e GROUP BY 1) USING (period_label))
"""


@query("prediction_drift", "N4", f"WITH {EVENTS}, {PRED_SQL} SELECT * FROM pd")
def prediction_drift(spark, sf):
    ref, cur = _sides(spark, sf)
    return drift.prediction_drift(ref, cur, "defect_probability", "period_label", PERIODS)


TARGET_SQL = """
td AS (SELECT period_label, (SELECT avg(defect_flag) FROM e WHERE period_label = 'p1') AS t, avg(defect_flag) AS r
  FROM e WHERE period_label <> 'p1' GROUP BY 1)
"""


@query("target_drift", "N5", f"""WITH {EVENTS}, {TARGET_SQL} SELECT period_label, round(t, 6) AS train_defect_rate,
  round(r, 6) AS period_defect_rate, round(abs(r - t), 6) AS target_rate_delta, abs(r - t) > 0.1 AS
  target_drift_detected FROM td""")
def target_drift(spark, sf):
    ref, cur = _sides(spark, sf)
    rate = ref.agg(F.avg(F.col("defect_flag").cast("double")).alias("v")).scalar()
    out = monitoring.target_drift(cur, "defect_flag", "period_label", rate)
    return out.withColumns({c: F.round(c, 6) for c in ("train_defect_rate", "period_defect_rate",
                                                       "target_rate_delta")})


PERF_SQL = """
pf AS (SELECT period_label, count(*) FILTER (WHERE defect_probability >= 0.75) AS high_flagged,
  round(avg(defect_flag) FILTER (WHERE defect_probability >= 0.75), 4) AS high_precision,
  round(sum(defect_flag) FILTER (WHERE defect_probability >= 0.75) / sum(defect_flag), 4) AS high_recall,
  round(avg(defect_flag) FILTER (WHERE defect_probability >= 0.65), 4) AS medium_precision,
  round(sum(defect_flag) FILTER (WHERE defect_probability >= 0.65) / sum(defect_flag), 4) AS medium_recall
  FROM e WHERE period_label <> 'p1' GROUP BY 1)
"""


def _monitoring(spark, sf):
    ref, cur = _sides(spark, sf)
    return monitoring.monitoring_table(ref, ref, cur, cur, "period_label", WITH_EMPTY, "defect_flag", "defect_flag",
                                       CATEGORICAL, NUMERIC, INTERACTION)


MONITOR_SQL = f"""{EVENTS}, {DRIFT_SQL.replace('0.02', '0.1')}, {PRED_SQL}, {TARGET_SQL}, {PERF_SQL},
dn AS (SELECT period_label, count(*) AS n_features_monitored, CAST(sum(CAST(drift_detected AS INTEGER)) AS BIGINT) AS
  n_features_drifted FROM fd GROUP BY 1),
mt AS (SELECT pf.*, pd.* EXCLUDE (period_label), td.t, td.r, dn.* EXCLUDE (period_label) FROM pf JOIN pd
  USING (period_label) JOIN td USING (period_label) JOIN dn USING (period_label))
"""


MONITORING_SQL = f"""
WITH {MONITOR_SQL}, d AS (SELECT *, list_filter([CASE WHEN high_precision < 0.85 THEN 'High-tier precision ' ||
    format('{{:.1f}}', high_precision * 100) || '% below 85% floor' END, CASE WHEN abs(r - t) > 0.1 THEN
    'Defect rate shifted ' || format('{{:.1f}}', abs(r - t) * 100) || '% from training baseline (> 10%)' END],
    lambda v: v IS NOT NULL) AS a, list_filter([CASE WHEN prediction_drift_detected THEN
    'Prediction (output) distribution drifted vs validation reference' END, CASE WHEN n_features_drifted > 3 THEN
    n_features_drifted || ' input features drifted (> 3)' END], lambda v: v IS NOT NULL) AS b FROM mt)
SELECT period_label, high_flagged, high_precision, high_recall, medium_precision, medium_recall, n_scored,
  prediction_drift_score, prediction_drift_threshold, prediction_drift_detected, ref_pred_mean, cur_pred_mean,
  round(t, 4) AS train_defect_rate, round(r, 4) AS period_defect_rate, round(abs(r - t), 4) AS target_rate_delta,
  abs(r - t) > 0.1 AS target_drift_detected, n_features_monitored, n_features_drifted,
  CASE WHEN len(a) > 0 THEN 'RETRAIN' WHEN len(b) > 0 THEN 'INVESTIGATE' ELSE 'HEALTHY' END AS status,
  len(a) > 0 AS retrain_recommended, array_to_string(a || b, ' | ') AS reasons FROM d
"""


@query("monitoring_table", "N6 N7 N8", MONITORING_SQL)
def monitoring_table(spark, sf):
    return _monitoring(spark, sf)


def _frozen(spark, sf):
    """The first period's profile, counted in two halves, merged, stored and read back."""
    ref, cur = _sides(spark, sf)
    halves = [monitoring.frozen_reference(part, part, "defect_flag", CATEGORICAL, NUMERIC, INTERACTION)
              for part in (ref.where("hash(value) % 2 = 0"), ref.where("hash(value) % 2 <> 0"))]
    path = scratch_path(spark, "frozen-reference")
    drift.merged_counts(*halves).write.parquet(path)
    return spark.read.schema(drift.PROFILE).parquet(path), cur


@query("frozen_feature_drift", "N3 M21", f"WITH {EVENTS}, {DRIFT_SQL} SELECT * FROM fd")
def frozen_feature_drift(spark, sf):
    profile, cur = _frozen(spark, sf)
    scores = drift.profile_scores(profile, cur, "period_label", PERIODS, CATEGORICAL, [*NUMERIC, *INTERACTION])
    return drift.drift_table(scores, "period_label", CATEGORICAL, INTERACTION, limit=0.02)


@query("frozen_monitoring", "N4 N7 N8 M21", MONITORING_SQL)
def frozen_monitoring(spark, sf):
    """The monitoring table without the reference rows."""
    profile, cur = _frozen(spark, sf)
    return monitoring.monitoring_table_of(profile, cur, cur, "period_label", WITH_EMPTY, "defect_flag", "defect_flag", CATEGORICAL, NUMERIC,
                                          INTERACTION)


@query("retraining_rules", "N12 N13", f"""
WITH {MONITOR_SQL}, l AS (SELECT * FROM mt WHERE period_label = (SELECT max(period_label) FROM mt)),
r AS (SELECT period_label, 'high_precision' AS layer, high_precision AS value, 0.85 AS lim, high_precision < 0.85 AS alert
  FROM l UNION ALL SELECT period_label, 'target_rate_delta', round(abs(r - t), 4), 0.1, round(abs(r - t), 4) > 0.1 FROM l
  UNION ALL SELECT period_label, 'prediction_drift_score', prediction_drift_score, 0.1, prediction_drift_detected FROM l
  UNION ALL SELECT period_label, 'n_features_drifted', n_features_drifted, 3, n_features_drifted > 3 FROM l)
SELECT period_label, layer, CAST(value AS DOUBLE) AS value, CAST(lim AS DOUBLE) AS "limit", alert,
  CASE WHEN alert THEN 'TRIGGERED' ELSE 'OK' END AS rule_status FROM r
""")
def retraining_rules(spark, sf):
    return monitoring.latest_rules(_monitoring(spark, sf), "period_label")


@query("drift_matrix", "N9 J17", f"""WITH {EVENTS}, {DRIFT_SQL} SELECT feature,
  max(drift_score) FILTER (WHERE period_label = 'p2') AS p2, max(drift_score) FILTER (WHERE period_label = 'p3') AS p3,
  round(avg(drift_score), 5) AS mean_score FROM fd GROUP BY 1""")
def drift_matrix(spark, sf):
    ref, cur = _sides(spark, sf)
    scores = drift.feature_drift(ref, cur, "period_label", PERIODS, CATEGORICAL, NUMERIC, INTERACTION, limit=0.02)
    return monitoring.drift_matrix(scores, "period_label", PERIODS).withColumn(
        "mean_score", F.round("mean_score", 5))


@query("tier_mix_by_period", "N10", f"""WITH {EVENTS}, g AS (SELECT period_label, CASE WHEN defect_probability <= 0.65
  THEN 'Low' WHEN defect_probability <= 0.75 THEN 'Medium' ELSE 'High' END AS tier, count(*) AS n FROM e GROUP BY 1, 2)
SELECT period_label, tier, n, round(n / sum(n) OVER (PARTITION BY period_label), 6) AS share FROM g""")
def tier_mix_by_period(spark, sf):
    rows = _events(spark, sf).withColumn("tier", risk_tier("defect_probability"))
    return tier_counts(rows, "tier", ["period_label"]).withColumn("share", F.round("share", 6))


@query("score_density", "N11", f"""WITH {EVENTS}, g AS (SELECT CASE WHEN period_label = 'p1' THEN 'reference' ELSE
  'current' END AS side, CAST(least(floor(defect_probability / (1.0 / 30)), 29) AS INTEGER) AS bin, count(*) AS n
  FROM e GROUP BY 1, 2)
SELECT side, bin, n, round(n / (sum(n) OVER (PARTITION BY side) * (CAST(1 AS DOUBLE) / 30)), 5) AS density FROM g""")
def score_density(spark, sf):
    side = F.when(F.col("period_label") == "p1", "reference").otherwise("current")
    rows = _events(spark, sf).withColumn("side", side)
    return histogram(rows, "defect_probability", 0.0, 1.0, 30, ["side"], density=True).select(
        "side", "bin", "n", F.round("density", 5).alias("density"))
