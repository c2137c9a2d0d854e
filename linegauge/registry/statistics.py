"""Correlation, regression, tests, monthly series."""

from pyspark.sql import functions as F

from linegauge.operators import stats, timeseries
from linegauge.operators.features import column_audit
from linegauge.registry.base import LINES, lines, month, query, table

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "failed"]
_PAIRS = [(a, b) for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]]


@query("corr_matrix", "ST1", f"WITH {LINES} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM li" for a, b in _PAIRS))
def corr_matrix(spark, sf):
    return stats.correlation_matrix(lines(spark, sf), NUMBERS).withColumn("corr", F.round("corr", 6))


@query("corr_rank", "ST2", f"WITH {LINES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, failed), 6) AS corr, round(abs(corr({c}, failed)), 6) AS strength "
    "FROM li" for c in NUMBERS[:-1]))
def corr_rank(spark, sf):
    out = stats.correlation_with(lines(spark, sf), "failed", NUMBERS[:-1])
    return out.withColumns({"corr": F.round("corr", 6), "strength": F.round("strength", 6)})


@query("trend_regression", "ST3 W5", """
WITH s AS (SELECT o_orderstatus, date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1, 2),
p AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY m) - 1 AS t FROM s)
SELECT o_orderstatus, round(regr_slope(n, t), 6) AS slope, round(regr_intercept(n, t), 6) AS intercept,
       round(corr(n, t), 6) AS r, count(*) AS n FROM p GROUP BY 1
""")
def trend_regression(spark, sf):
    series = timeseries.monthly_counts(table(spark, sf, "orders"), "o_orderdate", ["o_orderstatus"])
    out = timeseries.trend(series, "month", "records", ["o_orderstatus"])
    return out.withColumns({c: F.round(c, 6) for c in ("slope", "intercept", "r")})


@query("regression_by_group", "ST3", f"""
WITH {LINES}
SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
       round(corr(l_quantity, l_extendedprice), 6) AS r, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n
FROM li GROUP BY 1
""")
def regression_by_group(spark, sf):
    out = stats.regression(lines(spark, sf), "l_extendedprice", "l_quantity", ["l_returnflag"])
    return out.withColumns({"slope": F.round("slope", 4), "intercept": F.round("intercept", 4), "r": F.round("r", 6)})


@query("series_summary", "ST6 ST7 ST8 ST9 A14", """
WITH s AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1),
p AS (SELECT *, row_number() OVER (ORDER BY m) - 1 AS t, lag(n) OVER (ORDER BY m) AS prev FROM s),
y AS (SELECT var_samp(a) AS b FROM (SELECT avg(n) AS a FROM s GROUP BY month(m)))
SELECT count(*) AS months, round(avg(n), 6) AS mean, median(n) AS median, round(stddev_samp(n), 6) AS std,
  round(stddev_samp(n) / avg(n), 6) AS cv, CAST(min(n) AS DOUBLE) AS min,
  (SELECT strftime(m, '%Y-%m') FROM s ORDER BY n, m LIMIT 1) AS min_month, CAST(max(n) AS DOUBLE) AS max,
  (SELECT strftime(m, '%Y-%m') FROM s ORDER BY n DESC, m LIMIT 1) AS max_month, round(regr_slope(n, t), 6) AS slope,
  round(corr(n, prev), 6) AS acf1, round(CASE WHEN count(*) >= 24 THEN (SELECT b FROM y) / var_samp(n) END, 6)
  AS seasonal_strength FROM p
""")
def series_summary(spark, sf):
    series = timeseries.monthly_counts(table(spark, sf, "orders"), "o_orderdate")
    out = timeseries.series_summary(series, "month", "records")
    rounded = {c: F.round(c, 6) for c in ("mean", "std", "cv", "slope", "acf1", "seasonal_strength")}
    return out.withColumns({**rounded, "min_month": month("min_month"), "max_month": month("max_month")})


@query("welch_ttest", "ST4", f"""
WITH {LINES}, g AS (SELECT l_linestatus, avg(failed) FILTER (WHERE l_returnflag = 'R') AS ma,
  avg(failed) FILTER (WHERE l_returnflag = 'N') AS mb, var_samp(failed) FILTER (WHERE l_returnflag = 'R') AS va,
  var_samp(failed) FILTER (WHERE l_returnflag = 'N') AS vb, count(*) FILTER (WHERE l_returnflag = 'R') AS na,
  count(*) FILTER (WHERE l_returnflag = 'N') AS nb FROM li GROUP BY 1)
SELECT l_linestatus, round(ma, 6) AS mean_a, round(mb, 6) AS mean_b, na AS n_a, nb AS n_b,
  round((ma - mb) / sqrt(va / na + vb / nb), 5) AS t, round(pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) +
  pow(vb / nb, 2) / (nb - 1)), 3) AS df FROM g
""")
def welch_ttest(spark, sf):
    out = stats.welch(lines(spark, sf), "failed", F.col("l_returnflag") == "R", F.col("l_returnflag") == "N",
                      ["l_linestatus"])
    # the p-value is checked by unit tests; SQL has no t distribution
    return out.select("l_linestatus", F.round("mean_a", 6).alias("mean_a"), F.round("mean_b", 6).alias("mean_b"),
                      "n_a", "n_b", F.round("t", 5).alias("t"), F.round("df", 3).alias("df"))


@query("welch_p_value", "ST4")
def welch_p_value(spark, sf):
    return stats.welch(lines(spark, sf), "failed", F.col("l_returnflag") == "R", F.col("l_returnflag") == "N",
                       ["l_linestatus"]).select("l_linestatus", F.round("p", 4).alias("p"))


@query("point_biserial", "ST5", """
WITH d AS (SELECT l.quality, d.n_chars, length(d.source) AS source_len FROM labels l JOIN documents d USING (doc_id)),
r AS (SELECT 'n_chars' AS "column", corr(quality, n_chars) AS r, count(*) AS n FROM d UNION ALL
  SELECT 'source_len', corr(quality, source_len), count(*) FROM d)
SELECT "column", round(r, 6) AS r, n, round(r * sqrt((n - 2) / (1 - r * r)), 5) AS t FROM r
""")
def point_biserial(spark, sf):
    rows = table(spark, sf, "labels").join(
        table(spark, sf, "documents").select("doc_id", "n_chars", F.length("source").alias("source_len")), "doc_id")
    out = stats.point_biserial(rows, "quality", ["n_chars", "source_len"])
    return out.select("column", F.round("r", 6).alias("r"), "n", F.round("t", 5).alias("t"))


@query("biserial_p_value", "ST5", """
WITH d AS (SELECT l.quality, d.n_chars, length(d.source) AS source_len FROM labels l JOIN documents d USING (doc_id)),
r AS (SELECT 'n_chars' AS "column", corr(quality, n_chars) AS r, count(*) - 2 AS n FROM d UNION ALL
  SELECT 'source_len', corr(quality, source_len), count(*) - 2 FROM d),
a AS (SELECT "column", n, atan(abs(r) * sqrt(n / (1 - r * r)) / sqrt(n)) AS angle FROM r),
k AS (SELECT "column", n, angle, unnest(range(0, n // 2)) AS k FROM a),
f AS (SELECT *, CASE WHEN k = 0 THEN CASE WHEN n % 2 = 1 THEN ln(cos(angle)) ELSE 0 END WHEN n % 2 = 1 THEN
  ln(cos(angle) * cos(angle) * 2 * k / (2 * k + 1)) ELSE ln(cos(angle) * cos(angle) * (2 * k - 1) / (2 * k)) END AS step FROM k),
t AS (SELECT "column", n, angle, sum(exp(term)) AS total FROM (SELECT *, sum(step) OVER (PARTITION BY "column" ORDER BY k) AS term
  FROM f) GROUP BY 1, 2, 3)
SELECT "column", round(1 - CASE WHEN n % 2 = 1 THEN 2 / pi() * (angle + sin(angle) * total) ELSE sin(angle) * total END, 6) AS p FROM t
""")
def biserial_p_value(spark, sf):
    """p-values at whole degrees of freedom, where SQL can add up the closed form."""
    rows = table(spark, sf, "labels").join(
        table(spark, sf, "documents").select("doc_id", "n_chars", F.length("source").alias("source_len")), "doc_id")
    return stats.point_biserial(rows, "quality", ["n_chars", "source_len"]).select("column", F.round("p", 6).alias("p"))


@query("categorical_signal", "ST10", """
WITH d AS (SELECT quality, lang, source FROM labels JOIN documents USING (doc_id)),
g AS (SELECT 'lang' AS "column", lang AS v, avg(quality) AS r FROM d GROUP BY 2 UNION ALL
  SELECT 'source', source, avg(quality) FROM d GROUP BY 2)
SELECT "column", count(*) AS n_groups, round(min(r), 6) AS min_rate, round(max(r), 6) AS max_rate,
  round(max(r) - min(r), 6) AS range, CASE WHEN max(r) - min(r) > 0.02 THEN 'YES' ELSE 'NO' END AS signal
FROM g GROUP BY 1
""")
def categorical_signal(spark, sf):
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id")
    out = stats.categorical_signal(rows, "quality", ["lang", "source"])
    return out.withColumns({c: F.round(c, 6) for c in ("min_rate", "max_rate", "range")})


@query("feature_summary", "ST11 M4", """
WITH d AS (SELECT l.quality, d.n_chars, d.lang, d.source, l.toxic FROM labels l JOIN documents d USING (doc_id))
SELECT 'n_chars' AS feature, 'numeric' AS kind, CAST(0 AS DOUBLE) AS null_pct, count(DISTINCT n_chars) AS n_unique,
  round(corr(quality, n_chars), 6) AS corr, 'candidate' AS role FROM d UNION ALL
SELECT 'toxic', 'numeric', 0.0, count(DISTINCT toxic), round(corr(quality, toxic), 6), 'leakage' FROM d UNION ALL
SELECT 'lang', 'categorical', 0.0, count(DISTINCT lang), NULL, 'candidate' FROM d UNION ALL
SELECT 'source', 'categorical', 0.0, count(DISTINCT source), NULL, 'non_predictive' FROM d
""")
def feature_summary(spark, sf):
    rows = table(spark, sf, "labels").join(
        table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
    out = stats.feature_summary(rows, "quality", ["n_chars", "toxic"], ["lang", "source"])
    audit = column_audit(rows, ["toxic"], ["source"], "quality").select(F.col("column").alias("feature"), "role")
    return out.join(audit, "feature").withColumns({"corr": F.round("corr", 6), "null_pct": F.round("null_pct", 4)})
