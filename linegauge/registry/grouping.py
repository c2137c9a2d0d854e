"""Aggregations, windows, sorts and set operations."""

from pyspark.sql import functions as F

from linegauge.functions import exprs as x
from linegauge.operators import dedup, quantiles, rates, timeseries
from linegauge.operators.business import flag_overlap, ranked_drivers
from linegauge.operators.evaluate import tier_counts
from linegauge.operators.prefix import running_sums, split_points
from linegauge.operators.quality import class_balance
from linegauge.plans import kpi
from linegauge.registry.base import (LINES, ORDER_LINES, day, lines, money, month, order_lines, query, table)
from linegauge.session import fan_out


@query("operator_scorecard", "A1 A2 A3 K13", f"""
WITH {ORDER_LINES}, r AS (SELECT o_custkey AS op, failed / inspected AS rate, failed, cost FROM ol),
fleet AS (SELECT round(avg(rate), 4) AS v FROM r)
SELECT c_custkey, c_mktsegment, count(*) AS total_jobs, round(avg(rate), 4) AS mean_rate,
       round(quantile_cont(rate, 0.5), 4) AS median_rate, CAST(sum(failed) AS BIGINT) AS failed,
       count(*) FILTER (WHERE failed > 0) AS jobs_with_defect,
       round(CAST(count(*) FILTER (WHERE failed > 0) AS DOUBLE) / nullif(count(*), 0) * 100, 1) AS pct_with_defect,
       (SELECT v FROM fleet) AS peer_rate, round(round(avg(rate), 4) - (SELECT v FROM fleet), 4) AS vs_peer,
       coalesce(round(CAST(sum(cost) FILTER (WHERE failed > 0) AS DOUBLE), 4), 0) AS cost
FROM r JOIN customer ON op = c_custkey GROUP BY 1, 2
""")
def operator_scorecard(spark, sf):
    rows = order_lines(spark, sf).withColumn("rate", x.ratio("failed", "inspected")).select(
        F.col("o_custkey").alias("c_custkey"), "rate", "failed", "cost")
    stats = rows.groupBy("c_custkey").agg(
        F.count("*").alias("total_jobs"), F.round(F.avg("rate"), 4).alias("mean_rate"),
        F.sum("failed").alias("failed"), F.count_if(F.col("failed") > 0).alias("jobs_with_defect"),
        F.round(rates.conditional_share(F.col("failed") > 0), 1).alias("pct_with_defect"),
        F.coalesce(money(F.sum(F.when(F.col("failed") > 0, F.col("cost")))), F.lit(0.0)).alias("cost"),
        F.sum("rate").alias("s"))
    medians = quantiles.exact_quantiles(rows, ["c_custkey"], "rate", {"m": 0.5})
    fleet = rates.scalar_of(stats, F.round(F.sum("s") / F.sum("total_jobs"), 4))
    return (table(spark, sf, "customer").select("c_custkey", "c_mktsegment").join(stats, "c_custkey")
            .join(medians, "c_custkey").withColumn("median_rate", F.round("m", 4)).drop("m", "s")
            .withColumn("peer_rate", fleet)
            .withColumn("vs_peer", F.round(F.col("mean_rate") - F.col("peer_rate"), 4)))


@query("quantiles", "A4 A3", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
       round(quantile_cont(l_extendedprice, 0.95), 4) AS p95, round(quantile_cont(l_extendedprice, 0.01), 4) AS p01
FROM lineitem GROUP BY 1
""")
def price_quantiles(spark, sf):
    out = quantiles.exact_quantiles(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice",
                                    {"median": 0.5, "p95": 0.95, "p01": 0.01})
    return out.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("median", "p95", "p01")])


@query("weighted_vs_mean_rate", "A6 A7 K1", f"""
WITH {ORDER_LINES}
SELECT o_orderpriority, CAST(sum(inspected) AS BIGINT) AS inspected, CAST(sum(failed) AS BIGINT) AS failed,
       round(sum(failed) / sum(inspected), 6) AS weighted_rate, round(avg(failed / inspected), 6) AS mean_rate,
       count(*) AS n, count(*) < 10 AS low_n,
       round((SELECT avg(failed / inspected) FROM ol), 6) AS overall_mean
FROM ol GROUP BY 1
""")
def weighted_vs_mean_rate(spark, sf):
    out = rates.rates_by(order_lines(spark, sf), ["o_orderpriority"], "failed", "inspected", min_group=10)
    return out.withColumns({c: F.round(c, 6) for c in ("weighted_rate", "mean_rate", "overall_mean")})


@query("distinct_and_frequency", "A8 A9 A23", """
WITH m AS (SELECT event_type AS top_type FROM events GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, event_type = (SELECT top_type FROM m) AS is_mode
FROM events GROUP BY 1
""")
def distinct_and_frequency(spark, sf):
    events = table(spark, sf, "events")
    freq = rates.frequency(events, "event_type")
    top = rates.frequency(events, "event_type", 1).select("event_type").scalar()
    users = events.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    return freq.join(users, "event_type").withColumn("is_mode", F.col("event_type") == top)


@query("monthly_named_agg", "A10 K6 K8", f"""
WITH {ORDER_LINES}, last AS (SELECT max(order_month) AS m FROM ol),
g AS (SELECT order_month, sum(inspected) AS i, sum(failed) AS f FROM ol, last
      WHERE order_month >= m - INTERVAL 11 MONTH GROUP BY 1)
SELECT strftime(order_month, '%Y-%m') AS month, CAST(i AS BIGINT) AS inspected, CAST(f AS BIGINT) AS failed,
       round(f / i, 6) AS rate, round((SELECT avg(f / i) FROM g), 6) AS mean_rate FROM g
""")
def monthly_named_agg(spark, sf):
    out = kpi.monthly_rate(order_lines(spark, sf), "order_month", "inspected", "failed")
    return out.select(month("order_month").alias("month"), "inspected", "failed", F.round("rate", 6).alias("rate"),
                      F.round("mean_rate", 6).alias("mean_rate"))


@query("rate_lines_full_axis", "K8 A10 J18", f"""
WITH {ORDER_LINES}, last AS (SELECT max(order_month) AS m FROM ol),
w AS (SELECT ol.* FROM ol, last WHERE order_month >= m - INTERVAL 11 MONTH),
axis AS (SELECT d, a FROM (SELECT DISTINCT o_custkey AS d FROM w),
         (SELECT CAST(unnest(generate_series((SELECT min(order_month) FROM w)::TIMESTAMP, (SELECT max(order_month)
          FROM w)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS a)),
g AS (SELECT order_month, o_custkey, sum(inspected) AS i, sum(failed) AS f FROM w GROUP BY 1, 2)
SELECT d AS o_custkey, strftime(a, '%Y-%m') AS month, CAST(i AS BIGINT) AS inspected, CAST(f AS BIGINT) AS failed,
       round(f / i, 6) AS rate FROM axis LEFT JOIN g ON a = order_month AND d = o_custkey
""")
def rate_lines_full_axis(spark, sf):
    rows = order_lines(spark, sf)
    recent = kpi.trailing(rows, "order_month")
    out = kpi.rate_lines(recent, "order_month", "o_custkey", "inspected", "failed")
    return out.select("o_custkey", month("order_month").alias("month"), "inspected", "failed",
                      F.round("rate", 6).alias("rate"))


@query("two_level_mean", "A11", f"""
WITH {ORDER_LINES}
SELECT l_returnflag, round(avg(f), 6) AS mean_failed_per_month, round(avg(c), 2) AS mean_cost_per_month
FROM (SELECT l_returnflag, order_month, sum(failed) AS f, CAST(sum(cost) AS DOUBLE) AS c FROM ol GROUP BY 1, 2)
GROUP BY 1
""")
def two_level_mean(spark, sf):
    monthly = order_lines(spark, sf).groupBy("l_returnflag", "order_month").agg(
        F.sum("failed").alias("f"), F.sum("cost").alias("c"))
    return monthly.groupBy("l_returnflag").agg(
        F.round(F.avg("f"), 6).alias("mean_failed_per_month"),
        F.round(F.avg(F.col("c").cast("double")), 2).alias("mean_cost_per_month"))


@query("pivot_matrix", "A12 K10", f"""
WITH {ORDER_LINES}
SELECT o_orderpriority, coalesce(round(avg(failed / inspected) FILTER (WHERE o_orderstatus = 'F'), 6), 0) AS "F",
       coalesce(round(avg(failed / inspected) FILTER (WHERE o_orderstatus = 'O'), 6), 0) AS "O",
       coalesce(round(avg(failed / inspected) FILTER (WHERE o_orderstatus = 'P'), 6), 0) AS "P"
FROM ol GROUP BY 1
""")
def pivot_matrix(spark, sf):
    rate = F.round(F.avg(x.ratio("failed", "inspected")), 6)
    return rates.matrix(order_lines(spark, sf), ["o_orderpriority"], "o_orderstatus", ["F", "O", "P"], rate)


@query("row_share", "A13 K11", f"""
WITH {ORDER_LINES}, g AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM ol GROUP BY 1, 2)
SELECT o_orderpriority, o_orderstatus, n, round(n / sum(n) OVER (PARTITION BY o_orderpriority), 6) AS share FROM g
""")
def row_share(spark, sf):
    counts = order_lines(spark, sf).groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    return rates.share_within(counts, ["o_orderpriority"], "n").withColumn("share", F.round("share", 6))


@query("argmin_argmax", "A14", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice, l_orderkey) AS lo,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey) AS hi FROM lineitem)
SELECT l_returnflag, max(l_orderkey) FILTER (WHERE lo = 1) AS min_order, min(l_extendedprice) AS min_price,
       max(l_orderkey) FILTER (WHERE hi = 1) AS max_order, max(l_extendedprice) AS max_price FROM r GROUP BY 1
""")
def argmin_argmax(spark, sf):
    p, o = F.col("l_extendedprice"), F.col("l_orderkey")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.min_by(o, F.struct(p, o)).alias("min_order"), F.min(p).alias("min_price"),
        F.min_by(o, F.struct(-p, o)).alias("max_order"), F.max(p).alias("max_price"))


@query("spread", "A15 ST8", """
SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS std, round(var_samp(l_quantity), 6) AS var,
       round(stddev_samp(l_quantity) / avg(l_quantity), 6) AS cv FROM lineitem GROUP BY 1
""")
def spread(spark, sf):
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.round(F.stddev_samp(q), 6).alias("std"), F.round(F.var_samp(q), 6).alias("var"),
        F.round(F.stddev_samp(q) / F.avg(q), 6).alias("cv"))


@query("describe", "A16", """
SELECT l_linestatus, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean,
       round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
       round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS q3, max(l_extendedprice) AS max
FROM lineitem GROUP BY 1
""")
def describe(spark, sf):
    rows = table(spark, sf, "lineitem")
    p = F.col("l_extendedprice")
    base = rows.groupBy("l_linestatus").agg(
        F.count(p).alias("n"), F.round(F.avg(p), 4).alias("mean"), F.round(F.stddev_samp(p), 4).alias("std"),
        F.min(p).alias("min"), F.max(p).alias("max"))
    q = quantiles.exact_quantiles(rows, ["l_linestatus"], "l_extendedprice", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return base.join(q.select("l_linestatus", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")]),
                     "l_linestatus")


@query("sample_values", "A17 A25", """
SELECT p_type, min(substr(p_name, 1, 60)) AS example,
       array_to_string(list_slice(list_sort(list(DISTINCT p_name)), 1, 2), ' → ') AS first_two
FROM part GROUP BY 1
""")
def sample_values(spark, sf):
    # the two smallest distinct values by rank: no set of all values is ever held
    names = table(spark, sf, "part").groupBy("p_type", "p_name").agg(F.count("*").alias("n"))
    two = dedup.top_per_group(names, ["p_type"], 2, F.asc("p_name")).groupBy("p_type").agg(
        F.array_join(F.array_sort(F.collect_list("p_name")), " → ").alias("first_two"),
        F.min(F.substring("p_name", 1, 60)).alias("example"))
    return two.select("p_type", "example", "first_two")


@query("group_collect", "A18", """
SELECT user_id, count(DISTINCT event_type) AS kinds, min(value) AS low, max(value) AS high,
       array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types FROM events GROUP BY 1
""")
def group_collect(spark, sf):
    # the set holds at most the few event types
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.countDistinct("event_type").alias("kinds"), F.min("value").alias("low"), F.max("value").alias("high"),
        F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"))


@query("min_group_size", "A19 K16", f"""
WITH {ORDER_LINES}
SELECT c_custkey, split_part(c_name, '#', 1) AS short_name, count(*) AS n, round(avg(failed / inspected), 6) AS mean_rate,
       count(*) < 60 AS low_n
FROM ol JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2 HAVING count(*) >= 45
""")
def min_group_size(spark, sf):
    rows = order_lines(spark, sf).withColumn("rate", x.ratio("failed", "inspected"))
    ranked = rates.mean_by(rows, ["o_custkey"], "rate", min_group=60).where("n >= 45")
    return ranked.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", F.split("c_name", "#")[0].alias("short_name"), "n", F.round("mean_rate", 6).alias("mean_rate"),
        "low_n")


@query("operator_spotlight", "K16", f"""
WITH {ORDER_LINES}, top AS (SELECT o_custkey AS k FROM ol GROUP BY 1 ORDER BY avg(failed / inspected) DESC, 1 LIMIT 1)
SELECT o_custkey, l_returnflag, count(*) AS n, round(avg(failed / inspected), 6) AS mean_rate
FROM ol WHERE o_custkey = (SELECT k FROM top) GROUP BY 1, 2
""")
def operator_spotlight(spark, sf):
    rows = order_lines(spark, sf).withColumn("rate", x.ratio("failed", "inspected"))
    worst = rates.mean_by(rows, ["o_custkey"], "rate").orderBy(F.desc("mean_rate"), "o_custkey").limit(1)
    one = rows.where(F.col("o_custkey") == worst.select("o_custkey").scalar())
    return rates.mean_by(one, ["o_custkey", "l_returnflag"], "rate").select(
        "o_custkey", "l_returnflag", "n", F.round("mean_rate", 6).alias("mean_rate"))


@query("histogram", "A20", """
WITH e AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'reference' ELSE 'current' END AS side, value FROM events),
r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS width FROM events),
g AS (SELECT side, CAST(least(floor((value - lo) / width), 29) AS INTEGER) AS bin, count(*) AS n, max(lo) AS lo,
             max(width) AS width FROM e, r GROUP BY 1, 2)
SELECT side, bin, n, round(n / (sum(n) OVER (PARTITION BY side) * width), 6) AS density,
       round(lo + bin * width, 6) AS bin_start FROM g
""")
def value_histogram(spark, sf):
    side = F.when(F.col("ts") < F.to_timestamp(F.lit("2024-01-16")), "reference").otherwise("current")
    events = table(spark, sf, "events").withColumn("side", side)
    return quantiles.histogram(events, "value", bins=30, keys=["side"], density=True).select(
        "side", "bin", "n", F.round("density", 6).alias("density"), F.round("bin_start", 6).alias("bin_start"))


@query("box_stats", "A21", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS med,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
SELECT l_returnflag, count(*) AS n, round(max(q1), 4) AS q1, round(max(med), 4) AS median, round(max(q3), 4) AS q3,
       min(l_extendedprice) FILTER (WHERE l_extendedprice >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
       max(l_extendedprice) FILTER (WHERE l_extendedprice <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
       count(*) FILTER (WHERE l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1))
         AS outliers
FROM lineitem JOIN q USING (l_returnflag) GROUP BY 1
""")
def price_box_stats(spark, sf):
    out = quantiles.box_stats(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query("box_stats_overall", "A21", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3
           FROM events)
SELECT count(value) AS n, round(max(q1), 4) AS q1, round(max(med), 4) AS median, round(max(q3), 4) AS q3,
       min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
       max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
       count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
FROM events, q
""")
def value_box_stats(spark, sf):
    out = quantiles.box_stats(table(spark, sf, "events"), [], "value")
    return out.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query("class_balance", "A22 M12 Q13 Q14", """
SELECT lang, count(*) AS n, CAST(sum(quality) AS BIGINT) AS positives, CAST(count(*) - sum(quality) AS BIGINT)
       AS negatives, round(avg(quality), 6) AS rate,
       round(CASE WHEN count(*) - sum(quality) = 0 THEN NULL ELSE sum(quality) / (count(*) - sum(quality)) END, 6)
         AS odds, round((count(*) - sum(quality)) / greatest(sum(quality), 1), 6) AS class_weight,
       avg(quality) BETWEEN 0.2 AND 0.9 AS balance_ok, count(*) > 20 AS size_ok
FROM labels JOIN documents USING (doc_id) GROUP BY 1
""")
def label_balance(spark, sf):
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    out = class_balance(rows, "quality", 0.2, 0.9, 20, ["lang"])
    return out.withColumns({c: F.round(c, 6) for c in ("rate", "odds", "class_weight")})


@query("cost_per_event", "A24 K2", f"""
WITH {LINES}
SELECT l_returnflag, l_linestatus, round(CAST(sum(cost) AS DOUBLE), 4) AS total_cost, count(*) AS n,
       round(CAST(sum(cost) AS DOUBLE) / greatest(count(*), 1), 2) AS cost_per_event
FROM li WHERE failed > 0 GROUP BY 1, 2
""")
def cost_per_event(spark, sf):
    out = rates.cost_by(lines(spark, sf).where("failed > 0"), ["l_returnflag", "l_linestatus"], "cost")
    return out.select("l_returnflag", "l_linestatus", money("total_cost").alias("total_cost"), "n",
                      F.round(F.col("total_cost").cast("double") / F.greatest("n", F.lit(1)), 2)
                      .alias("cost_per_event"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("weekly_by_category", "A26 F17", f"""
SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week,
       {", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in EVENT_TYPES)} FROM events GROUP BY 1
""")
def weekly_by_category(spark, sf):
    rows = table(spark, sf, "events").withColumn("week", x.week_start("ts"))
    return rates.matrix(rows, [day("week").alias("week")], "event_type", EVENT_TYPES, F.count(F.lit(1)))


# -- windows ------------------------------------------------------------------

@query("dedup_first", "W1 C6", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) = 1
""")
def dedup_first(spark, sf):
    return dedup.keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_partkey", "l_suppkey",
                            "l_extendedprice", "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query("duplicate_groups", "W2 R12", """
WITH m AS (SELECT l_returnflag, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS dup FROM lineitem)
SELECT l_returnflag, count(*) AS n, count(*) FILTER (WHERE dup) AS in_duplicate_groups,
       CAST((SELECT coalesce(sum(c), 0) FROM (SELECT count(*) AS c FROM documents GROUP BY text, lang, source, n_chars
         HAVING count(*) > 1)) AS BIGINT) AS content_duplicates,
       CAST((SELECT coalesce(sum(c), 0) FROM (SELECT *, count(*) AS c FROM lineitem GROUP BY ALL HAVING count(*) > 1)) AS BIGINT) AS
         row_duplicates
FROM m GROUP BY 1
""")
def duplicate_groups(spark, sf):
    rows = table(spark, sf, "lineitem")
    content = dedup.duplicate_rows(table(spark, sf, "documents"), ["text", "lang", "source", "n_chars"])
    marked = dedup.mark_duplicates(rows.select("l_orderkey", "l_linenumber", "l_returnflag"),
                                   ["l_orderkey", "l_linenumber"], "dup")
    return marked.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count_if("dup").alias("in_duplicate_groups")).withColumn(
        "content_duplicates", content.select("dup_rows").scalar()).withColumn(
        "row_duplicates", dedup.duplicate_rows(rows).select("dup_rows").scalar())


@query("lag_pairs_acf", "W4 ST6", """
WITH s AS (SELECT o_orderstatus, date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1, 2),
p AS (SELECT o_orderstatus, n, lag(n) OVER (PARTITION BY o_orderstatus ORDER BY m) AS prev FROM s)
SELECT o_orderstatus, round(corr(n, prev), 6) AS acf1, count(prev) AS pairs FROM p GROUP BY 1
""")
def lag_pairs_acf(spark, sf):
    series = timeseries.monthly_counts(table(spark, sf, "orders"), "o_orderdate", ["o_orderstatus"])
    return timeseries.lag1(series, "month", "records", ["o_orderstatus"]).withColumn("acf1", F.round("acf1", 6))


@query("running_total_share", "W7 W9 K7", f"""
WITH {ORDER_LINES}, last AS (SELECT max(order_month) AS m FROM ol),
g AS (SELECT order_month, l_returnflag, sum(failed) AS v FROM ol, last WHERE order_month >= m - INTERVAL 11 MONTH
      GROUP BY 1, 2)
SELECT strftime(order_month, '%Y-%m') AS month, l_returnflag, CAST(v AS BIGINT) AS value,
       round(v / sum(v) OVER (PARTITION BY order_month), 6) AS share,
       CAST(coalesce(sum(v) OVER (PARTITION BY order_month ORDER BY l_returnflag ROWS BETWEEN UNBOUNDED PRECEDING
         AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM g
""")
def running_total_share(spark, sf):
    out = kpi.monthly_stack(order_lines(spark, sf), "order_month", "l_returnflag", "failed")
    return out.select(month("order_month").alias("month"), "l_returnflag", "value",
                      F.round("share", 6).alias("share"), "offset")


@query("period_comparison", "W8 K5 F15 F25", f"""
WITH {ORDER_LINES}, k AS (SELECT max(order_month) AS m, date_trunc('day', max(o_orderdate)) AS d FROM ol),
ev AS (SELECT *, CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month FROM li WHERE failed > 0),
w(wname, pname, os, oe, ms, me) AS (
  SELECT 'week', 'current', d - INTERVAL 7 DAY, d, NULL, NULL FROM k UNION ALL
  SELECT 'week', 'prior', d - INTERVAL 14 DAY, d - INTERVAL 7 DAY, NULL, NULL FROM k UNION ALL
  SELECT 'month', 'current', NULL, NULL, m, m FROM k UNION ALL
  SELECT 'month', 'prior', NULL, NULL, m - INTERVAL 1 MONTH, m - INTERVAL 1 MONTH FROM k UNION ALL
  SELECT 'ttm', 'current', NULL, NULL, m - INTERVAL 11 MONTH, DATE '2999-01-01' FROM k UNION ALL
  SELECT 'ttm', 'prior', NULL, NULL, m - INTERVAL 23 MONTH, m - INTERVAL 12 MONTH FROM k),
a AS (SELECT wname, pname, coalesce(sum(inspected), 0) AS qi, coalesce(sum(failed), 0) AS qf FROM w LEFT JOIN ol
  ON (os IS NOT NULL AND o_orderdate >= os AND o_orderdate < oe) OR (ms IS NOT NULL AND order_month BETWEEN ms AND me)
  GROUP BY 1, 2),
b AS (SELECT wname, pname, coalesce(sum(failed), 0) AS ps, coalesce(CAST(sum(cost) AS DOUBLE), 0) AS co,
             count(l_orderkey) AS n FROM w LEFT JOIN ev
  ON (os IS NOT NULL AND l_shipdate >= os AND l_shipdate < oe) OR (ms IS NOT NULL AND ship_month BETWEEN ms AND me)
  GROUP BY 1, 2),
v AS (SELECT * FROM (
  SELECT wname, pname, unnest(['parts_inspected', 'defects', 'defect_rate', 'parts_scrapped', 'scrap_cost',
    'cost_per_event']) AS measure, unnest([CAST(qi AS DOUBLE), CAST(qf AS DOUBLE), CASE WHEN qi > 0 THEN qf / qi
    ELSE 0.0 END, CAST(ps AS DOUBLE), co, co / greatest(n, 1)]) AS val FROM a JOIN b USING (wname, pname))),
p AS (SELECT wname, measure, max(val) FILTER (WHERE pname = 'current') AS cur,
             max(val) FILTER (WHERE pname = 'prior') AS prior FROM v GROUP BY 1, 2),
c AS (SELECT *, CASE WHEN prior <> 0 THEN (cur - prior) / abs(prior) END AS change FROM p)
SELECT wname AS "window", measure, round(cur, 4) AS cur, round(prior, 4) AS prior, round(change, 6) AS change,
       CASE WHEN change IS NULL THEN '' WHEN change > 0 THEN 'up' ELSE 'down' END AS arrow,
       CASE WHEN change IS NULL THEN 'neutral' WHEN measure = 'parts_inspected' THEN
         CASE WHEN change > 0 THEN 'good' ELSE 'bad' END
       WHEN change < 0 THEN 'good' ELSE 'bad' END AS verdict FROM c
""")
def period_comparison(spark, sf):
    events = lines(spark, sf).where("failed > 0").withColumn("ship_month", F.trunc("l_shipdate", "month"))
    out = kpi.kpi_cards(order_lines(spark, sf), events, "o_orderdate", "order_month", "l_shipdate", "ship_month",
                        "inspected", "failed", "failed", "cost")
    return out.select("window", "measure", F.round("cur", 4).alias("cur"), F.round("prior", 4).alias("prior"),
                      F.round("change", 6).alias("change"), "arrow", "verdict")


@query("topk_per_row", "W10 F28 F29", """
WITH c AS (SELECT event_id, unnest(['value', 'hour', 'key']) AS feature,
  unnest([round(value - 10, 4), CAST(hour(ts) - 12 AS DOUBLE), round(CAST(json_extract(props, '$.k') AS BIGINT) / 10.0
    - 5, 4)]) AS contribution FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY abs(contribution) DESC, feature) AS rn FROM c)
SELECT event_id, string_agg(feature || '=' || CASE WHEN contribution > 0 THEN 'increases_risk' ELSE 'decreases_risk' END,
       ';' ORDER BY rn) FILTER (WHERE rn <= 2) AS top_two, max(feature) FILTER (WHERE rn = 1) AS top_driver,
       max(contribution) FILTER (WHERE rn = 1) AS top_contribution FROM r GROUP BY 1
""")
def topk_per_row(spark, sf):
    from linegauge.functions.nested import driver, top_drivers

    k = F.from_json("props", "struct<k:bigint>")["k"]
    parts = {"value": F.round(F.col("value") - 10, 4), "hour": (F.hour("ts") - 12).cast("double"),
             "key": F.round(k / 10.0 - 5, 4)}
    candidates = F.array(*[driver(n, F.col("value"), e) for n, e in parts.items()])
    out = table(spark, sf, "events").withColumn("d", top_drivers(candidates, 2))
    return out.select("event_id", F.array_join(F.transform("d", lambda d: F.concat(
        d["feature"], F.lit("="), d["direction"])), ";").alias("top_two"),
        F.element_at("d", 1)["feature"].alias("top_driver"), F.element_at("d", 1)["contribution"].alias(
            "top_contribution"))


@query("topn_per_group", "O6", """
SELECT l_returnflag, CAST(rank AS INTEGER) AS rank, l_orderkey, l_extendedprice FROM (SELECT *, row_number() OVER (
  PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem)
WHERE rank <= 5
""")
def topn_per_group(spark, sf):
    rows = table(spark, sf, "lineitem")
    return dedup.top_per_group(rows, ["l_returnflag"], 5, F.desc("l_extendedprice"), F.asc("l_orderkey"),
                               F.asc("l_linenumber"), F.asc("l_partkey")).select(
        "l_returnflag", "rank", "l_orderkey", "l_extendedprice")


@query("rank_forced_last", "W11 K21", """
WITH t AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 4)
SELECT event_type, n, CAST(row_number() OVER (ORDER BY event_type = 'click', n DESC, event_type) AS INTEGER) AS rank FROM t
""")
def rank_forced_last(spark, sf):
    return ranked_drivers(table(spark, sf, "events"), "event_type", "click", 4)


@query("cumulative_distribution", "W12", """
WITH c AS (SELECT event_type, value, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, value, n, CAST(sum(n) OVER w AS BIGINT) AS upto,
       round(sum(n) OVER w / sum(n) OVER (PARTITION BY event_type), 6) AS cdf,
       lead(value) OVER (PARTITION BY event_type ORDER BY value) AS next_value
FROM c WINDOW w AS (PARTITION BY event_type ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""")
def cumulative_distribution(spark, sf):
    events, ranges = table(spark, sf, "events"), fan_out(spark)
    counts = events.groupBy("event_type", "value").agg(F.count("*").alias("n"))
    run = running_sums(counts, ["event_type"], "value", ["n"], ranges, split_points(events, "value", ranges))
    return run.select("event_type", "value", "n", F.col("n_upto").alias("upto"),
                      F.round(F.col("n_upto") / F.col("n_total"), 6).alias("cdf"), "next_value")


@query("tier_share", "A9 W9 M23", """
WITH e AS (SELECT event_type, CASE WHEN value <= 5 THEN 'Low' WHEN value <= 15 THEN 'Medium' ELSE 'High' END AS tier
           FROM events), g AS (SELECT event_type, tier, count(*) AS n FROM e GROUP BY 1, 2)
SELECT event_type, tier, n, round(n / sum(n) OVER (PARTITION BY event_type), 6) AS share FROM g
""")
def tier_share(spark, sf):
    tier = x.right_closed_bucket("value", [5, 15], ["Low", "Medium", "High"])
    rows = table(spark, sf, "events").withColumn("tier", tier)
    return tier_counts(rows, "tier", ["event_type"]).withColumn("share", F.round("share", 6))


# -- sorts and sets -------------------------------------------------------------

@query("multi_key_sort_limit", "O1 O5 O7", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 100
""")
def multi_key_sort_limit(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        F.asc_nulls_last("o_orderpriority"), F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(100)


@query("subset_and_overlap", "U3 U5", """
SELECT count(*) FILTER (WHERE value >= 15) AS n_a, count(*) FILTER (WHERE hour(ts) >= 18) AS n_b,
       count(*) FILTER (WHERE value >= 15 AND hour(ts) >= 18) AS n_both,
       count(*) FILTER (WHERE value >= 15 OR hour(ts) >= 18) AS n_either,
       (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')) AS outside_allowed
FROM events
""")
def subset_and_overlap(spark, sf):
    outside = table(spark, sf, "orders").agg(
        F.count_if(~F.col("o_orderstatus").isin("O", "F")).alias("v")).scalar()
    return flag_overlap(table(spark, sf, "events"), F.col("value") >= 15, F.hour("ts") >= 18).withColumn(
        "outside_allowed", outside)
