"""Business analytics on the driver tables."""

from pyspark.sql import functions as F

from linegauge.functions import exprs as x
from linegauge.operators import business, rates
from linegauge.operators.features import time_split
from linegauge.plans import kpi
from linegauge.registry.base import (LINES, ORDER_LINES, SCORED, day, lines, money, month, order_lines, query,
                                     scored_documents, table)


@query("segment_multiplier", "K3", f"""
WITH {ORDER_LINES}, s AS (
  SELECT 'urgent' AS segment, o_orderpriority = '1-URGENT' AS a, o_orderpriority = '5-LOW' AS b, failed, inspected FROM ol
  UNION ALL SELECT 'returned', l_returnflag = 'R', l_returnflag <> 'R', failed, inspected FROM ol
  UNION ALL SELECT 'solvent', coalesce(c_acctbal > 8000, false), coalesce(NOT c_acctbal > 8000, true), failed, inspected
  FROM ol LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON o_custkey = c_custkey),
r AS (SELECT segment, sum(failed) FILTER (WHERE a) / sum(inspected) FILTER (WHERE a) AS ra,
             sum(failed) FILTER (WHERE b) / sum(inspected) FILTER (WHERE b) AS rb FROM s GROUP BY 1)
SELECT segment, round(ra, 6) AS segment_rate, round(rb, 6) AS baseline_rate, round(ra / rb, 6) AS multiplier FROM r
""")
def segment_multiplier(spark, sf):
    c = F.col
    known = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_acctbal")
    rows = order_lines(spark, sf).join(known, c("o_custkey") == c("c_custkey"), "left")
    solvent = c("c_acctbal") > 8000
    out = business.segment_multipliers(rows, {
        "urgent": (c("o_orderpriority") == "1-URGENT", c("o_orderpriority") == "5-LOW"),
        "returned": (c("l_returnflag") == "R", c("l_returnflag") != "R"),
        "solvent": (x.flag(solvent, False), x.flag(~solvent, True))}, "failed", "inspected")
    return out.withColumns({n: F.round(n, 6) for n in ("segment_rate", "baseline_rate", "multiplier")})


@query("savings", "K4", f"""
WITH {LINES}, o AS (SELECT orders.*, i, f, c FROM orders JOIN (SELECT l_orderkey, sum(inspected) AS i,
  sum(failed) AS f FROM li GROUP BY 1) ON o_orderkey = l_orderkey LEFT JOIN (SELECT l_orderkey AS k,
  CAST(sum(cost) AS DOUBLE) AS c FROM li WHERE failed > 0 GROUP BY 1) ON o_orderkey = k),
s AS (SELECT 'urgent' AS segment, 0.03 AS target, * FROM o WHERE o_orderpriority = '1-URGENT' UNION ALL
  SELECT 'finished', 0.04, * FROM o WHERE o_orderstatus = 'F'),
g AS (SELECT segment, max(target) AS target, sum(f) / sum(i) AS r, coalesce(sum(c), 0) AS cost FROM s GROUP BY 1),
m AS (SELECT count(DISTINCT date_trunc('month', o_orderdate)) AS n FROM orders)
SELECT segment, round(cost, 2) AS segment_cost, round(r, 6) AS rate, CAST(target AS DOUBLE) AS target_rate,
  round(cost * (r - target) / r, 0) AS savings, round(cost * (r - target) / r / (n / 12.0), 0) AS savings_per_year
FROM g, m
""")
def savings(spark, sf):
    li = lines(spark, sf)
    per = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("inspected").alias("i"),
                                                                   F.sum("failed").alias("f"))
    orders = table(spark, sf, "orders").join(per, "o_orderkey")
    costs = li.where("failed > 0").select(F.col("l_orderkey").alias("o_orderkey"), "cost")
    months = table(spark, sf, "orders").agg(F.countDistinct(F.trunc("o_orderdate", "month")).alias("v")).scalar()
    out = business.savings(orders, costs, "o_orderkey", {
        "urgent": (F.col("o_orderpriority") == "1-URGENT", 0.03), "finished": (F.col("o_orderstatus") == "F", 0.04)},
        "f", "i", "cost", months)
    return out.select("segment", F.round("segment_cost", 2).alias("segment_cost"), F.round("rate", 6).alias("rate"),
                      "target_rate", F.round("savings", 0).alias("savings"),
                      F.round("savings_per_year", 0).alias("savings_per_year"))


@query("cost_split", "K9", """
WITH s AS (SELECT date_trunc('month', l_shipdate) AS m, CAST(l_extendedprice AS DECIMAL(18,2)) AS material,
  CAST(l_extendedprice * l_tax AS DECIMAL(18,4)) AS labor FROM lineitem),
g AS (SELECT m, CAST(sum(material) AS DOUBLE) AS a, CAST(sum(labor) AS DOUBLE) AS b FROM s GROUP BY 1)
SELECT strftime(m, '%Y-%m') AS month, round(a, 2) AS material, round(b, 4) AS labor, round(a / (a + b), 6) AS
  material_share, round(b / (a + b), 6) AS labor_share FROM g
""")
def cost_split(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.trunc("l_shipdate", "month").alias("m"), F.col("l_extendedprice").cast("decimal(18,2)").alias("material"),
        (F.col("l_extendedprice") * F.col("l_tax")).cast("decimal(18,4)").alias("labor"))
    out = kpi.cost_split(rows, "m", "material", "labor")
    return out.select(month("m").alias("month"), money("material", 2).alias("material"), money("labor").alias("labor"),
                      F.round("material_share", 6).alias("material_share"),
                      F.round("labor_share", 6).alias("labor_share"))


@query("rate_two_dims", "K12", f"""
WITH {LINES}
SELECT p_type, n_name, CAST(sum(inspected) AS BIGINT) AS inspected, CAST(sum(failed) AS BIGINT) AS failed,
       round(sum(failed) / sum(inspected), 6) AS rate
FROM li JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey =
  n_nationkey GROUP BY 1, 2
""")
def rate_two_dims(spark, sf):
    c = F.col
    place = table(spark, sf, "supplier").join(table(spark, sf, "nation"), c("s_nationkey") == c("n_nationkey"))
    rows = (lines(spark, sf).join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey"))
            .join(place, c("l_suppkey") == c("s_suppkey")))
    return rates.rate_by(rows, ["p_type", "n_name"], "failed", "inspected").withColumn("rate", F.round("rate", 6))


@query("mart_wide", "K15", f"""
WITH {ORDER_LINES}
SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(order_month, '%Y-%m') AS order_month,
  CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month_num, p_type,
  p_size, inspected, failed, round(failed / inspected, 6) AS defect_rate, failed > 0 AS defect_flag,
  p_type = 'LARGE' AND o_orderstatus = 'F' AS is_p1, l_suppkey < 10 AS is_p2, p_size > 40 AS is_p3
FROM ol JOIN part ON l_partkey = p_partkey
""")
def mart_wide(spark, sf):
    c = F.col
    rows = order_lines(spark, sf).join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey"))
    return rows.select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", month("order_month").alias("order_month"),
        F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("order_month_num"), "p_type", "p_size",
        "inspected", "failed", F.round(x.ratio("failed", "inspected"), 6).alias("defect_rate"),
        x.flag(c("failed") > 0).alias("defect_flag"),
        x.all_of(c("p_type") == "LARGE", c("o_orderstatus") == "F").alias("is_p1"),
        x.flag(c("l_suppkey") < 10).alias("is_p2"), x.flag(c("p_size") > 40).alias("is_p3"))


@query("caught_value", "K17", f"""
WITH {SCORED}, c AS (SELECT o_orderkey AS doc_id, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v
  FROM orders GROUP BY 1), s AS (SELECT sd.*, coalesce(v, 0) AS v, score >= 0.65 AND quality = 1 AS hit FROM sd
  LEFT JOIN c USING (doc_id))
SELECT count(*) FILTER (WHERE hit) AS n_caught, round(sum(v) FILTER (WHERE hit), 2) AS caught_month,
  round(sum(v) FILTER (WHERE quality = 1), 2) AS defect_month, round(sum(v) FILTER (WHERE hit) * 12, -3) AS caught_year,
  round(sum(v) FILTER (WHERE quality = 1) * 12, -3) AS defect_year FROM s
""")
def caught_value(spark, sf):
    costs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"),
                                              F.col("o_totalprice").alias("v"))
    out = business.caught_value(scored_documents(spark, sf), costs, "doc_id", "v", F.col("score") >= 0.65,
                                F.col("quality") == 1)
    return out.withColumns({c: F.round(c, 2) for c in ("caught_month", "defect_month")})


@query("training_volume", "K18", f"""
WITH {ORDER_LINES}
SELECT strftime(order_month, '%Y-%m') AS month, CASE WHEN order_month < DATE '1999-01-01' THEN 'train'
  WHEN order_month < DATE '2000-07-01' THEN 'validation' ELSE 'test' END AS split, count(DISTINCT o_orderkey) AS orders,
  round(avg(CASE WHEN failed > 0 THEN 1 ELSE 0 END), 6) AS defect_rate FROM ol GROUP BY 1, 2
""")
def training_volume(spark, sf):
    rows = order_lines(spark, sf)
    split = time_split("order_month", "1998-12-31", "2000-06-30")
    return rows.groupBy(month("order_month").alias("month"), split.alias("split")).agg(
        F.countDistinct("o_orderkey").alias("orders"),
        F.round(F.avg((F.col("failed") > 0).cast("int")), 6).alias("defect_rate"))


T = business.RISK_TEXT


@query("risk_factors", "K20", f"""
WITH {ORDER_LINES}, j AS (
  SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN p_type = 'LARGE' THEN 'Bending' ELSE p_type END AS mt,
    CASE WHEN o_orderstatus = 'F' THEN 'Shift B' ELSE 'Shift A' END AS sh,
    CASE WHEN p_size > 35 THEN 'High' ELSE 'Low' END AS cx, p_size % 13 AS age,
    CASE WHEN l_tax > 0.06 THEN 'Conditional' ELSE 'Certified' END AS cert,
    CASE WHEN l_returnflag = 'A' THEN '14ga Steel' WHEN l_returnflag = 'R' THEN '12ga Steel' ELSE '20ga Steel' END AS mat,
    CASE WHEN l_linenumber = 1 THEN 'supplier' WHEN l_linenumber = 2 THEN 'is_lapsed_cert_op' ELSE 'machine_id' END AS drv,
    round(l_discount * 10, 2) AS p FROM ol JOIN part ON l_partkey = p_partkey),
t AS (SELECT *, CASE WHEN p <= 0.65 THEN 'Low' WHEN p <= 0.75 THEN 'Medium' ELSE 'High' END AS tier FROM j),
a AS (SELECT *, list_filter([
  CASE WHEN mt = 'Bending' AND sh = 'Shift B' THEN '{T["bending"]}' END,
  CASE WHEN cx = 'High' AND age > 8 THEN 'High complexity part on aging equipment (' || age || ' yrs old)'
       WHEN cx = 'High' THEN '{T["complex"]}' END,
  CASE WHEN contains(drv, 'supplier') OR contains(drv, 'cert') THEN
    CASE WHEN cert IN ('Conditional', 'Missing') THEN '{T["lot"]}' ELSE '{T["supply"]}' END END,
  CASE WHEN contains(drv, 'lapsed') THEN '{T["cert"]}' END], lambda v: v IS NOT NULL) AS f FROM t),
b AS (SELECT *, CASE WHEN len(f) < 2 THEN f || list_filter([
  CASE WHEN mt = 'Bending' AND cx = 'High' THEN '{T["tight_bend"]}' END,
  CASE WHEN sh = 'Shift B' AND age > 6 THEN '{T["age_shift"]}' END,
  CASE WHEN CAST(split_part(mat, 'ga', 1) AS INTEGER) <= 16 THEN '{T["thin"]}' END], lambda v: v IS NOT NULL)
  ELSE f END AS g FROM a),
c AS (SELECT *, CASE WHEN len(g) < 1 THEN CASE WHEN p > 0.8 THEN ['{T["many"]}'] WHEN p > 0.65 THEN ['{T["check"]}']
  ELSE [] END ELSE g END AS h FROM b)
SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, tier AS risk_tier,
  CASE WHEN tier = 'Low' THEN '' ELSE array_to_string(h[1:3], '; ') END AS factors,
  CASE tier WHEN 'High' THEN '{business.ACTION_TEXT["High"]}' WHEN 'Medium' THEN '{business.ACTION_TEXT["Medium"]}' END
  AS action FROM c
""")
def risk_factors(spark, sf):
    from linegauge.operators.evaluate import risk_tier

    c = F.col
    p = F.round(c("l_discount") * 10, 2)
    rows = order_lines(spark, sf).join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey")).select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(c("p_type") == "LARGE", "Bending").otherwise(c("p_type")).alias("machine_type"),
        F.when(c("o_orderstatus") == "F", "Shift B").otherwise("Shift A").alias("shift_code"),
        F.when(c("p_size") > 35, "High").otherwise("Low").alias("complexity"),
        (c("p_size") % 13).alias("machine_age_years"),
        F.when(c("l_tax") > 0.06, "Conditional").otherwise("Certified").alias("lot_cert_status"),
        F.when(c("l_returnflag") == "A", "14ga Steel").when(c("l_returnflag") == "R", "12ga Steel")
        .otherwise("20ga Steel").alias("material_type"),
        F.when(c("l_linenumber") == 1, "supplier").when(c("l_linenumber") == 2, "is_lapsed_cert_op")
        .otherwise("machine_id").alias("top_driver_feature"),
        p.alias("defect_probability"), risk_tier(p).alias("risk_tier"))
    return business.risk_factors(rows).select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "risk_tier",
        F.array_join("risk_factors", "; ").alias("factors"), "action")


@query("current_month_mix", "K22", f"""
WITH {LINES}, m AS (SELECT max(date_trunc('month', l_shipdate)) AS m FROM li),
f AS (SELECT li.*, date_trunc('month', l_shipdate) AS sm, date_trunc('week', l_shipdate) AS w FROM li WHERE failed > 0)
SELECT 'reason' AS part, l_returnflag AS label, count(*) AS n, NULL AS n_year_before,
  round(count(*) / sum(count(*)) OVER (), 6) AS share FROM f, m WHERE sm = m GROUP BY 2
UNION ALL SELECT 'disposition', l_linestatus, count(*), NULL, round(count(*) / sum(count(*)) OVER (), 6) FROM f, m
  WHERE sm = m GROUP BY 2
UNION ALL SELECT 'week', strftime(w, '%Y-%m-%d'), count(*), NULL, NULL FROM f WHERE w IN (SELECT DISTINCT w FROM f
  ORDER BY w DESC LIMIT 8) GROUP BY 2
UNION ALL SELECT 'line', CAST(l_linenumber AS VARCHAR), count(*) FILTER (WHERE sm = m), count(*) FILTER (WHERE sm = m -
  INTERVAL 12 MONTH), NULL FROM f, m WHERE sm IN (m, m - INTERVAL 12 MONTH) GROUP BY 2
""")
def current_month_mix(spark, sf):
    li = lines(spark, sf)
    last = li.agg(F.trunc(F.max("l_shipdate"), "month").alias("v")).scalar()
    f = li.where("failed > 0").withColumns({"sm": F.trunc("l_shipdate", "month"), "w": x.week_start("l_shipdate")})
    now = f.where(F.col("sm") == last)
    none = F.lit(None)

    def mix(part, col):
        counts = now.groupBy(F.col(col).alias("label")).agg(F.count("*").alias("n"))
        return rates.share_within(counts, [], "n").select(
            F.lit(part).alias("part"), "label", "n", none.cast("bigint").alias("n_year_before"),
            F.round("share", 6).alias("share"))

    weeks = rates.last_months(f, "w", 8).groupBy(day("w").alias("label")).agg(F.count("*").alias("n")).select(
        F.lit("week").alias("part"), "label", "n", none.cast("bigint").alias("n_year_before"),
        none.cast("double").alias("share"))
    year_ago = F.add_months(last, -12)
    pair = f.where((F.col("sm") == last) | (F.col("sm") == year_ago)).groupBy(
        F.col("l_linenumber").cast("string").alias("label")).agg(
        F.count_if(F.col("sm") == last).alias("n"), F.count_if(F.col("sm") == year_ago).alias("n_year_before")).select(
        F.lit("line").alias("part"), "label", "n", "n_year_before", none.cast("double").alias("share"))
    return mix("reason", "l_returnflag").unionByName(mix("disposition", "l_linestatus")).unionByName(
        weeks).unionByName(pair)
