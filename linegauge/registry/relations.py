"""Join shapes."""

from pyspark.sql import functions as F

from linegauge.functions import exprs as x
from linegauge.operators import business, joins, rates
from linegauge.operators.dedup import keep_first
from linegauge.registry.base import LINES, SCORED, day, lines, money, month, query, scored_documents, table

FIRST_LINE = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("inner_spine", "J1", f"""
WITH {LINES}, first AS (
  SELECT * FROM li QUALIFY row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1)
SELECT o_orderkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS order_day, inspected, failed,
       round(failed / inspected, 6) AS defect_rate, CAST(datediff('hour', o_orderdate, l_shipdate) AS BIGINT) AS delay
FROM orders JOIN first ON o_orderkey = l_orderkey
""")
def inner_spine(spark, sf):
    first = keep_first(lines(spark, sf), ["l_orderkey"], *FIRST_LINE)
    return table(spark, sf, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_orderpriority", day("o_orderdate").alias("order_day"), "inspected", "failed",
        F.round(x.ratio("failed", "inspected"), 6).alias("defect_rate"),
        x.hours_crossed("o_orderdate", "l_shipdate").alias("delay"))


@query("star_enrich", "J2 J3", """
SELECT p_type, r_name, count(*) AS n, count(c_custkey) AS with_customer,
       round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS value
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
GROUP BY 1, 2
""")
def star_enrich(spark, sf):
    t = lambda n: table(spark, sf, n)
    c = F.col
    place = (t("supplier").join(t("nation"), c("s_nationkey") == c("n_nationkey"))
             .join(t("region"), c("n_regionkey") == c("r_regionkey")).select("s_suppkey", "r_name"))
    solvent = t("customer").where("c_acctbal > 0").select("c_custkey")
    return (t("lineitem").join(t("part"), c("l_partkey") == c("p_partkey"))
            .join(place, c("l_suppkey") == c("s_suppkey"))
            .join(t("orders"), c("l_orderkey") == c("o_orderkey"))
            .join(solvent, c("o_custkey") == c("c_custkey"), "left")
            .groupBy("p_type", "r_name").agg(
                F.count("*").alias("n"), F.count("c_custkey").alias("with_customer"),
                money(F.sum(c("l_extendedprice").cast("decimal(18,2)")), 2).alias("value")))


@query("event_cost_context", "J4 K14", f"""
WITH {LINES}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderpriority, p_type,
       strftime(date_trunc('month', l_shipdate), '%Y-%m') AS scrap_month,
       CAST(year(l_shipdate) AS INTEGER) AS scrap_year, CAST(month(l_shipdate) AS INTEGER) AS scrap_month_num,
       CAST(cost AS DOUBLE) AS total_cost, o_orderpriority = '1-URGENT' AND p_type = 'LARGE' AS is_p1,
       p_size > 40 AS is_p3
FROM li JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE failed > 0
""")
def event_cost_context(spark, sf):
    c = F.col
    scrap = lines(spark, sf).where("failed > 0")
    return (scrap.join(table(spark, sf, "orders"), c("l_orderkey") == c("o_orderkey"))
            .join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey")).select(
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderpriority", "p_type",
                month("l_shipdate").alias("scrap_month"), F.year("l_shipdate").alias("scrap_year"),
                F.month("l_shipdate").alias("scrap_month_num"), c("cost").cast("double").alias("total_cost"),
                x.all_of(c("o_orderpriority") == "1-URGENT", c("p_type") == "LARGE").alias("is_p1"),
                x.flag(c("p_size") > 40).alias("is_p3")))


@query("scalar_cross_join", "J5 A5", """
SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean_price,
       round(round(avg(o_totalprice), 4) - (SELECT round(avg(o_totalprice), 4) FROM orders), 3) AS vs_fleet
FROM orders GROUP BY 1
""")
def scalar_cross_join(spark, sf):
    orders = table(spark, sf, "orders")
    fleet = rates.scalar_of(orders, F.round(F.avg("o_totalprice"), 4))
    return orders.groupBy("o_orderpriority").agg(F.round(F.avg("o_totalprice"), 4).alias("mean_price")).withColumn(
        "vs_fleet", F.round(F.col("mean_price") - fleet, 3))


@query("left_join_aggregate_default", "J6", """
SELECT c_custkey, coalesce(round(CAST(s.v AS DOUBLE), 2), 0) AS spent FROM customer
LEFT JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders WHERE o_orderstatus = 'P'
           GROUP BY 1) s ON c_custkey = o_custkey
""")
def left_join_aggregate_default(spark, sf):
    paid = table(spark, sf, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    out = joins.with_total(table(spark, sf, "customer").select("c_custkey"), paid, "c_custkey", "v", "spent")
    return out.withColumn("spent", money("spent", 2))


@query("orphans_anti", "J7 U2", """
SELECT doc_id, count(*) AS n_rows FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 1
""")
def orphans_anti(spark, sf):
    return joins.orphans(table(spark, sf, "documents"), "doc_id", table(spark, sf, "labels"), "doc_id")


RELATIONS = [("documents", "doc_id", "labels", "doc_id"), ("orders", "o_custkey", "customer", "c_custkey"),
             ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("customer", "c_custkey", "orders", "o_custkey"),
             ("events", "user_id", "customer", "c_custkey")]


@query("integrity_report", "J7 J8 Q7", " UNION ALL ".join(f"""
SELECT * FROM (WITH c AS (SELECT {ck} AS k, count(*) AS n FROM {c} GROUP BY 1), p AS (SELECT DISTINCT {pk} AS k FROM {p} WHERE {pk} IS NOT NULL),
m AS (SELECT c.k, n, p.k IS NOT NULL AS hit FROM c LEFT JOIN p ON c.k = p.k)
SELECT '{c}.{ck} -> {p}.{pk}' AS relation, round(sum(n) FILTER (WHERE hit) * 100.0 / sum(n), 4) AS row_match_pct,
  round(100.0 - 100.0 * count(*) FILTER (WHERE k IS NOT NULL AND NOT hit) / greatest(count(k), 1), 4) AS distinct_match_pct,
  count(*) FILTER (WHERE k IS NOT NULL AND NOT hit) AS orphan_keys,
  coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT k FROM m WHERE k IS NOT NULL AND NOT hit ORDER BY k LIMIT 6)), '') AS sample FROM m)"""
    for c, ck, p, pk in RELATIONS))
def integrity_report(spark, sf):
    """Match rates of every relation, with a sample of the keys that have no parent."""
    return joins.integrity_report({n: table(spark, sf, n) for r in RELATIONS for n in (r[0], r[2])}, RELATIONS).withColumns(
        {c: F.round(c, 4) for c in ("row_match_pct", "distinct_match_pct")})


@query("segment_semi", "J9", f"""
WITH {LINES}
SELECT l_returnflag, count(*) AS n, round(CAST(sum(cost) AS DOUBLE), 4) AS cost FROM li
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
GROUP BY 1
""")
def segment_semi(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    segment = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    return joins.in_segment(lines(spark, sf), orders, "l_orderkey", segment).groupBy("l_returnflag").agg(
        F.count("*").alias("n"), money(F.sum("cost")).alias("cost"))


@query("match_rate", "J8 Q7", """
WITH c AS (SELECT d.doc_id, l.doc_id AS hit FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l
           ON d.doc_id = l.doc_id)
SELECT 'documents.doc_id' AS relationship, count(*) AS total_rows, count(hit) AS matched_rows,
       round(count(hit) * 100.0 / count(*), 4) AS row_match_pct,
       round(count(DISTINCT hit) * 100.0 / count(DISTINCT doc_id), 4) AS distinct_match_pct,
       count(DISTINCT doc_id) FILTER (WHERE hit IS NULL) AS orphan_keys,
       min(doc_id) FILTER (WHERE hit IS NULL) AS sample_orphan,
       CASE WHEN count(hit) = count(*) THEN 'PASS' ELSE 'FAIL' END AS status FROM c
""")
def match_rate(spark, sf):
    from linegauge.operators.quality import relationship_report

    out = relationship_report(table(spark, sf, "documents"), "documents", "doc_id",
                              table(spark, sf, "labels"), "doc_id")
    return out.withColumns({c: F.round(c, 4) for c in ("row_match_pct", "distinct_match_pct")})


@query("agg_then_join", "J11", f"""
WITH {LINES}, per AS (SELECT l_orderkey, sum(cost) AS cost, sum(failed) AS f, sum(inspected) AS i FROM li GROUP BY 1)
SELECT o_orderpriority, count(*) AS n, round(corr(CAST(cost AS DOUBLE), f / i), 6) AS r,
       round(CAST(sum(cost) AS DOUBLE), 4) AS cost
FROM per JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
""")
def agg_then_join(spark, sf):
    per = lines(spark, sf).groupBy("l_orderkey").agg(
        F.sum("cost").alias("c"), F.sum("failed").alias("f"), F.sum("inspected").alias("i"))
    joined = per.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.corr(F.col("c").cast("double"), x.ratio("f", "i")), 6).alias("r"),
        money(F.sum("c")).alias("cost"))


@query("topn_then_join", "J12 O3", f"""
WITH {LINES}, top AS (SELECT l_orderkey, sum(cost) AS cost FROM li GROUP BY 1 ORDER BY cost DESC, l_orderkey LIMIT 20)
SELECT l_orderkey, CAST(cost AS DOUBLE) AS cost, o_orderpriority, o_custkey
FROM top LEFT JOIN orders ON l_orderkey = o_orderkey
""")
def topn_then_join(spark, sf):
    top = lines(spark, sf).groupBy("l_orderkey").agg(F.sum("cost").alias("c")).orderBy(
        F.desc("c"), "l_orderkey").limit(20)
    return top.join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        "l_orderkey", F.col("c").cast("double").alias("cost"), "o_orderpriority", "o_custkey")


@query("queue_left_join", "J13 K19 O2 O4 P18 F18", f"""
WITH {SCORED}, p AS (
  SELECT doc_id, score AS defect_probability,
         CASE WHEN score <= 0.65 THEN 'Low' WHEN score <= 0.75 THEN 'Medium' ELSE 'High' END AS risk_tier FROM sd)
SELECT event_id, event_type, coalesce(defect_probability, 0.1) AS defect_probability,
       coalesce(risk_tier, 'Low') AS risk_tier,
       CASE WHEN hour(ts) BETWEEN 8 AND 13 THEN 'In Progress' ELSE 'Open' END AS status
FROM events LEFT JOIN p ON event_id = doc_id WHERE CAST(ts AS DATE) <= DATE '2024-01-02'
ORDER BY CASE coalesce(risk_tier, 'Low') WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END, ts, event_id LIMIT 35
""")
def queue_left_join(spark, sf):
    from linegauge.operators.evaluate import risk_tier

    preds = scored_documents(spark, sf).select(
        F.col("doc_id").alias("event_id"), F.col("score").alias("defect_probability"),
        risk_tier("score").alias("risk_tier"))
    orders = table(spark, sf, "events").where(x.in_period("ts", "2024-01-01", "2024-01-02")).select(
        "event_id", "event_type", "ts")
    queue = business.work_queue(orders, preds, "event_id", "ts")
    return business.in_queue_order(queue, "ts", "event_id", 35).select(
        "event_id", "event_type", "defect_probability", "risk_tier", "status")


@query("eligible_asof_join", "J14 C7", """
WITH lots AS (SELECT p_brand AS material, CAST(l_shipdate AS DATE) AS receipt,
                     l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS lot
              FROM lineitem JOIN part ON l_partkey = p_partkey),
ranked AS (SELECT *, row_number() OVER (PARTITION BY material ORDER BY receipt, lot) AS pos FROM lots),
days AS (SELECT material, receipt, max(pos) AS upto FROM ranked GROUP BY 1, 2),
demand AS (SELECT o_orderkey, 'Brand#' || (1 + o_custkey % 25) AS material, CAST(o_orderdate AS DATE) AS d FROM orders),
hit AS (SELECT o_orderkey, demand.material, d, upto FROM demand ASOF LEFT JOIN days
        ON demand.material = days.material AND demand.d >= days.receipt)
SELECT o_orderkey, hit.material, a.lot AS newest_lot, strftime(a.receipt, '%Y-%m-%d') AS newest_receipt,
       b.lot AS oldest_lot, CAST(CASE WHEN upto IS NULL THEN 0 ELSE least(upto, 60) END AS BIGINT) AS eligible
FROM hit LEFT JOIN ranked a ON hit.material = a.material AND hit.upto = a.pos
LEFT JOIN ranked b ON hit.material = b.material AND CASE WHEN hit.upto > 60 THEN hit.upto - 59 WHEN hit.upto > 0 THEN 1 END = b.pos
""")
def eligible_asof_join(spark, sf):
    c = F.col
    lot = c("l_orderkey") * 1_000_000 + c("l_partkey") * 10 + c("l_linenumber")
    lots = (table(spark, sf, "lineitem").join(table(spark, sf, "part"), c("l_partkey") == c("p_partkey"))
            .select(c("p_brand").alias("material"), c("l_shipdate").cast("date").alias("receipt"), lot.alias("lot")))
    demand = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("Brand#"), (1 + c("o_custkey") % 25).cast("string")).alias("material"),
        c("o_orderdate").cast("date").alias("d"))
    return joins.eligible_lots(demand, lots, "material", "d", "receipt", "lot").select(
        "o_orderkey", "material", "newest_lot", day("newest_receipt").alias("newest_receipt"), "oldest_lot", "eligible")


@query("join_dedup_right", "J15 W3", """
SELECT o_orderkey, o_orderpriority, l_partkey, l_extendedprice FROM orders LEFT JOIN (
  SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1) ON o_orderkey = l_orderkey
""")
def join_dedup_right(spark, sf):
    right = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.join_first(table(spark, sf, "orders"), right, "o_orderkey", *FIRST_LINE).select(
        "o_orderkey", "o_orderpriority", "l_partkey", "l_extendedprice")


@query("join_collision", "J16", """
SELECT a.o_orderkey, a.o_orderstatus AS status_x, b.o_orderstatus AS status_y, a.v AS price_x, b.v AS price_y
FROM (SELECT o_orderkey, o_orderstatus, o_totalprice AS v FROM orders) a
LEFT JOIN (SELECT o_orderkey, o_orderstatus, round(o_totalprice, -3) AS v FROM orders WHERE o_orderstatus <> 'P') b
ON a.o_orderkey = b.o_orderkey
""")
def join_collision(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    right = orders.where("status <> 'P'").select("o_orderkey", "status", F.round("price", -3).alias("price"))
    return joins.join_renamed(orders, right, "o_orderkey")


@query("feature_period_matrix", "J17 N9", """
WITH p AS (SELECT event_type, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 'p1' WHEN ts < TIMESTAMP '2024-01-21'
                  THEN 'p2' ELSE 'p3' END AS period, value FROM events),
s AS (SELECT event_type, period, avg(value) AS v FROM p GROUP BY 1, 2)
SELECT event_type, round(max(v) FILTER (WHERE period = 'p1'), 6) AS p1, round(max(v) FILTER (WHERE period = 'p2'), 6)
       AS p2, round(max(v) FILTER (WHERE period = 'p3'), 6) AS p3, round(avg(v), 6) AS mean_value FROM s GROUP BY 1
""")
def feature_period_matrix(spark, sf):
    t1, t2 = (F.to_timestamp(F.lit(d)) for d in ("2024-01-11", "2024-01-21"))
    period = F.when(F.col("ts") < t1, "p1").when(F.col("ts") < t2, "p2").otherwise("p3")
    scores = table(spark, sf, "events").groupBy("event_type", period.alias("period")).agg(F.avg("value").alias("v"))
    out = joins.period_matrix(scores, "event_type", "period", "v", ["p1", "p2", "p3"])
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("p1", "p2", "p3", "mean_value")])


@query("month_spine_gaps", "J18 Q10 F22", """
WITH o AS (SELECT date_trunc('month', min(o_orderdate)) AS m FROM orders GROUP BY o_custkey),
seen AS (SELECT m, count(*) AS n FROM o GROUP BY 1),
spine AS (SELECT unnest(generate_series((SELECT min(m) FROM seen), (SELECT max(m) FROM seen), INTERVAL 1 MONTH)) AS m)
SELECT strftime(spine.m, '%Y-%m') AS month, n, n IS NULL AS is_gap FROM spine LEFT JOIN seen ON spine.m = seen.m
""")
def month_spine_gaps(spark, sf):
    from linegauge.operators.quality import month_gaps

    # first orders of customers thin out over time, which leaves months without any
    firsts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    series = firsts.groupBy(F.trunc("first", "month").alias("m")).agg(F.count("*").alias("n"))
    gaps = month_gaps(series, "m").withColumn("gap", F.lit(True))
    full = joins.on_spine(series, "m", joins.month_spine(series, "m")).join(gaps, "m", "left")
    return full.select(month("m").alias("month"), "n", F.coalesce("gap", F.lit(False)).alias("is_gap"))
