"""Scans, sinks, projections, filters, scalar functions."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from linegauge.functions import exprs as x
from linegauge.functions import nested
from linegauge.operators import rates
from linegauge.operators.evaluate import nearest_point
from linegauge.registry.base import day, lines, LINES, money, month, query, table
from linegauge.session import scratch_path
from linegauge.sources import readers, sinks
from linegauge.sources.schemas import SOURCES


@query("csv_extracts_stored", "S1 S2 S8", """
SELECT 'orders' AS extract, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'P') AS marked,
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total FROM orders
UNION ALL SELECT 'suppliers', count(*), count(*) FILTER (WHERE s_nationkey = 3),
       round(CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE), 2) FROM supplier
""")
def csv_extracts_stored(spark, sf):
    """Tables written as CSV extracts of two systems, read back with missing ones left out, published as stored tables."""
    root = scratch_path(spark, "extracts")
    extracts = {
        "production_orders": table(spark, sf, "orders").select(
            F.col("o_orderkey").cast("string").alias("work_order_id"), F.col("o_orderstatus").alias("shift_code"),
            F.col("o_totalprice").alias("std_labor_hrs")),
        "operators": table(spark, sf, "supplier").select(
            F.col("s_suppkey").cast("string").alias("operator_id"), F.col("s_nationkey").cast("string").alias("cert_level"),
            F.col("s_acctbal").cast("string").alias("operator_name"))}
    for name, rows in extracts.items():
        src = SOURCES[name]
        wide = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name)
                             for f in T.StructType.fromDDL(src.schema)])
        wide.write.option("header", True).option("quote", '"').option("escape", '"').csv(f"{root}/{src.system}/{name}.csv")
    found = readers.read_sources(spark, root)
    out = None
    for label, name, mark, value, price in (("orders", "production_orders", "shift_code", "P", "std_labor_hrs"),
                                            ("suppliers", "operators", "cert_level", "3", "operator_name")):
        rows = sinks.publish(found[name], f"stored_{name}_{uuid.uuid4().hex}", stored=True, path=scratch_path(spark, name))
        part = rows.agg(F.count("*").alias("n"), F.count_if(F.col(mark) == value).alias("marked"),
                        money(F.sum(F.col(price).cast("decimal(18,2)")), 2).alias("total"))
        part = part.select(F.lit(label).alias("extract"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("scan_project_cast", "S3 S5 P1 P2", """
SELECT l_orderkey AS order_id, CAST(l_quantity AS INTEGER) AS qty, l_returnflag = 'R' AS returned,
       strftime(l_shipdate, '%Y-%m-%d') AS ship_day, l_extendedprice AS price
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity > 25
""")
def scan_project_cast(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.where((F.col("l_shipdate") >= F.to_timestamp(F.lit("1998-01-01"))) & (F.col("l_quantity") > 25)).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_quantity").cast("int").alias("qty"),
        (F.col("l_returnflag") == "R").alias("returned"), day("l_shipdate").alias("ship_day"),
        F.col("l_extendedprice").alias("price"))


@query("scan_period_params", "S4 S9 S10 P11", """
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE ts <= TIMESTAMP '2024-01-12') AS n_until_midnight,
       round(CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE), 4) AS total
FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13' GROUP BY 1
""")
def scan_period_params(spark, sf):
    events = table(spark, sf, "events")
    store = scratch_path(spark, "period-features")

    def compute():
        rows = readers.period_scan(events, ["event_id", "ts", "event_type", "value"], "ts", "2024-01-10", "2024-01-12")
        return readers.require_rows(rows, "events of the period").withColumn("period_label", F.lit("202401"))

    sinks.read_through(spark, store, "period_label", "202401", compute)
    cached = sinks.read_through(spark, store, "period_label", "202401", compute)
    literal = x.in_period("ts", "2024-01-10", "2024-01-12", closed_at_midnight=True)
    return cached.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count(F.when(literal, 1)).alias("n_until_midnight"),
        money(F.sum(F.col("value").cast("decimal(18,4)"))).alias("total"))


@query("sink_roundtrip_partitioned", "S6 S7", """
SELECT strftime(o_orderdate, '%Y%m') AS period_label, count(*) AS n,
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS total
FROM orders GROUP BY 1
""")
def sink_roundtrip_partitioned(spark, sf):
    orders = table(spark, sf, "orders").withColumn("period_label", F.date_format("o_orderdate", "yyyyMM"))
    path = sinks.write_partitioned(orders, scratch_path(spark, "orders-by-period"), "period_label")
    # the partition value comes back as a number unless it is read as text
    back = spark.read.schema(orders.schema).parquet(path)
    view = sinks.publish(back, "orders_by_period")
    summary = view.groupBy("period_label").agg(
        F.count("*").alias("n"), money(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).alias("total"))
    csv = sinks.write_csv_summary(summary, scratch_path(spark, "period-summary"))
    return readers.read_csv(spark, csv, "period_label string, n bigint, total double")


@query("sample_export", "S11 O5", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 200
""")
def sample_export(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    path = sinks.write_sample(orders, "o_orderkey", 200, scratch_path(spark, "orders-sample"))
    return readers.read_csv(spark, path, "o_orderkey bigint, o_orderpriority string, o_totalprice double")


@query("artifact_lookup_fallback", "S12 P18", """
SELECT lang, count(*) AS n, count(quality) AS n_labelled,
       CAST(sum(coalesce(quality, -1)) AS BIGINT) AS quality_filled
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang
""")
def artifact_lookup_fallback(spark, sf):
    labels = readers.read_first(spark, [f"{sf}/labels_of_run.parquet", f"{sf}/labels.parquet"])
    joined = table(spark, sf, "documents").select("doc_id", "lang").join(
        labels.select("doc_id", "quality"), "doc_id", "left")
    filled = joined.withColumn("q", F.col("quality")).fillna({"q": -1})
    return filled.groupBy("lang").agg(F.count("*").alias("n"), F.count("quality").alias("n_labelled"),
                                      F.sum("q").alias("quality_filled"))


SHIFTS = [("Shift A", "06:00:00", "13:59:59"), ("Shift B", "14:00:00", "21:59:59")]


@query("shift_bucket_coalesce", "P3 P4 F14", """
SELECT coalesce(CASE WHEN value >= 20 THEN 'Logged' END,
                CASE WHEN CAST(ts AS TIME) BETWEEN TIME '06:00:00' AND TIME '13:59:59' THEN 'Shift A'
                     WHEN CAST(ts AS TIME) BETWEEN TIME '14:00:00' AND TIME '21:59:59' THEN 'Shift B' END,
                '(none)') AS shift, count(*) AS n, min(strftime(ts, '%H:%M:%S.%f')) AS first_clock
FROM events GROUP BY 1
""")
def shift_bucket_coalesce(spark, sf):
    shift = F.coalesce(F.when(F.col("value") >= 20, "Logged"), x.clock_bucket("ts", SHIFTS), F.lit("(none)"))
    return table(spark, sf, "events").groupBy(shift.alias("shift")).agg(
        F.count("*").alias("n"), F.min(F.date_format("ts", "HH:mm:ss.SSSSSS")).alias("first_clock"))


@query("anomalous_time_flag", "P5 P17", """
SELECT event_type, count(*) AS n,
       CAST(sum(CASE WHEN CAST(ts AS TIME) NOT BETWEEN TIME '06:00:00' AND TIME '21:59:59' THEN 1 ELSE 0 END)
            AS BIGINT) AS anomalous
FROM events GROUP BY 1
""")
def anomalous_time_flag(spark, sf):
    outside = x.bit(~x.in_clock_window("ts", "06:00:00", "21:59:59"))
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.sum(outside).alias("anomalous"))


@query("safe_ratio_flags", "P6 P8 P9 P22 F24", f"""
WITH {LINES}
SELECT l_returnflag, l_linestatus, count(*) AS n,
       count(*) - count(CASE WHEN l_tax = 0 THEN NULL ELSE failed / l_tax END) AS undefined,
       round(avg(CASE WHEN l_tax = 0 THEN NULL ELSE failed / (l_tax * 100) END), 6) AS mean_ratio,
       count(*) FILTER (WHERE l_linenumber IN (1, 3, 5)) AS odd_lines,
       count(*) FILTER (WHERE failed > 0 AND l_tax = 0) AS failed_untaxed,
       count(*) FILTER (WHERE l_discount >= 0.07) AS over_threshold
FROM li GROUP BY 1, 2
""")
def safe_ratio_flags(spark, sf):
    r = x.ratio("failed", F.col("l_tax") * 100)
    return lines(spark, sf).groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.count(F.when(r.isNull(), 1)).alias("undefined"),
        F.round(F.avg(r), 6).alias("mean_ratio"), F.count_if(F.col("l_linenumber").isin(1, 3, 5)).alias("odd_lines"),
        F.count_if(x.all_of(F.col("failed") > 0, F.col("l_tax") == 0)).alias("failed_untaxed"),
        F.count_if(F.col("l_discount") >= 0.07).alias("over_threshold"))


@query("calendar_equality", "P12 P13", """
SELECT event_type, count(*) FILTER (WHERE CAST(ts AS DATE) = DATE '2024-01-15') AS on_day,
       count(*) FILTER (WHERE date_trunc('month', ts) = TIMESTAMP '2024-01-01') AS in_month
FROM events GROUP BY 1
""")
def calendar_equality(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count_if(x.on_day("ts", "2024-01-15")).alias("on_day"),
        F.count_if(x.month_start("ts") == F.lit("2024-01-01").cast("date")).alias("in_month"))


@query("null_policy_masks", "P10 P14", """
SELECT lang, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS in_segment,
       count(*) FILTER (WHERE quality IS NULL OR quality <> 1) AS in_complement,
       count(quality) AS with_value
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang
""")
def null_policy_masks(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    good = F.col("quality") == 1
    masked = df.groupBy("lang").agg(
        F.count("*").alias("n"), F.count_if(x.flag(good, False)).alias("in_segment"),
        F.count_if(x.flag(~good, True)).alias("in_complement"))
    kept = df.dropna(subset=["quality"]).groupBy("lang").agg(F.count("*").alias("with_value"))
    return masked.join(kept, "lang", "left").fillna({"with_value": 0})


@query("typed_column_selection", "P15 P16", """
SELECT 'c_acctbal' AS "column", 'numeric' AS kind, count(DISTINCT c_acctbal) AS n_distinct FROM customer UNION ALL
SELECT 'c_nationkey', 'numeric', count(DISTINCT c_nationkey) FROM customer UNION ALL
SELECT 'c_name', CASE WHEN count(DISTINCT c_name) <= 30 THEN 'categorical' ELSE 'text' END,
       count(DISTINCT c_name) FROM customer UNION ALL
SELECT 'c_mktsegment', CASE WHEN count(DISTINCT c_mktsegment) <= 30 THEN 'categorical' ELSE 'text' END,
       count(DISTINCT c_mktsegment) FROM customer
""")
def typed_column_selection(spark, sf):
    from linegauge.operators.profile import schema_summary

    df = table(spark, sf, "customer").drop("c_custkey")  # the declared key is not a candidate
    s = schema_summary(df)
    kind = F.when(F.col("dtype") != "string", "numeric").when(F.col("n_unique") <= 30, "categorical").otherwise("text")
    return s.select("column", kind.alias("kind"), F.col("n_unique").alias("n_distinct"))


@query("nearest_row", "P20", f"""
WITH {LINES}, curve AS (
  SELECT l_discount AS x, count(*) AS n, round(avg(failed), 6) AS mean_failed FROM li GROUP BY 1)
SELECT x, n, mean_failed FROM curve ORDER BY abs(x - 0.043), x LIMIT 1
""")
def nearest_row(spark, sf):
    curve = lines(spark, sf).groupBy(F.col("l_discount").alias("x")).agg(
        F.count("*").alias("n"), F.round(F.avg("failed"), 6).alias("mean_failed"))
    return nearest_point(curve, "x", 0.043)


@query("last_n_months", "P21 W6", """
WITH o AS (SELECT *, date_trunc('month', o_orderdate) AS m FROM orders),
last AS (SELECT DISTINCT m FROM o ORDER BY m DESC LIMIT 12)
SELECT strftime(m, '%Y-%m') AS month, o_orderstatus, count(*) AS n FROM o WHERE m IN (SELECT m FROM last) GROUP BY 1, 2
""")
def last_n_months(spark, sf):
    orders = table(spark, sf, "orders").withColumn("m", F.trunc("o_orderdate", "month"))
    return rates.last_months(orders, "m", 12).groupBy(month("m").alias("month"), "o_orderstatus").agg(
        F.count("*").alias("n"))


@query("constant_tag_union", "P19 U1", """
SELECT 'early' AS period_label, event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-11' GROUP BY 2
UNION ALL
SELECT 'middle', event_type, count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21'
GROUP BY 2 UNION ALL
SELECT 'late', event_type, count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-21' GROUP BY 2
""")
def constant_tag_union(spark, sf):
    events = table(spark, sf, "events")
    first, second = (F.to_timestamp(F.lit(d)) for d in ("2024-01-11", "2024-01-21"))
    early = events.where(F.col("ts") < first).withColumn("period_label", F.lit("early"))
    middle = events.where((F.col("ts") >= first) & (F.col("ts") < second)).withColumn("period_label", F.lit("middle"))
    late = events.where(F.col("ts") >= second).withColumn("period_label", F.lit("late"))
    return early.unionByName(middle).unionByName(late).groupBy("period_label", "event_type").agg(F.count("*").alias("n"))


@query("hour_boundary_diff", "P7 F13 F20", """
WITH e AS (SELECT event_type, ts AS a, ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS b FROM events)
SELECT event_type, CAST(sum(datediff('hour', a, b)) AS BIGINT) AS hours_crossed,
       CAST(max(datediff('hour', a, b)) AS BIGINT) AS longest,
       round(sum(CAST(epoch_us(b) - epoch_us(a) AS BIGINT)) / 60000000.0, 4) AS minutes
FROM e GROUP BY 1
""")
def hour_boundary_diff(spark, sf):
    later = F.timestamp_micros(F.unix_micros("ts") + F.floor(F.col("value") * 60).cast("bigint") * 1_000_000)
    e = table(spark, sf, "events").withColumn("later", later)
    hours = x.hours_crossed("ts", "later")
    return e.groupBy("event_type").agg(
        F.sum(hours).alias("hours_crossed"), F.max(hours).alias("longest"),
        F.round(F.sum(x.minutes_between("ts", "later")), 4).alias("minutes"))


# -- scalar functions -----------------------------------------------------------

@query("string_normalise", "F1 F3 F4 F5 F6 F7 F9", """
SELECT p_partkey, coalesce(lower(trim(p_name)), '__null__') AS folded, split_part(p_name, ' ', 1) AS first_token,
       p_brand || ' | ' || coalesce(nullif(p_type, 'PROMO'), '(no shift)') AS label,
       (' ' || p_name) <> trim(' ' || p_name) AS padded,
       upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) || ' Type' AS title,
       starts_with(p_brand, 'Brand#1') AS brand_one, contains(p_name, 'bolt') AS is_bolt,
       list_extract(string_split('cat__' || p_type, '__'), -1) AS plain
FROM part
""")
def string_normalise(spark, sf):
    c = F.col
    return table(spark, sf, "part").select(
        "p_partkey", x.normalised("p_name").alias("folded"), F.split("p_name", " ")[0].alias("first_token"),
        x.composite_label("p_brand", F.nullif(c("p_type"), F.lit("PROMO"))).alias("label"),
        x.has_outer_space(F.concat(F.lit(" "), c("p_name"))).alias("padded"),
        x.title_text(F.concat(c("p_type"), F.lit("_TYPE"))).alias("title"),
        F.startswith("p_brand", F.lit("Brand#1")).alias("brand_one"),
        F.contains("p_name", F.lit("bolt")).alias("is_bolt"),
        x.after_prefix(F.concat(F.lit("cat__"), c("p_type"))).alias("plain"))


@query("fingerprint", "F2", """
SELECT p_partkey, md5('p_name=' || lower(trim(p_name)) || '|p_brand=' || lower(trim(p_brand)) || '|p_size=' || p_size)
         AS print,
       md5('p_name=' || lower(trim(p_name)) || '|p_size=' || p_size) AS print_without_brand
FROM part
""")
def fingerprint(spark, sf):
    cols = ["p_name", "p_brand", "p_size"]
    return table(spark, sf, "part").select(
        "p_partkey", F.md5(x.fingerprint_text(cols, fold_case=True)).alias("print"),
        F.md5(x.fingerprint_text(cols, ["p_brand"], fold_case=True)).alias("print_without_brand"))


@query("parse_numbers", "F8 F21", """
SELECT p_brand, count(*) AS n, max(TRY_CAST(regexp_extract(p_brand, '#(\\d+)', 1) AS INTEGER)) AS brand_number,
       count(TRY_CAST(p_brand AS DOUBLE)) AS as_number, count(TRY_CAST(p_size AS DOUBLE)) AS size_as_number,
       max(TRY_CAST(regexp_extract(p_size || 'ga Steel', '(\\d+)ga', 1) AS INTEGER)) AS max_gauge,
       count(TRY_CAST(p_type AS TIMESTAMP)) AS as_time
FROM part GROUP BY 1
""")
def parse_numbers(spark, sf):
    number = F.regexp_extract("p_brand", r"#(\d+)", 1).try_cast("int")
    return table(spark, sf, "part").groupBy("p_brand").agg(
        F.count("*").alias("n"), F.max(number).alias("brand_number"),
        F.count(F.col("p_brand").try_cast("double")).alias("as_number"),
        F.count(F.col("p_size").cast("string").try_cast("double")).alias("size_as_number"),
        F.max(x.gauge_number(F.concat(F.col("p_size").cast("string"), F.lit("ga Steel")))).alias("max_gauge"),
        F.count(F.col("p_type").try_cast("timestamp")).alias("as_time"))


@query("reason_text", "F10 F32", """
WITH e AS (
  SELECT event_id, list_filter([CASE WHEN value > 20 THEN 'value above 20' END,
                                CASE WHEN event_type = 'error' THEN 'error event' END,
                                CASE WHEN hour(ts) >= 22 THEN 'late hour' END], lambda r: r IS NOT NULL) AS r
  FROM events)
SELECT event_id, array_to_string(r, ' | ') AS reasons,
       CAST(len(string_split(array_to_string(r, ' | '), ' | ')) AS BIGINT) AS parts FROM e WHERE len(r) > 0
""")
def reason_text(spark, sf):
    r = x.reasons((F.col("value") > 20, "value above 20"), (F.col("event_type") == "error", "error event"),
                  (F.hour("ts") >= 22, "late hour"))
    joined = F.array_join("r", " | ")
    return table(spark, sf, "events").withColumn("r", r).where(F.size("r") > 0).select(
        "event_id", joined.alias("reasons"), F.size(F.split(joined, r" \| ")).cast("bigint").alias("parts"))


@query("calendar_parts", "F11 F12 F15 F16 F18 F19", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start, CAST(year(o_orderdate) AS INTEGER) AS y,
       CAST(month(o_orderdate) AS INTEGER) AS m, strftime(o_orderdate, '%b ''%y') AS label,
       strftime(o_orderdate, '%Y%m') AS yyyymm,
       strftime(make_date(year(o_orderdate), month(o_orderdate), 1), '%Y-%m-%d') AS made,
       strftime(date_trunc('month', o_orderdate) - INTERVAL 11 MONTH, '%Y-%m-%d') AS ttm_start,
       strftime(date_trunc('month', o_orderdate) - INTERVAL 12 MONTH, '%Y-%m-%d') AS year_before, count(*) AS n
FROM orders GROUP BY ALL
""")
def calendar_parts(spark, sf):
    d, m = F.col("o_orderdate"), F.trunc("o_orderdate", "month")
    return table(spark, sf, "orders").groupBy(
        day(m).alias("month_start"), F.year(d).alias("y"), F.month(d).alias("m"),
        F.date_format(d, "MMM ''yy").alias("label"), F.date_format(d, "yyyyMM").alias("yyyymm"),
        day(F.make_date(F.year(d), F.month(d), F.lit(1))).alias("made"),
        day(F.add_months(m, -11)).alias("ttm_start"), day(F.add_months(m, -12)).alias("year_before"),
    ).agg(F.count("*").alias("n"))


@query("round_bucket", "F23 F26 F27 M23", """
WITH e AS (SELECT *, CASE WHEN value <= 5 THEN 'Low' WHEN value <= 15 THEN 'Medium' ELSE 'High' END AS tier FROM events)
SELECT tier, event_type, count(*) AS n, round(avg(value), 4) AS mean_value,
       round(max(value) * 1000, -3) AS max_thousands,
       round(CASE WHEN min(value) > 0 THEN max(value) / min(value) ELSE 0 END, 4) AS multiplier
FROM e GROUP BY 1, 2
""")
def round_bucket(spark, sf):
    tier = x.right_closed_bucket("value", [5, 15], ["Low", "Medium", "High"])
    return table(spark, sf, "events").groupBy(tier.alias("tier"), "event_type").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean_value"),
        F.round(F.max("value") * 1000, -3).alias("max_thousands"),
        F.round(x.ratio_or_zero(F.max("value"), F.min("value")), 4).alias("multiplier"))


@query("json_props", "F30", """
SELECT event_type, count(CAST(json_extract(props, '$.k') AS BIGINT)) AS with_key,
       CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS key_sum,
       CAST(0 AS BIGINT) AS unreadable
FROM events GROUP BY 1
""")
def json_props(spark, sf):
    k = F.from_json("props", "struct<k:bigint>")["k"]
    bad = nested.parse_drivers("props")  # an object is not a list of drivers: empty list
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count(k).alias("with_key"), F.sum(k).alias("key_sum"),
        F.sum(F.size(F.filter(bad, lambda d: d["feature"].isNotNull()))).alias("unreadable"))


@query("json_drivers", "F30", """
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 0 ELSE 2 END AS n_drivers,
       CASE WHEN user_id % 3 <> 0 THEN event_type END AS first_feature,
       CASE WHEN user_id % 3 <> 0 THEN value END AS first_value,
       CASE WHEN user_id % 3 <> 0 THEN CASE WHEN value - 10 > 0 THEN 'increases_risk' ELSE 'decreases_risk' END END
         AS first_direction
FROM events
""")
def json_drivers(spark, sf):
    """Driver lists written as JSON text and parsed back; every third text is broken."""
    listed = F.array(nested.driver(F.col("event_type"), "value", F.col("value") - 10),
                     nested.driver("user_id", F.col("user_id"), F.lit(-1.0)))
    text = F.when(F.col("user_id") % 3 == 0, F.lit("[{broken")).otherwise(F.to_json(listed))
    drivers = table(spark, sf, "events").select("event_id", nested.parse_drivers(text).alias("d"))
    first = lambda f: F.get(F.col("d"), F.lit(0))[f].alias(f"first_{f}")
    return drivers.select("event_id", F.size("d").alias("n_drivers"), first("feature"), first("value"), first("direction"))


@query("lookup_map_default", "J10 F31", """
SELECT n_name, CASE r_name WHEN (SELECT min(r_name) FROM region) THEN 'First region' ELSE r_name END AS region_label,
       CASE n_nationkey WHEN 0 THEN 'Home' WHEN 1 THEN 'Near' ELSE 'Abroad' END AS distance
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def lookup_map_default(spark, sf):
    region = table(spark, sf, "region")
    first = region.agg(F.min("r_name").alias("v")).scalar()
    named = region.withColumn("region_label", F.when(F.col("r_name") == first, "First region")
                              .otherwise(F.col("r_name")))
    joined = table(spark, sf, "nation").join(named, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_name", "region_label", x.map_value(
        F.col("n_nationkey").cast("string"), {"0": "Home", "1": "Near"}, F.lit("Abroad")).alias("distance"))
