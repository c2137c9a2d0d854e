"""Segment multipliers, savings, caught value, work-order queue, risk rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.functions.exprs import flag, gauge_number, map_value, ordinal, ratio_or_zero, reasons


def segment_multipliers(df: DataFrame, segments: Mapping[str, tuple[Column, Column]],
                        failed: str, inspected: str) -> DataFrame:
    """Rate of each segment against its baseline and their quotient, all in one pass.

    ``segments`` maps a name to (segment condition, baseline condition); the conditions
    carry their own null policy (see ``flag``).
    """
    aggs = []
    for i, (seg, base) in enumerate(segments.values()):
        for tag, cond in (("s", seg), ("b", base)):
            aggs += [F.coalesce(F.sum(F.when(cond, F.col(failed))), F.lit(0)).alias(f"_{tag}f{i}"),
                     F.coalesce(F.sum(F.when(cond, F.col(inspected))), F.lit(0)).alias(f"_{tag}i{i}")]
    items = [F.struct(F.lit(n).alias("segment"), ratio_or_zero(f"_sf{i}", f"_si{i}").alias("segment_rate"),
                      ratio_or_zero(f"_bf{i}", f"_bi{i}").alias("baseline_rate"))
             for i, n in enumerate(segments)]
    out = df.agg(*aggs).select(F.explode(F.array(*items)).alias("r")).select("r.*")
    return out.withColumn("multiplier", ratio_or_zero("segment_rate", "baseline_rate"))


def savings(orders: DataFrame, costs: DataFrame, key: str, segments: Mapping[str, tuple[Column, float]],
            failed: str, inspected: str, cost: str, months: Column) -> DataFrame:
    """Money saved if a segment met its target rate, in total and per year.

    Cost events carry no dimensions: their cost per order is summed first and joined to the
    orders, then every segment is a conditional sum in one pass. Segments overlap and do
    not add up. ``months`` is the number of calendar months the data spans.
    """
    per_order = costs.groupBy(key).agg(F.sum(cost).alias("_cost"))
    both = orders.join(per_order, key, "left")
    aggs = [e for i, (cond, _) in enumerate(segments.values()) for e in (
        F.coalesce(F.sum(F.when(flag(cond), F.col(failed))), F.lit(0)).alias(f"_f{i}"),
        F.coalesce(F.sum(F.when(flag(cond), F.col(inspected))), F.lit(0)).alias(f"_i{i}"),
        F.coalesce(F.sum(F.when(flag(cond), F.col("_cost"))), F.lit(0.0)).alias(f"_c{i}"))]
    items = [F.struct(F.lit(n).alias("segment"), F.col(f"_c{i}").cast("double").alias("segment_cost"),
                      ratio_or_zero(f"_f{i}", f"_i{i}").alias("rate"), F.lit(float(t)).alias("target_rate"))
             for i, (n, (_, t)) in enumerate(segments.items())]
    r = both.agg(*aggs).select(F.explode(F.array(*items)).alias("r")).select("r.*")
    saved = ratio_or_zero(F.col("segment_cost") * (F.col("rate") - F.col("target_rate")), "rate")
    return r.withColumn("savings", saved).withColumn("savings_per_year", saved / (months / F.lit(12.0)))


def caught_value(scored: DataFrame, costs: DataFrame, key: str, cost: str, flagged: Column, actual: Column) -> DataFrame:
    """Scrap value of the defects a model flagged, monthly and per year in thousands."""
    per_order = costs.groupBy(key).agg(F.sum(cost).alias("_cost"))
    rows = scored.join(per_order, key, "left").withColumn("_cost", F.coalesce("_cost", F.lit(0.0)))
    hit = flag(flagged & actual)
    return rows.agg(
        F.count(F.when(hit, 1)).alias("n_caught"),
        F.coalesce(F.sum(F.when(hit, F.col("_cost"))), F.lit(0.0)).alias("caught_month"),
        F.coalesce(F.sum(F.when(flag(actual), F.col("_cost"))), F.lit(0.0)).alias("defect_month"),
    ).select("*", F.round(F.col("caught_month") * 12, -3).alias("caught_year"),
             F.round(F.col("defect_month") * 12, -3).alias("defect_year"))


TIER_ORDER = ("High", "Medium", "Low")


def status_by_hour(ts) -> Column:
    """Work from 08:00 to 13:59 is in progress, everything else is open."""
    return F.when(F.hour(ts).between(8, 13), "In Progress").otherwise("Open")


def work_queue(orders: DataFrame, predictions: DataFrame, key: str, start: str,
               default_probability: float = 0.1, default_tier: str = "Low") -> DataFrame:
    """Orders with their prediction (defaults where missing), status and queue position columns."""
    joined = orders.join(predictions, key, "left")
    return joined.select(
        *[c for c in joined.columns if c not in ("defect_probability", "risk_tier")],
        F.coalesce("defect_probability", F.lit(default_probability)).alias("defect_probability"),
        F.coalesce("risk_tier", F.lit(default_tier)).alias("risk_tier"),
        status_by_hour(start).alias("status"),
    ).withColumn("tier_rank", ordinal("risk_tier", TIER_ORDER))


def in_queue_order(queue: DataFrame, start: str, key: str, n: int | None = None) -> DataFrame:
    out = queue.orderBy("tier_rank", F.asc_nulls_last(start), key)
    return out.limit(n) if n else out


def with_names(df: DataFrame, col: str, names: Mapping[str, str], out: str, default: str | None = None) -> DataFrame:
    """Display name of an id: from a small fixed map, else the id (or a default text)."""
    return df.withColumn(out, map_value(col, names, None if default is None else F.lit(default)))


# Texts shown to the shop floor.
RISK_TEXT = {
    "bending": "Bending setup conditions associated with higher-than-average rework rate",
    "complex": "High complexity part requiring tight tolerances",
    "lot": "Material lot has conditional certification status",
    "supply": "Material supply source has elevated historical defect rate",
    "cert": "Assigned operator has compliance certification gap",
    "tight_bend": "High complexity bend, tight angle tolerance required",
    "age_shift": "Equipment age increases setup sensitivity on second shift",
    "thin": "Thin gauge material requires precise feed pressure",
    "many": "Multiple concurrent risk factors detected",
    "check": "Setup conditions warrant pre-run supervisor check",
}
ACTION_TEXT = {
    "High": "Supervisor setup review required before job release",
    "Medium": "Review setup conditions before starting first piece",
}


def risk_factors(df: DataFrame) -> DataFrame:
    """Up to three plain-text risk factors and a recommended action per job.

    Reads machine_type, shift_code, complexity, machine_age_years, lot_cert_status,
    material_type, top_driver_feature, defect_probability, risk_tier. Jobs of other tiers
    than High and Medium get no factors and no action.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    driver, age = text("top_driver_feature"), F.coalesce(F.col("machine_age_years"), F.lit(0))
    bending, second = text("machine_type") == "Bending", text("shift_code") == "Shift B"
    complex_part = text("complexity") == "High"
    supply = driver.contains("supplier") | driver.contains("cert")
    doubtful_lot = text("lot_cert_status").isin("Conditional", "Missing")
    aging = F.concat(F.lit("High complexity part on aging equipment ("), age.cast("int").cast("string"),
                     F.lit(" yrs old)"))
    complex_case = driver.contains("complexity") | complex_part

    primary = reasons(
        (driver.contains("bending") | (bending & second), RISK_TEXT["bending"]),
        (complex_case & (age > 8), aging),
        (complex_case & ~(age > 8), RISK_TEXT["complex"]),
        (supply & doubtful_lot, RISK_TEXT["lot"]),
        (supply & ~doubtful_lot, RISK_TEXT["supply"]),
        (driver.contains("lapsed") | F.lower(driver).contains("op007"), RISK_TEXT["cert"]))
    gauge = gauge_number(text("material_type"))
    secondary = reasons(
        (bending & complex_part, RISK_TEXT["tight_bend"]),
        (second & (age > 6), RISK_TEXT["age_shift"]),
        (text("material_type").contains("Steel") & (gauge <= 16), RISK_TEXT["thin"]))
    fallback = reasons(
        (F.col("defect_probability") > 0.80, RISK_TEXT["many"]),
        ((F.col("defect_probability") > 0.65) & ~(F.col("defect_probability") > 0.80), RISK_TEXT["check"]))

    out = df.withColumn("_p", primary)
    out = out.withColumn("_p", F.when(F.size("_p") < 2, F.concat("_p", secondary)).otherwise(F.col("_p")))
    out = out.withColumn("_p", F.when(F.size("_p") < 1, fallback).otherwise(F.col("_p")))
    at_risk = F.col("risk_tier").isin(*ACTION_TEXT)
    return (out.withColumn("risk_factors", F.when(flag(at_risk), F.slice("_p", 1, 3))
                           .otherwise(F.array().cast("array<string>")))
            .withColumn("action", F.when(flag(at_risk), map_value("risk_tier", ACTION_TEXT))).drop("_p"))


def ranked_drivers(flagged: DataFrame, feature: str, forced_last: str | None = None, n: int = 5) -> DataFrame:
    """The n most frequent top drivers with a presentation rank; one value may be forced last."""
    from pyspark.sql import Window as W

    top = flagged.groupBy(feature).agg(F.count("*").alias("n")).orderBy(F.desc("n"), feature).limit(n)
    last = (F.col(feature) == forced_last).cast("int") if forced_last else F.lit(0)
    # the window sees at most n rows
    return top.withColumn("rank", F.row_number().over(W.orderBy(last, F.desc("n"), feature)))


def flag_overlap(df: DataFrame, a: Column, b: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Rows in a, in b, in both, and in either."""
    return df.groupBy(*keys).agg(
        F.count(F.when(a, 1)).alias("n_a"), F.count(F.when(b, 1)).alias("n_b"),
        F.count(F.when(a & b, 1)).alias("n_both"), F.count(F.when(a | b, 1)).alias("n_either"))
