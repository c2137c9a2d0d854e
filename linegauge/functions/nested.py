"""Arrays of drivers: build, rank, read back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

DRIVER_TYPE = "array<struct<feature:string,value:double,contribution:double,direction:string>>"


def driver(feature, value, contribution) -> Column:
    contribution = F.col(contribution) if isinstance(contribution, str) else contribution
    feature = F.lit(feature) if isinstance(feature, str) else feature
    value = F.col(value) if isinstance(value, str) else value
    return F.struct(
        feature.alias("feature"),
        value.cast("double").alias("value"),
        F.round(contribution, 4).alias("contribution"),
        F.when(contribution > 0, "increases_risk").otherwise("decreases_risk").alias("direction"),
    )


def top_drivers(candidates: Column, k: int = 3) -> Column:
    """The k entries of largest |contribution|; ties go to the smaller feature name."""
    keyed = F.transform(candidates, lambda d: F.struct(
        (-F.abs(d["contribution"])).alias("o"), d["feature"].alias("f"), d.alias("d")))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda s: s["d"])


def parse_drivers(text) -> Column:
    """Drivers stored as JSON text; text that cannot be read gives an empty list."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.from_json(text, DRIVER_TYPE), F.array().cast(DRIVER_TYPE))


def driver_sentence(drivers: Column, labels: Mapping[str, str]) -> Column:
    """``label (arrow); label (arrow)`` for every driver of a row."""
    from linegauge.functions.exprs import map_value, title_text

    arrow = {"increases_risk": "increases risk", "decreases_risk": "decreases risk"}
    return F.array_join(F.transform(drivers, lambda d: F.concat(
        map_value(d["feature"], labels, title_text(d["feature"])),
        F.lit(" ("), map_value(d["direction"], arrow), F.lit(")"))), "; ")
