"""Canonical ids and controlled vocabularies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings found in the quality system for each defect code.
DEFECT_SPELLINGS = {
    "Dimensional": ["Dimensional", "DIMENSIONAL", "Dim", "dimensional", "dim.", "Dimentional", "Dimension Error"],
    "Surface Scratch": ["Surface Scratch", "Scratch", "SCRATCH", "surface scratch", "scrach", "Scr", "surface scr"],
    "Burr": ["Burr", "BURR", "burr", "Bur", "Sharp Edge", "sharp edge", "Sharp Burr"],
    "Weld Defect": ["Weld Defect", "WELD", "weld defect", "Weld", "weld def.", "Welding Issue", "Weld Reject"],
    "Incorrect Material": ["Incorrect Material", "Wrong Material", "Mat Error", "incorrect material", "MATERIAL",
                           "Wrong Mat"],
    "Bend Angle": ["Bend Angle", "BEND", "bend angle", "Angle Error", "angle err", "Bend", "Out of Angle"],
    "Porosity": ["Porosity", "POROSITY", "porosity", "Poros.", "Void", "void", "Gas Pocket"],
    "None": ["None", "NONE", "none", "No Defect", "OK", "Pass", "", "PASS"],
}

# Spellings of each scrap reason.
SCRAP_REASON_SPELLINGS = {
    "OPERATOR_ERROR": ["OPERATOR_ERROR", "Operator Error", "Op Error", "operator error", "op err", "human error",
                       "Operator"],
    "MATERIAL_DEFECT": ["MATERIAL_DEFECT", "Material Defect", "Mat Defect", "material defect", "bad material",
                        "Incoming Defect"],
    "MACHINE_ISSUE": ["MACHINE_ISSUE", "Machine Issue", "Mach Issue", "machine issue", "equipment failure", "Machine"],
    "SETUP_ERROR": ["SETUP_ERROR", "Setup Error", "set up error", "setup err", "Setup", "First Article Fail"],
    "DESIGN_ISSUE": ["DESIGN_ISSUE", "Design Issue", "print error", "design issue", "drawing error",
                     "Print Rev Error"],
    "UNKNOWN": ["UNKNOWN", "Unknown", "unknown", "N/A", "TBD", "", "Not Recorded", "See Notes"],
}


def canonical_id(col, prefix: str, spellings: Sequence[str]) -> Column:
    """``<spelling><space or dash><digits>`` -> ``<prefix>-<digits>``; anything else unchanged."""
    col = F.col(col) if isinstance(col, str) else col
    text = F.upper(F.trim(col))
    forms = "|".join(spellings)
    return F.regexp_replace(text, rf"^(?:{forms})[- ]?(\d+)$", f"{prefix}-$1")


def canonical_part(col) -> Column:
    """P1234, p-1234, PART-1234, P 1234 -> P-1234."""
    return canonical_id(col, "P", ["PART", "P"])


def canonical_lot(col) -> Column:
    """LOT1234, L-1234, 1234 -> LOT-1234."""
    return canonical_id(col, "LOT", ["LOT", "L", ""])


def vocabulary(spellings: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Folded spelling -> code."""
    return {v.strip().lower(): code for code, variants in spellings.items() for v in variants}


def vocabulary_table(spark: SparkSession, spellings: Mapping[str, Sequence[str]]) -> DataFrame:
    return spark.createDataFrame(sorted(vocabulary(spellings).items()), "variant string, code string")


def to_vocabulary(col, spellings: Mapping[str, Sequence[str]], empty_code: str | None = None) -> Column:
    """Code of a free-text spelling, null when the spelling is unknown."""
    col = F.col(col) if isinstance(col, str) else col
    pairs = [F.lit(x) for kv in sorted(vocabulary(spellings).items()) for x in kv]
    code = F.try_element_at(F.create_map(*pairs), F.lower(F.trim(col)))
    return code if empty_code is None else F.when(
        col.isNull() | (F.trim(col) == ""), F.lit(empty_code)).otherwise(code)


def map_to_vocabulary(df: DataFrame, col: str, table: DataFrame, out: str = "code") -> DataFrame:
    """Vocabulary held as a table: left join on the folded spelling, unmatched rows flagged.

    The vocabulary has one row per spelling; Spark broadcasts it while it is below the
    broadcast threshold and shuffles both sides beyond it.
    """
    lookup = table.select(F.col("variant").alias("_variant"), F.col("code").alias(out))
    key = F.lower(F.trim(F.col(col)))
    return (df.join(lookup, key == F.col("_variant"), "left").drop("_variant")
            .withColumn(f"{out}_unmatched", F.col(col).isNotNull() & F.col(out).isNull()))


def repair_ids(df: DataFrame, col: str, people: DataFrame, id_col: str, name_col: str,
               id_pattern: str, out: str) -> DataFrame:
    """Ids typed as a name: keep what looks like an id, look the rest up by name."""
    names = people.groupBy(F.col(name_col).alias("_name")).agg(F.min(id_col).alias("_id"))
    shaped = F.when(F.col(col).rlike(id_pattern), F.col(col))
    return (df.join(names, F.col(col) == F.col("_name"), "left")
            .withColumn(out, F.coalesce(shaped, F.col("_id"))).drop("_name", "_id"))
