"""Cleansing of ids and codes. Dirty spellings are derived from the driver tables."""

from pyspark.sql import functions as F

from linegauge.functions import codes
from linegauge.registry.base import query, table


@query("canonical_codes", "C1 C2", """
SELECT p_partkey, 'P-' || (1000 + p_partkey) AS part, 'LOT-' || (1000 + p_partkey) AS lot,
       upper(p_brand) AS untouched FROM part
""")
def canonical_codes(spark, sf):
    number = (F.col("p_partkey") + 1000).cast("string")
    glue = lambda prefix: F.concat(F.lit(prefix), number)
    kind = F.col("p_type")
    raw_part = (F.when(kind == "ECONOMY", glue("P")).when(kind == "SMALL", glue("p-")).when(kind == "LARGE", glue("PART-"))
                .when(kind == "PROMO", glue(" P ")).otherwise(glue("P-")))
    raw_lot = (F.when(kind == "ECONOMY", glue("LOT")).when(kind == "SMALL", number).when(kind == "LARGE", glue("L-"))
               .otherwise(glue("LOT-")))
    return table(spark, sf, "part").select("p_partkey", codes.canonical_part(raw_part).alias("part"),
                                           codes.canonical_lot(raw_lot).alias("lot"),
                                           codes.canonical_part("p_brand").alias("untouched"))


def _values(spellings):
    """Spellings in a fixed order with the code each stands for, and one unknown spelling."""
    flat = [(v, code) for code, variants in spellings.items() for v in variants]
    return [*flat, ("no such code", None)]


def _sql(spellings):
    flat = _values(spellings)
    rows = ", ".join(f"({i}, '{v}', {'NULL' if c is None else chr(39) + c + chr(39)})" for i, (v, c) in enumerate(flat))
    return (f"SELECT event_id, s.code AS code, s.code IS NULL AS unmatched FROM events JOIN (VALUES {rows}) s(i, v, code)"
            f" ON CAST(floor(value * 100) AS BIGINT) % {len(flat)} = s.i")


def _dirty(spark, sf, spellings):
    flat = _values(spellings)
    raw = F.element_at(F.array(*[F.lit(v) for v, _ in flat]),
                       (F.floor(F.col("value") * 100) % len(flat) + 1).cast("int"))
    return table(spark, sf, "events").select("event_id", raw.alias("raw"))


@query("vocabulary_map", "C3", _sql(codes.DEFECT_SPELLINGS))
def vocabulary_map(spark, sf):
    lookup = codes.vocabulary_table(spark, codes.DEFECT_SPELLINGS)
    out = codes.map_to_vocabulary(_dirty(spark, sf, codes.DEFECT_SPELLINGS), "raw", lookup)
    return out.select("event_id", "code", F.col("code_unmatched").alias("unmatched"))


@query("scrap_reason_map", "C4", _sql(codes.SCRAP_REASON_SPELLINGS))
def scrap_reason_map(spark, sf):
    code = codes.to_vocabulary("raw", codes.SCRAP_REASON_SPELLINGS, empty_code="UNKNOWN")
    return _dirty(spark, sf, codes.SCRAP_REASON_SPELLINGS).select(
        "event_id", code.alias("code"), code.isNull().alias("unmatched"))


@query("id_repair", "C5", """
SELECT o_orderkey, 'OP' || o_custkey AS operator_id FROM orders
""")
def id_repair(spark, sf):
    op = F.concat(F.lit("OP"), F.col("c_custkey").cast("string"))
    people = table(spark, sf, "customer").select(op.alias("id"), F.col("c_name").alias("name"), "c_custkey")
    orders = table(spark, sf, "orders").join(people, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("name")).otherwise(F.col("id")).alias("raw"))
    return codes.repair_ids(orders, "raw", people, "id", "name", r"^OP\d+$", "operator_id").select(
        "o_orderkey", "operator_id")
