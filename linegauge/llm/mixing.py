"""Mixing sources to target weights by Poisson replication.

Every source has a target repetition rate: the mean number of times one of its documents should be
seen so that the source fills its share of the mix. A document's count is the inverse of the Poisson
distribution with that mean at a uniform number hashed from the seed and the document's id; the
document is exploded by its count and all copies are put in the global order of a hash. The same seed
gives the same mix in the same order, whatever the partitions or retries.

Null sources form a source of their own, null ids draw by their text, null and empty texts count no
characters (a source without characters is repeated once on average), repeated rows draw alike, an
empty table gives an empty mix. Extra columns pass through unchanged, but for one named ``copy``, which
comes out as ``copy_in``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linegauge.llm.common import stored

SEED = 20240
#: Target weight of a source is its share of the characters to this power, so large sources shrink.
FLATTEN = 0.7
HEX_DIGITS = 13
RESERVED = ("copy", "_rate", "_cdf", "_count", "_key", "_mix_source")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) hashed from texts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint") / float(16 ** HEX_DIGITS)


def draw_key(seed: int) -> list[Column]:
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.coalesce(F.col("text"), F.lit(""))))
    return [F.lit(str(seed)), own]


def source_rates(docs: DataFrame, flatten: float = FLATTEN, weights: DataFrame | None = None) -> DataFrame:
    """Mean repetition per source: target characters over characters there are; the total stays.

    ``weights`` (source, weight) sets target weights; sources it lacks are left out of the mix.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint")).alias("chars"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("chars").cast("double"), F.lit(flatten)))
    else:
        given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double"))
        sizes = (sizes.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
                 .withColumn("weight", F.coalesce("weight", F.lit(0.0))))
    sizes = stored(sizes, "source-sizes")
    all_chars, all_weight = sizes.agg(F.sum("chars")).scalar(), sizes.agg(F.sum("weight")).scalar()
    share = F.try_divide(F.col("weight"), all_weight) * F.try_divide(all_chars, F.col("chars"))
    rate = F.when(F.col("chars") > 0, share).otherwise(F.lit(1.0) if weights is None else F.signum("weight"))
    return sizes.select("source", "chars", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def cdf(rate: Column) -> Column:
    """Poisson distribution function at 0, 1, 2, ... up to where what is left is below 1e-15."""
    top = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    step = F.aggregate(F.sequence(F.lit(1), top),
                       F.struct((-rate).alias("log"), F.array(F.exp(-rate)).alias("out")),
                       lambda a, k: F.struct((a["log"] + F.log(rate / k)).alias("log"),
                                             F.concat(a["out"], F.array(F.exp(a["log"] + F.log(rate / k))
                                                                        + F.element_at(a["out"], -1))).alias("out")),
                       lambda a: a["out"])
    return F.when(rate > 0, step).otherwise(F.array(F.lit(1.0)))


def replicate(docs: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """Documents exploded by their Poisson counts, with ``copy`` from 1, in the global order of a hash."""
    if clash := set(RESERVED) & set(docs.columns):
        docs = docs.withColumnsRenamed({c: f"{c}_in" for c in clash})
    table = stored(rates.select(F.col("source").alias("_mix_source"), cdf(F.col("rate")).alias("_cdf")), "rates")
    drawn = docs.join(table, F.col("source").eqNullSafe(F.col("_mix_source")))
    u = uniform(*draw_key(seed))
    drawn = drawn.withColumn("_count", F.size(F.filter("_cdf", lambda c: c <= u))).where("_count > 0")
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_count"))))
    key = uniform(*draw_key(seed), F.col("copy").cast("string"), F.lit("order"))
    mixed = copies.drop("_cdf", "_count", "_mix_source").withColumn("_key", key)
    # keys are even numbers from 0 to 1, so their ranges need no sample
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = mixed.repartitionById(parts, F.floor(F.col("_key") * parts).cast("int")).sortWithinPartitions("_key").drop("_key")
    return out.withColumnsRenamed({f"{c}_in": c for c in clash if c != "copy"}) if clash else out


def mix(docs: DataFrame, flatten: float = FLATTEN, weights: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    return replicate(docs, source_rates(docs, flatten, weights), seed)
