"""Feature contract, interaction features, time split, encoders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import (
    OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linegauge.functions.exprs import bit
from linegauge.session import cut_lineage, fan_out, scratch_path

# The feature contract.
CATEGORICAL = ["machine_type", "machine_id", "shift_code", "operator_id", "complexity", "material_type", "supplier",
               "lot_cert_status", "requires_welding"]
NUMERIC = ["machine_age_years", "std_labor_hrs", "quantity_ordered", "schedule_variance_hrs"]
INTERACTION = ["is_bending_shift_b", "is_high_complexity", "is_supplier_c_thin_gauge", "is_lapsed_cert_op"]
FEATURES = CATEGORICAL + NUMERIC + INTERACTION
TARGET, ID = "defect_flag", "work_order_id"

# Thin gauges and operators whose welding certificate has lapsed.
THIN_GAUGE = ["16ga Steel", "14ga Steel"]
LAPSED_OPERATORS = ["OP007", "OP009", "OP012", "OP015"]

# Columns known only after production (the target among them), in published order.
LEAKAGE = ["quantity_inspected", "quantity_passed", "quantity_failed", "defect_rate", "defect_code", "disposition",
           "is_anomalous_timestamp", "inspection_id", "inspection_date", "inspector_id", "defect_flag",
           "is_p1_combination", "is_p2_supplier", "is_p3_complexity", "is_p4_cert_mismatch"]
# Columns without predictive meaning, in published order.
NON_PREDICTIVE = ["work_order_id", "order_date", "order_month", "order_year", "order_month_num", "operator_name",
                  "machine_name", "machine_location", "operator_home_shift", "cert_level", "specialization",
                  "welding_cert_current", "welding_cert_mismatch", "hire_date", "lot_receipt_date", "lot_id", "customer",
                  "part_number"]


def interaction_features(df: DataFrame, lapsed: Column | None = None) -> DataFrame:
    """Four 0/1 features; a missing input gives 0. ``lapsed`` overrides the operator list."""
    lapsed = F.col("operator_id").isin(LAPSED_OPERATORS) if lapsed is None else lapsed
    return df.withColumns({
        "is_bending_shift_b": bit((F.col("machine_type") == "Bending") & (F.col("shift_code") == "Shift B")),
        "is_high_complexity": bit(F.col("complexity") == "High"),
        "is_supplier_c_thin_gauge": bit(
            (F.col("supplier") == "Supplier C") & F.col("material_type").isin(THIN_GAUGE)),
        "is_lapsed_cert_op": bit(lapsed),
    })


def time_split(ts: Column | str, train_end: str, validation_end: str, test_end: str | None = None,
               closed_at_midnight: bool = False) -> Column:
    """train / validation / test by time; rows after ``test_end`` get no split.

    By default each end day belongs to its split; ``closed_at_midnight`` reads the ends as
    instants (the end day then falls into the next split).
    """
    ts = F.col(ts) if isinstance(ts, str) else ts

    def until(day: str) -> Column:
        end = F.to_timestamp(F.lit(day))
        return ts <= end if closed_at_midnight else ts < end + F.expr("INTERVAL 1 DAY")

    late = F.lit("test") if test_end is None else F.when(until(test_end), "test")
    return F.when(ts.isNotNull(), F.when(until(train_end), "train").when(until(validation_end), "validation")
                  .otherwise(late))


def feature_table(mart: DataFrame, ts: str, train_end: str, validation_end: str, **kw) -> DataFrame:
    """id + features + target + split, ready to be written partitioned by split."""
    wide = interaction_features(mart)
    cols = [c for c in [ID, *FEATURES, TARGET] if c in wide.columns]
    return wide.select(*cols, time_split(ts, train_end, validation_end, **kw).alias("split"))


def column_audit(df: DataFrame, leakage: Sequence[str] = LEAKAGE, non_predictive: Sequence[str] = NON_PREDICTIVE,
                 target: str = TARGET) -> DataFrame:
    """Role of every column: target, leakage, non-predictive or candidate; absent listed columns too."""
    present = set(df.columns)
    role = {**{c: "leakage" for c in leakage}, **{c: "non_predictive" for c in non_predictive}, target: "target"}
    rows = [(c, role.get(c, "candidate"), True) for c in df.columns]
    rows += [(c, r, False) for c, r in role.items() if c not in present]
    return df.sparkSession.createDataFrame(rows, "column string, role string, present boolean")


# -- encoders ------------------------------------------------------------------

VOCABULARY = "column string, hash bigint, value string, code double"
#: Characters of a value that its range is told by.
RANGE_CHARS = 128


def category_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, hash, value, code): the vocabulary as a table, for columns whose values have no known bound.

    Codes are places in the order of the values; nulls have none. Values are dealt out by range of
    themselves and numbered inside their part; only the number of values of each part is summed up.
    """
    found = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    values = found.where(F.col("value").isNotNull()).distinct()
    # Spark samples range keys to the driver, so they are short beginnings: equal ones share a part, the order stays.
    # A second reading must deal the values out alike, so the parts are kept.
    begins = F.substring("value", 1, RANGE_CHARS)
    parts = cut_lineage(values.repartitionByRange(fan_out(df.sparkSession), "column", begins).withColumn("_part", F.spark_partition_id()))
    sizes = parts.groupBy("column", "_part").agg(F.count("*").alias("_n"))
    before = W.partitionBy("column").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # a row per part
    offsets = sizes.select("column", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("column", "_part").orderBy("value")
    numbered = parts.withColumn("_place", F.row_number().over(inside)).join(offsets, ["column", "_part"])
    return numbered.select("column", F.xxhash64("value").alias("hash"), "value",
                           (F.col("_before") + F.col("_place") - 1).cast("double").alias("code"))


def with_codes(df: DataFrame, codes: DataFrame, cols: Sequence[str], suffix: str = "_code") -> DataFrame:
    """Codes by a vocabulary table: a left join per column; unseen or missing is -1."""
    out = df
    for c in cols:
        own = codes.where(F.col("column") == c).select(F.col("hash").alias("_hash"), F.col("value").alias("_value"), F.col("code").alias("_code"))
        text = out[c].cast("string")
        out = out.join(own, (F.xxhash64(text) == F.col("_hash")) & (text == F.col("_value")), "left")
        out = out.withColumn(f"{c}{suffix}", F.coalesce("_code", F.lit(-1.0))).drop("_hash", "_value", "_code")
    return out


class VocabularyEncoder(Transformer, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Codes of values by a stored vocabulary table (``category_codes``); unseen or missing is -1.

    A persistable pipeline stage that holds the table's folder only. The table has one row per value, so a
    value that fills many rows is the skewed side of a join with unique keys, which Spark splits; a
    table under the session's threshold is broadcast by its measured size.
    """

    path = Param(Params._dummy(), "path", "folder of the vocabulary table", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, path=None, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = self.getInputCols()
        if not columns:
            return df
        codes = df.sparkSession.read.schema(VOCABULARY).parquet(self.getOrDefault(self.path))
        out = with_codes(df, codes, columns, "__code")
        return out.withColumnsRenamed({f"{c}__code": o for c, o in zip(columns, self.getOutputCols())})


def vocabulary_encoder(df: DataFrame, cols: Sequence[str], root: str | None = None) -> VocabularyEncoder:
    """Store the values of ``df`` (below ``root`` or in the scratch folder) and encode by them."""
    path = f"{root}/vocabulary" if root else scratch_path(df.sparkSession, "vocabulary")
    if cols:
        category_codes(df, cols).write.mode("overwrite").parquet(path)
    return VocabularyEncoder(path=path, inputCols=list(cols), outputCols=[f"{c}_code" for c in cols])


def linear_stages(categorical: Sequence[str], numeric: Sequence[str], out: str = "features") -> list:
    """One-hot categories (unseen: all zeros) and standardised numbers in one vector."""
    texts = [f"coalesce(cast(`{c}` as string), 'UNKNOWN') AS `{c}_text`" for c in categorical]
    numbers = [f"cast(coalesce(`{c}`, 0) as double) AS `{c}_num`" for c in numeric]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(texts + numbers)} FROM __THIS__")]
    vectors = []
    if categorical:
        stages += [StringIndexer(inputCols=[f"{c}_text" for c in categorical],
                                 outputCols=[f"{c}_idx" for c in categorical],
                                 stringOrderType="alphabetAsc", handleInvalid="keep"),
                   # the dropped slot is the one of unseen values
                   OneHotEncoder(inputCols=[f"{c}_idx" for c in categorical],
                                 outputCols=[f"{c}_hot" for c in categorical], dropLast=True)]
        vectors += [f"{c}_hot" for c in categorical]
    if numeric:
        stages += [VectorAssembler(inputCols=[f"{c}_num" for c in numeric], outputCol="_numbers"),
                   StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True)]
        vectors.append("_scaled")
    return [*stages, VectorAssembler(inputCols=vectors, outputCol=out)]


def fit_stages(stages: Sequence, df: DataFrame):
    return Pipeline(stages=list(stages)).fit(df)


def standardised(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """z-scores with the population standard deviation, by one struct-valued scalar subquery."""
    stats = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))])
    s = stats.select(F.struct("*").alias("v")).scalar()
    return df.withColumns({f"{c}_z": F.when(s[f"s_{c}"] > 0, (F.col(c) - s[f"m_{c}"]) / s[f"s_{c}"])
                           .otherwise(F.lit(0.0)) for c in cols})


def one_hot(df: DataFrame, vocab: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 columns per known category; an unseen value gives zeros everywhere."""
    return df.withColumns({f"{c}={v}": bit(F.col(c).cast("string") == v) for c, vs in vocab.items() for v in vs})
