"""Fixed virtual slots: records hash into thousands of slots, and a versioned map sends slots to shards.

A record never changes its slot. Bytes are summed per slot, the map gives every slot to a shard so
that shards hold nearly equal bytes, and rebalancing writes the map's next version, which moves few
slots. The map has ``n_slots`` rows whatever the size of the corpus, so it may be broadcast.

Sharding edits the stored map: where there is one, its latest version is rebalanced by the bytes measured
now and appended as the next version; where there is none, a first version is made.

Null ids are placed by their text, null texts have no bytes, repeated rows share a slot (their
positions differ), an empty table gives an empty result and an empty map keeps all its slots.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from linegauge.llm.common import stored

N_SLOTS = 4096
#: Parts that the records of a virtual slot are numbered in.
PARTS = 64
RECORD_OVERHEAD = 8
#: Part of the mean that a shard may hold above it before its slots are moved.
TOLERANCE = 0.002
MAP_SCHEMA = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("virtual_slot", T.IntegerType()),
                           T.StructField("shard", T.IntegerType()), T.StructField("bytes", T.LongType())])


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + RECORD_OVERHEAD


def virtual_slot(doc_id: Column, text: Column, n_slots: int = N_SLOTS) -> Column:
    """Slot of a record by a hash of its id alone (of its text when the id is null)."""
    hashed = F.md5(F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit("")))).cast("binary"))
    return (F.conv(F.substring(hashed, 1, 8), 16, 10).cast("bigint") % n_slots).cast("int")


def slot_bytes(records: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """Bytes of every slot from 0 to ``n_slots`` - 1, empty ones included; records have virtual_slot and size."""
    spark = records.sparkSession
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    slots = spark.range(n_slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return slots.join(sums, "virtual_slot", "left").select("virtual_slot", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def _fold(slots: DataFrame, shards: int, version: int, kept: str) -> DataFrame:
    """Give slots to shards, largest first, each to the shard with the fewest bytes so far.

    ``kept`` is an SQL expression over a slot ``s`` and the loads ``a.loads``: the shard the slot
    must stay in, or null. One row of ``n_slots`` elements is folded, so the work has a fixed bound.
    """
    listed = slots.agg(F.expr("""
        sort_array(collect_list(named_struct('bytes', -bytes, 'slot', virtual_slot, 'old', old)))""").alias("slots"))
    placed = listed.withColumn("shards", F.expr(f"""
        aggregate(slots,
          named_struct('loads', array_repeat(0L, {shards}), 'out', CAST(array() AS ARRAY<INT>)),
          (a, s) -> transform(array(coalesce({kept}, CAST(array_position(a.loads, array_min(a.loads)) AS INT) - 1)),
            k -> named_struct('loads', transform(a.loads, (x, i) -> if(i = k, x - s.bytes, x)), 'out', concat(a.out, array(k))))[0],
          a -> a.out)"""))
    out = placed.select(F.expr(f"""
        inline(transform(slots, (s, i) -> named_struct('version', {version}, 'virtual_slot', s.slot, 'shard', shards[i], 'bytes', -s.bytes)))"""))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in MAP_SCHEMA])


def first_map(slots: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map, from the measured bytes of all slots."""
    return _fold(slots.withColumn("old", F.lit(None).cast("int")), shards, 1, "CAST(NULL AS INT)")


def rebalance(old: DataFrame, slots: DataFrame, shards: int, tolerance: float = 0.0) -> DataFrame:
    """Next version of a map for new bytes per slot or another number of shards.

    Slots stay where they are while their shard has room up to the mean plus ``tolerance``; the
    others go to the shards with the fewest bytes. Rows are (version, virtual_slot, shard, bytes).
    """
    version = old.agg(F.max("version")).first()[0]
    held = slots.join(old.select("virtual_slot", F.col("shard").alias("old")), "virtual_slot")
    total = held.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    room = int(total / shards * (1 + tolerance))
    kept = f"if(s.old < {shards} AND a.loads[s.old] - s.bytes <= {room}, s.old, CAST(NULL AS INT))"
    return _fold(held, shards, version + 1, kept)


def write_map(slot_map: DataFrame, path: str) -> DataFrame:
    """Append a version to the stored map and read that version back."""
    slot_map = stored(slot_map, "next-slot-map")
    version = slot_map.agg(F.max("version")).first()[0]
    slot_map.coalesce(1).write.mode("append").parquet(path)
    return read_map(slot_map.sparkSession, path, version)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """A version of the stored map, by default the latest; None where there is no map."""
    try:
        every = spark.read.schema(MAP_SCHEMA).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version)


def edited_map(slots: DataFrame, shards: int, path: str, tolerance: float = TOLERANCE) -> DataFrame:
    """The next version of the map at ``path`` for these bytes per slot, stored; its first one where there is none."""
    old = read_map(slots.sparkSession, path)
    return write_map(first_map(slots, shards) if old is None else rebalance(old, slots, shards, tolerance), path)


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records (stored, with part) with ``shard`` and ``slot``, their gapless place from 0 inside the shard.

    Places count on from the records of the shard's earlier virtual slots and parts, so the only window
    over records is inside one part of a virtual slot; the window over the map has ``n_slots`` x ``PARTS`` rows at most.
    """
    cell = ["virtual_slot", "part"]
    counted = records.groupBy(*cell).agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy(*cell).rowsBetween(W.unboundedPreceding, -1))
    bases = (slot_map.select("virtual_slot", "shard").join(counted, "virtual_slot")
             .select(*cell, "shard", F.coalesce(before, F.lit(0)).alias("base")))
    inside = F.row_number().over(W.partitionBy(*cell).orderBy("row"))
    return (records.withColumn("inside", inside).join(F.broadcast(bases), cell)
            .withColumn("slot", F.col("base") + F.col("inside") - 1).drop("base", "inside"))


def sized_records(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, row and part of every document, without its text.

    ``row`` is a number of its own once the records are stored; rows of one id, however many, are dealt
    out to ``PARTS`` parts by the task that read them.
    """
    text, row = F.col("text"), F.monotonically_increasing_id()
    return docs.select("doc_id", record_size(text).alias("size"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
                       virtual_slot(F.col("doc_id"), text, n_slots).alias("virtual_slot"), row.alias("row"),
                       (F.spark_partition_id() % PARTS).alias("part"))


def shard_documents(docs: DataFrame, shards: int, path: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Put documents into shards of nearly equal bytes, by the next version of the map at ``path``."""
    records = stored(sized_records(docs, n_slots), "sized-records")
    slot_map = edited_map(slot_bytes(records, n_slots), shards, path)
    return place(records, slot_map).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                           F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def plan_by_chars(docs: DataFrame, shards: int, path: str, n_slots: int = N_SLOTS) -> DataFrame:
    """A first map from the documents' characters, as an estimate of their bytes; sharding then edits it."""
    text = F.col("text")
    chars = docs.select(virtual_slot(F.col("doc_id"), text, n_slots).alias("virtual_slot"),
                        (F.coalesce(F.char_length(text), F.lit(0)) + RECORD_OVERHEAD).cast("bigint").alias("size"))
    return edited_map(slot_bytes(chars, n_slots), shards, path)
