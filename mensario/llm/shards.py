"""Balanced shards from global prefix sums of sizes in bytes.

Documents are ordered by a hash of the text, so equal texts stand together. Totals per
slice of that order give each slice its offset; a window inside the slice gives the
offset of each group of equal texts. Equal targets cut the order into shards. A group no
larger than ``GROUP_SHARE`` of a target goes whole to the shard in which it starts; a larger
one is cut at the targets, like any other stretch of the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mensario.llm.common import cut, slices

SHARDS, GROUP_SHARE = 8, 0.01
#: A group of equal texts is dealt into cells of about so many rows.
CELL_ROWS = 256


def _offsets(cells: DataFrame, order: list[str]) -> DataFrame:
    """``cells`` (slice, bytes, n and ``order``) with the sums of bytes and n before each in the order of slice, order."""
    before_slice = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    totals = cells.groupBy("slice").agg(F.sum("bytes").alias("sb"), F.sum("n").alias("sn"))
    slices_before = totals.select("slice", F.coalesce(F.sum("sb").over(before_slice), none).alias("b0"), F.coalesce(F.sum("sn").over(before_slice), none).alias("n0"))
    inner = cells.withColumn("b1", F.coalesce(F.sum("bytes").over(inside), none)).withColumn("n1", F.coalesce(F.sum("n").over(inside), none))
    return inner.join(F.broadcast(slices_before), "slice").withColumn("at_bytes", F.col("b0") + F.col("b1")).withColumn("at_rows", F.col("n0") + F.col("n1")).drop("b0", "b1", "n0", "n1")


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    Size is the text's UTF-8 bytes plus one, NULL counts as no bytes (its crc32 is that of the empty text, and
    it is grouped with it). Slots number a shard's rows from 0 without gaps. Repeated rows get slots of their
    own. No rows give no rows. The totals per slice (at most 16384 rows) are broadcast.
    """
    text = F.coalesce("text", F.lit(""))
    rows = cut(docs.select("doc_id", F.octet_length(text).cast("long").alias("bytes"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text, F.lit(10)).alias("h"))
               .select("doc_id", (F.col("bytes") + 1).alias("size"), "text_crc32", "h"))
    everything = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    n_slices = slices(everything["n"], 20_000, 256, 16_384)
    target = max(1, everything["bytes"]) / shards
    key = ["h", "size", "text_crc32"]
    # cells: parts of a group of equal texts by a hash of doc_id, one cell for most groups
    group = rows.groupBy(*key).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    group = group.withColumn("cells", F.ceil(F.col("n") / CELL_ROWS)).withColumn("slice", F.pmod("h", F.lit(n_slices)))
    groups = cut(_offsets(group, key).select(*key, "cells", "slice", "bytes", "at_bytes", "at_rows"))
    placed = cut(rows.join(groups.drop("slice"), key).withColumn("cell", F.pmod(F.xxhash64("doc_id"), F.col("cells"))))
    shard_of = lambda offset: F.least(F.lit(shards - 1), F.floor(offset / F.lit(target))).cast("int")
    # the rows of a group are of one size, so a row's offset follows from its rank in the group
    cells = placed.groupBy(*key, "cell").agg(F.count("*").alias("in_cell"))
    before_cell = Window.partitionBy(*key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("cell_start", F.coalesce(F.sum("in_cell").over(before_cell), F.lit(0)))
    in_cell = Window.partitionBy(*key, "cell").orderBy("doc_id")
    ranked = placed.withColumn("in_cell", F.row_number().over(in_cell) - 1).join(cells.drop("in_cell"), [*key, "cell"])
    rank = F.col("cell_start") + F.col("in_cell")
    whole = F.col("bytes") <= F.lit(GROUP_SHARE * target)
    seat = cut(ranked.select("doc_id", "size", "text_crc32", F.when(whole, shard_of(F.col("at_bytes"))).otherwise(shard_of(F.col("at_bytes") + rank * F.col("size"))).alias("shard"), (F.col("at_rows") + rank).alias("seat")))
    first = seat.groupBy("shard").agg(F.min("seat").alias("first"))
    return seat.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("seat") - F.col("first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
