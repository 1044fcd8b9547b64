"""Mixing sources to target weights by a time-varying curriculum, in DataFrame operations alone.

Each source has a weight schedule over training time 0..1: ``weight * (1 + tilt * (2t - 1))``,
whose integral is the weight. A source's cumulative demand up to t is its target times
the integrated schedule, ``t + tilt * (t^2 - t)``. Its documents, in the order of a hash,
fill that demand epoch after epoch; a copy's training position is the time at which
the demand reaches its first word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mensario.llm.common import cut

WEIGHTS = (5, 2, 1)
TILTS = (-0.5, 0.0, 0.5)
SHARE, MOST = 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str = "text") -> F.Column:
    """Number of words, 0 for NULL: blanks are squeezed and counted, no array of words is built."""
    spaced = F.translate(F.col(text), "\t\n\x0b\x0c\r", "     ")
    marked = F.concat(F.lit(" "), spaced)
    squeezed = F.rtrim(F.regexp_replace(marked, " +", " "))
    return F.coalesce(F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "), F.lit(""))), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, tilts: tuple[float, ...] = TILTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target, tilt) from (source, source_size), one row per source.

    Sources by code point, NULL last, take the weights in turn. They share ``share`` times all sizes by
    weight; none gets over ``most`` times its own size, what is over goes to the others by weight. Sources
    that reach their limit first are those of least limit per weight, so running sums in that order find the
    level of the others. The table has one row per source, so its windows are small.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    everything = Window.partitionBy()
    by_limit = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(0, Window.unboundedFollowing)
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn("turn", turn)
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    return (
        ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("turn").cast("int") + 1))
        .withColumn("tilt", F.element_at(F.array(*map(F.lit, tilts)), F.pmod("turn", F.lit(len(tilts))).cast("int") + 1))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("level", level)
        .withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
        # the first that stays below its limit sets the level for all behind it
        .withColumn("level", F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, 0)))
        .select("source", "source_size", F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level"))).alias("target"), "tilt")
    )


def position(demand: F.Column, tilt: F.Column) -> F.Column:
    """The time at which the share ``demand`` of a source's target is reached: t + tilt (t^2 - t) inverted."""
    b = 1 - tilt
    return F.when(tilt == 0, demand).otherwise((F.sqrt(b * b + 4 * tilt * demand) - b) / (2 * tilt))


def plan(docs: DataFrame, **rules) -> DataFrame:
    """(doc_id, source, size, source_size, target, rows, copies, position): one row per document.

    Rows equal in doc_id, source and size are one unit of ``rows`` rows. ``copies`` is how often each of its
    rows is taken, 0 to 2: an epoch takes a unit if its middle word lies within the target, so a source's
    taken words miss its target by half a unit at most. ``position`` is that of the first copy. NULL texts and
    texts without words have size 0 and are never taken. No rows give no rows. Any NULL source is one source.
    """
    units = cut(docs.select("doc_id", "source", words().alias("size")).groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")))
    digits = 3 if units.count() < 16**3 * 10_000 else 4  # slices: 4096, or 65536 for many rows
    key = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("size").cast("string")).cast("binary"))
    placed = units.withColumn("key", key).withColumn("slice", F.substring("key", 1, digits)).withColumn("mass", F.col("size") * F.col("rows"))
    per_slice = cut(placed.groupBy("source", "slice").agg(F.sum("mass").alias("slice_mass")))
    so_far = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    goals = targets(per_slice.groupBy("source").agg(F.sum("slice_mass").alias("source_size")), **rules)
    offsets = per_slice.select("source", "slice", F.coalesce(F.sum("slice_mass").over(so_far), F.lit(0)).alias("before"))
    offsets = offsets.join(goals, offsets["source"].eqNullSafe(goals["source"])).drop(goals["source"])
    within = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn("inner", F.coalesce(F.sum("mass").over(within), F.lit(0)))
    joined = rows.join(offsets, rows["source"].eqNullSafe(offsets["source"]) & (rows["slice"] == offsets["slice"])).drop(offsets["source"]).drop(offsets["slice"])
    start = F.col("before") + F.col("inner")
    epochs = F.ceil((F.col("target") - start - F.col("mass") / 2) / F.nullif("source_size", F.lit(0)))
    copies = F.when(F.col("mass") == 0, 0).otherwise(F.least(F.lit(MOST), F.greatest(F.lit(0), epochs))).cast("long")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", "rows", copies.alias("copies"),
        F.when(copies > 0, F.greatest(F.lit(0.0), position(F.least(F.lit(1.0), start / F.nullif("target", F.lit(0.0))), F.col("tilt")))).alias("position"),
        start.alias("start"), "tilt",
    )


def mix(docs: DataFrame, **rules) -> DataFrame:
    """``docs`` as the mix takes them, each row as often as planned, range-sorted by training position."""
    chosen = plan(docs, **rules).where("copies > 0")
    each = chosen.select(
        F.col("doc_id").alias("plan_id"), F.col("source").alias("plan_source"), F.col("size").alias("plan_size"), "source_size", "target", "start", "tilt", "copies"
    )
    # the row in one column, so that no name of the table meets one of the plan
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("row_id"), F.col("source").alias("row_source"), words().alias("row_size"))
    matched = rows.join(each, F.col("row_id").eqNullSafe(F.col("plan_id")) & F.col("row_source").eqNullSafe(F.col("plan_source")) & (F.col("row_size") == F.col("plan_size")))
    epoch = F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1))
    due = F.least(F.lit(1.0), (F.col("start") + F.col("epoch") * F.col("source_size")) / F.nullif("target", F.lit(0.0)))
    timed = matched.withColumn("epoch", epoch).withColumn("due", position(due, F.col("tilt")))
    return timed.repartitionByRange("due", "row_id").sortWithinPartitions("due", "row_id").select("row.*")
