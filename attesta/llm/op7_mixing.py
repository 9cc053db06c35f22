"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations only.

Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and share 1.5 times all words; a target stops at
twice its source's words and the rest is shared again by weight until none is above. That is one water level: with
sources in order of capacity per weight, the level follows from running sums over the table of sources.

Positions: a source's rate at time t of [0, 1] is target * (1 + tilt * (2 t - 1)). Its integral is the words it has
demanded by t; documents stand in a fixed random order, and a document whose words begin at c gets the t at which
demand reaches c. Documents are range-sorted by that position. The last document taken in a pass is cut to the words
still due, so a source's words come to the whole part of its target.

Words before a document within its source are prefix sums in two levels: about sqrt(n) slices of about sqrt(n)
documents, so no source, however large, is ever sorted in one task.

Defined cases: null or empty texts have size 0 and are never taken; a source of size 0 has target 0; null sources are
one source; rows that share a doc_id are separate documents ordered by size and text hash; an empty table gives an
empty result; further columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.common import WORD_SQL

#: The direction of change of each source's rate, repeating: early, even, late.
TILTS = (-0.6, 0.0, 0.6)


def _cycle(values: Sequence[float], n: Column) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), (n % len(values)).cast("int"))


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, tilts: Sequence[float] = TILTS) -> DataFrame:
    """sizes (source, source_size, source_docs), a row for each source -> with target and tilt. Windows here run over
    the table of sources, not over documents."""
    by_name = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    s = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", _cycle(weights, F.col("place"))).withColumn("tilt", _cycle(tilts, F.col("place")))
    s = s.withColumn("room", F.col("source_size") * most)
    level = Window.orderBy(F.col("room") / F.col("weight"), "place")
    everything = Window.partitionBy()
    full, later = level.rowsBetween(Window.unboundedPreceding, -1), level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.withColumn("before", F.coalesce(F.sum("room").over(full), F.lit(0.0))).withColumn("open", F.sum("weight").over(later))
    s = s.withColumn("demand", F.sum("source_size").over(everything) * share)
    # the level if all sources before this one are full; the first that stays below its room gives the true one, the largest of those
    s = s.withColumn("level", (F.col("demand") - F.col("before")) / F.col("open"))
    s = s.withColumn("true_level", F.max(F.when(F.col("level") * F.col("weight") <= F.col("room"), F.col("level"))).over(everything))
    target = F.least("room", F.coalesce(F.col("true_level") * F.col("weight"), F.col("room")))
    return s.select("source", "source_size", "source_docs", "tilt", target.alias("target"))


def when_due(words: Column, target: Column, tilt: Column) -> Column:
    """The time at which a source's demand target * (t + tilt * (t^2 - t)) reaches words."""
    u = F.when(target > 0, F.least(words / target, F.lit(1.0))).otherwise(F.lit(0.0))
    slope = 1 - tilt
    return F.when(tilt == 0, u).otherwise((F.sqrt(slope * slope + 4 * tilt * u) - slope) / (2 * tilt))


def mix(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """docs (doc_id, source, text) -> doc_id, source, size, source_size, target, taken, first_take and second_take (words
    of each pass), position and second_position (times, null where not taken). Options: those of `targets`."""
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_SQL)), F.lit(0)).cast("long")
    rows = docs.select("doc_id", "source", words.alias("size"), F.xxhash64("doc_id", text).alias("tie"))
    rows = rows.withColumn("draw", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 40)))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    goal = targets(sums, **options)
    goal = goal.withColumn("slices", F.ceil(F.sqrt("source_docs"))).withColumnRenamed("source", "_source")
    # AQE broadcasts the table of sources if it is small and splits a large source's partition if it is not
    rows = rows.join(goal, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("slice", F.floor(F.col("draw") * F.col("slices") / float(1 << 40)).cast("long"))
    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(F.col("source").alias("_source"), F.col("slice").alias("_slice"), F.coalesce(F.sum("slice_size").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "slice").orderBy("draw", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(slices, F.col("source").eqNullSafe(F.col("_source")) & (F.col("slice") == F.col("_slice")))
    due, start = F.floor("target"), F.col("base") + F.col("within")
    part = lambda first: F.greatest(F.lit(0), F.least(F.col("size"), due - first)).cast("long")
    rows = rows.withColumn("first_take", part(start)).withColumn("second_take", part(start + F.col("source_size")))
    at = lambda take, first: F.when(F.col(take) > 0, when_due(first.cast("double"), F.col("target"), F.col("tilt")))
    return rows.select(
        "doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("first_take") + F.col("second_take")).alias("taken"),
        "first_take", "second_take", at("first_take", start).alias("position"), at("second_take", start + F.col("source_size")).alias("second_position"), "draw", "tie",
    )


def in_order(mixed: DataFrame, position: str = "position") -> DataFrame:
    """Range-sorted by training position; documents that are not taken follow in their random order, spread as well."""
    return mixed.orderBy(F.coalesce(F.col(position), 1 + F.col("draw") / float(1 << 40)), "doc_id", "tie")


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"))
    return in_order(mixed).drop("draw", "tie", "source")


