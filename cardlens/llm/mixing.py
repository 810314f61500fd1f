"""Mixing sources to target weights by Sainte-Laguë apportionment.

Words are dealt in blocks of equal size.  Each source gets whole blocks by highest
quotients of its target, and its shards get theirs from the source's blocks by
highest quotients of their sizes.  Inside a shard the documents stand in a seeded
order, passed at most twice, and the shard's quota is what is read from the front.
A source has as many shards as its size needs, so no task holds a whole source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.common import WORD_PATTERN
from cardlens.workspace import snapshot

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 8
SHARD_WORDS = 100_000
MAX_SHARDS = 4096


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def ranked(sources: DataFrame, column: str = "source") -> DataFrame:
    """Adds ``place``, the row's place by code point, nulls last; sorted in parallel and numbered by partition."""
    ordered = snapshot(
        sources.repartitionByRange(F.col(column).asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    )
    before, offsets = 0, []
    for row in ordered.groupBy("_part").count().orderBy("_part").collect():
        offsets.append(F.struct(F.lit(row["_part"]).alias("k"), F.lit(before).alias("v")))
        before += row["count"]
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(column).asc_nulls_last()))
    if not offsets:
        return ordered.withColumn("place", F.lit(0).cast("long")).drop("_part")
    start = F.map_from_entries(F.array(*offsets))[F.col("_part")]
    return ordered.withColumn("place", (within - 1 + start).cast("long")).drop("_part")


def fill_level(sources: DataFrame, total: float, repeats: float = REPEATS) -> float:
    """The level L at which min(weight * L, repeats * size) adds up to ``total`` over all sources.

    Each round finds who is full at the present level and shares the rest among the
    others; one row of sums reaches the driver.
    """
    level = 0.0
    for _ in range(200):
        full = F.col("weight") * F.lit(level) >= repeats * F.col("source_size")
        row = sources.agg(
            F.sum(F.when(full, repeats * F.col("source_size")).otherwise(F.lit(0.0))).alias("taken"),
            F.sum(F.when(full, F.lit(0)).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            return level
        raised = (total - (row["taken"] or 0.0)) / row["open"]
        if raised <= level:
            return level
        level = raised
    return level


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS
) -> DataFrame:
    """Per source: ``source, source_size, place, weight, target``."""
    placed = ranked(sizes)
    named = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = snapshot(placed.withColumn("weight", named))
    words = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = fill_level(weighed, share * words, repeats)
    target = F.least(F.col("weight") * F.lit(float(level)), repeats * F.col("source_size").cast("double"))
    return weighed.withColumn("target", target.cast("double"))


def apportion(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """Adds ``blocks``: whole blocks per source by highest quotients target / 1, 3, 5, ...

    Rounding target / block gives all but a few seats (each source is within one half of its share); what is
    missing or too much is settled by comparing the sources' next, or last, quotients.
    """
    part = F.col("target") / F.lit(float(block))
    seats = sources.withColumn("blocks", F.floor(part + 0.5).cast("long"))
    # summed as decimals, so that the order of rows does not matter
    row = seats.agg(F.sum(part.cast("decimal(30,6)")).alias("want"), F.sum("blocks").alias("have")).first()
    missing = math.floor(float(row["want"] or 0) + 0.5) - (row["have"] or 0)
    if not missing:
        return seats
    seats = snapshot(seats)
    count = abs(missing)
    if missing > 0:
        choice = seats.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(1)))).withColumn("_j", F.col("_j") + F.col("blocks"))
    else:
        choice = seats.withColumn("_j", F.explode(F.sequence(F.lit(1), F.lit(2)))).withColumn("_j", F.col("blocks") - F.col("_j"))
        choice = choice.filter("_j >= 0")
    quotient = F.col("target") / (2 * F.col("_j") + 1)
    order = (F.desc("_q"), F.asc("place")) if missing > 0 else (F.asc("_q"), F.desc("place"))
    moved = choice.withColumn("_q", quotient).orderBy(*order).limit(count).groupBy("place").agg(F.count("*").alias("_moved"))
    change = F.coalesce(F.col("_moved"), F.lit(0)) * (1 if missing > 0 else -1)
    return seats.join(moved, "place", "left").withColumn("blocks", F.col("blocks") + change).drop("_moved")


def shard_quotas(shards: DataFrame) -> DataFrame:
    """Adds ``quota`` in words: the source's blocks dealt to its shards by the same rule.

    ``shards`` has ``source, shard, shard_size, source_size, blocks``; a source has at most MAX_SHARDS of them.
    """
    part = F.try_divide(F.col("blocks") * F.col("shard_size"), F.col("source_size"))
    by_source = Window.partitionBy("source")
    given = shards.withColumn("_part", F.coalesce(part, F.lit(0.0))).withColumn("_seats", F.floor(F.col("_part") + 0.5).cast("long"))
    given = given.withColumn("_missing", F.col("blocks") - F.sum("_seats").over(by_source))
    sign = F.signum("_missing")
    # the next quotient of a shard that may gain, the last of one that may lose
    next_q = F.col("_part") / (2 * F.col("_seats") + 1)
    last_q = F.when(F.col("_seats") > 0, F.col("_part") / (2 * F.col("_seats") - 1))
    rank = F.row_number().over(
        by_source.orderBy(F.when(sign >= 0, -next_q).otherwise(last_q).asc_nulls_last(), F.asc("shard"))
    )
    moved = F.when(rank <= F.abs("_missing"), sign).otherwise(F.lit(0)).cast("long")
    return given.withColumn("quota", (F.col("_seats") + moved) * F.lit(BLOCK_WORDS)).drop("_part", "_seats", "_missing")


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words of each document the mix takes: ``doc_id, source, size, source_size, target, taken``.

    Sources stand in code-point order, null last, and weigh ``weights``, repeating.  They share ``share`` of all
    words; a target stops at ``repeats`` times its source, the excess goes to the others by weight.  A null or
    empty text has size 0 and is never taken.  Equal inputs give equal results whatever the partitions; ties of
    the seeded order are broken by id and size, and rows equal in those are interchangeable.  An empty table gives an
    empty result; other columns are not looked at.
    """
    sized = snapshot(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"))
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    aimed = apportion(targets(per_source, weights, share, repeats))
    wanted = F.greatest(F.col("source_size") / SHARD_WORDS, F.col("_rows") / 1000)
    aimed = snapshot(aimed.withColumn("shards", F.least(F.lit(MAX_SHARDS), F.ceil(wanted)).cast("long")))

    known = aimed.select(F.col("source").alias("_source"), "source_size", "target", "blocks", "shards")
    spread = F.xxhash64(F.lit(seed), "doc_id", "size")
    placed = sized.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    placed = placed.withColumn("shard", F.pmod(spread, F.col("shards")))
    shards = placed.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("source_size").alias("source_size"), F.first("blocks").alias("blocks")
    )
    quotas = snapshot(shard_quotas(shards)).select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "shard_size", "quota"
    )
    joined = placed.join(quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    shuffled = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), "doc_id", "size")
    before = F.sum("size").over(shuffled.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    counted = joined.withColumn("_before", before)
    passes = [
        F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - p * F.col("shard_size") - F.col("_before")))
        for p in range(repeats)
    ]
    return counted.select(
        "doc_id", "source", "size", "source_size", "target", sum(passes[1:], passes[0]).cast("long").alias("taken")
    )
