"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

Every source has a weight and may be repeated ``most`` times at most; a source whose share of all words would exceed
that is held there, and what is left over is shared out again by weight (``targets``). The mix consists of blocks of
``block`` words. They go to the sources by highest quotients target / (2k + 1), then a source's blocks to its shards
by highest quotients of the shard's size. The words of a shard, laid end to end in an order that a seed fixes, are
cut into equal blocks; a quota takes all of them as often as it can, and of the rest the blocks whose place in a
seeded permutation is low enough. What a document gives is the part of its words that lies in taken blocks.

Nothing is enumerated but the quotients around the divisor: with S cells and n seats, the divisor lies between
W / (n + S/2) and W / (n - S/2), so a cell's certain seats follow by division and some 2 S quotients are ranked.
A shard holds some ``SHARD_WORDS`` words, more only where there would be over ``MOST_SHARDS`` of them, so that a source
with a third of all rows is many shards. The blocks that a document meets are its own array; no row is made of them.

A null text has no words. A null source is a source, the last in order. Documents without words get nothing, null and
repeated ids are rows of their own, an empty table gives no rows. Columns other than those three are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seriesflow.llm.common import materialize

WEIGHTS, MOST, BLOCK = (5, 2, 1), 3, 32
SHARD_WORDS, MOST_SHARDS = 1 << 17, 1 << 16
SEED = "mix-1"

#: What a word is; primes above any number of blocks, the steps of the permutations.
WORD = r"[^\x20\x09-\x0D]+"
STEPS = (2147483647, 2147483629, 2147483587)


def seeded(*parts: Column) -> Column:
    """A number of 60 bits that the seed and the parts fix."""
    text = F.concat_ws("|", F.lit(SEED), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size)`` with ``rank`` and ``target``; one row for each source.

    Sources are filled up in the order of limit / weight: the first that stays below its limit sets the level.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    whole = Window.partitionBy()
    scale = prod(weights)
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1))
    ranked = ranked.withColumns(
        {"limit": most * F.col("source_size"), "total": F.sum("source_size").over(whole), "weights": F.sum("weight").over(whole)}
    )
    filling = Window.orderBy(F.expr(f"limit * ({scale} div weight)"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns({"filled": F.coalesce(F.sum("limit").over(filling), F.lit(0)), "spent": F.coalesce(F.sum("weight").over(filling), F.lit(0))})
    held = F.expr("limit * (weights - spent) <= weight * (total - filled)")
    ranked = ranked.withColumn("held", held).withColumns(
        {
            "rest": F.col("total") - F.sum(F.expr("if(held, limit, 0)")).over(whole),
            "sharing": F.sum(F.expr("if(held, 0, weight)")).over(whole),
        }
    )
    level = F.expr("if(held, cast(limit AS double), cast(weight * rest AS double) / nullif(sharing, 0))")
    return ranked.select("source", "source_size", "rank", "total", level.alias("target"))


def apportioned(cells: DataFrame, group: Sequence[str], cell: Sequence[str], weight: str, seats: str) -> DataFrame:
    """``(*cell, quota)``: the ``seats`` of each group, dealt to its cells by highest quotients weight / (2k + 1).

    Equal quotients go by ``cell`` in order. Cells without weight get none.
    """
    own = Window.partitionBy(*group)
    cells = cells.where(F.col(weight) > 0).select(
        *cell,
        F.col(weight).cast("double").alias("_w"),
        F.col(seats).cast("bigint").alias("_n"),
        F.sum(F.col(weight).cast("double")).over(own).alias("_all"),
        F.count("*").over(own).alias("_cells"),
        *(F.col(c).alias(f"_group_{c}") for c in group),
    )
    # One seat less and one more than the bounds say keep rounding errors out.
    cells = cells.withColumns(
        {
            "_base": F.expr("if(2 * _n > _cells, greatest(0, cast(floor(_w * (_n - _cells / 2D) / _all + 0.5D) AS bigint) - 1), 0)"),
            "_top": F.expr("cast(floor(_w * (_n + _cells / 2D) / _all + 0.5D) AS bigint) + 1"),
        }
    )
    own = Window.partitionBy(*(f"_group_{c}" for c in group))
    cells = cells.withColumn("_open", F.col("_n") - F.sum("_base").over(own))
    claims = cells.withColumn("_k", F.explode(F.expr("sequence(_base, _top)")))
    best = own.orderBy(F.desc(F.expr("_w / (2 * _k + 1)")), *cell, "_k")
    won = F.row_number().over(best) <= F.col("_open")
    return (
        claims.withColumn("_won", won.cast("bigint"))
        .groupBy(*cell)
        .agg((F.first("_base") + F.sum("_won")).alias("quota"))
    )


def mix(
    spark: SparkSession,
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)`` of each row of ``docs``."""
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )
    # The texts are read once; from here on a document is three short columns.
    sized = materialize(spark, sized, "sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    sources = sources.withColumns(
        {
            "all_seats": F.expr(f"if(total > 0, greatest(1, cast(floor(total / {block} + 0.5D) AS bigint)), 0)"),
            "shards": F.expr(
                f"greatest(1, cast(ceil(source_size / greatest({SHARD_WORDS}, cast(ceil(total / {MOST_SHARDS}) AS bigint))) AS bigint))"
            ),
            "everything": F.lit(0),
        }
    )
    sources = materialize(spark, sources, "sources")
    seats = apportioned(sources, ["everything"], ["rank"], "target", "all_seats").withColumnRenamed("quota", "seats")
    order = seeded(F.col("doc_id"))
    dealt = sized.alias("d").join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.doc_id", "d.source", "size", "source_size", "target", "rank", order.alias("place"), (order % F.col("shards")).alias("shard")
    )
    cells = dealt.groupBy("rank", "shard").agg(F.sum("size").alias("shard_size")).join(seats, "rank", "left")
    quotas = apportioned(cells, ["rank"], ["rank", "shard"], "shard_size", "seats")
    shards = cells.join(quotas, ["rank", "shard"], "left").withColumn("blocks", F.expr(f"greatest(1, cast(floor(shard_size / {block} + 0.5D) AS bigint))"))
    lot = seeded(F.col("rank"), F.col("shard"))
    shards = shards.select(
        "rank",
        "shard",
        "shard_size",
        "blocks",
        F.expr(f"least(coalesce(quota, 0), {most} * blocks)").alias("quota"),
        (lot % F.col("blocks")).alias("shift"),
        F.element_at(F.array(*map(F.lit, STEPS)), (lot % len(STEPS)).cast("int") + 1).cast("bigint").alias("step"),
    ).withColumns({"passes": F.expr("quota div blocks"), "left_over": F.expr("quota % blocks")})
    shards = materialize(spark, shards, "shards").select("rank", "shard", "shard_size", "blocks", "passes", "left_over", "shift", "step")
    laid = Window.partitionBy("rank", "shard").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("stop", F.sum("size").over(laid)).join(shards, ["rank", "shard"], "left")
    placed = placed.withColumn("start", F.col("stop") - F.col("size"))
    taken = F.expr(
        """coalesce(passes * size, 0L) + if(size > 0 AND left_over > 0, aggregate(
            sequence(((start + 1) * blocks - 1) div shard_size, (stop * blocks - 1) div shard_size), 0L,
            (sum, j) -> sum + if((step * j + shift) % blocks < left_over,
                least(stop, (j + 1) * shard_size div blocks) - greatest(start, j * shard_size div blocks), 0L)), 0L)"""
    )
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
