"""Mix sources to target weights by a low-discrepancy schedule. DataFrame operations only.

Each source's documents are shuffled by a hash and laid end to end, again and again up to ``most`` times; this stream of tokens
is cut into blocks of equal size. The schedule takes van der Corput points, maps each through the cumulative targets to a
source, and the n-th slot of a source takes its n-th block. Nothing else is taken: a block without a slot stays out, so what a
source gives is the number of its slots times the block, which the points keep within a block times the logarithm of the
number of slots of its target, and within ``most`` times what it holds.

Null text counts as no tokens, null source is a source of its own and sorts last; rows with equal ids and texts are taken as
separate rows. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripleframe.llm.common import WORD, running_sum
from tripleframe.session import cut

#: Hex digits of the shuffling hash by which a source is cut into buckets for the running sums.
BUCKET_DIGITS = 3
#: Slots of the schedule that are ranked together.
CHUNK = 1 << 16
#: Tokens of a block at most, and slots at least: small corpora get smaller blocks, so that the slots still tell their sources apart.
BLOCK, SLOTS = 1 << 10, 1 << 16
#: Cells of the unit line in which points and sources meet.
CELLS = 1 << 12
#: Binary digits of a van der Corput point.
DIGITS = 48


def word_count(text: Column) -> Column:
    """Number of words of a text, null as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest() -> Column:
    """What shuffles the rows: a hash of id and text."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))).cast("binary"))


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """Target of every source: (source, source_size) gets ``target``.

    Sources by code point, null last, have the weights in turn and share the sum of all sizes. A target stops at ``most``
    times its source's size and the rest is shared again by weight. With sources in order of ``most * size / weight`` the
    full ones come first, so the common level follows from running sums: it is the first that does not exceed the next
    source's own limit. One row per source is ordered in one window, never documents.
    """
    turn = F.array(*[F.lit(w) for w in weights])
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sources.withColumn("_w", F.element_at(turn, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    limit = most * F.col("source_size")
    fill = Window.orderBy(limit / F.col("_w"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    ahead = fill.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(ahead), F.lit(0))
    open_weight = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(ahead), F.lit(0))
    levelled = ranked.withColumn("_level", left / open_weight)
    holds = F.when(F.col("_level") <= limit / F.col("_w"), F.col("_level"))
    level = F.first(holds, ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levelled.withColumn("target", F.least(limit.cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("_w"))).drop("_w", "_level")


def _positions(docs: DataFrame) -> DataFrame:
    """Adds ``start``: tokens of the same source before the document in its shuffled order."""
    spread = docs.withColumn("_bucket", F.substring("digest", 1, BUCKET_DIGITS))
    return running_sum(spread, ["source"], "_bucket", ["digest"], F.col("size"), "start").drop("_bucket")


def _blocks(docs: DataFrame, block: int, most: int) -> DataFrame:
    """A row for every document and block that share tokens: ``rank`` of the block in its source, ``tokens`` shared.

    ``_slots`` blocks of a source have a slot; what lies behind them is not cut.
    """
    size = F.col("source_size")
    rounds = docs.withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    begin = F.col("_round") * size + F.col("start")
    inside = rounds.withColumn("_a", begin).withColumn("_b", F.least(begin + F.col("size"), F.col("_slots") * block)).where("_b > _a")
    floor = F.floor(F.col("_a") / block)
    ranked = inside.withColumn("rank", F.explode(F.sequence(floor, F.floor((F.col("_b") - 1) / block))))
    shared = F.least(F.col("_b"), (F.col("rank") + 1) * block) - F.greatest(F.col("_a"), F.col("rank") * block)
    return ranked.withColumn("tokens", shared).withColumn("offset", F.greatest(F.col("_a") - F.col("rank") * block, F.lit(0))).drop("_a", "_b", "_slots")


def whole_target(sources: DataFrame) -> int:
    """Tokens of the mix: the sum of the targets, each as a whole number."""
    return sources.agg(F.coalesce(F.sum(F.round("target").cast("long")), F.lit(0))).first()[0]


def schedule(sources: DataFrame, block: int, total: int | None = None) -> DataFrame:
    """The slots: ``slot``, its source, and ``rank`` among the slots of that source.

    Points meet the cumulative targets as whole numbers of tokens, so a point on a border has one source everywhere.
    """
    total = whole_target(sources) if total is None else total
    slots = sources.sparkSession.range(-(-total // block)).withColumnRenamed("id", "slot")
    digits = F.reverse(F.lpad(F.bin("slot"), DIGITS, "0"))
    point = F.conv(digits, 2, 10).cast("double") / float(1 << DIGITS)
    by_name = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, 0)
    goals = sources.select("source", F.round("target").cast("long").alias("_goal")).where("_goal > 0").withColumn("_to", F.sum("_goal").over(by_name))
    ends = goals.withColumn("_from", F.col("_to") - F.col("_goal"))
    # Points meet the intervals of the sources in equal cells of the unit line, a cell more at either end for rounding.
    cell = lambda c: F.floor(F.col(c) * float(CELLS) / float(max(total, 1)))
    cells = F.sequence(F.greatest(cell("_from") - 1, F.lit(0)), F.least(cell("_to") + 1, F.lit(CELLS - 1)))
    celled = ends.withColumn("_cell", F.explode(cells))
    placed = slots.withColumn("_u", point).withColumn("_cell", F.floor(F.col("_u") * CELLS)).withColumn("_x", F.col("_u") * float(total))
    named = placed.join(celled, "_cell").where("_x >= _from AND _x < _to").select("slot", "source", F.floor(F.col("slot") / CHUNK).alias("_chunk"))
    return running_sum(named, ["source"], "_chunk", ["slot"], F.lit(1), "rank").drop("_chunk")


def mix(docs: DataFrame, block: int | None = None, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> tuple[DataFrame, DataFrame]:
    """(documents with their places, the mix in order).

    The documents have ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``digest`` and ``start``, one row per given row.
    The mix has a row for every piece of a document in a scheduled block: ``slot``, ``source``, ``rank``, ``offset`` in the
    block, ``doc_id``, ``start``, ``tokens``. Without ``block`` blocks have ``BLOCK`` tokens, or as many as give ``SLOTS`` slots.
    """
    sized = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), digest().alias("digest")))
    sources = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    total = whole_target(sources)
    block = block or max(1, min(BLOCK, -(-total // SLOTS)))
    slots = cut(schedule(sources, block, total)).select("slot", F.col("source").alias("_s"), F.col("rank").alias("_r"))
    # One row per source; written, so that the next join knows its size and need not deal documents by source.
    counts = slots.groupBy("_s").agg(F.count(F.lit(1)).alias("_slots"))
    told = cut(sources.join(counts, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        F.col("source").alias("_s"), "source_size", "target", F.coalesce("_slots", F.lit(0)).alias("_slots")
    ))
    placed = cut(_positions(sized).join(told, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    taken = _blocks(placed, block, most)
    mixed = taken.join(slots, F.col("source").eqNullSafe(F.col("_s")) & (F.col("rank") == F.col("_r"))).drop("_s", "_r")
    return placed.drop("_slots"), mixed


def taken_per_document(placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """Tokens the mix takes from each document: a row of ``placed`` with ``taken``, its ``first_slot`` (null: none) and ``n_pieces``."""
    keys = ["doc_id", "source", "size", "source_size", "target", "digest", "start"]
    none = [F.lit(0).cast("long").alias("tokens"), F.lit(None).cast("long").alias("slot")]
    # Documents with tokens differ in (source, start); documents without any are never part of a block.
    told = mixed.select(*keys, "tokens", "slot").unionByName(placed.where("size > 0").select(*keys, *none))
    counted = told.groupBy(*keys).agg(F.sum("tokens").alias("taken"), F.min("slot").alias("first_slot"), F.count("slot").alias("n_pieces"))
    empty = placed.where("size = 0").select(*keys, none[0].alias("taken"), none[1].alias("first_slot"), F.lit(0).cast("long").alias("n_pieces"))
    return counted.unionByName(empty).drop("start")
