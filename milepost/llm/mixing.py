"""Mixing sources to target shares by weighted fair queueing.

Documents of a source are shuffled by a keyed hash and queue up. The virtual finish time of
a document is the number of its source's words up to its end, divided by the source's
target; each further pass over a source goes on counting. All documents, ordered by finish
time, are taken until the budget is used up. Running totals are made per range of at most
about ``RANGE_ROWS`` rows, so a source with most of the rows is no single window.

Defined results: a null text has no words; a document without words is never taken. A null
source is a source of its own, last in order. Rows that repeat are documents of their own.
Documents that end at the same time are taken together or not at all. If no document has a
word, all targets are 0. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from milepost.operators.windows import write_once

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
PASSES = 3
RANGE_ROWS = 2_000
SEED = 20_240_229


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """Target of each source of ``sizes(source, source_size, ...)``, one row per source.

    Weights repeat over the sources by code point, null last. The sum of all sizes is
    shared by weight; a target stops at ``passes`` times its source's size, and what is
    left is shared again among the others. Sources by size per weight fill up in that
    order, so the last one to fill, and the level of the rest, follow from running sums.
    """
    by_name = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    full = sizes.withColumn("weight", weight.cast("double")).withColumn("most", (passes * F.col("source_size")).cast("double"))
    by_fill = W.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_fill.rowsBetween(W.unboundedPreceding, -1)
    here_on = by_fill.rowsBetween(0, W.unboundedFollowing)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    level = full.withColumn("level", left / F.sum("weight").over(here_on))
    # the first source that does not fill sets the level of all after it
    stays = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    level = level.withColumn("level", F.first(stays, ignorenulls=True).over(by_fill.rowsBetween(W.unboundedPreceding, 0)))
    target = F.coalesce(F.least("most", F.col("level") * F.col("weight")), F.col("most"))
    return level.select("source", "source_size", target.alias("target"), "documents")


def _running(rows: DataFrame, key: list[str], order: list[str], value: str, output: str) -> DataFrame:
    """Running total of ``value`` within ``key`` over the ranges in column ``range``."""
    sums = rows.groupBy(*key, "range").agg(F.sum(value).alias("_sum"))
    before = W.partitionBy(*key).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    shifts = sums.select(*[F.col(k).alias(f"_{k}") for k in key], F.col("range").alias("_range"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    same = F.col("range") == F.col("_range")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = W.partitionBy(*key, "range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumn("_local", F.sum(value).over(inside))
    return local.join(shifts, same).withColumn(output, F.col("_before") + F.col("_local")).drop("_before", "_local", "_range", *[f"_{k}" for k in key])


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """How many words of each document the mix takes.

    Returns ``doc_id, source, size, source_size, target, taken`` and the columns of
    ``keep``. ``taken`` is ``size`` times the number of passes that take the document.
    """
    own = [c for c in keep if c not in ("doc_id", "source")]
    rows = write_once(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *own), "mixing-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    targets = source_targets(sizes, weights, passes).select(F.col("source").alias("_source"), "source_size", "target", "documents")
    place = F.xxhash64(F.col("doc_id"), F.col("size"), F.lit(seed))
    # a place is uniform over 2**64; its range within the source follows from its high bits
    parts = F.floor(F.col("documents") / RANGE_ROWS) + 1
    known = (
        rows.join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("place", place)
        .withColumn("range", F.floor((F.shiftright("place", 32) + F.lit(2**31)) * parts / F.lit(2**32)).cast("long"))
    )
    queued = _running(known, ["source"], ["place", "doc_id"], "size", "until").drop("range", "place", "documents")
    queued = write_once(queued, "mixing-queue")
    # virtual finish times of all passes, in ranges of equal width; 1 is where targets end
    finish = F.transform(F.sequence(F.lit(0), F.lit(passes - 1)), lambda p: (p * F.col("source_size") + F.col("until")) / F.col("target"))
    taking = queued.where((F.col("size") > 0) & (F.col("target") > 0))
    # two numbers for the whole table, and below the one finish time that ends the mix
    budget, documents = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    finishes = (
        taking.select("size", F.explode(finish).alias("finish"))
        .groupBy("finish")
        .agg(F.sum("size").alias("size"))
        .withColumn("range", F.floor(F.col("finish") * (documents // RANGE_ROWS + 1)).cast("long"))
    )
    last = _running(finishes, [], ["finish"], "size", "total").where(F.col("total") <= budget).agg(F.max("finish")).first()[0]
    times = F.size(F.filter(finish, lambda f: f <= F.lit(last))) if last is not None else F.lit(0)
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), F.col("size") * times).otherwise(0)
    return queued.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), *own)


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows without words are kept once: they cost no budget. Rows that repeat an id and text
    share what the mix takes of them.
    """
    mark = F.xxhash64("text", "source")
    taken = mix_sources(docs.select("doc_id", "source", "text", mark.alias("mark")), weights, passes, seed, keep=("mark",))
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1).cast("long")
    totals = taken.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.sum(times).alias("_times"), F.count(F.lit(1)).alias("_rows"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumn("_text_mark", mark)
    joined = rows.join(totals, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_mark") == F.col("_mark")))
    place = F.row_number().over(W.partitionBy("_id", "_mark").orderBy(F.lit(1)))
    own = F.floor(F.col("_times") / F.col("_rows")) + F.when(F.col("_place") <= F.col("_times") % F.col("_rows"), 1).otherwise(0)
    counted = joined.withColumn("_place", place).withColumn("_own", own).where(F.col("_own") > 0)
    return counted.withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_own")))).select(*columns)
