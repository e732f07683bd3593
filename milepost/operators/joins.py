"""Dimension joins.

No join carries a broadcast hint. Spark compares the size of a dimension with
``spark.sql.autoBroadcastJoinThreshold``, at planning time and again at run time with
the real size, and falls back to a shuffled join beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.functions.text import match_key
from milepost.schemas import Fleet


def unique_names(dimension: DataFrame, key: str, name: str) -> DataFrame:
    """One row per key with its greatest name, so that a join cannot multiply rows."""
    return dimension.groupBy(key).agg(F.max(name).alias(name))


def with_vehicle(df: DataFrame, fleet: Fleet, *columns: str, how: str = "inner") -> DataFrame:
    """Add columns of the vehicle, its group among them."""
    return df.join(fleet.vehicles.select("vehicle_id", "group_id", *columns), "vehicle_id", how)


def with_group(df: DataFrame, fleet: Fleet, how: str = "inner") -> DataFrame:
    return df.join(fleet.groups.select("group_id", "group_name"), "group_id", how)


def with_driver(df: DataFrame, fleet: Fleet, *columns: str, how: str = "inner") -> DataFrame:
    return df.join(fleet.drivers.select("driver_id", *(columns or ("driver_name",))), "driver_id", how)


def with_top_driver_name(df: DataFrame, fleet: Fleet, driver: str = "top_driver_id") -> DataFrame:
    """Add ``top_driver_name`` for an id column."""
    names = unique_names(fleet.drivers, "driver_id", "driver_name").select(
        F.col("driver_id").alias(driver), F.col("driver_name").alias("top_driver_name")
    )
    return df.join(names, driver, "left")


SEED = 8


def _pieces(text: Column, length: Column) -> Column:
    """All pieces of a text with the given length."""
    starts = F.sequence(F.lit(1), F.length(text) - length + 1)
    return F.when(
        F.length(text) >= length,
        F.transform(starts, lambda start: F.substring(text, start, length)),
    ).otherwise(F.array().cast("array<string>"))


def containment_candidates(texts: DataFrame, fragments: DataFrame) -> DataFrame:
    """Pairs ``_text, _fragment`` that share the rarest piece of the fragment.

    ``texts(_text)`` and ``fragments(_fragment)`` are distinct and not empty. A text holding a
    fragment holds each of its pieces of ``SEED`` characters (or all of a shorter one). The
    piece that the fewest texts have becomes the seed of a fragment, so a beginning or word
    that many fragments or texts share costs nothing; a fragment with a piece that no text
    has is left out at once. The join is an equality on the seed.
    """
    lengths = fragments.agg(F.collect_set(F.least(F.length("_fragment"), F.lit(SEED)))).scalar()  # at most SEED numbers
    pieces = _pieces(F.col("_text"), F.col("_length"))
    of_texts = texts.withColumn("_length", F.explode(lengths)).select(
        "_text", F.explode(F.array_distinct(pieces)).alias("_seed")
    )
    in_texts = of_texts.groupBy("_seed").agg(F.count(F.lit(1)).alias("_n"))
    size = F.least(F.length("_fragment"), F.lit(SEED))
    of_fragments = fragments.select("_fragment", F.explode(F.array_distinct(_pieces(F.col("_fragment"), size))).alias("_seed"))
    seeds = (
        of_fragments.join(in_texts, "_seed", "left")
        .groupBy("_fragment")
        .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_seed").alias("seed"))).alias("_rarest"))
        .where(F.col("_rarest.n") > 0)
        .select("_fragment", F.col("_rarest.seed").alias("_seed"))
    )
    return of_texts.join(seeds, "_seed").select("_text", "_fragment")


def join_contains(
    texts: DataFrame, text: str, fragments: DataFrame, fragment: str
) -> DataFrame:
    """Pairs where the text contains the fragment; empty fragments match nothing.

    Each distinct text and each distinct fragment is matched once, however often it occurs:
    candidates by a common seed, then the exact test.
    """
    distinct_texts = texts.select(F.col(text).alias("_text")).filter(F.col("_text") != "").distinct()
    distinct_fragments = fragments.select(F.col(fragment).alias("_fragment")).filter(F.col("_fragment") != "").distinct()
    pairs = containment_candidates(distinct_texts, distinct_fragments).filter(
        F.col("_text").contains(F.col("_fragment"))
    )
    return (
        pairs.join(texts, F.col("_text") == F.col(text))
        .join(fragments, F.col("_fragment") == F.col(fragment))
        .drop("_text", "_fragment")
    )


def scheme_parameters(fleet: Fleet) -> DataFrame:
    """Schemes with every parameter whose label occurs in the scheme text."""
    schemes = fleet.schemes.select(
        "scheme_id",
        match_key(
            F.coalesce("scheme_description", "description", "scheme_type", F.lit(""))
        ).alias("scheme_key"),
    )
    parameters = fleet.parameters.select(
        F.col("parametro").alias("ofensor"),
        "categoria",
        "acao_recomendada_final",
        match_key(F.col("parametro")).alias("parameter_key"),
    )
    return join_contains(schemes, "scheme_key", parameters, "parameter_key").select(
        "scheme_id", "ofensor", "categoria", "acao_recomendada_final"
    )
