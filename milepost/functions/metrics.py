"""Measures, ratios, trends and the messages built from them."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from milepost.constants import (
    CONTRIBUTION,
    ELECTRIC_ENGINE,
    HEALTH_GOOD,
    HEALTH_LEVELS,
    HEALTH_WEIGHTS,
    SAFETY_COUNTERS,
    SCORE_ECONOMY,
    SCORE_OTHER,
    SCORE_SAFETY,
    SCORE_START,
    TREND,
)
from milepost.functions.text import first_label


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def safety_points() -> Column:
    """Severity counters of a trip added up, unknown ones as zero."""
    return reduce(add, [or_zero(F.col(c)).cast("bigint") for c in SAFETY_COUNTERS])


def ratio(part: Column, whole: Column) -> Column:
    """Quotient as double where ``whole`` is positive, else NULL."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def safety_pct(points: Column, km: Column) -> Column:
    """Points per hundred kilometres; lower is better."""
    return ratio(points, km) * 100


def engine_economy(engine: Column, km: Column, energy: Column) -> Column:
    """Energy per km for an electric engine that moved, otherwise km per unit of energy."""
    return F.when(
        (engine == ELECTRIC_ENGINE) & (km > 0), ratio(energy, km)
    ).otherwise(ratio(km, energy))


def driver_score(total: Column, safety: Column, economy: Column) -> Column:
    """Exact decimal score of a driver from event counts; there is no floor."""

    def weight(text):
        return F.lit(text).cast("decimal(6,1)")

    def count(value):
        return value.cast("decimal(20,0)")

    score = (
        weight(SCORE_START)
        - count(safety) * weight(SCORE_SAFETY[1])
        - count(economy) * weight(SCORE_ECONOMY[1])
        - count(total - safety - economy) * weight(SCORE_OTHER)
    )
    return score.cast("double")


def health_points(counts: dict[str, Column]) -> Column:
    return reduce(add, [counts[name] * weight for name, weight in HEALTH_WEIGHTS.items()])


def health_status(points: Column) -> Column:
    """Level of a vehicle by its points."""
    return first_label([(points <= limit, label) for limit, label in HEALTH_LEVELS], HEALTH_GOOD)


def pct_change(current: Column, previous: Column) -> Column:
    """Change in percent to two decimals; NULL without a usable previous value."""
    return F.when(previous != 0, F.round(_relative(current, previous) * 100, 2))


def _relative(current: Column, previous: Column) -> Column:
    return F.try_divide(current - previous, previous)


def trend(current: Column, previous: Column) -> Column:
    """Label of a lower-is-better measure against the previous period."""
    return first_label(
        [
            (previous.isNull(), TREND["none"]),
            (current < previous, TREND["better"]),
            (current > previous, TREND["worse"]),
        ],
        TREND["same"],
    )


def contribution(delta: Column) -> Column:
    return first_label(
        [(delta > 0, CONTRIBUTION["positive"]), (delta < 0, CONTRIBUTION["negative"])],
        CONTRIBUTION["neutral"],
    )


def two_decimals(value: Column) -> Column:
    """Text with exactly two decimals, the same on every engine."""
    return F.round(value, 2).try_cast("decimal(38,2)").cast("string")


def change_message(texts: dict, none: Column, better: Column, worse: Column, sizes: dict,
                   ending: Column | None = None) -> Column:
    """Sentence about a change; ``sizes`` holds the number quoted by either sentence.

    ``ending`` is appended to the better and worse sentences and, being part of a
    concatenation, makes them NULL when it is NULL.
    """

    def sentence(kind):
        before, after = texts[kind]
        parts = [F.lit(before), two_decimals(sizes[kind]), F.lit(after)]
        return F.concat(*parts, *([ending] if ending is not None else []))

    return (
        F.when(none, F.lit(texts["none"]))
        .when(better, sentence("better"))
        .when(worse, sentence("worse"))
        .otherwise(F.lit(texts["same"]))
    )


def safety_message(texts: dict, current: Column, previous: Column,
                   ending: Column | None = None) -> Column:
    """Lower is better; quotes the distance in points."""
    gap = F.abs(current - previous)
    return change_message(
        texts, previous.isNull(), current < previous, current > previous,
        {"better": gap, "worse": gap}, ending,
    )


def economy_message(texts: dict, current: Column, previous: Column) -> Column:
    """Higher is better; quotes the relative change in percent."""
    return change_message(
        texts,
        previous.isNull() | (previous == 0),
        current > previous,
        current < previous,
        {
            "better": _relative(current, previous) * 100,
            "worse": F.abs(_relative(current, previous)) * 100,
        },
    )
