"""Accent folding, match keys and ordered text classifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from milepost.constants import (
    ACCENTED,
    COMPONENT_OTHER,
    COMPONENTS,
    DRIVING_ERRORS,
    ENERGY_TYPES,
    ENERGY_UNKNOWN,
    PEDAL_ISSUES,
    PEDAL_OTHER,
    UNACCENTED,
)


def fold_text(text: Column) -> Column:
    """Lower-case text without accents."""
    return F.lower(F.translate(text, ACCENTED, UNACCENTED))


def match_key(text: Column) -> Column:
    """Folded text reduced to letters and digits."""
    return F.regexp_replace(fold_text(text), "[^a-z0-9]+", "")


def first_label(tests, otherwise: str | None = None) -> Column:
    """Label of the first true test in ``(condition, label)`` order."""
    (condition, label), *rest = tests
    chosen = F.when(condition, F.lit(label))
    for condition, label in rest:
        chosen = chosen.when(condition, F.lit(label))
    return chosen if otherwise is None else chosen.otherwise(F.lit(otherwise))


def _mentions(text: Column, fragments) -> Column:
    return reduce(Column.__or__, [text.contains(f) for f in fragments])


def _by_fragment(text: Column, rules, otherwise: str | None = None) -> Column:
    return first_label([(_mentions(text, frags), label) for frags, label in rules], otherwise)


def driving_error(description: Column) -> Column:
    """One of ten driving errors named by a scheme description, or NULL."""
    return _by_fragment(fold_text(F.coalesce(description, F.lit(""))), DRIVING_ERRORS)


def pedal_issue(description: Column) -> Column:
    """Issue behind a pedal event."""
    return _by_fragment(F.lower(description), PEDAL_ISSUES, PEDAL_OTHER)


def component(parent_scheme: Column) -> Column:
    """Vehicle component an event belongs to."""
    return _by_fragment(F.lower(parent_scheme), COMPONENTS, COMPONENT_OTHER)


def energy_type(engine: Column) -> Column:
    """Energy source of an engine type."""
    return first_label(
        [(F.lower(engine).isin(*names), label) for names, label in ENERGY_TYPES],
        ENERGY_UNKNOWN,
    )
