"""Views over the hand-kept parameter table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milepost.operators.windows import with_row_number
from milepost.schemas import Fleet


def v_parameter_dictionary(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Distinct parameters, the weight as double."""
    return fleet.parameters.select(
        "parametro", "categoria", F.col("peso_impacto").cast("double").alias("peso_impacto"),
        "acao_recomendada_final",
    ).distinct()


def v_event_parameters(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Parameters with a running id in a fixed order and their unfilled text columns."""
    columns = ("parametro", "categoria", "peso_impacto", "acao_recomendada_final")
    numbered = with_row_number(
        fleet.parameters.select(*columns),
        [F.col(c).asc_nulls_first() for c in columns],
        "parameter_id",
    )
    unfilled = F.lit(None).cast("string")
    return numbered.select(
        "parameter_id",
        F.col("parametro").alias("parameter_name"),
        F.col("categoria").alias("parameter_category"),
        "categoria",
        unfilled.alias("parent_scheme"),
        unfilled.alias("parameter_description"),
        "peso_impacto",
        "acao_recomendada_final",
        unfilled.alias("explanation_final"),
        unfilled.alias("example_good"),
        unfilled.alias("example_bad"),
    )
