"""Event marts: driving errors, pedal events, offenders, driver score, vehicle health.

Scheme texts are classified once per scheme and never per event.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from milepost.constants import (
    HEALTH_WEIGHTS,
    PEDAL_ISSUES,
    PEDAL_OTHER,
    PEDAL_WORD,
    SCORE_ECONOMY,
    SCORE_SAFETY,
    UNNAMED_DRIVER,
)
from milepost.functions import metrics as M
from milepost.functions.text import component, driving_error, pedal_issue
from milepost.operators import joins as J
from milepost.operators.rollups import event_counts, event_trip_rows, known_rows, sightings
from milepost.operators.windows import top_rows
from milepost.schemas import Fleet
from milepost.session import partitions_of_rows


def error_labels(fleet: Fleet) -> DataFrame:
    """Schemes that name a driving error the dictionary knows."""
    schemes = fleet.schemes.select(
        "scheme_id", driving_error(F.col("scheme_description")).alias("parametro")
    )
    dictionary = fleet.event_dictionary.select(
        "parametro", "categoria", F.col("peso_impacto").alias("peso_impacto_final"),
        "acao_recomendada_final",
    )
    return schemes.join(dictionary, "parametro")


def driver_error_counts(fleet: Fleet) -> DataFrame:
    """Driving errors per driver and month of the trip's start, weighted."""
    label = ["categoria", "parametro", "peso_impacto_final"]
    counts = event_counts(
        fleet, ["driver_id", "trip_month", *label, "acao_recomendada_final"],
        error_labels(fleet), ["trip_month"],
    )
    named = J.with_driver(counts, fleet, how="left").withColumn(
        "driver_name", F.coalesce("driver_name", F.lit(UNNAMED_DRIVER))
    )
    return (
        named.groupBy("driver_id", "driver_name", "trip_month", *label)
        .agg(
            F.sum("n").alias("total_eventos"),
            F.max("acao_recomendada_final").alias("acao_recomendada_final"),
        )
        .select(
            F.col("driver_id").cast("string").alias("driver_id"),
            "driver_name",
            "categoria",
            "parametro",
            F.year("trip_month").alias("year"),
            F.month("trip_month").alias("month"),
            "total_eventos",
            "peso_impacto_final",
            (F.col("total_eventos") * F.col("peso_impacto_final")).alias("pontuacao_impacto_final"),
            "acao_recomendada_final",
        )
    )


PERIOD = ("driver_id", "year", "month")


def _worst_first():
    return [
        F.col("pontuacao_impacto_final").desc_nulls_last(),
        F.col("total_eventos").desc(),
        *[F.col(c).asc_nulls_first() for c in ("parametro", "categoria", "driver_name")],
    ]


def mv_driver_errors(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Errors of a driver and month, ranked. A month holds ten kinds of error at most."""
    window = W.partitionBy(*PERIOD).orderBy(*_worst_first())
    return driver_error_counts(fleet).withColumn(
        "ranking_parametro", F.row_number().over(window).cast("bigint")
    )


def mv_driver_top_offenders(fleet: Fleet, as_of: dt.date | None = None, k: int = 5) -> DataFrame:
    """The first five errors of each driver and month."""
    top = top_rows(driver_error_counts(fleet), PERIOD, _worst_first(), k, "ranking_parametro")
    return top.withColumn("ranking_parametro", F.col("ranking_parametro").cast("bigint"))


# position in this list stands for an issue until its texts are joined
PEDAL_LABELS = [label for _, label in PEDAL_ISSUES] + [PEDAL_OTHER]


def pedal_schemes(fleet: Fleet) -> DataFrame:
    """Schemes about a pedal with the number of their issue; ``rows`` counts repeated ones."""
    issue = F.array_position(F.array(*[F.lit(x) for x in PEDAL_LABELS]), pedal_issue(F.col("description")))
    pedal = fleet.schemes.filter(F.lower("description").contains(PEDAL_WORD))
    return pedal.groupBy("scheme_id", issue.cast("int").alias("issue")).agg(F.count(F.lit(1)).alias("rows"))


def pedal_issues(fleet: Fleet) -> DataFrame:
    """Issues by number with their parameters, if any; ``texts`` counts repeated ones."""
    label = ["categoria", "peso_impacto", "acao_recomendada_final"]
    known = fleet.parameters.filter(F.col("parametro").isin(*PEDAL_LABELS))
    parameters = known.groupBy("parametro", *label).agg(F.count(F.lit(1)).alias("texts"))
    numbers = fleet.schemes.sparkSession.createDataFrame(list(enumerate(PEDAL_LABELS, 1)), "issue int, parametro string")
    found = numbers.join(parameters, "parametro", "left")
    return found.withColumn("texts", F.coalesce("texts", F.lit(1)))


def group_names(fleet: Fleet) -> DataFrame:
    """Group names by numbers: the least id of each, and ``twin`` among the names that share it."""
    known = fleet.groups.filter(F.col("group_name").isNotNull())
    names = known.groupBy("group_name").agg(F.min("group_id").alias("named"))
    twin = F.row_number().over(W.partitionBy("named").orderBy("group_name"))
    return names.withColumn("twin", twin)


def mv_pedal_events(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Pedal events per driver, group of the event's vehicle, issue and event month.

    Events are counted by numbers alone, of which a task holds a bounded number of rows. Names and
    texts meet the counts; what a dimension repeats is counted as often.
    """
    schemes, names = pedal_schemes(fleet), group_names(fleet)
    known = ["driver_id", "vehicle_id"]
    if fleet.event_rollup is not None:
        stored = fleet.event_rollup
        rows = known_rows(stored, known).select(*known, "event_month", "scheme_id", "n").join(schemes, "scheme_id")
    else:
        stored = fleet.events
        of_issue = known_rows(fleet.events, ["vehicle_id"]).join(schemes, "scheme_id")
        rows = event_trip_rows(of_issue, known_rows(fleet.trips, ["driver_id"]), extra=["issue", "rows"])
        rows = rows.withColumn("n", F.lit(1))
    placed = J.with_group(fleet.vehicles.select("vehicle_id", "group_id"), fleet, how="left").join(names, "group_name", "left")
    places = placed.groupBy("vehicle_id", "named", "twin").agg(F.count(F.lit(1)).alias("places"))
    keys = ["driver_id", "named", "twin", "event_month", "issue"]
    counted = rows.join(places, "vehicle_id").select(*keys, (F.col("n") * F.col("rows") * F.col("places")).alias("n"))
    tasks = partitions_of_rows(fleet.events.sparkSession, stored.count())
    counts = counted.repartition(tasks, *keys).groupBy(*keys).agg(F.sum("n").alias("n"))
    drivers = fleet.drivers.groupBy("driver_id", "driver_name").agg(F.count(F.lit(1)).alias("drivers"))
    named = counts.join(drivers, "driver_id").join(names, ["named", "twin"], "left").join(pedal_issues(fleet), "issue")
    events = F.col("n") * F.col("drivers") * F.col("texts")
    return named.withColumn("qtd_eventos", events).select(
        "driver_id", "driver_name", "group_name",
        "parametro", "categoria", "peso_impacto", "acao_recomendada_final",
        F.year("event_month").alias("year"),
        F.month("event_month").alias("month"),
        "qtd_eventos",
        (F.col("qtd_eventos") * F.col("peso_impacto")).alias("impacto_total"),
    )


def mv_safety_offenders(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Top driver per group and parameter found in scheme texts, parameters ranked.

    An event counts once for every parameter its scheme text contains.
    """
    label = ["ofensor", "categoria", "acao_recomendada_final"]
    counts = event_counts(
        fleet, ["vehicle_id", "driver_id", *label], J.scheme_parameters(fleet),
        ["driver_id", "vehicle_id"],
    )
    placed = J.with_group(J.with_vehicle(counts, fleet), fleet, how="left")
    totals = placed.groupBy("group_id", "group_name", "driver_id", *label).agg(
        F.sum("n").alias("total_events")
    )
    order = [
        F.col("total_events").desc(), F.col("driver_id"),
        *[F.col(c).asc_nulls_first() for c in ("group_name", "categoria", "acao_recomendada_final")],
    ]
    top = top_rows(totals, ["group_id", "ofensor"], order, 1).drop("_rank")
    # one row per group and parameter is left to rank
    by_events = W.partitionBy("group_id").orderBy(F.col("total_events").desc(), F.col("ofensor"))
    ranked = top.withColumn("ranking", F.row_number().over(by_events).cast("bigint"))
    return J.with_top_driver_name(
        ranked.withColumnRenamed("driver_id", "top_driver_id"), fleet
    ).select(
        "group_id", "group_name", "ofensor", "categoria", "total_events",
        "acao_recomendada_final", "top_driver_id", "top_driver_name", "ranking",
    )


def mv_driver_ranking(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Events of each driver by type and the score they leave."""
    counts = event_counts(fleet, ["driver_id", "scheme_id"], known=["driver_id"])
    typed = counts.join(fleet.schemes.select("scheme_id", "scheme_type"), "scheme_id", "left")

    def of_type(name):
        return F.sum(F.when(F.col("scheme_type") == name, F.col("n")).otherwise(0))

    per_driver = typed.groupBy("driver_id").agg(
        F.sum("n").alias("total_events"),
        of_type(SCORE_SAFETY[0]).alias("safety_events"),
        of_type(SCORE_ECONOMY[0]).alias("economy_events"),
    )
    drivers = J.with_group(
        fleet.drivers.select("driver_id", "driver_name", "group_id"), fleet, how="left"
    )
    events = ("total_events", "safety_events", "economy_events")
    named = per_driver.join(drivers, "driver_id").groupBy("driver_id").agg(
        F.max("driver_name").alias("driver_name"),
        F.max("group_name").alias("group_name"),
        *[F.sum(c).alias(c) for c in events],
    )
    return named.withColumn("driver_score", M.driver_score(*[F.col(c) for c in events]))


def mv_vehicle_health(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Component events of each vehicle, weighted points and status."""
    parts = list(HEALTH_WEIGHTS)
    labels = fleet.schemes.filter(F.col("parent_scheme").isNotNull()).select(
        "scheme_id", component(F.col("parent_scheme")).alias("part")
    ).filter(F.col("part").isin(*parts))
    seen = sightings(fleet.events) if fleet.sightings is None else fleet.sightings
    counts = (
        seen.join(labels, "scheme_id")
        .groupBy("vehicle_id")
        .agg(
            *[F.sum(F.when(F.col("part") == p, F.col("n")).otherwise(0)).alias(f"{p}_events") for p in parts],
            F.max("last_time").cast("date").alias("last_seen"),
        )
    )
    points = M.health_points({p: F.col(f"{p}_events") for p in parts})
    placed = J.with_group(J.with_vehicle(counts, fleet, how="left"), fleet, how="left")
    return placed.withColumn("health_points", points).select(
        "vehicle_id", "group_id", "group_name", *[f"{p}_events" for p in parts],
        "health_points", M.health_status(F.col("health_points")).alias("health_status"), "last_seen",
    )


def v_driver_event_parameters(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Events per driver in driver order; the parameter columns never have a value."""
    counts = event_counts(fleet, ["driver_id"], known=["driver_id"])
    named = (
        J.with_driver(counts, fleet)
        .groupBy("driver_id", "driver_name")
        .agg(F.sum("n").alias("qtd_eventos"))
    )
    return named.select(
        "driver_id",
        "driver_name",
        F.lit(None).cast("bigint").alias("parameter_id"),
        F.lit(None).cast("string").alias("parameter_name"),
        F.lit(None).cast("string").alias("parameter_category"),
        F.lit(None).cast("int").alias("peso_impacto"),
        F.lit(None).cast("string").alias("acao_recomendada_final"),
        "qtd_eventos",
    ).orderBy("driver_id")
