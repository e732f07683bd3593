"""Safety marts: points per kilometre of groups and drivers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from milepost.constants import DRIVER_SAFETY_MESSAGE, FLEET_SAFETY_MESSAGE, REFERENCE_DRIVER
from milepost.functions import metrics as M
from milepost.functions.parsing import as_date
from milepost.operators import joins as J
from milepost.operators.dedup import at_latest
from milepost.operators.rollups import trip_rows, trip_totals
from milepost.operators.windows import newest_row, top_rows, with_previous, with_row_number
from milepost.schemas import Fleet
from milepost.session import write_once
from milepost.sources.facts import since


def _year() -> Column:
    return F.year("ym").alias("year")


def _month() -> Column:
    return F.month("ym").alias("month")


def _rates(df: DataFrame) -> DataFrame:
    """Totals of known kilometres and the safety percentage."""
    km = M.or_zero(F.col("mileage"))
    return df.select(
        *[c for c in df.columns if c not in ("points", "mileage")],
        F.col("points").alias("total_points"),
        km.cast("double").alias("total_km"),
        M.safety_pct(F.col("points"), km).alias("safety_pct"),
    )


def _vehicle_months(fleet: Fleet, *keys: str, measures=("points", "mileage")) -> DataFrame:
    """Trip totals per vehicle and month of the trip's end."""
    totals = trip_totals(fleet, ["vehicle_id", *keys, "end_month"], measures, ["end_month"])
    return totals.withColumnRenamed("end_month", "ym")


def mv_group_safety_base(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Points, kilometres and safety percentage per group and month."""
    by_group = J.with_group(
        J.with_vehicle(_vehicle_months(fleet), fleet, how="left"), fleet, how="left"
    )
    sums = by_group.groupBy("group_id", "group_name", "ym").agg(
        F.sum("points").alias("points"), F.sum("mileage").alias("mileage")
    )
    return _rates(sums).select(
        "group_id", "group_name", "ym", _year(), _month(), "total_points", "total_km", "safety_pct"
    )


def _newest_month(df: DataFrame) -> DataFrame:
    """Newest month of each group with the percentage of the month row before."""
    compared = with_previous(
        df, "safety_pct", "safety_pct_prev", ["group_id"], ["ym", F.col("group_name").desc_nulls_last()]
    )
    return newest_row(
        compared, ["group_id"], [F.col("ym").desc(), F.col("group_name").asc_nulls_first()]
    )


def mv_fleet_safety_monthly(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Newest month per group against the month before, with its top driver by points.

    Drivers are added up first; totals and top driver of a group then come out of the
    same small frame instead of two passes over the trips.
    """
    per_driver = (
        J.with_group(
            J.with_vehicle(_vehicle_months(fleet, "driver_id"), fleet, how="left"), fleet, how="left"
        )
        .groupBy("group_id", "group_name", "ym", "driver_id")
        .agg(F.sum("points").alias("points"), F.sum("mileage").alias("mileage"))
    )
    top = F.min(
        F.when(
            F.col("driver_id").isNotNull() & F.col("group_id").isNotNull(),
            F.struct((-F.col("points")).alias("rank"), "driver_id"),
        )
    )
    per_group = per_driver.groupBy("group_id", "group_name", "ym").agg(
        F.sum("points").alias("points"),
        F.sum("mileage").alias("mileage"),
        top["driver_id"].alias("top_driver_id"),
    )
    newest = _newest_month(_rates(per_group))
    current, previous = F.col("safety_pct"), F.col("safety_pct_prev")
    return J.with_top_driver_name(newest, fleet).select(
        "group_id",
        "group_name",
        F.year("ym").alias("current_year"),
        F.month("ym").alias("current_month"),
        "total_points",
        "total_km",
        "safety_pct",
        "safety_pct_prev",
        M.trend(current, previous).alias("safety_tendencia"),
        M.safety_message(FLEET_SAFETY_MESSAGE, current, previous).alias("safety_message"),
        "top_driver_id",
        "top_driver_name",
    )


def driver_kilometres(fleet: Fleet) -> DataFrame:
    """Kilometres per group, month and driver, known drivers and groups only."""
    months = _vehicle_months(fleet, "driver_id", measures=("mileage",))
    placed = J.with_group(J.with_vehicle(months, fleet), fleet)
    per_driver = placed.groupBy("group_id", "ym", "driver_id").agg(F.sum("mileage").alias("mileage"))
    return (
        J.with_driver(per_driver, fleet)
        .groupBy("group_id", "ym", "driver_id", "driver_name")
        .agg(M.or_zero(F.sum("mileage")).cast("double").alias("total_km"))
    )


def by_kilometres() -> list[Column]:
    return [F.col("total_km").desc(), F.col("driver_id").asc(), F.col("driver_name").asc_nulls_first()]


def mv_group_main_driver(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Drivers of a group and month ranked by kilometres.

    Every driver gets a rank, and one group may hold most drivers, so the rank comes
    from range slices and not from a window per group.
    """
    ranked = with_row_number(driver_kilometres(fleet), by_kilometres(), "rn", ["group_id", "ym"])
    return ranked.select("group_id", "ym", "driver_id", "driver_name", "total_km", "rn")


def group_main_driver(fleet: Fleet) -> DataFrame:
    """Only the driver with most kilometres of each group and month."""
    return top_rows(driver_kilometres(fleet), ["group_id", "ym"], by_kilometres(), 1).drop("_rank")


def v_group_safety_summary(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Newest month per group with trend, message and main driver."""
    newest = _newest_month(mv_group_safety_base(fleet))
    main = group_main_driver(fleet).select(
        "group_id", "ym", F.col("driver_name").alias("driver_referencia")
    )
    current, previous = F.col("safety_pct"), F.col("safety_pct_prev")
    ending = F.concat(F.lit(REFERENCE_DRIVER), F.col("driver_referencia"), F.lit("."))
    return newest.join(main, ["group_id", "ym"], "left").select(
        "group_id",
        "group_name",
        F.col("year").alias("current_year"),
        F.col("month").alias("current_month"),
        "total_points",
        "total_km",
        "safety_pct",
        "safety_pct_prev",
        "driver_referencia",
        M.trend(current, previous).alias("safety_tendencia"),
        M.safety_message(FLEET_SAFETY_MESSAGE, current, previous, ending).alias("safety_message"),
    )


def driver_safety_months(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Safety per driver, group and month over the two months before the run date.

    The cut falls inside a month, so this reads trips and not the monthly rollup; the
    bound is a constant and reaches the scan as a pushed filter. Of trips stored by month only
    the folders of the months since then are read.
    """
    recent = trip_rows(since(fleet.trips, "end_drive", F.add_months(as_date(as_of), -2)))
    totals = recent.groupBy("vehicle_id", "driver_id", F.col("end_month").alias("ym")).agg(
        F.sum("points").alias("points"), F.sum("mileage").alias("mileage")
    )
    placed = J.with_group(J.with_vehicle(totals, fleet), fleet)
    per_driver = placed.groupBy("driver_id", "group_id", "group_name", "ym").agg(
        F.sum("points").alias("points"), F.sum("mileage").alias("mileage")
    )
    named = (
        J.with_driver(per_driver, fleet)
        .groupBy("driver_id", "driver_name", "group_id", "group_name", "ym")
        .agg(F.sum("points").alias("points"), F.sum("mileage").alias("mileage"))
    )
    return _rates(named)


def v_driver_safety_score_monthly(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Drivers in the newest month: change, trend, message, best and worst rank.

    The months are stored once: newest month, ranking slices and totals all read the
    stored rows. Both ranks come from one numbering, the worst counting from its end.
    """
    compared = with_previous(
        driver_safety_months(fleet, as_of), "safety_pct", "prev_pct", ["driver_id"],
        ["ym", "group_id", "group_name", "driver_name"],
    )
    latest = at_latest(write_once(compared, "driver-safety"), "ym")
    current, previous = F.col("safety_pct"), F.col("prev_pct")
    changed = latest.withColumn("_change", F.coalesce(current - previous, F.lit(0.0)))
    ranked = with_row_number(
        changed,
        [F.col(c).asc_nulls_first() for c in
         ("_change", "driver_id", "group_id", "driver_name", "group_name")],
        "ranking_melhor",
        total="_drivers",
    )
    return ranked.select(
        "driver_id",
        "driver_name",
        "group_id",
        "group_name",
        F.col("ym").alias("current_month"),
        "safety_pct",
        "prev_pct",
        F.coalesce(F.round(current - previous, 4), F.lit(0.0)).alias("impacto_pct"),
        M.trend(current, previous).alias("tendencia"),
        M.safety_message(DRIVER_SAFETY_MESSAGE, current, previous).alias("mensagem"),
        "ranking_melhor",
        (F.col("_drivers") + 1 - F.col("ranking_melhor")).alias("ranking_pior"),
    )
