"""Economy marts: distance per energy of drivers, engines and groups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from milepost.constants import ECONOMY_MESSAGE, GROUP_ECONOMY_MESSAGE, UNNAMED_DRIVER
from milepost.functions import metrics as M
from milepost.functions.text import energy_type
from milepost.operators import joins as J
from milepost.operators.reshape import unpivot_offenders
from milepost.operators.rollups import add_up, trip_totals
from milepost.operators.windows import newest_row, top_rows, with_previous
from milepost.schemas import Fleet

FUEL = ("mileage", "energy_used")
ENGINE = "vehicle_engine_type"
FLEET_KEYS = ("group_id", "group_name", ENGINE)


def _driver_months(fleet: Fleet, known=("end_month",)) -> DataFrame:
    """Fuel totals per group, engine, month of the trip's end and driver."""
    months = trip_totals(fleet, ["vehicle_id", "driver_id", "end_month"], FUEL, known)
    placed = J.with_group(J.with_vehicle(months, fleet, ENGINE), fleet)
    return add_up(placed.withColumnRenamed("end_month", "ym"), [*FLEET_KEYS, "ym", "driver_id"], FUEL)


def _known_fuel(df: DataFrame) -> DataFrame:
    """Sums with unknown measures as zero."""
    return df.withColumns(
        {
            "total_km": M.or_zero(F.col("mileage")).cast("double"),
            "total_energy": M.or_zero(F.col("energy_used")).cast("double"),
        }
    )


def v_driver_keymap(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """One row per driver with name and home group; ids as text."""
    names = J.with_group(
        fleet.drivers.select("driver_id", "driver_name", "group_id"), fleet, how="left"
    )
    driver_id = F.col("driver_id").cast("string")
    return (
        names.groupBy("driver_id")
        .agg(
            F.max(F.trim("driver_name")).alias("driver_name"),
            F.max("group_id").alias("group_id"),
            F.max("group_name").alias("group_name"),
        )
        .select(
            driver_id.alias("driver_tech_id"), driver_id.alias("driver_id"),
            "driver_name", "group_id", "group_name",
        )
    )


def v_driver_economy_monthly(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Distance and energy per driver, group, engine and month of the trip's start."""
    months = trip_totals(fleet, ["vehicle_id", "driver_id", "start_month"], FUEL, ["start_month"])
    placed = J.with_group(
        J.with_vehicle(months, fleet, ENGINE, how="left"), fleet, how="left"
    )
    sums = _known_fuel(add_up(placed, [*FLEET_KEYS, "start_month", "driver_id"], FUEL))
    names = fleet.drivers.groupBy("driver_id").agg(
        F.max(F.trim("driver_name")).alias("driver_name")
    )
    return sums.join(names, "driver_id", "left").select(
        F.year("start_month").alias("year"),
        F.month("start_month").alias("month"),
        "group_id",
        "group_name",
        F.col("driver_id").cast("string").alias("driver_id"),
        F.coalesce("driver_name", F.lit(UNNAMED_DRIVER)).alias("driver_name"),
        ENGINE,
        energy_type(F.col(ENGINE)).alias("energy_type"),
        "total_km",
        "total_energy",
        M.ratio(F.col("total_km"), F.col("total_energy")).alias("avg_economy"),
    )


def v_fleet_economy_monthly(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Distance and energy per group, engine and month; unknown sums stay NULL."""
    months = trip_totals(fleet, ["vehicle_id", "end_month"], FUEL, ["end_month"])
    placed = J.with_group(J.with_vehicle(months, fleet, ENGINE), fleet, how="left")
    km, energy = F.col("mileage").cast("double"), F.col("energy_used").cast("double")
    return add_up(placed, [*FLEET_KEYS, "end_month"], FUEL).select(
        F.year("end_month").alias("year"),
        F.month("end_month").alias("month"),
        *FLEET_KEYS,
        km.alias("total_km"),
        energy.alias("total_energy"),
        F.try_divide(km, energy).alias("avg_economy"),
    )


def v_group_economy_summary(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Unweighted mean of a group's monthly ratios, best group first."""
    known = v_fleet_economy_monthly(fleet).filter(F.col("avg_economy").isNotNull())
    before, middle, after = GROUP_ECONOMY_MESSAGE
    mean = F.round(F.avg("avg_economy"), 2)
    return (
        known.groupBy("group_id", "group_name")
        .agg(mean.alias("media_economia_grupo"))
        .withColumn(
            "mensagem_economia",
            F.concat(
                F.lit(before), "group_name", F.lit(middle),
                M.two_decimals(F.col("media_economia_grupo")), F.lit(after),
            ),
        )
        .orderBy(F.col("media_economia_grupo").desc_nulls_last())
    )


def mv_fleet_economy_comparison(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Newest month per group and engine against the month before, with its top driver.

    Totals and top driver by kilometres come out of one frame of driver months. An
    unknown engine has no top driver.
    """
    drivers = _driver_months(fleet)
    top = F.min(
        F.when(
            F.col("driver_id").isNotNull() & F.col(ENGINE).isNotNull(),
            F.struct((-M.or_zero(F.col("mileage"))).alias("rank"), "driver_id"),
        )
    )
    months = _known_fuel(
        drivers.groupBy(*FLEET_KEYS, "ym").agg(
            *[F.sum(m).alias(m) for m in FUEL], top["driver_id"].alias("top_driver_id")
        )
    ).withColumn(
        "avg_economy_current",
        M.engine_economy(F.col(ENGINE), F.col("total_km"), F.col("total_energy")),
    )
    compared = with_previous(
        months, "avg_economy_current", "avg_economy_previous", ["group_id", ENGINE],
        ["ym", F.col("group_name").desc_nulls_last()],
    )
    newest = newest_row(
        compared, ["group_id", ENGINE],
        [F.col("ym").desc(), F.col("group_name").asc_nulls_first()],
    )
    current, previous = F.col("avg_economy_current"), F.col("avg_economy_previous")
    return J.with_top_driver_name(newest, fleet).select(
        *FLEET_KEYS,
        F.year("ym").alias("year"),
        F.month("ym").alias("month"),
        "total_km",
        "total_energy",
        "avg_economy_current",
        "avg_economy_previous",
        M.pct_change(current, previous).alias("avg_economy_change_pct"),
        M.economy_message(ECONOMY_MESSAGE, current, previous).alias("mensagem_economia"),
        "top_driver_id",
        "top_driver_name",
    )


def exact_mean(ratio: str) -> Column:
    """Mean of ratios as decimals, so that it does not depend on the order of addition."""
    value = F.col(ratio).try_cast("decimal(28,9)")
    return F.sum(value).cast("double") / F.count(value)


def mv_driver_contribution(
    fleet: Fleet, as_of: dt.date | None = None, all_drivers: bool = False
) -> DataFrame:
    """Driver economy against the fleet mean in the newest month of a group and engine.

    One driver per group and engine, the one with the smallest id; ``all_drivers``
    returns every driver of that month. Months in which no driver has a ratio, and
    unknown engines, have no fleet mean and do not appear.
    """
    drivers = (
        _driver_months(fleet, ("end_month", "driver_id"))
        .filter(F.col(ENGINE).isNotNull())
        .withColumn(
            "driver_avg_economy",
            M.engine_economy(F.col(ENGINE), F.col("mileage"), F.col("energy_used")),
        )
    )
    months = drivers.groupBy(*FLEET_KEYS, "ym").agg(
        exact_mean("driver_avg_economy").alias("fleet_avg_economy"),
        F.min("driver_id").alias("driver_id"),
        F.min_by("driver_avg_economy", "driver_id").alias("driver_avg_economy"),
    ).filter(F.col("fleet_avg_economy").isNotNull())
    newest = newest_row(
        months, ["group_id", ENGINE],
        [F.col("ym").desc(), F.col("driver_id").asc(), F.col("group_name").asc_nulls_first()],
    )
    if all_drivers:
        newest = drivers.join(
            newest.select("group_id", ENGINE, "ym", "fleet_avg_economy"), ["group_id", ENGINE, "ym"]
        )
    names = J.unique_names(fleet.drivers, "driver_id", "driver_name")
    return (
        newest.withColumn(
            "economy_delta", F.round(F.col("driver_avg_economy") - F.col("fleet_avg_economy"), 4)
        )
        .join(names, "driver_id", "left")
        .select(
            *FLEET_KEYS,
            "ym",
            "driver_id",
            "driver_name",
            "driver_avg_economy",
            "fleet_avg_economy",
            "economy_delta",
            M.contribution(F.col("economy_delta")).alias("impacto_economia"),
        )
    )


def economy_offenders(fleet: Fleet) -> DataFrame:
    """Events per group, driver and economy offender over all history."""
    counters = ("engine", "speed_road3", "acceleration3", "idle_duration", "gearbox")
    totals = trip_totals(fleet, ["vehicle_id", "driver_id"], counters, ["driver_id"])
    placed = J.with_group(
        J.with_vehicle(totals, fleet).filter(F.col("group_id").isNotNull()), fleet, how="left"
    )
    keys = ("group_id", "group_name", "driver_id")
    return unpivot_offenders(add_up(placed, keys, counters), *keys)


def mv_economy_offenders(fleet: Fleet, as_of: dt.date | None = None) -> DataFrame:
    """Top driver per group and offender, and the offenders of a group ranked."""
    top = top_rows(
        economy_offenders(fleet), ["group_id", "ofensor"],
        [F.col("total_events").desc(), F.col("driver_id"), F.col("group_name").asc_nulls_first()], 1,
    ).drop("_rank").withColumnRenamed("driver_id", "top_driver_id")
    # one row per offender and group, so a group is as large as the list of offenders
    place = W.partitionBy("group_id").orderBy(F.col("total_events").desc(), "ofensor")
    ranked = top.withColumn("ranking", F.row_number().over(place))
    return J.with_top_driver_name(ranked, fleet).select(
        "group_id", "group_name", "top_driver_id", "top_driver_name", "ofensor",
        "total_events", "action_recommended", F.col("ranking").cast("bigint").alias("ranking"),
    )
