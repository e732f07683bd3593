"""Every operator and mart as a query over the supplied tables."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types

from milepost.constants import TRIP_TIME_FORMATS
from milepost.functions import cleaning as C
from milepost.functions import metrics as M
from milepost.functions import parsing as P
from milepost.functions import text as X
from milepost.operators import conform as W
from milepost.operators import dedup as D
from milepost.operators import joins as J
from milepost.operators import quality as Q
from milepost.operators import rollups as R
from milepost.operators.windows import newest_row, top_rows, with_previous
from milepost.plans import behaviour, economy, incremental, pipeline, safety
from milepost.plans import silver as S
from milepost.plans.marts import MARTS
from milepost.schemas import BRONZE, FOREIGN_KEYS, PRIMARY_KEYS
from milepost.session import shared_dir, write_once
from milepost.sources import facts, feeds
from milepost.sources import key_index as index
from milepost.sources import projection as T
from milepost.sources import versions
from milepost.sources.bronze import SOURCE_FILE, read_bronze, read_checked, route_landing
from milepost.sources.silver import (
    PARTITION,
    append_unseen,
    load_keyed,
    read_keyed,
    write_partitions,
)
from milepost.streaming import newest
from milepost.streaming.ingest import ingest, stream_bronze

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = T.AS_OF
SECOND_LOAD = dt.date(1998, 1, 1)
EXPORT_PREFIX = "fleet_"


def _month(column: str) -> Column:
    return P.month_start(F.col(column))


# --- sources and silver ---------------------------------------------------------------


def src_csv_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "bronze")
    feeds.write_csv_feed(feeds.feed(spark, sf_dir, "drivers"), path)
    rows = read_bronze(spark, path, BRONZE["drivers"])
    return rows.select(
        *BRONZE["drivers"].names,
        F.regexp_extract(SOURCE_FILE, "file=([^/]+)/", 1).alias("source"),
        S.source_date("any_sep").alias(PARTITION),
    )


DAMAGED = (
    "CASE o_orderkey % 10 WHEN 1 THEN concat(o_orderkey, ',', o_custkey) "
    "WHEN 2 THEN concat(o_orderkey, ',', o_custkey, ',', o_orderstatus, ',extra') "
    "WHEN 3 THEN concat(o_orderkey, ',\"', o_custkey, ',', o_orderstatus) "
    "WHEN 4 THEN concat(o_orderkey, ',\"', o_custkey, '\"x,', o_orderstatus) "
    "WHEN 5 THEN concat(o_orderkey, ',\"', o_custkey, ', twice\",', o_orderstatus) "
    "ELSE concat(o_orderkey, ',', o_custkey, ',', o_orderstatus) END"
)


def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some are short, long or badly quoted: good rows and rejected lines."""
    path = shared_dir(spark, "damaged")
    T.table(spark, sf_dir, "orders").selectExpr(f"{DAMAGED} AS value").write.text(path)
    schema = types.StructType.fromDDL("drive_id string, driver_id string, status string")
    good, rejected = read_checked(spark, path, schema, header=False)
    nothing = F.lit(None).cast("string")
    return good.select(*schema.names, nothing.alias("line"), nothing.alias("reason")).unionByName(
        rejected.select(*[nothing.alias(n) for n in schema.names], "line", "reason")
    )


LANDED = (
    "concat(CASE o_orderkey % 9 WHEN 0 THEN 'fleet_drivers/' WHEN 1 THEN 'fleet_events/' "
    "WHEN 2 THEN 'fleet_group/' WHEN 3 THEN 'fleet_schemes/' WHEN 4 THEN 'fleet_trips/' "
    "WHEN 5 THEN 'fleet_vehicles/' WHEN 6 THEN 'bronze/fleet_trips/' WHEN 7 THEN 'other/' "
    "ELSE 'old/fleet_trips/' END, 'fleet_', CAST(o_orderkey AS STRING), '.csv')"
)


def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = T.table(spark, sf_dir, "orders").selectExpr(f"{LANDED} AS path")
    return route_landing(files, EXPORT_PREFIX)


def _dated_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("drive_id"),
        F.col("o_custkey").alias("driver_id"),
        "o_orderstatus",
        _month("o_orderdate").alias(PARTITION),
    )


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "silver")
    trips = _dated_trips(spark, sf_dir).select("drive_id", "driver_id", PARTITION)
    write_partitions(trips.withColumn("load", F.lit(1)), path)
    later = trips.filter(F.col(PARTITION) >= SECOND_LOAD)
    write_partitions(later.withColumn("load", F.lit(2)), path)
    return spark.read.parquet(path)


def retain_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.at_latest(_dated_trips(spark, sf_dir), PARTITION)


def date_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = T.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias(PARTITION)
    )
    return D.date_inventory(dated, PARTITION)


def norm_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T.table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "lang", f"{feeds.messy_word('doc_id', 'source')} AS source"
    )
    return C.fill_missing_text(docs)


def norm_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = T.table(spark, sf_dir, "pages").selectExpr(
        "page_id", "html", f"{feeds.messy_word('page_id', 'url')} AS url"
    )
    return C.null_missing_text(pages)


def norm_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = T.table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "text", f"{feeds.messy_word('conv_id', 'role')} AS role"
    )
    return C.trim_strings(turns)


def _raw_orders(spark: SparkSession, sf_dir: str, expression: str) -> DataFrame:
    return T.table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{expression} AS raw")


RAW_ID = feeds.messy_id("o_orderkey")
RAW_NUMBER = feeds.messy_number("o_totalprice", "o_orderkey")
RAW_TIME = feeds.messy_time("o_orderdate", "o_orderkey")
RAW_FILE = feeds.messy_file("o_orderdate", "o_orderkey", "trips")


def _parsed(raw: str, parse: Callable[[Column], Column], output: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _raw_orders(spark, sf_dir, raw).select(
            "o_orderkey", "raw", parse(F.col("raw")).alias(output)
        )

    return query


def _event_feed(spark: SparkSession, sf_dir: str, drive_id: Column) -> DataFrame:
    return T.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS event_id", "l_orderkey", "l_partkey AS scheme_id",
        "l_suppkey AS vehicle_id", "l_shipdate AS start_time",
        f"concat('export_', CAST(l_partkey % 9 AS STRING), '_events.csv') AS {SOURCE_FILE}",
    ).select(
        "*", drive_id.alias("drive_id"), _month("start_time").alias(PARTITION)
    ).drop("l_orderkey")


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.latest_per_key(
        _event_feed(spark, sf_dir, F.col("l_orderkey")), ["scheme_id"], [PARTITION]
    )


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.latest_per_key(
        _event_feed(spark, sf_dir, F.col("l_orderkey")), ["event_id"], [PARTITION, SOURCE_FILE]
    )


def dedup_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyless = F.when(F.col("l_orderkey") % 50 != 7, F.col("l_orderkey"))
    return D.latest_per_key(
        _event_feed(spark, sf_dir, keyless), ["drive_id"], [SOURCE_FILE], "keep"
    )


def drivers_official_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _dated_trips(spark, sf_dir)
    rows = trips.join(T.drivers(spark, sf_dir), "driver_id").select(
        "driver_id", "driver_name", "group_id", "driver_code", "worker_id", PARTITION,
        F.concat(
            F.lit("export_"), (F.col("drive_id") % 9).cast("string"), F.lit("_drivers.csv")
        ).alias(SOURCE_FILE),
    )
    return S.official_drivers(rows, trips)


def trips_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "trips")
    trips = _dated_trips(spark, sf_dir)
    columns = ("drive_id", "driver_id", PARTITION)
    finished = trips.filter(F.col("o_orderstatus") == "F").select(*columns)
    keyed = F.when(F.col("drive_id") % 50 != 7, F.col("drive_id")).alias("drive_id")
    write_partitions(finished.withColumn("load", F.lit(1)), path)
    for load in (2, 3):  # the third load brings nothing new
        arrived = trips.select(keyed, *columns[1:]).withColumn("load", F.lit(load))
        append_unseen(spark, arrived, path, "drive_id")
    return spark.read.parquet(path)


def conform_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.conform_drivers(S.clean_drivers(feeds.feed(spark, sf_dir, "drivers")))


def conform_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.conform_groups(S.clean_groups(feeds.feed(spark, sf_dir, "groups"), AS_OF))


def conform_schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.conform_schemes(S.clean_schemes(feeds.feed(spark, sf_dir, "schemes"), AS_OF), AS_OF)


def conform_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.conform_vehicles(S.clean_vehicles(feeds.feed(spark, sf_dir, "vehicles"), AS_OF))


def conform_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = S.clean_events(feeds.feed(spark, sf_dir, "events"), AS_OF)
    return W.conform_events(events, AS_OF).drop("sk_event")


def conform_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.conform_trips(S.clean_trips(feeds.feed(spark, sf_dir, "trips")))


def _warehouse(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    fleet = T.fleet(spark, sf_dir)
    return {
        "d_drivers": fleet.drivers, "d_groups": fleet.groups, "d_schemes": fleet.schemes,
        "d_vehicles": fleet.vehicles, "t_events": fleet.events, "t_trips": fleet.trips,
    }


def dq_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet = T.fleet(spark, sf_dir)
    tables = {
        "drivers": fleet.drivers, "groups": fleet.groups, "schemes": fleet.schemes,
        "vehicles": fleet.vehicles, "trips": fleet.trips, "events": fleet.events,
    }
    return Q.checkpoint_report(spark, tables)


def dq_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {**PRIMARY_KEYS, "t_trips": "driver_id", "t_events": "event_id"}
    return Q.check_primary_keys(_warehouse(spark, sf_dir), keys)


def dq_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {
        **FOREIGN_KEYS,
        ("t_trips", "driver_id"): ("d_drivers", "driver_id"),
        ("t_events", "vehicle_id"): ("d_vehicles", "vehicle_id"),
    }
    return Q.check_foreign_keys(_warehouse(spark, sf_dir), keys)


def dq_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = T.trips(spark, sf_dir).withColumn(PARTITION, F.col("start_drive").cast("date"))
    return Q.null_partition_report(dated, "trips")


STREAMED = (
    "CAST(event_id AS STRING) AS event_id", "CAST(user_id AS STRING) AS vehicle_id",
    "CAST(event_id % 40 AS STRING) AS scheme_id", "CAST(user_id * 3 AS STRING) AS drive_id",
    "concat(substring(CAST(ts AS STRING), 1, 10), 'T', substring(CAST(ts AS STRING), 12, 8)) AS start_time",
    "event_type AS start_location", "props AS end_location",
)


STREAM_COLUMNS = (
    "event_id", "vehicle_id", "scheme_id", "drive_id", "start_time", "start_location",
    "end_location", "speed", PARTITION,
)


def _extracts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two extracts per month, every tenth event corrected by the second one."""
    source = T.table(spark, sf_dir, "events")
    named = "concat('export_', substring(CAST(ts AS STRING), 1, 4), '_', substring(CAST(ts AS STRING), 6, 2), '_{}_events.csv') AS " + SOURCE_FILE
    first = source.selectExpr(*STREAMED, "'10' AS speed", named.format("01"))
    second = source.filter("event_id % 10 = 0").selectExpr(*STREAMED, "'20' AS speed", named.format("15"))
    names = BRONZE["events"].names
    missing = [F.lit(None).cast("string").alias(c) for c in names if c not in first.columns]
    return [e.select("*", *missing).select(*names, SOURCE_FILE) for e in (first, second)]


def stream_bronze_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both extracts ingested one after the other, then the newest row per event."""
    landing, cleaned = shared_dir(spark, "landing"), shared_dir(spark, "cleaned")
    for extract in _extracts(spark, sf_dir):
        feeds.write_csv_feed(extract, landing)
        ingest(
            stream_bronze(spark, landing, BRONZE["events"]),
            lambda batch: S.clean_events(batch, AS_OF),
            cleaned,
            f"{landing}-progress",
        )
    stored = spark.read.parquet(cleaned).drop("_batch")
    silver = D.latest_per_key(stored, ["event_id"], S.NEWEST)
    return silver.select(*STREAM_COLUMNS)


# --- operators --------------------------------------------------------------------------


def join_events_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet = T.fleet(spark, sf_dir)
    return R.event_trip_rows(fleet.events, fleet.trips)


def _star(how: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        fleet = T.fleet(spark, sf_dir)
        trips = fleet.trips.select("drive_id", "vehicle_id", "driver_id")
        placed = J.with_group(
            J.with_vehicle(trips, fleet, "vehicle_engine_type", how=how), fleet, how=how
        )
        return J.with_driver(placed, fleet, how=how)

    return query


def join_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.scheme_parameters(T.fleet(spark, sf_dir))


def dim_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = T.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("driver_id"),
        F.concat("o_orderstatus", F.lit("/"), "o_orderpriority").alias("driver_name"),
    )
    return J.unique_names(variants, "driver_id", "driver_name")


def agg_sum_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    def known(column: str) -> Column:
        return F.sum(M.or_zero(F.col(column))).cast("double")

    return T.trips(spark, sf_dir).groupBy("driver_id").agg(
        known("mileage").alias("total_km"), known("energy_used").alias("total_energy")
    )


def agg_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.events(spark, sf_dir).groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("n_events"))


def agg_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet = T.fleet(spark, sf_dir)
    typed = fleet.events.join(fleet.schemes.select("scheme_id", "scheme_type"), "scheme_id", "left")
    return typed.groupBy("vehicle_id").agg(
        F.count_if(F.col("scheme_type") == "Safety").alias("safety_events"),
        F.count_if(F.col("scheme_type") == "Economy").alias("economy_events"),
    )


def agg_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = R.add_up(T.trips(spark, sf_dir), ["driver_id"], ["mileage", "energy_used"])
    return totals.select(
        "driver_id", M.ratio(F.col("mileage"), F.col("energy_used")).alias("km_per_energy")
    )


def agg_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleet = T.fleet(spark, sf_dir)
    labels = behaviour.error_labels(fleet)
    counts = R.event_counts(fleet, ["driver_id", "parametro", "peso_impacto_final"], labels)
    return counts.withColumn("score", F.col("n") * F.col("peso_impacto_final"))


def agg_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T.table(spark, sf_dir, "events").select(
        _month("ts").alias("ym"), "event_type", F.col("value").cast("decimal(18,2)").alias("value")
    )
    return rows.groupBy("ym", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("double").alias("total")
    ).select("ym", F.year("ym").alias("year"), F.month("ym").alias("month"), "event_type", "n", "total")


def safety_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.trips(spark, sf_dir).select("drive_id", M.safety_points().alias("points"))


def previous_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = safety.mv_group_safety_base(T.fleet(spark, sf_dir))
    return with_previous(base, "safety_pct", "safety_pct_prev", ["group_id"], ["ym"]).select(
        "group_id", "ym", "safety_pct", "safety_pct_prev"
    )


def latest_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = safety.mv_group_safety_base(T.fleet(spark, sf_dir))
    return newest_row(base, ["group_id"], [F.col("ym").desc()]).select(
        "group_id", "group_name", "ym", "total_points"
    )


def topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    km = safety.driver_kilometres(T.fleet(spark, sf_dir))
    top = top_rows(km, ["group_id", "ym"], safety.by_kilometres(), 5, "rank")
    return top.withColumn("rank", F.col("rank").cast("bigint"))


def unpivot_offenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return economy.economy_offenders(T.fleet(spark, sf_dir))


def fold_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "documents").select(
        "doc_id", X.fold_text(F.col("text")).alias("folded")
    )


def match_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "documents").select(
        "doc_id", X.match_key(F.col("text")).alias("match_key")
    )


def classify_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.schemes(spark, sf_dir).select(
        "scheme_id",
        X.driving_error(F.col("scheme_description")).alias("error"),
        X.pedal_issue(F.col("description")).alias("pedal"),
        X.component(F.col("parent_scheme")).alias("component"),
    )


def trend_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = previous_period(spark, sf_dir)
    return compared.select(
        "group_id", "ym", M.trend(F.col("safety_pct"), F.col("safety_pct_prev")).alias("trend")
    )


def _mart(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return MARTS[name](T.fleet(spark, sf_dir), AS_OF)

    return query


def driver_contribution_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every driver of the newest month instead of the one with the smallest id."""
    return economy.mv_driver_contribution(T.fleet(spark, sf_dir), AS_OF, all_drivers=True)


def silver_trips_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of one feed, the last without its older dates: all trips are there once."""
    path = shared_dir(spark, "silver-trips")
    trips = _dated_trips(spark, sf_dir)
    keyed = F.when(F.col("drive_id") % 50 != 7, F.col("drive_id")).alias("drive_id")
    arrived = trips.select(keyed, "driver_id", PARTITION, F.col("drive_id").alias("feed_row"))
    load_keyed(spark, arrived.filter(trips["o_orderstatus"] == "F"), path, "drive_id")
    load_keyed(spark, arrived, path, "drive_id")
    load_keyed(spark, arrived.filter(F.col(PARTITION) >= F.lit(SECOND_LOAD)), path, "drive_id")
    return read_keyed(spark, path)


def silver_events_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load replaces the dates it has; a date that it lacks stays."""
    path = shared_dir(spark, "silver-events")
    trips = _dated_trips(spark, sf_dir).select("drive_id", "driver_id", PARTITION)
    write_partitions(trips.withColumn("load", F.lit(1)), path)
    again = trips.filter(F.col(PARTITION) >= F.lit(SECOND_LOAD)).withColumn("load", F.lit(2))
    write_partitions(again, path)
    return spark.read.parquet(path)


def append_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loads of ``silver_trips_incremental`` into a versioned table with a key index."""
    path = shared_dir(spark, "indexed-trips")
    trips = _dated_trips(spark, sf_dir)
    keyed = F.when(F.col("drive_id") % 50 != 7, F.col("drive_id")).alias("drive_id")
    arrived = trips.select(keyed, "driver_id", PARTITION, F.col("drive_id").alias("feed_row"), "o_orderstatus")
    loads = (arrived.filter("o_orderstatus = 'F'"), arrived, arrived.filter(F.col(PARTITION) >= F.lit(SECOND_LOAD)))
    for load in loads:
        index.append_indexed(spark, load.drop("o_orderstatus"), path, "drive_id")
    return index.read_indexed(spark, path)


def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see after a load that died before its commit, and after the next one.

    The first version is removed once the second replaced some of its dates.
    """
    path = shared_dir(spark, "versioned-trips")
    trips = _dated_trips(spark, sf_dir).select("drive_id", "driver_id", PARTITION)
    versions.publish(trips.withColumn("load", F.lit(1)), path, PARTITION)
    later = trips.filter(F.col(PARTITION) >= F.lit(SECOND_LOAD))
    try:
        dying = versions.Load(spark, path)
        dying.write(later.withColumn("load", F.lit(9)), partition=PARTITION, replace="dates")
        raise RuntimeError("died between write and commit")
    except RuntimeError:
        after_failure = write_once(versions.read_version(spark, path), "after-failure")
    versions.publish(later.withColumn("load", F.lit(2)), path, PARTITION, "dates")
    versions.expire(spark, path)
    after_commit = versions.read_version(spark, path)
    return after_failure.withColumn("seen", F.lit("failure")).unionByName(after_commit.withColumn("seen", F.lit("commit")))


def refresh_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver scores from rollups that were brought up to date after three quarters changed."""
    root = shared_dir(spark, "incremental")
    fleet = T.fleet(spark, sf_dir)
    trips = fleet.trips.withColumn(PARTITION, F.trunc("start_drive", "quarter"))
    events = fleet.events.withColumn(PARTITION, F.trunc("start_time", "quarter"))
    late, changed = dt.date(1995, 4, 1), dt.date(1997, 1, 1)
    driver = F.when(F.col(PARTITION) == F.lit(changed), F.lit(1)).otherwise(F.col("driver_id"))
    incremental.load_fact(trips.withColumn("driver_id", driver).filter(~F.col(PARTITION).eqNullSafe(F.lit(late))), f"{root}/trips")
    incremental.load_fact(events.filter(F.col(PARTITION) != F.lit(late)), f"{root}/events")
    incremental.refresh_rollups(spark, f"{root}/trips", f"{root}/events", f"{root}/rollups")
    incremental.load_fact(trips.filter(F.col(PARTITION).isin(late, changed)), f"{root}/trips")
    incremental.load_fact(events.filter(F.col(PARTITION) == F.lit(late)), f"{root}/events")
    incremental.refresh_rollups(spark, f"{root}/trips", f"{root}/events", f"{root}/rollups")
    return MARTS["mv_driver_ranking"](incremental.with_rollups(fleet, f"{root}/rollups"), AS_OF)


def run_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of the warehouse after a run that stopped for want of a feed and then went on.

    ``silver_loads`` counts the loads of silver trips: the second run leaves them as they are.
    """
    bronze, out = shared_dir(spark, "run-bronze"), shared_dir(spark, "run-out")
    for name in ("trips", "events", "schemes", "vehicles"):
        feeds.write_csv_feed(feeds.feed(spark, sf_dir, name), f"{bronze}/{name}", gather=False)
    try:
        pipeline.load_silver(spark, bronze, out, AS_OF, resume=True)
        raise RuntimeError("the run went through without groups")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    feeds.write_csv_feed(feeds.feed(spark, sf_dir, "groups"), f"{bronze}/groups")
    day = index.read_indexed(spark, f"{out}/silver/trips").agg(F.max(PARTITION)).first()[0]
    named = F.lit(f"export_{day.year}_{day.month}_{day.day}_drivers.csv")
    drivers = feeds.feed(spark, sf_dir, "drivers").withColumn(SOURCE_FILE, named)
    feeds.write_csv_feed(drivers, f"{bronze}/drivers")
    silver = pipeline.load_silver(spark, bronze, out, AS_OF, resume=True)
    Q.require_checkpoint(spark, silver)
    pipeline.load_warehouse(spark, silver, out, AS_OF, resume=True)
    loads = versions.current(spark, f"{out}/silver/trips").number
    return versions.read_version(spark, f"{out}/warehouse/t_trips").withColumn("silver_loads", F.lit(loads))


def driver_safety_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-month driver view over trips stored by month, of which it reads three at most."""
    fleet = T.fleet(spark, sf_dir)
    path = shared_dir(spark, "trips-by-month")
    facts.store_by_month(fleet.trips, path, "end_drive")
    stored = dataclasses.replace(fleet, trips=facts.read_by_month(spark, path))
    return safety.v_driver_safety_score_monthly(stored, AS_OF)


def stream_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extracts of ``stream_bronze_silver``, corrections first, and both brought a second time."""
    first, second = _extracts(spark, sf_dir)
    landing, changed = shared_dir(spark, "landing"), shared_dir(spark, "changed")
    for extract in (second, first, first, second):
        feeds.write_csv_feed(extract, landing)
        newest.ingest_newest(
            stream_bronze(spark, landing, BRONZE["events"]),
            lambda batch: S.clean_events(batch, AS_OF),
            ["event_id"], S.NEWEST, changed, f"{landing}-progress",
        )
    return newest.read_newest(spark, changed, ["event_id"], S.NEWEST).select(*STREAM_COLUMNS)


def _registry() -> dict[str, Query]:
    silver = {
        "src_csv_bronze": src_csv_bronze,
        "bronze_quarantine": bronze_quarantine,
        "route_landing": route,
        "sink_roundtrip": sink_roundtrip,
        "retain_latest": retain_latest,
        "date_inventory": date_inventory,
        "norm_fill": norm_fill,
        "norm_null": norm_null,
        "norm_trim": norm_trim,
        "cast_ids": _parsed(RAW_ID, P.to_long, "id"),
        "safe_double": _parsed(RAW_NUMBER, P.to_double, "number"),
        "safe_bigint": _parsed(RAW_NUMBER, P.to_truncated_long, "number"),
        "parse_ts_multi": _parsed(RAW_TIME, P.parse_time, "ts"),
        "parse_ts_br": _parsed(RAW_TIME, lambda c: P.parse_time(c, TRIP_TIME_FORMATS), "ts"),
        "file_date_fallback": _parsed(RAW_FILE, lambda c: P.file_date(c, "padded", AS_OF), "day"),
        "file_date_loose": _parsed(RAW_FILE, lambda c: P.file_date(c, "loose"), "day"),
        "file_date_any": _parsed(RAW_FILE, lambda c: P.file_date(c, "any_sep"), "day"),
        "dedup_latest": dedup_latest,
        "dedup_events": dedup_events,
        "dedup_trips": dedup_trips,
        "drivers_official_date": drivers_official_date,
        "trips_incremental": trips_incremental,
        "silver_trips_incremental": silver_trips_incremental,
        "append_indexed": append_indexed,
        "publish_versions": publish_versions,
        "refresh_incremental": refresh_incremental,
        "silver_events_by_date": silver_events_by_date,
        "conform_drivers": conform_drivers,
        "conform_groups": conform_groups,
        "conform_schemes": conform_schemes,
        "conform_vehicles": conform_vehicles,
        "conform_events": conform_events,
        "conform_trips": conform_trips,
        "dq_checkpoint": dq_checkpoint,
        "dq_primary_key": dq_primary_key,
        "dq_foreign_key": dq_foreign_key,
        "dq_null_partition": dq_null_partition,
        "stream_bronze_silver": stream_bronze_silver,
        "stream_newest": stream_newest,
        "run_resumed": run_resumed,
        "driver_safety_by_month": driver_safety_by_month,
    }
    operators = {
        "join_events_trips": join_events_trips,
        "join_star_inner": _star("inner"),
        "join_star_left": _star("left"),
        "join_contains": join_contains,
        "dim_dedup": dim_dedup,
        "agg_sum_coalesce": agg_sum_coalesce,
        "agg_count": agg_count,
        "agg_conditional": agg_conditional,
        "agg_ratio": agg_ratio,
        "agg_weighted": agg_weighted,
        "agg_monthly": agg_monthly,
        "safety_points": safety_points,
        "previous_period": previous_period,
        "latest_period": latest_period,
        "topk_per_group": topk_per_group,
        "unpivot_offenders": unpivot_offenders,
        "fold_text": fold_text,
        "match_key": match_key,
        "classify_errors": classify_errors,
        "trend_label": trend_label,
    }
    marts = {name: _mart(name) for name in MARTS}
    marts["mv_driver_contribution_all"] = driver_contribution_all
    return {**silver, **operators, **marts}


# built once: the queries made by closures stay the same objects
REGISTRY = _registry()


def queries() -> dict[str, Query]:
    """All queries by name."""
    return dict(REGISTRY)
