"""Properties of the physical plans."""

import dataclasses
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from milepost.functions.text import pedal_issue
from milepost.operators.dedup import latest_per_key
from milepost.operators.rollups import event_rollup
from milepost.operators.windows import top_rows
from milepost.plans.marts import MARTS
from milepost.session import write_once
from milepost.sources.projection import AS_OF
from tests.conftest import rows

QUERIES = entry.queries()


def plan(df, mode="simple"):
    explained = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))
    return explained


@pytest.mark.parametrize("name", MARTS)
def test_no_cross_join_and_no_python(fleet, name):
    text = plan(MARTS[name](fleet, AS_OF))
    for node in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval", "MapInPandas"):
        assert node not in text, node


@pytest.mark.parametrize("name", MARTS)
def test_no_window_over_a_whole_frame(fleet, name):
    """The slice counts of a row number are the only frame numbered in one piece."""
    text = plan(MARTS[name](fleet, AS_OF))
    for window in re.findall(r"Window \[.*", text):
        if "_before" not in window and "_total" not in window and "sum(_rows" not in window:
            assert re.search(r"\], \[[^\]]+\], \[", window), window


def test_group_limit_before_the_shuffle(fleet):
    for df in (
        latest_per_key(fleet.events, ["drive_id"], ["start_time"]),
        latest_per_key(fleet.events, ["drive_id"], ["start_time"], "keep"),
        top_rows(fleet.trips, ["vehicle_id"], [F.col("mileage").desc(), F.col("drive_id")], 5),
    ):
        text = plan(df)
        assert re.search(r"Final\n.*Sort.*\n.*Exchange.*\n.*WindowGroupLimit.*Partial", text), text


def test_scans_read_only_what_they_need(fleet):
    text = plan(MARTS["v_driver_event_parameters"](fleet, AS_OF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sorted(schemas) == [
        "c_custkey:bigint,c_name:string", "l_orderkey:bigint", "o_orderkey:bigint,o_custkey:bigint"]


def test_filters_reach_the_scan(spark, fleet, tmp_path):
    import dataclasses

    path = str(tmp_path / "trips")
    fleet.trips.write.parquet(path)
    stored = dataclasses.replace(fleet, trips=spark.read.parquet(path))
    from milepost.plans.safety import driver_safety_months, mv_group_safety_base

    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(end_drive",
                     plan(driver_safety_months(stored, AS_OF)))
    assert "IsNotNull(end_drive)" in plan(mv_group_safety_base(stored))


def test_facts_shrink_before_dimensions_join(fleet):
    """The vehicle join sits above the aggregate of the trips."""
    text = plan(MARTS["mv_group_safety_base"](fleet, AS_OF))
    join = text.index("LeftOuter")
    assert text.index("partial_sum", join) > join


@pytest.mark.parametrize("name", ["mv_driver_errors", "mv_pedal_events", "mv_safety_offenders"])
def test_labels_do_not_travel_with_the_facts(fleet, name):
    """Only ids and months cross the shuffle by drive id."""
    conf = fleet.trips.sparkSession.conf
    conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(MARTS[name](fleet, AS_OF), "formatted")
    finally:
        conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\nArguments: hashpartitioning\((\w+)#", text)
    by_drive = [columns for columns, key in exchanges if key in ("drive_id", "l_orderkey", "o_orderkey")]
    assert by_drive
    for columns in by_drive:
        assert not re.search("ofensor|categoria|acao|parametro|description", columns), columns


def test_pedal_events_are_counted_by_numbers(fleet):
    """What is counted has no text: names and labels would fill the memory of a task."""
    text = plan(MARTS["mv_pedal_events"](fleet, AS_OF), "formatted")
    keys = [k for k in re.findall(r"Keys \[\d+\]: \[(.*?)\]", text) if "event_month" in k]
    assert keys
    for columns in keys:
        assert not re.search("driver_name|group_name|parametro|categoria|acao", columns), columns


def test_pedal_events_count_what_dimensions_repeat(spark, fleet):
    """Repeated rows of dimensions count as often as a join of them does."""
    def also(df, column, value):
        some = df.limit(60).withColumn(column, value.cast(df.schema[column].dataType))
        return write_once(df.unionByName(df.limit(40)).unionByName(some), "repeated")

    text = F.lit(None)
    known = fleet.parameters.filter(F.col("parametro").isin("Falha na embreagem"))
    many = dataclasses.replace(
        fleet,
        drivers=also(fleet.drivers, "driver_name", text),
        vehicles=also(fleet.vehicles, "group_id", text),
        groups=also(fleet.groups, "group_name", F.lit("same")).unionByName(fleet.groups.limit(2).withColumn("group_name", text.cast("string"))),
        schemes=also(fleet.schemes, "description", F.lit("some pedal")),
        parameters=also(fleet.parameters, "parametro", text).unionByName(known).unionByName(known.withColumn("peso_impacto", F.lit(9))),
    )
    pedal = many.schemes.filter(F.lower("description").contains("pedal")).select("scheme_id", pedal_issue(F.col("description")).alias("parametro"))
    joined = (
        many.events.select("drive_id", "vehicle_id", "scheme_id", "start_time").filter("vehicle_id IS NOT NULL")
        .join(many.trips.select("drive_id", "driver_id"), "drive_id")
        .join(pedal, "scheme_id").join(many.parameters, "parametro", "left")
        .join(many.vehicles.select("vehicle_id", "group_id"), "vehicle_id")
        .join(many.groups.select("group_id", "group_name"), "group_id", "left")
        .join(many.drivers.select("driver_id", "driver_name"), "driver_id")
    )
    keys = ["driver_id", "driver_name", "group_name", "parametro", "categoria", "peso_impacto", "acao_recomendada_final"]
    wanted = joined.groupBy(*keys, F.year("start_time").alias("year"), F.month("start_time").alias("month")).agg(F.count(F.lit(1)).alias("qtd_eventos"))
    for given in (many, dataclasses.replace(many, event_rollup=event_rollup(many))):
        found = MARTS["mv_pedal_events"](given, AS_OF)
        assert rows(found.drop("impacto_total")) == rows(wanted)
