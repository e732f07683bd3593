"""Fleet tables derived from order-management tables.

The supplied tables know nothing of vehicles, so they are read as a fleet: an order is
a trip, an order line an event, a customer a driver, a supplier a vehicle, a part an
event scheme, a nation a group. Whole tables are mapped; odd values (unknown drivers,
missing dates, repeated event ids) are spread over them on purpose.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.schemas import Fleet

AS_OF = dt.date(2001, 7, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _pick(number: Column, *values) -> Column:
    """Value by position; numbers beyond the list give NULL."""
    return F.element_at(
        F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int")
    )


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").cast("bigint").alias("group_id"),
        F.col("n_name").alias("group_name"),
        F.col("n_regionkey").cast("bigint").alias("parent_group_id"),
        F.col("r_name").alias("parent_group_name"),
        F.lit(1).cast("bigint").alias("client_id"),
        F.lit(None).cast("string").alias("external_id"),
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("driver_id"),
        F.col("c_name").alias("driver_name"),
        F.col("c_nationkey").cast("bigint").alias("group_id"),
        F.col("c_mktsegment").alias("driver_code"),
        F.col("c_custkey").alias("worker_id"),
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        key.alias("vehicle_id"),
        F.col("s_name").alias("license_number"),
        _unless(key % 17 == 3, F.col("s_nationkey").cast("bigint")).alias("group_id"),
        _pick(key, "diesel", "Elétrico", "cng", "flex", None).alias("vehicle_engine_type"),
    )


def schemes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("scheme_id"),
        _pick(
            key, "Aceleração Brusca", "CURVA brusca", "Freada Brusca", "PósChave desligado",
            "Fadiga", "Overspeed", "Banguela", "PedalDeFreio", "ABS acionado", "FreioDeMão",
            None, "Pedal de freio longo",
        ).alias("scheme_description"),
        _pick(
            key, "Pedal de embreagem", "Accelerator PEDAL", "Pedal de freio", "Curva Brusca"
        ).alias("description"),
        _pick(
            key, "Engine", "Braking", "ABS", "Gearbox", "Clutch", "Electrical", None
        ).alias("parent_scheme"),
        _pick(F.col("p_size"), "Safety", "Economy", "Other").alias("scheme_type"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, start = F.col("o_orderkey"), F.col("o_orderdate")
    fleet_size = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    hours = F.make_dt_interval(hours=(key % 72).cast("int"))

    def counter(modulus: int) -> Column:
        return (key % modulus).cast("int")

    nothing = F.lit(0)
    return table(spark, sf_dir, "orders").select(
        key.alias("drive_id"),
        (key % fleet_size).alias("vehicle_id"),
        F.when(key % 89 == 3, -1 - F.col("o_custkey"))
        .when(key % 97 != 9, F.col("o_custkey"))
        .alias("driver_id"),
        _unless(key % 101 == 5, start).alias("start_drive"),
        _unless(key % 103 == 8, start + hours).alias("end_drive"),
        _unless(key % 23 == 4, F.col("o_totalprice").cast("decimal(18,2)")).alias("mileage"),
        _unless(key % 29 == 6, (key % 400).cast("decimal(18,2)")).alias("energy_used"),
        counter(3).alias("turn1"),
        counter(5).alias("turn2"),
        _unless(key % 7 == 0, F.lit(1)).alias("turn3"),
        counter(2).alias("break1"),
        nothing.alias("break2"),
        nothing.alias("break3"),
        counter(4).alias("acceleration1"),
        nothing.alias("acceleration2"),
        counter(6).alias("acceleration3"),
        nothing.alias("speed_road1"),
        nothing.alias("speed_road2"),
        counter(9).alias("speed_road3"),
        counter(11).alias("engine"),
        counter(13).alias("gearbox"),
        counter(600).alias("idle_duration"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, vehicle = F.col("l_linenumber"), F.col("l_suppkey")
    thinned = ((vehicle % 10 == 3) & (line > 1)) | ((vehicle % 10 == 7) & (line > 3))
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + line).alias("event_id"),
        _unless(thinned, vehicle).alias("vehicle_id"),
        F.col("l_partkey").alias("scheme_id"),
        F.col("l_orderkey").alias("drive_id"),
        F.col("l_shipdate").alias("start_time"),
    )


# Sample rows of the hand-kept tables. Two of the ten driving errors are missing from
# the dictionary on purpose, and parameter labels overlap so that one text matches several.
DICTIONARY_ROWS = (
    ("Aceleração Brusca", "Safety", "a1", 5.0),
    ("Curva Brusca", "Safety", "a2", 4.0),
    ("Freada Brusca", "Safety", "a3", 4.0),
    ("Fadiga", "Safety", "a4", 8.0),
    ("Excesso de velocidade em pista seca", "Safety", "a5", 7.0),
    ("Dirigir na banguela", "Economy", "a6", 3.0),
    ("ABS acionado", "Vehicle", "a7", 2.0),
    ("Dirigir com pós-chave desligado", "Safety", "a8", 6.0),
)
PARAMETER_ROWS = (
    ("Falha na embreagem", "Vehicle", 3, "b1"),
    ("Uso excessivo de potência", "Economy", 2, "b2"),
    ("Curva Brusca", "Safety", 4, "b3"),
    ("Aceleração", "Safety", 5, "b4"),
    ("Brusca", "Safety", 1, "b5"),
    ("Fadiga", "Safety", 8, "b6"),
)


def dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        DICTIONARY_ROWS,
        "parametro string, categoria string, acao_recomendada_final string, peso_impacto double",
    )


def parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample parameters plus one per part, so that the table grows with the data."""
    sample = spark.createDataFrame(
        PARAMETER_ROWS,
        "parametro string, categoria string, peso_impacto int, acao_recomendada_final string",
    )
    derived = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("parametro"),
        F.col("p_type").alias("categoria"),
        F.col("p_size").alias("peso_impacto"),
        F.col("p_brand").alias("acao_recomendada_final"),
    )
    return sample.unionByName(derived)


def fleet(spark: SparkSession, sf_dir: str) -> Fleet:
    return Fleet(
        trips=trips(spark, sf_dir),
        events=events(spark, sf_dir),
        drivers=drivers(spark, sf_dir),
        groups=groups(spark, sf_dir),
        vehicles=vehicles(spark, sf_dir),
        schemes=schemes(spark, sf_dir),
        event_dictionary=dictionary(spark),
        parameters=parameters(spark, sf_dir),
    )
