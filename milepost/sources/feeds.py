"""Raw text feeds derived from the supplied tables, one row per source row.

Each feed is a source table and one expression per column. The expressions are plain
enough to mean the same in any SQL engine, so a check can derive the very same text.
Columns arrive as untidy as real extracts: padded, with null words, decimal commas,
mixed timestamp formats and mixed file names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from milepost.constants import SAFETY_COUNTERS
from milepost.session import compiled_methods, files_at_once
from milepost.sources.bronze import SOURCE_FILE
from milepost.sources.projection import table

FILES_AT_ONCE = 128


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _two(expression: str) -> str:
    return f"lpad({_text(expression)}, 2, '0')"


def _iso(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS STRING)"


def _brazilian(column: str) -> str:
    day = _iso(column)
    return f"concat(substring({day}, 9, 2), '/', substring({day}, 6, 2), '/', substring({day}, 1, 4))"


def _clock(key: str) -> str:
    return f"concat({_two(key + ' % 24')}, ':', {_two(key + ' % 60')}, ':', {_two(key + ' % 59')})"


def _comma(number: str) -> str:
    return f"replace({_text(f'CAST({number} AS DECIMAL(18,2))')}, '.', ',')"


def messy_time(column: str, key: str) -> str:
    """A time in one of five formats, unreadable or missing."""
    day, clock = _iso(column), _clock(key)
    return (
        f"CASE {key} % 7 WHEN 0 THEN concat({day}, ' ', {clock}, '.125') "
        f"WHEN 1 THEN concat({day}, ' ', {clock}) "
        f"WHEN 2 THEN concat({_brazilian(column)}, ' ', {clock}) "
        f"WHEN 3 THEN concat({day}, 'T', {clock}) "
        f"WHEN 4 THEN concat({day}, 'T', {clock}, 'Z') "
        f"WHEN 5 THEN 'no time' ELSE NULL END"
    )


def messy_file(column: str, key: str, name: str) -> str:
    """A file name with a padded, unpadded, dashed or missing date."""
    day = _iso(column)
    year, month, dom = (f"substring({day}, {a}, {n})" for a, n in ((1, 4), (6, 2), (9, 2)))
    short = f"CAST(CAST({month} AS INT) AS STRING), '_', CAST(CAST({dom} AS INT) AS STRING)"
    return (
        f"CASE {key} % 4 WHEN 0 THEN concat('export_', {year}, '_', {month}, '_', {dom}, '_{name}.csv') "
        f"WHEN 1 THEN concat('export_', {year}, '_', {short}, '_{name}.csv') "
        f"WHEN 2 THEN concat('export_', {day}, '_{name}.csv') "
        f"ELSE 'export_{name}.csv' END"
    )


def _month_file(column: str, name: str) -> str:
    day = _iso(column)
    return f"concat('export_', substring({day}, 1, 4), '_', substring({day}, 6, 2), '_01_{name}.csv')"


def messy_id(key: str) -> str:
    """An id as text: plain, padded, with a decimal tail, or unreadable."""
    text = _text(key)
    return (
        f"CASE {key} % 6 WHEN 0 THEN {text} WHEN 1 THEN concat('  ', {text}, ' ') "
        f"WHEN 2 THEN concat({text}, '.75') WHEN 3 THEN 'sem dado' WHEN 4 THEN '' "
        f"ELSE concat('x', {text}) END"
    )


def messy_number(number: str, key: str) -> str:
    """A number with a decimal comma or point, with two separators, unreadable or missing."""
    return (
        f"CASE {key} % 5 WHEN 0 THEN {_comma(number)} "
        f"WHEN 1 THEN {_text(f'CAST({number} AS DECIMAL(18,2))')} "
        f"WHEN 2 THEN '1.234,5' WHEN 3 THEN 'abc' ELSE NULL END"
    )


def messy_word(key: str, otherwise: str) -> str:
    """A text that is often a null word, empty or blank."""
    return (
        f"CASE {key} % 11 WHEN 0 THEN '  NULL ' WHEN 1 THEN 'n/a' WHEN 2 THEN ' - ' "
        f"WHEN 3 THEN ' NaN' WHEN 4 THEN '' WHEN 5 THEN '   ' WHEN 6 THEN 'none' "
        f"WHEN 7 THEN NULL WHEN 8 THEN ' na ' ELSE concat(' ', {otherwise}, '  x ') END"
    )


FEEDS: dict[str, tuple[str, dict[str, str]]] = {
    "drivers": ("customer", {
        "driver_id": _text("c_custkey"),
        "driver_name": "concat('  ', c_name, ' ')",
        "group_id": _text("c_nationkey"),
        "driver_code": messy_word("c_custkey", "c_mktsegment"),
        "worker_id": messy_id("c_custkey"),
        SOURCE_FILE: "concat('export_2001_', CAST(1 + c_custkey % 9 AS STRING), '_15_drivers.csv')",
    }),
    "groups": ("nation", {
        "group_id": _text("n_nationkey"),
        "group_name": "concat(n_name, '  ')",
        "parent_group_id": _text("n_regionkey"),
        "parent_group_name": messy_word("n_nationkey", "n_name"),
        "client_id": messy_id("n_nationkey"),
        "external_id": messy_word("n_nationkey", "n_name"),
        SOURCE_FILE: "'export_2001_7_2_group.csv'",
    }),
    "schemes": ("part", {
        "scheme_id": _text("p_partkey"),
        "scheme_description": messy_word("p_partkey", "repeat(concat(p_name, ' '), 70)"),
        "description": "repeat(concat(p_type, p_brand), 40)",
        "parent_scheme": messy_word("p_partkey", "p_brand"),
        "scheme_type": "p_type",
        SOURCE_FILE: "concat('export_2001_0', CAST(1 + p_partkey % 9 AS STRING), '_02_schemes.csv')",
    }),
    "vehicles": ("supplier", {
        "vehicle_id": _text("s_suppkey"),
        "license_number": "s_name",
        "group_id": messy_id("s_suppkey"),
        "manufacturer": messy_word("s_suppkey", "s_name"),
        "model": _text("s_nationkey"),
        "unit_serial_number": messy_id("s_suppkey + 3"),
        "vin": messy_word("s_suppkey + 5", "s_name"),
        "vehicle_engine_type": "CASE s_suppkey % 3 WHEN 0 THEN 'diesel' WHEN 1 THEN 'n/a' ELSE 'flex' END",
        "body_configuration": "'truck'",
        SOURCE_FILE: "concat('export_2001_0', CAST(1 + s_suppkey % 9 AS STRING), '_02_vehicles.csv')",
    }),
    "events": ("lineitem", {
        "event_id": _text("l_orderkey * 8 + l_linenumber"),
        "vehicle_id": messy_id("l_suppkey"),
        "scheme_id": _text("l_partkey"),
        "drive_id": _text("l_orderkey"),
        "start_time": messy_time("l_shipdate", "l_orderkey"),
        "start_location": messy_word("l_orderkey", "l_returnflag"),
        "start_latitude": _text("CAST(l_discount AS DECIMAL(18,2))"),
        "start_longitude": _text("CAST(l_tax AS DECIMAL(18,2))"),
        "direction": _text("CAST(l_quantity AS DECIMAL(18,2))"),
        "start_mileage": messy_number("l_extendedprice", "l_orderkey"),
        "end_time": messy_time("l_shipdate", "l_partkey"),
        "end_location": "l_linestatus",
        "end_latitude": _text("CAST(l_tax AS DECIMAL(18,2))"),
        "end_longitude": _text("CAST(l_discount AS DECIMAL(18,2))"),
        "end_mileage": messy_number("l_extendedprice", "l_partkey"),
        "speed": messy_number("l_quantity", "l_partkey + 2"),
        "max_speed": _text("l_linenumber"),
        SOURCE_FILE: _month_file("l_shipdate", "events"),
    }),
    "trips": ("orders", {
        "drive_id": messy_id("o_orderkey"),
        "vehicle_id": _text("o_orderkey % 97"),
        "driver_id": _text("o_custkey"),
        "start_drive": f"concat({_brazilian('o_orderdate')}, ' ', {_clock('o_orderkey')})",
        "start_location": messy_word("o_orderkey", "o_orderpriority"),
        "start_latitude": messy_number("o_totalprice", "o_orderkey"),
        "start_longitude": messy_number("o_totalprice", "o_orderkey + 1"),
        "end_drive": messy_time("o_orderdate", "o_orderkey"),
        "end_location": "o_orderstatus",
        "end_latitude": messy_number("o_totalprice", "o_orderkey + 2"),
        "end_longitude": messy_number("o_totalprice", "o_orderkey + 3"),
        "drive_duration": _text("o_orderkey % 5000"),
        "idle_duration": _text("o_orderkey % 600"),
        "mileage": messy_number("o_totalprice", "o_orderkey"),
        "avg_speed": messy_number("o_totalprice", "o_custkey"),
        **{
            name: messy_number(f"(o_orderkey % {3 + i}) + 0.9", f"o_orderkey + {i}")
            for i, name in enumerate(SAFETY_COUNTERS)
        },
        "energy_consumption": _comma("(o_orderkey % 40) + 0.75"),
        "breaking_system": _text("o_orderkey % 4"),
        "gearbox": _text("o_orderkey % 13"),
        "engine": messy_word("o_orderkey", "o_orderstatus"),
        "clutch_system": "concat(CAST(o_orderkey % 7 AS STRING), '.25')",
        "start_energy_level": messy_number("o_totalprice", "o_orderkey"),
        "end_energy_level": messy_number("o_totalprice", "o_orderkey + 1"),
        "energy_used": messy_number("o_totalprice", "o_orderkey + 2"),
        "start_soc": _text("o_orderkey % 100"),
        "end_soc": _text("o_orderkey % 90"),
        SOURCE_FILE: _month_file("o_orderdate", "trips"),
    }),
}


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw feed with its source file, all columns text."""
    source, columns = FEEDS[name]
    rows = table(spark, sf_dir, source)
    # a date is in many texts of a row, in most of them several times: its own text is made once
    days = {_iso(c): f"_day_{c}" for c in rows.columns if any(_iso(c) in e for e in columns.values())}
    made = rows.selectExpr("*", *[f"{e} AS {day}" for e, day in days.items()])
    for e, day in days.items():
        columns = {c: text.replace(e, day) for c, text in columns.items()}
    return made.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def feed_sql(name: str) -> str:
    """The same feed as a SELECT over the source table."""
    source, columns = FEEDS[name]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source}"


def write_csv_feed(df: DataFrame, path: str, gather: bool = True) -> None:
    """Write a feed as headered and packed CSV, one folder per source file name.

    Unless the rows of a file are to be gathered first, each task writes its own part of every
    file: the texts, far wider than what they are made of, are then not shuffled.
    """
    named = df.withColumnRenamed(SOURCE_FILE, "file")
    writer = (
        (named.hint("rebalance", "file") if gather else named)
        .write.mode("append")
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .partitionBy("file")
    )
    with compiled_methods(df.sparkSession):
        if gather:
            return writer.csv(path)
        with files_at_once(df.sparkSession, FILES_AT_ONCE):
            writer.csv(path)
