"""The expected result of each query as plain SQL over the supplied tables.

Written independently of the Spark plans: facts are joined row by row and nothing is
rolled up first. Only fixed values and the raw feeds are shared.
"""

from __future__ import annotations

import textwrap

from milepost import constants as K
from milepost.checks.queries import (
    AS_OF,
    EXPORT_PREFIX,
    LANDED,
    RAW_FILE,
    RAW_ID,
    RAW_NUMBER,
    RAW_TIME,
    SECOND_LOAD,
    STREAMED,
)
from milepost.sources import feeds
from milepost.sources.projection import DICTIONARY_ROWS, PARAMETER_ROWS

# --- the fleet tables -------------------------------------------------------------------


def _values(rows) -> str:
    def literal(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def _choose(key: str, *values) -> str:
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)
    )
    return f"CASE {key} % {len(values)} {arms} END"


FLEET = {
    "d_groups": """
        SELECT CAST(n_nationkey AS BIGINT) AS group_id, n_name AS group_name
        FROM nation""",
    "d_drivers": """
        SELECT c_custkey AS driver_id, c_name AS driver_name,
               CAST(c_nationkey AS BIGINT) AS group_id, c_mktsegment AS driver_code,
               c_custkey AS worker_id
        FROM customer""",
    "d_vehicles": f"""
        SELECT s_suppkey AS vehicle_id, s_name AS license_number,
               CASE WHEN s_suppkey % 17 <> 3 THEN CAST(s_nationkey AS BIGINT) END AS group_id,
               {_choose('s_suppkey', 'diesel', 'Elétrico', 'cng', 'flex', None)} AS vehicle_engine_type
        FROM supplier""",
    "d_schemes": f"""
        SELECT p_partkey AS scheme_id,
               {_choose('p_partkey', 'Aceleração Brusca', 'CURVA brusca', 'Freada Brusca',
                        'PósChave desligado', 'Fadiga', 'Overspeed', 'Banguela', 'PedalDeFreio',
                        'ABS acionado', 'FreioDeMão', None, 'Pedal de freio longo')} AS scheme_description,
               {_choose('p_partkey', 'Pedal de embreagem', 'Accelerator PEDAL', 'Pedal de freio',
                        'Curva Brusca')} AS description,
               {_choose('p_partkey', 'Engine', 'Braking', 'ABS', 'Gearbox', 'Clutch', 'Electrical',
                        None)} AS parent_scheme,
               {_choose('p_size', 'Safety', 'Economy', 'Other')} AS scheme_type
        FROM part""",
    "t_trips": """
        SELECT o_orderkey AS drive_id, o_orderkey % (SELECT count(*) FROM supplier) AS vehicle_id,
               CASE WHEN o_orderkey % 89 = 3 THEN -1 - o_custkey
                    WHEN o_orderkey % 97 <> 9 THEN o_custkey END AS driver_id,
               CASE WHEN o_orderkey % 101 <> 5 THEN o_orderdate END AS start_drive,
               CASE WHEN o_orderkey % 103 <> 8
                    THEN o_orderdate + (o_orderkey % 72) * INTERVAL '1' HOUR END AS end_drive,
               CASE WHEN o_orderkey % 23 <> 4 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS mileage,
               CASE WHEN o_orderkey % 29 <> 6
                    THEN CAST(o_orderkey % 400 AS DECIMAL(18,2)) END AS energy_used,
               o_orderkey % 3 + o_orderkey % 5 + CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1 END
                 + o_orderkey % 2 + o_orderkey % 4 + o_orderkey % 6 + o_orderkey % 9 AS points,
               o_orderkey % 11 AS engine, o_orderkey % 9 AS speed_road3,
               o_orderkey % 6 AS acceleration3, o_orderkey % 600 AS idle_duration,
               o_orderkey % 13 AS gearbox
        FROM orders""",
    "t_events": """
        SELECT l_orderkey * 8 + l_linenumber AS event_id,
               CASE WHEN (l_suppkey % 10 = 3 AND l_linenumber > 1)
                      OR (l_suppkey % 10 = 7 AND l_linenumber > 3) THEN NULL
                    ELSE l_suppkey END AS vehicle_id,
               l_partkey AS scheme_id, l_orderkey AS drive_id, l_shipdate AS start_time
        FROM lineitem""",
    "d_event_dictionary": f"""
        SELECT * FROM (VALUES {_values(DICTIONARY_ROWS)})
          AS v(parametro, categoria, acao, peso)""",
    "parametro_base": f"""
        SELECT * FROM (VALUES {_values(PARAMETER_ROWS)}) AS v(parametro, categoria, peso, acao)
        UNION ALL SELECT p_name, p_type, p_size, p_brand FROM part""",
}


def _sql(body: str, *tables: str, **extra: str) -> str:
    """A query over the named fleet tables and extra sub-queries."""
    parts = {**{t: FLEET[t] for t in tables}, **extra}
    body = textwrap.dedent(body).strip()
    if not parts:
        return body
    with_ = ",\n".join(f"{name} AS MATERIALIZED ({textwrap.dedent(q).strip()})" for name, q in parts.items())
    return f"WITH {with_}\n{body}"


# --- shared expressions ---------------------------------------------------------------


def _month(ts: str) -> str:
    return f"CAST(date_trunc('month', {ts}) AS DATE)"


def _int(expression: str) -> str:
    return f"CAST({expression} AS INTEGER)"


def _big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _dbl(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def _period(ts: str) -> str:
    return f"{_int(f'year({ts})')} AS year, {_int(f'month({ts})')} AS month"


def _fold(text: str) -> str:
    return f"lower(translate({text}, '{K.ACCENTED}', '{K.UNACCENTED}'))"


def _key(text: str) -> str:
    return f"regexp_replace({_fold(text)}, '[^a-z0-9]+', '', 'g')"


def _labels(text: str, rules, otherwise: str | None = None) -> str:
    arms = " ".join(
        "WHEN " + " OR ".join(f"{text} LIKE '%{f}%'" for f in fragments) + f" THEN '{label}'"
        for fragments, label in rules
    )
    return f"CASE {arms}" + (f" ELSE '{otherwise}'" if otherwise else "") + " END"


def _squeeze(text: str, fill: str) -> str:
    tidy = f"trim(regexp_replace({text}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), ' ')"
    return f"CASE WHEN {tidy} = '' OR lower({tidy}) IN {K.NULL_TOKENS} OR {text} IS NULL THEN {fill} ELSE {tidy} END"


FILL = f"'{K.MISSING_TEXT}'"


def _trim(text: str) -> str:
    return f"CASE WHEN trim({text}, ' ') IN {K.NULL_TOKENS} THEN NULL ELSE trim({text}, ' ') END"


def _long(text: str) -> str:
    return f"TRY_CAST(regexp_replace(trim({text}, ' '), '^([+-]?[0-9]+)\\.[0-9]*$', '\\1') AS BIGINT)"


def _double(text: str) -> str:
    return f"TRY_CAST(replace({text}, ',', '.') AS DOUBLE)"


def _trunc_long(text: str) -> str:
    return _big(f"trunc({_double(text)})")


EVENT_FORMATS = (
    "['%Y-%m-%d %H:%M:%S.%g', '%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M:%S', "
    "'%Y-%m-%dT%H:%M:%S', '%Y-%m-%dT%H:%M:%SZ']"
)


def _event_time(text: str) -> str:
    return f"try_strptime({text}, {EVENT_FORMATS})"


def _trip_time(text: str) -> str:
    return f"try_strptime({text}, '%d/%m/%Y %H:%M:%S')"


def _file_day(text: str, pattern: str) -> str:
    found = f"replace(regexp_extract({text}, '{pattern}', 1), '-', '_')"
    return f"CAST(try_strptime({found}, '%Y_%m_%d') AS DATE)"


PADDED = "([0-9]{4}_[0-9]{2}_[0-9]{2})"
LOOSE = "([0-9]{4}_[0-9]{1,2}_[0-9]{1,2})"
ANY_SEP = "([0-9]{4}[_-][0-9]{1,2}[_-][0-9]{1,2})"
TODAY = f"DATE '{AS_OF}'"


def _two(value: str) -> str:
    return f"CAST(CAST(round({value}, 2) AS DECIMAL(38,2)) AS VARCHAR)"


def _message(texts: dict, none: str, better: str, worse: str, size: str, ending: str = "''") -> str:
    def sentence(kind):
        before, after = texts[kind]
        return f"'{before}' || {_two(size)} || '{after}' || {ending}"

    return (
        f"CASE WHEN {none} THEN '{texts['none']}' WHEN {better} THEN {sentence('better')} "
        f"WHEN {worse} THEN {sentence('worse')} ELSE '{texts['same']}' END"
    )


def _trend(now: str, before: str) -> str:
    t = K.TREND
    return (
        f"CASE WHEN {before} IS NULL THEN '{t['none']}' WHEN {now} < {before} THEN '{t['better']}' "
        f"WHEN {now} > {before} THEN '{t['worse']}' ELSE '{t['same']}' END"
    )


def _pct(points: str, km: str) -> str:
    return f"CASE WHEN {km} > 0 THEN {_dbl(points)} / {_dbl(km)} * 100 END"


NAMES = "SELECT driver_id, max(driver_name) AS driver_name FROM d_drivers GROUP BY driver_id"

# --- sources and silver ------------------------------------------------------------------


def _raw(raw: str, parsed: str, output: str) -> str:
    return _sql(f"SELECT o_orderkey, raw, {parsed} AS {output} FROM r",
                r=f"SELECT o_orderkey, {raw} AS raw FROM orders")


DATED = f"""
    SELECT o_orderkey AS drive_id, o_custkey AS driver_id, o_orderstatus,
           {_month('o_orderdate')} AS p_source_date FROM orders"""

EVENT_ROWS = f"""
    SELECT l_orderkey * 8 + l_linenumber AS event_id, l_orderkey, l_partkey AS scheme_id,
           l_suppkey AS vehicle_id, l_shipdate AS start_time,
           'export_' || CAST(l_partkey % 9 AS VARCHAR) || '_events.csv' AS _source_file,
           {_month('l_shipdate')} AS p_source_date
    FROM lineitem"""


def _landing() -> str:
    arms = " ".join(
        f"WHEN starts_with(path, '{EXPORT_PREFIX}{folder}/') THEN '{table}'"
        for table, folder in K.LANDING_FOLDERS.items()
    )
    return _sql(
        """
        SELECT path, "table", "table" IS NOT NULL AS accepted,
               CASE WHEN starts_with(path, 'bronze/') THEN 'already in bronze'
                    WHEN "table" IS NULL THEN 'out of scope' ELSE 'accepted' END AS reason,
               CASE WHEN "table" IS NOT NULL THEN 'bronze/' || path END AS bronze_path
        FROM k""",
        k=f'SELECT path, CASE {arms} END AS "table" FROM (SELECT {LANDED} AS path FROM orders)',
    )


def _newest(key: str, order: str, drive: str = "l_orderkey", keep_null: bool = False) -> str:
    kept = f"{key} IS NULL OR rn = 1" if keep_null else "rn = 1"
    return _sql(
        f"""
        SELECT event_id, scheme_id, vehicle_id, start_time, _source_file, drive_id, p_source_date
        FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
              FROM (SELECT *, {drive} AS drive_id FROM e)) WHERE {kept}""",
        e=EVENT_ROWS,
    )


def _conform(name: str, body: str) -> str:
    return _sql(body, r=feeds.feed_sql(name))


def _round_int(text: str) -> str:
    return f"CAST(round({text}) AS INTEGER)"


def _conform_trips() -> str:
    def nulled(c):
        return _squeeze(c, "NULL")

    counters = ", ".join(f"CAST({_trunc_long(nulled(c))} AS INTEGER) AS {c}" for c in K.SAFETY_COUNTERS)
    doubles = ", ".join(
        f"{_double(nulled(c))} AS {c}"
        for c in (
            "start_latitude", "start_longitude", "end_latitude", "end_longitude", "drive_duration",
            "idle_duration", "mileage", "avg_speed", "start_energy_level", "end_energy_level",
            "energy_used", "start_soc", "end_soc",
        )
    )
    whole = ", ".join(
        f"{_round_int(_double(nulled(c)))} AS {c}" for c in ("energy_consumption", "breaking_system")
    )
    systems = ", ".join(
        f"{_round_int(f'TRY_CAST({nulled(c)} AS DOUBLE)')} AS {c}"
        for c in ("gearbox", "engine", "clutch_system")
    )
    return _conform("trips", f"""
        SELECT {_long(nulled('drive_id'))} AS drive_id, {_long(nulled('vehicle_id'))} AS vehicle_id,
               {_long(nulled('driver_id'))} AS driver_id,
               {_trip_time(nulled('start_drive'))} AS start_drive,
               {_trip_time(nulled('end_drive'))} AS end_drive,
               {nulled('start_location')} AS start_location, {nulled('end_location')} AS end_location,
               {doubles}, {counters}, {whole}, {systems},
               {_file_day('_source_file', LOOSE)} AS p_source_date
        FROM r""")


def _conform_events() -> str:
    doubles = ", ".join(
        f"TRY_CAST({_trim(c)} AS DOUBLE) AS {c}"
        for c in ("start_latitude", "start_longitude", "direction", "end_latitude",
                  "end_longitude", "speed", "max_speed")
    )
    return _conform("events", f"""
        SELECT {', '.join(f'{_long(_trim(c))} AS {c}' for c in
                          ('event_id', 'vehicle_id', 'scheme_id', 'drive_id'))},
               {_event_time(_trim('start_time'))} AS start_time,
               {_event_time(_trim('end_time'))} AS end_time,
               {_trim('start_location')} AS start_location, {_trim('end_location')} AS end_location,
               {doubles}, {_double(_trim('start_mileage'))} AS start_mileage,
               {_double(_trim('end_mileage'))} AS end_mileage,
               coalesce({_file_day('_source_file', LOOSE)}, {TODAY}) AS p_source_date,
               {TODAY} AS p_load_date
        FROM r WHERE event_id IS NOT NULL""")


def _pk(table: str, key: str) -> str:
    return f"""
        SELECT '{table}' AS table_name, '{key}' AS key_column, {_big('count(*)')} AS rows,
               {_big(f'count(*) FILTER (WHERE {key} IS NULL)')} AS null_keys,
               (SELECT count(*) FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL
                                      GROUP BY {key} HAVING count(*) > 1)) AS duplicated_keys,
               {_big(f'count({key}) - count(DISTINCT {key})')} AS surplus_rows,
               count(*) = count({key}) AND count({key}) = count(DISTINCT {key}) AS valid
        FROM {table}"""


def _fk(table: str, key: str, ref: str, ref_key: str) -> str:
    orphan = f"FROM {table} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {ref_key} FROM {ref})"
    return f"""
        SELECT '{table}' AS table_name, '{key}' AS key_column, '{ref}' AS ref_table,
               '{ref_key}' AS ref_column, count(*) AS rows,
               count(*) - count({key}) AS null_keys,
               (SELECT count(DISTINCT {key}) {orphan}) AS orphan_keys,
               (SELECT count(*) {orphan}) AS orphan_rows,
               NOT EXISTS (SELECT 1 {orphan}) AS valid
        FROM {table}"""


def _silver() -> dict[str, str]:
    fallback = f"coalesce({_file_day('raw', PADDED)}, {TODAY})"
    driver_feed = "SELECT *, replace(_source_file, '/', '') AS source FROM r"
    streamed = ", ".join(STREAMED)
    checkpoint = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, true AS \"exists\", count(*) AS rows, "
        f"CASE WHEN count(*) = 0 THEN 'empty' ELSE 'ok' END AS status FROM {table}"
        for name, table in (
            ("drivers", "customer"), ("groups", "nation"), ("schemes", "part"),
            ("vehicles", "supplier"), ("trips", "orders"), ("events", "lineitem"),
        )
    )
    return {
        "src_csv_bronze": _sql(
            f"""
            SELECT driver_id, driver_name, group_id, nullif(driver_code, '') AS driver_code,
                   nullif(worker_id, '') AS worker_id, source,
                   {_file_day('source', ANY_SEP)} AS p_source_date
            FROM ({driver_feed})""",
            r=feeds.feed_sql("drivers"),
        ),
        "route_landing": _landing(),
        "sink_roundtrip": _sql(
            f"""
            SELECT drive_id, driver_id, p_source_date,
                   CASE WHEN p_source_date < DATE '{SECOND_LOAD}' THEN 1 ELSE 2 END AS load
            FROM d""", d=DATED),
        "retain_latest": _sql(
            "SELECT * FROM d WHERE p_source_date = (SELECT max(p_source_date) FROM d)", d=DATED),
        "date_inventory": "SELECT DISTINCT CAST(l_shipdate AS DATE) AS p_source_date FROM lineitem",
        "norm_fill": _sql(
            f"""SELECT doc_id, {_squeeze('text', FILL)} AS text, {_squeeze('lang', FILL)} AS lang,
                       {_squeeze('source', FILL)} AS source FROM r""",
            r=f"SELECT doc_id, text, lang, {feeds.messy_word('doc_id', 'source')} AS source FROM documents"),
        "norm_null": _sql(
            f"SELECT page_id, {_squeeze('html', 'NULL')} AS html, {_squeeze('url', 'NULL')} AS url FROM r",
            r=f"SELECT page_id, html, {feeds.messy_word('page_id', 'url')} AS url FROM pages"),
        "norm_trim": _sql(
            f"SELECT conv_id, turn, {_trim('text')} AS text, {_trim('role')} AS role FROM r",
            r=f"SELECT conv_id, turn, text, {feeds.messy_word('conv_id', 'role')} AS role FROM conversations"),
        "cast_ids": _raw(RAW_ID, _long("raw"), "id"),
        "safe_double": _raw(RAW_NUMBER, _double("raw"), "number"),
        "safe_bigint": _raw(RAW_NUMBER, _trunc_long("raw"), "number"),
        "parse_ts_multi": _raw(RAW_TIME, _event_time("raw"), "ts"),
        "parse_ts_br": _raw(RAW_TIME, _trip_time("raw"), "ts"),
        "file_date_fallback": _raw(RAW_FILE, fallback, "day"),
        "file_date_loose": _raw(RAW_FILE, _file_day("raw", LOOSE), "day"),
        "file_date_any": _raw(RAW_FILE, _file_day("raw", ANY_SEP), "day"),
        "dedup_latest": _newest(
            "scheme_id", "p_source_date DESC, event_id DESC, vehicle_id DESC, start_time DESC, "
            "_source_file DESC, drive_id DESC"),
        "dedup_events": _newest(
            "event_id", "p_source_date DESC, _source_file DESC, scheme_id DESC, vehicle_id DESC, "
            "start_time DESC, drive_id DESC"),
        "dedup_trips": _newest(
            "drive_id", "_source_file DESC, event_id DESC, scheme_id DESC, vehicle_id DESC, "
            "start_time DESC, p_source_date DESC",
            "CASE WHEN l_orderkey % 50 <> 7 THEN l_orderkey END", keep_null=True),
        "drivers_official_date": _sql(
            """
            SELECT DISTINCT driver_id, driver_name, group_id, driver_code, worker_id, p_source_date
            FROM d JOIN d_drivers USING (driver_id)
            WHERE p_source_date = (SELECT max(p_source_date) FROM d)""",
            "d_drivers", d=DATED),
        "trips_incremental": _sql(
            """
            SELECT drive_id, driver_id, p_source_date,
                   CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS load
            FROM d WHERE o_orderstatus = 'F' OR drive_id % 50 <> 7""", d=DATED),
        "silver_trips_incremental": _sql(
            """
            SELECT CASE WHEN drive_id % 50 <> 7 THEN drive_id END AS drive_id, driver_id, p_source_date,
                   drive_id AS feed_row
            FROM d""", d=DATED),
        "bronze_quarantine": """
            SELECT CASE WHEN reason IS NULL THEN id END AS drive_id,
                   CASE WHEN reason IS NULL THEN CASE k WHEN 5 THEN driver || ', twice' ELSE driver END END AS driver_id,
                   CASE WHEN reason IS NULL THEN o_orderstatus END AS status,
                   CASE k WHEN 1 THEN id || ',' || driver
                          WHEN 2 THEN id || ',' || driver || ',' || o_orderstatus || ',extra'
                          WHEN 3 THEN id || ',"' || driver || ',' || o_orderstatus
                          WHEN 4 THEN id || ',"' || driver || '"x,' || o_orderstatus END AS line,
                   reason
            FROM (SELECT o_orderkey % 10 AS k, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS driver,
                         o_orderstatus,
                         CASE o_orderkey % 10 WHEN 1 THEN 'too few fields' WHEN 2 THEN 'too many fields'
                                              WHEN 3 THEN 'broken quotes' WHEN 4 THEN 'broken quotes' END AS reason
                  FROM orders)""",
        "publish_versions": _sql(
            """
            SELECT drive_id, driver_id, p_source_date, 1 AS load, 'failure' AS seen FROM d
            UNION ALL
            SELECT drive_id, driver_id, p_source_date,
                   CASE WHEN p_source_date >= DATE '1998-01-01' THEN 2 ELSE 1 END, 'commit' FROM d""", d=DATED),
        "silver_events_by_date": _sql(
            """
            SELECT drive_id, driver_id, p_source_date,
                   CASE WHEN p_source_date >= DATE '1998-01-01' THEN 2 ELSE 1 END AS load
            FROM d""", d=DATED),
        "conform_drivers": _conform("drivers", f"""
            SELECT {_long('driver_id')} AS driver_id, {_squeeze('driver_name', FILL)} AS driver_name,
                   {_long('group_id')} AS group_id, {_squeeze('driver_code', FILL)} AS driver_code,
                   {_long(_squeeze('worker_id', FILL))} AS worker_id,
                   {_file_day('_source_file', ANY_SEP)} AS p_source_date FROM r"""),
        "conform_groups": _conform("groups", f"""
            SELECT {_long('group_id')} AS group_id, {_squeeze('group_name', FILL)} AS group_name,
                   {_long('parent_group_id')} AS parent_group_id,
                   {_squeeze('parent_group_name', FILL)} AS parent_group_name,
                   {_long(_squeeze('client_id', FILL))} AS client_id,
                   {_file_day('_source_file', LOOSE)} AS p_source_date,
                   {_squeeze('external_id', FILL)} AS external_id FROM r"""),
        "conform_schemes": _conform("schemes", f"""
            SELECT {_long('scheme_id')} AS scheme_id,
                   {_squeeze('scheme_description', FILL)} AS scheme_description,
                   {_squeeze('description', FILL)} AS description,
                   {_squeeze('parent_scheme', FILL)} AS parent_scheme,
                   {_squeeze('scheme_type', FILL)} AS scheme_type,
                   {TODAY} AS p_load_date,
                   {_file_day('_source_file', LOOSE)} AS p_source_date FROM r"""),
        "conform_vehicles": _conform("vehicles", f"""
            SELECT {_long('vehicle_id')} AS vehicle_id, {_squeeze('license_number', 'NULL')} AS license_number,
                   {_long(_squeeze('group_id', 'NULL'))} AS group_id,
                   {_squeeze('manufacturer', 'NULL')} AS manufacturer, model,
                   {_long(_squeeze('unit_serial_number', 'NULL'))} AS unit_serial_number,
                   {_squeeze('vin', 'NULL')} AS vin,
                   {_squeeze('vehicle_engine_type', 'NULL')} AS vehicle_engine_type,
                   body_configuration, {_file_day('_source_file', LOOSE)} AS p_source_date FROM r"""),
        "conform_events": _conform_events(),
        "conform_trips": _conform_trips(),
        "dq_checkpoint": checkpoint,
        "dq_primary_key": _sql(
            " UNION ALL ".join(_pk(*k) for k in (
                ("d_drivers", "driver_id"), ("d_groups", "group_id"), ("d_schemes", "scheme_id"),
                ("t_trips", "driver_id"), ("t_events", "event_id"))),
            "d_drivers", "d_groups", "d_schemes", "t_trips", "t_events"),
        "dq_foreign_key": _sql(
            " UNION ALL ".join(_fk(*k) for k in (
                ("t_events", "scheme_id", "d_schemes", "scheme_id"),
                ("t_trips", "driver_id", "d_drivers", "driver_id"),
                ("t_events", "vehicle_id", "d_vehicles", "vehicle_id"))),
            "t_events", "t_trips", "d_schemes", "d_drivers", "d_vehicles"),
        "dq_null_partition": _sql(
            """
            SELECT 'trips' AS table_name, count(*) AS rows,
                   count(*) - count(start_drive) AS undated_rows,
                   count(*) = count(start_drive) AS valid
            FROM t_trips""", "t_trips"),
        "stream_bronze_silver": _sql(
            f"""
            SELECT {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in
                              ('event_id', 'vehicle_id', 'scheme_id', 'drive_id'))},
                   {_event_time('start_time')} AS start_time, start_location, end_location,
                   CASE WHEN corrected THEN 20.0::DOUBLE ELSE 10.0::DOUBLE END AS speed,
                   CAST(month || CASE WHEN corrected THEN '-15' ELSE '-01' END AS DATE) AS p_source_date
            FROM s""",
            s=f"""SELECT {streamed}, events.event_id % 10 = 0 AS corrected,
                         substring(CAST(ts AS VARCHAR), 1, 7) AS month FROM events"""),
    }


# --- operators ----------------------------------------------------------------------------

PER_MONTH = f"""
    SELECT v.group_id, g.group_name, {_month('end_drive')} AS ym, sum(points) AS points,
           sum(coalesce(mileage, 0)) AS km
    FROM t_trips LEFT JOIN d_vehicles v USING (vehicle_id) LEFT JOIN d_groups g USING (group_id)
    WHERE end_drive IS NOT NULL GROUP BY ALL"""

SAFETY_MONTHS = f"""
    SELECT group_id, group_name, ym, {_big('points')} AS total_points, {_dbl('km')} AS total_km,
           {_pct('points', 'km')} AS safety_pct
    FROM per_month"""

COMPARED = """
    SELECT *, lag(safety_pct) OVER (PARTITION BY group_id ORDER BY ym) AS prev,
           max(ym) OVER (PARTITION BY group_id) = ym AS is_last
    FROM safety_months"""

MONTHS = {"per_month": PER_MONTH, "safety_months": SAFETY_MONTHS, "compared": COMPARED}
PLACES = ("t_trips", "d_vehicles", "d_groups")

DRIVER_KM = f"""
    SELECT g.group_id, {_month('end_drive')} AS ym, d.driver_id, d.driver_name,
           {_dbl('sum(coalesce(mileage, 0))')} AS total_km
    FROM t_trips t JOIN d_drivers d ON t.driver_id = d.driver_id
         JOIN d_vehicles v ON t.vehicle_id = v.vehicle_id JOIN d_groups g ON v.group_id = g.group_id
    WHERE end_drive IS NOT NULL GROUP BY ALL"""

RANKED_KM = """
    SELECT *, row_number() OVER (PARTITION BY group_id, ym
                                 ORDER BY total_km DESC, driver_id, driver_name) AS place
    FROM driver_km"""

ERRORS = f"""
    SELECT scheme_id, m.parametro, m.categoria, m.peso, m.acao
    FROM (SELECT scheme_id, {_labels(_fold("coalesce(scheme_description, '')"), K.DRIVING_ERRORS)} AS label
          FROM d_schemes) s
    JOIN d_event_dictionary m ON m.parametro = s.label"""

SCHEME_KEYS = f"""
    SELECT scheme_id, {_key("coalesce(scheme_description, description, scheme_type, '')")} AS scheme_key
    FROM d_schemes"""
PARAMETER_KEYS = f"""
    SELECT *, {_key('parametro')} AS parameter_key FROM parametro_base"""
SCHEME_PARAMETERS = """
    SELECT scheme_id, parametro AS ofensor, categoria, acao AS acao_recomendada_final
    FROM scheme_keys JOIN parameter_keys ON contains(scheme_key, parameter_key)
    WHERE parameter_key <> ''"""
KEYED = {"scheme_keys": SCHEME_KEYS, "parameter_keys": PARAMETER_KEYS}

OFFENDER_ROWS = " UNION ALL ".join(
    f"""SELECT group_id, group_name, driver_id, '{label}' AS ofensor,
               {_dbl(f'sum({column})')} AS total_events, '{advice}' AS action_recommended
        FROM placed GROUP BY ALL HAVING sum({column}) > 0"""
    for column, label, advice in K.ECONOMY_OFFENDERS
)
PLACED = """
    SELECT * FROM t_trips JOIN d_vehicles USING (vehicle_id) LEFT JOIN d_groups USING (group_id)
    WHERE group_id IS NOT NULL AND driver_id IS NOT NULL"""


def _star(kind: str) -> str:
    return _sql(
        f"""
        SELECT drive_id, vehicle_id, driver_id, group_id, vehicle_engine_type, group_name, driver_name
        FROM t_trips {kind} JOIN d_vehicles USING (vehicle_id)
             {kind} JOIN d_groups USING (group_id)
             {kind} JOIN (SELECT driver_id, driver_name FROM d_drivers) USING (driver_id)""",
        *PLACES, "d_drivers")


def _operators() -> dict[str, str]:
    return {
        "join_events_trips": _sql(
            f"""
            SELECT drive_id, e.vehicle_id, scheme_id, {_month('start_time')} AS event_month,
                   driver_id, {_month('start_drive')} AS trip_month
            FROM t_events e JOIN t_trips t USING (drive_id)""", "t_events", "t_trips"),
        "join_star_inner": _star("INNER"),
        "join_star_left": _star("LEFT"),
        "join_contains": _sql(SCHEME_PARAMETERS, "d_schemes", "parametro_base", **KEYED),
        "dim_dedup": """
            SELECT o_custkey AS driver_id, max(o_orderstatus || '/' || o_orderpriority) AS driver_name
            FROM orders GROUP BY o_custkey""",
        "agg_sum_coalesce": _sql(
            f"""
            SELECT driver_id, {_dbl('sum(coalesce(mileage, 0))')} AS total_km,
                   {_dbl('sum(coalesce(energy_used, 0))')} AS total_energy
            FROM t_trips GROUP BY driver_id""", "t_trips"),
        "agg_count": _sql(
            "SELECT vehicle_id, count(*) AS n_events FROM t_events GROUP BY vehicle_id", "t_events"),
        "agg_conditional": _sql(
            """
            SELECT vehicle_id, count(*) FILTER (WHERE scheme_type = 'Safety') AS safety_events,
                   count(*) FILTER (WHERE scheme_type = 'Economy') AS economy_events
            FROM t_events LEFT JOIN d_schemes USING (scheme_id) GROUP BY vehicle_id""",
            "t_events", "d_schemes"),
        "agg_ratio": _sql(
            f"""
            SELECT driver_id, CASE WHEN sum(energy_used) > 0
                              THEN {_dbl('sum(mileage)')} / {_dbl('sum(energy_used)')} END AS km_per_energy
            FROM t_trips GROUP BY driver_id""", "t_trips"),
        "agg_weighted": _sql(
            """
            SELECT driver_id, parametro, peso AS peso_impacto_final, count(*) AS n,
                   count(*) * peso AS score
            FROM t_events JOIN t_trips USING (drive_id) JOIN errors USING (scheme_id)
            GROUP BY driver_id, parametro, peso""",
            "t_events", "t_trips", "d_schemes", "d_event_dictionary", errors=ERRORS),
        "agg_monthly": f"""
            SELECT {_month('ts')} AS ym, {_period('any_value(ts)')}, event_type, count(*) AS n,
                   {_dbl('sum(CAST(value AS DECIMAL(18,2)))')} AS total
            FROM events GROUP BY {_month('ts')}, event_type""",
        "safety_points": _sql("SELECT drive_id, points FROM t_trips", "t_trips"),
        "previous_period": _sql(
            "SELECT group_id, ym, safety_pct, prev AS safety_pct_prev FROM compared", *PLACES, **MONTHS),
        "latest_period": _sql(
            "SELECT group_id, group_name, ym, total_points FROM compared WHERE is_last", *PLACES, **MONTHS),
        "topk_per_group": _sql(
            """SELECT group_id, ym, driver_id, driver_name, total_km, place AS rank
               FROM ranked_km WHERE place <= 5""",
            *PLACES, "d_drivers", driver_km=DRIVER_KM, ranked_km=RANKED_KM),
        "unpivot_offenders": _sql(OFFENDER_ROWS, *PLACES, placed=PLACED),
        "fold_text": f"SELECT doc_id, {_fold('text')} AS folded FROM documents",
        "match_key": f"SELECT doc_id, {_key('text')} AS match_key FROM documents",
        "classify_errors": _sql(
            f"""
            SELECT scheme_id,
                   {_labels(_fold("coalesce(scheme_description, '')"), K.DRIVING_ERRORS)} AS error,
                   {_labels('lower(description)', K.PEDAL_ISSUES, K.PEDAL_OTHER)} AS pedal,
                   {_labels('lower(parent_scheme)', K.COMPONENTS, K.COMPONENT_OTHER)} AS component
            FROM d_schemes""", "d_schemes"),
        "trend_label": _sql(
            f"SELECT group_id, ym, {_trend('safety_pct', 'prev')} AS trend FROM compared",
            *PLACES, **MONTHS),
    }


# --- marts ----------------------------------------------------------------------------------

DRIVER_ERRORS = f"""
    SELECT CAST(t.driver_id AS VARCHAR) AS driver_id,
           coalesce(d.driver_name, '{K.UNNAMED_DRIVER}') AS driver_name, categoria, parametro,
           {_int('year(start_drive)')} AS year, {_int('month(start_drive)')} AS month,
           count(*) AS total_eventos, peso AS peso_impacto_final, max(acao) AS acao_recomendada_final
    FROM t_events JOIN errors USING (scheme_id) JOIN t_trips t USING (drive_id)
         LEFT JOIN d_drivers d ON d.driver_id = t.driver_id
    WHERE start_drive IS NOT NULL
    GROUP BY ALL"""

RANKED_ERRORS = """
    SELECT *, row_number() OVER (
        PARTITION BY driver_id, year, month
        ORDER BY pontuacao_impacto_final DESC NULLS LAST, total_eventos DESC, parametro,
                 categoria, driver_name) AS ranking_parametro
    FROM (SELECT *, total_eventos * peso_impacto_final AS pontuacao_impacto_final FROM driver_errors)"""

ERROR_TABLES = ("t_events", "t_trips", "d_drivers", "d_schemes", "d_event_dictionary")
ERROR_STEPS = {"errors": ERRORS, "driver_errors": DRIVER_ERRORS, "ranked": RANKED_ERRORS}


def _economy(engine: str, km: str, energy: str) -> str:
    return (
        f"CASE WHEN {engine} = '{K.ELECTRIC_ENGINE}' AND {km} > 0 THEN {_dbl(energy)} / {_dbl(km)} "
        f"WHEN {energy} > 0 THEN {_dbl(km)} / {_dbl(energy)} END"
    )


ENGINE_MONTHS = f"""
    SELECT group_id, group_name, vehicle_engine_type, {_month('end_drive')} AS ym,
           sum(coalesce(mileage, 0)) AS km, sum(coalesce(energy_used, 0)) AS energy
    FROM t_trips JOIN d_vehicles USING (vehicle_id) JOIN d_groups USING (group_id)
    WHERE end_drive IS NOT NULL GROUP BY ALL"""

ENGINE_COMPARED = f"""
    SELECT *, lag(economy) OVER w AS prev, row_number() OVER (
               PARTITION BY group_id, vehicle_engine_type ORDER BY ym DESC) AS age
    FROM (SELECT *, {_economy('vehicle_engine_type', 'km', 'energy')} AS economy FROM engine_months)
    WINDOW w AS (PARTITION BY group_id, vehicle_engine_type ORDER BY ym)"""

ENGINE_TOP = f"""
    SELECT group_id, vehicle_engine_type, ym, arg_min(driver_id, (-km, driver_id)) AS driver_id
    FROM (SELECT v.group_id, v.vehicle_engine_type, {_month('end_drive')} AS ym, driver_id,
                 sum(coalesce(mileage, 0)) AS km
          FROM t_trips JOIN d_vehicles v USING (vehicle_id)
          WHERE end_drive IS NOT NULL AND driver_id IS NOT NULL GROUP BY ALL)
    GROUP BY ALL"""

GROUP_TOP = f"""
    SELECT group_id, ym, arg_min(driver_id, (-points, driver_id)) AS driver_id
    FROM (SELECT v.group_id, {_month('end_drive')} AS ym, driver_id, sum(points) AS points
          FROM t_trips JOIN d_vehicles v USING (vehicle_id)
          WHERE end_drive IS NOT NULL AND driver_id IS NOT NULL GROUP BY ALL)
    GROUP BY ALL"""

FUEL_MONTHS = f"""
    SELECT year(end_drive) AS y, month(end_drive) AS m, group_id, group_name, vehicle_engine_type,
           {_dbl('sum(mileage)')} AS km, {_dbl('sum(energy_used)')} AS energy
    FROM t_trips JOIN d_vehicles USING (vehicle_id) LEFT JOIN d_groups USING (group_id)
    WHERE end_drive IS NOT NULL GROUP BY ALL"""

CONTRIBUTORS = f"""
    SELECT *, {_economy('vehicle_engine_type', 'km', 'energy')} AS own
    FROM (SELECT group_id, group_name, vehicle_engine_type, {_month('end_drive')} AS ym, driver_id,
                 sum(mileage) AS km, sum(energy_used) AS energy
          FROM t_trips JOIN d_vehicles USING (vehicle_id) JOIN d_groups USING (group_id)
          WHERE end_drive IS NOT NULL AND driver_id IS NOT NULL AND vehicle_engine_type IS NOT NULL
          GROUP BY ALL)"""

MEANS = """
    SELECT group_id, vehicle_engine_type, ym,
           CAST(sum(CAST(own AS DECIMAL(28, 9))) AS DOUBLE) / count(own) AS mean
    FROM contributors WHERE own IS NOT NULL GROUP BY ALL"""

RECENT = f"""
    SELECT d.driver_id, d.driver_name, g.group_id, g.group_name, {_month('end_drive')} AS ym,
           {_pct('sum(points)', 'sum(coalesce(mileage, 0))')} AS pct
    FROM t_trips t JOIN d_vehicles v ON v.vehicle_id = t.vehicle_id
         JOIN d_groups g ON g.group_id = v.group_id JOIN d_drivers d ON d.driver_id = t.driver_id
    WHERE end_drive >= {TODAY} - INTERVAL '2' MONTH GROUP BY ALL"""


def _unpedal() -> str:
    return f"""
        SELECT scheme_id, s.parametro, p.categoria, p.peso AS peso_impacto,
               p.acao AS acao_recomendada_final
        FROM (SELECT scheme_id,
                     {_labels('lower(description)', K.PEDAL_ISSUES, K.PEDAL_OTHER)} AS parametro
              FROM d_schemes WHERE lower(description) LIKE '%{K.PEDAL_WORD}%') s
        LEFT JOIN parametro_base p ON p.parametro = s.parametro"""


def _energy_type() -> str:
    arms = " ".join(
        f"WHEN lower(vehicle_engine_type) IN {names} THEN '{label}'" for names, label in K.ENERGY_TYPES
    )
    return f"CASE {arms} ELSE '{K.ENERGY_UNKNOWN}' END"


def _health() -> str:
    parts = list(K.HEALTH_WEIGHTS)
    counts = ", ".join(f"count(*) FILTER (WHERE part = '{p}') AS {p}_events" for p in parts)
    points = " + ".join(f"{w} * {p}_events" for p, w in K.HEALTH_WEIGHTS.items())
    (low, low_label), (mid, mid_label) = K.HEALTH_LEVELS
    return _sql(
        f"""
        SELECT vehicle_id, group_id, group_name, {', '.join(f'{p}_events' for p in parts)},
               health_points,
               CASE WHEN health_points <= {low} THEN '{low_label}'
                    WHEN health_points <= {mid} THEN '{mid_label}' ELSE '{K.HEALTH_GOOD}' END AS health_status,
               last_seen
        FROM (SELECT *, {points} AS health_points FROM counted)
             LEFT JOIN d_vehicles USING (vehicle_id) LEFT JOIN d_groups USING (group_id)""",
        "t_events", "d_schemes", "d_vehicles", "d_groups",
        parts=f"""SELECT scheme_id, {_labels('lower(parent_scheme)', K.COMPONENTS, K.COMPONENT_OTHER)} AS part
                  FROM d_schemes WHERE parent_scheme IS NOT NULL""",
        counted=f"""SELECT vehicle_id, {counts}, CAST(max(start_time) AS DATE) AS last_seen
                    FROM t_events JOIN parts USING (scheme_id)
                    WHERE part IN {tuple(parts)} GROUP BY vehicle_id""")


def _marts() -> dict[str, str]:
    reference = f"'{K.REFERENCE_DRIVER}' || m.driver_name || '.'"
    before, middle, after = K.GROUP_ECONOMY_MESSAGE
    change = "(economy - prev) / prev"
    better, worse, same = (K.CONTRIBUTION[k] for k in ("positive", "negative", "neutral"))
    return {
        "mv_driver_errors": _sql("SELECT * FROM ranked", *ERROR_TABLES, **ERROR_STEPS),
        "mv_driver_top_offenders": _sql(
            "SELECT * FROM ranked WHERE ranking_parametro <= 5", *ERROR_TABLES, **ERROR_STEPS),
        "mv_pedal_events": _sql(
            f"""
            SELECT *, qtd_eventos * peso_impacto AS impacto_total
            FROM (SELECT d.driver_id, d.driver_name, g.group_name, parametro, categoria, peso_impacto,
                         acao_recomendada_final, {_int('year(start_time)')} AS year,
                         {_int('month(start_time)')} AS month, count(*) AS qtd_eventos
                  FROM t_events e JOIN pedal USING (scheme_id) JOIN t_trips t ON t.drive_id = e.drive_id
                       JOIN d_drivers d ON d.driver_id = t.driver_id
                       JOIN d_vehicles v ON v.vehicle_id = e.vehicle_id
                       LEFT JOIN d_groups g ON g.group_id = v.group_id
                  GROUP BY ALL)""",
            "t_events", "t_trips", "d_drivers", "d_vehicles", "d_groups", "d_schemes",
            "parametro_base", pedal=_unpedal()),
        "mv_fleet_economy_comparison": _sql(
            f"""
            SELECT c.group_id, c.group_name, c.vehicle_engine_type, {_period('c.ym')},
                   {_dbl('km')} AS total_km, {_dbl('energy')} AS total_energy,
                   economy AS avg_economy_current, prev AS avg_economy_previous,
                   CASE WHEN prev <> 0 THEN round({change} * 100, 2) END AS avg_economy_change_pct,
                   {_message(K.ECONOMY_MESSAGE, 'coalesce(prev, 0) = 0', 'economy > prev',
                             'economy < prev', f'abs({change}) * 100')} AS mensagem_economia,
                   t.driver_id AS top_driver_id, n.driver_name AS top_driver_name
            FROM engine_compared c
                 LEFT JOIN engine_top t ON t.group_id = c.group_id AND t.ym = c.ym
                       AND t.vehicle_engine_type = c.vehicle_engine_type
                 LEFT JOIN names n ON n.driver_id = t.driver_id
            WHERE age = 1""",
            *PLACES, "d_drivers", engine_months=ENGINE_MONTHS, engine_compared=ENGINE_COMPARED,
            engine_top=ENGINE_TOP, names=NAMES),
        "mv_driver_contribution": _sql(
            f"""
            SELECT group_id, group_name, vehicle_engine_type, ym, driver_id, driver_name,
                   own AS driver_avg_economy, mean AS fleet_avg_economy,
                   round(own - mean, 4) AS economy_delta,
                   CASE WHEN round(own - mean, 4) > 0 THEN '{better}'
                        WHEN round(own - mean, 4) < 0 THEN '{worse}' ELSE '{same}' END AS impacto_economia
            FROM (SELECT c.*, f.mean, row_number() OVER (
                         PARTITION BY group_id, vehicle_engine_type ORDER BY ym DESC, driver_id) AS place
                  FROM contributors c JOIN means f USING (group_id, vehicle_engine_type, ym))
                 LEFT JOIN names USING (driver_id)
            WHERE place = 1""",
            *PLACES, "d_drivers", contributors=CONTRIBUTORS, names=NAMES,
            means=MEANS),
        "mv_driver_contribution_all": _sql(
            f"""
            SELECT c.group_id, c.group_name, c.vehicle_engine_type, c.ym, c.driver_id, driver_name,
                   own AS driver_avg_economy, mean AS fleet_avg_economy,
                   round(own - mean, 4) AS economy_delta,
                   CASE WHEN round(own - mean, 4) > 0 THEN '{better}'
                        WHEN round(own - mean, 4) < 0 THEN '{worse}' ELSE '{same}' END AS impacto_economia
            FROM contributors c
                 JOIN (SELECT *, max(ym) OVER (PARTITION BY group_id, vehicle_engine_type) AS newest FROM means) f
                      USING (group_id, vehicle_engine_type, ym)
                 LEFT JOIN names USING (driver_id)
            WHERE ym = newest""",
            *PLACES, "d_drivers", contributors=CONTRIBUTORS, names=NAMES, means=MEANS),
        "mv_economy_offenders": _sql(
            """
            SELECT group_id, group_name, driver_id AS top_driver_id, driver_name AS top_driver_name,
                   ofensor, total_events, action_recommended,
                   row_number() OVER (PARTITION BY group_id ORDER BY total_events DESC, ofensor) AS ranking
            FROM (SELECT *, row_number() OVER (PARTITION BY group_id, ofensor
                                               ORDER BY total_events DESC, driver_id) AS place
                  FROM offenders) LEFT JOIN names USING (driver_id)
            WHERE place = 1""",
            *PLACES, "d_drivers", placed=PLACED, offenders=OFFENDER_ROWS, names=NAMES),
        "mv_fleet_safety_monthly": _sql(
            f"""
            SELECT c.group_id, c.group_name, {_int('year(c.ym)')} AS current_year,
                   {_int('month(c.ym)')} AS current_month, total_points, total_km, safety_pct,
                   prev AS safety_pct_prev, {_trend('safety_pct', 'prev')} AS safety_tendencia,
                   {_message(K.FLEET_SAFETY_MESSAGE, 'prev IS NULL', 'safety_pct < prev',
                             'safety_pct > prev', 'abs(safety_pct - prev)')} AS safety_message,
                   t.driver_id AS top_driver_id, n.driver_name AS top_driver_name
            FROM compared c LEFT JOIN group_top t ON t.group_id = c.group_id AND t.ym = c.ym
                 LEFT JOIN names n ON n.driver_id = t.driver_id
            WHERE is_last""",
            *PLACES, "d_drivers", **MONTHS, group_top=GROUP_TOP, names=NAMES),
        "mv_safety_offenders": _sql(
            """
            SELECT group_id, group_name, ofensor, categoria, total_events, acao_recomendada_final,
                   driver_id AS top_driver_id, driver_name AS top_driver_name,
                   row_number() OVER (PARTITION BY group_id ORDER BY total_events DESC, ofensor) AS ranking
            FROM (SELECT *, row_number() OVER (PARTITION BY group_id, ofensor
                            ORDER BY total_events DESC, driver_id) AS place FROM per_driver)
                 LEFT JOIN names USING (driver_id)
            WHERE place = 1""",
            "t_events", "t_trips", "d_vehicles", "d_groups", "d_schemes", "parametro_base", "d_drivers",
            **KEYED, matches=SCHEME_PARAMETERS, names=NAMES,
            per_driver="""
                SELECT v.group_id, g.group_name, t.driver_id, ofensor, categoria,
                       acao_recomendada_final, count(*) AS total_events
                FROM t_events e JOIN t_trips t ON t.drive_id = e.drive_id
                     JOIN matches m ON m.scheme_id = e.scheme_id
                     JOIN d_vehicles v ON v.vehicle_id = e.vehicle_id
                     LEFT JOIN d_groups g ON g.group_id = v.group_id
                WHERE t.driver_id IS NOT NULL GROUP BY ALL"""),
        "mv_group_main_driver": _sql(
            "SELECT group_id, ym, driver_id, driver_name, total_km, place AS rn FROM ranked_km",
            *PLACES, "d_drivers", driver_km=DRIVER_KM, ranked_km=RANKED_KM),
        "mv_group_safety_base": _sql(
            f"""SELECT group_id, group_name, ym, {_period('ym')}, total_points, total_km, safety_pct
                FROM safety_months""",
            *PLACES, per_month=PER_MONTH, safety_months=SAFETY_MONTHS),
        "mv_driver_ranking": _sql(
            f"""
            SELECT *, CAST({K.SCORE_START} - safety_events * {K.SCORE_SAFETY[1]}
                           - economy_events * {K.SCORE_ECONOMY[1]}
                           - (total_events - safety_events - economy_events) * {K.SCORE_OTHER}
                      AS DOUBLE) AS driver_score
            FROM (SELECT d.driver_id, max(d.driver_name) AS driver_name, max(g.group_name) AS group_name,
                         count(*) AS total_events,
                         count(*) FILTER (WHERE scheme_type = 'Safety') AS safety_events,
                         count(*) FILTER (WHERE scheme_type = 'Economy') AS economy_events
                  FROM t_events e JOIN t_trips t USING (drive_id) JOIN d_drivers d USING (driver_id)
                       LEFT JOIN d_groups g ON g.group_id = d.group_id
                       LEFT JOIN d_schemes s ON s.scheme_id = e.scheme_id
                  GROUP BY d.driver_id)""",
            "t_events", "t_trips", "d_drivers", "d_groups", "d_schemes"),
        "mv_vehicle_health": _health(),
        "v_driver_keymap": _sql(
            """
            SELECT CAST(driver_id AS VARCHAR) AS driver_tech_id, CAST(driver_id AS VARCHAR) AS driver_id,
                   max(trim(driver_name)) AS driver_name, max(group_id) AS group_id,
                   max(group_name) AS group_name
            FROM d_drivers LEFT JOIN d_groups USING (group_id) GROUP BY d_drivers.driver_id""",
            "d_drivers", "d_groups"),
        "v_parameter_dictionary": _sql(
            f"""SELECT DISTINCT parametro, categoria, {_dbl('peso')} AS peso_impacto,
                       acao AS acao_recomendada_final FROM parametro_base""", "parametro_base"),
        "v_event_parameters": _sql(
            """
            SELECT row_number() OVER (ORDER BY parametro, categoria, peso, acao) AS parameter_id,
                   parametro AS parameter_name, categoria AS parameter_category, categoria,
                   CAST(NULL AS VARCHAR) AS parent_scheme,
                   CAST(NULL AS VARCHAR) AS parameter_description,
                   peso AS peso_impacto, acao AS acao_recomendada_final,
                   CAST(NULL AS VARCHAR) AS explanation_final,
                   CAST(NULL AS VARCHAR) AS example_good, CAST(NULL AS VARCHAR) AS example_bad
            FROM parametro_base""", "parametro_base"),
        "v_driver_event_parameters": _sql(
            """
            SELECT driver_id, driver_name, CAST(NULL AS BIGINT) AS parameter_id,
                   CAST(NULL AS VARCHAR) AS parameter_name, CAST(NULL AS VARCHAR) AS parameter_category,
                   CAST(NULL AS INTEGER) AS peso_impacto,
                   CAST(NULL AS VARCHAR) AS acao_recomendada_final, count(*) AS qtd_eventos
            FROM t_events JOIN t_trips USING (drive_id) JOIN d_drivers USING (driver_id)
            GROUP BY driver_id, driver_name""", "t_events", "t_trips", "d_drivers"),
        "v_driver_economy_monthly": _sql(
            f"""
            SELECT year, month, group_id, group_name, CAST(s.driver_id AS VARCHAR) AS driver_id,
                   coalesce(n.driver_name, '{K.UNNAMED_DRIVER}') AS driver_name, vehicle_engine_type,
                   {_energy_type()} AS energy_type, total_km, total_energy,
                   CASE WHEN total_energy > 0 THEN total_km / total_energy END AS avg_economy
            FROM (SELECT {_int('year(start_drive)')} AS year, {_int('month(start_drive)')} AS month,
                         group_id, group_name, driver_id, vehicle_engine_type,
                         {_dbl('sum(coalesce(mileage, 0))')} AS total_km,
                         {_dbl('sum(coalesce(energy_used, 0))')} AS total_energy
                  FROM t_trips LEFT JOIN d_vehicles USING (vehicle_id) LEFT JOIN d_groups USING (group_id)
                  WHERE start_drive IS NOT NULL GROUP BY ALL) s
                 LEFT JOIN names n ON n.driver_id = s.driver_id""",
            *PLACES, "d_drivers", names=NAMES),
        "v_driver_safety_score_monthly": _sql(
            f"""
            SELECT driver_id, driver_name, group_id, group_name, ym AS current_month,
                   pct AS safety_pct, prev AS prev_pct, coalesce(round(pct - prev, 4), 0) AS impacto_pct,
                   {_trend('pct', 'prev')} AS tendencia,
                   {_message(K.DRIVER_SAFETY_MESSAGE, 'prev IS NULL', 'pct < prev', 'pct > prev',
                             'abs(pct - prev)')} AS mensagem,
                   row_number() OVER (ORDER BY coalesce(pct - prev, 0), driver_id, group_id) AS ranking_melhor,
                   row_number() OVER (ORDER BY coalesce(pct - prev, 0) DESC, driver_id DESC,
                                      group_id DESC) AS ranking_pior
            FROM (SELECT *, lag(pct) OVER (PARTITION BY driver_id ORDER BY ym, group_id) AS prev FROM recent)
            WHERE ym = (SELECT max(ym) FROM recent)""",
            *PLACES, "d_drivers", recent=RECENT),
        "v_fleet_economy_monthly": _sql(
            f"""
            SELECT {_int('y')} AS year, {_int('m')} AS month, group_id, group_name, vehicle_engine_type,
                   km AS total_km, energy AS total_energy, km / nullif(energy, 0) AS avg_economy
            FROM fuel_months""", *PLACES, fuel_months=FUEL_MONTHS),
        "v_group_economy_summary": _sql(
            f"""
            SELECT group_id, group_name, mean AS media_economia_grupo,
                   '{before}' || group_name || '{middle}' || {_two('mean')} || '{after}' AS mensagem_economia
            FROM (SELECT group_id, group_name, round(avg(km / energy), 2) AS mean
                  FROM fuel_months WHERE energy <> 0 AND km IS NOT NULL GROUP BY ALL)""",
            *PLACES, fuel_months=FUEL_MONTHS),
        "v_group_safety_summary": _sql(
            f"""
            SELECT c.group_id, c.group_name, {_int('year(c.ym)')} AS current_year,
                   {_int('month(c.ym)')} AS current_month, total_points, c.total_km, safety_pct,
                   prev AS safety_pct_prev, m.driver_name AS driver_referencia,
                   {_trend('safety_pct', 'prev')} AS safety_tendencia,
                   {_message(K.FLEET_SAFETY_MESSAGE, 'prev IS NULL', 'safety_pct < prev',
                             'safety_pct > prev', 'abs(safety_pct - prev)', reference)} AS safety_message
            FROM compared c LEFT JOIN ranked_km m
                 ON m.group_id = c.group_id AND m.ym = c.ym AND m.place = 1
            WHERE is_last""",
            *PLACES, "d_drivers", **MONTHS, driver_km=DRIVER_KM, ranked_km=RANKED_KM),
    }


def oracle_sql() -> dict[str, str]:
    found = {**_silver(), **_operators(), **_marts()}
    # other ways to the same result
    found["append_indexed"] = found["silver_trips_incremental"]
    found["refresh_incremental"] = found["mv_driver_ranking"]
    found["driver_safety_by_month"] = found["v_driver_safety_score_monthly"]
    found["stream_newest"] = found["stream_bronze_silver"]
    found["run_resumed"] = f"SELECT *, 1 AS silver_loads FROM ({found['conform_trips']})"
    return found
