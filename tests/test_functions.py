"""Cleaning, parsing, classifying and measuring, value by value."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from milepost.constants import ECONOMY_MESSAGE, EVENT_TIME_FORMATS, FLEET_SAFETY_MESSAGE, TRIP_TIME_FORMATS
from milepost.functions import metrics as M
from milepost.functions import parsing as P
from milepost.functions import text as X
from milepost.functions.cleaning import fill_missing_text, null_missing_text, squeeze, trim_strings
from milepost.plans import silver as S


def apply(spark, values, function, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


RAW = ["  a   b ", "", "   ", "NULL", "null", "N/A", "-", None, "x\ty", " none "]


def cleaned(spark, rule):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(RAW)], "i int, v string")
    return [r.v for r in rule(df).orderBy("i").collect()]


def test_fill_missing_text(spark):
    gone = "sem dado"
    assert cleaned(spark, fill_missing_text) == ["a b", *[gone] * 7, "x y", gone]


def test_null_missing_text(spark):
    assert cleaned(spark, null_missing_text) == ["a b", *[None] * 7, "x y", None]


def test_trim_strings_keeps_case_and_inner_space(spark):
    assert cleaned(spark, trim_strings) == ["a   b", "", "", "NULL", None, "N/A", None, None, "x\ty", None]


def test_only_chosen_columns_are_cleaned(spark):
    df = spark.createDataFrame([(" a ", " b ")], "p string, q string")
    assert tuple(trim_strings(df, ["q"]).first()) == (" a ", "b")


def test_to_long(spark):
    values = ["42", " 42 ", "-7", "+7", "12.75", "12.", "x1", "", "1e3", None,
              "9007199254740993", "99999999999999999999", "sem dado"]
    assert apply(spark, values, P.to_long) == [
        42, 42, -7, 7, 12, 12, None, None, None, None, 9007199254740993, None, None]


def test_to_double(spark):
    values = ["1,5", "1.5", "1.234,5", "abc", None, " 2,5 ", "-,5", "3e2", ""]
    assert apply(spark, values, P.to_double) == [1.5, 1.5, None, None, None, 2.5, -0.5, 300.0, None]


def test_to_truncated_long(spark):
    assert apply(spark, ["2,9", "-2,9", "x", "1e300"], P.to_truncated_long) == [2, -2, None, None]


def test_parse_time(spark):
    values = [
        "2025-10-14 01:02:03.120", "2025-10-14 01:02:03.1", "2025-10-14 01:02:03",
        "14/10/2025 01:02:03", "2025-10-14T01:02:03", "2025-10-14T01:02:03Z",
        "2025-13-14 01:02:03", "14-10-2025", "", None,
    ]
    second = dt.datetime(2025, 10, 14, 1, 2, 3)
    assert apply(spark, values, P.parse_time) == [
        second.replace(microsecond=120000), second.replace(microsecond=100000), *[second] * 4,
        *[None] * 4]


def test_shape_test_rejects_nothing_a_format_reads(spark):
    times = [
        f"{d}{sep}{t}{tail}"
        for d in ("2025-10-14", "14/10/2025", "2025-1-4", "+12025-10-14", "31/02/2025")
        for sep in (" ", "T", "")
        for t in ("01:02:03", "1:02:03", "25:00:00", "00:00:00")
        for tail in ("", "Z", ".1", ".12", ".123", ".1234", " x")
    ]
    plain = lambda c: F.coalesce(
        *[F.try_to_timestamp(c, F.lit(f)) for f in EVENT_TIME_FORMATS]).cast("timestamp_ntz")
    as_text = lambda f: lambda c: f(c).cast("string")
    assert apply(spark, times, as_text(P.parse_time)) == apply(spark, times, as_text(plain))


def test_bare_texts_read_as_all_texts_do(spark):
    """The short ways for usual texts give what the rules for any text give, odd texts included."""
    numbers = [
        f"{lead}{sign}{whole}{tail}{end}"
        for lead in ("", " ", "\t")
        for sign in ("", "-", "+")
        for whole in ("", "0", "007", "12", "9" * 15, "9" * 18, "9" * 19, "1e3", "nan", "NaN", "-", "\u0663", "x1")
        for tail in ("", ".", ".5", ",5", ".25,5", "." + "3" * 16)
        for end in ("", " ", "\n")
    ] + [None]
    long = lambda c: F.nullif(F.regexp_extract(c, P.WHOLE_NUMBER, 1), F.lit("")).try_cast("bigint")
    double = lambda c: F.when(c.rlike(P.DECIMAL_NUMBER), c.try_cast("double"))
    comma = lambda c: double(F.translate(c, ",", "."))
    as_text = lambda f: lambda c: f(c).cast("string")
    assert apply(spark, numbers, P.to_long) == apply(spark, numbers, long)
    for new, old, rule in ((P.plain_double, double, S._trimmed), (P.to_double, comma, S._trimmed), (P.to_double, comma, S._a_number)):
        assert apply(spark, numbers, as_text(new)) == apply(spark, numbers, as_text(old))
        assert apply(spark, numbers, as_text(lambda c: new(c, rule))) == apply(spark, numbers, as_text(lambda c: old(rule(c))))

    days = ("2025-10-14", "14/10/2025", "2024-02-30", "30/02/2024", "0000-01-01", "01/01/0000", "2018-11-04", "0001-01-01", "9999-12-31")
    times = [
        f"{lead}{day}{sep}{clock}{end}"
        for lead in ("", " ")
        for day in days
        for sep in (" ", "  ", "T", "")
        for clock in ("01:02:03", "00:30:00", "24:00:00", "23:59:60", "1:02:03")
        for end in ("", "Z", ".1", ".123", ".1234", ".123Z", " ", "\n", "+01:00")
    ] + [None]
    tried = lambda rule, formats: lambda c: F.coalesce(
        *[F.when(rule(c).rlike(P._shape(f)), F.try_to_timestamp(rule(c), F.lit(f))) for f in formats]).cast("timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session_zone in (zone, "America/Sao_Paulo"):
            spark.conf.set("spark.sql.session.timeZone", session_zone)
            for formats, rule in ((EVENT_TIME_FORMATS, F.trim), (TRIP_TIME_FORMATS, squeeze), (("MM/dd/yyyy HH:mm:ss", *TRIP_TIME_FORMATS), squeeze)):
                new, old = lambda c: P.parse_time(c, formats, rule), tried(rule, formats)
                assert apply(spark, times, as_text(new)) == apply(spark, times, as_text(old))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


NAMES = ["x_2025_10_14_events.csv", "x_2026_1_8_trips.csv", "x_2026-01-08_d.csv", "plain.csv", None]


@pytest.mark.parametrize(
    "style, fallback, expected",
    [
        ("padded", None, ["2025-10-14", None, None, None, None]),
        ("padded", dt.date(2000, 1, 1), ["2025-10-14", *["2000-01-01"] * 4]),
        ("loose", None, ["2025-10-14", "2026-01-08", None, None, None]),
        ("any_sep", None, ["2025-10-14", "2026-01-08", "2026-01-08", None, None]),
    ],
)
def test_file_date(spark, style, fallback, expected):
    found = apply(spark, NAMES, lambda c: P.file_date(c, style, fallback).cast("string"))
    assert found == expected


def test_fold_and_match_key(spark):
    values = ["Pós-chave Ñ", "Pedal de FREIO", None]
    assert apply(spark, values, X.fold_text) == ["pos-chave n", "pedal de freio", None]
    assert apply(spark, values, X.match_key) == ["poschaven", "pedaldefreio", None]


def test_driving_error_keeps_spaces(spark):
    values = ["PosChave ligado", "Pós-chave", "PedalDeFreio", "Pedal de freio", "Absoluto",
              "FreioDeMão", "Speeding", "Curva e aceleração", None]
    assert apply(spark, values, X.driving_error) == [
        "Dirigir com pós-chave desligado", None, "Excesso de uso do pedal de freio >30 km/h", None,
        "ABS acionado", "Estacionar sem freio de mão", "Excesso de velocidade em pista seca",
        "Aceleração Brusca", None]


def test_component_pedal_and_energy(spark):
    assert apply(spark, ["Brakes", "ABS", "Transmission", "wheel", "Suspension"], X.component) == [
        "braking", "braking", "gearbox", "other", "suspension"]
    assert apply(spark, ["Pedal embreagem freio", "BRAKE pedal", "pedal"], X.pedal_issue) == [
        "Falha na embreagem", "Falha no freio/ABS", "Outros"]
    assert apply(spark, ["Flex", "ELÉTRICO", "gnv", "steam", None], X.energy_type) == [
        "Combustão", "Elétrico", "Gás", "Desconhecido", "Desconhecido"]


def pairs(spark, values, function):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, cur double, prev double")
    out = df.select("i", function(F.col("cur"), F.col("prev")).alias("out")).orderBy("i")
    return [r.out for r in out.collect()]


COMPARED = [(1.0, None), (1.0, 2.0), (2.0, 1.0), (1.0, 1.0), (None, 1.0), (1.0, 0.0)]


def test_trend(spark):
    assert pairs(spark, COMPARED, M.trend) == [
        "sem histórico", "melhorou", "piorou", "igual", "igual", "piorou"]


def test_pct_change(spark):
    assert pairs(spark, COMPARED, M.pct_change) == [None, -50.0, 100.0, 0.0, None, None]


def test_messages(spark):
    economy = pairs(spark, COMPARED, lambda c, p: M.economy_message(ECONOMY_MESSAGE, c, p))
    assert economy[1] == "Seu percentual de economia piorou 50.00% em relação ao mês anterior."
    assert economy[2] == "Seu percentual de economia melhorou 100.00% em relação ao mês anterior."
    assert economy[0] == economy[5] == "Sem histórico anterior para comparação."
    assert "estável" in economy[3] and "estável" in economy[4]
    ending = F.lit(None).cast("string")
    safety = pairs(spark, COMPARED, lambda c, p: M.safety_message(FLEET_SAFETY_MESSAGE, c, p, ending))
    assert safety[1] is None and safety[2] is None and "estável" in safety[3]


def test_ratio_and_score(spark):
    assert pairs(spark, [(1.0, 0.0), (1.0, 4.0), (None, 1.0), (1.0, None)], M.ratio) == [
        None, 0.25, None, None]
    df = spark.createDataFrame([(10, 3, 4)], "t long, s long, e long")
    assert df.select(M.driver_score(F.col("t"), F.col("s"), F.col("e"))).first()[0] == 94.7


def test_health_levels(spark):
    assert apply(spark, [300, 301, 1000, 1001], M.health_status, "v int") == [
        "Crítico", "Atenção", "Atenção", "OK"]
