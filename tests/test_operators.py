"""Deduplication, ranking, containment, unpivot and quality checks."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from milepost.operators import quality as Q
from milepost.operators.dedup import at_latest, latest_per_key
from milepost.operators.joins import containment_candidates, join_contains
from milepost.operators.reshape import unpivot_offenders
from milepost.operators.windows import top_rows, with_previous, with_row_number
from tests.conftest import rows


@pytest.fixture(scope="module")
def dated(spark):
    data = [
        (1, "2026-01-08", "a", 1), (1, "2026-01-10", "a", 2), (1, "2026-01-10", "b", 3),
        (2, "2026-01-01", "a", 4), (None, "2026-01-01", "a", 5), (None, "2026-01-02", "a", 6),
        (None, "2026-01-02", "a", 6),
    ]
    return spark.createDataFrame(data, "k int, d string, f string, v int").withColumn(
        "d", F.col("d").cast("date"))


@pytest.mark.parametrize(
    "null_keys, expected", [("collapse", [3, 4, 6]), ("keep", [3, 4, 5, 6, 6]), ("drop", [3, 4])])
def test_latest_per_key(dated, null_keys, expected):
    kept = latest_per_key(dated, ["k"], ["d", "f"], null_keys)
    assert sorted(r.v for r in kept.collect()) == expected
    again = latest_per_key(kept, ["k"], ["d", "f"], null_keys)
    assert rows(again) == rows(kept)


def test_latest_per_key_rejects_unknown_mode(dated):
    with pytest.raises(ValueError):
        latest_per_key(dated, ["k"], ["d"], "other")


def test_ties_do_not_depend_on_partitioning(dated):
    for n in (1, 3, 7):
        spread = latest_per_key(dated.repartition(n), ["k"], ["d"])
        assert sorted(r.v for r in spread.collect()) == [3, 4, 6]


def test_at_latest(dated):
    assert sorted(r.v for r in at_latest(dated, "d").collect()) == [2, 3]


def test_previous_row_skips_gap_months(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 3, 30), (2, 1, 5)], "g int, m int, v int")
    assert rows(with_previous(df, "v", "p", ["g"], ["m"])) == [(1, 1, 10, None), (1, 3, 30, 10), (2, 1, 5, None)]


@pytest.fixture(scope="module")
def measured(spark):
    """Two thirds of the rows in one group, many equal values, NULL groups."""
    rng = random.Random(5)
    data = [
        (rng.choice([1, 1, 1, 1, 2, None]), rng.choice([0.0, 0.0, 0.0, 1.5, -2.0, None]), i)
        for i in range(3000)
    ]
    return spark.createDataFrame(data, "g int, v double, id int").repartition(6)


def order():
    return [F.col("v").asc_nulls_first(), F.col("id").asc()]


@pytest.mark.parametrize("keys", [[], ["g"]])
def test_row_number_equals_window(measured, keys):
    window = W.partitionBy(*keys).orderBy(*order())
    expected = measured.withColumn("n", F.row_number().over(window).cast("bigint")).withColumn(
        "t", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    assert rows(with_row_number(measured, order(), "n", keys, total="t")) == rows(expected)


def test_row_number_of_nothing(measured):
    assert with_row_number(measured.filter("id < 0"), order(), "n").count() == 0


def test_top_rows_is_a_prefix_of_the_ranking(measured):
    window = W.partitionBy("g").orderBy(*order())
    ranked = measured.withColumn("r", F.row_number().over(window))
    assert rows(top_rows(measured, ["g"], order(), 3, "r")) == rows(ranked.filter("r <= 3"))


WORDS = st.lists(st.text(alphabet="ab", max_size=7), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=WORDS, fragments=WORDS)
def test_join_contains_equals_nested_loop(spark, texts, fragments):
    left = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    right = spark.createDataFrame(list(enumerate(fragments)), "j int, fragment string")
    found = join_contains(left, "text", right, "fragment").select("i", "j")
    expected = sorted(
        ((i, j) for i, t in enumerate(texts) for j, f in enumerate(fragments) if f and f in t),
        key=repr)
    assert rows(found) == expected


LONG_WORDS = st.lists(st.text(alphabet="ab", min_size=7, max_size=14), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=LONG_WORDS, fragments=LONG_WORDS)
def test_join_contains_beyond_the_seed(spark, texts, fragments):
    """Fragments longer than the seed, cut out of the texts and free ones."""
    fragments = fragments + [t[1:11] for t in texts]
    left = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    right = spark.createDataFrame(list(enumerate(fragments)), "j int, fragment string")
    expected = sorted(
        ((i, j) for i, t in enumerate(texts) for j, f in enumerate(fragments) if f and f in t),
        key=repr)
    assert rows(join_contains(left, "text", right, "fragment").select("i", "j")) == expected


def test_containment_candidates_follow_matches(spark):
    """Labels that share their beginning, and texts full of it, meet only where they match."""
    start = "falha no sistema de "  # 20 letters
    labels = spark.range(1000).select(F.concat(F.lit(start), F.lpad(F.col("id"), 4, "0"), F.lit(" de freio")).alias("_fragment"))
    texts = spark.range(300).select(F.concat(F.lit("x " + start), F.lpad(F.col("id") * 7, 4, "0"), F.lit(" de freio dianteiro")).alias("_text"))
    pairs = containment_candidates(texts, labels)
    matching = pairs.filter(F.col("_text").contains(F.col("_fragment"))).count()
    assert matching == 143  # ids below 1000 that are multiples of 7
    assert pairs.count() <= 2 * matching


def test_unpivot_keeps_the_total(spark):
    df = spark.createDataFrame(
        [(1, 2, 0, None, 4.5, 1)],
        "k int, engine long, speed_road3 long, acceleration3 long, idle_duration double, gearbox long")
    found = unpivot_offenders(df, "k")
    assert found.count() == 3
    assert found.agg(F.sum("total_events")).first()[0] == 7.5


def test_key_checks(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    pk = Q.check_primary_key(facts, "f", "k").first()
    assert (pk.rows, pk.null_keys, pk.duplicated_keys, pk.surplus_rows, pk.valid) == (6, 1, 2, 2, False)
    fk = Q.check_foreign_key(facts, "f", "k", dim, "d", "k").first()
    assert (fk.rows, fk.null_keys, fk.orphan_keys, fk.orphan_rows, fk.valid) == (6, 1, 1, 2, False)
    assert Q.check_primary_key(dim.filter("k = 1"), "d", "k").first().valid


def test_checkpoint_names_every_fault(spark):
    full, empty = spark.range(3), spark.range(0)
    tables = {"a": full, "b": empty}
    report = {r.table_name: r.status for r in Q.checkpoint_report(spark, tables, ("a", "b", "c")).collect()}
    assert report == {"a": "ok", "b": "empty", "c": "missing"}
    Q.require_checkpoint(spark, tables, ("a",))
    with pytest.raises(Q.QualityError, match="table b is empty\ntable c is missing"):
        Q.require_checkpoint(spark, tables, ("a", "b", "c"))


def test_null_partition_report(spark):
    df = spark.createDataFrame([("x", None), ("y", "2026-01-01")], "v string, p_source_date string")
    assert tuple(Q.null_partition_report(df, "t").first()) == ("t", 2, 1, False)
