"""Silver tables, incremental loads, streams, the catalog and the whole pipeline."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from milepost.operators.conform import conform_events, conform_trips
from milepost.operators.dedup import latest_per_key
from milepost.operators.quality import QualityError
from milepost.plans import silver as S
from milepost.plans.marts import MARTS, VIEWS, create_views, store_rollups
from milepost.plans.pipeline import input_bytes, load_silver, run_pipeline
from milepost.schemas import BRONZE, WAREHOUSE
from milepost.session import shared_dir, write_once
from milepost.sources import feeds
from milepost.sources import projection as T
from milepost.sources.bronze import SOURCE_FILE, read_bronze, read_checked, route_landing
from milepost.sources.reference import load_dictionary, load_parameters
from milepost.sources.silver import (
    PARTITION,
    append_unseen,
    existing_keys,
    load_keyed,
    read_keyed,
    read_table,
    register_table,
    write_partitions,
    write_snapshot,
)
from milepost.sources.versions import publish, read_version
from milepost.streaming.ingest import ingest, ingest_unseen, stream_bronze
from tests.conftest import rows

AS_OF = T.AS_OF


def dated(spark, data):
    df = spark.createDataFrame(data, f"drive_id int, v string, {PARTITION} string")
    return df.withColumn(PARTITION, F.col(PARTITION).cast("date"))


def stored(spark, path):
    return sorted((r.drive_id, r.v) for r in spark.read.parquet(path).collect())


def test_append_keeps_stored_rows_of_a_touched_date(spark, tmp_path):
    path = str(tmp_path / "t")
    append_unseen(spark, dated(spark, [(1, "a", "2026-01-01"), (2, "a", "2026-01-02")]), path, "drive_id")
    arrived = dated(spark, [(2, "b", "2026-01-01"), (3, "b", "2026-01-01"), (None, "b", "2026-01-01")])
    for _ in range(2):
        append_unseen(spark, arrived, path, "drive_id")
    assert stored(spark, path) == [(1, "a"), (2, "a"), (3, "b")]


def test_rows_without_key_of_other_dates_stay(spark, tmp_path):
    path = str(tmp_path / "t")

    def load(*data):
        load_keyed(spark, dated(spark, list(data)), path, "drive_id")
        return sorted((r.drive_id or 0, r.v) for r in read_keyed(spark, path).collect())

    assert load((1, "a", "2026-01-01"), (None, "b", "2026-01-01"), (None, "c", "2026-01-02"), (None, "n", None)) == [(0, "b"), (0, "c"), (0, "n"), (1, "a")]
    assert load((None, "d", "2026-01-02"), (None, "e", "2026-01-02")) == [(0, "b"), (0, "d"), (0, "e"), (0, "n"), (1, "a")]
    assert load((2, "b", "2026-01-01"), (None, "f", "2026-01-03")) == [(0, "d"), (0, "e"), (0, "f"), (0, "n"), (1, "a"), (2, "b")]


def test_dynamic_overwrite_and_snapshot(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(dated(spark, [(1, "a", "2026-01-01"), (2, "a", "2026-01-02")]), path)
    write_partitions(dated(spark, [(3, "b", "2026-01-02")]), path)
    assert stored(spark, path) == [(1, "a"), (3, "b")]
    write_snapshot(dated(spark, [(4, "c", "2026-01-03")]), path)
    assert stored(spark, path) == [(4, "c")]


def test_missing_table_and_other_failures(spark, tmp_path):
    assert read_table(spark, str(tmp_path / "none")) is None
    assert existing_keys(spark, str(tmp_path / "none"), "drive_id") is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "bad")).count()


def test_register_table_finds_its_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    df = dated(spark, [(1, "a", "2026-01-01"), (2, "a", "2026-01-02")])
    write_partitions(df, path)
    register_table(spark, "registered_trips", path)
    try:
        assert spark.table("registered_trips").count() == 2
        assert spark.sql("SHOW PARTITIONS registered_trips").count() == 2
        assert dict(spark.table("registered_trips").dtypes)[PARTITION] == "date"
    finally:
        spark.sql("DROP TABLE registered_trips")


def test_write_once_reads_back_the_same(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    assert rows(write_once(df, "test")) == rows(df)
    assert shared_dir(spark, "a") != shared_dir(spark, "a")


def test_read_bronze_matches_header_and_dates(spark, tmp_path):
    folder = tmp_path / "fleet_trips" / "2020_01_01"
    folder.mkdir(parents=True)
    (folder / "fleet_2026_1_8_drivers.csv").write_text(
        "driver_id,driver_name,group_id,driver_code,worker_id\n1,Ana,2,x,\n")
    (tmp_path / "note.txt").write_text("no csv")
    df = read_bronze(spark, str(tmp_path), BRONZE["drivers"], name_glob="*.csv")
    row = df.select("*", S.source_date("loose").alias("d")).first()
    assert (row.driver_id, row.driver_name, row.worker_id) == ("1", "Ana", None)
    assert row.d == dt.date(2026, 1, 8)
    assert read_bronze(spark, str(tmp_path), BRONZE["drivers"], recursive=False).count() == 0


def test_every_line_is_good_or_rejected(spark, tmp_path):
    schema = BRONZE["drivers"]
    lines = [
        '1,"Ana, filha",2,x,7', "2,Bia,2,x", "3,Caio,2,x,7,8,9", '4,"Dora,2,x,7', '5,"Eva"s,2,x,7', ",,,,", "", '6,"F,G",2,x',
    ]
    for i, part in enumerate((lines[:4], lines[4:], [])):
        (tmp_path / f"{i}_drivers.csv").write_text("\n".join([",".join(schema.names), *part]) + "\n")
    good, rejected = read_checked(spark, str(tmp_path), schema)
    assert [r.driver_name for r in good.orderBy("driver_id").collect()] == [None, "Ana, filha"]
    assert good.columns == [*schema.names, SOURCE_FILE]
    assert sorted((r.line[:1], r.reason, r.file.rsplit("/")[-1][:1]) for r in rejected.collect()) == [
        ("2", "too few fields", "0"), ("3", "too many fields", "0"), ("4", "broken quotes", "0"),
        ("5", "broken quotes", "1"), ("6", "too few fields", "1"),
    ]
    assert {r.line for r in rejected.collect()} <= set(lines)


def test_route_landing(spark):
    keys = ["in_group/a.csv", "in_trips/b.csv", "bronze/in_trips/c.csv", "in_tripsx/d.csv", "e.csv"]
    routed = route_landing(spark.createDataFrame([(k,) for k in keys], "path string"), "in_")
    assert [tuple(r)[1:] for r in routed.collect()] == [
        ("groups", True, "accepted", "bronze/in_group/a.csv"),
        ("trips", True, "accepted", "bronze/in_trips/b.csv"),
        (None, False, "already in bronze", None),
        (None, False, "out of scope", None),
        (None, False, "out of scope", None),
    ]


def test_driver_gates(spark, small):
    bronze = feeds.feed(spark, small, "drivers")
    trips = spark.createDataFrame([("2001-03-15",), ("2001-02-15",)], f"{PARTITION} string").select(
        F.col(PARTITION).cast("date"))
    drivers = S.silver_drivers(bronze, trips)
    assert [r[0] for r in drivers.select(PARTITION).distinct().collect()] == [dt.date(2001, 3, 15)]
    with pytest.raises(QualityError, match="no official date"):
        S.silver_drivers(bronze, trips.filter("false"))
    with pytest.raises(QualityError, match="no driver row"):
        S.silver_drivers(bronze, trips.withColumn(PARTITION, F.lit(dt.date(1999, 1, 1))))


def test_surrogate_key_is_unique(spark, small):
    from milepost.operators.conform import conform_events

    silver = S.silver_events(feeds.feed(spark, small, "events"), AS_OF)
    events = conform_events(silver, AS_OF)
    assert events.schema.names == WAREHOUSE["t_events"].names
    assert events.select("sk_event").distinct().count() == events.count()


def half(df, remainder):
    return df.filter(F.crc32("drive_id") % 2 == remainder)


def test_stream_equals_batch(spark, small, tmp_path):
    """Files arriving in two portions, several batches each, against one batch run."""
    landing, cleaned = str(tmp_path / "in"), str(tmp_path / "cleaned")
    feed = feeds.feed(spark, small, "events")
    for remainder in (0, 1):
        feeds.write_csv_feed(half(feed, remainder), landing)
        source = stream_bronze(spark, landing, BRONZE["events"], files_per_batch=40)
        ingest(source, lambda b: S.clean_events(b, AS_OF), cleaned, str(tmp_path / "progress"))
    streamed = latest_per_key(spark.read.parquet(cleaned).drop("_batch"), ["event_id"], S.NEWEST)
    batch = S.silver_events(read_bronze(spark, landing, BRONZE["events"]), AS_OF)
    assert rows(streamed.select(*batch.columns)) == rows(batch)


def test_stream_of_unseen_trips(spark, small, tmp_path):
    landing, silver = str(tmp_path / "in"), str(tmp_path / "silver")
    feed = feeds.feed(spark, small, "trips")
    for _ in range(2):  # the second portion repeats the first
        feeds.write_csv_feed(feed, landing)
        source = stream_bronze(spark, landing, BRONZE["trips"])
        ingest_unseen(
            source, lambda b: S.silver_trips(b).drop(SOURCE_FILE), silver, "drive_id",
            str(tmp_path / "progress"))
    expected = S.silver_trips(feed).filter("drive_id IS NOT NULL").drop(SOURCE_FILE)
    found = spark.read.parquet(silver)
    assert rows(found.select(*expected.columns)) == rows(expected)


def test_stream_of_trips_without_drive_id_equals_batch(spark, small, tmp_path):
    """Two portions with rows without a key, the last batch of them played twice."""
    landing, silver = str(tmp_path / "in"), str(tmp_path / "silver")
    feed = feeds.feed(spark, small, "trips").limit(400)
    keyed = F.when(F.crc32("drive_id") % 5 > 0, F.col("drive_id"))
    ids = write_once(feed.withColumn("part", F.crc32("drive_id") % 2).withColumn("drive_id", keyed), "halves")
    for part in (0, 1):
        feeds.write_csv_feed(ids.filter(F.col("part") == part).drop("part"), landing)
        source = stream_bronze(spark, landing, BRONZE["trips"])
        clean = lambda b: S.silver_trips(b).drop(SOURCE_FILE)
        ingest_unseen(source, clean, silver, "drive_id", str(tmp_path / "progress"))
    (tmp_path / "progress" / "commits" / "1").unlink()
    (tmp_path / "progress" / "commits" / ".1.crc").unlink(missing_ok=True)
    ingest_unseen(source, clean, silver, "drive_id", str(tmp_path / "progress"))
    batch = S.silver_trips(read_bronze(spark, landing, BRONZE["trips"])).drop(SOURCE_FILE)
    assert batch.filter("drive_id IS NULL").count() > 20
    assert rows(read_keyed(spark, silver).select(*batch.columns)) == rows(batch)


@pytest.mark.parametrize("name", MARTS)
def test_marts_from_stored_rollups(spark, fleet, stored_fleet, name):
    direct, shared = MARTS[name](fleet, AS_OF), MARTS[name](stored_fleet, AS_OF)
    digits = [
        F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in direct.dtypes
    ]
    assert direct.dtypes == shared.dtypes
    assert rows(direct.select(*digits)) == rows(shared.select(*digits))


@pytest.fixture(scope="module")
def stored_fleet(spark, fleet, tmp_path_factory):
    return store_rollups(spark, fleet, str(tmp_path_factory.mktemp("marts")))


def test_views_in_sql(spark, fleet):
    create_views(fleet, ["v_driver_keymap"], AS_OF)
    assert "v_driver_keymap" in VIEWS
    assert spark.sql("SELECT count(*) FROM v_driver_keymap").first()[0] == fleet.drivers.count()


def test_all_drivers_of_the_newest_month(fleet):
    from milepost.plans.economy import mv_driver_contribution

    one, every = mv_driver_contribution(fleet), mv_driver_contribution(fleet, all_drivers=True)
    assert every.count() > one.count()
    assert one.select("group_id", "vehicle_engine_type", "ym").exceptAll(
        every.select("group_id", "vehicle_engine_type", "ym").distinct()).count() == 0


@pytest.fixture(scope="module")
def bronze(spark, small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    trips = S.clean_trips(feeds.feed(spark, small, "trips"))
    official = {
        df.agg(F.max(PARTITION)).first()[0] for df in (trips, trips.filter("drive_id IS NOT NULL"))
    }
    for name in BRONZE:
        feed = feeds.feed(spark, small, name)
        if name != "drivers":
            feeds.write_csv_feed(feed, f"{root}/{name}")
            continue
        for day in official:
            file = F.lit(f"export_{day.year}_{day.month}_{day.day}_drivers.csv")
            feeds.write_csv_feed(feed.withColumn(SOURCE_FILE, file), f"{root}/{name}")
    return root


def test_pipeline(spark, small, bronze, tmp_path):
    out = str(tmp_path)
    dictionary, parameters = T.dictionary(spark), T.parameters(spark, small)
    paths = run_pipeline(spark, bronze, out, dictionary, parameters, AS_OF, database="fleet_test")
    assert len(paths) == 12
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    trips = read_version(spark, f"{out}/warehouse/t_trips")
    assert trips.schema.names == WAREHOUSE["t_trips"].names
    assert trips.filter("drive_id IS NULL").count() > 0
    assert all(spark.table(f"fleet_test.{name}").count() == n for name, n in counts.items())
    assert spark.table("fleet_test.t_trips").count() == trips.count()
    assert spark.table("v_driver_keymap").count() > 0
    for feed in ("events", "drivers", "trips"):
        expected = read_version(spark, f"{out}/silver/{feed}")
        named = spark.table(f"fleet_test.silver_{feed}").drop("version")
        assert named.count() == expected.count() and set(named.dtypes) == set(expected.dtypes)
    silver = load_silver(spark, bronze, out, AS_OF)  # a repeated run brings no new trips
    assert silver["trips"].count() == trips.count()
    full_out = str(tmp_path / "full")
    full_paths = run_pipeline(spark, bronze, full_out, dictionary, parameters, AS_OF, incremental_trips=False)
    for name in ("mv_fleet_safety_monthly", "mv_economy_offenders", "mv_group_safety_base"):
        assert counts[name] > 0
        assert rows(spark.read.parquet(paths[name])) == rows(spark.read.parquet(full_paths[name])), name
    spark.sql("DROP DATABASE fleet_test CASCADE")


def test_events_of_dates_gone_from_bronze_stay(spark, bronze, tmp_path):
    out = str(tmp_path)
    load_silver(spark, bronze, out, AS_OF)
    stored = read_version(spark, f"{out}/silver/events")
    old = stored.limit(1).withColumn(PARTITION, F.lit(dt.date(1980, 1, 1)))
    publish(write_once(old, "old-event"), f"{out}/silver/events", PARTITION, "dates")
    again = load_silver(spark, bronze, out, AS_OF)["events"]
    assert again.filter(F.col(PARTITION) == F.lit(dt.date(1980, 1, 1))).count() == 1


def test_quarantined_lines_do_not_reach_silver(spark, bronze, tmp_path):
    import shutil

    source = tmp_path / "bronze"
    shutil.copytree(bronze, source)
    (source / "groups" / "export_2026_1_1_group.csv").write_text(",".join(BRONZE["groups"].names) + "\n77\n")
    silver = load_silver(spark, str(source), str(tmp_path / "out"), AS_OF, quarantine=True)
    assert silver["groups"].count() > 0
    assert silver["groups"].filter("group_id = 77").count() == 0
    rejected = read_version(spark, f"{tmp_path}/out/rejected/groups").collect()
    assert [(r.line, r.reason) for r in rejected] == [("77", "too few fields")]


def test_input_bytes(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("12345")
    (tmp_path / "y.csv").write_text("123")
    assert input_bytes(spark, str(tmp_path)) == 8


def test_cleaning_compiles(spark, small, tmp_path):
    """Cleaned and conformed trips and events run as generated code."""
    for name, clean, shape in (("trips", S.clean_trips, conform_trips), ("events", S.clean_events, conform_events)):
        df = shape(clean(feeds.feed(spark, small, name)))
        stages = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
        text = stages.codegenString(df._jdf.queryExecution().executedPlan())
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(-?\d+)", text)]
        assert sizes and min(sizes) >= 0, (name, sizes)


def test_reference_tables(spark, tmp_path):
    (tmp_path / "p.csv").write_text("parametro,categoria,peso_impacto,acao_recomendada_final\nFadiga,Safety,8,b\n")
    row = load_parameters(spark, str(tmp_path / "p.csv")).first()
    assert (row.parametro, row.peso_impacto) == ("Fadiga", 8)
    path = str(tmp_path / "d")
    T.dictionary(spark).withColumn("impacto_resumido", F.lit("x")).write.parquet(path)
    assert load_dictionary(spark, path).count() == 8


def test_shuffle_partitions():
    from milepost.session import shuffle_partitions

    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(10 * 2**40) == 81920
