"""Runs that go on where they stopped, facts by month, newest rows in the state store."""

import contextlib
import dataclasses
import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from milepost import session
from milepost.operators.dedup import latest_per_key
from milepost.plans import pipeline, safety
from milepost.plans import silver as S
from milepost.schemas import BRONZE
from milepost.sources import facts, feeds
from milepost.sources import fingerprints as P
from milepost.sources import projection as T
from milepost.sources import versions
from milepost.sources.bronze import SOURCE_FILE, read_bronze
from milepost.sources.silver import PARTITION
from milepost.sources.versions import current, publish, read_version
from milepost.streaming.ingest import stream_bronze
from milepost.streaming.newest import ingest_newest, newest_in_state, read_newest
from tests.conftest import rows

AS_OF = T.AS_OF


@pytest.fixture(scope="module")
def bronze(spark, small, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    for name in BRONZE:
        feed = feeds.feed(spark, small, name)
        if name == "drivers":
            day = S.clean_trips(feeds.feed(spark, small, "trips")).agg(F.max(PARTITION)).first()[0]
            file = f"export_{day.year}_{day.month}_{day.day}_drivers.csv"
            feed = feed.withColumn(SOURCE_FILE, F.lit(file))
        feeds.write_csv_feed(feed, f"{root}/{name}")
    return root


def numbers(spark, out):
    found = {}
    for layer in ("silver", "warehouse", "marts"):
        for folder in sorted(Path(out, layer).iterdir()):
            found[f"{layer}/{folder.name}"] = current(spark, str(folder)).number
    return found


def test_a_stopped_run_goes_on(spark, small, bronze, tmp_path, monkeypatch):
    out = str(tmp_path)
    dictionary, parameters = T.dictionary(spark), T.parameters(spark, small)

    def run(**more):
        return pipeline.run_pipeline(spark, bronze, out, dictionary, parameters, AS_OF, resume=True, **more)

    class Stopped(Exception):
        pass

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "require_checkpoint", stop)
        with pytest.raises(Stopped):
            run()
    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "read_bronze", stop)
        paths = run()  # bronze is listed and not read
    first = numbers(spark, out)
    assert set(first.values()) == {1} and len(paths) == 12
    with monkeypatch.context() as patch:
        for name in ("read_bronze", "publish"):
            patch.setattr(pipeline, name, stop)
        assert run() == paths
    assert numbers(spark, out) == first

    # one more group file: groups and what is built on them are done again, nothing else
    header = ",".join(BRONZE["groups"].names)
    folder = Path(bronze, "groups", "file=export_2026_1_1_group.csv")
    folder.mkdir()
    (folder / "part-0.csv").write_text(f"{header}\n990,NEW,1,x,1,y\n")
    run()
    changed = {name for name, number in numbers(spark, out).items() if number != first[name]}
    marts = {name for name in first if name.startswith("marts/")}
    assert changed == {"silver/groups", "warehouse/d_groups"} | marts
    assert read_version(spark, f"{out}/warehouse/d_groups").filter("group_id = 990").count() == 1
    # another run date is another input
    later = AS_OF + dt.timedelta(days=1)
    pipeline.load_silver(spark, bronze, out, later, resume=True)
    assert current(spark, f"{out}/silver/trips").number == 1
    assert current(spark, f"{out}/silver/events").number == 2


def test_fingerprints(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    b = spark.createDataFrame([(2, None), (1, "x"), (2, None)], "k int, v string")
    assert P.of_rows(a) == P.of_rows(b) != P.of_rows(b.distinct())
    assert P.of_rows(a.limit(0)) == P.of_rows(b.limit(0)) != P.of_rows(a)
    path = str(tmp_path / "t")
    assert not P.is_finished(spark, path, "f")
    publish(a, path, fingerprint="f")
    before = P.of_version(spark, path)
    assert P.is_finished(spark, path, "f") and not P.is_finished(spark, path, "g")
    publish(a, path)  # a load that names no inputs finishes nothing
    assert not P.is_finished(spark, path, "f") and not P.is_finished(spark, path, "")
    assert P.of_version(spark, path) != before
    files = tmp_path / "files"
    files.mkdir()
    (files / "a.csv").write_text("1")
    one = P.of_files(spark, str(files))
    assert one == P.of_files(spark, str(files))
    (files / "b.csv").write_text("1")
    assert one != P.of_files(spark, str(files))


def test_months_since_the_bound_are_read(spark, fleet, tmp_path):
    path = str(tmp_path)
    facts.store_by_month(fleet.trips, path, "end_drive")
    assert read_version(spark, path).schema.names == fleet.trips.columns
    stored = dataclasses.replace(fleet, trips=facts.read_by_month(spark, path))
    assert rows(read_version(spark, path)) == rows(fleet.trips)
    months = safety.driver_safety_months(stored, AS_OF)
    assert rows(months) == rows(safety.driver_safety_months(fleet, AS_OF))
    assert months.count() > 0
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*p_month", plan)
    read = {re.search("p_month=([^/]+)", f).group(1) for f in facts.since(
        stored.trips, "end_drive", F.add_months(F.lit(AS_OF), -2)).select(
        F.col("_metadata.file_path").alias("f")).distinct().toPandas()["f"]}
    everything = {p.name for p in Path(path).rglob("p_month=*")}
    assert 0 < len(read) <= 3 < len(everything)


def test_rows_without_a_time_and_no_rows(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, CAST(NULL AS TIMESTAMP_NTZ) AS t UNION ALL SELECT 2, TIMESTAMP_NTZ'2026-01-31 23:59:59'")
    for name, given in (("some", df), ("none", df.limit(0))):
        facts.store_by_month(given, str(tmp_path / name), "t")
        stored = facts.read_by_month(spark, str(tmp_path / name))
        assert rows(stored.drop(facts.MONTH)) == rows(given)
        assert rows(facts.since(stored, "t", F.lit(dt.date(2026, 1, 15))).select("id")) == rows(given.filter("id = 2").select("id"))


def test_state_equals_the_batch(spark):
    df = spark.sql("""
        SELECT CASE WHEN id % 3 = 0 THEN 0 WHEN id % 31 = 1 THEN NULL ELSE id % 17 END AS k,
               DATE'2026-01-01' + CAST(id % 5 AS INT) AS day, CASE WHEN id % 7 = 0 THEN NULL ELSE concat('f', id % 4) END AS f,
               CASE WHEN id % 2 = 0 THEN id END AS v FROM range(600)""")
    assert rows(newest_in_state(df, ["k"], ["day", "f"])) == rows(latest_per_key(df, ["k"], ["day", "f"]))
    assert newest_in_state(df.limit(0), ["k"], ["day", "f"]).count() == 0


def test_files_out_of_order_and_a_replay(spark, tmp_path):
    landing, changed, progress = (str(tmp_path / n) for n in ("landing", "changed", "progress"))
    names = BRONZE["events"].names

    def arrive(day, speeds):
        folder = Path(landing, f"file=export_2026_01_{day:02d}_events.csv")
        folder.mkdir(parents=True, exist_ok=True)
        lines = [",".join(str({"event_id": k, "speed": s}.get(n, "")) for n in names) for k, s in speeds]
        (folder / f"part-{len(list(folder.iterdir()))}.csv").write_text("\n".join([",".join(names), *lines]) + "\n")

    def ingest():
        source = stream_bronze(spark, landing, BRONZE["events"])
        ingest_newest(source, lambda b: S.clean_events(b, AS_OF), ["event_id"], S.NEWEST, changed, progress)
        stored = read_newest(spark, changed, ["event_id"], S.NEWEST)
        assert stored.count() == stored.select("event_id").distinct().count()
        return {r.event_id: r.speed for r in stored.collect()}

    arrive(10, [(1, 10), (2, 10), ("", 10)])
    assert ingest() == {1: 10, 2: 10, None: 10}
    arrive(20, [(2, 20), (3, 20)])
    assert ingest() == {1: 10, 2: 20, 3: 20, None: 10}
    arrive(5, [(1, 5), (2, 5), (4, 5)])  # late: older rows change nothing, new keys come in
    expected = {1: 10, 2: 20, 3: 20, 4: 5, None: 10}
    assert ingest() == expected
    # a batch without its commit is run again
    commits = sorted(p for p in Path(progress, "commits").iterdir() if p.name.isdigit())
    for kept in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        kept.unlink(missing_ok=True)
    assert ingest() == expected
    batch = S.silver_events(spark.read.schema(BRONZE["events"]).option("header", True).option(
        "recursiveFileLookup", True).csv(landing).withColumn(SOURCE_FILE, F.input_file_name()), AS_OF)
    assert {r.event_id: r.speed for r in batch.collect()} == expected


def test_feeds_are_packed_and_need_no_shuffle(spark, small, tmp_path):
    feed = feeds.feed(spark, small, "trips")
    found = []
    for gather in (True, False):
        path = str(tmp_path / str(gather))
        feeds.write_csv_feed(feed, path, gather)
        assert all(p.name.endswith(".csv.gz") for p in Path(path).rglob("part-*"))
        found.append(rows(S.clean_trips(read_bronze(spark, path, BRONZE["trips"])).drop(SOURCE_FILE)))
    assert found[0] == found[1] and len(found[0]) == feed.count()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_date_of_a_file_is_read_once(spark, tmp_path):
    """The run sends the dates of the files to their rows, with what each path gives for itself."""
    files = [f"export_2024_{m}_02_events.csv" for m in (1, 13)] + ["export_events.csv", "a b_2024_03_01%20.csv"]
    rows_of = spark.range(12).select(
        *[(F.col("id").cast("string") if c == "event_id" else F.lit(None).cast("string")).alias(c) for c in BRONZE["events"].names],
        F.element_at(F.array(*[F.lit(f) for f in files]), (F.col("id") % 4 + 1).cast("int")).alias(SOURCE_FILE),
    )
    path = str(tmp_path / "events")
    feeds.write_csv_feed(rows_of, path)
    raw = read_bronze(spark, path, BRONZE["events"])
    dated = S.with_file_dates(raw, path, "events")
    assert dated.filter(F.col(S.FILE_DATE).isNotNull()).count() == 12
    unlisted = raw.withColumn(S.FILE_DATE, F.lit(None).cast("struct<date: date>"))
    expected = rows(S.clean_events(raw, AS_OF))
    assert len(expected) == 12 and {r[-1] for r in expected} == {dt.date(2024, 1, 2), dt.date(2024, 3, 1), AS_OF}
    for df in (dated, unlisted):
        assert rows(S.clean_events(df, AS_OF)) == expected
        assert S.clean_events(df, AS_OF).columns == S.clean_events(raw, AS_OF).columns


def test_wide_work_runs_in_compiled_methods(spark, small, tmp_path, monkeypatch):
    """Also where the session has Spark's own limit: writing a feed, silver and the warehouse."""
    limits = []
    for module in (feeds, versions, session):
        kept = module.compiled_methods

        @contextlib.contextmanager
        def noted(spark, kept=kept):
            with kept(spark):
                limits.append(spark.conf.get(session.METHOD_LIMIT))
                yield

        monkeypatch.setattr(module, "compiled_methods", noted)
    spark.conf.set(session.METHOD_LIMIT, 65535)
    try:
        trips = feeds.feed(spark, small, "trips").limit(50)
        feeds.write_csv_feed(trips, str(tmp_path / "csv"))
        publish(S.clean_trips(trips), str(tmp_path / "whole"))
        publish(S.clean_trips(trips), str(tmp_path / "dated"), PARTITION)
        session.write_once(trips, "limits")
        assert spark.conf.get(session.METHOD_LIMIT) == "65535"
    finally:
        spark.conf.set(session.METHOD_LIMIT, session.DEFAULTS[session.METHOD_LIMIT])
    assert limits == ["8000"] * 4


def test_the_text_of_a_day_is_made_once(spark, small):
    """A feed says the same rows as its SQL without repeating the cast of a date in each text."""
    for name, date in (("events", "l_shipdate"), ("trips", "o_orderdate")):
        plan = feeds.feed(spark, small, name)._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(rf"cast\((?:cast\()?{date}", plan)) == 1


def test_rows_near_their_month_are_written_where_they_are_read(spark, tmp_path):
    """Folders of few months are not shuffled by month; one folder with all months is."""
    days = spark.range(720).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("day"))
    near = facts.with_month(days.withColumn(PARTITION, F.trunc("day", "quarter")), "day")
    mixed = facts.with_month(days.withColumn(PARTITION, F.lit(dt.date(2024, 1, 1))), "day")
    assert facts.lies_by_month(near, PARTITION) and not facts.lies_by_month(mixed, PARTITION)
    assert facts.lies_by_month(near.limit(0), PARTITION)
    for df, gather in ((near, False), (mixed, True)):
        path = str(tmp_path / str(gather))
        publish(df, path, facts.MONTH, hidden=True, gather=gather)
        stored = facts.read_by_month(spark, path)
        assert rows(stored.select(*df.columns)) == rows(df)
