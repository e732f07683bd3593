"""The whole run: bronze CSV, silver, gate, warehouse, marts."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from milepost.operators.conform import CONFORM
from milepost.operators.quality import require_checkpoint
from milepost.plans import silver as S
from milepost.plans.marts import create_views, refresh_marts
from milepost.schemas import BRONZE, Fleet
from milepost.session import build_session, shuffle_partitions
from milepost.sources.bronze import SOURCE_FILE, read_bronze, read_checked
from milepost.sources.reference import load_dictionary, load_parameters
from milepost.sources.facts import MONTH, MONTHS, lies_by_month, with_month
from milepost.sources.fingerprints import fingerprint, is_finished, of_files, of_rows, of_version
from milepost.sources.key_index import append_indexed, read_indexed, replace_indexed
from milepost.sources.silver import PARTITION, register_table, register_version
from milepost.sources.versions import expire, publish, read_version, version_folders


def load_silver(
    spark: SparkSession,
    bronze: str,
    out: str,
    as_of: dt.date | None = None,
    incremental_trips: bool = True,
    quarantine: bool = False,
    resume: bool = False,
) -> dict[str, DataFrame]:
    """Bronze to silver, each table published as a new version.

    With ``resume`` a feed whose files and settings are those of its current version is not read
    again (see ``fingerprints``).

    With ``quarantine`` malformed lines do not reach silver; they are published with their reasons
    as ``rejected/<feed>``. Otherwise missing fields are NULL and extra ones are left out.

    Trips come first because drivers take their date from them. They are appended through their
    key index; those without a drive id replace what the same files brought before.
    """

    def raw(feed: str) -> DataFrame:
        files = f"{bronze}/{feed}"
        if not quarantine:
            return S.with_file_dates(read_bronze(spark, files, BRONZE[feed]), files, feed)
        good, rejected = read_checked(spark, files, BRONZE[feed])
        publish(rejected, f"{out}/rejected/{feed}")
        return S.with_file_dates(good, files, feed)

    def path(feed: str) -> str:
        return f"{out}/silver/{feed}"

    def unfinished(feed: str, *settings: object) -> str | None:
        """The fingerprint of a feed that has to be loaded, or None."""
        mark = fingerprint(of_files(spark, f"{bronze}/{feed}"), quarantine, *settings)
        return None if resume and is_finished(spark, path(feed), mark) else mark

    day = run_date(spark, as_of)
    if mark := unfinished("trips", incremental_trips):
        trips = S.silver_trips(raw("trips"))
        if incremental_trips:
            append_indexed(spark, trips, path("trips"), "drive_id", origin=SOURCE_FILE, fingerprint=mark)
        else:
            replace_indexed(spark, trips, path("trips"), "drive_id", fingerprint=mark)
    for feed, build in (
        ("groups", S.silver_groups), ("schemes", S.silver_schemes), ("vehicles", S.silver_vehicles),
    ):
        if mark := unfinished(feed, day):
            rows = build(raw(feed), as_of).drop(SOURCE_FILE)
            publish(rows, path(feed), PARTITION, fingerprint=mark)
    if mark := unfinished("events", day):
        # events of dates that bronze no longer holds stay
        rows = S.silver_events(raw("events"), as_of).drop(SOURCE_FILE)
        publish(rows, path("events"), PARTITION, "dates", fingerprint=mark)

    stored = {"trips": read_indexed(spark, path("trips")).drop(SOURCE_FILE)}
    if mark := unfinished("drivers", of_version(spark, path("trips"))):
        publish(S.silver_drivers(raw("drivers"), stored["trips"]), path("drivers"), PARTITION, fingerprint=mark)
    return stored | {feed: read_version(spark, path(feed)) for feed in BRONZE if feed != "trips"}


def load_warehouse(
    spark: SparkSession,
    silver: dict[str, DataFrame],
    out: str,
    as_of: dt.date | None = None,
    resume: bool = False,
) -> dict[str, DataFrame]:
    """Silver to warehouse, every table replaced by a new version, dimensions before facts.

    Facts lie in folders by month (``MONTHS``), so that a look back over some months lists and
    reads no others. With ``resume`` tables of an unchanged silver table stay as they are.
    """
    tables = {}
    for name, (feed, build) in CONFORM.items():
        path = f"{out}/warehouse/{name}"
        dated = name in ("d_schemes", "t_events")
        settings = [run_date(spark, as_of)] if dated else []
        mark = fingerprint(of_version(spark, f"{out}/silver/{feed}"), *settings)
        month = MONTH if name in MONTHS else None
        if not (resume and is_finished(spark, path, mark)):
            df = build(silver[feed], as_of) if dated else build(silver[feed])
            if month:
                df = with_month(df, MONTHS[name])
            # silver lies by source date: where that follows the month, rows stay with their task
            gather = not (month and lies_by_month(df, PARTITION))
            publish(df, path, month, fingerprint=mark, hidden=True, gather=gather)
        tables[name] = read_version(spark, path, layout=month)
    return tables


def run_pipeline(
    spark: SparkSession,
    bronze: str,
    out: str,
    dictionary: DataFrame,
    parameters: DataFrame,
    as_of: dt.date | None = None,
    incremental_trips: bool = True,
    database: str | None = None,
    quarantine: bool = False,
    resume: bool = False,
) -> dict[str, str]:
    """Run all layers and return the folders that hold the current marts.

    With ``database`` silver (as ``silver_<feed>``), warehouse tables and marts can be read by
    name there afterwards, and the views exist in the session. Whatever fails on the way,
    readers keep the versions before; those are removed when the run is through, but for one.

    With ``resume`` a run goes on where one with the same inputs stopped: tables whose inputs did
    not change are neither computed nor read for more than what depends on them.
    """
    silver = load_silver(spark, bronze, out, as_of, incremental_trips, quarantine, resume)
    require_checkpoint(spark, silver)
    tables = load_warehouse(spark, silver, out, as_of, resume)
    fleet = Fleet(
        trips=tables["t_trips"],
        events=tables["t_events"],
        drivers=tables["d_drivers"],
        groups=tables["d_groups"],
        vehicles=tables["d_vehicles"],
        schemes=tables["d_schemes"],
        event_dictionary=dictionary,
        parameters=parameters,
    )
    mark = fingerprint(
        *[of_version(spark, f"{out}/warehouse/{name}") for name in CONFORM],
        of_rows(dictionary), of_rows(parameters), run_date(spark, as_of),
    )
    paths = refresh_marts(spark, fleet, f"{out}/marts", as_of=as_of, fingerprint=mark, resume=resume)
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name in CONFORM:
            if name in MONTHS:
                register_version(spark, f"{database}.{name}", f"{out}/warehouse/{name}", partition=MONTH)
            else:
                register_table(spark, f"{database}.{name}", version_folders(spark, f"{out}/warehouse/{name}")[0])
        for name, path in paths.items():
            register_table(spark, f"{database}.{name}", path)
        for feed in BRONZE:
            register_version(spark, f"{database}.silver_{feed}", f"{out}/silver/{feed}")
        create_views(fleet, as_of=as_of)
    for table in [f"silver/{f}" for f in BRONZE] + [f"warehouse/{n}" for n in CONFORM] + [f"marts/{n}" for n in paths]:
        expire(spark, f"{out}/{table}", keep=2)
    return paths


def run_date(spark: SparkSession, as_of: dt.date | None) -> dt.date:
    """The given date or, as in the plans, the session's current one."""
    return as_of or spark.range(1).select(F.current_date()).first()[0]


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder; only their listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def main(argv: list[str] | None = None) -> None:
    """``spark-submit`` entry: bronze folder, output folder and the two reference tables."""
    args = argparse.ArgumentParser(description=main.__doc__)
    args.add_argument("--bronze", required=True)
    args.add_argument("--out", required=True)
    args.add_argument("--dictionary", required=True)
    args.add_argument("--parameters", required=True)
    args.add_argument("--as-of", type=dt.date.fromisoformat)
    args.add_argument("--full-trips", action="store_true")
    args.add_argument("--quarantine", action="store_true", help="keep malformed lines out of silver")
    args.add_argument("--resume", action="store_true", help="go on where a run with the same inputs stopped")
    args.add_argument("--database", help="register tables and marts there")
    given = args.parse_args(argv)
    spark = build_session("milepost-pipeline")
    partitions = shuffle_partitions(input_bytes(spark, given.bronze))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    run_pipeline(
        spark, given.bronze, given.out,
        load_dictionary(spark, given.dictionary), load_parameters(spark, given.parameters),
        given.as_of, not given.full_trips, given.database, given.quarantine, given.resume,
    )


if __name__ == "__main__":
    main()
