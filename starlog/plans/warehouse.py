"""The warehouse load and the scheduled load: stage, fact, dimensions, quality gate."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlog import schemas
from starlog.functions.values import drop_fraction
from starlog.operators import quality
from starlog.operators.filters import PLAY_PAGE
from starlog.plans import star
from starlog.schemas import conform
from starlog.sinks.files import stage, write_parquet
from starlog.sinks.ledger import RunLedger
from starlog.sinks.tables import VersionedTables, append_new
from starlog.sources import loading
from starlog.sources.files import read_path_mapping

#: What tells two plays apart: their md5 key alone repeats within one second of a session.
PLAY_KEY = ["playid", "item", "userid", "songid"]

# Column names of the scheduled tables, by their names in the sources (fixed values).
NAMES = {
    "user_id": "userid",
    "song_id": "songid",
    "artist_id": "artistid",
    "artist_name": "name",
    "artist_location": "location",
    "artist_latitude": "lattitude",
    "artist_longitude": "longitude",
}


#: The dimensions of the scheduled star, which change over together.
DIMENSIONS = ("users", "songs", "artists", "time")


def dimensions(spark: SparkSession, out: str) -> VersionedTables:
    """The dimensions of the scheduled star below `out`."""
    return VersionedTables(spark, f"{out}/dimensions")


def load_star(
    spark: SparkSession,
    log: DataFrame,
    song_data: DataFrame,
    out: str,
    run_time: datetime,
    page: str = PLAY_PAGE,
    fraction: str = "truncate",
    again: bool = False,
) -> DataFrame:
    """Load the scheduled star schema below `out` and return the passed quality results.

    Sources are staged once and read back, the fact is appended by PLAY_KEY, the dimensions are
    written as a new version, every table must hold rows, and only then the dimensions change over, all at once.
    A ledger keeps the finished steps of the run time, so that a run that failed is taken up at the step it failed in; with
    `again` all steps run anew, which adds no fact twice. The
    staged lengths and coordinates lose their fraction as `fraction` says.
    """
    ledger = RunLedger(spark, f"{out}/runs", f"{run_time:%Y-%m-%d-%H}")
    if again:
        ledger.forget()
    template = f"{out}/staging/{{table}}/{{execution_date:%Y-%m-%d-%H}}"
    whole = {c: drop_fraction(F.col(c), fraction) for c in ("duration", "artist_latitude", "artist_longitude")}
    sources = {"events": log, "songs": song_data.withColumns(whole)}
    log, song_data = (
        spark.read.parquet(ledger.step(f"stage-{name}", lambda: stage(source, template, run_time, table=name)))
        for name, source in sources.items()
    )

    plays = star.plays_scheduled(log, song_data, fraction, page, with_item=True)
    plays = conform(plays, T.StructType([*schemas.SCHEDULED_PLAYS.schema.fields, T.StructField("item", T.IntegerType())]))
    plays = plays.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
    ledger.step("append-songplays", lambda: append_new(plays, f"{out}/songplays", PLAY_KEY, by=("year", "month")))
    fact = spark.read.schema(plays.schema).parquet(f"{out}/songplays")

    users = star.users(log, "distinct", numeric_id=True, page=page)
    fresh = {
        "users": conform(users.withColumnsRenamed(NAMES), schemas.SCHEDULED_USERS),
        "songs": conform(star.songs(song_data, "distinct").withColumnsRenamed(NAMES), schemas.SCHEDULED_SONGS),
        "artists": conform(star.artists(song_data, "distinct").withColumnsRenamed(NAMES), schemas.SCHEDULED_ARTISTS),
        "time": conform(star.time_scheduled(fact), schemas.SCHEDULED_TIME),
    }
    tables = dimensions(spark, out)
    version = ledger.step("begin-dimensions", tables.begin)
    for name in DIMENSIONS:
        ledger.step(f"load-{name}", lambda: tables.write(version, name, fresh[name]))

    written = {"songplays": fact} | {name: tables.read(name, version) for name in DIMENSIONS}
    checks = quality.require(quality.run_checks([quality.row_count(name, table) for name, table in written.items()]))
    ledger.step("change-over", lambda: tables.finish(version))
    return checks


def load_warehouse(
    spark: SparkSession,
    log_path: str,
    mapping_path: str,
    song_path: str,
    out: str,
    page: str = PLAY_PAGE,
    started: datetime | None = None,
    max_rejected: int | None = None,
) -> dict[str, DataFrame]:
    """Load the warehouse star below `out` and return its tables.

    The log is staged through a mapping file and the songs by name; lines that do not fit are told in the
    error table `load_errors`, and more than `max_rejected` of them stop the load. Then the five tables are replaced:
    plays of catalogued artists numbered from 0, each user's latest rows, distinct songs and artists, and
    the times of plays.
    """
    started = started or datetime.now(timezone.utc)
    errors = loading.ErrorTable(spark, f"{out}/load_errors")
    checked = {
        "staging_events": loading.json_mapped(spark, log_path, read_path_mapping(spark, mapping_path), schemas.STAGED_EVENTS),
        "staging_songs": loading.json_by_name(spark, song_path, schemas.STAGED_SONGS),
    }
    log, songs = (
        loading.load(rows, f"{out}/{name}", errors, name, started, max_rejected) for name, rows in checked.items()
    )
    tables = {
        "songplays": star.with_serial(star.plays_by_artist(log, songs, True, page, with_item=True), start=0),
        "users": star.users(log, "latest", numeric_id=True, page=page),
        "songs": star.songs(songs, "distinct"),
        "artists": star.renamed_artists(star.artists(songs, "distinct")),
        "time": star.time_warehouse(log, page),
    }
    for name, table in tables.items():
        write_parquet(table, f"{out}/{name}")
    return {name: spark.read.parquet(f"{out}/{name}") for name in tables}
