"""The data-lake load: JSON sources to five parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starlog.operators.filters import PLAY_PAGE
from starlog.plans import star
from starlog.sinks.files import materialise_as, write_parquet, write_small_directories
from starlog.sources.files import read_small_directories

LAYOUTS = {"year_and_artist": ("year", "artist_id"), "year": ("year",)}
TABLES = ("songs", "artists", "users", "time", "songplay")


def write_lake(
    log: DataFrame,
    song_data: DataFrame,
    out: str,
    songs_layout: str = "year_and_artist",
    page: str = PLAY_PAGE,
) -> None:
    """Write songs, artists, users, time and songplay below `out`.

    The sources are converted to parquet once, so that the five tables parse no JSON and read only
    their own columns. `songs_layout="year"` avoids the small files of one directory per artist.
    """
    log, song_data = (
        materialise_as(source, f"{out}/staging/{name}", f"staged_{name}")
        for name, source in (("log", log), ("songs", song_data))
    )
    write_songs = write_small_directories if songs_layout == "year_and_artist" else write_parquet
    write_songs(star.songs(song_data), f"{out}/songs", by=LAYOUTS[songs_layout])
    write_parquet(star.artists(song_data), f"{out}/artists")
    write_parquet(star.users(log, page=page), f"{out}/users")
    write_parquet(star.time_lake(log, page), f"{out}/time", by=("year", "month"))
    write_parquet(star.plays_by_artist(log, song_data, page=page), f"{out}/songplay", by=("year", "month"))


def read_lake(spark: SparkSession, out: str, songs_layout: str = "year_and_artist") -> dict[str, DataFrame]:
    """The five tables by name, as `write_lake` left them below `out`."""
    tables = {name: spark.read.parquet(f"{out}/{name}") for name in TABLES if name != "songs" or songs_layout != "year_and_artist"}
    if songs_layout == "year_and_artist":
        schema = spark.read.parquet(f"{out}/staging/songs").select(*star.SONG_COLUMNS).schema
        tables["songs"] = read_small_directories(spark, f"{out}/songs", schema, LAYOUTS[songs_layout])
    return {name: tables[name] for name in TABLES}
