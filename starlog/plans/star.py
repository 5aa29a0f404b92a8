"""Star schema of the activity log: songs, artists, users, time and plays.

The tables exist under several rules, each a parameter value here:

* relational: one row per key as first seen, user level replaced, at most one song per play
* warehouse / lake: distinct or lowest rows, users at their latest play, plays joined on artist name
* scheduled: distinct rows, plays joined on title, artist and whole-second length, md5 key
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlog.functions.calendar import (
    calendar_parts,
    from_epoch_ms,
    from_epoch_ms_whole_seconds,
)
from starlog.functions.values import drop_fraction, md5_key, user_number
from starlog.operators import quality
from starlog.operators.dedupe import first_and_last, first_row_per_key, latest_rows
from starlog.operators.filters import PLAY_PAGE, on_page
from starlog.operators.joins import join_resplit, lookup_at_most_one
from starlog.operators.windows import number_rows
from starlog.schemas import ARTISTS, PLAYS, SONGS, TIME, USERS, conform

SONG_COLUMNS = ["song_id", "title", "artist_id", "year", "duration"]
ARTIST_COLUMNS = ["artist_id", "artist_name", "artist_location", "artist_latitude", "artist_longitude"]


def songs(song_data: DataFrame, rule: str = "lowest_artist", order: list[Column] | None = None) -> DataFrame:
    """Songs: `lowest_artist` row per song_id, `distinct` rows, or `first_seen` along `order`."""
    table = song_data.select(*SONG_COLUMNS)
    if rule == "distinct":
        return table.distinct()
    if rule == "lowest_artist":
        rows = table.where(F.col("song_id").isNotNull())
        return first_row_per_key(rows, ["song_id"], [F.col("artist_id").asc_nulls_last()])
    if rule == "first_seen":
        rows = song_data.where(F.col("song_id").isNotNull())
        return first_row_per_key(rows, ["song_id"], order or []).select(*SONG_COLUMNS)
    raise ValueError(f"unknown rule {rule!r}")


def artists(song_data: DataFrame, rule: str = "one_per_id", order: list[Column] | None = None) -> DataFrame:
    """Artists: `one_per_id` (lowest remaining columns), `distinct` rows, or `first_seen` along `order`."""
    table = song_data.select(*ARTIST_COLUMNS)
    if rule == "distinct":
        return table.distinct()
    if rule == "one_per_id":
        return first_row_per_key(table.where(F.col("artist_id").isNotNull()), ["artist_id"], [])
    if rule == "first_seen":
        rows = song_data.where(F.col("artist_id").isNotNull())
        return first_row_per_key(rows, ["artist_id"], order or []).select(*ARTIST_COLUMNS)
    raise ValueError(f"unknown rule {rule!r}")


def renamed_artists(table: DataFrame) -> DataFrame:
    return table.withColumnsRenamed({c: c.removeprefix("artist_") for c in ARTIST_COLUMNS[1:]})


def users(
    log: DataFrame,
    rule: str = "latest",
    numeric_id: bool = False,
    order: list[str] | None = None,
    page: str = PLAY_PAGE,
) -> DataFrame:
    """Users who played: rows at each user's `latest` play, `distinct` profiles, or `upserted`.

    `upserted` keeps the names as first seen along `order` and the level as last seen.
    """
    user_id = user_number(F.col("userId")) if numeric_id else F.col("userId")
    order = order or ["ts"]
    plays = on_page(log, page).select(
        user_id.alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        *order,
    )
    profile = ["first_name", "last_name", "gender"]
    if rule == "latest":
        return latest_rows(plays, "user_id", order[0], [*profile, "level"])
    if rule == "distinct":
        return plays.select("user_id", *profile, "level").distinct()
    if rule == "upserted":
        return first_and_last(plays, "user_id", order, profile, ["level"])
    raise ValueError(f"unknown rule {rule!r}")


def time_lake(log: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """One row per distinct play timestamp, with its date; weekday 0 is Monday."""
    stamps = on_page(log, page).select(from_epoch_ms(F.col("ts")).alias("time_stamp"))
    stamps = stamps.where(F.col("time_stamp").isNotNull()).distinct()
    ts = F.col("time_stamp")
    return stamps.select(ts, F.to_date(ts).alias("date"), *[c.alias(n) for n, c in calendar_parts(ts).items()])


def time_relational(log: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """One row per play time in epoch ms; weekday 0 is Monday."""
    ts = from_epoch_ms(F.col("start_time"))
    times = on_page(log, page).select(F.col("ts").alias("start_time")).where(F.col("start_time").isNotNull()).distinct()
    return times.select("start_time", *[c.alias(n) for n, c in calendar_parts(ts).items()])


def time_warehouse(log: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """One row per play time in epoch ms, parts taken from its whole second; weekday 0 is Sunday."""
    ts = from_epoch_ms_whole_seconds(F.col("start_time"))
    times = on_page(log, page).select(F.col("ts").alias("start_time")).distinct()
    return times.select("start_time", *[c.alias(n) for n, c in calendar_parts(ts, "sunday").items()])


def time_scheduled(plays: DataFrame) -> DataFrame:
    """One row per play of the fact table (no distinct); month and weekday as text, weekday 0 is Sunday."""
    ts = F.col("start_time")
    parts = calendar_parts(ts, "sunday")
    parts |= {name: parts[name].cast("string") for name in ("month", "weekday")}
    return plays.select(ts, *[c.alias(n) for n, c in parts.items()])


def plays_by_artist(
    log: DataFrame, song_data: DataFrame, numeric_id: bool = False, page: str = PLAY_PAGE, with_item: bool = False
) -> DataFrame:
    """Plays of catalogued artists: one row per play and song of the artist, with month and year.

    `with_item` adds the item in the session, which `with_serial` takes.
    """
    plays = on_page(log, page)
    catalogue = song_data.select("song_id", "artist_id", F.col("artist_name").alias("artist"))
    ts = from_epoch_ms(F.col("ts"))
    return plays.join(catalogue, "artist").select(
        F.col("ts").alias("start_time"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        (user_number(F.col("userId")) if numeric_id else F.col("userId")).alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        *([F.col("itemInSession").alias("_item")] if with_item else []),
    )


def plays_scheduled(
    log: DataFrame, song_data: DataFrame, fraction: str = "truncate", page: str = PLAY_PAGE, with_item: bool = False
) -> DataFrame:
    """All plays with the songs of equal title, artist and whole-second length, keyed by md5.

    `fraction` says how lengths lose their fraction: `truncate` or `round`. The key repeats for two plays
    of one session and second; `with_item` adds the item in the session, which tells them apart.
    """
    plays = on_page(log, page).select(
        "*",
        from_epoch_ms_whole_seconds(F.col("ts")).alias("start_time"),
        drop_fraction(F.col("length"), fraction).alias("_length"),
    )
    catalogue = song_data.select(
        F.col("title").alias("song"),
        F.col("artist_name").alias("artist"),
        drop_fraction(F.col("duration"), fraction).alias("_length"),
        "song_id",
        "artist_id",
    )
    return plays.join(catalogue, ["song", "artist", "_length"], "left").select(
        md5_key(F.col("sessionId"), F.col("start_time")).alias("playid"),
        "start_time",
        user_number(F.col("userId")).alias("userid"),
        "level",
        F.col("song_id").alias("songid"),
        F.col("artist_id").alias("artistid"),
        F.col("sessionId").alias("sessionid"),
        "location",
        F.col("userAgent").alias("user_agent"),
        *([F.col("itemInSession").alias("item")] if with_item else []),
    )


def song_lookup(song_table: DataFrame, artist_table: DataFrame) -> DataFrame:
    """Songs joined with their artists, as searched by play lookups."""
    names = artist_table.select("artist_id", F.col("artist_name").alias("name"))
    return join_resplit(song_table.select("song_id", "title", "duration", "artist_id"), names, ["artist_id"], "inner")


def exact_length(number: Column) -> Column:
    """A length as decimal, so that equal texts compare equal."""
    return number.try_cast("decimal(18,5)")


def plays_relational(log: DataFrame, lookup: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """All plays, each with at most one song of equal title, artist and length (lowest song_id)."""
    plays = on_page(log, page).withColumn("_length", exact_length(F.col("length")))
    keyed = lookup.select(
        F.col("title").alias("song"),
        F.col("name").alias("artist"),
        exact_length(F.col("duration")).alias("_length"),
        "song_id",
        "artist_id",
    )
    found = lookup_at_most_one(
        plays, keyed, ["song", "artist", "_length"], [F.col("song_id").asc()], ["song_id", "artist_id"]
    )
    return found.select(
        F.col("ts").alias("start_time"),
        user_number(F.col("userId")).alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        F.col("itemInSession").alias("_item"),
    )


def relational_star(
    log: DataFrame, song_data: DataFrame, page: str = PLAY_PAGE, arrival: list[Column] | None = None
) -> dict[str, DataFrame]:
    """The five tables under the relational rules, in the shape of their contracts.

    `arrival` orders the song data as it arrived, for a load in which the first row of a song or artist
    wins; without it the lowest row does.
    """
    if arrival:
        song_table, artist_table = songs(song_data, "first_seen", arrival), artists(song_data, "first_seen", arrival)
    else:
        song_table, artist_table = songs(song_data), artists(song_data)
    plays = plays_relational(log, song_lookup(song_table, artist_table), page)
    return {
        "users": conform(users(log, "upserted", numeric_id=True, page=page), USERS),
        "songs": conform(song_table, SONGS),
        "artists": conform(renamed_artists(artist_table), ARTISTS),
        "time": conform(time_relational(log, page), TIME),
        "songplays": conform(with_serial(plays), PLAYS),
    }


def star_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """The NOT NULL, key and reference checks that the tables' contracts declare.

    Every check reads its table, so pass tables that are stored.
    """
    contracts = {c.name: c for c in (USERS, SONGS, ARTISTS, TIME, PLAYS)}
    parents = {name: (table, contracts[name].key[0]) for name, table in tables.items()}
    return quality.run_checks(
        [check for name, table in tables.items() for check in quality.contract_checks(table, contracts[name], parents)]
    )


def with_serial(plays: DataFrame, start: int = 1) -> DataFrame:
    """Number the plays by time, session and item; the item column leaves the table."""
    numbered = number_rows(plays, ["start_time", "session_id", "_item", "user_id", "song_id"], "songplay_id", start)
    return numbered.select("songplay_id", *[c for c in plays.columns if c != "_item"])
