"""Compacted event file, its lookups, and log wrangling reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlog.functions.calendar import from_epoch_ms
from starlog.functions.values import event_flag
from starlog.operators.filters import PLAY_PAGE, complete, non_empty, on_page
from starlog.operators.windows import phases
from starlog.schemas import COMPACT_EVENT_FIELDS
from starlog.sinks.files import write_sorted


def compact(events: DataFrame) -> DataFrame:
    """Events that name an artist, reduced to the compact fields."""
    return non_empty(events, "artist").select(*COMPACT_EVENT_FIELDS)


def session_item(events: DataFrame, session: int, item: int) -> DataFrame:
    """Artist, song and length heard as the given item of a session."""
    return events.where((F.col("sessionId") == session) & (F.col("itemInSession") == item)).select(
        "artist", "song", "length"
    )


def session_playlist(events: DataFrame, user: str, session: int) -> DataFrame:
    """What a user heard in a session, in playing order, with the user's name."""
    return (
        events.where((F.col("userId") == user) & (F.col("sessionId") == session))
        .orderBy(F.col("itemInSession").cast("int"))
        .select("itemInSession", "artist", "song", "firstName", "lastName")
    )


def song_listeners(events: DataFrame, song: str) -> DataFrame:
    """Every user who heard the song."""
    return events.where(F.col("song") == song).select("userId", "firstName", "lastName").distinct()


# One stored copy per question asked of the events, sorted by what the question names.
ACCESS_ORDERS = {
    "by_session": ["sessionId", "itemInSession"],
    "by_user": ["userId", "sessionId", "itemInSession"],
    "by_song": ["song", "userId", "sessionId", "itemInSession"],
}


def write_access_tables(events: DataFrame, out: str) -> None:
    """Store the events once per access pattern, for `session_item`, `session_playlist` and `song_listeners`."""
    for name, order in ACCESS_ORDERS.items():
        write_sorted(events, f"{out}/{name}", order)


#: What the questions name besides the session, which the stored order serves.
LOOKED_UP = ("userId", "song")


def write_access_table(events: DataFrame, path: str, group_bytes: int = 64 << 20, values: int = 100_000) -> None:
    """Store the events once for all three questions, in the order of `by_session`.

    A session's rows lie together. Bloom filters of the users and songs of each row group, about `values` of them, let a
    reader that asks for one of those pass over the groups without it.
    """
    order = ACCESS_ORDERS["by_session"]
    writer = events.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite")
    writer = writer.option("parquet.block.size", group_bytes)
    for column in LOOKED_UP:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", values)
    writer.parquet(path)


def valid_log(log: DataFrame) -> DataFrame:
    """Rows with a user and a session."""
    return non_empty(complete(log, ["userId", "sessionId"]), "userId")


def plays_per_hour(log: DataFrame, page: str = PLAY_PAGE) -> DataFrame:
    """Plays by hour of day, in hour order."""
    hours = on_page(log, page).select(F.hour(from_epoch_ms(F.col("ts"))).alias("hour"))
    return hours.groupBy("hour").agg(F.count("*").alias("count")).orderBy("hour")


def downgrade_phases(log: DataFrame, page: str = "Submit Downgrade") -> DataFrame:
    """Valid rows with the downgrade flag and the number of downgrades at or after each."""
    flagged = valid_log(log).withColumn("downgrade", event_flag(F.col("page"), page))
    return phases(flagged, "userId", "ts", "downgrade", ["sessionId", "itemInSession"])
