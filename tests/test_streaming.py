"""Incremental ingest equals the batch result and can be repeated."""

from starlog.plans import star
from starlog.streaming.ingest import ingest_log, load_batch, users_table
from test_plans import MS, log_frame, song_frame


def parts(spark):
    yield log_frame(spark, ("8", "free", "NextSong", MS, 5, 0, "One", "Band", 200.25), ("9", "free", "Home", MS, 6, 0, None, None, None))
    yield log_frame(spark, ("8", "paid", "NextSong", MS + 1000, 5, 1, "Two", "Band", 1.0), ("9", "free", "NextSong", MS + 1000, 6, 1, "One", "Band", 200.25))
    yield log_frame(spark, ("9", "paid", "NextSong", MS + 2000, 6, 2, "One", "Band", 200.25))


def tables_of(spark, out):
    plays = spark.read.parquet(f"{out}/songplays").drop("batch")
    numbers = [r.songplay_id for r in plays.collect()]
    assert len(set(numbers)) == len(numbers) and None not in numbers
    plays = plays.drop("songplay_id")  # it tells the batch
    return {
        "users": sorted(map(tuple, users_table(spark, out).read().collect())),
        "time": sorted(map(tuple, spark.read.parquet(f"{out}/time").collect())),
        "plays": sorted(map(str, plays.select(sorted(plays.columns)).collect())),
    }


def test_stream_equals_batch(spark, path):
    songs = song_frame(spark, ("S1", "One", "A1", "Band", 200.25, 2001))
    lookup = star.song_lookup(star.songs(songs), star.artists(songs)).cache()
    for i, part in enumerate(parts(spark)):
        part.write.json(f"{path}/in/{i}")
        ingest_log(spark, f"{path}/in", f"{path}/stream", lookup)
    ingest_log(spark, f"{path}/in", f"{path}/stream", lookup)

    whole = spark.read.schema(next(parts(spark)).schema).option("recursiveFileLookup", True).json(f"{path}/in")
    load_batch(whole, 0, f"{path}/batch", lookup)
    streamed = tables_of(spark, f"{path}/stream")
    assert streamed == tables_of(spark, f"{path}/batch")
    assert [(u[0], u[4]) for u in streamed["users"]] == [(8, "paid"), (9, "paid")]
    assert len(streamed["plays"]) == 4 and len(streamed["time"]) == 3

    load_batch(whole, 0, f"{path}/batch", lookup)  # a repeated batch
    assert tables_of(spark, f"{path}/batch") == streamed
