"""Incremental ingest of log files with each table's own conflict rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlog.functions.calendar import from_epoch_ms
from starlog.functions.values import user_number
from starlog.operators.filters import PLAY_PAGE, on_page
from starlog.plans import star
from starlog.schemas import LOG
from starlog.session import materialise
from starlog.sinks.bucketed import BucketedTable
from starlog.sinks.files import write_parquet
from starlog.sinks.tables import insert_if_absent, upsert

EVENT_ORDER = ["ts", "sessionId", "itemInSession"]
#: Play numbers of one batch start this far from those of the batch before.
BATCH_STEP = 1 << 40


def users_table(spark: SparkSession, out: str) -> BucketedTable:
    """The users below `out`; a batch rewrites only the buckets of users who appear in it."""
    return BucketedTable(spark, f"{out}/users", "user_id", buckets=16)


def load_batch(batch: DataFrame, batch_id: int, out: str, lookup: DataFrame, page: str = PLAY_PAGE) -> None:
    """Load one batch of log rows; loading the same batch again changes nothing.

    Time rows are inserted if absent, users upserted (level replaced, later batches win), and the
    batch's plays, numbered from batch_id * BATCH_STEP, fill a directory of their own, by year and
    month, that a repeat overwrites.
    """
    spark = batch.sparkSession
    plays = materialise(on_page(batch, page))
    times = star.time_relational(plays, page)
    insert_if_absent(times, f"{out}/time", ["start_time"], [], by=("year", "month"))
    profiles = plays.select(
        user_number(F.col("userId")).alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        *EVENT_ORDER,
    )
    upsert(profiles, users_table(spark, out), EVENT_ORDER, ["level"])
    facts = star.with_serial(star.plays_relational(plays, lookup, page), start=batch_id * BATCH_STEP + 1)
    time = from_epoch_ms(F.col("start_time"))
    facts = facts.withColumns({"year": F.year(time), "month": F.month(time)})
    write_parquet(facts, f"{out}/songplays/batch={batch_id}", ("year", "month"))


def ingest_log(
    spark: SparkSession,
    source: str,
    out: str,
    lookup: DataFrame,
    files_per_batch: int = 10_000,
    page: str = PLAY_PAGE,
) -> None:
    """Load the log files that arrived since the last run, then stop.

    Progress is kept below `out`, so the next run takes up where this one ended. A backlog is
    loaded in batches of at most `files_per_batch` files.
    """
    reader = spark.readStream.schema(LOG).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.json(source)
        .writeStream.option("checkpointLocation", f"{out}/_progress")
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: load_batch(batch, batch_id, out, lookup, page))
        .start()
    )
    query.awaitTermination()
