"""Table contracts: column types, NOT NULL, keys and references of every table in use."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    """A table's schema (non-nullable fields are NOT NULL), key and foreign keys."""

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


TEXT, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()
WHOLE = T.DecimalType(18, 0)


def _schema(*required: str, **types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, name not in required) for name, kind in types.items()])


SONG = _schema(
    num_songs=INT, song_id=TEXT, title=TEXT, artist_id=TEXT, artist_name=TEXT, artist_location=TEXT,
    artist_latitude=T.DecimalType(8, 6), artist_longitude=T.DecimalType(9, 6), duration=DOUBLE,
    year=INT,
)

# userId is quoted in the log, so it is read as text and cast later.
LOG = _schema(
    artist=TEXT, auth=TEXT, firstName=TEXT, gender=TEXT, itemInSession=INT, lastName=TEXT,
    length=DOUBLE, level=TEXT, location=TEXT, method=TEXT, page=TEXT, registration=DOUBLE,
    sessionId=INT, song=TEXT, status=INT, ts=LONG, userAgent=TEXT, userId=TEXT,
)

EVENT_CSV = T.StructType([T.StructField(f.name, T.StringType()) for f in LOG.fields if f.name != "userAgent"])

# Fields and order of the compacted event file (fixed values).
COMPACT_EVENT_FIELDS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length",
    "level", "location", "sessionId", "song", "userId",
]

IMMIGRATION = _schema(
    i94yr=DOUBLE, i94mon=DOUBLE, i94addr=TEXT, i94port=TEXT,
)
TEMPERATURE_TEXT = _schema(
    dt=TEXT, AverageTemperature=TEXT, City=TEXT, Country=TEXT,
)

USERS = Contract(
    "users",
    _schema(
        "user_id", user_id=INT, first_name=TEXT, last_name=TEXT, gender=TEXT, level=TEXT,
    ),
    key=("user_id",),
)
SONGS = Contract(
    "songs",
    _schema(
        "song_id", song_id=TEXT, title=TEXT, artist_id=TEXT, year=INT, duration=DOUBLE,
    ),
    key=("song_id",),
    references={"artist_id": "artists"},
)
ARTISTS = Contract(
    "artists",
    _schema(
        "artist_id", artist_id=TEXT, name=TEXT, location=TEXT, latitude=DOUBLE, longitude=DOUBLE,
    ),
    key=("artist_id",),
)
TIME = Contract(
    "time",
    _schema(
        "start_time", start_time=LONG, hour=INT, day=INT, week=INT, month=INT, year=INT, weekday=INT,
    ),
    key=("start_time",),
)
PLAYS = Contract(
    "songplays",
    _schema(
        "songplay_id", songplay_id=LONG, start_time=LONG, user_id=INT, level=TEXT, song_id=TEXT,
        artist_id=TEXT, session_id=INT, location=TEXT, user_agent=TEXT,
    ),
    key=("songplay_id",),
    references={"start_time": "time", "user_id": "users", "song_id": "songs", "artist_id": "artists"},
)

STAGED_EVENTS = Contract(
    "staging_events",
    _schema(
        artist=TEXT, auth=TEXT, firstname=TEXT, gender=TEXT, iteminsession=INT, lastname=TEXT,
        length=DOUBLE, level=TEXT, location=TEXT, method=TEXT, page=TEXT, registration=DOUBLE,
        sessionid=INT, song=TEXT, status=INT, ts=LONG, useragent=TEXT, userid=INT,
    ),
)
STAGED_SONGS = Contract("staging_songs", SONG)
SCHEDULED_PLAYS = Contract(
    "songplays",
    _schema(
        "playid", "start_time", "userid", playid=TEXT, start_time=TIMESTAMP, userid=INT, level=TEXT,
        songid=TEXT, artistid=TEXT, sessionid=INT, location=TEXT, user_agent=TEXT,
    ),
    key=("playid",),
)
SCHEDULED_USERS = Contract(
    "users",
    _schema(
        "userid", userid=INT, first_name=TEXT, last_name=TEXT, gender=TEXT, level=TEXT,
    ),
    key=("userid",),
)
SCHEDULED_SONGS = Contract(
    "songs",
    _schema(
        "songid", songid=TEXT, title=TEXT, artistid=TEXT, year=INT, duration=WHOLE,
    ),
    key=("songid",),
)
SCHEDULED_ARTISTS = Contract(
    "artists",
    _schema(
        "artistid", artistid=TEXT, name=TEXT, location=TEXT, lattitude=WHOLE, longitude=WHOLE,
    ),
)
SCHEDULED_TIME = Contract(
    "time",
    _schema(
        "start_time", start_time=TIMESTAMP, hour=INT, day=INT, week=INT, month=TEXT, year=INT,
        weekday=TEXT,
    ),
    key=("start_time",),
)

ARRIVALS = Contract(
    "immigration",
    _schema(
        "dt", "i94addr", "i94port", dt=DATE, i94addr=TEXT, i94port=TEXT,
    ),
)
TEMPERATURES = Contract(
    "temperature",
    _schema(
        "dt", "Country", "City", "AverageTemperature", "i94port", dt=DATE, Country=TEXT, City=TEXT,
        AverageTemperature=DOUBLE, i94port=TEXT,
    ),
)
ARRIVAL_FACTS = Contract(
    "fact_table",
    _schema(
        "dt", "i94port", dt=DATE, i94port=TEXT, AverageTemperature=DOUBLE,
    ),
)


def max_length(field: T.StructField) -> int | None:
    """How many characters a text field may hold, None without a limit."""
    return field.metadata.get("max_length")


def conform(df: DataFrame, contract: Contract | T.StructType) -> DataFrame:
    """The contract's columns in its order and types; bad values and missing columns become NULL.

    Column names match regardless of case.
    """
    schema = contract.schema if isinstance(contract, Contract) else contract
    present = {name.lower(): name for name in df.columns}
    return df.select(
        *[
            (F.col(f"`{present[f.name.lower()]}`") if f.name.lower() in present else F.lit(None))
            .try_cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )


def create_table(spark: SparkSession, contract: Contract, name: str | None = None) -> None:
    """Create a catalog table of the contract unless it exists."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in contract.schema.fields
    )
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name or contract.name} ({columns}) USING parquet")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
