"""JSON, CSV, text and parquet readers with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlog.schemas import EVENT_CSV, LOG, SONG, Contract
from starlog.sinks.directories import mounted, read_directories
from starlog.sinks.files import write_once
from starlog.sources import loading

BAD_RECORD = "_bad_record"
ARRIVAL = ["_file", "_block_start", "_line"]


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """JSON lines below `path` at any depth.

    Without a schema the types are inferred, which takes a pass over all files.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_json_checked(
    spark: SparkSession, path: str | list[str], schema: T.StructType, files: str = "*.json"
) -> DataFrame:
    """JSON lines with, for each line that does not parse, its text in `_bad_record`.

    `_source_file` and `_file_time` name the file and when it was written.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", files).text(path)
    checked = T.StructType([*schema.fields, T.StructField(BAD_RECORD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
    named = lines.where(F.trim("value") != "").select(
        "value",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_file_time"),
    )
    parsed = loading.parsed_once(named, "_row", F.from_json("value", checked, options))
    return parsed.select("_row.*", "_source_file", "_file_time")


def split_bad_records(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that parsed, and the quarantine (file, file_time, raw_text) of those that did not."""
    good = checked.where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD, "_source_file", "_file_time")
    bad = checked.where(F.col(BAD_RECORD).isNotNull()).select(
        F.col("_source_file").alias("file"),
        F.col("_file_time").alias("file_time"),
        F.col(BAD_RECORD).alias("raw_text"),
    )
    return good, bad


def read_songs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_json(spark, path, SONG)


def read_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_json(spark, path, LOG)


def read_by_name_checked(spark: SparkSession, path: str | list[str], contract: Contract) -> DataFrame:
    """JSON whose fields go to the contract's columns of the same name in any case.

    The lines are parsed once, without a pass to infer types; values that do not fit become NULL. Of
    fields whose names differ only in case the first of the line counts. Lines that do not parse are
    named as in `read_json_checked`.
    """
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path)
    told = lines.where(F.trim("value") != "").select(
        "value",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_file_time"),
    )
    named = loading.with_names(loading.parsed_once(told, "_fields", F.from_json("value", "map<string,string>")))

    def field(name: str):
        return F.get("_values", F.array_position("_names", name).cast("int") - 1)

    return named.select(
        *[field(f.name.lower()).try_cast(f.dataType).alias(f.name) for f in contract.schema.fields],
        F.when(F.col("_fields").isNull(), F.col("value")).alias(BAD_RECORD),
        "_source_file",
        "_file_time",
    )


def read_by_name(spark: SparkSession, path: str | list[str], contract: Contract) -> DataFrame:
    """The rows of `read_by_name_checked` that parsed."""
    return split_bad_records(read_by_name_checked(spark, path, contract))[0]


def read_path_mapping(spark: SparkSession, path: str) -> list[str]:
    """The paths, in target order, of a mapping file {"jsonpaths": ["$['artist']", …]}; one small document is read.

    A path to a top-level field is given by the field's name, a deeper one as it stands.
    """
    paths = spark.read.json(path, multiLine=True).select("jsonpaths").first()["jsonpaths"]
    steps = [loading.path_steps(p) for p in paths]
    return [step[0] if len(step) == 1 else p for step, p in zip(steps, paths)]


def read_mapped(spark: SparkSession, path: str | list[str], fields: list[str], contract: Contract) -> DataFrame:
    """JSON whose i-th mapped field goes to the contract's i-th column; rejected lines are left out.

    `loading.json_mapped` with `loading.load` keeps what was wrong with them.
    """
    return loading.accepted(loading.json_mapped(spark, path, fields, contract))


def read_csv_text(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """CSV with header, every column as text; a quote inside a field is doubled.

    `multiline` allows line ends inside quoted fields, at the price of one task per file.
    """
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).csv(path)


def read_event_csv(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """All event files below the given directories as one set of text rows."""
    return (
        spark.read.schema(EVENT_CSV)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .csv(path)
    )


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Tab-separated rows with header, empty = NULL, backslash escapes."""
    return (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", "")
        .option("escape", "\\")
        .csv(path)
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_small_directories(spark: SparkSession, path: str, schema: T.StructType, by: tuple[str, ...]) -> DataFrame:
    """Rows that `write_small_directories` wrote. The directories' values get the schema's types, none is inferred.

    In a mounted folder the tasks list the directories; elsewhere Spark does, which keeps them all on the driver.
    """
    if mounted(spark, path) is None:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    return read_directories(spark, path, schema, list(by), int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_arrival_order(df: DataFrame) -> DataFrame:
    """Add (_file, _block_start, _line): file order, then position of the line in the file.

    Must be applied to a file scan; `_line` grows within one split of one file.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(ARRIVAL[0]),
        F.col("_metadata.file_block_start").alias(ARRIVAL[1]),
        F.monotonically_increasing_id().alias(ARRIVAL[2]),
    )


def parquet_copy(spark: SparkSession, raw: DataFrame, path: str) -> DataFrame:
    """Convert a raw source to parquet unless the copy exists, and read the copy."""
    write_once(raw, path)
    return spark.read.parquet(path)


def newest(df: DataFrame, time: str, n: int = 5, ties: tuple[str, ...] = ()) -> DataFrame:
    """The n newest rows."""
    return df.orderBy(F.col(time).desc_nulls_last(), *ties).limit(n)
