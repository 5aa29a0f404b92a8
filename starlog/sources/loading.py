"""Checked loads: every value that does not fit is kept as (column, reason, raw value), across loads.

A checked read turns each line into the contract's columns and an array of what was wrong with it, in
one projection. `load` stores the whole lines as the staged table and appends what was wrong with
the others to an error table, one directory per load, so that a load that is repeated replaces its
own errors and touches no others.

Text is taken as it is, empty values of other columns are NULL. A line that does not parse has one error,
without a column; a line is rejected if it has any error.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlog.operators.joins import join_null_safe, join_resplit
from starlog.schemas import Contract, max_length
from starlog.session import materialise

ERRORS, LINE, FILE = "_errors", "_line_text", "_source_file"
ERROR = "struct<column: string, reason: string, raw_value: string>"
#: The error table: one row per value that did not fit.
ERROR_TABLE = T.StructType(
    [T.StructField("start_time", T.TimestampType())]
    + [T.StructField(name, T.StringType()) for name in ("file", "column", "reason", "raw_value", "line", "load")]
)

UNREADABLE, MISSING, TOO_LONG, OUT_OF_RANGE = "line does not parse", "no value", "text too long", "number out of range"
REPEATED, NO_PARENT = "key repeats", "no such parent"
WRONG = {
    "tinyint": "not a whole number", "smallint": "not a whole number", "int": "not a whole number", "bigint": "not a whole number",
    "float": "not a number", "double": "not a number", "decimal": "not a number",
    "boolean": "not a boolean", "date": "not a date", "timestamp": "not a timestamp",
}
NUMBER = r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*"
STEP = re.compile(r"""\.([^.\[\]'"]+)|\['([^']+)'\]|\["([^"]+)"\]|\[(\d+)\]""")


class LoadError(Exception):
    """More lines were rejected than the load allows."""


def _error(column: str | None, reason: Column, raw: Column) -> Column:
    return F.struct(F.lit(column).cast("string").alias("column"), reason.alias("reason"), raw.alias("raw_value"))


def _checked(field: T.StructField, raw: Column) -> tuple[Column, Column]:
    """The value of a field from its text, and its error or NULL."""
    kind = field.dataType.simpleString()
    if kind == "string":
        value, longest = raw, max_length(field)
        misfit = F.when(F.length(raw) > longest, TOO_LONG) if longest else F.lit(None).cast("string")
    else:
        raw = F.nullif(F.trim(raw), F.lit(""))
        value = raw.try_cast(field.dataType)
        name = kind.split("(")[0]
        reason = F.lit(WRONG.get(name, f"not of type {kind}"))
        if WRONG.get(name) == "not a whole number":
            reason = F.when(F.regexp_like(raw, F.lit(r"^[+-]?\d+$")), OUT_OF_RANGE).otherwise(reason)
        elif name == "decimal":
            reason = F.when(F.regexp_like(raw, F.lit(f"^{NUMBER}$")), OUT_OF_RANGE).otherwise(reason)
        misfit = F.when(raw.isNotNull() & value.isNull(), reason)
    if not field.nullable:
        misfit = F.when(raw.isNull(), MISSING).otherwise(misfit)
    return value, F.when(misfit.isNotNull(), _error(field.name, misfit, raw))


def check_values(lines: DataFrame, raw: dict[str, Column], contract: Contract, readable: Column, text: Column, file: Column) -> DataFrame:
    """The contract's columns from the `raw` text of each, with `_errors`, `_line_text` of bad lines and `_source_file`."""
    found = {field.name: _checked(field, raw[field.name]) for field in contract.schema.fields}
    misfits = F.array_compact(F.array(*[error for _, error in found.values()]))
    unreadable = F.array(_error(None, F.lit(UNREADABLE), F.lit(None).cast("string")))
    errors = F.when(readable, misfits).otherwise(unreadable)
    checked = lines.select(
        *[value.alias(name) for name, (value, _) in found.items()],
        errors.cast(f"array<{ERROR}>").alias(ERRORS),
        text.alias(LINE),
        file.alias(FILE),
    )
    return checked.withColumn(LINE, F.when(F.size(ERRORS) > 0, F.col(LINE)))


def _lines(spark: SparkSession, path: str | list[str], files: str) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", files).text(path)
    return lines.where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias(FILE))


def parsed_once(lines: DataFrame, name: str, parsed: Column) -> DataFrame:
    """The lines with a parsed value beside them, which is worked out once a line.

    As a mere column it would be put in place of each of its uses, when rows are filtered by what was parsed.
    """
    return lines.select("*", F.explode(F.array(parsed)).alias(name))


def with_names(parsed: DataFrame) -> DataFrame:
    """Parsed lines with the names of their `_fields` in lower case in `_names` and their values in `_values`."""
    names, values = F.transform(F.map_keys("_fields"), lambda name: F.lower(name)), F.map_values("_fields")
    found = F.struct(names.alias("names"), values.alias("values"))
    return parsed_once(parsed, "_found", found).withColumns({"_names": F.col("_found.names"), "_values": F.col("_found.values")})


def json_by_name(spark: SparkSession, path: str | list[str], contract: Contract, files: str = "*.json") -> DataFrame:
    """JSON lines whose fields go to the contract's columns of the same name in any case, checked.

    Of fields whose names differ only in case the first of the line counts.
    """
    parsed = parsed_once(_lines(spark, path, files), "_fields", F.from_json("value", "map<string,string>"))
    parsed = with_names(parsed)

    def field(name: str) -> Column:
        return F.get("_values", F.array_position("_names", name).cast("int") - 1)

    raw = {f.name: field(f.name.lower()) for f in contract.schema.fields}
    return check_values(parsed, raw, contract, F.col("_fields").isNotNull(), F.col("value"), F.col(FILE))


def path_steps(path: str) -> list[str | int]:
    """The steps of a path such as $.a, $['b-c'].d or $.list[0]; names are text, places are numbers."""
    steps, at = [], 1
    while path[:1] == "$" and (step := STEP.match(path, at)):
        steps.append(int(step[4]) if step[4] else step[1] or step[2] or step[3])
        at = step.end()
    if not steps or at != len(path) or not isinstance(steps[0], str):
        raise ValueError(f"not a path to a field: {path}")
    return steps


def json_mapped(
    spark: SparkSession, path: str | list[str], paths: list[str], contract: Contract, files: str = "*.json", empty_as_null: bool = True
) -> DataFrame:
    """JSON lines whose i-th mapped path goes to the contract's i-th column, checked.

    A line is parsed once for the fields that the paths begin with; only what lies deeper is looked up in
    those. A path may be a field's plain name. With `empty_as_null` empty text is NULL too.
    """
    steps = [path_steps(p) if p[:1] == "$" else [p] for p in paths]
    tops = list(dict.fromkeys(s[0] for s in steps))
    bad = "_unread"
    while bad in tops:
        bad += "_"
    # fields are read by their place, as names may differ only in case
    types = T.StructType([T.StructField(name, T.StringType()) for name in [*tops, bad]])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    names = [f"_{at}" for at in range(len(tops) + 1)]
    placed = T.StructType([T.StructField(n, T.StringType()) for n in names])
    parsed = parsed_once(_lines(spark, path, files), "_row", F.from_json("value", types, options).cast(placed))

    def value(step: list[str | int]) -> Column:
        found = F.col(f"_row._{tops.index(step[0])}")
        if len(step) > 1:
            deeper = "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in step[1:])
            found = F.get_json_object(found, "$" + deeper)
        return F.nullif(found, F.lit("")) if empty_as_null else found

    raw = {f.name: value(step) for f, step in zip(contract.schema.fields, steps, strict=True)}
    readable = F.col(f"_row._{len(tops)}").isNull() & F.col("_row").isNotNull()
    return check_values(parsed, raw, contract, readable, F.col("value"), F.col(FILE))


def csv_rows(
    spark: SparkSession, path: str | list[str], contract: Contract, files: str = "*.csv", sep: str = ",", header: bool = True
) -> DataFrame:
    """CSV lines, under a header or not, their i-th field for the contract's i-th column, checked.

    A line of too many or too few fields does not parse. Of a misfit the line is written anew from its fields.
    """
    names = [f"_{at}" for at in range(len(contract.schema.fields))]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, "_unread"]])
    reader = spark.read.schema(schema).option("header", header).option("escape", '"').option("sep", sep).option("enforceSchema", True)
    reader = reader.option("columnNameOfCorruptRecord", "_unread").option("columnPruning", False)
    rows = reader.option("recursiveFileLookup", True).option("pathGlobFilter", files).csv(path)
    rows = rows.withColumn(FILE, F.col("_metadata.file_path"))
    raw = {f.name: F.col(name) for f, name in zip(contract.schema.fields, names)}
    text = F.coalesce(F.col("_unread"), F.to_csv(F.struct(*names), {"sep": sep}))
    return check_values(rows, raw, contract, F.col("_unread").isNull(), text, F.col(FILE))


def frame_rows(rows: DataFrame, contract: Contract) -> DataFrame:
    """A frame's columns under the contract's, by name in any case, checked; columns it lacks are NULL.

    Columns that the database fills in may be missing.
    """
    present = {name.lower(): name for name in rows.columns}
    raw = {
        f.name: rows[f"`{present[f.name.lower()]}`"].cast("string") if f.name.lower() in present else F.lit(None).cast("string")
        for f in contract.schema.fields
    }
    fields = [
        T.StructField(f.name, f.dataType, f.nullable or (f.metadata.get("generated", False) and f.name.lower() not in present), f.metadata)
        for f in contract.schema.fields
    ]
    text = F.to_json(F.struct(*[value.alias(name) for name, value in raw.items()]))
    loose = Contract(contract.name, T.StructType(fields), contract.key, contract.references)
    return check_values(rows, raw, loose, F.lit(True), text, F.lit(None).cast("string"))


def _with_error(checked: DataFrame, wrong: Column, column: str, reason: str, raw: Column) -> DataFrame:
    """The checked rows with one more error where `wrong` holds."""
    added = F.array_append(ERRORS, _error(column, F.lit(reason), raw.cast("string")).cast(ERROR))
    return checked.withColumn(ERRORS, F.when(wrong, added).otherwise(F.col(ERRORS)))


def check_references(checked: DataFrame, contract: Contract, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows that name a parent which its table lacks get an error; `parents` gives tables and their keys by name.

    NULL names no parent. References to tables that are not given are not checked.
    """
    for column, name in contract.references.items():
        if name not in parents:
            continue
        table, key = parents[name]
        known = table.select(F.col(key).alias(column)).distinct().withColumn("_known", F.lit(True))
        met = join_resplit(checked, known, [column], "left")
        lost = F.col(column).isNotNull() & F.col("_known").isNull()
        checked = _with_error(met, lost, column, NO_PARENT, F.col(column)).drop("_known")
    return checked


def check_key(checked: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Of the rows without errors that share a key all but the first, in the order of their columns, get an error."""
    if not key:
        return checked
    # a stored number tells equal rows apart
    rows = materialise(checked.withColumn("_row", F.monotonically_increasing_id()))
    others = [F.col(name) for name in checked.columns if name not in (*key, ERRORS)]
    first = rows.where(F.size(ERRORS) == 0).groupBy(*key).agg(F.min(F.struct(*others, "_row")).alias("_first"))
    met = join_null_safe(rows, first.select(*key, F.col("_first._row").alias("_kept")), list(key), "left")
    later = (F.size(ERRORS) == 0) & (F.col("_row") != F.col("_kept"))
    raw = F.concat_ws(",", *[F.col(name).cast("string") for name in key])
    told = _with_error(met, later, ",".join(key), REPEATED, raw)
    text = F.to_json(F.struct(*[F.col(name) for name in checked.columns if name not in (ERRORS, LINE, FILE)]))
    told = told.withColumn(LINE, F.when(F.size(ERRORS) > 0, F.coalesce(LINE, text)))
    return told.select(*checked.columns)


def accepted(checked: DataFrame) -> DataFrame:
    """The rows without errors, in the contract's columns."""
    return checked.where(F.size(ERRORS) == 0).drop(ERRORS, LINE, FILE)


def errors_of(checked: DataFrame) -> DataFrame:
    """(file, column, reason, raw_value, line) of every error."""
    return checked.select(F.col(FILE).alias("file"), F.explode(ERRORS).alias("error"), F.col(LINE).alias("line")).select(
        "file", "error.*", "line"
    )


@dataclass(frozen=True)
class ErrorTable:
    """The errors of all loads below a path, in one directory per load."""

    spark: SparkSession
    path: str

    def record(self, errors: DataFrame, load: str, started: datetime) -> None:
        """Store a load's errors in place of those it stored before."""
        stamped = errors.withColumn("start_time", F.lit(started).cast("timestamp"))
        stamped.select(*ERROR_TABLE.fieldNames()[:-1]).write.mode("overwrite").parquet(f"{self.path}/load={load}")

    def read(self, load: str | None = None) -> DataFrame:
        """All errors, or those of one load."""
        reader = self.spark.read.schema(ERROR_TABLE).option("basePath", self.path)
        return reader.parquet(self.path if load is None else f"{self.path}/load={load}")

    def newest(self, n: int = 5) -> DataFrame:
        """Start time, reason and raw value of the n errors of the newest loads."""
        ties = ["load", "column", "raw_value", "line", "file"]
        return self.read().orderBy(F.desc("start_time"), *ties).limit(n).select("start_time", "reason", "raw_value")


def load(
    checked: DataFrame, path: str, table: ErrorTable, name: str, started: datetime, max_rejected: int | None = None
) -> DataFrame:
    """Stage a checked read below `path`, record its errors under the load's `name`, and return the staged rows.

    The source is read once: whole and rejected lines are written side by side. With `max_rejected` a load that
    rejects more lines records them and raises LoadError, and its rows are not to be used.
    """
    if not re.fullmatch(r"[\w.-]+", name):
        raise ValueError(f"a load's name is made of letters, digits, dots and dashes: {name}")
    spark = checked.sparkSession
    marked = checked.withColumn("_rejected", F.size(ERRORS) > 0)
    marked.write.partitionBy("_rejected").mode("overwrite").parquet(path)
    stored = spark.read.schema(marked.schema).parquet(path)
    rejected = stored.where("_rejected").drop("_rejected")
    table.record(errors_of(rejected), name, started)
    if max_rejected is not None and (count := rejected.count()) > max_rejected:
        raise LoadError(f"load {name} rejected {count} lines, {max_rejected} allowed")
    return stored.where("NOT _rejected").drop("_rejected", ERRORS, LINE, FILE)
