"""Many small parquet files in name=value directories of a folder that all executors mount.

Hadoop's local file system starts a `chmod` process for each file and directory it makes, and a checksum file beside; over
a row or two a file that is nearly all of the time. Here the tasks' Python workers make the files, in the directories and under the
names that Spark's writer gives them, and read them where they lie, so that no list of all files reaches the driver.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from importlib.util import find_spec
from itertools import groupby
from urllib.parse import unquote

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlog.session import file_system

NULL_NAME = "__HIVE_DEFAULT_PARTITION__"
#: What Spark's writer escapes in the name of a directory.
ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
#: Spark's codecs by pyarrow's names.
CODECS = {"snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "none": "none", "uncompressed": "none"}
#: Types that both write alike.
TYPES = re.compile(r"(string|binary|boolean|tinyint|smallint|int|bigint|float|double|date|timestamp|timestamp_ntz|decimal\(.*\))$")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system names it, None if another file system than the local one holds it."""
    fs, location = file_system(spark, path)
    if fs.getUri().getScheme() != "file" or find_spec("pyarrow") is None:
        return None
    return fs.makeQualified(location).toUri().getPath()


def writable(df: DataFrame, path: str) -> bool:
    """Whether `write_directories` can write these columns there, as Spark would under the session's settings."""
    conf = df.sparkSession.conf
    return (
        mounted(df.sparkSession, path) is not None
        and conf.get("spark.sql.parquet.compression.codec") in CODECS
        and conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
        and all(TYPES.match(kind) for _, kind in df.dtypes)
    )


def _map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """`mapInArrow` with this package on the path of the Python workers, wherever the driver was started."""
    variables = df.sparkSession.sparkContext.environment
    known = variables.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        variables["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
    return df.mapInArrow(run, schema)


def directory_name(column: str, value: str | None) -> str:
    name, value = (ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", text) for text in (column, value or NULL_NAME))
    return f"{name}={value}"


def _make_below(root: str, directory: str) -> None:
    """Make a directory and those between it and the root, but never the root."""
    try:
        os.mkdir(f"{root}/{directory}")
    except FileExistsError:
        return
    except FileNotFoundError:
        parent = os.path.dirname(directory)
        if not parent:
            raise
        _make_below(root, parent)
        _make_below(root, directory)


class _File:
    """A parquet file that takes its name when it is whole; rows are held until they fill a row group."""

    def __init__(self, folder: str, name: str, attempt: int, schema, codec: str):
        self.at, self.under = f"{folder}/.{name}.{attempt}", f"{folder}/{name}"
        self.schema, self.codec, self.writer, self.held, self.rows, self.size = schema, codec, None, [], 0, 0

    def add(self, batch) -> None:
        self.held.append(batch)
        self.rows += batch.num_rows
        self.size += batch.nbytes
        if self.rows >= 1 << 18 or self.size >= 64 << 20:
            self._flush()

    def _flush(self) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq

        if self.writer is None:
            # few values repeat in a file of a few rows
            repeats = self.rows > 100
            self.writer = pq.ParquetWriter(self.at, self.schema, compression=self.codec, use_dictionary=repeats, store_schema=False)
        self.writer.write_table(pa.Table.from_batches(self.held, self.schema))
        self.held, self.rows, self.size = [], 0, 0

    def close(self) -> None:
        if self.held:
            self._flush()
        self.writer.close()
        os.replace(self.at, self.under)


def put_rows(batches: Iterator, root: str, by: list[str], name: str, attempt: int, codec: str, metadata: dict[str, str]) -> int:
    """Write rows, which come directory by directory, to a file `name` in each; the first columns are the directories' values.

    An attempt that is repeated replaces the files of the one before. Returns the number of rows.
    """
    rows, last, file = 0, None, None
    for batch in batches:
        first = 0
        data = batch.select(range(len(by), batch.num_columns))
        data = data.replace_schema_metadata(metadata)
        for values, same in groupby(zip(*(batch.column(n).to_pylist() for n in range(len(by))))):
            n = sum(1 for _ in same)
            if file is None or values != last:
                if file is not None:
                    file.close()
                directory = "/".join(map(directory_name, by, values))
                _make_below(root, directory)
                last, file = values, _File(f"{root}/{directory}", name, attempt, data.schema, codec)
            file.add(data.slice(first, n))
            first += n
        rows += first
    if file is not None:
        file.close()
    return rows


def write_directories(df: DataFrame, path: str, by: list[str], tasks: int, deal: list[str]) -> None:
    """Write parquet in one directory per value of the `by` columns, replacing what is at `path`.

    Rows are dealt to the tasks by their directory and the `deal` columns, which are not written. All lies in a folder beside until
    it is whole and takes the place of the old in one step.
    """
    spark = df.sparkSession
    fs, target = file_system(spark, path)
    target = fs.makeQualified(target)
    stamp = uuid.uuid4().hex
    folder = f"{target.getParent().toString()}/_writing-{stamp}"
    _, place = file_system(spark, folder)
    root, codec = mounted(spark, folder), spark.conf.get("spark.sql.parquet.compression.codec")
    data = df.drop(*by, *deal)
    metadata = {"org.apache.spark.version": spark.version, "org.apache.spark.sql.parquet.row.metadata": data.schema.json()}
    # NULL and the empty text share a directory
    values = [F.nullif(F.col(c).cast("string"), F.lit("")).alias(f"_directory_{n}") for n, c in enumerate(by)]
    keys = [f"_directory_{n}" for n in range(len(by))]
    rows = df.select(*values, *deal, *data.columns).repartition(tasks, *keys, *deal).drop(*deal).sortWithinPartitions(*keys)

    def run(batches):
        import pyarrow as pa

        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{stamp}.{codec}.parquet"
        put = put_rows(batches, root, by, name, task.taskAttemptId(), CODECS[codec], metadata)
        yield pa.RecordBatch.from_pydict({"rows": pa.array([put], pa.int64())})

    try:
        fs.mkdirs(place)
        _map_arrow(rows, run, "rows long").agg(F.sum("rows")).collect()
        fs.create(file_system(spark, f"{folder}/_SUCCESS")[1]).close()
        fs.delete(target, True)
        if not fs.rename(place, target):
            raise OSError(f"cannot rename {folder} to {path}")
    except BaseException:
        fs.delete(place, True)
        raise


def _seen(folder: str) -> list[os.DirEntry]:
    with os.scandir(folder) as entries:
        return sorted((e for e in entries if e.name[0] not in "._"), key=lambda e: e.name)


def subdirectories(root: str, directory: str, column: str) -> list[str]:
    """The directories of the column's values in one, relative to the root."""
    start, found = f"{directory_name(column, None).partition('=')[0]}=", _seen(f"{root}/{directory}")
    if wrong := [e.name for e in found if not (e.name.startswith(start) and e.is_dir())]:
        raise ValueError(f"{wrong[0]} in {root}/{directory} is no directory of {column}")
    return [f"{directory}/{e.name}".lstrip("/") for e in found]


def fetch_rows(directories: Iterator[str], root: str, schema, by: int) -> Iterator:
    """The rows of all files in the directories as Arrow batches, with the directories' values as text in the first `by` columns."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    held, rows = [], 0
    fields = pa.schema([schema.field(n) for n in range(by, len(schema))])
    for directory in directories:
        values = [unquote(part.partition("=")[2]) for part in directory.split("/")]
        values = [pa.scalar(None if value == NULL_NAME else value, pa.string()) for value in values]
        for entry in _seen(f"{root}/{directory}"):
            with pq.ParquetFile(entry.path) as file:
                whole = file.metadata.num_rows <= 1 << 16
                tables = [file.read(fields.names, use_threads=False)] if whole else map(
                    lambda b: pa.Table.from_batches([b]), file.iter_batches(1 << 16, columns=fields.names, use_threads=False)
                )
                for table in tables:
                    table = table.select(fields.names).replace_schema_metadata()
                    table = table if table.schema.equals(fields) else table.cast(fields)
                    held.append(pa.Table.from_arrays([*[pa.repeat(v, len(table)) for v in values], *table.columns], schema=schema))
                    rows += len(table)
                    if rows >= 1 << 14:
                        yield from pa.concat_tables(held).combine_chunks().to_batches()
                        held, rows = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def read_directories(spark: SparkSession, path: str, schema: T.StructType, by: list[str], tasks: int) -> DataFrame:
    """The rows below `path`, whose directories are listed level by level and dealt to the tasks; they are listed when rows are asked for."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    root = mounted(spark, path)
    data = T.StructType([field for field in schema.fields if field.name not in by])
    told = T.StructType([*[T.StructField(c, T.StringType()) for c in by], *data.fields])
    arrow = to_arrow_schema(T.StructType([T.StructField(f.name, f.dataType) for f in told.fields]))

    def listed(column: str):
        def run(batches):
            for batch in batches:
                for directory in batch.column(0).to_pylist():
                    yield pa.RecordBatch.from_pydict({"directory": pa.array(subdirectories(root, directory, column), pa.string())})

        return run

    def fetched(batches):
        return fetch_rows((d for batch in batches for d in batch.column(0).to_pylist()), root, arrow, len(by))

    directories = spark.createDataFrame([("",)], "directory string")
    for column in by:
        directories = _map_arrow(directories, listed(column), "directory string").repartition(tasks, "directory")
    rows = _map_arrow(directories, fetched, told)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in by else f.name for f in schema.fields])
