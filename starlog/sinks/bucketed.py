"""A parquet table in hash buckets, of which a batch rewrites only those that it touches.

The rows of a key lie in the bucket of its hash. A manifest names, for every bucket, the write that
holds it; the newest manifest is the table. A batch writes the buckets it touches anew, beside the old
ones, and then commits a manifest that points at them. So a reader sees all of a batch or nothing, a
failed write leaves the table as it was, and untouched buckets are neither read nor written.

A manifest's number is one more than that of the manifest it was made from, and a number is taken by a
rename that does not overwrite. Of two writers from one manifest the second finds its number taken and
applies its batch again to the newer table.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlog.session import file_system, materialise
from starlog.sinks.files import write_parquet

BUCKET = "_bucket"
MANIFEST = re.compile(r"manifest-(\d{10})\.json")


@dataclass(frozen=True)
class Manifest:
    """One state of the table: its columns, the number of buckets, and the write that holds each non-empty bucket."""

    number: int
    columns: str
    buckets: int
    held: dict[int, str] = field(default_factory=dict)


class BucketedTable:
    """A table of one row per key below `path`; `buckets` is fixed by the first write.

    The `keep` newest manifests and what they point at stay for readers that started with them.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64, keep: int = 3):
        self.spark, self.path, self.key, self.buckets, self.keep = spark, path, key, buckets, keep

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def numbers(self) -> list[int]:
        """The numbers of the manifests on disk, oldest first."""
        fs, location = file_system(self.spark, self.path)
        if not fs.exists(location):
            return []
        names = [MANIFEST.fullmatch(status.getPath().getName()) for status in fs.listStatus(location)]
        return sorted(int(name[1]) for name in names if name)

    def manifest(self, number: int | None = None) -> Manifest | None:
        """The given manifest, by default the newest; None where there is no table yet."""
        numbers = self.numbers()
        if number is None and not numbers:
            return None
        number = numbers[-1] if number is None else number
        text = self.spark.read.text(self._manifest_path(number), wholetext=True).first()["value"]
        said = json.loads(text)
        return Manifest(number, said["columns"], said["buckets"], {int(b): write for b, write in said["held"].items()})

    def _manifest_path(self, number: int) -> str:
        return f"{self.path}/manifest-{number:010d}.json"

    def exists(self) -> bool:
        return bool(self.numbers())

    def files(self, manifest: Manifest, chosen: set[int] | None = None) -> list[str]:
        """The directories of the chosen buckets, by default of all."""
        return [f"{self.path}/{write}/{BUCKET}={b}" for b, write in sorted(manifest.held.items()) if chosen is None or b in chosen]

    def read(self, manifest: Manifest | None = None, chosen: set[int] | None = None) -> DataFrame:
        """The rows of the chosen buckets in the newest or the given state of the table."""
        manifest = manifest or self.manifest()
        schema = T.StructType.fromJson(json.loads(manifest.columns))
        paths = self.files(manifest, chosen)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _written(self, write: str) -> list[int]:
        """The buckets that a write gave rows to."""
        fs, location = file_system(self.spark, f"{self.path}/{write}")
        names = [status.getPath().getName().split("=") for status in fs.listStatus(location)]
        return [int(name[1]) for name in names if name[0] == BUCKET]

    def _commit(self, manifest: Manifest) -> bool:
        """Make the manifest the newest one; False if its number is taken."""
        fs, draft = file_system(self.spark, f"{self.path}/_draft-{uuid.uuid4().hex}")
        out = fs.create(draft)
        text = json.dumps({"columns": manifest.columns, "buckets": manifest.buckets, "held": manifest.held})
        out.write(bytearray(text.encode()))
        out.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        _, final = file_system(self.spark, self._manifest_path(manifest.number))
        files = hadoop.FileContext.getFileContext(final.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        plainly = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            files.rename(fs.makeQualified(draft), fs.makeQualified(final), plainly)  # fails where the number is taken
            return True
        except Py4JJavaError:
            fs.delete(draft, False)
            if not fs.exists(final):
                raise
            return False

    def apply(self, batch: DataFrame, change: Callable[[DataFrame, DataFrame | None], DataFrame]) -> list[int]:
        """Replace the buckets that the batch touches by `change(batch, their rows)`; returns those buckets.

        `change` gets None for a table that does not exist yet, must keep every key in its bucket and give the same columns each
        time. NULL keys are dropped.
        """
        batch = materialise(batch.where(F.col(self.key).isNotNull()))
        while True:
            base = self.manifest()
            buckets = base.buckets if base else self.buckets
            # no more than `buckets` numbers reach the driver
            touched = sorted(row[0] for row in batch.select(self._bucket(buckets)).distinct().collect())
            rows = change(batch, self.read(base, set(touched)) if base else None)
            write = f"write-{uuid.uuid4().hex}"
            held = dict(base.held) if base else {}
            if touched or not base:
                write_parquet(rows.withColumn(BUCKET, self._bucket(buckets)), f"{self.path}/{write}", (BUCKET,))
                held = {b: w for b, w in held.items() if b not in touched} | {b: write for b in self._written(write)}
            schema = json.dumps(rows.schema.jsonValue())
            if self._commit(Manifest(base.number + 1 if base else 1, schema, buckets, held)):
                self._clean()
                return touched
            fs, location = file_system(self.spark, f"{self.path}/{write}")
            fs.delete(location, True)

    def _clean(self) -> None:
        """Delete the manifests before the `keep` newest, and the buckets that only those pointed at."""
        numbers = self.numbers()
        old, new = numbers[: -self.keep], numbers[-self.keep :]
        if not old:
            return
        wanted = {path for number in new for path in self.files(self.manifest(number))}
        for number in old:
            for path in set(self.files(self.manifest(number))) - wanted:
                fs, location = file_system(self.spark, path)
                fs.delete(location, True)
            fs, location = file_system(self.spark, self._manifest_path(number))
            fs.delete(location, False)
