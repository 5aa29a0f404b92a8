"""Token counts of documents in flat token files without an index.

A flat file holds the 16-bit ids of its documents one after the other, each closed by the
end-of-document id. It is cut into blocks of equal size, wherever their edges fall; every block is
searched for the end id by one vectorised comparison. A prefix scan over the blocks then says how
many documents ended before each block and where the last of them ended, which stitches the
documents that run over block edges. Tokens after the last end id are an unclosed document.

Files are reached through pyarrow's file systems, blocks by seeking, so one file may be of any size.

Edge cases: an empty document (NULL or empty text) counts 0; an empty file or folder has no
documents; repeated doc ids are kept row by row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlog.llm.byte_bpe import encoder
from starlog.llm.common import map_arrow, only, text_batches
from starlog.session import file_system, materialise

WIDTH = 2  # bytes of an id
#: Blocks whose summaries one task of the prefix scan holds.
GROUP = 4096
#: Bytes of flat files that one task searches.
TASK_BYTES = 32 << 20


def write_flat(docs: DataFrame, folder: str, path: str, pattern: str, end_id: int) -> DataFrame:
    """Write the documents of each partition as one flat file in `folder`; returns (file, place, doc_id).

    Ids must fit into 16 bits, else ValueError is raised. A task writes under a name of its own attempt and renames it when complete, so a repeated task
    replaces the file by an equal one and no reader sees half of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        if max(end_id, len(coder.tokens.lengths) - 1) >= 1 << 8 * WIDTH:
            raise ValueError(f"ids of this vocabulary do not fit into {WIDTH} bytes")
        context = TaskContext.get()
        name = f"tokens-{context.partitionId():06d}.bin"
        place, out = 0, None
        system, base = fs.FileSystem.from_uri(folder)
        draft = f"{base}/.draft-{name}-{context.taskAttemptId()}"
        for batch in batches:
            for at, texts in text_batches(batch, "text"):
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(draft)
                ids, counts = coder.encode(texts)
                ends = np.cumsum(counts)
                out.write(np.insert(ids, ends, end_id).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(texts)),
                        pa.array(np.arange(place, place + len(texts))),
                        batch.column("doc_id").slice(at, len(texts)),
                    ],
                    ["file", "place", "doc_id"],
                )
                place += len(texts)
        if out is not None:
            out.close()
            if system.get_file_info(f"{base}/{name}").type != fs.FileType.NotFound:
                system.delete_file(f"{base}/{name}")  # an earlier attempt's; some stores do not replace it
            system.move(draft, f"{base}/{name}")

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return materialise(map_arrow(only(docs, "doc_id", "text"), run, f"file string, place long, doc_id {doc_type}"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes) of the flat files in the folder, by name; hidden files are left out."""
    system, location = file_system(spark, folder)
    found = system.listStatus(location) if system.exists(location) else []
    rows = [(s.getPath().getName(), s.getLen()) for s in found if s.getPath().getName()[0] not in "._"]
    return spark.createDataFrame(rows, "file string, bytes long")


def find_ends(files: DataFrame, folder: str, end_id: int, block_tokens: int) -> DataFrame:
    """(file, block, tokens, ends): for each block the places of its end ids, counted in the file.

    Places beyond 2**31 tokens are fine; a block's list is no longer than the block.
    """
    per_block = block_tokens * WIDTH
    last = F.call_function("div", F.col("bytes") + per_block - 1, F.lit(per_block)) - 1
    blocks = files.where(F.col("bytes") >= WIDTH).select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")
    )
    # rows this small would be merged into one task, so the number of tasks is given
    total = files.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    blocks = blocks.repartition(max(1, -(-total // TASK_BYTES)), "file", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                begin = row["block"] * per_block
                with system.open_input_file(f"{base}/{row['file']}") as source:
                    source.seek(begin)
                    data = source.read(min(per_block, row["bytes"] // WIDTH * WIDTH - begin))
                ids = np.frombuffer(data, "<u2")
                ends = np.flatnonzero(ids == end_id) + begin // WIDTH
                yield pa.RecordBatch.from_pydict(
                    {"file": [row["file"]], "block": [row["block"]], "tokens": [len(ids)], "ends": [ends]},
                    schema=pa.schema(
                        [("file", pa.string()), ("block", pa.int64()), ("tokens", pa.int64())]
                        + [("ends", pa.list_(pa.int64()))]
                    ),
                )

    return map_arrow(blocks, run, "file string, block long, tokens long, ends array<long>")


def _scan(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Exclusive prefix sum of `n` as `before`, and prefix maximum of `last` as `prior`."""
    frame = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns(
        {"before": F.coalesce(F.sum("n").over(frame), F.lit(0)), "prior": F.coalesce(F.max("last").over(frame), F.lit(-1))}
    )


def count_tokens(files: DataFrame, folder: str, end_id: int, block_tokens: int = 1 << 22) -> DataFrame:
    """(file, place, start, n_tokens, closed) of every document of the flat files.

    `place` counts documents of a file from 0, `start` tokens of the file; the end id is not counted.
    """
    found = materialise(find_ends(files, folder, end_id, block_tokens))
    blocks = found.select(
        "file",
        "block",
        F.call_function("div", F.col("block"), F.lit(GROUP)).alias("part"),
        F.size("ends").cast("long").alias("n"),
        F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(-1)).alias("last"),
        (F.col("block") * block_tokens + F.col("tokens")).alias("size"),
    )
    # scan within parts of GROUP blocks, over the parts, and put both together
    inner = _scan(blocks, ["file", "part"], "block").withColumnsRenamed({"before": "in_before", "prior": "in_prior"})
    parts = blocks.groupBy("file", "part").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    outer = _scan(parts, ["file"], "part").drop("n", "last")
    stitched = inner.join(outer, ["file", "part"]).select(
        "file",
        "block",
        "size",
        (F.col("in_before") + F.col("before")).alias("before"),
        F.greatest("in_prior", "prior").alias("prior"),
    )
    whole = found.join(stitched, ["file", "block"])

    def stitch(end, k):  # the first document of a block starts behind the last end of the blocks before
        start = F.when(k == 0, F.col("prior")).otherwise(F.get("ends", k - 1)) + 1
        place = F.col("before") + k
        return F.struct(place.alias("place"), start.alias("start"), (end - start).alias("n_tokens"))

    ended = whole.select("file", F.transform("ends", stitch).alias("ended"))
    closed = ended.select("file", F.inline("ended")).withColumn("closed", F.lit(True))
    totals = blocks.groupBy("file").agg(F.sum("n").alias("place"), F.max("last").alias("last"), F.max("size").alias("size"))
    unclosed = totals.where(F.col("last") + 1 < F.col("size")).select(
        "file",
        "place",
        (F.col("last") + 1).alias("start"),
        (F.col("size") - F.col("last") - 1).alias("n_tokens"),
        F.lit(False).alias("closed"),
    )
    return closed.unionByName(unclosed)


def with_doc_ids(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Name the documents by the manifest that `write_flat` returned."""
    return manifest.join(counts, ["file", "place"])
