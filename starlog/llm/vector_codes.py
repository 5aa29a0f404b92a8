"""Vector codes: product quantisation trained by Lloyd rounds that look at active entries only.

Components become integers floor(scale * x), a vector is cut into equal consecutive parts, and every
part position has a codebook of at most 256 entries, which starts as that part of the vectors of
least id. A round assigns every part to its nearest entry (squared Euclidean distance, ties to the
lower index) and then moves every entry to the floored mean of its parts; unused entries stay.

After an update only some entries have moved. A part whose assigned entry stayed keeps its stored,
exact distance and is compared with the moved entries alone: no other entry that stayed can have
come nearer. A part whose entry moved looks at the whole codebook again. All of it is integer
arithmetic, so results do not depend on how the rows are partitioned.

Rows are never gathered: an assignment is one pass over the rows that stores (vector, entries, distances)
in the shared folder for the next round, an update adds up one small table of sums per task, and only
codebooks (parts * entries * width integers) reach the driver.

Edge cases: vectors that are NULL, hold NULL or non-finite components or components of
RANGE / scale and more (their distances would leave 64 bits) are dropped, and so are vectors whose length differs from that
of the vector of least id; a NULL id comes after all others; equal ids are ordered by their vectors;
with fewer vectors than entries the codebooks are that much smaller; NULL labels are one
label; an empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlog.llm.common import binary_lists, map_arrow, only
from starlog.operators.joins import join_null_safe
from starlog.session import materialise

RANGE = 1 << 24
#: Rows compared with a codebook at a time.
ROWS = 2048


@dataclass
class Coding:
    """Codes of all kept rows (vec_id, label, code binary, error) and the codebooks (part, entry, place)."""

    rows: DataFrame
    codebooks: np.ndarray

    def fingerprint(self) -> str:
        """SHA-256 of the codebooks' decimal components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, ints) of the rows whose vector is whole."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < RANGE / scale))
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    rows = only(vectors, "vec_id", "label", "embedding").where(F.col("embedding").isNotNull() & (F.size("embedding") > 0))
    return rows.where(usable).select("vec_id", "label", ints.alias("ints"))


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of every row to every entry, exact in 64 bits."""
    gaps = rows[:, None, :] - entries[None, :, :]
    return np.einsum("ijk,ijk->ij", gaps, gaps)


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of every row's nearest entry, the lowest of equals, and its distance."""
    found = np.empty(len(rows), np.int64)
    least = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), ROWS):
        away = distances(rows[at : at + ROWS], entries)
        best = away.argmin(axis=1)  # the first of equal minima
        found[at : at + ROWS] = best
        least[at : at + ROWS] = away[np.arange(len(best)), best]
    return found, least


def reassign(
    rows: np.ndarray, entries: np.ndarray, moved: np.ndarray, codes: np.ndarray, away: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The assignment after the `moved` entries (a mask) changed, from the one before."""
    codes, away = codes.copy(), away.copy()
    active = np.flatnonzero(moved)
    if not len(active):
        return codes, away
    rescan = np.flatnonzero(moved[codes])
    codes[rescan], away[rescan] = nearest(rows[rescan], entries)
    stayed = np.setdiff1d(np.arange(len(rows)), rescan, assume_unique=True)
    best, least = nearest(rows[stayed], entries[active])
    best = active[best]
    better = (least < away[stayed]) | ((least == away[stayed]) & (best < codes[stayed]))
    codes[stayed[better]], away[stayed[better]] = best[better], least[better]
    return codes, away


def _parts(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """(row, part, place) of a batch's integer vectors, all of one length."""
    flat = batch.column("ints").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(batch.num_rows, parts, -1)


def _assign(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """Rows with `code` (a byte per part) and `away` (a distance per part); `moved` tells active entries."""
    parts = books.shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _parts(batch, parts)
            codes = np.empty((len(vectors), parts), np.int64)
            away = np.empty((len(vectors), parts), np.int64)
            if moved is not None:
                codes[:] = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
                away[:] = batch.column("away").flatten().to_numpy(zero_copy_only=False).reshape(-1, parts)
            for part in range(parts):
                if moved is None:
                    codes[:, part], away[:, part] = nearest(vectors[:, part], books[part])
                else:
                    codes[:, part], away[:, part] = reassign(
                        vectors[:, part], books[part], moved[part], codes[:, part], away[:, part]
                    )
            lengths = np.full(len(vectors), parts)
            packed = [row.tobytes() for row in codes.astype(np.uint8)]
            columns = [batch.column(name) for name in ("vec_id", "label", "ints")]
            columns += [pa.array(packed, pa.binary()), binary_lists(away.ravel(), lengths)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "ints", "code", "away"])

    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("vec_id", "label")}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, ints array<int>, code binary, away array<bigint>"
    return materialise(map_arrow(rows, run, schema))


def _moved_to(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after an update from the assigned rows."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _parts(batch, parts)
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            for part in range(parts):
                slots = part * entries + codes[:, part].astype(np.int64)
                np.add.at(total[:, 0], slots, 1)
                np.add.at(total[:, 1:], slots, vectors[:, part])
        used = np.flatnonzero(total[:, 0])
        sums = binary_lists(total[used, 1:].ravel(), np.full(len(used), width))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(total[used, 0], pa.int64()), sums], ["slot", "held", "sums"]
        )

    partial = map_arrow(rows.select("ints", "code"), run, "slot bigint, held bigint, sums array<bigint>")
    totals = [F.sum(F.get("sums", F.lit(place))).alias(f"sum{place}") for place in range(width)]
    moved = books.copy()
    for slot, held, *sums in partial.groupBy("slot").agg(F.sum("held"), *totals).collect():  # parts * entries rows
        moved[slot // entries, slot % entries] = [value // held for value in sums]
    return moved


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> Coding:
    """Codes and codebooks of `vectors` (vec_id, embedding, label)."""
    if not 0 < entries <= 256:
        raise ValueError("a code holds one byte per part, so 1 to 256 entries")
    kept = quantised(vectors, scale)
    order = [F.col("vec_id").asc_nulls_last(), F.col("ints")]
    least = kept.orderBy(*order).select("ints").limit(1).collect()
    width = len(least[0].ints) if least else parts
    if width % parts:
        raise ValueError(f"vectors of {width} components cannot be cut into {parts} equal parts")
    kept = kept.where(F.size("ints") == width)
    first = [row.ints for row in kept.orderBy(*order).select("ints").limit(entries).collect()]
    books = np.array(first, np.int64).reshape(len(first), parts, -1 if first else 1).transpose(1, 0, 2).copy()
    rows, moved = kept, None
    for _ in range(rounds):
        rows = _assign(rows, books, moved)
        after = _moved_to(rows, books)
        books, moved = after, (after != books).any(axis=2)
    rows = _assign(rows, books, moved)
    error = F.aggregate("away", F.lit(0).cast("long"), lambda total, one: total + one)
    return Coding(rows.select("vec_id", "label", "code", error.alias("error")), books)


def with_label_error(rows: DataFrame) -> DataFrame:
    """Add `label_error`, the errors summed over the rows of an equal label, NULL labels together."""
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    return join_null_safe(rows, sums, ["label"], "left")
