"""Small helpers that several operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What the word rules call white space: space, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def whole_text(column: str | Column) -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """The maximal runs without blanks, as an array; empty for a text without words."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_CLASS + "+"))


def text_batches(batch: pa.RecordBatch, column: str, chars: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Slices of the batch as (first row, texts) of about `chars` characters; NULL texts are empty."""
    first, held, size = 0, [], 0
    for text in batch.column(column):
        value = text.as_py() or ""
        held.append(value)
        size += len(value)
        if size >= chars:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held


class PieceTable:
    """Token ids of text pieces, each distinct piece encoded once per worker.

    `encode` maps a list of new pieces to all their ids, one after the other, and how many each has;
    `mark` gives each a small number. The ids lie in one flat array, a piece is a number into it. Beyond `limit` pieces
    the table forgets those that it met once only (all, if too few are), so its memory is bounded
    whatever the input; results do not depend on it.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
        mark: Callable[[str], int] = lambda piece: 0,
        limit: int = 1_000_000,
    ):
        self.encode, self.mark, self.limit = encode, mark, limit
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.used = 0
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.marks = np.zeros(1 << 14, np.int8)
        self.met = np.zeros(1 << 14, np.int64)

    def _forget(self) -> None:
        """Keep the pieces met more than once, if they are less than half of the limit."""
        kept = np.flatnonzero(self.met[: len(self.number)] > 1)
        if 2 * len(kept) > self.limit:
            self._clear()
            return
        pieces = list(self.number)
        ids, lengths = self.ids(kept)
        marks = self.marks[kept]
        self._clear()
        self._add([pieces[at] for at in kept.tolist()], ids, lengths, marks)

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        grown = np.zeros(max(size, 2 * len(array)), array.dtype)
        grown[: len(array)] = array
        return grown

    def _add(self, new: list[str], ids: np.ndarray, lengths: np.ndarray, marks: np.ndarray) -> None:
        at, total = len(self.number), len(ids)
        stop = at + len(new)
        self.flat = self._room(self.flat, self.used + total)
        self.start, self.length, self.marks, self.met = (
            self._room(column, stop) for column in (self.start, self.length, self.marks, self.met)
        )
        self.marks[at:stop] = marks
        self.flat[self.used : self.used + total] = ids
        self.length[at:stop] = lengths
        self.start[at:stop] = self.used + np.cumsum(lengths) - lengths
        self.used += total
        self.number.update(zip(new, range(at, stop)))

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The number of every piece; new pieces are encoded first."""
        found = np.fromiter(map(self.number.get, pieces, repeat(-1)), np.int64, len(pieces))
        lacking = np.flatnonzero(found < 0).tolist()
        if lacking:
            if len(self.number) > self.limit:
                self._forget()
                return self.numbers(pieces)
            named = [pieces[at] for at in lacking]
            new = list(dict.fromkeys(named))
            self._add(new, *self.encode(new), np.fromiter(map(self.mark, new), np.int8, len(new)))
            found[lacking] = np.fromiter(map(self.number.__getitem__, named), np.int64, len(named))
        self.met[: len(self.number)] += np.bincount(found, minlength=len(self.number))
        return found

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered pieces one after the other, and how many each piece has."""
        lengths = self.length[numbers]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        shift = self.start[numbers] - (ends - lengths)
        return self.flat[np.arange(total) + np.repeat(shift, lengths)], lengths


def binary_lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive slices of a flat array as an Arrow array of lists."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def gray_rank(bits: Column) -> Column:
    """Position of a 64-bit pattern in the Gray sequence (the inverse of x ^ x >> 1)."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone, so that extra ones cannot clash with columns made on the way."""
    return df.select(*[df[c] for c in columns])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of the value, which is computed once however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow` with this package on the path of the Python workers, wherever the driver was started."""
    variables = df.sparkSession.sparkContext.environment
    path = variables.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in path:
        variables["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, path)])
    return df.mapInArrow(run, schema)
