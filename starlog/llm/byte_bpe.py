"""Byte-level BPE: text to token ids and back.

A text is cut by the vocabulary's pattern; in each piece the pair of neighbouring tokens with the
lowest rank is merged, the leftmost first, until no pair has a rank. The ranks of the pairs lie in
the leaves of a segment tree over the piece's byte positions, whose root names the leftmost pair
of least rank; a merge changes three leaves (the merged pair, the pair before it, and the token
that went) and the paths above them. The trees of all new pieces of one size are rows of one
array, so a step merges one pair in each of them, and a piece of any length costs n log n.

Edge cases: a NULL or empty text has no ids and decodes to no bytes; NULL and repeated doc ids are
kept row by row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starlog.llm.common import PieceTable, binary_lists, map_arrow, only, text_batches

NONE = np.int64(1) << 62  # no pair


def read_ranks(path: str) -> list[bytes]:
    """The tokens in order of rank from a rank file (base64 token and rank per line)."""
    with open(path, "rb") as lines:
        found = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [found[rank] for rank in range(len(found))]


class Merger:
    """Merges pieces given as bytes, by segment trees over their byte positions."""

    def __init__(self, tokens: list[bytes]):
        rank_of = {token: rank for rank, token in enumerate(tokens)}
        self.byte_ids = np.array([rank_of[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for rank, token in enumerate(tokens):
            for cut in range(1, len(token)):
                left, right = rank_of.get(token[:cut]), rank_of.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.pairs.tolist()], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, NONE where they do not merge or one is missing (-1)."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pairs[at] == key), self.ranks[at], NONE)

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after the other, and how many each has."""
        sizes = [max(len(piece) - 1, 0).bit_length() for piece in pieces]
        lengths = np.zeros(len(pieces), np.int64)
        found = []
        by_size = defaultdict(list)
        for at, bits in enumerate(sizes):
            by_size[bits].append(at)
        for bits, members in by_size.items():
            step = max(1, (1 << 20) >> bits)
            for first in range(0, len(members), step):
                group = members[first : first + step]
                ids, counts = self._merge([pieces[i] for i in group], bits)
                lengths[group] = counts
                found.append((np.array(group), ids, counts))
        ends = np.cumsum(lengths)
        flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        for group, ids, counts in found:
            shift = ends[group] - counts - (np.cumsum(counts) - counts)
            flat[np.arange(len(ids)) + np.repeat(shift, counts)] = ids
        return flat, lengths

    def _merge(self, pieces: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of at most 2**bits bytes, all at once: a row for each."""
        size, count = 1 << bits, len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, count)
        padded = b"".join(piece.ljust(size, b"\0") for piece in pieces)
        places = np.arange(size)
        inside = places < lengths[:, None]
        ids = np.where(inside, self.byte_ids[np.frombuffer(padded, np.uint8).reshape(count, size)], -1)
        after = np.where(places + 1 < lengths[:, None], places + 1, size) + np.zeros((count, 1), np.int64)
        before = np.tile(places - 1, (count, 1))
        # a node holds rank << bits | position, so the least is the leftmost of least rank
        tree = np.full((count, 2 * size), NONE)
        if size > 1:
            ranks = self._rank(ids[:, :-1], ids[:, 1:])
            tree[:, size:-1] = np.where(ranks < NONE, ranks << bits | places[:-1], NONE)
        for node in range(size - 1, 0, -1) if size <= 64 else ():
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        level = size
        while size > 64 and level > 1:
            level //= 2
            tree[:, level : 2 * level] = tree[:, 2 * level : 4 * level].reshape(count, level, 2).min(axis=2)
        rows = np.arange(count)
        while size > 1:
            least = tree[rows, 1]
            live = least < NONE
            rows, least = rows[live], least[live]
            if not len(rows):
                break
            at = least & (size - 1)
            gone = after[rows, at]
            follows = after[rows, gone]
            ids[rows, at] = merged = least >> bits
            ids[rows, gone] = -1
            after[rows, at] = follows
            has_next = follows < size
            before[rows[has_next], follows[has_next]] = at[has_next]
            left = before[rows, at]
            has_left = left >= 0
            next_id = np.where(has_next, ids[rows, np.where(has_next, follows, 0)], -1)
            left_id = np.where(has_left, ids[rows, np.where(has_left, left, 0)], -1)
            ranks = self._rank(merged, next_id)
            tree[rows, size + at] = np.where(ranks < NONE, ranks << bits | at, NONE)
            tree[rows, size + gone] = NONE
            ranks = self._rank(left_id, merged)
            tree[rows[has_left], size + left[has_left]] = np.where(ranks < NONE, ranks << bits | left, NONE)[has_left]
            changed_rows = np.concatenate((rows, rows, rows[has_left]))
            nodes = np.concatenate((at, gone, left[has_left])) + size
            for _ in range(bits):
                nodes = nodes >> 1
                tree[changed_rows, nodes] = np.minimum(
                    tree[changed_rows, 2 * nodes], tree[changed_rows, 2 * nodes + 1]
                )
        kept = ids >= 0
        return ids[kept], kept.sum(axis=1)


class Tokens:
    """The bytes of all tokens in one array."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The bytes of each text's tokens, joined; `ids` has those of all texts, `counts` how many each has."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        data = self.data[np.arange(total) + np.repeat(self.starts[ids] - (ends - lengths), lengths)]
        offsets = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]
        return pa.Array.from_buffers(
            pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
        ).cast(pa.binary())


class Encoder:
    """Texts to ids under a rank file and a splitting pattern, in one worker."""

    def __init__(self, path: str, pattern: str):
        import regex

        tokens = read_ranks(path)
        merge = Merger(tokens)
        self.tokens = Tokens(tokens)
        self.split = regex.compile(pattern).findall
        self.table = PieceTable(lambda pieces: merge([piece.encode() for piece in pieces]), limit=600_000)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        found = [self.split(text) for text in texts]
        numbers = self.table.numbers([piece for pieces in found for piece in pieces])
        ids, lengths = self.table.ids(numbers)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        return ids, np.diff(ends[np.cumsum([0, *map(len, found)])])


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker process, reused by its later tasks."""
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Add `ids` (array of int) to doc_id; `path` is a rank file that every executor can read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            for at, texts in text_batches(batch, "text"):
                ids, counts = coder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), binary_lists(ids, counts)], ["doc_id", "ids"]
                )

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(only(docs, "doc_id", "text"), run, f"doc_id {doc_type}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add `decoded` (binary) to doc_id and ids: the bytes of the tokens, joined. NULL ids have no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(read_ranks(path))
        for batch in batches:
            ids = batch.column("ids")
            counts = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            data = tokens.decode(ids.flatten().to_numpy(zero_copy_only=False), counts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, data], ["doc_id", "ids", "decoded"])

    doc_type = encoded.schema["doc_id"].dataType.simpleString()
    return map_arrow(only(encoded, "doc_id", "ids"), run, f"doc_id {doc_type}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`encode` and `decode` in one pass: doc_id, ids and decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in batches:
            for at, texts in text_batches(batch, "text"):
                ids, counts = coder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), binary_lists(ids, counts), coder.tokens.decode(ids, counts)],
                    ["doc_id", "ids", "decoded"],
                )

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(only(docs, "doc_id", "text"), run, f"doc_id {doc_type}, ids array<int>, decoded binary")
