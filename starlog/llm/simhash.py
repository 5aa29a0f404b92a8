"""SimHash near-duplicates through Gray-ordered hierarchical indexes.

A text's fingerprint has a bit set where more than half of its shingle hashes have it. Fingerprints
within `DISTANCE` bits link, and linked documents form components.

The search runs over the distinct fingerprints. Two that differ in at most 3 of 64 bits agree on
at least two of five bands, so each fingerprint goes to one bucket for every pair of bands, and
every link is found in some bucket. A bucket's fingerprints are sorted by their rank in the Gray sequence,
which puts patterns that share many bits side by side. An index is laid over that order: a node
stands for a few neighbours and holds the bits that they share and the node above does not. A query goes down
from the root, adds up the bits in which it differs from each node, and drops a whole group as soon
as the sum exceeds the distance. Buckets give chains through their linked members rather than pairs,
so what leaves a bucket is no longer than the bucket.

Components come from repeated contraction: each node takes the least node it is linked to, twice
over, and the links between the remaining nodes go on. Node ids are mixed fingerprints, so that
the order is random and the number of rounds logarithmic.

Edge cases: a NULL or empty text has fingerprint zero, linked like any other; NULL doc ids come
after all others in a component, whose id is NULL only if all its doc ids are; repeated rows
are members like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlog.llm.common import gray_rank, map_arrow, text_batches, whole_text
from starlog.operators.dedupe import first_row_per_key
from starlog.operators.joins import join_null_safe
from starlog.session import materialise

DISTANCE = 3
BANDS = (13, 13, 13, 13, 12)
FANOUT = 8
#: Query and node pairs that a search holds at once, about.
HELD = 1 << 21


def _masks() -> list[int]:
    """The bits of every pair of bands, as signed 64-bit numbers."""
    ends = np.cumsum((0, *BANDS)).tolist()
    bands = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(ends, ends[1:])]
    masks = [a | b for a, b in combinations(bands, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of one text, unsigned."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z are lowered, only ASCII blanks split
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends.tolist()[shingle - 1 :] or [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, stops)], "<u8")
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        rows = hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    major = np.packbits(2 * set_bits > len(hashes), bitorder="little")
    return int(major.view("<u8")[0])


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of unsigned 64-bit values."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, version, fp, node) of every row: the text's hash, its SimHash and that mixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_batches(batch, "text"):
                found = np.array([fingerprint(text, shingle, seed) for text in texts], np.uint64)
                rows = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        rows.column("version"),
                        pa.array(found.view(np.int64)),
                        pa.array(mixed(found).view(np.int64)),
                    ],
                    ["doc_id", "version", "fp", "node"],
                )

    rows = docs.select("doc_id", F.xxhash64(whole_text("text")).alias("version"), "text")
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {doc_type}, version long, fp long, node long")


class GrayIndex:
    """Hierarchical index over Gray-sorted buckets; all buckets are searched together.

    `levels[0]` are the fingerprints; a node of a higher level covers up to FANOUT neighbours of one
    bucket, until every bucket has one root. Of a node's shared bits those that its parent shares too
    are left out, as their differences were counted there.
    """

    def __init__(self, values: np.ndarray, starts: np.ndarray):
        """`starts` are the places where buckets begin; the first is 0."""
        self.values = values
        sizes = np.diff(np.append(starts, len(values)))
        pattern, shared = values, np.full(len(values), ~np.uint64(0))
        self.levels = []  # (pattern, bits to compare, first child, number of children), leaves first
        first = np.zeros(len(values), np.int64)
        count = np.zeros(len(values), np.int64)
        begin = starts
        while True:
            if sizes.max(initial=0) <= 1:
                self.levels.append((pattern, shared, first, count))
                break
            up_sizes = -(-sizes // FANOUT)
            up_begin = np.cumsum(up_sizes) - up_sizes
            bucket = np.repeat(np.arange(len(sizes)), sizes)
            parent = up_begin[bucket] + (np.arange(len(pattern)) - begin[bucket]) // FANOUT
            up_first = np.flatnonzero(np.diff(parent, prepend=-1))
            differ = np.bitwise_or.reduceat(pattern ^ pattern[up_first][parent], up_first)
            up_shared = np.bitwise_and.reduceat(shared, up_first) & ~differ
            up_pattern = pattern[up_first]
            self.levels.append((pattern, shared & ~up_shared[parent], first, count))
            first, count = up_first, np.diff(np.append(up_first, len(pattern)))
            pattern, shared, sizes, begin = up_pattern, up_shared, up_sizes, up_begin
        self.root_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(values))))

    def links(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later member of its bucket) within the distance, as places."""
        node, query = self.root_of[queries], queries
        acc = np.zeros(len(queries), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            pattern, bits, first, count = self.levels[depth]
            acc = acc + np.bitwise_count((self.values[query] ^ pattern[node]) & bits[node])
            near = acc <= distance
            node, query, acc = node[near], query[near], acc[near]
            if depth:
                children = count[node]
                offset = np.arange(children.sum()) - np.repeat(np.cumsum(children) - children, children)
                query, acc = np.repeat(query, children), np.repeat(acc, children)
                node = np.repeat(first[node], children) + offset
        later = node > query
        return query[later], node[later]


def connected(values: np.ndarray, starts: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Chains through the linked members of each bucket: consecutive members, as two arrays of values."""
    sizes = np.diff(np.append(starts, len(values)))
    several = np.repeat(sizes > 1, sizes)
    values = values[several]
    sizes = sizes[sizes > 1]
    if not len(values):
        return values, values
    index = GrayIndex(values, np.cumsum(sizes) - sizes)
    label = np.arange(len(values))
    work = np.cumsum(np.repeat(sizes, sizes))
    at = 0
    while at < len(values):
        stop = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + HELD, "right")))
        a, b = index.links(np.arange(at, stop), distance)
        while len(a):
            a, b = label[a], label[b]
            apart = a != b
            a, b = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(label, b, a)
            while (label[label] != label).any():
                label = label[label]
        at = stop
    order = np.argsort(label, kind="stable")
    same = label[order][1:] == label[order][:-1]
    return values[order[:-1][same]], values[order[1:][same]]


def whole_buckets(
    batches: Iterator[pa.RecordBatch], limit: float
) -> Iterator[tuple[list[np.ndarray], np.ndarray | None]]:
    """The columns of whole buckets and where each begins, from rows that are sorted by all columns but the last.

    A bucket of more than `limit` rows comes alone and in parts, without beginnings.
    """
    held: list[list[np.ndarray]] = []
    size, passing, key = 0, False, None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        if not len(columns[0]):
            continue
        change = np.zeros(len(columns[0]) - 1, bool)
        for column in columns[:-1]:
            change |= column[1:] != column[:-1]
        starts = np.append(0, np.flatnonzero(change) + 1)
        if key == tuple(column[0] for column in columns[:-1]):  # the open bucket goes on
            stop = starts[1] if len(starts) > 1 else len(columns[0])
            held.append([column[:stop] for column in columns])
            size += stop
            if passing or size > limit:
                yield _joined(held), None
                held, passing = [], True
            if len(starts) == 1:
                continue
            columns, starts = [column[stop:] for column in columns], starts[1:] - stop
        if held:
            yield _joined(held), np.zeros(1, np.int64)
        last = starts[-1]
        if last:
            sizes = np.diff(starts)
            for at in np.flatnonzero(sizes > limit).tolist():
                yield [column[starts[at] : starts[at + 1]] for column in columns], None
            kept = np.repeat(sizes <= limit, sizes)
            small = sizes[sizes <= limit]
            if len(small):
                yield [column[:last][kept] for column in columns], np.cumsum(small) - small
        held, size = [[column[last:] for column in columns]], len(columns[0]) - last
        key, passing = tuple(column[last] for column in columns[:-1]), size > limit
        if passing:
            yield _joined(held), None
            held = []
    if held:
        yield _joined(held), np.zeros(1, np.int64)


def _joined(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(columns) for columns in zip(*parts)]


def _linked(rows: DataFrame, keys: list[str], distance: int, limit: float) -> DataFrame:
    """(a, b) links within the buckets of `rows` (keys, fp), and as (a, NULL, pair, key) the members of buckets beyond the limit."""
    # the sign is turned so that signed order is the order of the unsigned ranks
    rank = gray_rank(F.col("fp")).bitwiseXOR(F.lit(-(1 << 63)))
    dealt = rows.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys, rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "pair", "key"]
        for columns, starts in whole_buckets(batches, limit):
            if starts is None:
                pair, key, fp = columns[0], columns[1], columns[-1]
                none = pa.nulls(len(fp), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(fp), none, pa.array(pair, pa.int32()), pa.array(key)], names)
                continue
            a, b = connected(columns[-1].view(np.uint64), starts, distance)
            if len(a):
                ends = [pa.array(mixed(x).view(np.int64)) for x in (a, b)]
                yield pa.RecordBatch.from_arrays([*ends, pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.int64())], names)

    return map_arrow(dealt, run, "a long, b long, pair int, key long")


def _quarters() -> list[list[int]]:
    """For every pair of bands the other bits, in four parts, as signed 64-bit numbers."""
    found = []
    for mask in _masks():
        others = [bit for bit in range(64) if not mask >> bit & 1]
        parts = [sum(1 << bit for bit in others[at::4]) for at in range(4)]
        found.append([part - (1 << 64) if part >> 63 else part for part in parts])
    return found


def links(nodes: DataFrame, distance: int = DISTANCE, limit: int = 1 << 20) -> DataFrame:
    """(a, b): links between mixed fingerprints that connect all of `nodes` (fp) within the distance.

    The members of a bucket of more than `limit` are dealt out once more by each of four parts of the bits that the bucket does not
    fix: two that differ in at most 3 bits agree on one of the four, so no link is lost.
    """
    if distance > DISTANCE:
        raise ValueError(f"the bands find links of at most {DISTANCE} bits")
    keys = [F.struct(F.lit(i).alias("pair"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(_masks())]
    rows = nodes.select("fp", F.explode(F.array(*keys)).alias("bucket")).select("fp", "bucket.*")
    found = materialise(_linked(rows, ["pair", "key"], distance, limit))
    large = found.where("b IS NULL").select("pair", "key", F.col("a").alias("fp"))
    linked = found.where("b IS NOT NULL").select("a", "b")
    if large.isEmpty():
        return linked
    masks = F.get(F.array(*[F.array(*[F.lit(m) for m in masks]) for masks in _quarters()]), F.col("pair"))
    parts = F.transform(masks, lambda mask, at: F.struct(at.alias("part"), F.col("fp").bitwiseAND(mask).alias("bits")))
    again = large.select("pair", "key", "fp", F.inline(parts))
    return linked.unionByName(_linked(again, ["pair", "key", "part", "bits"], distance, float("inf")).select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the edges (a, b): the root is the same within a component."""

    def tidy(found: DataFrame) -> DataFrame:
        ordered = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return materialise(ordered.where("a < b").distinct())

    edges = tidy(edges)
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # stored, as the joins below can split hot keys only where both sides are shuffled for them
        step = materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")))
        onward = step.select(F.col("a").alias("to"), F.col("to").alias("next"))
        step = materialise(step.join(onward, "to").select(F.col("a").alias("node"), F.col("next").alias("root")))
        if labels is None:
            labels = step
        else:
            again = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = labels.join(again, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            labels = materialise(labels)
        for end in ("a", "b"):
            moved = step.select(F.col("node").alias(end), "root")
            edges = edges.join(moved, end).drop(end).withColumnRenamed("root", end)
        edges = tidy(edges)
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = DISTANCE, seed: int = 42) -> DataFrame:
    """(doc_id, version, fp, component_id, first) of every row of `docs` (doc_id, text).

    `version` is the text's hash; `first` marks the rows that stand for their component: those with
    its least (doc_id, version).
    """
    found = materialise(fingerprints(docs, shingle, seed))
    member = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "version")
    nodes = materialise(found.groupBy("node", "fp").agg(F.min(member).alias("least")))
    roots = components(links(nodes, distance))
    rooted = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    rooted = materialise(rooted)
    heads = materialise(rooted.groupBy("root").agg(F.min("least").alias("head")))
    named = materialise(rooted.join(heads, "root").select("node", "head"))
    joined = found.join(named, "node")
    return joined.select(
        "doc_id",
        "version",
        "fp",
        F.col("head.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("version") == F.col("head.version"))).alias("first"),
    )


def keep_first(docs: DataFrame, shingle: int = 3, distance: int = DISTANCE) -> DataFrame:
    """One row of `docs` for each component, its least (doc_id, text hash); all columns stay.

    Of rows repeated under one doc_id and text the first in the order of all columns stays. Rows go by the keys of
    those that do not stand for their component; while these keys are few, Spark broadcasts them and no text moves.
    """
    found = materialise(near_duplicates(docs, shingle, distance).select("doc_id", "version", "first"))
    found = found.withColumnsRenamed({"doc_id": "__doc", "version": "__version"})
    key = ["__doc", "__version"]
    others = materialise(found.where(~F.col("first")).select(*key).distinct())
    # rows are kept whole in a struct, so that their columns cannot clash with the keys
    keyed = docs.select(
        F.struct(*docs.columns).alias("__row"), docs["doc_id"].alias("__doc"), F.xxhash64(whole_text(docs["text"])).alias("__version")
    )
    kept = join_null_safe(keyed, others, key, "left_anti")
    repeated = materialise(found.where("first").groupBy(*key).count().where("count > 1").select(*key))
    if not repeated.isEmpty():
        several = first_row_per_key(join_null_safe(kept, repeated, key, "left_semi"), key, [])
        kept = join_null_safe(kept, repeated, key, "left_anti").unionByName(several)
    return kept.select("__row.*")
