"""Packing documents into training sequences by order-preserving dynamic programming.

The documents of a partition form one stream of tokens in row order, each closed by the end id.
Windows of at most `window` tokens are cut from the stream. A cut costs nothing after a
document, `sentence_cost` after a sentence and `hard_cost` elsewhere (tried only inside sentences longer
than a thirty-second of a window); an unfilled window costs its padding, unless its length is a power of two,
which is kept unpadded. With x the cut positions and f the least cost up to a cut,

    f(j) = cost(j) + min over x(j) - window <= x(i) < x(j) of  f(i) + window - (x(j) - x(i))

and as f(i) + x(i) does not depend on j, the minimum moves through a monotone queue in linear
time; the few predecessors at a power-of-two distance are tried beside it.

Edge cases: the string of a special token in a text is that token, as in the tokenizer's plain call, and ends
no document; a NULL or empty text is a document of the end id alone; NULL and repeated doc ids are
kept row by row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from starlog.llm.common import PieceTable, binary_lists, map_arrow, only

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, sequence_tokens long"
)
SENTENCE, DOCUMENT = 1, 2
LINE = 32
#: Sequence numbers of one partition start this far from those of the partition before.
PARTITION_STEP = 1 << 40
END = "\n\n"  # stands for the end of a document; a text never gives it, as line feeds are cut apart
#: Characters of text that join the stream at once, and how many times as many are cut into pieces at once.
CHARS, AT_ONCE = 1 << 20, 4
#: The rules of a tokenizer whose words WORDS finds in lower-case text of U+0000 to U+00FF, and APART alone between pieces.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
LETTERS, DIGITS = r"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"
APART = "\ue000"
WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\\t-\\r \\x85\\xa0{LETTERS}{DIGITS}{APART}]+|{APART}"
)


def words_apart(rules: dict) -> bool:
    """Whether a tokenizer with these rules encodes each of the WORDS by itself."""
    split, *others = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        not any(token["normalized"] for token in rules["added_tokens"])
        and (rules.get("normalizer") or {}).get("normalizers") == NORMALIZERS
        and [split.get(k) for k in ("type", "pattern", "behavior", "invert")] == ["Split", SPLIT, "Removed", True]
        and [[other.get(k) for k in ("type", "add_prefix_space", "use_regex")] for other in others] == [["ByteLevel", False, False]]
    )


@lru_cache(maxsize=2)
def word_table(path: str, end_id: int) -> tuple[PieceTable, str]:
    """Ids of words, one table per worker process, reused by its later tasks; which pieces are one word whatever WORDS says."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    rules = json.loads(tokenizer.to_str())
    added = [re.escape(token["content"]) for token in rules["added_tokens"]]
    whole = "|".join([f"^{END}$", r"[^\x00-\xff]", *added]) if words_apart(rules) else ""

    def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encoded in lines of a few words, which is faster than each alone; offsets tell them apart."""
        lines = [" ".join(words[at : at + LINE]) for at in range(0, len(words), LINE)]
        found = tokenizer.encode_batch(lines, add_special_tokens=False)
        ids = np.fromiter((i for line in found for i in line.ids), np.int32)
        begin = np.cumsum([0, *(len(line) + 1 for line in lines[:-1])])
        places = np.fromiter((at for line in found for at, _ in line.offsets), np.int64, len(ids))
        places += np.repeat(begin, [len(line) for line in found])
        starts = np.cumsum([0, *(len(word) + 1 for word in words)])
        lengths = np.bincount(np.searchsorted(starts, places, "right") - 1, minlength=len(words))
        if END in words:  # it has no ids of its own
            at = words.index(END)
            ids = np.insert(ids, lengths[:at].sum(), end_id)
            lengths[at] = 1
        return ids, lengths

    return PieceTable(encode, limit=600_000), whole


def pieces_of(texts: pa.Array) -> pa.DictionaryArray:
    """The texts cut at spaces and around line feeds, END after each; NULL texts are empty."""
    kind = pa.large_string()  # as cutting at line feeds lengthens a text
    cut = pc.replace_substring(pc.fill_null(texts.cast(kind), ""), "\n", " \n ")
    spaced = pc.binary_join_element_wise(cut, pa.scalar(END, kind), pa.scalar(" ", kind))
    return pc.list_flatten(pc.split_pattern(spaced, " ")).dictionary_encode()


def closing_kinds(pieces: pa.Array) -> np.ndarray:
    """What kind of cut may follow each piece: none (0), SENTENCE or DOCUMENT."""
    kinds = SENTENCE * pc.match_substring_regex(pieces, r"[.!?\n]\z").to_numpy(zero_copy_only=False).astype(np.int8)
    kinds[pc.equal(pieces, END).to_numpy(zero_copy_only=False)] = DOCUMENT
    return kinds


def ids_of(pieces: pa.Array, table: PieceTable, whole: str) -> pa.Array:
    """The ids of each of the distinct pieces, which share words that differ in case or in what stands around them."""
    alone = pc.match_substring_regex(pieces, whole)
    order = np.argsort(alone.to_numpy(zero_copy_only=False), kind="stable")  # those that are one word last
    rest = pieces.filter(alone).to_numpy(zero_copy_only=False).tolist()
    found = WORDS.findall(APART.join(pieces.filter(pc.invert(alone)).to_numpy(zero_copy_only=False)).lower())
    between = np.flatnonzero(np.fromiter(map(APART.__eq__, found), bool, len(found)))
    counts = np.ones(len(order), np.int64)
    if split := len(order) - len(rest):
        counts[:split] = np.diff(between, prepend=-1, append=len(found)) - 1
    ids, lengths = table.ids(table.numbers([*filter(APART.__ne__, found), *rest]))
    before = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(counts)]
    return binary_lists(ids, np.diff(before, prepend=0)).take(pa.array(np.argsort(order)))


def stretches(texts: pa.Array) -> list[int]:
    """Where the column is cut into stretches of about CHARS characters: the row after each."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    stops, done = [], 0
    while (stop := int(np.searchsorted(ends, done + CHARS)) + 1) <= len(texts):
        stops.append(stop)
        done = int(ends[stop - 1])
    if len(texts) > (stops[-1] if stops else 0):
        stops.append(len(texts))
    return stops


def plan_cuts(
    positions: np.ndarray,
    costs: np.ndarray,
    window: int,
    unpadded: Iterable[int] = (),
    begin: int = 0,
) -> list[int]:
    """Cut positions of least total cost, from `begin` to the last position, which is one of them.

    `positions` rise strictly, start above `begin` and never lie more than `window` apart.
    `unpadded` are window lengths, besides `window`, that need no padding.
    """
    x = [begin, *positions.tolist()]
    cost = [0.0, *costs.tolist()]
    exact: dict[int, list[int]] = {}
    whole = np.concatenate(([begin], positions))
    for length in unpadded:
        at = np.searchsorted(whole, whole - length)
        hit = np.flatnonzero(whole[np.minimum(at, len(whole) - 1)] == whole - length)
        for j, i in zip(hit.tolist(), at[hit].tolist()):
            exact.setdefault(j, []).append(i)
    best, came = [0.0] * len(x), [0] * len(x)
    queue, head = [(float(begin), begin, 0)], 0  # (f + x, x, index), rising; what lies before the head is out of reach
    for j in range(1, len(x)):
        here = x[j]
        while queue[head][1] < here - window:
            head += 1
        value, _, came[j] = queue[head]
        value += window - here
        if j in exact:
            for i in exact[j]:
                if best[i] < value:
                    value, came[j] = best[i], i
        best[j] = value = value + cost[j]
        value += here
        while len(queue) > head and queue[-1][0] > value:
            queue.pop()
        queue.append((value, here, j))
    cuts, j = [], len(x) - 1
    while j:
        cuts.append(x[j])
        j = came[j]
    return cuts[::-1]


class _Stream:
    """Tokens of a partition that are not yet in a finished window, with the cuts they allow."""

    def __init__(self, window: int, sentence_cost: float, hard_cost: float, unpadded: tuple[int, ...], first_id: int):
        self.window, self.sentence_cost, self.hard_cost, self.unpadded = window, sentence_cost, hard_cost, unpadded
        self.sequence = first_id
        self.begin = self.end = 0  # of the tokens held, counted from the start of the partition
        self.ids: list[np.ndarray] = []
        self.cuts: list[np.ndarray] = []
        self.kinds: list[np.ndarray] = []
        self.doc_ids: list[int | None] = []
        self.doc_starts: list[int] = [0]  # one more than documents: the last is where the next starts

    def add(self, doc_ids: list, ids: np.ndarray, ends: np.ndarray, kinds: np.ndarray) -> None:
        """Whole documents: their ids, and for each piece where it ends and what cut follows."""
        closing = kinds > 0
        cuts, kinds = self.end + ends[closing], kinds[closing]
        self.ids.append(ids)
        self.cuts.append(cuts)
        self.kinds.append(kinds)
        self.doc_ids.extend(doc_ids)
        self.doc_starts.extend(cuts[kinds == DOCUMENT].tolist())
        self.end += len(ids)

    def _candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Cut positions, strictly rising, and their costs; long sentences get hard cuts."""
        at, kinds = np.concatenate(self.cuts), np.concatenate(self.kinds)
        last = np.append(at[1:] != at[:-1], True)
        # of cuts at one position the last counts: the end of a document follows all others
        at, kinds = at[last], kinds[last]
        keep = at > self.begin
        at, costs = at[keep], np.where(kinds[keep] == DOCUMENT, 0.0, self.sentence_cost)
        step = self.window // 64
        gaps = np.diff(at, prepend=self.begin)
        wide = np.flatnonzero(gaps > 2 * step)
        if len(wide):
            hard = np.concatenate([np.arange(at[g] - gaps[g] + step, at[g], step) for g in wide])
            at, costs = np.append(at, hard), np.append(costs, np.full(len(hard), self.hard_cost))
            order = np.argsort(at, kind="stable")
            at, costs = at[order], costs[order]
        return at, costs

    def flush(self, final: bool) -> list[tuple]:
        """Pieces of the finished windows; unless final, the last window waits for more tokens."""
        if self.end == self.begin:
            return []
        ends = plan_cuts(*self._candidates(), self.window, self.unpadded, self.begin)
        if not final:
            ends = ends[:-1]
        else:
            ends = self._split_last(ends)
        return self._emit(ends) if ends else []

    def _split_last(self, ends: list[int]) -> list[int]:
        """Replace the last window by unpadded powers of two where that costs less than its padding."""
        start = ends[-2] if len(ends) > 1 else self.begin
        rest = ends[-1] - start
        powers = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
        if (len(powers) - 1) * self.hard_cost >= self.window - rest:
            return ends
        return [*ends[:-1], *(start + np.cumsum(powers)).tolist()]

    def _emit(self, ends: list[int]) -> list[tuple]:
        ids = np.concatenate(self.ids)
        starts = np.array([self.begin, *ends[:-1]], np.int64)
        sizes = np.array(ends, np.int64) - starts
        docs = np.array(self.doc_starts, np.int64)
        done = ends[-1]
        points = np.unique(np.concatenate((starts, docs[(docs > self.begin) & (docs < done)])))
        stops = np.append(points[1:], done)
        of_window = np.searchsorted(starts, points, "right") - 1
        of_doc = np.searchsorted(docs, points, "right") - 1
        words = np.ascontiguousarray(ids, "<u4")
        rows = []
        for a, b, w, d in zip(points.tolist(), stops.tolist(), of_window.tolist(), of_doc.tolist()):
            data = words[a - self.begin : b - self.begin].tobytes()
            begun, window = self.doc_starts[d], int(starts[w])
            rows.append(
                (
                    self.doc_ids[d],
                    a - begun,
                    b - a,
                    data,
                    self.doc_starts[d + 1] - begun,
                    self.sequence + w,
                    a - window,
                    int(sizes[w]),
                )
            )
        self.sequence += len(ends)
        open_doc = int(np.searchsorted(docs, done, "right")) - 1
        self.doc_ids, self.doc_starts = self.doc_ids[open_doc:], self.doc_starts[open_doc:]
        self.ids = [ids[done - self.begin :].copy()]
        cuts, kinds = np.concatenate(self.cuts), np.concatenate(self.kinds)
        self.cuts, self.kinds = [cuts[cuts > done]], [kinds[cuts > done]]
        self.begin = done
        return rows


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    window: int = 4096,
    sentence_cost: float = 4.0,
    hard_cost: float = 64.0,
    unpadded: tuple[int, ...] = (1024, 2048),
    hold_tokens: int = 1 << 20,
) -> DataFrame:
    """Pieces of all documents with their place in the sequences.

    `docs` has doc_id and text; `tokenizer` is a tokenizer file that every executor can read. Returns
    doc_id, start (the document's ids before the piece), length, ids (little-endian 32-bit), doc_tokens,
    sequence_id, offset (in its sequence) and sequence_tokens. Every partition is packed by itself in
    one pass without a shuffle, holding about `hold_tokens` tokens; only its last sequence can be
    short for lack of tokens.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    schema = pa.schema(
        [(n, pa.binary() if n == "ids" else pa.int64()) for n in [c.split()[0] for c in SCHEMA.split(", ")]]
    )

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, whole = word_table(tokenizer, end_id)
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) * PARTITION_STEP
        stream = _Stream(window, sentence_cost, hard_cost, unpadded, first)
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            texts, stops = batch.column("text"), stretches(batch.column("text"))
            at = 0
            for several in (stops[i : i + AT_ONCE] for i in range(0, len(stops), AT_ONCE)):
                pieces = pieces_of(texts[at : several[-1]])
                numbers, first_row = pieces.indices.to_numpy(), at
                kinds = closing_kinds(pieces.dictionary)[numbers]
                found = ids_of(pieces.dictionary, table, whole).take(pieces.indices)
                ids, ends = found.flatten().to_numpy(), found.offsets.to_numpy()[1:].astype(np.int64)
                closed = np.flatnonzero(kinds == DOCUMENT) + 1
                begin, done = 0, 0  # the pieces and ids before
                for stop in several:
                    last = int(closed[stop - first_row - 1])
                    size = int(ends[last - 1])
                    stream.add(doc_ids[at:stop], ids[done:size], ends[begin:last] - done, kinds[begin:last])
                    at, begin, done = stop, last, size
                    if stream.end - stream.begin >= hold_tokens and (rows := stream.flush(final=False)):
                        yield to_batch(rows)
        if rows := stream.flush(final=True):
            yield to_batch(rows)

    return map_arrow(only(docs, "doc_id", "text"), run, SCHEMA)
