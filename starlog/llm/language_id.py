"""Language identification: averaged hashed subword embeddings under a linear softmax.

Model. A text is lower-cased; its letters and marks form words, and every run of 1 to 4 characters
inside a word, its two borders included, is a subword, hashed into one of `buckets`. Each bucket has an embedding; the mean
over all subwords of a text goes through a linear softmax over the languages. Both layers are
trained by stochastic gradient descent in numpy, on short, middle and long pieces of texts, one at a time, with a falling rate.

Calibration. A fifth of the sampled texts is kept from training. On their pieces the logits are scaled by
exp(a + b log(1 + subwords)), with the a and b of least log loss, so that the score is the chance
that the language is right. The rejection threshold is the least score at and above which at most `max_error` of them are wrong.

The sample is the documented bound of the fit: about `sample_docs` labelled texts, drawn by a hash
from all, the same number of each language, six pieces of each. The most frequent
`max_languages` labels are learned. Scoring covers every text whole.

Edge cases: a text that is NULL or has no letter is `und` with score 0; so is every text if there is
nothing to learn from; of one language alone every text with letters is taken for it; NULL labels are not learned from; repeated
rows are scored each by itself and learned once; an empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlog.llm.common import map_arrow, only
from starlog.session import materialise

UNDETERMINED = "und"
LONGEST = 4
#: Letters and marks of a piece of text to learn from: two of each length from every sampled text.
PIECES = (16, 64, 256)
#: Characters whose subwords are looked at together.
CHARS = 1 << 18
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@cache
def _classes() -> np.ndarray:
    """Per code point: 2 for a letter, 1 for a mark, 0 for all else."""
    return np.array([{"L": 2, "M": 1}.get(category(chr(point))[0], 0) for point in range(0x110000)], np.int8)


def characters(text: str) -> tuple[np.ndarray, bool]:
    """Code points of the lower-cased text, 0 for all that is neither letter nor mark; whether it has a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _classes()[points]
    return np.where(kinds > 0, points, 0), bool((kinds == 2).any())


def subwords(points: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all subwords, in arrays of bounded size."""
    bordered = np.concatenate(([0], points, np.zeros(LONGEST, points.dtype))).astype(np.uint64)
    for first in range(0, len(points) + 1, CHARS):
        window = bordered[first : first + CHARS + LONGEST - 1]
        starts = min(CHARS, len(points) + 1 - first)
        inside = window != 0
        state = np.zeros(starts, np.uint64)
        whole = np.ones(starts, bool)  # no border but at the first place
        found = []
        for n in range(1, LONGEST + 1):
            last = slice(n - 1, n - 1 + starts)
            state = (state + window[last] + np.uint64(n)) * MULTIPLIER
            state ^= state >> np.uint64(29)
            # a border may only be the first or the last character, and not all there is
            usable = whole & (inside[:starts] | inside[last]) if n < 3 else whole
            found.append((state[usable] >> np.uint64(7)) % np.uint64(buckets))
            whole = whole & inside[last] if n > 1 else whole
        yield np.concatenate(found).astype(np.int64)


@dataclass
class Model:
    """What scoring needs: buckets * dimensions numbers, and dimensions for each language."""

    languages: list[str] = field(default_factory=list)
    embeddings: np.ndarray = field(default_factory=lambda: np.zeros((1, 1), np.float32))
    output: np.ndarray = field(default_factory=lambda: np.zeros((1, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    scale: tuple[float, float] = (0.0, 0.0)
    threshold: float = 0.0

    def logits(self, points: np.ndarray) -> tuple[np.ndarray, int]:
        """The raw logits of a text and how many subwords it has."""
        total, n = np.zeros(self.embeddings.shape[1]), 0
        for ids in subwords(points, len(self.embeddings)):
            total += self.embeddings[ids].sum(axis=0, dtype=np.float64)
            n += len(ids)
        return total / max(n, 1) @ self.output + self.bias, n

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and the chance that it is right."""
        points, has_letter = characters(text or "")
        if not has_letter or not self.languages:
            return UNDETERMINED, 0.0
        logits, n = self.logits(points)
        chances = calibrated(logits[None], np.array([n]), *self.scale)[0]
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def calibrated(logits: np.ndarray, n: np.ndarray, a: float, b: float) -> np.ndarray:
    return softmax(logits * np.exp(a + b * np.log1p(n))[:, None])


def train(
    pieces: list[np.ndarray], truth: np.ndarray, languages: list[str], buckets: int, dimensions: int, epochs: int, rate: float
) -> Model:
    """Stochastic gradient descent over the pieces, each given by its characters."""
    draw = np.random.default_rng(0)
    model = Model(
        languages,
        ((draw.random((buckets, dimensions)) - 0.5) / dimensions).astype(np.float32),
        np.zeros((dimensions, len(languages)), np.float32),
        np.zeros(len(languages), np.float32),
    )
    held = []
    for points in pieces:
        ids, times = np.unique(np.concatenate(list(subwords(points, buckets))), return_counts=True)
        held.append((ids, (times / max(times.sum(), 1)).astype(np.float32)))
    steps = epochs * len(pieces)
    for step in range(steps):
        if step % max(len(pieces), 1) == 0:
            order = draw.permutation(len(pieces))
        at = order[step % len(pieces)]
        ids, shares = held[at]
        now = np.float32(rate * (1 - step / steps))
        mean = shares @ model.embeddings[ids]
        wrong = softmax(mean @ model.output + model.bias)
        wrong[truth[at]] -= 1
        back = model.output @ wrong
        model.output -= now * np.outer(mean, wrong)
        model.bias -= now * wrong * np.float32(0.1)
        # the mean over many subwords makes each one's share small, so a step is taken in the mean itself
        model.embeddings[ids] -= now * np.outer(shares / shares.max(), back)
    return model


def calibrate(model: Model, pieces: list[np.ndarray], truth: np.ndarray, max_error: float) -> None:
    """Set the model's scale and rejection threshold from pieces it was not trained on."""
    if not pieces or len(model.languages) < 2:
        return
    scored = [model.logits(points) for points in pieces]
    logits, n = np.array([one for one, _ in scored]), np.array([count for _, count in scored])
    rows = np.arange(len(truth))

    def loss(a: float, b: float) -> float:
        return -np.log(np.maximum(calibrated(logits, n, a, b)[rows, truth], 1e-12)).mean()

    best, reach = (0.0, 0.0), 2.0
    for _ in range(8):  # a grid around the best found so far, each time half as wide
        tries = [(best[0] + reach * x, best[1] + reach * y / 4) for x in (-1, -0.5, 0, 0.5, 1) for y in (-1, -0.5, 0, 0.5, 1)]
        best, reach = min(tries, key=lambda ab: loss(*ab)), reach / 2 ** 0.5
    model.scale = best
    chances = calibrated(logits, n, *best)
    order = np.argsort(-chances.max(axis=1), kind="stable")
    errors = np.cumsum(chances.argmax(axis=1)[order] != truth[order])
    right = np.flatnonzero(errors <= max_error * np.arange(1, len(order) + 1))
    model.threshold = float(chances.max(axis=1)[order][right[-1]]) if len(right) else 1.0


def sample(docs: DataFrame, languages: dict[str, int], sample_docs: int) -> DataFrame:
    """(lang, fold, points): pieces of about `sample_docs` texts, as many of each of the (language, count)."""
    share = F.lit(0.0)
    for lang, count in languages.items():
        share = F.when(F.col("lang") == lang, min(1.0, sample_docs / len(languages) / count)).otherwise(share)
    draw = F.pmod(F.xxhash64("text", "doc_id", F.lit("language sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    texts = only(docs, "doc_id", "text", "lang").where((draw < share) & F.col("text").isNotNull())
    # the texts are bounded in number, so that they may be dealt out anew
    texts = materialise(texts.select("lang", "text").dropDuplicates())
    fold = F.pmod(F.xxhash64("text"), F.lit(5)).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, folds, found = [], [], []
            for lang, fold, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                points, has_letter = characters(text)
                if not has_letter:
                    continue
                for at, length in enumerate(PIECES * 2):
                    first = max(len(points) - length, 0) * at // (2 * len(PIECES) - 1)
                    piece = points[first : first + length]
                    if piece.any():
                        langs.append(lang)
                        folds.append(fold)
                        found.append(piece.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(folds, pa.int32()), pa.array(found, pa.list_(pa.int32()))],
                ["lang", "fold", "points"],
            )

    return map_arrow(texts.select("lang", fold.alias("fold"), "text"), run, "lang string, fold int, points array<int>")


def fit(
    docs: DataFrame,
    sample_docs: int = 4000,
    max_languages: int = 256,
    buckets: int = 1 << 15,
    dimensions: int = 16,
    epochs: int = 3,
    rate: float = 0.5,
    max_error: float = 0.01,
) -> Model:
    """A model from the texts and languages of `docs` (doc_id, text, lang), which holds only rows to learn from."""
    known = only(docs, "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    ranked = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    languages = {row["lang"]: row["count"] for row in sorted(ranked)}
    if not languages:
        return Model()
    rows = sample(docs, languages, sample_docs).toArrow().sort_by([("lang", "ascending"), ("fold", "ascending")])
    number = {lang: at for at, lang in enumerate(languages)}
    truth = np.array([number[lang] for lang in rows.column("lang").to_pylist()], np.int64)
    points = [np.array(one, np.uint32) for one in rows.column("points").to_pylist()]
    # in an order of their own, whatever the order in which tasks return
    order = sorted(range(len(points)), key=lambda at: (truth[at], points[at].tobytes()))
    folds = rows.column("fold").to_pylist()
    learned, judged = [at for at in order if folds[at]], [at for at in order if not folds[at]]
    model = train([points[at] for at in learned], truth[learned], list(languages), buckets, dimensions, epochs, rate)
    calibrate(model, [points[at] for at in judged], truth[judged], max_error)
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every row of `docs`; accepted tells scores above the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(text.as_py()) for text in batch.column("text")]
            langs, scores = [lang for lang, _ in found], [score for _, score in found]
            accepted = [lang != UNDETERMINED and score >= model.threshold for lang, score in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())],
                ["doc_id", "lang_pred", "score", "accepted"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(only(docs, "doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double, accepted boolean")
