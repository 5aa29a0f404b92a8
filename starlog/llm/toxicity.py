"""Toxic passages: maximum-scoring segments over word log-odds, calibrated by extreme values.

Model. From labelled texts, the log-odds of every word, and of its beginnings of 3 to 8 letters (which
gather inflected forms), are compared between toxic and clean texts under a Dirichlet prior drawn
from all of them; what differs clearly (by its deviance) is kept, with the bound of its log-odds
nearest to 0. A word scores by its clearest form, and every word a small negative drift.

Scan. The word scores of a text are searched for all maximal scoring segments in linear time
(Ruzzo and Tompa's method: a stack of candidate segments, each linked to the nearest one that
starts lower). With lambda and K of the score distribution in clean texts, a segment of score S in
a text of n words is expected K n exp(-lambda S) times by chance (Karlin and Altschul); its
passage is significant if that is below `max_expected`. The rarity of the best segment (minus the log
of its expected number) and the summed rarity of all go through a logistic curve fitted on the
labelled texts.

Edge cases: a NULL or empty text has no words and scores the curve's value for no segment; without labels
of both kinds every text scores 0; NULL and repeated doc ids are kept row by row; label rows that are
NULL or contradict each other count as they stand; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlog.llm.common import map_arrow, only, text_batches, whole_text
from starlog.session import materialise

WORD = re.compile(r"[^\W\d_]+")
STEMS = range(3, 9)
PASSAGES = "array<struct<start: long, end: long, score: double, expected: double>>"


@dataclass
class Model:
    """What scoring needs; its size is bounded by the sample it was fitted on."""

    weights: dict[str, tuple[float, float]] = field(default_factory=dict)  # log-odds, clarity
    drift: float = -0.5
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    curve: tuple[float, float, float] | None = None
    max_expected: float = 0.01

    def entry(self, word: str) -> float:
        """The log-odds of the clearest known form of the word, the drift if none is known."""
        forms = ["=" + word, *(word[:n] for n in STEMS if n <= len(word))]
        known = [self.weights[form] for form in forms if form in self.weights]
        return self.drift + (max(known, key=lambda found: abs(found[1]))[0] if known else 0.0)

    def rarity(self, score: float, words: int) -> float:
        """Minus the log of the number of such segments that a clean text has by chance."""
        return self.rate * score - math.log(self.scale * max(words, 1))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, behind last, score), in order."""
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[tuple[int, int, float, float, int]] = []  # first, stop, sum before, sum after, link
    for at in np.flatnonzero(scores > 0).tolist():
        first, stop, low, high = at, at + 1, float(sums[at]), float(sums[at + 1])
        while True:
            link = len(stack) - 1
            while link >= 0 and stack[link][2] >= low:
                link = stack[link][4]
            if link < 0 or stack[link][3] >= high:
                stack.append((first, stop, low, high, link))
                break
            # joined with all that lies between, and looked at again from there
            first, low = stack[link][0], stack[link][2]
            del stack[link:]
    return [(first, stop, high - low) for first, stop, low, high, _ in stack]


class Scorer:
    """Scores texts under a model, in one worker."""

    def __init__(self, model: Model, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.known: dict[str, float] = {}

    def _scores(self, words: list[str]) -> np.ndarray:
        try:
            return np.fromiter(map(self.known.__getitem__, words), float, len(words))
        except KeyError:
            if len(self.known) > self.limit:
                self.known.clear()
            self.known.update((word, self.model.entry(word)) for word in set(words).difference(self.known))
            return np.fromiter(map(self.known.__getitem__, words), float, len(words))

    def scan(self, text: str) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
        """The score of every word and the maximal scoring segments."""
        scores = self._scores(WORD.findall(text.lower()))
        return scores, segments(scores) if len(scores) and scores.max() > 0 else []

    def passages(self, text: str, words: int, found: list[tuple[int, int, float]]) -> list[tuple]:
        """(start, end, score, expected) of the significant segments, in characters."""
        rare = [(a, b, s, math.exp(-max(self.model.rarity(s, words), -700))) for a, b, s in found]
        rare = [segment for segment in rare if segment[3] < self.model.max_expected]
        if not rare:
            return []
        lowered = text.lower()
        spans = [m.span() for m in WORD.finditer(lowered)]
        places = [(spans[a][0], spans[b - 1][1] - 1) for a, b, *_ in rare]
        if len(lowered) != len(text):  # some letters lower to two
            of = [at for at, letter in enumerate(text) for _ in letter.lower()]
            places = [(of[first], of[last]) for first, last in places]
        return [(first, last + 1, s, e) for (first, last), (_, _, s, e) in zip(places, rare)]


def features(text: Column) -> Column:
    """The distinct words of a text, marked by "=", and their beginnings."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}]+"), F.lit(0)))
    starts = [F.transform(F.filter(words, lambda w: F.length(w) >= n), lambda w: F.substring(w, 1, n)) for n in STEMS]
    whole = F.transform(words, lambda w: F.concat(F.lit("="), w))
    return F.array_distinct(F.concat(whole, *starts))


def sample_labels(labels: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, toxic, weight): at most about `per_class` labelled rows of each class, by a hash of the id.

    A class with fewer rows is taken whole. The weight is how many rows of its class one stands for.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "toxic")
    counts = dict(known.groupBy("toxic").count().collect())
    parts = [F.lit(per_class / max(counts.get(kind, 0), per_class)) for kind in (0, 1)]
    share = F.when(F.col("toxic") == 1, parts[1]).otherwise(parts[0])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxic sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return known.where(draw < share).withColumn("weight", 1 / share)


def _evidence(t: Column, seen: Column, n_toxic: int, n_clean: int, prior: float) -> Column:
    """(bound, clarity) of a feature: the log-odds bound nearest to 0, and the signed root of the deviance."""
    c = seen - t
    share = prior * seen / (n_toxic + n_clean) + 0.5

    def odds(count: Column, total: int) -> Column:
        return F.log((count + share) / (total + prior - count))

    delta = odds(t, n_toxic) - odds(c, n_clean)
    spread = F.sqrt(1 / (t + share) + 1 / (c + share))

    def gain(count: Column, total: int) -> Column:
        chance = seen * (total / (n_toxic + n_clean))
        return F.when(count > 0, count * F.log(count / chance)).otherwise(0.0)

    deviance = F.greatest(2 * (gain(t, n_toxic) + gain(c, n_clean)), F.lit(0.0))
    return F.struct(
        (F.signum(delta) * F.greatest(F.abs(delta) - spread, F.lit(0.0))).alias("bound"),
        (F.signum(delta) * F.sqrt(deviance)).alias("clarity"),
    )


def weigh(texts: DataFrame, prior: float, clarity: float) -> list[dict[str, tuple[float, float]]]:
    """Weights of the clear features of `texts` (text, toxic, fold): from fold 0, from fold 1, from both.

    Empty where a fold lacks texts of one kind.
    """
    sizes = {(kind, fold): n for kind, fold, n in texts.groupBy("toxic", "fold").count().collect()}
    n_toxic, n_clean = ([sizes.get((kind, fold), 0) for fold in (0, 1)] for kind in (1, 0))
    counts = texts.select("toxic", "fold", F.explode(features(whole_text("text"))).alias("feature")).groupBy("feature")
    parts = [F.count_if(F.col("fold") == fold).alias(f"all{fold}") for fold in (0, 1)]
    parts += [F.count_if((F.col("fold") == fold) & (F.col("toxic") == 1)).alias(f"t{fold}") for fold in (0, 1)]
    counts = counts.agg(*parts).where("all0 + all1 >= 3")
    found = {}
    for name, folds in (("first", (0,)), ("second", (1,)), ("both", (0, 1))):
        t, seen = (sum((F.col(f"{part}{fold}") for fold in folds), F.lit(0)) for part in ("t", "all"))
        totals = sum(n_toxic[fold] for fold in folds), sum(n_clean[fold] for fold in folds)
        if all(totals):
            found[name] = F.when(seen > 0, _evidence(t, seen, *totals, prior))
    weights: list[dict[str, tuple[float, float]]] = [{}, {}, {}]
    if found:
        clear = [F.abs(evidence["clarity"]) >= clarity for evidence in found.values()]
        kept = [F.when(is_clear, evidence).alias(name) for is_clear, (name, evidence) in zip(clear, found.items())]
        for row in counts.select("feature", *kept).where(F.coalesce(*[F.col(name) for name in found]).isNotNull()).collect():
            for at, name in enumerate(("first", "second", "both")):
                if name in found and row[name] is not None:
                    weights[at][row.feature] = tuple(row[name])
    return weights


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - 1e-3 * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(beta))
        step = np.linalg.solve(bend, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def signals(model: Model, words: int, scores: list[float]) -> tuple[float, float]:
    """The inputs of the curve: how rare the best segment is by chance, and the summed rarity of all."""
    rarity = [model.rarity(score, words) for score in scores]
    return max(-20.0, min(20.0, max(rarity, default=-20.0))), math.log1p(sum(x for x in rarity if x > 0))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 10_000, prior: float = 10.0, clarity: float = 4.0) -> Model:
    """A model from the labelled rows; `labels` has doc_id and toxic and holds only rows to learn from.

    The model is fitted on a sample of at most about `per_class` labelled texts of each class, so
    the sample's ids, its word counts and its measures are bounded whatever the input. The chance
    scale and the curve are fitted on scores of texts under the weights of the other half.
    """
    # bounded by 2 * per_class rows, so it is safe to broadcast
    sample = F.broadcast(materialise(sample_labels(labels, per_class)))
    texts = only(docs, "doc_id", "text").join(sample, "doc_id").dropDuplicates(["doc_id", "text", "toxic"])
    texts = materialise(texts.select("text", "toxic", "weight", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold")))
    *halves, weights = weigh(texts, prior, clarity)
    model = Model(weights)
    if not weights:
        return model
    crossed = [Model(halves[1 - fold] or weights) for fold in (0, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(crossed[fold]) for fold in (0, 1)]
        for batch in batches:
            for at, texts in text_batches(batch, "text"):
                rows = batch.slice(at, len(texts))
                found = [scorers[fold].scan(text) for text, fold in zip(texts, rows.column("fold").to_pylist())]
                spread = [np.unique(scores, return_counts=True) for scores, _ in found]
                columns = {
                    "toxic": rows.column("toxic").cast(pa.int32()),
                    "weight": rows.column("weight"),
                    "words": pa.array([len(scores) for scores, _ in found], pa.int64()),
                    "best": pa.array([[s for _, _, s in segs] for _, segs in found], pa.list_(pa.float64())),
                    "values": pa.array([v for v, _ in spread], pa.list_(pa.float64())),
                    "counts": pa.array([n for _, n in spread], pa.list_(pa.int64())),
                }
                yield pa.RecordBatch.from_pydict(columns)

    schema = "toxic int, weight double, words long, best array<double>, values array<double>, counts array<long>"
    measured = materialise(map_arrow(texts, run, schema))
    pairs = measured.where("toxic = 0").select(F.inline(F.arrays_zip("values", "counts")))
    spread = np.array(pairs.groupBy("values").agg(F.sum("counts").cast("double")).collect()).reshape(-1, 2)
    if len(spread):
        # clean texts may hold no positive score at all, so half an occurrence of the highest is added
        highest = model.drift + max(bound for bound, _ in weights.values())
        spread = np.vstack((spread, [highest, 0.5]))
        model.rate = rate_of(spread[:, 0], spread[:, 1] / spread[:, 1].sum())
    rows = measured.select("toxic", "weight", "words", "best").collect()
    clean = [(row.words, max(row.best)) for row in rows if row.toxic == 0 and row.best]
    if clean:
        # K from the clean texts: as many exceed the median best score as it makes expected
        middle = float(np.median([best for _, best in clean]))
        chance = sum(max(row.words, 1) for row in rows if row.toxic == 0) * math.exp(-model.rate * middle)
        model.scale = max(sum(best >= middle for _, best in clean) / max(chance, 1e-12), 1e-6)
    inputs = np.array([signals(model, row.words, row.best) for row in rows])
    model.curve = _fit_curve(inputs, np.array([float(row.toxic) for row in rows]), np.array([row.weight for row in rows]))
    return model


def rate_of(values: np.ndarray, share: np.ndarray) -> float:
    """Lambda: the positive solution of sum(share * exp(lambda * value)) = 1."""
    if values.max() <= 0 or (values * share).sum() >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while (share * np.exp(high * values)).sum() < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (share * np.exp(middle * values)).sum() < 1 else (low, middle)
    return max(high, 1e-3)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, passages) of every row of `docs`; passages are the significant toxic ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            for at, texts in text_batches(batch, "text"):
                found = [scorer.scan(text) for text in texts]
                scores = np.zeros(len(texts))
                if model.curve:
                    inputs = [signals(model, len(words), [s for _, _, s in segs]) for words, segs in found]
                    base, *slopes = model.curve
                    scores = 1 / (1 + np.exp(-np.clip(base + np.array(inputs) @ np.array(slopes), -30, 30)))
                passages = [scorer.passages(t, len(words), segs) for t, (words, segs) in zip(texts, found)]
                names = ("start", "end", "score", "expected")
                passages = [[dict(zip(names, passage)) for passage in one] for one in passages]
                kind = pa.list_(pa.struct([(n, pa.int64() if n in ("start", "end") else pa.float64()) for n in names]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array(scores), pa.array(passages, kind)],
                    ["doc_id", "score", "passages"],
                )

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(only(docs, "doc_id", "text"), run, f"doc_id {doc_type}, score double, passages {PASSAGES}")
