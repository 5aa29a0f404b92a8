"""Importance resampling towards a target corpus, with features counted once per distinct line.

Features are runs of 1 to `max_n` consecutive words, hashed into buckets by the CRC-32 of their
bytes. A bucket's gain is the log ratio of its smoothed share in the target corpus and in the
documents, in thousandths; a document's weight is the floored mean gain of its features. Documents
are drawn without replacement by the greatest weight + Gumbel noise, which depends on the document id and a seed.

Line feeds cut texts into lines. Equal lines are found first, over all documents; the features of a
distinct line are hashed and counted once and multiplied by its occurrences, and so is its summed
gain. Features that span lines are worked out per document and added. Words hold no line feed, so nothing else differs from counting texts whole.

Line texts are shuffled once, after equal lines of a task were collapsed; after that only their two
64-bit keys move. A line that stands in very many documents meets them in a join that Spark can split.
Counts are kept per bucket (`buckets` rows); the ranking is range-partitioned.

Edge cases: a NULL or empty text has no words, weight 0 and is never drawn; a NULL id draws its noise
as an empty one; repeated rows count and are drawn each by itself; equal scores go to the smaller
id, NULL first; an empty table gives no rows, and an empty target is counted as no features.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlog.llm.common import let, only, whole_text
from starlog.operators.windows import number_rows
from starlog.session import materialise

#: Words are runs of digits, letters a to z and all beyond ASCII; the text is lower-cased from A to Z alone.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
KEY = ["key", "key2"]


def words_in(text: Column) -> Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lowered, BETWEEN_WORDS), lambda word: word != "")


def lines_of(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line != "")


def line_key(line: Column) -> Column:
    """Two hashes of 64 bits, which tell lines apart."""
    return F.struct(F.xxhash64(line).alias("key"), F.xxhash64(F.lit(1), line).alias("key2"))


def bucket_of(feature: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(feature), F.lit(buckets)).cast("int")


def runs_of(words: Column, max_n: int) -> Column:
    """All runs of 1 to max_n consecutive words."""

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(words) - (n - 1))
        runs = F.transform(starts, lambda at: F.array_join(F.slice(words, at, n), " "))
        return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<string>"))

    return F.concat(words, *[of(n) for n in range(2, max_n + 1)])


def runs_across(text: Column, max_n: int) -> Column:
    """The runs of 2 to max_n words whose words stand on more than one line."""
    if max_n < 2:
        return F.array().cast("array<string>")
    lines = F.transform(lines_of(text), words_in)
    places = F.flatten(F.transform(lines, lambda words, at: F.transform(words, lambda w: F.struct(w.alias("w"), at.alias("line")))))

    def of(marked: Column, n: int) -> Column:
        starts = F.when(F.size(marked) >= n, F.sequence(F.lit(1), F.size(marked) - (n - 1))).otherwise(F.array().cast("array<int>"))
        spanning = F.filter(starts, lambda at: F.get(marked, at - 1)["line"] != F.get(marked, at + (n - 2))["line"])
        return F.transform(spanning, lambda at: F.array_join(F.transform(F.slice(marked, at, n), lambda x: x["w"]), " "))

    return let(places, lambda marked: F.concat(*[of(marked, n) for n in range(2, max_n + 1)]))


def distinct_lines(docs: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """(key, key2, times, n_words, features): every distinct line once, features as bucket numbers."""
    lines = docs.select(F.explode(lines_of(whole_text("text"))).alias("line")).groupBy("line").agg(F.count("*").alias("times"))
    # the words are found in a step of their own, so that each use does not look for them anew
    found = lines.select(line_key(F.col("line")).alias("at"), "times", F.explode(F.array(words_in(F.col("line")))).alias("words"))
    features = F.transform(runs_of(F.col("words"), max_n), lambda run: bucket_of(run, buckets))
    return materialise(found.select("at.*", "times", F.size("words").alias("n_words"), features.alias("features")))


def across_lines(docs: DataFrame, max_n: int, buckets: int, keep: list[str]) -> DataFrame:
    """Per row its `keep` columns, a row number, its lines' keys and the buckets of its runs across lines."""
    text = whole_text("text")
    return materialise(
        docs.select(
            F.struct(*[docs[name] for name in keep]).alias("kept"),
            F.monotonically_increasing_id().alias("row"),
            F.transform(lines_of(text), line_key).alias("lines"),
            F.transform(runs_across(text, max_n), lambda run: bucket_of(run, buckets)).alias("across"),
        )
    )


def bucket_counts(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """(bucket, n): the features of distinct lines times their occurrences, and those across lines."""
    within = lines.select(F.explode("features").alias("bucket"), "times")
    spanning = rows.select(F.explode("across").alias("bucket"), F.lit(1).cast("long").alias("times"))
    return within.unionByName(spanning).groupBy("bucket").agg(F.sum("times").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """One row with `gains`, the gain of every bucket by its number."""
    source, target = source.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    every = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(source, "bucket", "left").join(target, "bucket", "left").fillna(0, ["s", "t"])
    listed = counts.agg(
        F.sum("s").cast("double").alias("S"),
        F.sum("t").cast("double").alias("T"),
        F.array_sort(F.collect_list(F.struct("bucket", "s", "t"))).alias("counts"),
    )

    def gain(c: Column) -> Column:
        ratio = (c["t"].cast("double") + 1) * (F.col("S") + buckets) / ((c["s"].cast("double") + 1) * (F.col("T") + buckets))
        return F.floor(F.lit(1000.0) * F.log(ratio))

    return materialise(listed.select(F.transform("counts", gain).alias("gains")))


def weigh(docs: DataFrame, target: DataFrame, max_n: int = 1, buckets: int = 10_000, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(columns of `keep`, n_words, n_features, weight) of every row of `docs` against the texts of `target`."""
    keep = list(keep)
    rows = across_lines(docs, max_n, buckets, keep)
    lines = distinct_lines(docs, max_n, buckets)
    target = only(target, "text")
    wanted = bucket_counts(distinct_lines(target, max_n, buckets), across_lines(target, max_n, buckets, ["text"]).select("across"))
    table = gains(bucket_counts(lines, rows), wanted, buckets).select("gains").scalar()
    none = F.lit(0).cast("long")

    def summed(features: str) -> Column:
        return F.aggregate(features, none, lambda total, at: total + F.get("gains", at))

    # stored, so that the join shuffles it by the line for itself and a hot line can be split
    valued = lines.withColumn("gains", table).select(
        *KEY, "n_words", F.size("features").alias("n_features"), summed("features").alias("gain")
    )
    valued = materialise(valued)
    within = rows.select("row", F.inline("lines")).join(valued, KEY).drop(*KEY)
    itself = rows.withColumn("gains", table).select(
        "row", none.alias("n_words"), F.size("across").alias("n_features"), summed("across").alias("gain"), "kept"
    )
    parts = within.unionByName(itself, allowMissingColumns=True)
    named = [F.first(F.col("kept")[name], ignorenulls=True).alias(f"kept_{at}") for at, name in enumerate(keep)]
    sums = parts.groupBy("row").agg(*[F.sum(n).cast("long").alias(n) for n in ("n_words", "n_features", "gain")], *named)
    mean = F.when(F.col("n_features") > 0, F.call_function("div", F.col("gain") - F.pmod("gain", "n_features"), F.col("n_features")))
    weighed = sums.select(
        *[F.col(f"kept_{at}").alias(name) for at, name in enumerate(keep)],
        "n_words",
        "n_features",
        F.coalesce(mean, none).alias("weight"),
    )
    return materialise(weighed)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, by the first 32 bits of the SHA-256 of `seed:doc_id`."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / 4294967296.0)))


def resample(weighed: DataFrame, percent: int = 10, min_words: int = 20, seed: int = 2024) -> DataFrame:
    """The rows of `weigh` with `score` and `rank`: 1, 2, … for those drawn, NULL for the others.

    Of the rows of `min_words` words and more, `percent` per cent (rounded down) are drawn.
    """
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    able = F.coalesce(F.col("n_words") >= min_words, F.lit(False))
    drawn = percent * scored.where(able).count() // 100
    others = [name for name in scored.columns if name not in ("score", "doc_id")]
    ranked = number_rows(scored.where(able), ["-score", "doc_id", *others], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    return ranked.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))
