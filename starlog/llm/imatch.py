"""I-Match fingerprints over randomised lexicons.

The lexicon is the terms within a band of inverse document frequency: neither so common that every
text has them nor so rare that they tell little. A text's distinct lexicon terms are sorted, and each of
several random subsets of the lexicon hashes those of them that it holds; texts that agree on a subset agree
in that hash. Subsets of many sizes are drawn, so that near copies agree on large ones and loosely
related texts on small ones only. The likeness of two fingerprints is the share of agreeing hashes
among the subsets in which either text has a term.

The band is given in shares of documents, which bounds the lexicon by (mean distinct terms of a text) /
`rare`, whatever the number of documents; so it is kept as one small value and no text or term of
a text is shuffled to look it up. Texts with fewer than `least` lexicon terms use all their terms.

Everything is built-in functions.

Edge cases: a NULL or empty text has no terms, its hashes are all 0 and two such texts have
likeness 1; equal texts have equal fingerprints; repeated and NULL doc ids are kept row by row (NULL last in
descending order, equal ids in order of text); one row is its own successor; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlog.llm.common import let, whole_text
from starlog.session import materialise

#: Random subsets of the lexicon in groups (one in how many terms, subsets, lowest bit of the draw). The subsets of a
#: group are disjoint; a term's hash is random, so the draws are bits of it that no other group takes.
SUBSETS = ((2, 2, 10), (8, 4, 12), (32, 8, 16), (64, 8, 24), (128, 10, 32))
#: Ranges of ids that rows are dealt to, at most; a range is sorted in one task, which can spill.
MOST_BLOCKS = 10_000
#: Parts of the lexicon, by hash, so that looking a term up is looking through a short list.
PARTS = 1 << 10


def terms(text: Column) -> Column:
    """The hashes of the distinct terms: lower-cased runs of letters, marks and digits."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda term: F.xxhash64(term)))


def lexicon(docs: DataFrame, common: float, rare: float, total: int | None = None) -> DataFrame:
    """(part, terms) of the lexicon: term hashes in a share of `rare` to `common` of the `total` documents of `docs` (text)."""
    total = docs.count() if total is None else total
    counts = docs.select(F.explode(terms(whole_text("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("docs"))
    band = counts.where((F.col("docs") >= max(2, rare * total)) & (F.col("docs") <= common * total))
    return band.groupBy(F.pmod("term", F.lit(PARTS)).alias("part")).agg(F.collect_list("term").alias("terms"))


def lookup(words: DataFrame) -> Column:
    """The lexicon as one value: for each part its terms."""
    every = words.sparkSession.range(PARTS).withColumnRenamed("id", "part").join(words, "part", "left")
    lists = F.sort_array(F.collect_list(F.struct("part", F.coalesce("terms", F.array().cast("array<long>")).alias("terms"))))
    return every.agg(F.transform(lists, lambda part: part["terms"])).scalar()


def subset_hashes(kept: Column) -> Column:
    """For each random subset the hash of the sorted terms it holds, 0 if none."""

    def group(size: int, count: int, bit: int) -> Column:
        def draw(term: Column) -> Column:
            return F.shiftrightunsigned(term, bit).bitwiseAND(F.lit(size - 1))

        def hashes(drawn: Column) -> Column:
            def one(subset: Column) -> Column:
                held = F.filter(drawn, lambda term: draw(term) == subset)
                return let(held, lambda found: F.when(F.size(found) == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(found)))

            return F.transform(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")), one)

        # most terms are in none of a group's subsets, so they are left out before the subsets are formed
        drawn = kept if count == size else F.filter(kept, lambda term: draw(term) < count)
        return let(drawn, hashes)

    return F.concat(*[group(*sizes) for sizes in SUBSETS])


def fingerprint(text: Column, words: Column, least: int = 4) -> Column:
    """The hashes of a text under the lexicon (as from `lookup`)."""

    def hashes(found: Column) -> Column:
        known = F.filter(found, lambda term: F.array_contains(F.get(words, F.pmod(term, F.lit(PARTS)).cast("int")), term))
        used = let(known, lambda inside: F.sort_array(F.when(F.size(inside) < least, found).otherwise(inside)))
        return let(used, subset_hashes)

    return let(terms(text), hashes)


def likeness(one: Column, other: Column) -> Column:
    """Share of agreeing hashes among those that are not empty in both fingerprints; 1 if all are."""
    pairs = F.zip_with(one, other, lambda a, b: F.when((a == 0) & (b == 0), F.lit(None)).otherwise(a == b))

    def share(found: Column) -> Column:
        judged = F.size(F.filter(found, lambda same: same.isNotNull()))
        agree = F.size(F.filter(found, lambda same: F.coalesce(same, F.lit(False))))
        return F.when(judged == 0, F.lit(1.0)).otherwise(agree / judged)

    return let(pairs, share)


def as_text(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def in_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """The rows (doc_id, text) dealt out by `block`, ranges of ids in descending order.

    Each block ends with a row marked `carry`: the first row of the block behind it, or of the
    first block for the last. Rows are shuffled once. The bounds are one number for each block, at most MOST_BLOCKS.
    """
    spark = rows.sparkSession
    blocks = min(blocks, MOST_BLOCKS)
    points = F.array(*[F.lit(at / blocks) for at in range(1, blocks)]).cast("array<double>")
    bounds = rows.agg(F.percentile_approx("doc_id", points, 10 * MOST_BLOCKS)).first()[0] if blocks > 1 else None
    cuts = sorted(set(bounds or []))
    # the bounds in lists of equal length, of which a row looks through one and the lists' ends
    length = max(1, math.isqrt(len(cuts)))
    lists = [cuts[at : at + length] for at in range(0, len(cuts), length)]
    ends = F.array(*[F.lit(one[-1]) for one in lists]).cast("array<long>")
    inner = F.array(*[F.array(*map(F.lit, one)) for one in lists]).cast("array<array<long>>")

    def below(found: Column) -> Column:
        return F.size(F.filter(found, lambda cut: cut < F.col("doc_id")))

    of_list = below(ends)
    before = F.least(of_list * length, F.lit(len(cuts))) + F.coalesce(below(F.get(inner, of_list)), F.lit(0))
    placed = rows.withColumn("block", F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(len(cuts) - before))

    # the first row of each block: its highest id, and of rows with that id the least text
    tops = placed.groupBy("block").agg(F.max("doc_id").alias("top")).withColumnRenamed("block", "at")
    tops = F.broadcast(materialise(tops))  # no more rows than blocks
    first = placed.join(tops, (placed["block"] == tops["at"]) & placed["doc_id"].eqNullSafe(tops["top"]))
    first = materialise(first.groupBy("block", "doc_id").agg(F.min("text").alias("text")))
    present = sorted(row.block for row in first.select("block").collect())
    before = spark.createDataFrame(list(zip(present, present[-1:] + present[:-1])), "block int, into int")
    carry = first.join(F.broadcast(before), "block").select("doc_id", "text", F.col("into").alias("block"))
    marked = placed.withColumn("carry", F.lit(False)).unionByName(carry.withColumn("carry", F.lit(True)))
    # each block is a task of its own, whatever the number of blocks
    return marked.repartitionById(blocks, F.col("block").cast("int"))


def _fingerprinted(rows: DataFrame, text: str, name: str, words: Column, least: int) -> DataFrame:
    # a lambda cannot hold the subquery itself, so it is a column for one step
    wide = rows.withColumn("words", words)
    return wide.withColumn(name, fingerprint(F.col(text), F.col("words"), least)).drop("words")


def compare_edited(
    docs: DataFrame, common: float = 0.5, rare: float = 0.005, least: int = 4, block_chars: int = 32 << 20
) -> DataFrame:
    """Fingerprint every row of `docs` (doc_id, text), its edited text and its successor's.

    The edited text is the text with its last half replaced by as much of the start of the next
    document's, in descending order of doc_id. Returns doc_id, n_chars, edited, fingerprint,
    edited_fingerprint, near_edited and near_next. A task holds a block of about `block_chars` characters.
    """
    plain = docs.select("doc_id", whole_text("text").alias("text"))
    total, chars = plain.agg(F.count("*"), F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()
    words = lookup(materialise(lexicon(plain, common, rare, total)))
    blocks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // block_chars))
    rows = _fingerprinted(in_blocks(plain, blocks), "text", "hashes", words, least)
    order = Window.partitionBy("block").orderBy("carry", F.col("doc_id").desc_nulls_last(), "text")
    chained = rows.withColumn("next", F.lead(F.struct("text", "hashes")).over(order)).where(~F.col("carry"))
    n = F.length("text")
    half = F.call_function("div", n, F.lit(2)).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    chained = chained.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "hashes", F.col("next.hashes").alias("next"))
    judged = _fingerprinted(chained, "edited", "edited_hashes", words, least)
    return judged.select(
        "doc_id",
        "n_chars",
        "edited",
        as_text(F.col("hashes")).alias("fingerprint"),
        as_text(F.col("edited_hashes")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next")).alias("near_next"),
    )
