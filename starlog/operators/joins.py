"""Joins and lookups.

No join carries a broadcast hint: Spark broadcasts a side whose known size is below
`spark.sql.autoBroadcastJoinThreshold` and otherwise sorts and merges, with adaptive
execution splitting skewed partitions. It can split only where both sides are shuffled for the
join itself. A side that was grouped by the join key before is not, so such sides are joined
with `join_null_safe` or `join_resplit`, whose keys call for a shuffle of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlog.operators.dedupe import first_row_per_key
from starlog.operators.filters import without_nulls
from starlog.session import materialise


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join on keys in which NULL matches NULL; the keys appear once, from the left."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = reduce(Column.__and__, [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{key}" for key in keys])


def join_resplit(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Plain equi-join (NULL matches nothing) with a right side that was grouped by the keys."""
    return join_null_safe(left, without_nulls(right, keys), keys, how)


def lookup_at_most_one(
    rows: DataFrame, lookup: DataFrame, keys: list[str], order: list[Column], wanted: list[str]
) -> DataFrame:
    """Left lookup that never multiplies rows: the first match by `order` wins, NULLs if none."""
    single = first_row_per_key(lookup, keys, order).select(*keys, *wanted)
    return join_resplit(rows, single, keys, "left")


def keep_listed(rows: DataFrame, codes: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Rows whose column is one of the listed codes (semi-join)."""
    return join_resplit(rows, codes.select(F.col(code).alias(column)), [column], "left_semi")


def orphans(rows: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key values without a parent and how many rows hold each; NULL keys pass.

    The values are counted before the join, so a hot key is one row by then.
    """
    held = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return held.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")


def _label_texts(labels: DataFrame) -> DataFrame:
    """(_first, _text) of the labels: what is looked for, and the label in lower case.

    A label list is small but its substrings are not, so it is dealt to many tasks.
    """
    tasks = int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = labels.where(F.col("label").isNotNull()).repartition(tasks, "ordinal")
    return texts.select(F.struct("ordinal", "code").alias("_first"), F.lower("label").alias("_text"))


def _gram_places(texts: DataFrame, gram: int) -> DataFrame:
    """(_first, _gram, _from) of every place of a label at which a substring of `gram` characters begins."""
    starts = F.when(F.length("_text") >= gram, F.sequence(F.lit(1), F.length("_text") - gram + 1))
    places = texts.select("_first", "_text", F.explode(starts).alias("_from"))
    return places.select("_first", F.expr(f"substring(_text, _from, {gram})").alias("_gram"), "_from")


def _rarest_grams(terms: DataFrame, places: DataFrame, gram: int) -> DataFrame:
    """(_term, _gram, _offset): every term's substring that begins at the fewest places of labels.

    Terms with a substring that no label holds are left out: no label contains them.
    """
    starts = F.sequence(F.lit(1), F.length("_term") - gram + 1)
    own = terms.select("_term", F.explode(starts).alias("_offset"))
    own = own.select("_term", F.expr(f"substring(_term, _offset, {gram})").alias("_gram"), (F.col("_offset") - 1).alias("_offset"))
    # stored, so that the join shuffles both sides for itself and can split a frequent substring
    held = materialise(places.groupBy("_gram").agg(F.count("*").alias("_places")))
    met = own.join(held, "_gram", "left")
    rarity = F.struct(F.col("_places").alias("places"), F.col("_gram").alias("gram"), F.col("_offset").alias("offset"))
    best = met.groupBy("_term").agg(F.min(rarity).alias("_best"), F.count_if(F.col("_places").isNull()).alias("_lacking"))
    return best.where("_lacking = 0").select(
        "_term", F.col("_best.gram").alias("_gram"), F.col("_best.offset").alias("_offset")
    )


def cut_candidates(terms: DataFrame, texts: DataFrame, gram: int) -> DataFrame:
    """(_term, _first): substrings of labels that are as long as a term and hold its rarest gram at the term's place for it.

    `terms` has `_term`, distinct and longer than `gram`. Candidates are cut per (gram, offset, length), not per
    term, so that terms or labels with a shared part do not meet in pairs; a term is among them if a label contains it.
    """
    places = materialise(_gram_places(texts, gram))
    keyed = _rarest_grams(terms, places, gram)
    shapes = materialise(keyed.select("_gram", "_offset", F.length("_term").alias("_length")).distinct())
    spans = places.join(shapes, "_gram").select("_first", (F.col("_from") - F.col("_offset")).alias("_from"), "_length")
    cut = spans.where("_from >= 1").join(texts, "_first").where(F.col("_from") + F.col("_length") - 1 <= F.length("_text"))
    return cut.select(F.expr("substring(_text, _from, _length)").alias("_term"), "_first")


def first_label_containing(terms: DataFrame, term: str, labels: DataFrame, gram: int = 8) -> DataFrame:
    """For each distinct term the code of the first label (by `ordinal`) that contains it, in any case.

    `labels` has columns ordinal (long), code and label. Returns (term, code), code NULL where no
    label contains the term. A term of up to `gram` characters is looked up among the labels' substrings of
    its length. A longer one is found by its rarest substring of `gram` characters: where that
    stands in a label, the characters around it are cut out and compared as a key. The distinct terms are stored once, as they are
    read more than once.
    """
    wanted = materialise(terms.select(term).where(F.col(term).isNotNull()).distinct())
    wanted = wanted.select(term, F.lower(F.col(term)).alias("_term"))
    texts = _label_texts(labels)
    short, long = F.length("_term") <= gram, F.length("_term") > gram
    lengths = wanted.where(short).select(F.collect_set(F.length("_term"))).scalar()  # no more than `gram` + 1
    fitting = F.array_intersect(lengths, F.sequence(F.lit(0), F.least(F.length("_text"), F.lit(gram))))
    spans = texts.select("_first", "_text", F.explode(fitting).alias("_len"))
    starts = F.sequence(F.lit(1), F.length("_text") - F.col("_len") + 1)
    pieces = spans.select("_first", "_text", "_len", F.explode(starts).alias("_from")).select(
        "_first", F.expr("substring(_text, _from, _len)").alias("_term")
    )
    candidates = pieces.unionByName(cut_candidates(wanted.where(long).select("_term").distinct(), texts, gram).select("_first", "_term"))
    found = candidates.groupBy("_term").agg(F.min("_first").alias("_found"))
    return wanted.join(found, "_term", "left").select(term, F.col("_found.code").alias("code"))


def add_first_label(rows: DataFrame, term: str, labels: DataFrame, name: str) -> DataFrame:
    """Add the code of the first label containing the row's term; NULL for a NULL term."""
    found = first_label_containing(rows, term, labels).withColumnRenamed("code", name)
    return rows.join(found, term, "left")
