"""Quality rules: per-document measures and cross-document line frequency.

The base rules look at one document: too few words, or too many words inside repeated 8-word
windows. The method looks at lines across the documents of a host (`source`): lines are normalised
(blanks trimmed and collapsed) and hashed, and the distinct documents that contain each are counted.
A line in more than `limit_docs` documents is removed; a document is rejected as depleted if less than
`min_left` of its words remain. Documents are distinct by text, so copies of one document count once, and
a copied document is not taken for boilerplate.

Everything is built-in functions. The measures and line hashes of all rows are worked out once and stored
with the columns to keep; after that only hashes and counts move. Lines meet the removed ones in a join on host and line that Spark can
split. `keep_good` removes rows by the keys (host, text hash) of what is rejected, so that texts stay where they
are while Spark can broadcast those keys, and are shuffled once beyond that.

Edge cases: a NULL text is an empty one (no words: base_failed); NULL hosts are one host; repeated
rows are judged each by itself; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlog.llm.common import BLANK_CLASS, BLANKS, let, whole_text, words_of
from starlog.operators.joins import join_null_safe
from starlog.session import materialise

WINDOW = 8
HOST, DOC, LINES, ROW = "__rule_host", "__rule_doc", "__rule_lines", "__rule_row"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def normalised(line: Column) -> Column:
    return F.regexp_replace(F.btrim(line, F.lit(BLANKS)), BLANK_CLASS + "+", " ")


def _repeated(words: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more, each word once."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1), lambda at: F.xxhash64(F.slice(words, at, WINDOW)))

    def covered(ordered: Column) -> Column:
        def twin(item: Column, at: Column) -> Column:
            before, behind = F.get(ordered, at - 1), F.get(ordered, at + 1)
            return F.coalesce(before["h"] == item["h"], F.lit(False)) | F.coalesce(behind["h"] == item["h"], F.lit(False))

        places = F.sort_array(F.transform(F.filter(ordered, twin), lambda item: item["i"]))
        # a window adds the words that the repeated window before it has not covered
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            places,
            start,
            lambda done, at: F.struct(
                (done["n"] + F.least(F.lit(WINDOW), at - done["last"])).alias("n"), at.alias("last")
            ),
            lambda done: done["n"],
        )

    def count(found: Column) -> Column:
        pairs = F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0)).otherwise(
            let(F.sort_array(pairs), covered)
        )

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(hashes, count))


def measures(text: Column) -> dict[str, Column]:
    """The base measures of one text."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return {
        "n_words": F.size(words_of(text)).cast("long"),
        "word_chars": F.length(F.regexp_replace(text, BLANK_CLASS + "+", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_dup_lines": let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long"),
        "n_repeat_words": let(words_of(text), _repeated).cast("long"),
    }


def _measured(docs: DataFrame, keep: list[str], min_words: int, max_repeat_percent: int) -> DataFrame:
    """The stored rows: a struct of the columns to keep if there are any, measures, base_failed, host, text hash and the lines' (hash, words)."""
    text = whole_text("text")
    found = measures(text)
    bare = F.filter(F.transform(F.split(text, "\n"), normalised), lambda line: line != "")
    lines = F.transform(bare, lambda line: F.struct(F.xxhash64(line).alias("line"), F.size(words_of(line)).alias("words")))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rows = docs.select(
        *([F.struct(*[docs[name] for name in keep]).alias(ROW)] if keep else []),
        docs["source"].alias(HOST),
        F.xxhash64(text).alias(DOC),
        lines.alias(LINES),
        *[value.alias(name) for name, value in found.items()],
    )
    return materialise(rows.withColumn("base_failed", base))


def lost_words(rows: DataFrame, limit_docs: int) -> DataFrame:
    """(host, doc, n_words, lost): words of the distinct documents that stand in lines above the document limit."""
    rows = materialise(rows.select(HOST, DOC, "n_words", LINES).dropDuplicates([HOST, DOC]))
    counts = rows.select(HOST, F.explode(F.array_distinct(f"{LINES}.line")).alias("line")).groupBy(HOST, "line").count()
    # stored, so that the join shuffles both sides for itself and can split a hot line
    above = materialise(counts.where(F.col("count") > limit_docs).select(HOST, "line"))
    found = join_null_safe(rows.select(HOST, DOC, "n_words", F.inline(LINES)), above, [HOST, "line"], "inner")
    return materialise(found.groupBy(HOST, DOC, "n_words").agg(F.sum("words").alias("lost")))


def judge(
    docs: DataFrame,
    min_words: int = 20,
    max_repeat_percent: int = 30,
    limit_docs: int = 10,
    min_left: float = 0.3,
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows (columns of `keep`, by default all) with the measures, base_failed, n_words_left (outside removed lines) and kept."""
    added = [*MEASURES, "base_failed", "n_words_left", "kept"]
    keep = [name for name in (docs.columns if keep is None else keep) if name not in added]
    rows = _measured(docs, keep, min_words, max_repeat_percent)
    lost = lost_words(rows, limit_docs).drop("n_words")
    joined = join_null_safe(rows.drop(LINES), lost, [HOST, DOC], "left")
    joined = joined.withColumn("n_words_left", F.col("n_words") - F.coalesce("lost", F.lit(0)))
    kept = ~F.col("base_failed") & (F.col("n_words_left") >= min_left * F.col("n_words"))
    return joined.select(
        *[F.col(ROW)[name].alias(name) for name in keep], *MEASURES, "base_failed", "n_words_left", kept.alias("kept")
    )


def keep_good(
    docs: DataFrame, min_words: int = 20, max_repeat_percent: int = 30, limit_docs: int = 10, min_left: float = 0.3
) -> DataFrame:
    """The rows that `judge` keeps, as they are."""
    rows = _measured(docs, [], min_words, max_repeat_percent)
    lost = lost_words(rows, limit_docs)
    depleted = lost.where(F.col("n_words") - F.col("lost") < min_left * F.col("n_words"))
    rejected = depleted.select(HOST, DOC).unionByName(rows.where("base_failed").select(HOST, DOC)).distinct()
    keyed = docs.select(
        F.struct(*docs.columns).alias(ROW), docs["source"].alias(HOST), F.xxhash64(whole_text(docs["text"])).alias(DOC)
    )
    return join_null_safe(keyed, materialise(rejected), [HOST, DOC], "left_anti").select(f"{ROW}.*")
