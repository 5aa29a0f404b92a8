"""Site-relative line dedup: lines that stand on a large part of a host's pages are boilerplate.

For every host the pages that contain a line are divided by all pages of the host; lines above
`ratio` are dropped from all pages of that host. A share says little over a few pages: a line must also
stand on `few_pages`, and on a host of under 2 * `min_pages` pages on half of them. Lines are
compared without the blanks around them, by a 64-bit hash. A host cannot have more than (mean
lines of a page) / ratio such lines, so their list is a small value of the host; pages meet it by
a join on the host, which moves no text where the list is small and is split where a host is hot.

Edge cases: NULL hosts are one host; a NULL text stays NULL and counts as a page without lines;
blank lines are never dropped; repeated rows are pages of their own; a page whose lines all go
keeps an empty text; hosts of under `few_pages` pages lose no line; an empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlog.llm.common import BLANKS
from starlog.operators.joins import join_null_safe
from starlog.session import materialise

HOST, LINES = "__line_host", "__line_hashes"


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(BLANKS)))


def host_boilerplate(docs: DataFrame, ratio: float, min_pages: int, few_pages: int) -> DataFrame:
    """(host, hashes of its boilerplate lines), for hosts that have any."""
    bare = F.transform(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))
    lines = F.array_distinct(F.filter(bare, lambda line: line != ""))
    pages = docs.select(F.col("source").alias(HOST), F.transform(lines, lambda line: F.xxhash64(line)).alias(LINES))
    counts = pages.select(HOST, F.explode(LINES).alias("line")).groupBy(HOST, "line").agg(F.count("*").alias("pages"))
    totals = docs.groupBy(F.col("source").alias(HOST)).agg(F.count("*").alias("all_pages"))
    common = join_null_safe(counts.where(F.col("pages") >= few_pages), totals, [HOST], "inner")
    # half of a small host's pages, until that is more than min_pages
    least = F.least(F.lit(min_pages), F.col("all_pages") / 2)
    common = common.where((F.col("pages") > ratio * F.col("all_pages")) & (F.col("pages") >= least))
    return materialise(common.groupBy(HOST).agg(F.collect_list("line").alias(LINES)))


def dedup_lines(
    docs: DataFrame,
    ratio: float = 0.1,
    min_pages: int = 10,
    count: str | None = "n_dropped",
    few_pages: int = 3,
) -> DataFrame:
    """The rows with boilerplate lines taken out of `text`, and how many went in a column named by `count`.

    `docs` has source (the host) and text; a column of the name `count` is replaced.
    """
    listed = host_boilerplate(docs, ratio, min_pages, few_pages)
    same = docs["source"].eqNullSafe(listed[HOST])
    joined = docs.join(listed, same, "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line: ~F.array_contains(LINES, line_hash(line)))
    cut = joined.withColumn("__kept", F.when(F.col(LINES).isNotNull(), kept))
    dropped = F.coalesce(F.size(lines) - F.size("__kept"), F.lit(0)).cast("long")
    return cut.select(
        *[docs[c] for c in docs.columns if c not in ("text", count)],
        F.when(F.col("__kept").isNull(), F.col("text")).otherwise(F.array_join("__kept", "\n")).alias("text"),
        *([dropped.alias(count)] if count else []),
    )
