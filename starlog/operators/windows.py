"""Running, moving, ranking and numbering windows that stay parallel inside one group.

A plain `Window.partitionBy(key).orderBy(...)` puts a whole group into one task. Here the rows
are range-partitioned over key and order instead, so a group of any size is cut into blocks.
Every block starts with one carry row that holds what the earlier blocks of its group
contribute (prefix totals, or the last row), and an ordinary window over (key, block) does the rest.

Order columns are names; a leading "-" means descending (NULLs first ascending, last descending).
Orders of row-based windows must be total, so that equal rows can be cut apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starlog.operators.joins import join_null_safe
from starlog.session import materialise

BLOCK = "_block"
CARRY = "_carry"
#: Bits of `monotonically_increasing_id` that count rows of a partition.
PLACE_BITS = 33


def sort_columns(order: Iterable[str]) -> list[Column]:
    return [F.col(name[1:]).desc_nulls_last() if name[0] == "-" else F.col(name).asc_nulls_first() for name in order]


def _reversed(order: Iterable[str]) -> list[str]:
    return [name[1:] if name[0] == "-" else "-" + name for name in order]


def _names(order: Iterable[str]) -> list[str]:
    return [name.lstrip("-") for name in order]


def ordered_blocks(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows cut into blocks by a range partitioning over keys and order, computed once.

    The block numbers come from the partitioning, so they are written to the shared folder
    before two branches read them.
    """
    cut = df.repartitionByRange(*sort_columns([*keys, *order]))
    return materialise(cut.withColumn(BLOCK, F.spark_partition_id()))


def _behind_carry(blocks: DataFrame, carry: DataFrame) -> DataFrame:
    rows = blocks.withColumn(CARRY, F.lit(False))
    return rows.unionByName(carry.withColumn(CARRY, F.lit(True)), allowMissingColumns=True)


def _block_window(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, BLOCK).orderBy(F.col(CARRY).desc(), *sort_columns(order))


def running_totals(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    totals: Mapping[str, Column],
    whole: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add running sums (all rows of the group up to and including this one).

    `totals` names summed expressions; `whole` names expressions summed over the full group.
    """
    whole = dict(whole or {})
    added = {f"_run_{name}": value for name, value in totals.items()}
    added |= {f"_all_{name}": value for name, value in whole.items()}
    blocks = ordered_blocks(df.withColumns(added), keys, order)
    frame = _block_window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _summed(blocks, keys, frame, list(totals), list(whole)).select(*df.columns, *totals, *whole)


def _summed(blocks: DataFrame, keys: list[str], frame, totals: list[str], whole: list[str]) -> DataFrame:
    """Sum the `_run_` columns over the frame within blocks, on top of the blocks before."""
    added = [*[f"_run_{name}" for name in totals], *[f"_all_{name}" for name in whole]]
    per_block = blocks.groupBy(*keys, BLOCK).agg(*[F.sum(name).alias(name) for name in added])
    group = Window.partitionBy(*keys)
    before = group.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_block.withColumns(
        {"_seq": F.row_number().over(group.orderBy(BLOCK))}
        | {f"_run_{name}": F.sum(f"_run_{name}").over(before) for name in totals}
        | {f"_whole_{name}": F.sum(f"_all_{name}").over(group) for name in whole}
    )
    if not whole:  # a group's first block has nothing to carry
        carry = carry.where("_seq > 1")
    spent = ["_seq", *[f"_all_{name}" for name in whole]]
    rows = _behind_carry(blocks.drop(*spent), carry.drop(*spent))
    return rows.withColumns(
        {name: F.sum(f"_run_{name}").over(frame) for name in totals}
        | {name: F.max(f"_whole_{name}").over(frame) for name in whole}
    ).where(~F.col(CARRY))


def number_rows(
    df: DataFrame, order: list[str], name: str = "row_number", start: int = 1, keys: list[str] | None = None
) -> DataFrame:
    """Dense numbers along a total order, over all rows or within each group."""
    if keys:
        numbered = running_totals(df, keys, order, {name: F.lit(1)})
        return numbered.withColumn(name, F.col(name) + (start - 1)) if start != 1 else numbered
    # sorted in range partitions, a row's id holds its partition and its place there, so that only the
    # sizes of the partitions are left to add up and the rows move once
    cut = df.repartitionByRange(*sort_columns(order)).sortWithinPartitions(*sort_columns(order))
    placed = materialise(cut.withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn(BLOCK, F.shiftright("_id", PLACE_BITS))
    sizes = placed.groupBy(BLOCK).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialise(sizes.select(BLOCK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")))
    place = F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.join(offsets, BLOCK).select(*df.columns, (F.col("_offset") + place + start).alias(name))


def running_rows(df: DataFrame, keys: list[str], order: list[str], value: str, prefix: str = "") -> DataFrame:
    """Running total, average and row count, one frame per row (ROWS unbounded..current)."""
    out = running_totals(
        df,
        keys,
        order,
        {f"{prefix}total": F.col(value), "_n": F.col(value).isNotNull().cast("int"), f"{prefix}rows": F.lit(1)},
    )
    return out.withColumn(f"{prefix}average", _average(f"{prefix}total", "_n")).drop("_n")


def running_range(df: DataFrame, keys: list[str], by: str, totals: Mapping[str, Column]) -> DataFrame:
    """Running sums in which rows equal in `by` share one value (RANGE unbounded..current).

    Rows of one (group, `by`) are summed first, so ties of any size shrink before the shuffle.
    Meant for values that repeat; where most differ, `running_range_cut` moves less data.
    """
    at = by.lstrip("-")
    steps = df.groupBy(*keys, at).agg(*[F.sum(value).alias(f"_step_{name}") for name, value in totals.items()])
    run = running_totals(steps, keys, [by], {name: F.col(f"_step_{name}") for name in totals})
    return join_null_safe(df, run.select(*keys, at, *totals), [*keys, at], "left")


def running_range_cut(
    df: DataFrame, keys: list[str], at: str, ties: list[str], totals: Mapping[str, Column]
) -> DataFrame:
    """As `running_range` along `at`, without summing equal rows first.

    `ties` orders rows of one (group, `at`) so that many of them can be cut into blocks. Only the
    rows at the end of one block and the start of the next can then miss equals; these groups, at
    most one per cut, are found and their sums in later blocks added.
    """
    blocks = ordered_blocks(
        df.withColumns({f"_run_{name}": value for name, value in totals.items()}), keys, [at, *ties]
    )
    frame = _block_window(keys, [at]).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _summed(blocks, keys, frame, list(totals), [])

    name = at.lstrip("-")
    place = F.struct(*keys, name)
    ends = blocks.groupBy(BLOCK).agg(F.min(place).alias("first"), F.max(place).alias("last"))
    touched = ends.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("place"))
    cut = touched.groupBy("place").count().where("count > 1").select("place.*")
    group = [*keys, name]
    parts = (
        join_null_safe(blocks, cut, group, "left_semi")
        .groupBy(*group, BLOCK)
        .agg(*[F.sum(f"_run_{name}").alias(f"_run_{name}") for name in totals])
    )
    after = Window.partitionBy(*group).orderBy(BLOCK).rowsBetween(1, Window.unboundedFollowing)
    later = parts.select(*group, BLOCK, *[F.sum(f"_run_{name}").over(after).alias(f"_later_{name}") for name in totals])
    out = join_null_safe(rows, later, [*group, BLOCK], "left")
    return out.withColumns(
        {name: F.coalesce(F.col(name) + F.col(f"_later_{name}"), F.col(name), F.col(f"_later_{name}")) for name in totals}
    ).select(*df.columns, *totals)


def running_range_stats(df: DataFrame, keys: list[str], by: str, value: str) -> DataFrame:
    """Running total and average with ties sharing a value."""
    out = running_range(
        df, keys, by, {"total": F.col(value), "_n": F.col(value).isNotNull().cast("int"), "rows": F.lit(1)}
    )
    return out.withColumn("average", _average("total", "_n")).drop("_n")


def _average(total: str, n: str) -> Column:
    return F.col(total).cast("double") / F.nullif(F.col(n), F.lit(0)).cast("double")


def ranks(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """rank, dense_rank and percent_rank within each group, computed over its distinct values."""
    at = by.lstrip("-")
    values = df.groupBy(*keys, at).agg(F.count("*").alias("_rows"))
    run = running_totals(
        values, keys, [by], {"_upto": F.col("_rows"), "dense_rank": F.lit(1)}, whole={"_group_rows": F.col("_rows")}
    )
    rank = F.col("_upto") - F.col("_rows") + 1
    share = F.when(F.col("_group_rows") > 1, (rank - 1).cast("double") / (F.col("_group_rows") - 1).cast("double"))
    ranked = run.select(
        *keys, at, rank.alias("rank"), "dense_rank", F.coalesce(share, F.lit(0.0)).alias("percent_rank")
    )
    return join_null_safe(df, ranked, [*keys, at], "left")


def _behind_last_row(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows in blocks, each block led by the last row of its group's block before."""
    blocks = ordered_blocks(df, keys, order)
    backwards = Window.partitionBy(*keys, BLOCK).orderBy(*sort_columns(_reversed(order)))
    last = (
        blocks.select(*dict.fromkeys([*keys, BLOCK, *_names(order), value]))
        .withColumn("_nth", F.row_number().over(backwards))
        .where("_nth = 1")
    )
    sequence = Window.partitionBy(*keys).orderBy(BLOCK)
    carry = (
        last.select(
            *keys,
            BLOCK,
            F.lag(value).over(sequence).alias("_value"),
            F.row_number().over(sequence).alias("_seq"),
        )
        .where("_seq > 1")
        .drop("_seq")
    )
    return _behind_carry(blocks.withColumn("_value", F.col(value)), carry)


def with_previous(df: DataFrame, keys: list[str], order: list[str], value: str, name: str = "lag") -> DataFrame:
    """Add the value of the row before in the group, NULL on its first row."""
    rows = _behind_last_row(df, keys, order, value)
    return (
        rows.withColumn(name, F.lag("_value", 1).over(_block_window(keys, order)))
        .where(~F.col(CARRY))
        .select(*df.columns, name)
    )


def difference_to_previous(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Add `lag` and `diff`, the value minus the value before."""
    return with_previous(df, keys, order, value).withColumn("diff", F.col(value) - F.col("lag"))


def moving_pair(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """List, average and total over the row before and the current row (ROWS -1..0)."""
    rows = _behind_last_row(df, keys, order, value)
    pair = _block_window(keys, order).rowsBetween(-1, Window.currentRow)
    return (
        rows.withColumns(
            {
                "list": F.collect_list("_value").over(pair),
                "total": F.sum("_value").over(pair),
                "average": F.avg("_value").over(pair),
            }
        )
        .where(~F.col(CARRY))
        .select(*df.columns, "list", "total", "average")
    )


def phases(df: DataFrame, key: str, ts: str, flag: str, ties: list[str], name: str = "phase") -> DataFrame:
    """Number the phases of each key: flagged events at this time or later; a NULL time is the earliest.

    `ties` orders events of one time.
    """
    return running_range_cut(df, [key], f"-{ts}", ties, {name: F.col(flag)})


def group_totals(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Add each group's total, average and row count to all its rows (no order).

    The groups are aggregated map-side first and joined back, so no task holds a whole group.
    """
    totals = df.groupBy(*keys).agg(
        F.sum(value).alias("total"), F.avg(value).alias("average"), F.count("*").alias("rows")
    )
    return join_null_safe(df, totals, keys, "left")


def group_lists(df: DataFrame, keys: list[str], order: list[str], value: str, piece_rows: int = 1000) -> DataFrame:
    """Each group's ordered value list with its total, average and row count.

    A list longer than `piece_rows` continues in further rows (`piece` 0, 1, …), so the size of
    one array is bounded while the whole list is kept. NULL values are left out of the list, so a
    group without others has an empty one; `rows` counts all rows.
    """
    held = df.select(*dict.fromkeys([*keys, *_names(order), value]))
    present = F.col(value).isNotNull().cast("int")
    placed = running_totals(
        held, keys, order, {"_place": present}, whole={"total": F.col(value), "rows": F.lit(1), "_n": present}
    )
    piece = F.call_function("div", F.greatest(F.col("_place") - 1, F.lit(0)), F.lit(piece_rows))
    item = F.when(F.col(value).isNotNull(), F.struct("_place", F.col(value).alias("value")))
    pieces = placed.groupBy(*keys, piece.alias("piece")).agg(
        F.array_sort(F.collect_list(item)).alias("_items"),
        F.max("total").alias("total"),
        F.max("rows").alias("rows"),
        F.max("_n").alias("_n"),
    )
    return pieces.select(
        *keys,
        "piece",
        F.col("_items.value").alias("list"),
        "total",
        _average("total", "_n").alias("average"),
        "rows",
    )


def frame_list_at(df: DataFrame, keys: list[str], order: list[str], value: str, row: int) -> DataFrame:
    """The running list as it stands at the given row of each group: its first `row` values.

    Groups shorter than `row` have no such row and are left out. Rows are placed in blocks, so
    that no task holds a whole group whatever `row` is.
    """
    top = running_totals(df, keys, order, {"_nth": F.lit(1)}).where(F.col("_nth") <= row)
    return (
        top.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_nth", F.col(value).alias("value")))).alias("_items"))
        .where(F.size("_items") == row)
        .select(*keys, F.transform("_items", lambda item: item["value"]).alias("list"))
    )


def factorised_lists(
    df: DataFrame, keys: list[str], order: list[str], value: str, frame: str = "rows", piece_rows: int = 1000
) -> tuple[DataFrame, DataFrame]:
    """The running list of every row, in linear size: (rows with `prefix`, pieces of the groups' lists).

    A row's list is the first `prefix` values of its group's list, which lies in `pieces` (keys, piece,
    list) of at most `piece_rows` values. With frame "rows" a list ends at its row along the total
    `order`; with "range" rows equal in `order[0]` share one list, and the other order columns, which must tell them apart, place
    values within it. NULL values are left out of lists. `expand_lists` gives the lists of chosen rows.
    """
    if frame not in ("rows", "range"):
        raise ValueError(f"no such frame: {frame}")
    present = F.col(value).isNotNull().cast("int")
    placed = materialise(running_totals(df, keys, order, {"_place": present}))
    piece = F.call_function("div", F.col("_place") - 1, F.lit(piece_rows))
    items = F.array_sort(F.collect_list(F.struct("_place", F.col(value).alias("value"))))
    held = placed.where(F.col(value).isNotNull()).groupBy(*keys, piece.alias("piece")).agg(items.alias("_items"))
    pieces = held.select(*keys, "piece", F.col("_items.value").alias("list"))
    if frame == "rows":
        rows = placed.withColumnRenamed("_place", "prefix")
    else:
        rows = running_range_cut(df, keys, order[0], order[1:], {"prefix": present})
    return rows, pieces


def expand_lists(rows: DataFrame, pieces: DataFrame, keys: list[str], piece_rows: int = 1000) -> DataFrame:
    """The lists of chosen `rows` of `factorised_lists`, each in rows (columns of `rows`, piece, list).

    `piece_rows` is that of the pieces. A row whose list is empty has one empty piece. Rows meet each piece by an equi-join,
    which Spark can split where many rows of one group are chosen. It is asked for as a merge, and the pieces that a list
    ends in come apart from the whole ones: so equal lists lie together, of which parquet stores each once.
    """
    rows = materialise(rows)
    whole, rest = F.call_function("div", F.col("prefix"), F.lit(piece_rows)), F.col("prefix") % piece_rows
    kept = rows.where(whole > 0).withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)))
    ended = rows.where((rest > 0) | (F.col("prefix") == 0)).withColumn("piece", whole)

    def with_lists(wanted: DataFrame) -> DataFrame:
        return join_null_safe(wanted, pieces.hint("merge"), [*keys, "piece"], "left")

    empty = F.array().cast(pieces.schema["list"].dataType)
    cut = F.when(rest > 0, F.slice("list", F.lit(1), rest.cast("int"))).otherwise(empty)
    return with_lists(kept).unionByName(with_lists(ended).withColumn("list", cut))
