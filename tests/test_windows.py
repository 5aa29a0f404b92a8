"""Block-cut windows against brute force, with one group holding most rows and many ties."""

import os
import random

import pytest
from pyspark.sql import functions as F

from starlog.operators import windows as win

SCHEMA = "id bigint, dept string, salary bigint"


def make_rows(seed=1, n=600):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        dept = rnd.choice(["big", "big", "big", "mid", "small", None])
        salary = None if rnd.random() < 0.05 else rnd.choice([100, 100, 100, rnd.randrange(-50, 200)])
        rows.append((i, dept, salary))
    return rows + [(n, "single", 7)]


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


def groups(rows):
    out = {}
    for row in rows:
        out.setdefault(row[1], []).append(row)
    nulls_first = lambda r: (r[2] is not None, r[2] or 0, r[0])
    return {dept: sorted(members, key=nulls_first) for dept, members in out.items()}


def total(values):
    known = [v for v in values if v is not None]
    return (sum(known), sum(known) / len(known)) if known else (None, None)


def test_blocks_cut_the_big_group(frame):
    blocks = win.ordered_blocks(frame, ["dept"], ["salary", "id"])
    per_group = {r.dept: r.n for r in blocks.groupBy("dept").agg(F.countDistinct("_block").alias("n")).collect()}
    assert per_group["big"] > 1
    assert blocks.count() == frame.count()


def test_running_rows(frame, rows):
    got = {r.id: (r.total, r.average, r.rows) for r in win.running_rows(frame, ["dept"], ["salary", "id"], "salary").collect()}
    for members in groups(rows).values():
        for i, row in enumerate(members):
            assert got[row[0]] == (*total([m[2] for m in members[: i + 1]]), i + 1)
    assert len(got) == len(rows)


def test_running_range_shares_ties(frame, rows):
    got = {r.id: (r.total, r.average, r.rows) for r in win.running_range_stats(frame, ["dept"], "salary", "salary").collect()}
    for members in groups(rows).values():
        for row in members:
            upto = [m for m in members if m[2] is None or (row[2] is not None and m[2] <= row[2])]
            assert got[row[0]] == (*total([m[2] for m in upto]), len(upto))


def test_running_range_cut_shares_ties_over_blocks(frame, rows):
    values = {"total": F.col("salary"), "rows": F.lit(1)}
    out = win.running_range_cut(frame, ["dept"], "salary", ["id"], values)
    blocks = win.ordered_blocks(frame.where("dept = 'big' AND salary = 100"), ["dept"], ["salary", "id"])
    assert blocks.select("_block").distinct().count() > 2
    assert out.columns == ["id", "dept", "salary", "total", "rows"]
    got = {r.id: (r.total, r.rows) for r in out.collect()}
    for members in groups(rows).values():
        for row in members:
            upto = [m for m in members if m[2] is None or (row[2] is not None and m[2] <= row[2])]
            assert got[row[0]] == (total([m[2] for m in upto])[0], len(upto))
    assert len(got) == len(rows)


def test_running_range_cut_with_one_value_everywhere(spark):
    out = win.running_range_cut(spark.range(500).withColumn("v", F.lit(1)), [], "v", ["id"], {"n": F.lit(1)})
    assert out.select("n").distinct().collect()[0].n == 500 and out.count() == 500


def test_ranks(frame, rows):
    got = {r.id: (r["rank"], r.dense_rank, r.percent_rank) for r in win.ranks(frame, ["dept"], "salary").collect()}
    for members in groups(rows).values():
        order = [m[2] for m in members]
        distinct = list(dict.fromkeys(order))
        for row in members:
            rank = order.index(row[2]) + 1
            share = (rank - 1) / (len(members) - 1) if len(members) > 1 else 0.0
            assert got[row[0]] == (rank, distinct.index(row[2]) + 1, share)


def test_lag_and_difference(frame, rows):
    got = {r.id: (r.lag, r.diff) for r in win.difference_to_previous(frame, ["dept"], ["salary", "id"], "salary").collect()}
    for members in groups(rows).values():
        for i, row in enumerate(members):
            before = members[i - 1][2] if i else None
            diff = None if before is None or row[2] is None else row[2] - before
            assert got[row[0]] == (before, diff)


def test_moving_pair(frame, rows):
    got = {r.id: (r.list, r.total, r.average) for r in win.moving_pair(frame, ["dept"], ["salary", "id"], "salary").collect()}
    for members in groups(rows).values():
        for i, row in enumerate(members):
            pair = [m[2] for m in members[max(0, i - 1) : i + 1]]
            assert got[row[0]] == ([v for v in pair if v is not None], *total(pair))


def test_descending_order(frame, rows):
    got = {r.id: r.lag for r in win.with_previous(frame, ["dept"], ["-id"], "id").collect()}
    for members in groups(rows).values():
        ids = sorted((m[0] for m in members), reverse=True)
        assert [got[i] for i in ids] == [None, *ids[:-1]]


def test_group_totals(frame, rows):
    got = {r.id: (r.total, r.average, r.rows) for r in win.group_totals(frame, ["dept"], "salary").collect()}
    for members in groups(rows).values():
        for row in members:
            assert got[row[0]] == (*total([m[2] for m in members]), len(members))


def test_group_lists_in_pieces(frame, rows):
    pieces = win.group_lists(frame, ["dept"], ["salary", "id"], "salary", piece_rows=50).collect()
    assert max(len(p.list) for p in pieces) == 50
    for dept, members in groups(rows).items():
        known = [m[2] for m in members if m[2] is not None]
        mine = sorted((p for p in pieces if p.dept == dept), key=lambda p: p.piece)
        assert [v for p in mine for v in p.list] == known
        assert {(p.total, p.average, p.rows) for p in mine} == {(*total(known), len(members))}


def test_group_lists_keep_groups_without_values(spark):
    people = spark.createDataFrame([(1, "a", 10), (2, "a", None), (3, "b", None), (4, "b", None)], SCHEMA)
    got = {r.dept: (r.piece, r.list, r.total, r.average, r.rows) for r in win.group_lists(people, ["dept"], ["salary", "id"], "salary").collect()}
    assert got == {"a": (0, [10], 10, 10.0, 2), "b": (0, [], None, None, 2)}


def test_frame_list_far_down_splits_the_group(frame):
    plan = win.frame_list_at(frame, ["dept"], ["salary", "id"], "salary", 5000)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" not in plan and "_block" in plan


def test_frame_list(frame, rows):
    got = {r.dept: r.list for r in win.frame_list_at(frame, ["dept"], ["salary", "id"], "salary", 30).collect()}
    want = {d: [m[2] for m in members[:30]] for d, members in groups(rows).items() if len(members) >= 30}
    assert got == want


def test_number_rows_without_groups(frame, rows):
    got = {r.id: r.key for r in win.number_rows(frame, ["-salary", "id"], "key", start=0).collect()}
    order = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
    assert [got[r[0]] for r in order] == list(range(len(rows)))


def test_phases_count_flags_at_or_after(spark):
    rows = [("u", t, 1 if t in (3, 5, 5, 9) else 0, i) for i, t in enumerate([1, 2, 3, 4, 5, 5, 6, 9, 10])] + [("v", 1, 0, 99)]
    out = win.phases(spark.createDataFrame(rows, "user string, ts bigint, flag int, id int"), "user", "ts", "flag", ["id"])
    got = {r.id: r.phase for r in out.collect()}
    assert got == {0: 4, 1: 4, 2: 4, 3: 3, 4: 3, 5: 3, 6: 1, 7: 1, 8: 0, 99: 0}


def test_phases_with_unknown_times(spark):
    rows = [("u", 10, 1, 0), ("u", None, 1, 1), ("u", 20, 0, 2), ("u", None, 0, 3)]
    out = win.phases(spark.createDataFrame(rows, "user string, ts bigint, flag int, id int"), "user", "ts", "flag", ["id"])
    assert {r.id: r.phase for r in out.collect()} == {2: 0, 0: 1, 1: 2, 3: 2}


def test_ties_share_a_running_total(spark):
    people = [(1, "ship", 70), (2, "ship", 70), (3, "ship", 15), (4, "yard", 8), (5, "yard", 9), (6, "ship", 70), (7, "yard", 9)]
    out = win.running_range_stats(spark.createDataFrame(people, SCHEMA), ["dept"], "salary", "salary")
    got = {r.id: r.total for r in out.collect()}
    assert got == {3: 15, 1: 225, 2: 225, 6: 225, 4: 8, 5: 26, 7: 26}


@pytest.mark.parametrize("frame_kind", ["rows", "range"])
def test_factorised_lists_hold_every_running_list(frame, rows, frame_kind):
    ordered, pieces = win.factorised_lists(frame, ["dept"], ["salary", "id"], "salary", frame_kind, piece_rows=7)
    held = pieces.collect()
    assert max(len(r.list) for r in held) <= 7 and sum(len(r.list) for r in held) == sum(r[2] is not None for r in rows)
    lists = {}
    for r in win.expand_lists(ordered, pieces, ["dept"], piece_rows=7).collect():
        lists.setdefault(r.id, {})[r.piece] = r.list
    assert len(lists) == len(rows)
    for members in groups(rows).values():
        for i, row in enumerate(members):
            last = i if frame_kind == "rows" else max(j for j, m in enumerate(members) if m[2] == row[2])
            found = lists[row[0]]
            assert sorted(found) == list(range(len(found)))
            assert [x for piece in sorted(found) for x in found[piece]] == [m[2] for m in members[: last + 1] if m[2] is not None]


def test_range_lists_descend_and_place_ties(spark):
    frame = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "a", 9), (4, "a", None)], SCHEMA)
    rows, pieces = win.factorised_lists(frame, ["dept"], ["-salary", "id"], "id", "range")
    assert {r.id: r.prefix for r in rows.collect()} == {3: 1, 1: 3, 2: 3, 4: 4}
    assert [r.list for r in pieces.collect()] == [[3, 1, 2, 4]]
    empty = win.factorised_lists(frame.limit(0), ["dept"], ["salary", "id"], "id", "rows")
    assert win.expand_lists(*empty, ["dept"]).collect() == []
    with pytest.raises(ValueError):
        win.factorised_lists(frame, ["dept"], ["salary", "id"], "id", "groups")


def test_equal_lists_are_stored_once(spark, path):
    n = F.col("id")
    frame = spark.range(60_000).select("id", F.lit("a").alias("dept"), F.abs(F.xxhash64(n)).alias("salary"))
    rows, pieces = win.factorised_lists(frame, ["dept"], ["id"], "salary", "rows", piece_rows=100)
    texts = pieces.withColumn("list", F.col("list").cast("array<string>"))
    lists = win.expand_lists(rows.where(n % 500 == 499), texts, ["dept"], piece_rows=100)
    lists.withColumn("list", F.concat_ws(",", "list")).write.parquet(path)
    stored = spark.read.parquet(path).agg(F.sum(F.length("list")), F.count("*")).first()
    assert stored[0] > 60_000_000 and stored[1] == sum(5 * i for i in range(1, 121))
    assert sum(os.path.getsize(f"{path}/{name}") for name in os.listdir(path)) < 8_000_000
