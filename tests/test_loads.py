"""Random batches loaded one after another equal a row-at-a-time model of the conflict rules."""

import os
import random

import pytest
from pyspark.sql import functions as F

from starlog.sinks import tables
from starlog.sinks.bucketed import BucketedTable

SCHEMA = "k int, name string, level string, ts int, day int"


def batches(seed):
    rnd = random.Random(seed)
    ts = 0
    for _ in range(3):
        batch = []
        for _ in range(rnd.randrange(1, 40)):
            ts += 1
            k = None if rnd.random() < 0.05 else 7 if rnd.random() < 0.4 else rnd.randrange(12)
            batch.append((k, f"n{ts}", rnd.choice(["free", "paid"]), ts, None if k is None else k % 3))
        yield batch


@pytest.mark.parametrize("seed", [1, 2])
def test_upsert_equals_row_at_a_time(spark, path, seed):
    table, model = BucketedTable(spark, path, "k", buckets=5), {}
    for batch in batches(seed):
        frame = spark.createDataFrame(batch, SCHEMA).drop("day").repartition(4)
        for _ in range(2):
            tables.upsert(frame, table, ["ts"], ["level"])
        for k, name, level, _, _ in batch:
            if k is not None:
                model[k] = (model.get(k, (name,))[0], level)
    assert {r.k: (r.name, r.level) for r in table.read().collect()} == model


@pytest.mark.parametrize("by", [(), ("day",)])
def test_insert_if_absent_equals_row_at_a_time(spark, path, by):
    model = {}
    for batch in batches(3):
        frame = spark.createDataFrame(batch, SCHEMA).repartition(4)
        for _ in range(2):
            tables.insert_if_absent(frame, path, ["k"], [F.col("ts").asc()], by)
        for k, name, *_ in batch:
            if k is not None:
                model.setdefault(k, name)
    rows = spark.read.parquet(path).collect()
    assert {r.k: r.name for r in rows} == model and len(rows) == len(model)


@pytest.mark.parametrize("by", [(), ("day",)])
def test_append_new_equals_row_at_a_time(spark, path, by):
    names, held = [], set()
    for batch in batches(4):
        frame = spark.createDataFrame(batch, SCHEMA).repartition(4)
        for _ in range(2):
            tables.append_new(frame, path, ["k"], by)
        names += [row[1] for row in batch if row[0] not in held]
        held |= {row[0] for row in batch}
    assert sorted(r.name for r in spark.read.parquet(path).collect()) == sorted(names)


def files_below(path):
    return {os.path.join(folder, f) for folder, _, files in os.walk(path) for f in files if f.endswith(".parquet")}


def test_a_batch_rewrites_only_its_buckets(spark, path):
    table = BucketedTable(spark, path, "k", buckets=32)
    frame = spark.range(1000).selectExpr("CAST(id AS INT) AS k", "'a' AS name", "'free' AS level", "1 AS ts")
    assert tables.upsert(frame, table, ["ts"], ["level"]) == list(range(32))
    before, first = files_below(path), table.manifest()
    late = spark.createDataFrame([(5, "z", "paid", 2), (5, "z", "gold", 3), (7000, "n", "free", 2)], frame.schema)
    touched = tables.upsert(late, table, ["ts"], ["level"])
    assert len(touched) == len({r.b for r in late.select(table._bucket(32).alias("b")).collect()}) <= 2
    written = files_below(path) - before
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in written} == set(touched) and before <= files_below(path)
    rows = {r.k: (r.name, r.level) for r in table.read().collect()}
    assert len(rows) == 1001 and rows[5] == ("a", "gold") and rows[7000] == ("n", "free") and rows[6] == ("a", "free")
    assert table.read(first).where("level <> 'free'").count() == 0  # a reader of the state before
    assert tables.upsert(late.limit(0), table, ["ts"], ["level"]) == [] and table.read().count() == 1001


def test_two_writers_of_one_state_lose_nothing(spark, path):
    table = BucketedTable(spark, path, "k", buckets=4)

    def row(k, level):
        return spark.createDataFrame([(k, "n", level, 1)], "k int, name string, level string, ts int")

    tables.upsert(row(1, "free"), table, ["ts"], ["level"])
    seen = []

    def change(batch, held):
        if not seen:  # another writer commits between our reading and our writing
            seen.append(held)
            tables.upsert(row(2, "paid"), BucketedTable(spark, path, "k"), ["ts"], ["level"])
        return tables.upserted(batch, held, "k", ["ts"], ["level"])

    table.apply(row(3, "gold"), change)
    assert {r.k: r.level for r in table.read().collect()} == {1: "free", 2: "paid", 3: "gold"}
    assert table.numbers() == [1, 2, 3]


def test_a_failed_write_leaves_the_table(spark, path):
    table = BucketedTable(spark, path, "k", buckets=4, keep=2)
    batch = spark.createDataFrame([(1, "n", "free", 1), (None, "x", "free", 1)], "k int, name string, level string, ts int")
    for _ in range(4):
        tables.upsert(batch, table, ["ts"], ["level"])
    assert table.numbers() == [3, 4] and len(files_below(path)) == 2
    with pytest.raises(Exception):
        table.apply(batch, lambda rows, held: rows.select("k", F.raise_error(F.lit("broken")).alias("name")))
    assert [tuple(r) for r in table.read().collect()] == [(1, "n", "free")]


def test_a_table_of_no_rows(spark, path):
    table = BucketedTable(spark, path, "k")
    empty = spark.createDataFrame([], "k int, name string, level string, ts int")
    assert not table.exists() and tables.upsert(empty, table, ["ts"], ["level"]) == []
    assert table.exists() and table.read().collect() == [] and table.read().columns == ["k", "name", "level"]
