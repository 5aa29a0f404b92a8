import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlog import schemas
from starlog.schemas import conform, create_table, drop_table
from starlog.session import fit_shuffles, materialise, scratch_path, shared_folder
from starlog.sinks import files as sinks
from starlog.sinks import tables
from starlog.sinks.bucketed import BucketedTable
from starlog.sources import codes
from starlog.sources import files as sources

EVENT = {
    "artist": None, "auth": "Logged In", "firstName": "Ada", "gender": "F", "itemInSession": 0, "lastName": "Low",
    "length": None, "level": "free", "location": "Here", "method": "GET", "page": "Home", "registration": 1577836800500.0,
    "sessionId": 512, "song": None, "status": 200, "ts": 1583020800123, "userAgent": "agent", "userId": "77",
}


def write_events(folder, name, *changes):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        for change in changes:
            out.write((change if isinstance(change, str) else json.dumps(EVENT | change)) + "\n")


def test_log_reader_keeps_quoted_ids_at_any_depth(spark, path):
    write_events(f"{path}/2018/11", "1-events.json", {}, {"userId": ""})
    write_events(f"{path}/2018/12", "2-events.json", {"userId": "8", "artist": "A", "length": 209.60608})
    rows = sources.read_log(spark, path).orderBy("userId").collect()
    assert [r.userId for r in rows] == ["", "77", "8"]
    assert rows[2].length == 209.60608 and rows[1].registration == 1577836800500.0


def test_bad_lines_go_to_quarantine(spark, path):
    write_events(path, "a.json", {}, '{"ts": 1, "broken', "", {"ts": "not a number"})
    good, bad = sources.split_bad_records(sources.read_json_checked(spark, path, schemas.LOG))
    assert good.columns == schemas.LOG.fieldNames() and good.count() == 1
    newest = sources.newest(bad, "file_time", 5, ties=("raw_text",)).collect()
    assert len(newest) == 2 and any("broken" in r.raw_text for r in newest)


def test_arrival_order_across_files_and_lines(spark, path):
    for name in ("b", "a"):
        write_events(path, f"{name}.json", *[{"ts": i, "song": name} for i in range(50)])
    arrived = sources.with_arrival_order(sources.read_log(spark, path)).orderBy(*sources.ARRIVAL)
    assert [(r.song, r.ts) for r in arrived.collect()] == [(n, i) for n in "ab" for i in range(50)]


def test_mapping_file(spark, path):
    write_events(f"{path}/log", "a.json", {}, {"userId": ""})
    with open(f"{path}/rule.json", "w") as out:
        json.dump({"jsonpaths": ["$['artist']"] + [f"$.{f.name}" for f in schemas.LOG.fields[1:]]}, out, indent=1)
    fields = sources.read_path_mapping(spark, f"{path}/rule.json")
    assert fields == schemas.LOG.fieldNames()
    staged = sources.read_mapped(spark, f"{path}/log", fields, schemas.STAGED_EVENTS)
    assert sorted((r.userid or 0, r.firstname, r.ts) for r in staged.collect()) == [(0, "Ada", 1583020800123), (77, "Ada", 1583020800123)]


def test_event_csv_directories_are_one_set(spark, path):
    from starlog.plans.events import compact

    header = ",".join(schemas.EVENT_CSV.fieldNames())
    for i, (folder, artist) in enumerate([("x", "Band, The"), ("y", ""), ("z", "Solo")]):
        os.makedirs(f"{path}/{folder}")
        with open(f"{path}/{folder}/{i}-events.csv", "w") as out:
            out.write(f'{header}\n"{artist}",Logged In,Ada,F,{i},Low,,free,Here,PUT,NextSong,1.54E+12,5,Song,200,1.54E+12,9\n')
    rows = compact(sources.read_event_csv(spark, path)).orderBy("artist").collect()
    assert [(r.artist, r.itemInSession, r.userId) for r in rows] == [("Band, The", "0", "9"), ("Solo", "2", "9")]
    assert rows[0].__fields__ == schemas.COMPACT_EVENT_FIELDS


def test_port_list_order_and_spacing(spark, path):
    os.makedirs(path)
    with open(f"{path}/ports.txt", "w") as out:
        out.write("ports = {\n   'ZZZ'\t=\t'ZETA TOWN, AK     '\n   'AAA'\t=\t'ALPHA, AL'\n   'NK' \t=\t'two blanks'\n"
                  "   'AG'\t\t=\t'two tabs'\n   'ZZZ'\t=\t'ZETA AGAIN'\n}\n")
    rows = codes.read_codes(spark, f"{path}/ports.txt").orderBy("ordinal").collect()
    assert [(r.code, r.label) for r in rows] == [("ZZZ", "ZETA AGAIN"), ("AAA", "ALPHA, AL")]


def test_address_codes(spark):
    rows = {r.code: r.label for r in codes.address_codes(spark).collect()}
    assert len(rows) == 55 and rows["99"] == "All Other Codes"


def test_conform_casts_reorders_and_fills(spark):
    frame = spark.createDataFrame([("x", "12", "Ada"), ("", "free", None)], "USER_ID string, level string, First_Name string")
    out = conform(frame, schemas.USERS)
    assert out.columns == schemas.USERS.schema.fieldNames()
    assert sorted(map(tuple, out.collect()), key=str) == [(None, "Ada", None, None, "12"), (None, None, None, None, "free")]


def test_catalog_table_is_created_once(spark):
    drop_table(spark, "time")
    for _ in range(2):
        create_table(spark, schemas.TIME)
    assert spark.table("time").columns == schemas.TIME.schema.fieldNames()
    drop_table(spark, "time")
    assert not spark.catalog.tableExists("time")


def test_tsv_round_trip_with_nulls_and_tabs(spark, path):
    frame = spark.createDataFrame([(1, "a\tb", None), (2, None, 2.5), (3, 'say "x"', 0.0)], "id int, t string, d double")
    sinks.write_tsv(frame, path)
    back = sources.read_tsv(spark, path, frame.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))


def test_quoted_csv_round_trip(spark, path):
    frame = spark.createDataFrame([('say "x", twice', "a\nb"), ("back\\slash", None)], "t string, u string")
    sinks.write_quoted_csv(frame, path)
    back = sources.read_csv_text(spark, path, multiline=True)
    assert sorted(back.fillna("").collect()) == sorted(frame.fillna("").collect())


def test_write_once_and_stage(spark, path):
    assert sources.parquet_copy(spark, spark.range(3), path).count() == 3
    assert sources.parquet_copy(spark, spark.range(9), path).count() == 3
    template = path + "/{table}/{execution_date:%Y}/{execution_date:%m}"
    staged = sinks.stage(spark.range(4), template, datetime(2018, 11, 3), table="log")
    assert staged.endswith("/log/2018/11") and spark.read.parquet(staged).count() == 4


def test_partition_directories_hold_every_row_of_a_hot_partition(spark, path):
    frame = spark.range(1000).withColumn("p", F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 7).cast("string")))
    sinks.write_parquet(frame, path, by=("p",))
    back = spark.read.parquet(path)
    assert back.count() == 1000 and back.where("p = 'hot'").count() == 666
    assert "p=hot" in os.listdir(path)


def test_append_new_keeps_repeated_keys_and_is_idempotent(spark, path):
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n"), (2, "c")], "k int, v string")
    for _ in range(2):
        tables.append_new(batch, path, ["k"])
    assert sorted((r.v for r in spark.read.parquet(path).collect())) == ["a", "b", "c", "n"]
    tables.append_new(spark.createDataFrame([(2, "x"), (3, "d")], "k int, v string"), path, ["k"])
    assert spark.read.parquet(path).count() == 5


def test_insert_if_absent_prunes_partitions(spark, path):
    def batch(*rows):
        return spark.createDataFrame(rows, "k int, v string, day int")

    tables.insert_if_absent(batch((1, "b", 1), (1, "a", 1), (None, "x", 1), (2, "c", 2)), path, ["k"], [F.col("v")], by=("day",))
    tables.insert_if_absent(batch((2, "z", 2), (3, "d", 2)), path, ["k"], [F.col("v")], by=("day",))
    assert sorted((r.k, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "c"), (3, "d")]
    held = tables._touched(spark.read.parquet(path), batch((4, "q", 2)), ("day",))
    read = {r.f for r in held.select(F.input_file_name().alias("f")).collect()}
    assert read and all("day=2" in f for f in read)
    assert held.count() == 2


def test_upsert_replaces_only_the_level(spark, path):
    table = BucketedTable(spark, path, "user_id", buckets=3, keep=2)
    names = "user_id int, first_name string, level string, ts int"
    first = spark.createDataFrame([(1, "Ann", "free", 1), (1, "Anna", "paid", 2), (2, "Bob", "free", 1), (None, "?", "free", 1)], names)
    second = spark.createDataFrame([(1, "Other", "free", 3), (3, "Cy", "paid", 3)], names)
    for batch in (first, second, second, second):
        tables.upsert(batch, table, ["ts"], ["level"])
    assert sorted(map(tuple, table.read().collect())) == [(1, "Ann", "free"), (2, "Bob", "free"), (3, "Cy", "paid")]
    assert table.numbers() == [3, 4]


def test_unfinished_version_is_ignored(spark, path):
    table = tables.VersionedTable(spark, path)
    table.replace(spark.range(2))
    os.makedirs(f"{path}/v00000002")
    assert table.read().count() == 2
    table.replace(spark.range(5))
    assert table.read().count() == 5


def test_shared_folder_follows_the_setting(spark, path):
    class Conf:
        def get(self, key, default=None):
            return {"spark.checkpoint.dir": path}.get(key, default)

    class Session:
        conf = Conf()
        sparkContext = spark.sparkContext

    assert shared_folder(Session()) == path
    assert scratch_path(Session(), "x").startswith(path + "/")
    assert shared_folder(spark) == shared_folder(spark)


def test_no_local_folder_on_a_cluster():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        shared_folder(Session())


def test_materialised_step_keeps_rows_and_types(spark):
    frame = spark.createDataFrame([(1, None, "a"), (2, 2.5, None)], "i int, d double, s string")
    step = materialise(frame.withColumn("r", F.rand()))
    assert sorted(step.select("i", "r").collect()) == sorted(step.select("i", "r").collect())
    assert step.drop("r").schema == frame.schema


def test_scratch_can_be_cleared(spark):
    from starlog.session import clear_scratch

    step = materialise(spark.range(3))
    assert len(step.inputFiles()) > 0 and os.path.exists(step.inputFiles()[0].removeprefix("file://"))
    clear_scratch(spark)
    assert not os.path.exists(step.inputFiles()[0].removeprefix("file://"))


def test_shuffle_partitions_follow_the_input_size(spark, path):
    spark.range(50_000).write.parquet(path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert fit_shuffles(spark, path) == int(before)
        assert fit_shuffles(spark, path, partition_bytes=10_000) > int(before)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_read_by_name_with_bad_lines(spark, path):
    contract = schemas.Contract("t", T.StructType([T.StructField("Title", T.StringType()), T.StructField("year", T.IntegerType())]), key=())
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as out:
        out.write('{"Title": "one", "title": "two", "YEAR": 3}\n{"title": "x", "year": "many"}\nno json\n\n{"other": 1}\n')
    rows = sources.read_by_name(spark, path, contract).collect()
    assert sorted(map(tuple, rows), key=str) == [("one", 3), ("x", None), (None, None)]
    _, bad = sources.split_bad_records(sources.read_by_name_checked(spark, path, contract))
    assert [r.raw_text for r in bad.collect()] == ["no json"]


def test_versions_beside_other_entries(spark, path):
    table = tables.VersionedTable(spark, path)
    table.replace(spark.range(2))
    os.makedirs(f"{path}/_note")
    table._claim(2)  # another writer has begun version 2
    table.replace(spark.range(3))
    assert table.versions() == [1, 3] and table.read().count() == 3
