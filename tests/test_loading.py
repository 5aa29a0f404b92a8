"""Checked loads, contracts from statements and file-by-file conversion on damaged, repeated and changed input."""

import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlog import schemas
from starlog.plans import warehouse
from starlog.sinks.conversion import ConvertedCopy
from starlog.sinks.files import write_once
from starlog.sources import ddl, loading
from starlog.sources import files as sources

MS = 1541103205000

ITEMS = schemas.Contract(
    "items",
    T.StructType(
        [
            T.StructField("id", T.IntegerType(), False),
            T.StructField("Title", T.StringType(), True, {"max_length": 5}),
            T.StructField("price", T.DecimalType(6, 2)),
            T.StructField("size", T.DoubleType()),
            T.StructField("at", T.TimestampType()),
            T.StructField("ok", T.BooleanType()),
        ]
    ),
    key=("id",),
)


def lines(folder, *texts, name="a.json"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(texts) + "\n")


def told(df):
    return sorted(((r.column, r.reason, r.raw_value) for r in df.collect()), key=str)


def test_every_misfit_of_a_line_is_told(spark, path):
    good = {"ID": 1, "title": "one", "price": "3.5", "size": 1e3, "at": "2018-11-01 05:00:00", "ok": True}
    lines(path, json.dumps(good), json.dumps({"id": "", "title": "too long", "price": "99999", "size": "big", "at": "noon", "ok": "maybe"}),
          '{"id": 3, "title"', "", json.dumps({"id": "12345678901", "title": ""}), json.dumps({"id": 2.5}), json.dumps({"id": " 7 "}))
    checked = loading.json_by_name(spark, path, ITEMS)
    rows = {r.id: r for r in loading.accepted(checked).collect()}
    assert set(rows) == {1, 7} and rows[1].Title == "one" and float(rows[1].price) == 3.5 and rows[1].ok is True
    errors = loading.errors_of(checked)
    assert told(errors) == sorted(
        [
            ("id", "no value", None), ("Title", "text too long", "too long"), ("price", "number out of range", "99999"),
            ("size", "not a number", "big"), ("at", "not a timestamp", "noon"), ("ok", "not a boolean", "maybe"),
            (None, "line does not parse", None), ("id", "number out of range", "12345678901"), ("id", "not a whole number", "2.5"),
        ],
        key=str,
    )
    assert {r.line for r in errors.where("column IS NULL").collect()} == {'{"id": 3, "title"'}
    assert all(r.file.endswith("/a.json") for r in errors.collect())


def test_mapped_paths_reach_nested_and_hyphenated_fields(spark, path):
    assert loading.path_steps("$['a']['b-c'].d[0]") == ["a", "b-c", "d", 0]
    for wrong in ("a.b", "$", "$[0]", "$.a[*]", "$..a", "$['a"):
        with pytest.raises(ValueError):
            loading.path_steps(wrong)
    with open(os.path.join(os.path.dirname(path), "rule.json"), "w") as out:
        paths = ["$.key.id", "$['x-title']", "$.key['list'][1]", "$.X", "$.x", "$.missing"]
        json.dump({"jsonpaths": paths}, out)
    mapping = sources.read_path_mapping(spark, os.path.join(os.path.dirname(path), "rule.json"))
    assert mapping == ["$.key.id", "x-title", "$.key['list'][1]", "X", "x", "missing"]
    lines(path, json.dumps({"key": {"id": 5, "list": [1, 2.5]}, "x-title": "abc", "X": "4.5", "x": "2018-11-01"}), "broken {",
          json.dumps({"key": 3}), json.dumps({"key": {"id": 6}, "x-title": "", "X": "NaN?"}))
    checked = loading.json_mapped(spark, path, mapping, ITEMS)
    row = loading.accepted(checked).first()
    assert (row.id, row.Title, float(row.price), row.size, row["at"].day) == (5, "abc", 2.5, 4.5, 1)
    assert told(loading.errors_of(checked)) == sorted(
        [(None, "line does not parse", None), ("id", "no value", None), ("size", "not a number", "NaN?")], key=str
    )
    assert sources.read_mapped(spark, path, mapping, ITEMS).count() == 1  # a broken line is no row of NULLs


def test_lines_are_parsed_once(spark, path):
    lines(path, '{"id": 1, "Title": "one"}', "broken {")
    paths = ["id", "Title", "price", "size", "at", "ok"]
    checked = sources.read_json_checked(spark, path, ITEMS.schema)
    for loaded in (
        loading.accepted(loading.json_mapped(spark, path, paths, ITEMS)),
        loading.accepted(loading.json_by_name(spark, path, ITEMS)),
        sources.read_by_name(spark, path, ITEMS),
        sources.split_bad_records(checked)[0],
    ):
        assert [r.id for r in loaded.collect()] == [1]
        assert loaded._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_csv_lines_of_other_lengths(spark, path):
    lines(path, "id,title,price,size,at,ok", '1,"a ""b""",2.50,,,true', "2,x", "3,x,1,1,,,more", 'x,"a, b",,,,', name="a.csv")
    checked = loading.csv_rows(spark, path, ITEMS)
    assert [(r.id, r.Title) for r in loading.accepted(checked).collect()] == [(1, 'a "b"')]
    errors = loading.errors_of(checked)
    assert told(errors) == sorted([(None, "line does not parse", None)] * 2 + [("id", "not a whole number", "x")], key=str)
    assert {r.line for r in errors.collect()} == {"2,x", "3,x,1,1,,,more", 'x,"a, b",,,,'}


def test_errors_are_kept_across_loads(spark, path):
    errors = loading.ErrorTable(spark, f"{path}/errors")
    lines(f"{path}/1", '{"id": 1}', "no json")
    lines(f"{path}/2", '{"id": "x"}', '{"id": "y"}', '{"id": 2}')
    first = loading.load(loading.json_by_name(spark, f"{path}/1", ITEMS), f"{path}/t1", errors, "one", datetime(2018, 11, 1))
    for _ in range(2):  # a repeated load replaces its own errors
        second = loading.load(loading.json_by_name(spark, f"{path}/2", ITEMS), f"{path}/t2", errors, "two", datetime(2018, 11, 2))
    assert [r.id for r in first.collect()] == [1] and [r.id for r in second.collect()] == [2]
    assert {(r.load, r.reason) for r in errors.read().collect()} == {("one", "line does not parse"), ("two", "not a whole number")}
    assert errors.read().count() == 3 and errors.read("two").count() == 2
    newest = errors.newest(2).collect()
    assert [(r.start_time, r.reason, r.raw_value) for r in newest] == [(datetime(2018, 11, 2), "not a whole number", v) for v in "xy"]
    with pytest.raises(loading.LoadError):
        loading.load(loading.json_by_name(spark, f"{path}/2", ITEMS), f"{path}/t3", errors, "three", datetime(2018, 11, 3), max_rejected=1)
    assert errors.read("three").count() == 2
    nothing = loading.json_by_name(spark, f"{path}/1", ITEMS).limit(0)
    assert loading.load(nothing, f"{path}/t4", errors, "four", datetime(2018, 11, 4)).count() == 0


def test_warehouse_load_keeps_what_it_rejects(spark, path):
    event = {"artist": "Band", "page": "NextSong", "ts": MS, "userId": "8", "sessionId": 1, "itemInSession": 0, "level": "free"}
    lines(f"{path}/log", json.dumps(event), "broken", json.dumps(event | {"ts": "then"}))
    lines(f"{path}/songs", json.dumps({"song_id": "S", "title": "One", "artist_id": "A", "artist_name": "Band", "year": "soon"}))
    names = [f.name for f in schemas.LOG.fields]
    lines(f"{path}/rule", json.dumps({"jsonpaths": [f"$['{n}']" for n in names]}))
    tables = warehouse.load_warehouse(spark, f"{path}/log", f"{path}/rule", f"{path}/songs", f"{path}/out")
    errors = loading.ErrorTable(spark, f"{path}/out/load_errors").read()
    assert {(r.load, r.column, r.raw_value) for r in errors.collect()} == {
        ("staging_events", None, None), ("staging_events", "ts", "then"), ("staging_songs", "year", "soon"),
    }
    assert tables["users"].count() == 1 and tables["songs"].count() == 0


STATEMENTS = """
-- a comment; with a semicolon
CREATE TABLE IF NOT EXISTS public."plays" (
    playid int8 IDENTITY(0,1) PRIMARY KEY, /* numbered, (by the database) */
    "level" varchar(4) DEFAULT 'free, or (not)',
    userid int4 NOT NULL REFERENCES users (userid) SORTKEY,
    price numeric(6,2), whole numeric(18,0), ratio double precision,
    title character varying(max)
) DISTSTYLE KEY;
DROP TABLE other;
create table users (a int, b bigint, c timestamp, CONSTRAINT users_pkey PRIMARY KEY (a, "b"), FOREIGN KEY (c) REFERENCES days (d))
"""


def test_contracts_from_statements():
    found = ddl.contracts(STATEMENTS)
    assert list(found) == ["plays", "users"]
    plays, users = found["plays"], found["users"]
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in plays.schema.fields] == [
        ("playid", "bigint", False), ("level", "string", True), ("userid", "int", False), ("price", "decimal(6,2)", True),
        ("whole", "decimal(18,0)", True), ("ratio", "double", True), ("title", "string", True),
    ]
    assert [schemas.max_length(f) for f in plays.schema.fields] == [None, 4, None, None, None, None, None]
    assert plays.schema["playid"].metadata["generated"] and plays.key == ("playid",) and plays.references == {"userid": "users"}
    assert users.key == ("a", "b") and users.required == ["a", "b"] and users.references == {"c": "days"}
    for wrong in ("create table t (a strange)", "create table t (a int", "create table t (a)"):
        with pytest.raises(ValueError):
            ddl.contracts(wrong)


def test_statements_give_the_contracts_of_the_scheduled_tables():
    text = """CREATE TABLE public.songplays (playid varchar(32) NOT NULL, start_time timestamp NOT NULL, userid int4 NOT NULL,
        "level" varchar(256), songid varchar(256), artistid varchar(256), sessionid int4, location varchar(256),
        user_agent varchar(256), CONSTRAINT songplays_pkey PRIMARY KEY (playid));"""
    found, known = ddl.contracts(text)["songplays"], schemas.SCHEDULED_PLAYS
    assert [(f.name, f.dataType, f.nullable) for f in found.schema] == [(f.name, f.dataType, f.nullable) for f in known.schema]
    assert (found.name, found.key) == (known.name, known.key)


def test_violators_are_split_off(spark, path):
    contract = ddl.contracts(
        "create table t (id int primary key, parent int references p (k), name varchar(3), n bigint identity(0,1) not null)"
    )["t"]
    rows = [(1, "1", "abc"), (1, "2", "b"), (2, "9", "b"), (2, "2", "long"), (2, None, "ok"), (3, "x", "a"), (None, "1", "a"), (4, "1", "a"), (4, "1", "a")]
    frame = spark.createDataFrame(rows, "ID int, parent string, name string").repartition(4)
    parents = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    checked = loading.check_references(loading.frame_rows(frame, contract), contract, {"p": (parents, "k")})
    checked = loading.check_key(checked, contract.key)
    errors = loading.ErrorTable(spark, f"{path}/errors")
    kept = loading.load(checked, f"{path}/t", errors, "t", datetime(2018, 11, 1))
    assert sorted((r.id, r.parent, r.name) for r in kept.collect()) == [(1, 1, "abc"), (2, None, "ok"), (4, 1, "a")]
    assert told(errors.read()) == sorted(
        [("id", "key repeats", "1"), ("parent", "no such parent", "9"), ("name", "text too long", "long"),
         ("parent", "not a whole number", "x"), ("id", "no value", None), ("id", "key repeats", "4")], key=str
    )
    assert all(r.line for r in errors.read().collect())
    assert loading.check_key(loading.frame_rows(frame.limit(0), contract), contract.key).collect() == []


def read_json(spark):
    return lambda paths: spark.read.schema("k int, v string").json(paths)


def test_conversion_takes_added_and_changed_files(spark, path):
    copy, source = ConvertedCopy(spark, f"{path}/copy", files_per_batch=2), f"{path}/in"
    for i in range(5):
        lines(f"{source}/{i % 2}", json.dumps({"k": i, "v": "first"}), name=f"{i}.json")
    lines(source, "not taken", name="other.txt")
    assert copy.read().collect() == [] if copy.batches() else True
    assert copy.convert(source, read_json(spark), "*.json") == 5 and copy.batches() == [1, 2, 3]
    assert copy.convert(source, read_json(spark), "*.json") == 0
    lines(f"{source}/0", json.dumps({"k": 9, "v": "added"}), name="with blank.json")
    lines(f"{source}/0", json.dumps({"k": 2, "v": "changed"}), json.dumps({"k": 22, "v": "changed"}), name="2.json")
    os.utime(f"{source}/0/2.json", (time.time() + 5, time.time() + 5))
    assert copy.convert(source, read_json(spark), "*.json") == 2
    assert sorted(map(tuple, copy.read().collect())) == [
        (0, "first"), (1, "first"), (2, "changed"), (3, "first"), (4, "first"), (9, "added"), (22, "changed"),
    ]


def test_conversion_is_taken_up_after_a_crash(spark, path):
    copy, source = ConvertedCopy(spark, f"{path}/copy", files_per_batch=2), f"{path}/in"
    for i in range(4):
        lines(source, json.dumps({"k": i, "v": "x"}), name=f"{i}.json")
    calls = []

    def failing(paths):
        calls.append(paths)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return read_json(spark)(paths)

    with pytest.raises(RuntimeError):
        copy.convert(source, failing, "*.json")
    # rows of a batch whose list of files was never finished, and a list that was only begun
    spark.createDataFrame([(7, "half", "f")], "k int, v string, _source_file string").write.parquet(f"{path}/copy/data/_batch=2")
    os.makedirs(f"{path}/copy/files/_batch=2/_temporary")
    assert copy.batches() == [1] and sorted(r.k for r in copy.read().collect()) == [0, 1]
    assert copy.convert(source, read_json(spark), "*.json") == 2
    assert sorted(r.k for r in copy.read().collect()) == [0, 1, 2, 3]


def test_an_unfinished_copy_does_not_count(spark, path):
    os.makedirs(f"{path}/_temporary/0")
    assert sources.parquet_copy(spark, spark.range(3), path).count() == 3
    write_once(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
