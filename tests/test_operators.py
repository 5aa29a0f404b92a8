import random

import pytest
from pyspark.sql import functions as F

from starlog.functions import calendar as cal
from starlog.functions import values as val
from starlog.operators import aggregates as agg
from starlog.operators import joins, quality
from starlog.operators.dedupe import first_and_last, first_row_per_key, latest_rows


def test_latest_rows_keep_ties_and_drop_null_keys(spark):
    rows = [("a", 1, "free"), ("a", 5, "paid"), ("a", 5, "free"), ("a", 5, "free"), ("b", 2, "free"), (None, 9, "paid"), ("c", None, "free")]
    out = latest_rows(spark.createDataFrame(rows, "user string, ts int, level string"), "user", "ts", ["level"])
    assert sorted(map(tuple, out.collect())) == [("a", "free"), ("a", "paid"), ("b", "free")]


def test_first_row_per_key_is_idempotent_and_null_last(spark):
    rows = [("s", None, 1), ("s", "b", 2), ("s", "a", 3), ("t", None, 4)]
    frame = spark.createDataFrame(rows, "k string, a string, v int")
    once = first_row_per_key(frame, ["k"], [F.col("a").asc_nulls_last()])
    assert sorted(map(tuple, once.collect())) == [("s", "a", 3), ("t", None, 4)]
    twice = first_row_per_key(once.unionByName(once), ["k"], [F.col("a").asc_nulls_last()])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_first_and_last(spark):
    rows = [("a", 2, "Ann", "paid"), ("a", 1, "Anna", "free"), ("a", 3, "A.", "free"), ("a", 4, "A.", "paid"), (None, 1, "x", "y")]
    out = first_and_last(spark.createDataFrame(rows, "k string, ts int, name string, level string"), "k", ["ts"], ["name"], ["level"])
    assert [tuple(r) for r in out.collect()] == [("a", "Anna", "paid")]


def test_at_most_one_lookup_never_multiplies(spark):
    plays = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None)], "id int, title string")
    songs = spark.createDataFrame([("x", "S2"), ("x", "S1"), ("z", "S3"), (None, "S4")], "title string, song_id string")
    out = joins.lookup_at_most_one(plays, songs, ["title"], [F.col("song_id").asc()], ["song_id"])
    assert sorted((r.id, r.song_id) for r in out.collect()) == [(1, "S1"), (2, "S1"), (3, None), (4, None)]


def brute_first_label(terms, labels):
    found = {}
    for term in {t for t in terms if t is not None}:
        hits = [code for _, code, label in sorted(labels) if label is not None and term.lower() in label.lower()]
        found[term] = hits[0] if hits else None
    return found


def test_first_label_containing(spark):
    labels = [(0, "ZED", "ZEDVILLE, QX"), (1, "NYC", "NEW YORK, NY"), (2, "NEW", "NEWARK/NEW YORK, NJ"), (3, "XXX", None), (4, "E", "")]
    terms = ["New York", "Newark", "NEW", "York, n", "", None, "Paris", "an", "a very long name that no label can hold", "New York"]
    out = joins.first_label_containing(
        spark.createDataFrame([(t,) for t in terms], "city string"), "city",
        spark.createDataFrame(labels, "ordinal bigint, code string, label string"),
    )
    assert {r.city: r.code for r in out.collect()} == brute_first_label(terms, labels)
    assert out.count() == len(set(terms)) - 1


def label_frames(spark, terms, labels):
    return (
        spark.createDataFrame([(t,) for t in terms], "city string"),
        spark.createDataFrame(labels, "ordinal bigint, code string, label string"),
    )


@pytest.mark.parametrize("seed", range(3))
def test_long_terms_against_brute_force(spark, seed):
    pick = random.Random(seed)
    labels = [(i, f"C{i}", "".join(pick.choices("abAé ", k=pick.randrange(0, 60)))) for i in range(60)]
    terms = []
    for _ in range(150):
        text = pick.choice(labels)[2]
        at = pick.randrange(0, len(text) + 1)
        terms.append(text[at : at + pick.randrange(0, 30)] + pick.choice(["", "", "b", "x"]))
    labels += [(7, "C7", "another label under one number"), (99, None, "aaaaaaaaaaaa without a code")]
    terms += ["label under one", "aaaaaaaaaaa", "aaaaaaaaaaaa without"]
    frame, texts = label_frames(spark, terms, labels)
    out = joins.first_label_containing(frame, "city", texts, gram=4)
    want = {}
    for term in set(terms):
        hits = [(n, code or "") for n, code, label in labels if term.lower() in label.lower()]
        want[term] = (min(hits)[1] or None) if hits else None
    assert {r.city: r.code for r in out.collect()} == want and out.count() == len(want)


def candidates(spark, n, label, term):
    """How many substrings are cut for n labels and terms made from their numbers."""
    labels = [(i, f"C{i}", label(i)) for i in range(n)]
    terms = sorted({term(i) for i in range(n)})
    frame, texts = label_frames(spark, terms, labels)
    texts = joins._label_texts(texts)
    cut = joins.cut_candidates(frame.select(F.lower("city").alias("_term")), texts, 8)
    assert {r._term for r in cut.join(frame.select(F.lower("city").alias("_term")), "_term").collect()} == {
        t.lower() for t in terms if any(t.lower() in x[2].lower() for x in labels)
    }
    return cut.count()


def test_a_shared_beginning_makes_no_pairs(spark):
    shared = "the very same long beginning of all "
    for label, term in (
        (lambda i: f"{shared}{i:07d}, NY", lambda i: f"same long beginning of all {i // 10:06d}"),
        (lambda i: shared + "z" * (i % 50), lambda i: shared[: 9 + i % 20]),  # every substring is frequent
    ):
        small, large = (candidates(spark, n, label, term) for n in (500, 2000))
        assert small <= 25 * 500 and large <= 4.5 * small


def test_added_label_keeps_every_row(spark):
    labels = spark.createDataFrame([(5, "B", "Bergen and Bern"), (2, "A", "Bern")], "ordinal bigint, code string, label string")
    rows = spark.createDataFrame([(1, "bern"), (2, "BERN"), (3, None), (4, "Oslo"), (5, "bergen")], "id int, city string")
    out = joins.add_first_label(rows, "city", labels, "port")
    assert sorted((r.id, r.port) for r in out.collect()) == [(1, "A"), (2, "A"), (3, None), (4, None), (5, "B")]


def test_no_terms_or_no_labels(spark):
    labels = spark.createDataFrame([(1, "A", "Alpha")], "ordinal bigint, code string, label string")
    terms = spark.createDataFrame([("alp",)], "city string")
    assert joins.first_label_containing(terms.limit(0), "city", labels).count() == 0
    assert [tuple(r) for r in joins.first_label_containing(terms, "city", labels.limit(0)).collect()] == [("alp", None)]


def test_join_null_safe(spark):
    left = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, v int")
    assert sorted(map(tuple, joins.join_null_safe(left, right, ["k"], "left").collect())) == [(1, "a", 10), (2, None, 20)]


def test_value_counts_null_group_counts_zero(spark):
    frame = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "c string")
    assert [tuple(r) for r in agg.value_counts(frame, "c").collect()] == [(None, 0), ("b", 1), ("a", 2)]


def test_profile_and_summary(spark):
    frame = spark.createDataFrame([(1, "7"), (2, "x"), (2, None)], "n int, t string")
    got = {(r.column, r.value): r["count"] for r in agg.profile_columns(frame).collect()}
    assert got == {("n", "1"): 1, ("n", "2"): 2, ("t", "7"): 1, ("t", "x"): 1, ("t", None): 0}
    text = {r.column: r for r in agg.summary(frame, ["n", "t"]).collect()}
    assert (text["n"]["count"], text["n"]["min"], text["n"]["max"]) == (3, "1", "2")
    assert (text["t"]["count"], text["t"]["mean"]) == (2, 7.0)


def test_quality_comparisons(spark):
    empty = spark.createDataFrame([], "a int")
    strict = quality.row_count("t", empty)
    assert not strict.first().passed
    assert quality.row_count("t", empty, ">=").first().passed
    with pytest.raises(quality.QualityError, match="row_count t: 0 is not > 0"):
        quality.require(strict)
    assert quality.require(quality.row_count("t", empty, ">=")).count() == 1


def test_same_count_and_orphans(spark):
    one = spark.createDataFrame([(1,), (None,)], "a int")
    two = spark.createDataFrame([(1,), (2,), (2,)], "a int")
    assert quality.same_count("x", one, one).first().passed
    assert tuple(quality.same_count("x", one, two).first())[2:] == (2, "=", 3, False)
    assert quality.same_count("x", one.limit(0), two.limit(0)).first().passed
    assert quality.no_orphans("t", one, "a", two, "a").first().passed
    assert quality.no_orphans("t", two, "a", one, "a").first().measured == 2
    assert quality.no_nulls("t", one, ["a"]).first().measured == 1
    assert quality.unique_key("t", two, ["a"]).first().measured == 1


def test_calendar_functions(spark):
    one = spark.range(1).select(F.lit(1541290000999).cast("bigint").alias("ms"))  # a Sunday
    ts = cal.from_epoch_ms(F.col("ms"))
    row = one.select(
        cal.weekday_monday0(ts).alias("mon"),
        cal.weekday_sunday0(ts).alias("sun"),
        cal.from_epoch_ms_whole_seconds(F.col("ms")).cast("string").alias("sec"),
        cal.time_of_day(ts).alias("clock"),
        cal.parse_date(F.lit("2013-04-31")).alias("bad"),
        cal.parse_date(F.lit("2013-04-30")).cast("string").alias("good"),
        cal.month_start(F.lit(2016.0), F.lit(4.0)).cast("string").alias("month"),
        cal.month_start(F.lit(2016.0), F.lit(13.0)).alias("no_month"),
        cal.from_epoch_ms(F.lit(None).cast("bigint")).alias("null_ts"),
        *[c.alias(n) for n, c in cal.load_stamp().items()],
    ).first()
    assert (row.mon, row.sun) == (6, 0)
    assert row.sec == "2018-11-04 00:06:40" and row.clock == "00:06:40.999"
    assert (row.bad, row.good, row.month, row.no_month, row.null_ts) == (None, "2013-04-30", "2016-04-01", None, None)
    assert abs(row.loaded_epoch - row.loaded_at.timestamp()) < 2


def test_value_functions(spark):
    row = spark.range(1).select(
        val.drop_fraction(F.lit(-2.7)).alias("cut"),
        val.drop_fraction(F.lit(209.60608), "round").alias("rounded"),
        val.drop_fraction(F.lit(2.5), "round").alias("half"),
        val.varchar(F.lit("ABCD"), 2).alias("short"),
        val.user_number(F.lit("39")).alias("id"),
        val.user_number(F.lit("")).alias("none"),
        val.md5_key(F.lit(1), F.lit(None).cast("string")).alias("null_key"),
        val.strip(F.lit("\t ZEDVILLE, QX \n")).alias("label"),
        val.event_flag(F.lit(None).cast("string"), "x").alias("flag"),
    ).first()
    assert (row.cut, row.rounded, row.half, row.short) == (-2, 210, 3, "AB")
    assert (row.id, row.none, row.null_key, row.label, row.flag) == (39, None, None, "ZEDVILLE, QX", 0)
    with pytest.raises(ValueError):
        val.drop_fraction(F.lit(1.0), "floor")


def test_lengths_out_of_range_become_null(spark):
    df = spark.createDataFrame([(1e30,), (2.9,), (None,)], "n double")
    got = df.select(val.drop_fraction(F.col("n")).alias("a"), val.drop_fraction(F.col("n"), "round").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(None, None), (2, 3), (None, None)]
