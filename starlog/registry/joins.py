"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from starlog.functions.values import drop_fraction
from starlog.operators import joins
from starlog.registry import query
from starlog.registry import standins as std
from starlog.sources.files import read_table


@query("""SELECT p_partkey, p_name, first_key FROM part JOIN
  (SELECT p_name, p_type, MIN(p_partkey) AS first_key FROM part WHERE p_size > 10 GROUP BY ALL) USING (p_name, p_type)
UNION ALL SELECT p_partkey, p_name, NULL FROM part WHERE NOT EXISTS
  (SELECT 1 FROM part q WHERE q.p_size > 10 AND q.p_name = part.p_name AND q.p_type = part.p_type)""")
def lookup_at_most_one(spark, d):
    """Each part with the lowest key among the larger parts of its name and type."""
    part = read_table(spark, d, "part")
    larger = part.where("p_size > 10").select("p_name", "p_type", F.col("p_partkey").alias("first_key"))
    found = joins.lookup_at_most_one(
        part.select("p_partkey", "p_name", "p_type"), larger, ["p_name", "p_type"], [F.col("first_key").asc()], ["first_key"]
    )
    return found.select("p_partkey", "p_name", "first_key")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND n_regionkey <> 4)")
def semi_valid_codes(spark, d):
    codes = read_table(spark, d, "nation").where("n_regionkey <> 4")
    return joins.keep_listed(read_table(spark, d, "customer").select("c_custkey", "c_nationkey"), codes, "c_nationkey", "n_nationkey")


@query("""SELECT c_custkey, COUNT(*) AS rows FROM customer WHERE NOT EXISTS
  (SELECT 1 FROM orders WHERE o_custkey = c_custkey) GROUP BY c_custkey""")
def anti_orphans(spark, d):
    """Customers that no order refers to."""
    orders = read_table(spark, d, "orders").select("o_custkey").distinct()
    return joins.orphans(read_table(spark, d, "customer"), "c_custkey", orders, "o_custkey")


@query("""WITH words AS (SELECT DISTINCT lower(word) AS term, word FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents)),
  terms AS (SELECT DISTINCT term FROM words),
  hits AS (SELECT term, MIN(item_id) AS code FROM terms JOIN benchmark ON contains(lower(benchmark.text), term) GROUP BY term)
SELECT word, CAST(code AS VARCHAR) AS code FROM words LEFT JOIN hits USING (term)""")
def contains_first_match(spark, d):
    """Every distinct word of the documents with the first benchmark text that contains it."""
    documents = read_table(spark, d, "documents")
    words = documents.select(F.explode(F.split("text", r"\s+")).alias("word"))
    labels = read_table(spark, d, "benchmark").select(
        F.col("item_id").alias("ordinal"), F.col("item_id").cast("string").alias("code"), F.col("text").alias("label")
    )
    return joins.first_label_containing(words, "word", labels)


@query("""SELECT p_partkey, n_name AS place, (SELECT 'N' || max(m.n_nationkey) FROM nation m
   WHERE m.n_regionkey <> 4 AND contains(lower(m.n_name), lower(nation.n_name))) AS port
FROM part JOIN nation ON n_nationkey = p_size % 25""")
def contains_match_added(spark, d):
    """Each part's place (a nation name) with the first port whose label contains it, NULL if none."""
    part = read_table(spark, d, "part").select("p_partkey", (F.col("p_size") % 25).alias("n_nationkey"))
    nation = read_table(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("place"))
    rows = part.join(nation, "n_nationkey").select("p_partkey", "place")
    return joins.add_first_label(rows, "place", std.port_list(spark, d), "port").select("p_partkey", "place", "port")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, p_partkey AS matched FROM lineitem LEFT JOIN part
ON p_partkey = l_partkey AND trunc(p_retailprice) = trunc(900 + (l_extendedprice / l_quantity) % 100)""")
def decimal_align_join(spark, d):
    """Lines matched to their part on key and whole-number price; the fractions differ."""
    lines = read_table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        drop_fraction(900 + (F.col("l_extendedprice") / F.col("l_quantity")) % 100).alias("_price"),
    )
    part = read_table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"), drop_fraction(F.col("p_retailprice")).alias("_price"), F.col("p_partkey").alias("matched")
    )
    return lines.join(part, ["l_partkey", "_price"], "left").drop("_price")
