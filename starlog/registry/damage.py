"""Loads of damaged input, loads under contracts from statements, and conversion file by file.

Damaged input is orders written as JSON and CSV lines of which some do not
fit: of fifty orders one line is cut short, and one each has a price that is no number, a customer beyond the
type, a date that does not exist and no customer, or a status that is too long.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlog.registry import query
from starlog.registry import standins as std
from starlog.schemas import Contract
from starlog.session import scratch_path
from starlog.sources import ddl, loading
from starlog.sinks.conversion import ConvertedCopy
from starlog.sources.files import read_table

ORDERS = Contract(
    "orders",
    T.StructType(
        [
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("o_custkey", T.IntegerType(), False),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.DateType()),
            T.StructField("o_orderstatus", T.StringType(), metadata={"max_length": 1}),
        ]
    ),
)
_STARTED = {"by-name": datetime(2018, 11, 1, 5), "mapped": datetime(2018, 11, 2, 5), "csv": datetime(2018, 11, 3, 5)}
_STATUS = {"by-name": "F", "mapped": "O", "csv": "P"}


def _damaged(spark, d, status):
    """(key, customer, price, date, status) as text, damaged, and how."""
    orders = read_table(spark, d, "orders").where(F.col("o_orderstatus") == status)
    how = F.col("o_orderkey") % 50
    return orders.select(
        how.alias("how"),
        F.col("o_orderkey").cast("string").alias("key"),
        F.when(how == 2, "99999999999").when(how != 3, F.col("o_custkey").cast("string")).alias("customer"),
        F.when(how == 1, "12,5x").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(how == 3, "1995-13-45").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.when(how == 4, "FF").otherwise(F.col("o_orderstatus")).alias("status"),
    )


def _loaded(spark, d):
    """Three loads of one kind of orders each, the first one twice; their staged rows and the error table."""
    path = scratch_path(spark, "damaged")
    cut = F.concat(F.lit('{"o_orderkey":'), F.col("key"), F.lit(",broken"))

    def write(load, line):
        rows = _damaged(spark, d, _STATUS[load])
        rows.select(F.when(F.col("how") == 0, cut).otherwise(line).alias("value")).write.text(f"{path}/{load}")

    named = {"O_ORDERKEY": "key", "o_custkey": "customer", "O_TotalPrice": "price", "o_orderdate": "date", "o_orderstatus": "status"}
    write("by-name", F.to_json(F.struct(*[F.col(c).alias(n) for n, c in named.items()])))
    nested = F.struct(F.col("key"), F.col("customer").alias("cust-key"))
    write("mapped", F.to_json(F.struct(nested.alias("order"), "price", F.col("date").alias("on-date"), F.array("status").alias("st"))))
    fields = [F.coalesce(c, F.lit("")) for c in ("key", "customer", "price", "date", "status")]
    fields[2] = F.concat(F.lit('"'), fields[2], F.lit('"'))
    write("csv", F.concat_ws(",", *fields))

    paths = ["$.order.key", "$['order']['cust-key']", "$.price", "$['on-date']", "$.st[0]"]
    checked = {
        "by-name": loading.json_by_name(spark, f"{path}/by-name", ORDERS, "*.txt"),
        "mapped": loading.json_mapped(spark, f"{path}/mapped", paths, ORDERS, "*.txt"),
        "csv": loading.csv_rows(spark, f"{path}/csv", ORDERS, "*.txt", header=False),
    }
    errors = loading.ErrorTable(spark, f"{path}/errors")
    staged = []
    for load in ("by-name", *checked):
        rows = loading.load(checked[load], f"{path}/staged/{load}", errors, load, _STARTED[load])
        staged.append(rows.withColumn("load", F.lit(load)))
    return staged[1:], errors


_LOADS = " UNION ALL ".join(
    f"SELECT '{load}' AS load, '{_STARTED[load]}' AS start_time, o_orderkey % 50 AS how, * FROM orders WHERE o_orderstatus = '{status}'"
    for load, status in _STATUS.items()
)
_WHAT = [
    (0, "NULL", "line does not parse", "NULL"),
    (1, "'o_totalprice'", "not a number", "'12,5x'"),
    (2, "'o_custkey'", "number out of range", "'99999999999'"),
    (3, "'o_custkey'", "no value", "NULL"),
    (3, "'o_orderdate'", "not a date", "'1995-13-45'"),
    (4, "'o_orderstatus'", "text too long", "'FF'"),
]
_ERRORS = " UNION ALL ".join(
    f"""SELECT load, start_time, {column} AS "column", '{reason}' AS reason, {raw} AS raw_value,
    {"'{" + '"o_orderkey":' + "' || o_orderkey || ',broken'" if how == 0 else "NULL"} AS line FROM l WHERE how = {how}"""
    for how, column, reason, raw in _WHAT
)


@query(f"WITH l AS ({_LOADS}) {_ERRORS}")
def load_errors(spark, d):
    """What did not fit in three loads, by name, through mapped paths and from CSV, one of them repeated."""
    errors = std.iso(_loaded(spark, d)[1].read())
    return errors.select(
        "load", "start_time", "column", "reason", "raw_value", F.when(F.col("column").isNull(), F.col("line")).alias("line")
    )


@query(f"""WITH l AS ({_LOADS}) SELECT load, o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus FROM l WHERE how > 4""")
def load_accepted(spark, d):
    """The staged rows of the same loads."""
    return std.longs(std.iso(reduce(lambda a, b: a.unionByName(b), _loaded(spark, d)[0])))


@query(f"""WITH l AS ({_LOADS}), e AS ({_ERRORS}) SELECT start_time, reason, raw_value FROM
  (SELECT * FROM e ORDER BY start_time DESC, load, "column" NULLS FIRST, raw_value NULLS FIRST, line LIMIT 5)""")
def load_errors_newest(spark, d):
    """Start time, reason and raw value of the five newest load errors."""
    return std.iso(_loaded(spark, d)[1].newest(5))


_STATEMENTS = """
-- customers and the nations that they may name
CREATE TABLE IF NOT EXISTS public.nations (nationkey int4 NOT NULL PRIMARY KEY, "name" varchar(256)) DISTSTYLE ALL;
CREATE TABLE public.customers (
    custkey int8 NOT NULL,
    name varchar(256),
    nationkey int4 NOT NULL REFERENCES nations (nationkey),
    segment varchar(9),
    balance numeric(12,2),
    CONSTRAINT customers_pkey PRIMARY KEY (custkey)
) SORTKEY (nationkey);
"""


@query("""WITH c AS (SELECT c_custkey AS custkey, c_custkey % 20 AS how, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer),
  n AS (SELECT n_nationkey AS nationkey FROM nation WHERE n_regionkey <> 4),
  r AS (SELECT custkey, how = 2 AS missing, length(segment) > 9 AS long, how <> 2 AND nationkey NOT IN (SELECT nationkey FROM n) AS lost FROM c),
  ok AS (SELECT custkey FROM r WHERE NOT missing AND NOT long AND NOT lost)
SELECT 'accepted' AS kind, custkey, NULL AS "column", NULL AS reason, COUNT(*) AS rows FROM ok GROUP BY custkey
UNION ALL SELECT 'rejected', custkey, 'nationkey', 'no value', 1 FROM r WHERE missing
UNION ALL SELECT 'rejected', custkey, 'segment', 'text too long', 1 + CAST(custkey % 20 = 3 AS BIGINT) FROM r WHERE long
UNION ALL SELECT 'rejected', custkey, 'nationkey', 'no such parent', 1 + CAST(custkey % 20 = 3 AS BIGINT) FROM r WHERE lost
UNION ALL SELECT 'rejected', custkey, 'custkey', 'key repeats', 1 FROM ok WHERE custkey % 20 = 3""")
def ddl_load(spark, d):
    """Customers, some of them twice, loaded under the contracts of a file of CREATE TABLE statements."""
    path = scratch_path(spark, "ddl")
    spark.createDataFrame([(_STATEMENTS,)], "value string").coalesce(1).write.text(f"{path}/statements")
    contracts = ddl.read_contracts(spark, f"{path}/statements")
    nation = read_table(spark, d, "nation").where("n_regionkey <> 4")
    errors = loading.ErrorTable(spark, f"{path}/errors")
    nations = nation.select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("NAME"))
    nations = loading.load(loading.frame_rows(nations, contracts["nations"]), f"{path}/nations", errors, "nations", _STARTED["csv"])
    customer = read_table(spark, d, "customer")
    customer = customer.unionByName(customer.where("c_custkey % 20 = 3")).select(
        F.col("c_custkey").alias("custkey"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 20 != 2, F.col("c_nationkey")).alias("nationkey"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    contract = contracts["customers"]
    checked = loading.frame_rows(customer, contract)
    checked = loading.check_references(checked, contract, {"nations": (nations, "nationkey")})
    checked = loading.check_key(checked, contract.key)
    staged = loading.load(checked, f"{path}/customers", errors, "customers", _STARTED["csv"])
    kept = staged.groupBy("custkey").agg(F.count("*").alias("rows"))
    rejected = errors.read("customers").withColumn("custkey", F.get_json_object("line", "$.custkey").cast("bigint"))
    rejected = rejected.groupBy("custkey", "column", "reason").agg(F.count("*").alias("rows"))
    kinds = kept.withColumn("kind", F.lit("accepted")), rejected.withColumn("kind", F.lit("rejected"))
    return kinds[0].unionByName(kinds[1], allowMissingColumns=True)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def converted_deliveries(spark, d):
    """JSON files converted as they are delivered: in part, interrupted before the second part, and again with nothing new."""
    path = scratch_path(spark, "converted")
    supplier = read_table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    copy = ConvertedCopy(spark, f"{path}/copy", files_per_batch=2)

    def read(files):
        return spark.read.schema(supplier.schema).json(files)

    for part in range(3):
        supplier.where(F.col("s_suppkey") % 3 == part).write.json(f"{path}/in/{part}")
        copy.convert(f"{path}/in", read, "*.json")
        # what a run leaves that stops before its batch counts
        supplier.write.parquet(f"{path}/copy/data/_batch={copy.batches()[-1] + 1}")
    return copy.read()
