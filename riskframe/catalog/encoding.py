"""Encoding, imputation and scaling."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskframe.catalog.base import Catalog, load, r6
from riskframe.operators import encode as E
from riskframe.operators import sparse
from riskframe.operators.rollup import single_level_rollup

Q = Catalog()

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@Q.add(
    "vocabulary",
    """
SELECT DISTINCT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
UNION SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders
""",
)
def vocabulary(spark, d):
    return E.fit_vocabulary(load(spark, d, "orders"))


def _flags(column, levels):
    return ", ".join(f"CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS \"{column}_{v}\"" for v in levels)


@Q.add("one_hot_segments", f"SELECT c_custkey, {_flags('c_mktsegment', SEGMENTS)} FROM customer")
def one_hot_segments(spark, d):
    customer = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return E.one_hot(customer, E.read_vocabulary(E.fit_vocabulary(customer)))


@Q.add("one_hot_priorities", f"SELECT o_orderkey, {_flags('o_orderpriority', PRIORITIES)} FROM orders")
def one_hot_priorities(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return E.one_hot(orders, E.read_vocabulary(E.fit_vocabulary(orders)))


def order_lines(spark, d):
    """Orders with line statistics; orders without lines have gaps."""
    lines = single_level_rollup(
        load(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"),
        "o_orderkey",
        {"quantity": F.avg("l_quantity"), "price": F.sum("l_extendedprice"), "n_lines": F.count(F.lit(1))},
    )
    return load(spark, d, "orders").select("o_orderkey", "o_totalprice").join(lines, "o_orderkey", "left")


ORDER_LINES_SQL = """
ol AS (
  SELECT o_orderkey, o_totalprice, quantity, price, n_lines FROM orders LEFT JOIN
    (SELECT l_orderkey, avg(l_quantity) AS quantity, sum(l_extendedprice) AS price, count(*) AS n_lines
     FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
)
"""


@Q.add(
    "median_impute",
    f"""
WITH {ORDER_LINES_SQL},
m AS (SELECT median(quantity) AS q, median(price) AS p, median(n_lines) AS n FROM ol)
SELECT o_orderkey, o_totalprice, round(coalesce(quantity, (SELECT q FROM m)), 6) AS quantity,
       round(coalesce(price, (SELECT p FROM m)), 2) AS price,
       CAST(coalesce(n_lines, (SELECT n FROM m)) AS DOUBLE) AS n_lines
FROM ol
""",
)
def median_impute(spark, d):
    joined = order_lines(spark, d)
    medians = E.fit_medians(joined, ["quantity", "price", "n_lines"])
    filled = E.impute_median(joined, medians)
    return filled.withColumns({"quantity": r6("quantity"), "price": r6("price", 2)})


@Q.add(
    "column_medians",
    """
SELECT median(l_quantity) AS l_quantity, round(median(l_extendedprice), 4) AS l_extendedprice,
       median(l_discount) AS l_discount, median(CAST(l_partkey AS DOUBLE)) AS l_partkey FROM lineitem
""",
)
def column_medians(spark, d):
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]
    medians = E.fit_medians(load(spark, d, "lineitem"), columns)
    medians["l_extendedprice"] = round(medians["l_extendedprice"], 4)
    return spark.createDataFrame([tuple(medians[c] for c in columns)], ", ".join(f"{c} double" for c in columns))


@Q.add(
    "standardize",
    """
WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd, avg(c_nationkey) AS nm, stddev_pop(c_nationkey) AS nsd
           FROM customer)
SELECT c_custkey, round((c_acctbal - (SELECT m FROM s)) / (SELECT sd FROM s), 6) AS c_acctbal,
       round((c_nationkey - (SELECT nm FROM s)) / (SELECT nsd FROM s), 6) AS c_nationkey
FROM customer
""",
)
def standardize(spark, d):
    columns = ["c_acctbal", "c_nationkey"]
    scaled = E.standardize(load(spark, d, "customer").select("c_custkey", *columns), columns)
    return scaled.withColumns({c: r6(c) for c in columns})


@Q.add(
    "assemble_vector",
    "SELECT c_custkey, 2 AS size, c_acctbal AS first, CAST(c_nationkey AS DOUBLE) AS second FROM customer",
)
def assemble_vector(spark, d):
    customer = load(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    v = vector_to_array("features")
    return E.assemble_vector(customer, ["c_acctbal", "c_nationkey"]).select(
        "c_custkey", F.size(v).alias("size"), v[0].alias("first"), v[1].alias("second")
    )


@Q.add(
    "sparse_one_hot",
    """
WITH l AS (
  SELECT 0 AS col, CAST(l_partkey AS VARCHAR) AS value, count(*) AS n FROM lineitem GROUP BY 2
  UNION ALL SELECT 1, l_returnflag, count(*) FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 2
  UNION ALL SELECT 2, CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem GROUP BY 2
),
p AS (SELECT col, value, row_number() OVER (ORDER BY col, value) - 1 AS place FROM l),
width AS (SELECT CAST(count(*) AS INTEGER) AS size FROM l)
SELECT l_orderkey, l_linenumber, size, concat_ws(',', a.place, b.place, c.place) AS places, 3e0 AS total
FROM lineitem JOIN p a ON a.col = 0 AND a.value = CAST(l_partkey AS VARCHAR) JOIN p b ON b.col = 1 AND b.value = l_returnflag
JOIN p c ON c.col = 2 AND c.value = CAST(l_suppkey AS VARCHAR), width
""",
)
def sparse_one_hot(spark, d):
    """Columns of thousands of levels as one sparse vector per row; parts are joined by a shuffle, the others by broadcast."""
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_suppkey")
    levels = sparse.fit_levels(lines, ["l_partkey", "l_returnflag", "l_suppkey"])
    vectors = sparse.sparse_vectors(lines, levels, few_levels=1000)
    v = F.unwrap_udt("features")
    total = F.aggregate(v["values"], F.lit(0.0), lambda a, x: a + x)
    return vectors.select(
        "l_orderkey", "l_linenumber", v["size"].alias("size"), F.array_join(v["indices"], ",").alias("places"), total.alias("total")
    )
