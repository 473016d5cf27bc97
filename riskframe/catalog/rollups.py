"""Roll-ups and joins."""

from pyspark.sql import functions as F

from riskframe.catalog.base import Catalog, day_number, load, r6, settle, settle_sql
from riskframe.functions import expr as X
from riskframe.operators.assemble import Side, assemble, key_overlap
from riskframe.operators.rollup import attach_to_entity, frequent_keys, ratio_of, single_level_rollup, two_level_rollup

Q = Catalog()

REFERENCE_DAY = 10000  # day number from which lateness is counted in these queries


def customer_shipments(spark, d):
    """Per order: unit price and lateness; per customer: means of means, worst of worst."""
    lines = load(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    price = X.eps_ratio("l_extendedprice", "l_quantity")
    late = X.day_gap(day_number("l_shipdate"), F.lit(REFERENCE_DAY))
    rolled = two_level_rollup(
        lines,
        "o_orderkey",
        {
            "price_mean": F.avg(price),
            "price_std": F.stddev_samp(price),
            "late_mean": F.avg(late),
            "late_max": F.max(late),
            "late_share": X.share_where(late > 0),
            "severe_share": X.share_where(late > 0, 30),
        },
        load(spark, d, "orders"),
        "o_custkey",
        {
            "unit_price_mean": F.avg("price_mean"),
            "unit_price_std": F.avg("price_std"),
            "late_mean": F.avg("late_mean"),
            "late_max": F.max("late_max"),
            "late_share": F.avg("late_share"),
            "severe_share": F.avg("severe_share"),
        },
    ).withColumnRenamed("o_custkey", "c_custkey")
    customer = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return assemble(customer, [Side(rolled, unique=True)], "c_custkey").select(
        "c_custkey",
        "c_mktsegment",
        settle("unit_price_mean").alias("unit_price_mean"),
        settle("unit_price_std").alias("unit_price_std"),
        settle("late_mean").alias("late_mean"),
        "late_max",
        settle("late_share").alias("late_share"),
        settle("severe_share").alias("severe_share"),
    )


Q.add(
    "entity_rollup_flagship",
    f"""
WITH line AS (
  SELECT l_orderkey, l_extendedprice / (l_quantity + 1e-6) AS price,
         datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) - 10000 AS late
  FROM lineitem
), per_order AS (
  SELECT l_orderkey, avg(price) AS pm, stddev_samp(price) AS ps, avg(late) AS lm, max(late) AS lx,
         avg(CASE WHEN late > 0 THEN 1 ELSE 0 END) AS ls, avg(CASE WHEN late > 0 THEN 30 ELSE 0 END) AS ss
  FROM line GROUP BY l_orderkey
), per_customer AS (
  SELECT o_custkey, avg(pm) AS pm, avg(ps) AS ps, avg(lm) AS lm, max(lx) AS lx, avg(ls) AS ls, avg(ss) AS ss
  FROM per_order JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey
)
SELECT c_custkey, c_mktsegment, {settle_sql("pm")} AS unit_price_mean, {settle_sql("ps")} AS unit_price_std,
       {settle_sql("lm")} AS late_mean, CAST(lx AS INTEGER) AS late_max, {settle_sql("ls")} AS late_share,
       {settle_sql("ss")} AS severe_share
FROM customer LEFT JOIN per_customer ON c_custkey = o_custkey
""",
)(customer_shipments)


@Q.add(
    "single_level_rollup",
    f"""
SELECT o_custkey, count(DISTINCT o_orderkey) AS n_orders,
       CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_filled,
       CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_open,
       round(sum(o_totalprice), 2) AS total_price, max(o_totalprice) AS max_price, min(o_totalprice) AS min_price,
       {settle_sql("avg(o_totalprice / (o_custkey + 1e-6))")} AS price_per_key_mean,
       round(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(DISTINCT o_orderkey), 6) AS filled_rate
FROM orders GROUP BY o_custkey
""",
)
def single_level(spark, d):
    rolled = single_level_rollup(
        load(spark, d, "orders"),
        "o_custkey",
        {
            "n_orders": F.count_distinct("o_orderkey"),
            "n_filled": X.count_where(F.col("o_orderstatus") == "F"),
            "n_open": X.count_where(F.col("o_orderstatus") == "O"),
            "total_price": r6(F.sum("o_totalprice"), 2),
            "max_price": F.max("o_totalprice"),
            "min_price": F.min("o_totalprice"),
            "price_per_key_mean": settle(X.mean_of_ratio("o_totalprice", "o_custkey")),
        },
    )
    return ratio_of(rolled, "filled_rate", "n_filled", "n_orders").withColumn("filled_rate", r6("filled_rate"))


@Q.add(
    "code_rollup_last_offset",
    """
WITH coded AS (
  SELECT l_orderkey, CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS code,
         -CAST(datediff('day', CAST(l_shipdate AS DATE), DATE '2002-01-01') AS INTEGER) AS day_offset
  FROM lineitem
), share AS (
  SELECT l_orderkey, avg(CASE WHEN code > 0 THEN 1 ELSE 0 END) AS s, max(code) AS w FROM coded GROUP BY l_orderkey
), last_one AS (
  SELECT l_orderkey, -max(day_offset) AS m FROM coded WHERE code > 0 GROUP BY l_orderkey
)
SELECT share.l_orderkey, round(s, 6) AS delinquent_share, CAST(w AS INTEGER) AS worst_code,
       CAST(m AS INTEGER) AS days_since_last
FROM share LEFT JOIN last_one ON share.l_orderkey = last_one.l_orderkey
""",
)
def code_rollup(spark, d):
    status = F.when(F.col("l_returnflag") == "N", "C").when(F.col("l_returnflag") == "A", "1").otherwise("2")
    code = X.code_to_number(status)
    offset = day_number("l_shipdate") - F.unix_date(F.lit("2002-01-01").cast("date"))
    return single_level_rollup(
        load(spark, d, "lineitem"),
        "l_orderkey",
        {
            "delinquent_share": r6(X.share_where(code > 0)),
            "worst_code": F.max(code),
            "days_since_last": X.last_offset_where(code > 0, offset),
        },
    )


@Q.add(
    "subset_left_join",
    """
WITH every AS (SELECT l_partkey, count(*) AS n_lines, max(l_quantity) AS max_quantity FROM lineitem GROUP BY l_partkey),
returned AS (SELECT l_partkey, count(*) AS n_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey)
SELECT every.l_partkey, n_lines, max_quantity, n_returned
FROM every LEFT JOIN returned ON every.l_partkey = returned.l_partkey
""",
)
def subset_left_join(spark, d):
    """An aggregate joined to an aggregate of a filtered part of the same child table."""
    lines = load(spark, d, "lineitem")
    every = single_level_rollup(lines, "l_partkey", {"n_lines": F.count(F.lit(1)), "max_quantity": F.max("l_quantity")})
    returned = single_level_rollup(
        lines.filter(F.col("l_returnflag") == "R"), "l_partkey", {"n_returned": F.count(F.lit(1))}
    )
    return assemble(Side(every, unique=True), [Side(returned, unique=True)], "l_partkey")


@Q.add(
    "link_left_null_group",
    f"""
WITH per_order AS (SELECT l_orderkey, avg(l_discount) AS disc, count(*) AS n FROM lineitem GROUP BY l_orderkey),
link AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F')
SELECT o_custkey, count(*) AS n_children, {settle_sql("avg(disc)")} AS discount_mean, max(n) AS most_lines
FROM per_order LEFT JOIN link ON l_orderkey = o_orderkey GROUP BY o_custkey
""",
)
def link_left(spark, d):
    """Children without a link gather under a NULL entity."""
    return two_level_rollup(
        load(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"),
        "o_orderkey",
        {"discount": F.avg("l_discount"), "n": F.count(F.lit(1))},
        load(spark, d, "orders").filter(F.col("o_orderstatus") == "F"),
        "o_custkey",
        {"n_children": F.count(F.lit(1)), "discount_mean": settle(F.avg("discount")), "most_lines": F.max("n")},
        how="left",
    )


@Q.add(
    "attach_inner",
    """
SELECT o_custkey, count(*) AS n_lines, CAST(sum(l_linenumber) AS BIGINT) AS line_sum
FROM lineitem JOIN (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ON l_orderkey = o_orderkey
GROUP BY o_custkey
""",
)
def attach_inner(spark, d):
    lines = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber")
    link = load(spark, d, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    hot = frequent_keys(lines, "o_orderkey", at_least=7)  # orders of many lines, as an example of hot keys
    attached = attach_to_entity(lines, link, "o_orderkey", "o_custkey", hot=hot)
    return single_level_rollup(
        attached, "o_custkey", {"n_lines": F.count(F.lit(1)), "line_sum": F.sum("l_linenumber")}
    )


@Q.add(
    "rollup_left_rollup",
    """
WITH a AS (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_price FROM orders GROUP BY o_custkey),
b AS (SELECT o_custkey, count(*) AS n_urgent, min(o_totalprice) AS min_urgent_price
      FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
SELECT a.o_custkey, n_orders, max_price, n_urgent, min_urgent_price FROM a LEFT JOIN b ON a.o_custkey = b.o_custkey
""",
)
def rollup_left_rollup(spark, d):
    orders = load(spark, d, "orders")
    a = single_level_rollup(orders, "o_custkey", {"n_orders": F.count(F.lit(1)), "max_price": F.max("o_totalprice")})
    b = single_level_rollup(
        orders.filter(F.col("o_orderpriority") == "1-URGENT"),
        "o_custkey",
        {"n_urgent": F.count(F.lit(1)), "min_urgent_price": F.min("o_totalprice")},
    )
    return assemble(Side(a, unique=True), [Side(b, unique=True)], "o_custkey")


@Q.add(
    "key_overlap",
    """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'
""",
)
def overlap(spark, d):
    orders = load(spark, d, "orders")
    return key_overlap(
        orders.filter(F.col("o_orderstatus") == "P"), orders.filter(F.col("o_orderpriority") == "5-LOW"), "o_custkey"
    )
