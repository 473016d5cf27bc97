"""Contracts and checks."""

from pyspark.sql import functions as F

from riskframe.catalog.base import Catalog, event_features, load
from riskframe.operators import contract as K
from riskframe.operators import profile as P
from riskframe.operators.assemble import duplicate_keys

Q = Catalog()

LINE_CONTRACT = K.Contract(
    "lineitem",
    {
        "l_orderkey": K.Field(nullable=False, rules=(K.NON_NEGATIVE,), unique=True),
        "l_quantity": K.Field(nullable=False, rules=(K.NON_NEGATIVE,)),
        "l_discount": K.Field(rules=(K.sentinel_or_non_positive(0.05),)),
        "l_returnflag": K.Field(kind="string", nullable=False, rules=(K.one_of("A", "N"),)),
        "l_comment": K.Field(kind="string"),
    },
)
CUSTOMER_CONTRACT = K.Contract(
    "customer",
    {
        "c_custkey": K.Field(nullable=False, rules=(K.NON_NEGATIVE,), unique=True),
        "c_acctbal": K.Field(nullable=False, rules=(K.NON_NEGATIVE,)),
        "c_name": K.Field(kind="double"),
    },
)

_REPORT = """
SELECT "table", "column", "check", CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (
  SELECT 'lineitem' AS "table", 'l_orderkey' AS "column", 'present' AS "check", 0 AS failures
  UNION ALL SELECT 'lineitem', 'l_quantity', 'present', 0
  UNION ALL SELECT 'lineitem', 'l_discount', 'present', 0
  UNION ALL SELECT 'lineitem', 'l_returnflag', 'present', 0
  UNION ALL SELECT 'lineitem', 'l_comment', 'present', 1
  UNION ALL SELECT 'lineitem', 'l_orderkey', 'type', 0
  UNION ALL SELECT 'lineitem', 'l_orderkey', 'not_null', count_if(l_orderkey IS NULL) FROM lineitem
  UNION ALL SELECT 'lineitem', 'l_orderkey', 'non_negative', count_if(l_orderkey < 0) FROM lineitem
  UNION ALL SELECT 'lineitem', 'l_orderkey', 'unique', count(l_orderkey) - count(DISTINCT l_orderkey) FROM lineitem
  UNION ALL SELECT 'lineitem', 'l_quantity', 'type', 0
  UNION ALL SELECT 'lineitem', 'l_quantity', 'not_null', count_if(l_quantity IS NULL) FROM lineitem
  UNION ALL SELECT 'lineitem', 'l_quantity', 'non_negative', count_if(l_quantity < 0) FROM lineitem
  UNION ALL SELECT 'lineitem', 'l_discount', 'type', 0
  UNION ALL SELECT 'lineitem', 'l_discount', 'sentinel_or_non_positive', count_if(l_discount > 0 AND l_discount <> 0.05e0) FROM lineitem
  UNION ALL SELECT 'lineitem', 'l_returnflag', 'type', 0
  UNION ALL SELECT 'lineitem', 'l_returnflag', 'not_null', count_if(l_returnflag IS NULL) FROM lineitem
  UNION ALL SELECT 'lineitem', 'l_returnflag', 'one_of', count_if(l_returnflag NOT IN ('A', 'N')) FROM lineitem
  UNION ALL SELECT 'customer', 'c_custkey', 'present', 0
  UNION ALL SELECT 'customer', 'c_acctbal', 'present', 0
  UNION ALL SELECT 'customer', 'c_name', 'present', 0
  UNION ALL SELECT 'customer', 'c_custkey', 'type', 0
  UNION ALL SELECT 'customer', 'c_custkey', 'not_null', count_if(c_custkey IS NULL) FROM customer
  UNION ALL SELECT 'customer', 'c_custkey', 'non_negative', count_if(c_custkey < 0) FROM customer
  UNION ALL SELECT 'customer', 'c_custkey', 'unique', count(c_custkey) - count(DISTINCT c_custkey) FROM customer
  UNION ALL SELECT 'customer', 'c_acctbal', 'type', 0
  UNION ALL SELECT 'customer', 'c_acctbal', 'not_null', count_if(c_acctbal IS NULL) FROM customer
  UNION ALL SELECT 'customer', 'c_acctbal', 'non_negative', count_if(c_acctbal < 0) FROM customer
  UNION ALL SELECT 'customer', 'c_name', 'type', count_if(try_cast(c_name AS DOUBLE) IS NULL) FROM customer
)
"""


@Q.add("contract_report", _REPORT)
def contract_report(spark, d):
    tables = {"lineitem": load(spark, d, "lineitem"), "customer": load(spark, d, "customer")}
    return K.run_contracts(tables, {c.name: c for c in (LINE_CONTRACT, CUSTOMER_CONTRACT)})


@Q.add(
    "contract_failure_sample",
    """
SELECT c_custkey, 'c_acctbal' AS "column", 'non_negative' AS "check", CAST(c_acctbal AS VARCHAR) AS value
FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 10
""",
)
def contract_failure_sample(spark, d):
    balance = K.Contract("customer", {"c_acctbal": K.Field(nullable=False, rules=(K.NON_NEGATIVE,))})
    return K.failure_sample(load(spark, d, "customer"), balance, "c_custkey", 10)


@Q.add(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicates(spark, d):
    return duplicate_keys(load(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def damaged_events(spark, d):
    """Event ratios with natural gaps (zero k) and infinite cells (values above 200)."""
    events = event_features(load(spark, d, "events"))
    return events.select(
        "event_id",
        "user_id",
        F.try_divide("value", "k").alias("value_per_k"),
        F.when(F.col("value") > 200, F.lit(float("inf"))).otherwise(F.col("value")).alias("value"),
    )


_MATRIX_SQL = """
f AS (SELECT user_id, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events),
m AS (SELECT CAST(count_if(k = 0) AS BIGINT) AS gaps, CAST(count_if(value > 200) AS BIGINT) AS infinite,
             count(*) - count(DISTINCT user_id) AS repeats FROM f)
"""


@Q.add(
    "matrix_check",
    f"""
WITH {_MATRIX_SQL}
SELECT 'matrix' AS "table", 'absent' AS "column", 'columns_present' AS "check", CAST(1 AS BIGINT) AS failures, false AS passed
UNION ALL SELECT 'matrix', NULL, 'missing_cells', gaps, gaps = 0 FROM m
UNION ALL SELECT 'matrix', NULL, 'infinite_cells', infinite, infinite = 0 FROM m
""",
)
def matrix_check(spark, d):
    return K.matrix_check(damaged_events(spark, d), ["value", "value_per_k", "absent"])


@Q.add(
    "request_check",
    f"""
WITH {_MATRIX_SQL}
SELECT 'request' AS "table", NULL AS "column", 'columns_present' AS "check", CAST(0 AS BIGINT) AS failures, true AS passed
UNION ALL SELECT 'request', NULL, 'missing_cells', gaps, gaps = 0 FROM m
UNION ALL SELECT 'request', NULL, 'infinite_cells', infinite, infinite = 0 FROM m
UNION ALL SELECT 'request', 'user_id', 'unique', repeats, repeats = 0 FROM m
""",
)
def request_check(spark, d):
    return K.request_check(damaged_events(spark, d), ["value", "value_per_k"], "user_id")


EVENT_CONTRACT = K.Contract(
    "events",
    {
        "value": K.Field(nullable=False, rules=(K.Rule("at_most_150", lambda c: c <= 150),)),
        "k": K.Field(nullable=False, rules=(K.Rule("positive", lambda c: c > 0),)),
        "is_click": K.Field(nullable=False, rules=(K.one_of(0, 1),)),
    },
)


@Q.add(
    "quarantine_split",
    """
WITH f AS (SELECT event_id, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events)
SELECT event_id, concat_ws(',', CASE WHEN value > 150 THEN 'value:at_most_150' END, CASE WHEN k <= 0 THEN 'k:positive' END) AS reasons
FROM f
""",
)
def quarantine_split(spark, d):
    valid, rejected = K.quarantine(event_features(load(spark, d, "events")), EVENT_CONTRACT)
    return valid.select("event_id", F.lit("").alias("reasons")).unionByName(
        rejected.select("event_id", F.concat_ws(",", "reasons").alias("reasons"))
    )


@Q.add(
    "layer_contracts",
    """
WITH f AS (SELECT c_custkey AS k, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS t, 0 AS m FROM customer)
SELECT "table", "column", "check", CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (
  SELECT t AS "table", c AS "column", k AS "check",
         CASE WHEN k = 'not_null' AND c = 'entity' THEN (SELECT count_if(f.k IS NULL) FROM f)
              WHEN k = 'unique' THEN (SELECT count(f.k) - count(DISTINCT f.k) FROM f)
              WHEN k = 'one_of' THEN (SELECT count_if(f.t NOT IN (0, 1)) FROM f) ELSE 0 END AS failures
  FROM (VALUES ('feature_store', 'entity', 'present'), ('feature_store', 'entity', 'type'), ('feature_store', 'entity', 'not_null'),
               ('feature_store', 'entity', 'non_negative'), ('feature_store', 'entity', 'unique'),
               ('feature_store', 'target', 'present'), ('feature_store', 'target', 'type'), ('feature_store', 'target', 'not_null'),
               ('feature_store', 'target', 'one_of'),
               ('feature_store', 'missing_count', 'present'), ('feature_store', 'missing_count', 'type'),
               ('feature_store', 'missing_count', 'not_null'), ('feature_store', 'missing_count', 'non_negative'),
               ('train', 'entity', 'present'), ('train', 'entity', 'type'), ('train', 'entity', 'not_null'),
               ('train', 'entity', 'non_negative'), ('train', 'entity', 'unique'),
               ('train', 'target', 'present'), ('train', 'target', 'type'), ('train', 'target', 'not_null'), ('train', 'target', 'one_of')
       ) AS v(t, c, k))
""",
)
def layer_contracts(spark, d):
    """Contracts of the feature layer and of a split, over the customers."""
    features = load(spark, d, "customer").select(
        F.col("c_custkey").alias("entity"), (F.col("c_acctbal") < 0).cast("int").alias("target"), F.lit(0).alias("missing_count")
    )
    K.check_features_present(features, ["entity", "target"])
    store = K.run_contract(features, K.feature_store_contract("target", "entity"))
    return store.unionByName(K.run_contract(features, K.split_contract("target", "entity", "train")))


@Q.add(
    "cardinality",
    """
WITH d AS (SELECT doc.lang, doc.source, doc.n_chars, l.quality, l.toxic FROM documents doc LEFT JOIN labels l USING (doc_id))
SELECT "column", count(DISTINCT v) AS n_distinct, count(DISTINCT v) + max(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS n_distinct_with_missing
FROM (SELECT 'lang' AS "column", lang AS v FROM d UNION ALL SELECT 'source', source FROM d
      UNION ALL SELECT 'n_chars', CAST(n_chars AS VARCHAR) FROM d UNION ALL SELECT 'quality', CAST(quality AS VARCHAR) FROM d
      UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR) FROM d)
GROUP BY "column"
""",
)
def cardinality(spark, d):
    columns = ["lang", "source", "n_chars", "quality", "toxic"]
    joined = load(spark, d, "documents").drop("text").join(load(spark, d, "labels"), "doc_id", "left")
    return P.cardinality(joined, columns)
