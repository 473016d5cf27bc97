"""Projections, scalar expressions, filters and column surgery."""

from pyspark.sql import functions as F

from riskframe.catalog.base import Catalog, day_number, load, r6
from riskframe.functions import expr as X
from riskframe.operators import frame as FR
from riskframe.operators.sampling import features_target

Q = Catalog()


def labelled_documents(spark, d):
    """Documents with their labels where there are any (most have none)."""
    docs = load(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(load(spark, d, "labels"), "doc_id", "left")


LABELLED_SQL = """
ld AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


@Q.add(
    "project_require",
    "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part",
)
def project_require(spark, d):
    part = load(spark, d, "part")
    return FR.require_columns(part, ["p_partkey", "p_brand", "p_size", "p_retailprice"], "part")


@Q.add(
    "eps_and_plain_ratio",
    """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       round(l_tax / (l_discount + 1e-6), 6) AS eps_ratio,
       round(l_tax / nullif(l_discount, 0), 6) AS plain_ratio,
       round(CASE WHEN l_discount = 0 THEN -1e0 ELSE l_tax / nullif(l_discount, 0) END, 6) AS ratio_or_minus_one
FROM lineitem
""",
)
def ratios(spark, d):
    return load(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        r6(X.eps_ratio("l_tax", "l_discount")).alias("eps_ratio"),
        r6(X.plain_ratio("l_tax", "l_discount")).alias("plain_ratio"),
        r6(X.plain_ratio("l_tax", "l_discount", on_zero=-1)).alias("ratio_or_minus_one"),
    )


@Q.add(
    "sentinel_and_years",
    """
WITH x AS (
  SELECT l_orderkey, l_linenumber, l_discount,
         CAST(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS INTEGER) - 20000 AS ship,
         -20000 - l_orderkey AS life
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 1 ELSE 0 END AS is_sentinel,
       CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS discount,
       round(-ship / (365 + 1e-6), 6) AS years,
       round(-(CASE WHEN l_discount = 0 THEN NULL ELSE ship END) / (-life + 1e-6), 6) AS tenure,
       CAST(ship - life AS BIGINT) AS gap_days
FROM x
""",
)
def sentinel_and_years(spark, d):
    ship = day_number("l_shipdate") - 20000
    life = F.lit(-20000) - F.col("l_orderkey")
    return load(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        X.sentinel_flag("l_discount", 0.0).alias("is_sentinel"),
        X.sentinel_to_null("l_discount", 0.0).alias("discount"),
        r6(X.days_to_years(ship)).alias("years"),
        r6(X.tenure_share(F.when(F.col("l_discount") != 0, ship), life)).alias("tenure"),
        X.day_gap(ship, life).cast("long").alias("gap_days"),
    )


@Q.add(
    "missing_indicators",
    f"""
WITH {LABELLED_SQL}
SELECT doc_id, CASE WHEN quality IS NULL THEN 1 ELSE 0 END AS quality_is_missing,
       CASE WHEN toxic IS NULL THEN 1 ELSE 0 END AS toxic_is_missing,
       (CASE WHEN lang IS NULL THEN 1 ELSE 0 END) + (CASE WHEN source IS NULL THEN 1 ELSE 0 END)
       + (CASE WHEN n_chars IS NULL THEN 1 ELSE 0 END) + (CASE WHEN quality IS NULL THEN 1 ELSE 0 END)
       + (CASE WHEN toxic IS NULL THEN 1 ELSE 0 END) + (CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) AS missing_count
FROM ld
""",
)
def missing_indicators(spark, d):
    docs = labelled_documents(spark, d)
    return docs.select(
        "doc_id",
        X.missing_indicator("quality").alias("quality_is_missing"),
        X.missing_indicator("toxic").alias("toxic_is_missing"),
        FR.row_missing_count(docs).alias("missing_count"),
    )


@Q.add(
    "flag_sums",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       (CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)
       + coalesce(CASE WHEN l_linestatus = 'O' THEN 1 WHEN l_linestatus = 'F' THEN NULL END, 0)
       + (CASE WHEN l_discount > 0.05e0 OR l_tax > 0.05e0 THEN 1 ELSE 0 END) AS flags
FROM lineitem
""",
)
def flag_sums(spark, d):
    returned = X.condition_flag(F.col("l_returnflag") == "R")
    still_open = F.when(F.col("l_linestatus") == "O", 1)
    pricey = X.condition_flag((F.col("l_discount") > 0.05) | (F.col("l_tax") > 0.05))
    return load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.flag_sum([returned, still_open, pricey]).alias("flags")
    )


@Q.add(
    "sparse_column_drop",
    f"WITH {LABELLED_SQL} SELECT doc_id, lang AS language, n_chars FROM ld",
)
def sparse_column_drop(spark, d):
    """The label columns are mostly empty and go; the rest is renamed or dropped by name."""
    kept = FR.drop_sparse_columns(labelled_documents(spark, d), 0.5)
    kept = FR.drop_columns(kept, ["source", "doc_id", "no_such_column"], protect=["doc_id"])
    return FR.rename_column(kept, "lang", "language")


@Q.add(
    "zero_fill_cast",
    f"""
WITH {LABELLED_SQL}
SELECT doc_id, CAST(coalesce(quality, 0) AS DOUBLE) AS quality, CAST(coalesce(toxic, 0) AS DOUBLE) AS toxic,
       CAST(n_chars AS DOUBLE) AS n_chars FROM ld
""",
)
def zero_fill_cast(spark, d):
    filled = FR.fill_zero(labelled_documents(spark, d))
    return FR.to_double_matrix(filled, ["quality", "toxic", "n_chars"], keep=["doc_id"])


@Q.add(
    "filter_predicates",
    """
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events
WHERE event_type IN ('click', 'view') AND value >= 0 AND (value <= 40 OR value = 99.5)
  AND try_cast(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL
""",
)
def filter_predicates(spark, d):
    k = FR.numeric_values(F.get_json_object("props", "$.k"))
    return (
        load(spark, d, "events")
        .filter(F.col("event_type").isin("click", "view"))
        .filter((F.col("value") >= 0) & ((F.col("value") <= 40) | (F.col("value") == 99.5)))
        .select("event_id", "user_id", k.alias("k"))
        .filter(F.col("k").isNotNull())
    )


@Q.add(
    "class_filter",
    "SELECT doc_id, quality FROM labels WHERE toxic = 1",
)
def class_filter(spark, d):
    toxic = load(spark, d, "labels").filter(F.col("toxic") == 1)
    return features_target(toxic, "toxic")[0]


@Q.add(
    "row_numbers",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders",
)
def row_numbers(spark, d):
    return FR.with_row_id(load(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@Q.add(
    "latest_per_key",
    """
SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type, max(ts) AS ts
FROM events GROUP BY user_id
""",
)
def latest_per_key(spark, d):
    return FR.latest_per_key(load(spark, d, "events"), ["user_id"], "ts", ["event_id", "event_type", "ts"])


@Q.add(
    "top_k",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_k(spark, d):
    orders = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return FR.top_k(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)
