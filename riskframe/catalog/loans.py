"""The loan feature plan over tables derived from customers, orders and lines.

The benchmark has no loan data, so the seven tables are projections of it:
customers apply, orders are their earlier contracts, lines are the monthly and
instalment history. The projections are written once as expressions that Spark
and SQL both read; the features themselves are stated separately for each.
"""

from pyspark.sql import types as T

from riskframe.catalog.base import Catalog, load, settle, settle_sql
from riskframe.operators import contract as K
from riskframe.operators.frame import string_columns
from riskframe.plans import flat_table as FT
from riskframe.plans import loan_features as L
from riskframe.session import shuffle_parallelism

Q = Catalog()

SPARK_DAYS = "unix_date(cast({0} as date))"
SQL_DAYS = "cast(datediff('day', date '1970-01-01', cast({0} as date)) as integer)"


def _holes(expression: str, key: str, every: int) -> str:
    return f"case when {key} % {every} = 0 then null else {expression} end"


def _flag(key: str, every: int) -> str:
    return f"case when {key} % {every} = 0 then 1 else 0 end"


def _level(column: str, key: str) -> str:
    """One category per key, one key in n+1 without a category."""
    levels = L.CATEGORY_LEVELS[column]
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(levels))
    return f"case {key} % {len(levels) + 1} {cases} end"


APPLICATION = {
    "SK_ID_CURR": "c_custkey",
    "TARGET": "case when c_acctbal < 0 then 1 else 0 end",
    "EXT_SOURCE_1": _holes("(c_custkey % 101) / 101e0", "c_custkey", 3),
    "EXT_SOURCE_2": _holes("(c_custkey % 89) / 89e0", "c_custkey", 17),
    "EXT_SOURCE_3": _holes("(c_custkey % 83) / 83e0", "c_custkey", 7),
    "AMT_ANNUITY": _holes("1000 + abs(c_acctbal) / 10", "c_custkey", 29),
    "AMT_CREDIT": "5000 + abs(c_acctbal) * 3",
    "AMT_GOODS_PRICE": _holes("4500 + abs(c_acctbal) * 2", "c_custkey", 31),
    "AMT_INCOME_TOTAL": "20000 + (c_custkey % 1000) * 37e0",
    "DAYS_BIRTH": "-7000 - (c_custkey * 13) % 18000",
    "DAYS_EMPLOYED": "case when c_custkey % 6 = 0 then 365243 else -((c_custkey * 7) % 9000) end",
    "DAYS_REGISTRATION": "-1e0 * ((c_custkey * 5) % 12000)",
    "DAYS_ID_PUBLISH": "-((c_custkey * 11) % 6000)",
    "DAYS_LAST_PHONE_CHANGE": _holes("-1e0 * (c_custkey % 3000)", "c_custkey", 53),
    "CNT_CHILDREN": "c_custkey % 4",
    "CNT_FAM_MEMBERS": _holes("(c_custkey % 5) * 1e0", "c_custkey", 41),
    "REGION_RATING_CLIENT": "c_nationkey % 3 + 1",
    "REGION_RATING_CLIENT_W_CITY": "c_nationkey % 2 + 1",
    "REGION_POPULATION_RELATIVE": "(c_nationkey % 10) / 100e0",
    "HOUR_APPR_PROCESS_START": "c_custkey % 24",
    **{c: _flag("c_custkey", 5 + i) for i, c in enumerate(L.ADDRESS_FLAGS)},
    **{c: _holes(f"(c_custkey % {4 + i}) * 1e0", "c_custkey", 19) for i, c in enumerate(L.SOCIAL_CIRCLE)},
    **{c: _holes(f"(c_custkey % {3 + i}) * 1e0", "c_custkey", 8) for i, c in enumerate(L.ENQUIRIES)},
    **{c: _flag("c_custkey", 2 + i) for i, c in enumerate(L.CONTACT_FLAGS)},
    **{c: _flag("c_custkey", 3 + i) for i, c in enumerate(L.DOCUMENT_FLAGS)},
    **{c: _level(c, "c_custkey") for c in L.CATEGORY_LEVELS},
    "OWN_CAR_AGE": "case when c_custkey % 3 = 1 then null else (c_custkey % 20) * 1e0 end",
}
BUREAU = {
    "SK_ID_BUREAU": "o_orderkey",
    "SK_ID_CURR": "o_custkey",
    "CREDIT_ACTIVE": "case o_orderstatus when 'O' then 'Active' when 'F' then 'Closed' else 'Sold' end",
    "CREDIT_DAY_OVERDUE": "o_orderkey % 12",
    "DAYS_CREDIT": "{o_orderdate} - 12000",
    "DAYS_CREDIT_UPDATE": "{o_orderdate} - 11990",
    "AMT_CREDIT_SUM": "case when o_orderkey % 37 = 0 then 0e0 else o_totalprice end",
    "AMT_CREDIT_SUM_DEBT": _holes("o_totalprice * 25e-2", "o_orderkey", 4),
    "AMT_CREDIT_SUM_LIMIT": _holes("o_totalprice * 5e-1", "o_orderkey", 3),
    "AMT_CREDIT_SUM_OVERDUE": "(o_orderkey % 9) * 1e0",
    "AMT_CREDIT_MAX_OVERDUE": _holes("(o_orderkey % 100) * 1e0", "o_orderkey", 2),
    "CNT_CREDIT_PROLONG": "o_orderkey % 3",
}
BUREAU_BALANCE = {
    "SK_ID_BUREAU": "l_orderkey",
    "MONTHS_BALANCE": "-(l_partkey % 60)",
    "STATUS": "case l_suppkey % 8 when 6 then 'C' when 7 then 'X' else cast(l_suppkey % 8 as varchar(1)) end",
}
PREVIOUS = {
    "SK_ID_PREV": "o_orderkey",
    "SK_ID_CURR": "o_custkey",
    "NAME_CONTRACT_STATUS": "case o_orderkey % 5 when 0 then 'Refused' when 1 then 'Canceled' when 2 then 'Unused offer' else 'Approved' end",
    "AMT_APPLICATION": "o_totalprice * 9e-1",
    "AMT_CREDIT": "case when o_orderkey % 23 = 0 then 0e0 else o_totalprice end",
    "AMT_ANNUITY": "o_totalprice / 12",
    "AMT_DOWN_PAYMENT": _holes("o_totalprice * 1e-1", "o_orderkey", 2),
    "CNT_PAYMENT": _holes("(o_orderkey % 48) * 1e0", "o_orderkey", 11),
    "DAYS_DECISION": "{o_orderdate} - 12000",
}
INSTALLMENTS = {
    "SK_ID_PREV": "l_orderkey",
    "SK_ID_CURR": "l_suppkey",
    "NUM_INSTALMENT_NUMBER": "l_linenumber",
    "NUM_INSTALMENT_VERSION": "l_linenumber % 3",
    "AMT_INSTALMENT": "case when l_partkey % 43 = 0 then 0e0 else l_extendedprice end",
    "AMT_PAYMENT": _holes("l_extendedprice * (1 - l_discount)", "l_partkey", 13),
    "DAYS_INSTALMENT": "{l_shipdate} - 12000",
    "DAYS_ENTRY_PAYMENT": _holes("{l_shipdate} - 12000 + l_linenumber - 3", "l_partkey", 13),
}
CREDIT_CARD = {
    "SK_ID_PREV": "l_orderkey",
    "SK_ID_CURR": "l_suppkey",
    "MONTHS_BALANCE": "-l_linenumber",
    "AMT_BALANCE": "l_extendedprice * l_tax",
    "AMT_CREDIT_LIMIT_ACTUAL": "l_quantity * 1000 + 100",
    "AMT_PAYMENT_TOTAL_CURRENT": "l_extendedprice * l_discount",
    "AMT_INST_MIN_REGULARITY": _holes("l_extendedprice * 4e-2", "l_partkey", 10),
    "AMT_DRAWINGS_ATM_CURRENT": _holes("l_quantity * 10", "l_partkey", 4),
    "SK_DPD": "l_suppkey % 4",
    "SK_DPD_DEF": "l_suppkey % 3",
}
POS_CASH = {
    "SK_ID_PREV": "l_orderkey",
    "SK_ID_CURR": "l_suppkey",
    "MONTHS_BALANCE": "-l_linenumber - l_partkey % 7",
    "CNT_INSTALMENT": "l_linenumber * 1e0",
    "CNT_INSTALMENT_FUTURE": "7e0 - l_linenumber",
    "NAME_CONTRACT_STATUS": "case l_returnflag when 'N' then 'Active' when 'A' then 'Completed' else 'Signed' end",
    "SK_DPD": "l_partkey % 5",
    "SK_DPD_DEF": "l_partkey % 2",
}
# table name -> (source table, columns)
DERIVED = {
    "application": ("customer", APPLICATION),
    "bureau": ("orders", BUREAU),
    "bureau_balance": ("lineitem", BUREAU_BALANCE),
    "previous_application": ("orders", PREVIOUS),
    "installments": ("lineitem", INSTALLMENTS),
    "credit_card": ("lineitem", CREDIT_CARD),
    "pos_cash": ("lineitem", POS_CASH),
}
DATES = ("o_orderdate", "l_shipdate")


def loan_tables(spark, d) -> L.LoanTables:
    """A customer is a few bytes in its file and more than a hundred columns here, so a single split of the file would hold
    most of the work: customers are spread by key before they are widened."""
    days = {c: SPARK_DAYS.format(c) for c in DATES}

    def rows(source):
        table = load(spark, d, source)
        return table.repartition(shuffle_parallelism(spark), "c_custkey") if source == "customer" else table

    return L.LoanTables(
        **{
            name: rows(source).selectExpr(*[f"{e.format(**days)} as {c}" for c, e in columns.items()])
            for name, (source, columns) in DERIVED.items()
        }
    )


def _derived_sql(name: str) -> str:
    source, columns = DERIVED[name]
    days = {c: SQL_DAYS.format(c) for c in DATES}
    return f"{name} AS (SELECT " + ", ".join(f"{e.format(**days)} AS {c}" for c, e in columns.items()) + f" FROM {source})"


def _sum_of(columns, what="coalesce({0}, 0)") -> str:
    return " + ".join(what.format(c) for c in columns)


_GAPS = "CASE WHEN {0} IS NULL THEN 1 ELSE 0 END"
_RATIO_SQL = ", ".join(f"{a} / ({b} + 1e-6) AS {n}" for n, (a, b) in L.RATIOS.items())

FEATURES_SQL = f"""
{", ".join(_derived_sql(t) for t in DERIVED)},
app AS (
  SELECT *, {_sum_of(APPLICATION, _GAPS)} AS TOT_MISSING_COUNT, nullif(DAYS_EMPLOYED, 365243) AS employed FROM application
),
app_f AS (
  SELECT {", ".join(L.PASSED_THROUGH)}, -DAYS_BIRTH / 365.000001e0 AS AGE_YEARS,
         CASE WHEN DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END AS DAYS_EMPLOYED_ANOMALY, -employed / 365.000001e0 AS EMPLOYED_YEARS,
         -employed / (-DAYS_BIRTH + 1e-6) AS EMPLOYMENT_YEARS_TO_AGE, {_RATIO_SQL},
         {", ".join(_GAPS.format(c) + f" AS {c}_IS_MISSING" for c in L.INDICATED)},
         {_sum_of(L.DOCUMENT_FLAGS)} AS DOC_COUNT, {_sum_of(L.CONTACT_FLAGS)} AS CONTACT_COUNT, {_sum_of(L.ADDRESS_FLAGS)} AS ADDR_MISMATCH_SUM
  FROM app
),
bu AS (
  SELECT SK_ID_CURR, count_if(CREDIT_ACTIVE = 'Active') AS BUREAU_N_ACTIVE, count_if(CREDIT_ACTIVE = 'Closed') AS BUREAU_N_CLOSED,
         max(DAYS_CREDIT) AS BUREAU_LAST_CREDIT_DAYS, max(DAYS_CREDIT_UPDATE) AS BUREAU_LAST_UPDATE_DAYS,
         sum(AMT_CREDIT_SUM_DEBT) AS BUREAU_TOTAL_DEBT, sum(AMT_CREDIT_SUM) AS BUREAU_TOTAL_CREDIT,
         sum(AMT_CREDIT_SUM_LIMIT) AS BUREAU_LIMIT_SUM, avg(AMT_CREDIT_SUM_DEBT / (AMT_CREDIT_SUM + 1e-6)) AS BUREAU_UTIL_MEAN,
         sum(AMT_CREDIT_SUM_OVERDUE) AS BUREAU_OVERDUE_SUM, max(AMT_CREDIT_MAX_OVERDUE) AS BUREAU_MAX_OVERDUE,
         sum(CNT_CREDIT_PROLONG) AS BUREAU_PROLONG_SUM
  FROM bureau GROUP BY SK_ID_CURR
),
bb_row AS (SELECT *, CASE WHEN STATUS IN ('C', 'X') THEN 0 ELSE CAST(STATUS AS INTEGER) END AS s FROM bureau_balance),
bb_one AS (
  SELECT SK_ID_BUREAU, avg(CASE WHEN s > 0 THEN 1 ELSE 0 END) AS share, max(s) AS worst,
         -max(MONTHS_BALANCE) FILTER (WHERE s > 0) AS since FROM bb_row GROUP BY SK_ID_BUREAU
),
bb AS (
  SELECT SK_ID_CURR, avg(share) AS BB_DELINQ_SHARE_MEAN, max(worst) AS BB_WORST_STATUS_MAX, min(since) AS BB_MONTHS_SINCE_LAST_DELINQ_MIN
  FROM bb_one LEFT JOIN bureau USING (SK_ID_BUREAU) GROUP BY SK_ID_CURR
),
pr AS (
  SELECT SK_ID_CURR, count(DISTINCT SK_ID_PREV) AS PREV_TOTAL, count_if(NAME_CONTRACT_STATUS = 'Approved') AS PREV_APPROVED,
         count_if(NAME_CONTRACT_STATUS = 'Refused') AS PREV_REFUSED, count_if(NAME_CONTRACT_STATUS = 'Canceled') AS PREV_CANCELLED,
         count_if(NAME_CONTRACT_STATUS = 'Unused offer') AS PREV_UNUSED,
         avg(AMT_APPLICATION / nullif(AMT_CREDIT, 0)) AS PREV_APP_CREDIT_RATIO_MEAN,
         avg(AMT_DOWN_PAYMENT / nullif(AMT_CREDIT, 0)) AS PREV_DOWNPAYMENT_RATE_MEAN, avg(CNT_PAYMENT) AS PREV_CNT_PAYMENT_MEAN,
         max(DAYS_DECISION) AS PREV_LAST_DECISION_DAYS, min(DAYS_DECISION) AS PREV_EARLIEST_DECISION_DAYS,
         count_if(NAME_CONTRACT_STATUS = 'Approved') / count(DISTINCT SK_ID_PREV) AS PREV_APPROVAL_RATE,
         count_if(NAME_CONTRACT_STATUS = 'Refused') / count(DISTINCT SK_ID_PREV) AS PREV_REFUSED_RATE
  FROM previous_application GROUP BY SK_ID_CURR
),
link AS (SELECT SK_ID_PREV, SK_ID_CURR FROM previous_application),
in_one AS (
  SELECT SK_ID_PREV, avg(q) AS a, stddev_samp(q) AS b, avg(g) AS c, max(g) AS e, avg(CASE WHEN g > 0 THEN 1 ELSE 0 END) AS f
  FROM (SELECT SK_ID_PREV, AMT_PAYMENT / (AMT_INSTALMENT + 1e-6) AS q, DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT AS g FROM installments)
  GROUP BY SK_ID_PREV
),
ins AS (
  SELECT SK_ID_CURR, avg(a) AS INSTAL_PAYMENT_RATIO_MEAN, avg(b) AS INSTAL_PAYMENT_RATIO_STD, avg(c) AS INSTAL_LATE_MEAN,
         max(e) AS INSTAL_LATE_MAX, avg(f) AS INSTAL_LATE_SHARE, avg(f * 30) AS INSTAL_SEVERE_LATE_SHARE
  FROM in_one JOIN link USING (SK_ID_PREV) GROUP BY SK_ID_CURR
),
cc_one AS (
  SELECT SK_ID_PREV, avg(u) AS a, max(u) AS b, avg(m) AS c, avg(CASE WHEN m >= 1 THEN 1 ELSE 0 END) AS e,
         avg(CASE WHEN SK_DPD > 0 OR SK_DPD_DEF > 0 THEN 1 ELSE 0 END) AS f, max(SK_DPD) AS g, avg(w) AS h
  FROM (SELECT *, AMT_BALANCE / (AMT_CREDIT_LIMIT_ACTUAL + 1e-6) AS u, AMT_PAYMENT_TOTAL_CURRENT / (AMT_INST_MIN_REGULARITY + 1e-6) AS m,
               AMT_DRAWINGS_ATM_CURRENT / (AMT_CREDIT_LIMIT_ACTUAL + 1e-6) AS w FROM credit_card)
  GROUP BY SK_ID_PREV
),
cc AS (
  SELECT SK_ID_CURR, avg(a) AS CC_UTIL_MEAN, max(b) AS CC_UTIL_MAX, avg(c) AS CC_MINPAY_COVERAGE_MEAN, avg(e) AS CC_MINPAY_MET_SHARE,
         avg(f) AS CC_DPD_ANY_SHARE, max(g) AS CC_DPD_MAX, avg(h) AS CC_CASH_RATIO_MEAN
  FROM cc_one JOIN link USING (SK_ID_PREV) GROUP BY SK_ID_CURR
),
po_one AS (
  SELECT SK_ID_PREV, avg(CASE WHEN SK_DPD > 0 OR SK_DPD_DEF > 0 THEN 1 ELSE 0 END) AS a, max(SK_DPD) AS b,
         -max(MONTHS_BALANCE) FILTER (WHERE NAME_CONTRACT_STATUS = 'Active') AS c
  FROM pos_cash GROUP BY SK_ID_PREV
),
po AS (
  SELECT SK_ID_CURR, avg(a) AS POS_DPD_ANY_SHARE, max(b) AS POS_DPD_MAX, max(c) AS POS_MONTHS_SINCE_LAST_ACTIVE
  FROM po_one JOIN link USING (SK_ID_PREV) GROUP BY SK_ID_CURR
),
feats AS (
  SELECT * FROM app_f LEFT JOIN bu USING (SK_ID_CURR) LEFT JOIN bb USING (SK_ID_CURR) LEFT JOIN pr USING (SK_ID_CURR)
    LEFT JOIN ins USING (SK_ID_CURR) LEFT JOIN cc USING (SK_ID_CURR) LEFT JOIN po USING (SK_ID_CURR)
)
"""

DERIVED_FEATURES = (
    ["AGE_YEARS", "DAYS_EMPLOYED_ANOMALY", "EMPLOYED_YEARS", "EMPLOYMENT_YEARS_TO_AGE"]
    + list(L.RATIOS)
    + [f"{c}_IS_MISSING" for c in L.INDICATED]
    + ["DOC_COUNT", "CONTACT_COUNT", "ADDR_MISMATCH_SUM"]
)
NUMBERS = [c for c in L.PASSED_THROUGH if c not in L.CATEGORY_LEVELS] + DERIVED_FEATURES + L.HISTORY_FEATURES


def _comparable(df):
    """Every number as a rounded double, so both engines show the same value. Whole numbers are what ``settle`` makes of them."""
    texts = set(string_columns(df))
    whole = {f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)}
    return df.select(
        *[L.col(c) if c in texts else (L.col(c).cast("double") if c in whole else settle(c)).alias(c) for c in df.columns]
    )


def _numbers_sql(pairs) -> str:
    return ", ".join(f'{settle_sql(e)} AS "{n}"' for n, e in pairs)


@Q.add(
    "loan_features",
    f"WITH {FEATURES_SQL} SELECT {_numbers_sql((c, c) for c in NUMBERS)}, {', '.join(L.CATEGORY_LEVELS)} FROM feats",
)
def loan_features(spark, d):
    """All 132 features before encoding, one row per applicant."""
    return _comparable(L.joined_features(loan_tables(spark, d)))


def _encoded_sql() -> list[tuple[str, str]]:
    pairs = []
    for c in NUMBERS:
        name = "DAYS_EMPLOYED_ANOM" if c == "DAYS_EMPLOYED_ANOMALY" else c
        pairs.append((name, f"feats.{c}" if c in (L.ENTITY, L.TARGET) else f"coalesce(feats.{c}, m.{c}, 0)"))
    pairs.append(("DAYS_EMPLOYED_REPLACED", "coalesce(nullif(feats.DAYS_EMPLOYED, 365243), 0)"))
    pairs.append(("missing_count", "feats.TOT_MISSING_COUNT"))
    for c, levels in L.CATEGORY_LEVELS.items():
        pairs += [(f"{c}_{v}", f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END") for v in levels]
    return pairs


_MEDIANS_SQL = ", ".join(f"median({c}) AS {c}" for c in NUMBERS if c not in (L.ENTITY, L.TARGET))


@Q.add(
    "loan_model_table",
    f"WITH {FEATURES_SQL}, m AS (SELECT {_MEDIANS_SQL} FROM feats) SELECT {_numbers_sql(_encoded_sql())} FROM feats, m",
)
def loan_model_table(spark, d):
    """The model-ready table: encoded, imputed, renamed, zero-filled; it holds every model column."""
    table = L.feature_table(loan_tables(spark, d))
    K.check_features_present(table, L.model_columns())
    return _comparable(table)


_CONTRACT_ROWS = [
    (name, column, check)
    for name, contract in L.RAW_CONTRACTS.items()
    for column, spec in contract.fields.items()
    for check in ["present", "type"]
    + ([] if spec.nullable else ["not_null"])
    + [r.name for r in spec.rules]
    + (["unique"] if spec.unique else [])
]
_CHECK_SQL = {
    "not_null": "count_if({0} IS NULL)",
    "non_negative": "count_if({0} < 0)",
    "non_positive": "count_if({0} > 0)",
    "one_of": "count_if({0} NOT IN (0, 1))",
    "sentinel_or_non_positive": "count_if({0} > 0 AND {0} <> 365243)",
    "unique": "count({0}) - count(DISTINCT {0})",
}


@Q.add(
    "loan_contracts",
    f"WITH {', '.join(_derived_sql(t) for t in DERIVED)} "
    "SELECT \"table\", \"column\", \"check\", CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", '{k}' AS \"check\", {_CHECK_SQL.get(k, '0').format(c)} AS failures"
        + (f" FROM {t}" if k in _CHECK_SQL else "")
        for t, c, k in _CONTRACT_ROWS
    )
    + ")",
)
def loan_contracts(spark, d):
    return K.run_contracts(vars(loan_tables(spark, d)), L.RAW_CONTRACTS)


_FLAT_BASE = f"""
{_derived_sql("application")},
a AS (
  SELECT *, nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED_REPLACED, -DAYS_BIRTH / 365.000001e0 AS AGE_YEARS,
         CASE WHEN DAYS_EMPLOYED = 365243 THEN 1 ELSE 0 END AS DAYS_EMPLOYED_ANOM,
         -nullif(DAYS_EMPLOYED, 365243) / 365.000001e0 AS EMPLOYED_YEARS,
         -nullif(DAYS_EMPLOYED, 365243) / (-DAYS_BIRTH + 1e-6) AS EMPLOYMENT_YEARS_TO_AGE,
         {", ".join(_GAPS.format(c) + f" AS {c}_IS_MISSING" for c in L.INDICATED)}
  FROM application
),
b AS (
  SELECT *, {_sum_of([*APPLICATION, "DAYS_EMPLOYED_REPLACED", "AGE_YEARS", "EMPLOYED_YEARS", "EMPLOYMENT_YEARS_TO_AGE"], _GAPS)} AS missing_count,
         {_RATIO_SQL}, {_sum_of(L.DOCUMENT_FLAGS)} AS DOC_COUNT, {_sum_of(L.CONTACT_FLAGS)} AS CONTACT_COUNT,
         {_sum_of(L.ADDRESS_FLAGS)} AS ADDR_MISMATCH_SUM
  FROM a
)
"""
_FLAT_NUMBERS = (
    [c for c in APPLICATION if c not in L.CATEGORY_LEVELS]
    + ["DAYS_EMPLOYED_REPLACED", "AGE_YEARS", "DAYS_EMPLOYED_ANOM", "EMPLOYED_YEARS", "EMPLOYMENT_YEARS_TO_AGE"]
    + [f"{c}_IS_MISSING" for c in L.INDICATED]
    + ["missing_count", *L.RATIOS, "DOC_COUNT", "CONTACT_COUNT", "ADDR_MISMATCH_SUM"]
)
_FLAT_PAIRS = (
    [(c, f"coalesce({c}, 0)") for c in _FLAT_NUMBERS]
    + [("TOT_MISSING_COUNT", "missing_count")]
    + [(f"{c}_{v}", f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END") for c, levels in L.CATEGORY_LEVELS.items() for v in levels]
)


@Q.add("flat_table", f"WITH {_FLAT_BASE} SELECT {_numbers_sql(_FLAT_PAIRS)} FROM b")
def flat_table(spark, d):
    """The application table alone, prepared without its histories."""
    return _comparable(FT.prepare_flat_table(loan_tables(spark, d).application, L.TARGET))
