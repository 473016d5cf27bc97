"""Feature table of the seven-table loan schema.

Six history tables are rolled up to one row per applicant and joined to the
application table. The result is one lazy plan: each history table is scanned
once with the columns it needs, all three contract histories reach the applicant
through the same exchanged link table, and the applicant joins share one key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions import expr as X
from riskframe.functions.expr import col
from riskframe.operators import contract as K
from riskframe.operators.assemble import Side, assemble
from riskframe.operators.encode import (
    MAX_LEVELS,
    columns_with_gaps,
    fit_medians,
    fit_vocabulary,
    impute_median,
    one_hot,
    read_vocabulary,
)
from riskframe.operators.frame import drop_columns, fill_zero, numeric_columns, row_missing_count, string_columns
from riskframe.operators.rollup import HOT_FROM, frequent_keys, ratio_of, single_level_rollup, two_level_rollup
from riskframe.operators.storage import stored
from riskframe.session import compiled_methods
from riskframe.sources.tables import nan_to_null

# Column names of the schema and of the feature table.
ENTITY, TARGET = "SK_ID_CURR", "TARGET"
BUREAU_KEY, CONTRACT_KEY = "SK_ID_BUREAU", "SK_ID_PREV"

DOCUMENT_FLAGS = [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]
CONTACT_FLAGS = ["FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE", "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL"]
ADDRESS_FLAGS = [
    "REG_REGION_NOT_LIVE_REGION", "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION",
    "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY", "LIVE_CITY_NOT_WORK_CITY",
]
EXTERNAL_SCORES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
AMOUNTS = ["AMT_ANNUITY", "AMT_CREDIT", "AMT_GOODS_PRICE", "AMT_INCOME_TOTAL"]
DAY_OFFSETS = ["DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "DAYS_LAST_PHONE_CHANGE"]
FAMILY_COUNTS = ["CNT_CHILDREN", "CNT_FAM_MEMBERS"]
REGION = ["REGION_RATING_CLIENT", "REGION_RATING_CLIENT_W_CITY", "REGION_POPULATION_RELATIVE"]
SOCIAL_CIRCLE = [f"{kind}_{days}_CNT_SOCIAL_CIRCLE" for kind in ("OBS", "DEF") for days in (30, 60)]
ENQUIRIES = [f"AMT_REQ_CREDIT_BUREAU_{span}" for span in ("HOUR", "DAY", "WEEK", "MON", "QRT", "YEAR")]
CATEGORY_LEVELS = {
    "NAME_CONTRACT_TYPE": ["Cash loans", "Revolving loans"],
    "CODE_GENDER": ["F", "M", "XNA"],
    "FLAG_OWN_CAR": ["N", "Y"],
    "FLAG_OWN_REALTY": ["N", "Y"],
    "NAME_INCOME_TYPE": [
        "Businessman", "Commercial associate", "Maternity leave", "Pensioner", "State servant", "Student", "Unemployed", "Working",
    ],
    "NAME_EDUCATION_TYPE": [
        "Academic degree", "Higher education", "Incomplete higher", "Lower secondary", "Secondary / secondary special",
    ],
    "NAME_FAMILY_STATUS": ["Civil marriage", "Married", "Separated", "Single / not married", "Unknown", "Widow"],
    "NAME_HOUSING_TYPE": [
        "Co-op apartment", "House / apartment", "Municipal apartment", "Office apartment", "Rented apartment", "With parents",
    ],
    "WEEKDAY_APPR_PROCESS_START": ["FRIDAY", "MONDAY", "SATURDAY", "SUNDAY", "THURSDAY", "TUESDAY", "WEDNESDAY"],
}
RATIOS = {
    "PAYMENT_RATE": ("AMT_ANNUITY", "AMT_CREDIT"),
    "CREDIT_TO_INCOME": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    "ANNUITY_TO_INCOME": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    "GOODS_TO_CREDIT": ("AMT_GOODS_PRICE", "AMT_CREDIT"),
    "INCOME_PER_PERSON": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
    "CHILDREN_RATIO": ("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
}
SEVERE_LATE_WEIGHT = 30
DEFAULT_DROPPED = (ENTITY,)

PASSED_THROUGH = (
    [ENTITY, TARGET]
    + EXTERNAL_SCORES
    + AMOUNTS
    + DAY_OFFSETS
    + FAMILY_COUNTS
    + REGION
    + ["HOUR_APPR_PROCESS_START"]
    + ADDRESS_FLAGS
    + SOCIAL_CIRCLE
    + ENQUIRIES
    + CONTACT_FLAGS
    + DOCUMENT_FLAGS
    + list(CATEGORY_LEVELS)
    + ["TOT_MISSING_COUNT"]
)
INDICATED = EXTERNAL_SCORES + ["OWN_CAR_AGE"]


@dataclass(frozen=True)
class LoanTables:
    application: DataFrame
    bureau: DataFrame
    bureau_balance: DataFrame
    previous_application: DataFrame
    installments: DataFrame
    credit_card: DataFrame
    pos_cash: DataFrame


# --- one function per table ---------------------------------------------------------


def application_features(application: DataFrame, eps: float = X.RATIO_EPSILON) -> DataFrame:
    """Row-wise features; nothing here needs a shuffle."""
    counted = application.withColumn("TOT_MISSING_COUNT", row_missing_count(application))
    employed = X.sentinel_to_null("DAYS_EMPLOYED", X.EMPLOYMENT_SENTINEL)
    derived = {
        "AGE_YEARS": X.days_to_years("DAYS_BIRTH", eps),
        "DAYS_EMPLOYED_ANOMALY": X.sentinel_flag("DAYS_EMPLOYED", X.EMPLOYMENT_SENTINEL),
        "EMPLOYED_YEARS": X.days_to_years(employed, eps),
        "EMPLOYMENT_YEARS_TO_AGE": X.tenure_share(employed, "DAYS_BIRTH", eps),
        **{name: X.eps_ratio(num, den, eps) for name, (num, den) in RATIOS.items()},
        **{f"{c}_IS_MISSING": X.missing_indicator(c) for c in INDICATED},
        "DOC_COUNT": X.flag_sum(DOCUMENT_FLAGS),
        "CONTACT_COUNT": X.flag_sum(CONTACT_FLAGS),
        "ADDR_MISMATCH_SUM": X.flag_sum(ADDRESS_FLAGS),
    }
    return counted.select(*[col(c) for c in PASSED_THROUGH], *[c.alias(n) for n, c in derived.items()])


def bureau_features(bureau: DataFrame, eps: float = X.RATIO_EPSILON) -> DataFrame:
    return single_level_rollup(
        bureau,
        ENTITY,
        {
            "BUREAU_N_ACTIVE": X.count_where(F.col("CREDIT_ACTIVE") == "Active"),
            "BUREAU_N_CLOSED": X.count_where(F.col("CREDIT_ACTIVE") == "Closed"),
            "BUREAU_LAST_CREDIT_DAYS": F.max("DAYS_CREDIT"),
            "BUREAU_LAST_UPDATE_DAYS": F.max("DAYS_CREDIT_UPDATE"),
            "BUREAU_TOTAL_DEBT": F.sum("AMT_CREDIT_SUM_DEBT"),
            "BUREAU_TOTAL_CREDIT": F.sum("AMT_CREDIT_SUM"),
            "BUREAU_LIMIT_SUM": F.sum("AMT_CREDIT_SUM_LIMIT"),
            "BUREAU_UTIL_MEAN": X.mean_of_ratio("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", eps),
            "BUREAU_OVERDUE_SUM": F.sum("AMT_CREDIT_SUM_OVERDUE"),
            "BUREAU_MAX_OVERDUE": F.max("AMT_CREDIT_MAX_OVERDUE"),
            "BUREAU_PROLONG_SUM": F.sum("CNT_CREDIT_PROLONG"),
        },
    )


def bureau_balance_features(bureau_balance: DataFrame, bureau: DataFrame, hot_links: Sequence = ()) -> DataFrame:
    """Monthly statuses. The last delinquent month is a conditional maximum of the first
    aggregate, so the delinquent rows need no scan and join of their own."""
    status = X.code_to_number("STATUS")
    late = status > 0
    return two_level_rollup(
        bureau_balance,
        BUREAU_KEY,
        {
            "share": X.share_where(late),
            "worst": F.max(status),
            "since_late": X.last_offset_where(late, "MONTHS_BALANCE"),
        },
        bureau,
        ENTITY,
        {
            "BB_DELINQ_SHARE_MEAN": F.avg("share"),
            "BB_WORST_STATUS_MAX": F.max("worst"),
            "BB_MONTHS_SINCE_LAST_DELINQ_MIN": F.min("since_late"),
        },
        how="left",
        hot_links=hot_links,
    )


def previous_application_features(previous: DataFrame) -> DataFrame:
    def outcome(status: str):
        return X.count_where(F.col("NAME_CONTRACT_STATUS") == status)

    rolled = single_level_rollup(
        previous,
        ENTITY,
        {
            "PREV_TOTAL": F.count_distinct(col(CONTRACT_KEY)),
            "PREV_APPROVED": outcome("Approved"),
            "PREV_REFUSED": outcome("Refused"),
            "PREV_CANCELLED": outcome("Canceled"),
            "PREV_UNUSED": outcome("Unused offer"),
            "PREV_APP_CREDIT_RATIO_MEAN": X.mean_of_ratio("AMT_APPLICATION", "AMT_CREDIT", None),
            "PREV_DOWNPAYMENT_RATE_MEAN": X.mean_of_ratio("AMT_DOWN_PAYMENT", "AMT_CREDIT", None),
            "PREV_CNT_PAYMENT_MEAN": F.avg("CNT_PAYMENT"),
            "PREV_LAST_DECISION_DAYS": F.max("DAYS_DECISION"),
            "PREV_EARLIEST_DECISION_DAYS": F.min("DAYS_DECISION"),
        },
    )
    approved = ratio_of(rolled, "PREV_APPROVAL_RATE", "PREV_APPROVED", "PREV_TOTAL")
    return ratio_of(approved, "PREV_REFUSED_RATE", "PREV_REFUSED", "PREV_TOTAL")


def _contract_rollup(
    history: DataFrame, previous: DataFrame, measures: Mapping[str, tuple], hot_links: Sequence = ()
) -> DataFrame:
    """Two levels through the contract: ``name -> (per contract, over the applicant's contracts)``."""
    return two_level_rollup(
        history,
        CONTRACT_KEY,
        {name: inner for name, (inner, _) in measures.items()},
        previous,
        ENTITY,
        {name: outer(name) for name, (_, outer) in measures.items()},
        hot_links=hot_links,
    )


def installment_features(
    installments: DataFrame, previous: DataFrame, eps: float = X.RATIO_EPSILON, hot_links: Sequence = ()
) -> DataFrame:
    paid = X.eps_ratio("AMT_PAYMENT", "AMT_INSTALMENT", eps)
    late = X.day_gap("DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT")
    return _contract_rollup(
        installments,
        previous,
        {
            "INSTAL_PAYMENT_RATIO_MEAN": (F.avg(paid), F.avg),
            "INSTAL_PAYMENT_RATIO_STD": (F.stddev_samp(paid), F.avg),
            "INSTAL_LATE_MEAN": (F.avg(late), F.avg),
            "INSTAL_LATE_MAX": (F.max(late), F.max),
            "INSTAL_LATE_SHARE": (X.share_where(late > 0), F.avg),
            "INSTAL_SEVERE_LATE_SHARE": (X.share_where(late > 0, SEVERE_LATE_WEIGHT), F.avg),
        },
        hot_links,
    )


def _overdue():
    return (F.col("SK_DPD") > 0) | (F.col("SK_DPD_DEF") > 0)


def credit_card_features(
    credit_card: DataFrame, previous: DataFrame, eps: float = X.RATIO_EPSILON, hot_links: Sequence = ()
) -> DataFrame:
    used = X.eps_ratio("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", eps)
    coverage = X.eps_ratio("AMT_PAYMENT_TOTAL_CURRENT", "AMT_INST_MIN_REGULARITY", eps)
    cash = X.eps_ratio("AMT_DRAWINGS_ATM_CURRENT", "AMT_CREDIT_LIMIT_ACTUAL", eps)
    return _contract_rollup(
        credit_card,
        previous,
        {
            "CC_UTIL_MEAN": (F.avg(used), F.avg),
            "CC_UTIL_MAX": (F.max(used), F.max),
            "CC_MINPAY_COVERAGE_MEAN": (F.avg(coverage), F.avg),
            "CC_MINPAY_MET_SHARE": (X.share_where(coverage >= 1), F.avg),
            "CC_DPD_ANY_SHARE": (X.share_where(_overdue()), F.avg),
            "CC_DPD_MAX": (F.max("SK_DPD"), F.max),
            "CC_CASH_RATIO_MEAN": (F.avg(cash), F.avg),
        },
        hot_links,
    )


def pos_cash_features(pos_cash: DataFrame, previous: DataFrame, hot_links: Sequence = ()) -> DataFrame:
    active = F.col("NAME_CONTRACT_STATUS") == "Active"
    return _contract_rollup(
        pos_cash,
        previous,
        {
            "POS_DPD_ANY_SHARE": (X.share_where(_overdue()), F.avg),
            "POS_DPD_MAX": (F.max("SK_DPD"), F.max),
            "POS_MONTHS_SINCE_LAST_ACTIVE": (X.last_offset_where(active, "MONTHS_BALANCE"), F.max),
        },
        hot_links,
    )


# --- the whole table ----------------------------------------------------------------


def joined_features(
    tables: LoanTables, eps: float = X.RATIO_EPSILON, check_keys: bool = True, hot_from: int = HOT_FROM
) -> DataFrame:
    """One row per applicant with all raw features, before encoding.

    NaN in a table of numbers is a missing value. Earlier contracts and bureau records are not promised to be
    unique, so their tables are searched once for ids that occur at least ``hot_from`` times; those are
    joined another way, with the same result.
    """
    tables = LoanTables(**{name: nan_to_null(df) for name, df in vars(tables).items()})
    previous = tables.previous_application
    hot = frequent_keys(previous, CONTRACT_KEY, at_least=hot_from) if check_keys else []
    hot_bureau = frequent_keys(tables.bureau, BUREAU_KEY, at_least=hot_from) if check_keys else []
    sides = [
        bureau_features(tables.bureau, eps),
        bureau_balance_features(tables.bureau_balance, tables.bureau, hot_bureau),
        previous_application_features(previous),
        installment_features(tables.installments, previous, eps, hot),
        credit_card_features(tables.credit_card, previous, eps, hot),
        pos_cash_features(tables.pos_cash, previous, hot),
    ]
    base = application_features(tables.application, eps)
    return assemble(Side(base, unique=not check_keys), [Side(s, unique=True) for s in sides], ENTITY)


def encode_features(
    joined: DataFrame,
    medians: Mapping[str, float | None] | None = None,
    vocabulary: Mapping[str, Sequence[str]] | None = None,
    max_levels: int = MAX_LEVELS,
) -> DataFrame:
    """Categories to 0/1 columns, missing numbers to medians.

    State not given is fitted on ``joined`` itself; pass the training part's to
    keep test rows out of it.
    """
    if vocabulary is None:
        texts = string_columns(joined)
        vocabulary = read_vocabulary(fit_vocabulary(joined, texts), max_levels, len(texts)) if texts else {}
    if medians is None:
        numbers = [c for c in numeric_columns(joined) if c not in (ENTITY, TARGET)]
        medians = fit_medians(joined, columns_with_gaps(joined, numbers))
    return one_hot(impute_median(joined, medians), vocabulary)


def finish_features(
    encoded: DataFrame,
    drop: Sequence[str] = DEFAULT_DROPPED,
    sentinel: int = X.EMPLOYMENT_SENTINEL,
    missing_count: str = "TOT_MISSING_COUNT",
) -> DataFrame:
    """Renames the anomaly flag, adds the sentinel-free copy and the missing count, drops, zero-fills.

    The copy is made after imputation, so the sentinel ends as 0 there.
    """
    df = encoded
    if "DAYS_EMPLOYED_ANOMALY" in df.columns:
        df = df.withColumnRenamed("DAYS_EMPLOYED_ANOMALY", "DAYS_EMPLOYED_ANOM")
    if "DAYS_EMPLOYED" in df.columns:
        df = df.withColumn("DAYS_EMPLOYED_REPLACED", X.sentinel_to_null("DAYS_EMPLOYED", sentinel))
    count = col(missing_count) if missing_count in df.columns else row_missing_count(df)
    df = df.withColumn("missing_count", count)
    return fill_zero(drop_columns(df, drop, protect=(TARGET, ENTITY)))


def feature_table(
    tables: LoanTables,
    eps: float = X.RATIO_EPSILON,
    check_keys: bool = True,
    hot_from: int = HOT_FROM,
    max_levels: int = MAX_LEVELS,
) -> DataFrame:
    """The model-ready table. The joined features are read three times (levels, medians,
    result), so they are written to the shared folder once. Writing and fitting cover more than a hundred columns at a time."""
    with compiled_methods(tables.application.sparkSession):
        joined = stored(joined_features(tables, eps, check_keys, hot_from), "joined-features")
        encoded = encode_features(joined, max_levels=max_levels)
    return finish_features(encoded)


# The model's columns before the category levels, in the configured order.
MODEL_NUMBERS = [
    "CNT_CHILDREN", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "REGION_POPULATION_RELATIVE",
    "DAYS_BIRTH", "DAYS_EMPLOYED", "DAYS_EMPLOYED_ANOM", "DAYS_EMPLOYED_REPLACED", "AGE_YEARS", "EMPLOYED_YEARS",
    "EMPLOYMENT_YEARS_TO_AGE", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH", "FLAG_MOBIL", "FLAG_EMP_PHONE", "FLAG_WORK_PHONE",
    "FLAG_CONT_MOBILE", "FLAG_PHONE", "FLAG_EMAIL", "CNT_FAM_MEMBERS", "REGION_RATING_CLIENT",
    "REGION_RATING_CLIENT_W_CITY", "HOUR_APPR_PROCESS_START", "REG_REGION_NOT_LIVE_REGION",
    "REG_REGION_NOT_WORK_REGION", "LIVE_REGION_NOT_WORK_REGION", "REG_CITY_NOT_LIVE_CITY", "REG_CITY_NOT_WORK_CITY",
    "LIVE_CITY_NOT_WORK_CITY", "EXT_SOURCE_2", "EXT_SOURCE_3", "EXT_SOURCE_1_IS_MISSING", "EXT_SOURCE_2_IS_MISSING",
    "EXT_SOURCE_3_IS_MISSING", "TOT_MISSING_COUNT", "OBS_30_CNT_SOCIAL_CIRCLE", "DEF_30_CNT_SOCIAL_CIRCLE",
    "OBS_60_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE", "DAYS_LAST_PHONE_CHANGE", *DOCUMENT_FLAGS,
    *ENQUIRIES, "missing_count", "PAYMENT_RATE", "CREDIT_TO_INCOME", "ANNUITY_TO_INCOME", "GOODS_TO_CREDIT",
    "INCOME_PER_PERSON", "CHILDREN_RATIO", "DOC_COUNT", "CONTACT_COUNT", "ADDR_MISMATCH_SUM", "OWN_CAR_AGE_IS_MISSING",
]


def model_columns(vocabulary: Mapping[str, Sequence[str]] = CATEGORY_LEVELS) -> list[str]:
    """The 162 columns the model reads, in the order that coefficients and vectors follow."""
    levels = [f"{c}_{v}" for c, values in vocabulary.items() for v in values]
    return MODEL_NUMBERS + levels + HISTORY_FEATURES


# Names of the history features.
HISTORY_FEATURES = [
    "BUREAU_N_ACTIVE", "BUREAU_N_CLOSED", "BUREAU_LAST_CREDIT_DAYS", "BUREAU_LAST_UPDATE_DAYS",
    "BUREAU_TOTAL_DEBT", "BUREAU_TOTAL_CREDIT", "BUREAU_LIMIT_SUM", "BUREAU_UTIL_MEAN", "BUREAU_OVERDUE_SUM",
    "BUREAU_MAX_OVERDUE", "BUREAU_PROLONG_SUM",
    "BB_DELINQ_SHARE_MEAN", "BB_WORST_STATUS_MAX", "BB_MONTHS_SINCE_LAST_DELINQ_MIN",
    "PREV_TOTAL", "PREV_APPROVED", "PREV_REFUSED", "PREV_CANCELLED", "PREV_UNUSED",
    "PREV_APP_CREDIT_RATIO_MEAN", "PREV_DOWNPAYMENT_RATE_MEAN", "PREV_CNT_PAYMENT_MEAN",
    "PREV_LAST_DECISION_DAYS", "PREV_EARLIEST_DECISION_DAYS", "PREV_APPROVAL_RATE", "PREV_REFUSED_RATE",
    "INSTAL_PAYMENT_RATIO_MEAN", "INSTAL_PAYMENT_RATIO_STD", "INSTAL_LATE_MEAN", "INSTAL_LATE_MAX",
    "INSTAL_LATE_SHARE", "INSTAL_SEVERE_LATE_SHARE",
    "CC_UTIL_MEAN", "CC_UTIL_MAX", "CC_MINPAY_COVERAGE_MEAN", "CC_MINPAY_MET_SHARE", "CC_DPD_ANY_SHARE",
    "CC_DPD_MAX", "CC_CASH_RATIO_MEAN",
    "POS_DPD_ANY_SHARE", "POS_DPD_MAX", "POS_MONTHS_SINCE_LAST_ACTIVE",
]


# --- contracts of the raw tables ------------------------------------------------------
# Columns, kinds and bounds that the raw tables promise.

_ID = K.Field(nullable=False, rules=(K.NON_NEGATIVE,))
_UNIQUE_ID = K.Field(nullable=False, rules=(K.NON_NEGATIVE,), unique=True)
_AMOUNT = K.Field(rules=(K.NON_NEGATIVE,))
_NUMBER = K.Field()
_GIVEN_NUMBER = K.Field(nullable=False)
_TEXT = K.Field(kind="string")
_GIVEN_TEXT = K.Field(kind="string", nullable=False)

RAW_CONTRACTS = {
    c.name: c
    for c in (
        K.Contract(
            "application",
            {
                ENTITY: _UNIQUE_ID,
                TARGET: K.Field(nullable=False, rules=(K.one_of(0, 1),)),
                "AMT_INCOME_TOTAL": _ID,
                "AMT_CREDIT": _ID,
                "CNT_CHILDREN": _AMOUNT,
                "DAYS_BIRTH": K.Field(nullable=False, rules=(K.NON_POSITIVE,)),
                "DAYS_EMPLOYED": K.Field(rules=(K.sentinel_or_non_positive(X.EMPLOYMENT_SENTINEL),)),
                **{c: _NUMBER for c in EXTERNAL_SCORES},
            },
        ),
        K.Contract(
            "bureau",
            {
                BUREAU_KEY: _UNIQUE_ID,
                ENTITY: _ID,
                "AMT_CREDIT_SUM": _AMOUNT,
                "CREDIT_DAY_OVERDUE": _NUMBER,
                "CREDIT_ACTIVE": _TEXT,
            },
        ),
        K.Contract(
            "bureau_balance", {BUREAU_KEY: _ID, "MONTHS_BALANCE": _GIVEN_NUMBER, "STATUS": _GIVEN_TEXT}
        ),
        K.Contract(
            "previous_application",
            {
                CONTRACT_KEY: _ID,
                ENTITY: _ID,
                "AMT_CREDIT": _AMOUNT,
                "AMT_ANNUITY": _AMOUNT,
                "NAME_CONTRACT_STATUS": _GIVEN_TEXT,
            },
        ),
        K.Contract(
            "installments",
            {
                CONTRACT_KEY: _ID,
                ENTITY: _ID,
                "NUM_INSTALMENT_NUMBER": _ID,
                "NUM_INSTALMENT_VERSION": _AMOUNT,
                "AMT_INSTALMENT": _AMOUNT,
                "AMT_PAYMENT": _AMOUNT,
            },
        ),
        K.Contract(
            "credit_card",
            {
                CONTRACT_KEY: _ID,
                ENTITY: _ID,
                "MONTHS_BALANCE": _GIVEN_NUMBER,
                "AMT_BALANCE": _NUMBER,
                "AMT_CREDIT_LIMIT_ACTUAL": _AMOUNT,
            },
        ),
        K.Contract(
            "pos_cash",
            {
                CONTRACT_KEY: _ID,
                ENTITY: _ID,
                "MONTHS_BALANCE": _GIVEN_NUMBER,
                "CNT_INSTALMENT": _AMOUNT,
                "CNT_INSTALMENT_FUTURE": _NUMBER,
            },
        ),
    )
}
