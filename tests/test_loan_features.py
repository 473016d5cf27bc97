import pytest
from pyspark.sql import functions as F

from riskframe.operators.assemble import DuplicateKeyError
from riskframe.operators.contract import run_contract
from riskframe.plans import flat_table as FT
from riskframe.plans import loan_features as L
from riskframe.session import METHOD_SETTING, compiled_methods


def sparse(spark, kinds, rows):
    """Rows given as dicts; every other column is NULL."""
    return spark.createDataFrame([tuple(r.get(c) for c in kinds) for r in rows], ", ".join(f"{c} {k}" for c, k in kinds.items()))


APP = {
    **{c: "double" for c in L.PASSED_THROUGH if c != "TOT_MISSING_COUNT"},
    **{c: "string" for c in L.CATEGORY_LEVELS},
    "SK_ID_CURR": "long",
    "OWN_CAR_AGE": "double",
}


@pytest.fixture(scope="module")
def tables(spark):
    full = {c: 0.0 for c in APP if c not in L.CATEGORY_LEVELS} | {c: v[0] for c, v in L.CATEGORY_LEVELS.items()}
    app = [
        full | {"SK_ID_CURR": 1, "AMT_CREDIT": 100.0, "AMT_ANNUITY": 10.0, "DAYS_BIRTH": -7300.0, "DAYS_EMPLOYED": 365243.0, "FLAG_DOCUMENT_3": 1.0, "FLAG_MOBIL": 1.0},
        full | {"SK_ID_CURR": 2, "EXT_SOURCE_1": None, "CODE_GENDER": None, "DAYS_BIRTH": -3650.0, "DAYS_EMPLOYED": -365.0},
        full | {"SK_ID_CURR": 3, "DAYS_BIRTH": -3650.0, "DAYS_EMPLOYED": -730.0, "CODE_GENDER": "M"},  # no history at all
    ]
    bureau = [
        {"SK_ID_BUREAU": 10, "SK_ID_CURR": 1, "CREDIT_ACTIVE": "Active", "DAYS_CREDIT": -5.0, "AMT_CREDIT_SUM": 50.0, "AMT_CREDIT_SUM_DEBT": 25.0},
        {"SK_ID_BUREAU": 11, "SK_ID_CURR": 1, "CREDIT_ACTIVE": "Closed", "DAYS_CREDIT": -9.0, "AMT_CREDIT_SUM": 100.0},
        {"SK_ID_BUREAU": 12, "SK_ID_CURR": 2, "CREDIT_ACTIVE": "Sold", "DAYS_CREDIT": -1.0},
    ]
    balance = [
        {"SK_ID_BUREAU": 10, "MONTHS_BALANCE": -1, "STATUS": "C"},
        {"SK_ID_BUREAU": 10, "MONTHS_BALANCE": -2, "STATUS": "3"},
        {"SK_ID_BUREAU": 10, "MONTHS_BALANCE": -6, "STATUS": "1"},
        {"SK_ID_BUREAU": 10, "MONTHS_BALANCE": -7, "STATUS": "X"},
        {"SK_ID_BUREAU": 11, "MONTHS_BALANCE": -4, "STATUS": "5"},
        {"SK_ID_BUREAU": 99, "MONTHS_BALANCE": -1, "STATUS": "5"},  # no bureau row
    ]
    previous = [
        {"SK_ID_PREV": 20, "SK_ID_CURR": 1, "NAME_CONTRACT_STATUS": "Approved", "AMT_APPLICATION": 5.0, "AMT_CREDIT": 10.0, "DAYS_DECISION": -3.0},
        {"SK_ID_PREV": 21, "SK_ID_CURR": 1, "NAME_CONTRACT_STATUS": "Refused", "AMT_APPLICATION": 5.0, "AMT_CREDIT": 0.0, "DAYS_DECISION": -8.0},
        {"SK_ID_PREV": 21, "SK_ID_CURR": 1, "NAME_CONTRACT_STATUS": "Refused", "AMT_APPLICATION": 3.0, "AMT_CREDIT": 4.0, "DAYS_DECISION": -9.0},
    ]
    installments = [
        {"SK_ID_PREV": 20, "AMT_PAYMENT": 10.0, "AMT_INSTALMENT": 10.0, "DAYS_ENTRY_PAYMENT": -1.0, "DAYS_INSTALMENT": -4.0},
        {"SK_ID_PREV": 20, "AMT_PAYMENT": 20.0, "AMT_INSTALMENT": 10.0, "DAYS_ENTRY_PAYMENT": -9.0, "DAYS_INSTALMENT": -8.0},
        {"SK_ID_PREV": 20, "AMT_PAYMENT": None, "AMT_INSTALMENT": 10.0, "DAYS_ENTRY_PAYMENT": None, "DAYS_INSTALMENT": -8.0},
        {"SK_ID_PREV": 21, "AMT_PAYMENT": 4.0, "AMT_INSTALMENT": 8.0, "DAYS_ENTRY_PAYMENT": -6.0, "DAYS_INSTALMENT": -7.0},
        {"SK_ID_PREV": 88, "AMT_PAYMENT": 4.0, "AMT_INSTALMENT": 8.0, "DAYS_ENTRY_PAYMENT": 0.0, "DAYS_INSTALMENT": -70.0},  # no link
    ]
    card = [
        {"SK_ID_PREV": 20, "AMT_BALANCE": 5.0, "AMT_CREDIT_LIMIT_ACTUAL": 10.0, "AMT_PAYMENT_TOTAL_CURRENT": 3.0, "AMT_INST_MIN_REGULARITY": 2.0, "SK_DPD": 0.0, "SK_DPD_DEF": 2.0, "AMT_DRAWINGS_ATM_CURRENT": 1.0},
        {"SK_ID_PREV": 20, "AMT_BALANCE": 9.0, "AMT_CREDIT_LIMIT_ACTUAL": 10.0, "AMT_PAYMENT_TOTAL_CURRENT": 1.0, "AMT_INST_MIN_REGULARITY": None, "SK_DPD": 7.0, "SK_DPD_DEF": None, "AMT_DRAWINGS_ATM_CURRENT": None},
    ]
    pos = [
        {"SK_ID_PREV": 20, "NAME_CONTRACT_STATUS": "Active", "MONTHS_BALANCE": -3, "SK_DPD": 0.0, "SK_DPD_DEF": 0.0},
        {"SK_ID_PREV": 20, "NAME_CONTRACT_STATUS": "Completed", "MONTHS_BALANCE": -1, "SK_DPD": 1.0, "SK_DPD_DEF": 0.0},
        {"SK_ID_PREV": 21, "NAME_CONTRACT_STATUS": "Active", "MONTHS_BALANCE": -8, "SK_DPD": None, "SK_DPD_DEF": None},
    ]
    d = "double"
    return L.LoanTables(
        sparse(spark, APP, app),
        sparse(spark, {"SK_ID_BUREAU": "long", "SK_ID_CURR": "long", "CREDIT_ACTIVE": "string", "DAYS_CREDIT": d, "DAYS_CREDIT_UPDATE": d, "AMT_CREDIT_SUM": d, "AMT_CREDIT_SUM_DEBT": d, "AMT_CREDIT_SUM_LIMIT": d, "AMT_CREDIT_SUM_OVERDUE": d, "AMT_CREDIT_MAX_OVERDUE": d, "CNT_CREDIT_PROLONG": d}, bureau),
        sparse(spark, {"SK_ID_BUREAU": "long", "MONTHS_BALANCE": "long", "STATUS": "string"}, balance),
        sparse(spark, {"SK_ID_PREV": "long", "SK_ID_CURR": "long", "NAME_CONTRACT_STATUS": "string", "AMT_APPLICATION": d, "AMT_CREDIT": d, "AMT_DOWN_PAYMENT": d, "CNT_PAYMENT": d, "DAYS_DECISION": d}, previous),
        sparse(spark, {"SK_ID_PREV": "long", "AMT_PAYMENT": d, "AMT_INSTALMENT": d, "DAYS_ENTRY_PAYMENT": d, "DAYS_INSTALMENT": d}, installments),
        sparse(spark, {"SK_ID_PREV": "long", "AMT_BALANCE": d, "AMT_CREDIT_LIMIT_ACTUAL": d, "AMT_PAYMENT_TOTAL_CURRENT": d, "AMT_INST_MIN_REGULARITY": d, "SK_DPD": d, "SK_DPD_DEF": d, "AMT_DRAWINGS_ATM_CURRENT": d}, card),
        sparse(spark, {"SK_ID_PREV": "long", "NAME_CONTRACT_STATUS": "string", "MONTHS_BALANCE": "long", "SK_DPD": d, "SK_DPD_DEF": d}, pos),
    )


@pytest.fixture(scope="module")
def joined(tables):
    return {r["SK_ID_CURR"]: r.asDict() for r in L.joined_features(tables).collect()}


def near(value):
    return pytest.approx(value, rel=1e-5)


def test_application_features(joined):
    a, b = joined[1], joined[2]
    assert a["PAYMENT_RATE"] == near(0.1) and a["DAYS_EMPLOYED_ANOMALY"] == 1 and a["EMPLOYED_YEARS"] is None
    assert (a["DOC_COUNT"], a["CONTACT_COUNT"], a["ADDR_MISMATCH_SUM"], a["TOT_MISSING_COUNT"]) == (1, 1, 0, 0)
    assert b["EMPLOYED_YEARS"] == near(1.0) and b["EMPLOYMENT_YEARS_TO_AGE"] == near(0.1) and b["AGE_YEARS"] == near(10.0)
    assert (b["EXT_SOURCE_1_IS_MISSING"], b["EXT_SOURCE_2_IS_MISSING"], b["TOT_MISSING_COUNT"]) == (1, 0, 2)


def test_bureau_features(joined):
    a, b = joined[1], joined[2]
    assert (a["BUREAU_N_ACTIVE"], a["BUREAU_N_CLOSED"], a["BUREAU_LAST_CREDIT_DAYS"], a["BUREAU_TOTAL_CREDIT"]) == (1, 1, -5.0, 150.0)
    assert a["BUREAU_UTIL_MEAN"] == near(0.5) and a["BUREAU_LIMIT_SUM"] is None
    assert a["BB_DELINQ_SHARE_MEAN"] == (0.5 + 1.0) / 2 and a["BB_WORST_STATUS_MAX"] == 5
    assert a["BB_MONTHS_SINCE_LAST_DELINQ_MIN"] == 2  # contracts: 2 and 4 months back
    assert (b["BUREAU_N_ACTIVE"], b["BB_WORST_STATUS_MAX"]) == (0, None)


def test_previous_applications(joined):
    a = joined[1]
    assert (a["PREV_TOTAL"], a["PREV_APPROVED"], a["PREV_REFUSED"]) == (2, 1, 2)
    assert a["PREV_APP_CREDIT_RATIO_MEAN"] == (0.5 + 0.75) / 2  # the zero credit is left out
    assert (a["PREV_APPROVAL_RATE"], a["PREV_REFUSED_RATE"]) == (0.5, 1.0)
    assert (a["PREV_LAST_DECISION_DAYS"], a["PREV_EARLIEST_DECISION_DAYS"]) == (-3.0, -9.0)


def test_contract_histories(joined):
    a = joined[1]
    # contract 21 occurs twice in the link, so it counts twice
    assert a["INSTAL_PAYMENT_RATIO_MEAN"] == near((1.5 + 0.5 + 0.5) / 3)
    assert a["INSTAL_PAYMENT_RATIO_STD"] == near(0.5**0.5)
    assert a["INSTAL_LATE_MAX"] == 3.0 and a["INSTAL_LATE_MEAN"] == near((1.0 + 1 + 1) / 3)
    assert a["INSTAL_LATE_SHARE"] == near((1 / 3 + 1 + 1) / 3)
    assert a["INSTAL_SEVERE_LATE_SHARE"] == near(30 * a["INSTAL_LATE_SHARE"])
    assert (a["CC_UTIL_MEAN"], a["CC_UTIL_MAX"], a["CC_CASH_RATIO_MEAN"]) == (near(0.7), near(0.9), near(0.1))
    assert (a["CC_MINPAY_COVERAGE_MEAN"], a["CC_MINPAY_MET_SHARE"]) == (near(1.5), 0.5)
    assert (a["CC_DPD_ANY_SHARE"], a["CC_DPD_MAX"]) == (1.0, 7.0)
    assert a["POS_DPD_ANY_SHARE"] == near((0.5 + 0 + 0) / 3) and a["POS_MONTHS_SINCE_LAST_ACTIVE"] == 8


def test_applicant_without_history_has_nulls(joined):
    assert all(joined[3][c] is None for c in L.HISTORY_FEATURES) and set(joined) == {1, 2, 3}


def test_model_table(tables):
    table = L.feature_table(tables)
    rows = {r["SK_ID_CURR"]: r.asDict() for r in table.collect()}
    assert rows[1]["DAYS_EMPLOYED_REPLACED"] == 0 and rows[1]["DAYS_EMPLOYED"] == 365243
    assert rows[1]["EMPLOYED_YEARS"] == near(1.5)  # median of 1 and 2 years
    assert rows[3]["BUREAU_N_ACTIVE"] == 0.5  # median of 1 and 0
    assert rows[3]["BUREAU_LIMIT_SUM"] == 0.0  # no value anywhere
    assert rows[2]["missing_count"] == 2 and "SK_ID_CURR" in table.columns
    assert (rows[1]["CODE_GENDER_F"], rows[2]["CODE_GENDER_F"], rows[3]["CODE_GENDER_M"]) == (1, 0, 1)
    assert not any(v is None for r in rows.values() for v in r.values())


def test_wide_steps_run_in_methods_that_the_jvm_compiles(spark, tables, monkeypatch):
    before, seen, fit = spark.conf.get(METHOD_SETTING), [], L.fit_medians
    monkeypatch.setattr(L, "fit_medians", lambda *args: (seen.append(spark.conf.get(METHOD_SETTING)), fit(*args))[1])
    L.feature_table(tables)
    assert seen == ["8000"] and spark.conf.get(METHOD_SETTING) == before
    with pytest.raises(ZeroDivisionError), compiled_methods(spark):
        1 / 0
    assert spark.conf.get(METHOD_SETTING) == before


def test_names():
    assert len(L.PASSED_THROUGH) == 72 and len(set(L.model_columns())) == len(L.model_columns()) == 162


def test_duplicate_applicant_raises(tables):
    twice = L.LoanTables(**(vars(tables) | {"application": tables.application.unionByName(tables.application)}))
    with pytest.raises(DuplicateKeyError):
        L.joined_features(twice)


def test_raw_contracts(spark, tables):
    assert set(L.RAW_CONTRACTS) == {"application", "bureau", "bureau_balance", "previous_application", "installments", "credit_card", "pos_cash"}
    bad = tables.application.filter("SK_ID_CURR = 1").withColumn("DAYS_EMPLOYED", F.lit(100.0))
    failing = run_contract(bad, L.RAW_CONTRACTS["application"]).filter("not passed").collect()
    assert [(r["column"], r["check"]) for r in failing] == [("DAYS_EMPLOYED", "sentinel_or_non_positive")]


def test_flat_table(spark):
    rows = [(1, 0, 365243, -3650, 10.0, None, "a", "x"), (2, 1, -365, -3650, None, None, None, "y"), (3, 0, -730, -7300, 20.0, None, "b", "x")]
    df = spark.createDataFrame(rows, "id int, TARGET int, DAYS_EMPLOYED int, DAYS_BIRTH int, AMT_ANNUITY double, EMPTY double, S string, OCCUPATION_TYPE string")
    out = FT.prepare_flat_table(df.withColumn("AMT_CREDIT", F.lit(100.0)), "TARGET", drop=["id"])
    assert "EMPTY" not in out.columns and "id" not in out.columns and not [c for c in out.columns if c.startswith("OCCUPATION")]
    first, second, _ = out.orderBy(F.col("DAYS_EMPLOYED").desc()).collect()
    assert first["DAYS_EMPLOYED_ANOM"] == 1 and first["EMPLOYED_YEARS"] == 0.0 and first["PAYMENT_RATE"] == near(0.1)
    assert first["missing_count"] == 1 + 3  # EMPTY, and the three columns derived from the sentinel
    assert (second["S_a"], second["S_b"], second["missing_count"]) == (0, 0, 3)
    assert FT.selected_columns(out, "TARGET", ["S_a"]) == ["S_a"]
    with pytest.raises(ValueError, match="zz"):
        FT.selected_columns(out, "TARGET", ["zz"])
