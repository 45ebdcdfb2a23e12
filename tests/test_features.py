import pytest
from pyspark.sql import functions as F

from creditloom.functions.registry import feature_names, feature_rows, fill_for_missing_history, fill_values
from creditloom.operators import features, impute, quality
from creditloom.sources.schemas import raw_schema


def test_registry_shape(spark):
    rows = feature_rows()
    assert len(rows) == len({f.name for f in rows}) == 185
    sizes = {g: len(feature_names(group=g)) for g in ("application", "bureau", "ins", "cc", "pos", "prev")}
    assert sizes == {"application": 123, "bureau": 15, "ins": 8, "cc": 15, "pos": 7, "prev": 17}
    app = {k: len(feature_names(kind=k, group="application")) for k in ("numeric", "binary", "categorical")}
    assert app == {"numeric": 78, "binary": 31, "categorical": 14}
    assert len(feature_names(exclude_groups=("application",))) == 62
    # the fill the join step uses and the registry's own differ for two features only
    fills = fill_values()
    differ = [f.name for f in rows if f.group != "application" and int(fills[f.name]) != fill_for_missing_history(f.name)]
    assert differ == ["bureau_global_worst_status", "bureau_global_worst_status_last_6m"]


def test_loan_months_and_bureau(spark):
    months = spark.createDataFrame(
        [(1, 0, "C"), (1, -1, "2"), (1, -7, "5"), (2, -9, "X"), (2, -8, None), (2, -10, "?")],
        "SK_ID_BUREAU long, MONTHS_BALANCE long, STATUS string",
    )
    loans = features.loan_month_features(months)
    got = {r.SK_ID_BUREAU: tuple(r)[1:] for r in loans.collect()}
    assert got == {1: (3, 5, 2, 2), 2: (3, 0, 0, None)}
    bureau = spark.createDataFrame(
        [(7, 1, "Active", None, -10, None, 1, 100.0, 40.0, 1.0), (7, 3, "Closed", "card", -20, None, 0, None, None, None)],
        "SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, CREDIT_TYPE string, DAYS_CREDIT long, "
        "CREDIT_DAY_OVERDUE long, CNT_CREDIT_PROLONG long, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, "
        "AMT_CREDIT_SUM_OVERDUE double",
    )
    r = features.bureau_features(bureau, loans).first()
    assert (r.bureau_loan_count, r.bureau_loan_types, r.bureau_max_overdue) == (2, 2, None)
    assert (r.total_debt, r.bureau_active_debt, r.debt_to_credit_ratio) == (40.0, 40.0, 40.0 / (100 + 1e-5))
    assert (r.bureau_global_worst_status, r.bureau_total_months_overdue_across_loans, r.bureau_global_worst_status_last_6m) == (5, 2, 2)
    alone = features.bureau_features(bureau).first()
    assert (alone.bureau_global_worst_status, alone.bureau_total_months_overdue_across_loans) == (0, 0)


def test_previous_outcome_domain(spark):
    rows = [(1, 1, "Approved", -5), (1, 2, "Refused", -1), (2, 3, "Other", -1), (3, 4, None, -1)]
    df = spark.createDataFrame(
        [(c, p, s, d, 1.0, 1.0, None, None, None) for c, p, s, d in rows],
        "SK_ID_CURR long, SK_ID_PREV long, NAME_CONTRACT_STATUS string, DAYS_DECISION long, AMT_APPLICATION double, "
        "AMT_CREDIT double, AMT_ANNUITY double, RATE_DOWN_PAYMENT double, CNT_PAYMENT double",
    )
    got = {
        r.SK_ID_CURR: [r[f"prev_most_recent_status_{o}"] for o in ("Approved", "Refused", "Canceled", "Unused offer")]
        for r in features.previous_application_features(df).collect()
    }
    assert got == {1: [0, 1, 0, 0], 2: [0, 0, 0, 0], 3: [0, 0, 0, 0]}
    assert tuple(features.unknown_outcomes(df).first()) == (4, 2)


def test_join_fill(spark):
    base = spark.createDataFrame([(1, None, 0)], "SK_ID_CURR long, NAME_X string, TARGET int")
    side = spark.createDataFrame([(2, 1.0, 1)], "SK_ID_CURR long, prev_avg_annuity_amt double, cc_months_tracked long")
    r = features.fill_joined_nulls(features.star_join(base, side)).first()
    assert (r.NAME_X, r.prev_avg_annuity_amt, r.cc_months_tracked) == ("Missing", -1.0, 0)


def test_impute_rules(spark):
    schema = (
        "SK_ID_CURR long, TARGET int, EXT_SOURCE_1 double, EXT_SOURCE_2 double, NAME_X string, OTHER string, AMT double, "
        "COMMONAREA_AVG double, FLAG_OWN_CAR string, OWN_CAR_AGE double, FLAG_OWN_REALTY string, D date"
    )
    rows = [
        (1, 0, 0.2, None, None, "x", 1.0, None, "N", None, "Y", None),
        (2, 1, None, None, "b", "y", None, None, "Y", 4.0, None, None),
        (3, None, 0.8, None, "c", "z", 9.0, 1.0, "Y", None, "N", None),
        (4, 0, 0.4, None, "c", "z", 3.0, None, None, 6.0, "N", None),
    ]
    df = spark.createDataFrame(rows, schema)
    profile = impute.fit_imputer(df)
    out = impute.apply_imputer(df, profile)
    got = {r.SK_ID_CURR: r for r in out.collect()}
    assert "COMMONAREA_AVG" not in out.columns and out.columns[-2:] == ["MISSING_EXT_SOURCE_1", "MISSING_EXT_SOURCE_2"]
    assert (got[2].EXT_SOURCE_1, got[2].MISSING_EXT_SOURCE_1, got[1].MISSING_EXT_SOURCE_1) == (0.4, 1, 0)
    assert got[1].EXT_SOURCE_2 == 0.5 and got[1].NAME_X == "Missing" and got[2].AMT == 3.0
    # car age is zeroed before its median, the median is taken over 0, 4, 6
    assert (got[1].OWN_CAR_AGE, got[3].OWN_CAR_AGE) == (0.0, 4.0)
    assert (got[4].FLAG_OWN_CAR, got[2].FLAG_OWN_REALTY, got[1].FLAG_OWN_REALTY) == (0, 0, 1)
    assert got[3].TARGET is None and got[1].D == 0.0
    # a later row is treated with what training saw
    again = impute.apply_imputer(spark.createDataFrame([(9, 0, None, None, None, None, None, None, "Y", None, "Y", None)], schema), profile).first()
    assert (again.EXT_SOURCE_1, again.AMT, again.OWN_CAR_AGE) == (0.4, 3.0, 4.0)


def test_align_adds_defaults(spark):
    df = impute.align_to(spark.createDataFrame([(1,)], "a int"), ["a", "b", "c"], ["c"])
    assert tuple(df.first()) == (1, 0.0, "Missing")


def test_registry_validation(spark):
    df = spark.createDataFrame([(1, None)], "EXT_SOURCE_1 int, EXT_SOURCE_2 double")
    states = {r.feature: r.state for r in quality.registry_check(df.withColumn("x", F.lit(1))).collect()}
    assert (states["EXT_SOURCE_1"], states["EXT_SOURCE_2"], states["EXT_SOURCE_3"], states["x"]) == ("ok", "has_nulls", "missing", "unregistered")
    with pytest.raises(quality.ContractError):
        quality.validate_registry(df)


def test_contracts(spark):
    df = spark.createDataFrame([(1, 0), (1, None)], "k int, y int")
    with pytest.raises(quality.ContractError):
        quality.require_unique(df, "k", "t")
    with pytest.raises(quality.ContractError):
        quality.require_no_nulls(df, "y", "t")
    assert quality.require_unique(df.where("y = 0"), "k", "t").count() == 1


def test_raw_schemas_cover_feature_inputs():
    assert "TARGET" in raw_schema("application_train").names and "TARGET" not in raw_schema("application_test").names
    assert len(raw_schema("application_test")) == 121  # id and 120 raw application columns
