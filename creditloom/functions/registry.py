"""The canonical model features in model order: name, source group, kind, fill value and description."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditloom.runtime import small_table

ID_COLUMN = "SK_ID_CURR"
LABEL_COLUMN = "TARGET"

# fixed values: contract outcomes, each with its own one-hot column
CONTRACT_OUTCOMES = ["Approved", "Refused", "Canceled", "Unused offer"]

# fixed values: presence flags that never enter a model
PRESENCE_FLAGS = [
    "HAS_BUREAU_RECORD",
    "HAS_INSTALMENT_HISTORY",
    "HAS_CREDIT_CARD_HISTORY",
    "HAS_POS_HISTORY",
    "HAS_PREVIOUS_APPLICATION",
]

# fixed values: joined features whose missing value becomes -1 instead of 0
MINUS_ONE_PREFIXES = (
    "bureau_avg",
    "bureau_global",
    "debt_to_credit",
    "ins_mean",
    "ins_worst",
    "ins_avg",
    "cc_atm_to",
    "cc_pay_to",
    "cc_current_utilization",
    "pos_remaining",
    "prev_credit_to",
    "prev_avg",
    "prev_rejection",
)


class Feature(NamedTuple):
    name: str
    group: str
    kind: str
    fill: int | str
    description: str


# fixed values: the features in model order
FEATURES = [
    Feature("EXT_SOURCE_1", "application", "numeric", -1, "Normalised score from external data source 1"),
    Feature("EXT_SOURCE_2", "application", "numeric", -1, "Normalised score from external data source 2"),
    Feature("EXT_SOURCE_3", "application", "numeric", -1, "Normalised score from external data source 3"),
    Feature("MISSING_EXT_SOURCE_1", "application", "binary", 0, "1 if EXT_SOURCE_1 was missing before imputation"),
    Feature("MISSING_EXT_SOURCE_2", "application", "binary", 0, "1 if EXT_SOURCE_2 was missing before imputation"),
    Feature("MISSING_EXT_SOURCE_3", "application", "binary", 0, "1 if EXT_SOURCE_3 was missing before imputation"),
    Feature("DAYS_BIRTH", "application", "numeric", -1, "Applicant age in days relative to application (negative)"),
    Feature("DAYS_EMPLOYED", "application", "numeric", -1, "Days employed at current job relative to application (negative)"),
    Feature("DAYS_ID_PUBLISH", "application", "numeric", -1, "Days since ID was last changed (negative)"),
    Feature("DAYS_REGISTRATION", "application", "numeric", -1, "Days since applicant changed registration (negative)"),
    Feature("DAYS_LAST_PHONE_CHANGE", "application", "numeric", -1, "Days since applicant last changed phone (negative)"),
    Feature("AMT_INCOME_TOTAL", "application", "numeric", -1, "Applicant annual income"),
    Feature("AMT_CREDIT", "application", "numeric", -1, "Credit amount of the loan"),
    Feature("AMT_GOODS_PRICE", "application", "numeric", -1, "Price of goods for which the loan is given"),
    Feature("AMT_ANNUITY", "application", "numeric", -1, "Loan annuity amount"),
    Feature("AMT_REQ_CREDIT_BUREAU_HOUR", "application", "numeric", 0, "Credit bureau enquiries in last hour"),
    Feature("AMT_REQ_CREDIT_BUREAU_DAY", "application", "numeric", 0, "Credit bureau enquiries in last day"),
    Feature("AMT_REQ_CREDIT_BUREAU_WEEK", "application", "numeric", 0, "Credit bureau enquiries in last week"),
    Feature("AMT_REQ_CREDIT_BUREAU_MON", "application", "numeric", 0, "Credit bureau enquiries in last month"),
    Feature("AMT_REQ_CREDIT_BUREAU_QRT", "application", "numeric", 0, "Credit bureau enquiries in last quarter"),
    Feature("AMT_REQ_CREDIT_BUREAU_YEAR", "application", "numeric", 0, "Credit bureau enquiries in last year"),
    Feature("FLAG_OWN_CAR", "application", "binary", 0, "1 if applicant owns a car"),
    Feature("FLAG_OWN_REALTY", "application", "binary", 0, "1 if applicant owns real estate"),
    Feature("FLAG_MOBIL", "application", "binary", 0, "1 if applicant provided mobile phone"),
    Feature("FLAG_EMP_PHONE", "application", "binary", 0, "1 if applicant provided work phone"),
    Feature("FLAG_WORK_PHONE", "application", "binary", 0, "1 if applicant provided work phone number"),
    Feature("FLAG_CONT_MOBILE", "application", "binary", 0, "1 if mobile phone is reachable"),
    Feature("FLAG_PHONE", "application", "binary", 0, "1 if applicant provided home phone"),
    Feature("FLAG_EMAIL", "application", "binary", 0, "1 if applicant provided email"),
    Feature("FLAG_DOCUMENT_2", "application", "binary", 0, "1 if applicant provided document 2"),
    Feature("FLAG_DOCUMENT_3", "application", "binary", 0, "1 if applicant provided document 3"),
    Feature("FLAG_DOCUMENT_4", "application", "binary", 0, "1 if applicant provided document 4"),
    Feature("FLAG_DOCUMENT_5", "application", "binary", 0, "1 if applicant provided document 5"),
    Feature("FLAG_DOCUMENT_6", "application", "binary", 0, "1 if applicant provided document 6"),
    Feature("FLAG_DOCUMENT_7", "application", "binary", 0, "1 if applicant provided document 7"),
    Feature("FLAG_DOCUMENT_8", "application", "binary", 0, "1 if applicant provided document 8"),
    Feature("FLAG_DOCUMENT_9", "application", "binary", 0, "1 if applicant provided document 9"),
    Feature("FLAG_DOCUMENT_10", "application", "binary", 0, "1 if applicant provided document 10"),
    Feature("FLAG_DOCUMENT_11", "application", "binary", 0, "1 if applicant provided document 11"),
    Feature("FLAG_DOCUMENT_12", "application", "binary", 0, "1 if applicant provided document 12"),
    Feature("FLAG_DOCUMENT_13", "application", "binary", 0, "1 if applicant provided document 13"),
    Feature("FLAG_DOCUMENT_14", "application", "binary", 0, "1 if applicant provided document 14"),
    Feature("FLAG_DOCUMENT_15", "application", "binary", 0, "1 if applicant provided document 15"),
    Feature("FLAG_DOCUMENT_16", "application", "binary", 0, "1 if applicant provided document 16"),
    Feature("FLAG_DOCUMENT_17", "application", "binary", 0, "1 if applicant provided document 17"),
    Feature("FLAG_DOCUMENT_18", "application", "binary", 0, "1 if applicant provided document 18"),
    Feature("FLAG_DOCUMENT_19", "application", "binary", 0, "1 if applicant provided document 19"),
    Feature("FLAG_DOCUMENT_20", "application", "binary", 0, "1 if applicant provided document 20"),
    Feature("FLAG_DOCUMENT_21", "application", "binary", 0, "1 if applicant provided document 21"),
    Feature("CODE_GENDER", "application", "categorical", "Missing", "Applicant gender"),
    Feature("NAME_CONTRACT_TYPE", "application", "categorical", "Missing", "Type of loan contract"),
    Feature("NAME_TYPE_SUITE", "application", "categorical", "Missing", "Who accompanied applicant during application"),
    Feature("NAME_INCOME_TYPE", "application", "categorical", "Missing", "Applicant income source type"),
    Feature("NAME_EDUCATION_TYPE", "application", "categorical", "Missing", "Highest education level of applicant"),
    Feature("NAME_FAMILY_STATUS", "application", "categorical", "Missing", "Applicant family status"),
    Feature("NAME_HOUSING_TYPE", "application", "categorical", "Missing", "Applicant housing situation"),
    Feature("OCCUPATION_TYPE", "application", "categorical", "Missing", "Applicant occupation type"),
    Feature("ORGANIZATION_TYPE", "application", "categorical", "Missing", "Type of organisation applicant works for"),
    Feature("WEEKDAY_APPR_PROCESS_START", "application", "categorical", "Missing", "Day of week application was started"),
    Feature("HOUSETYPE_MODE", "application", "categorical", "Missing", "Type of house applicant lives in (mode)"),
    Feature("WALLSMATERIAL_MODE", "application", "categorical", "Missing", "Wall material of applicant's building (mode)"),
    Feature("EMERGENCYSTATE_MODE", "application", "categorical", "Missing", "Emergency state of applicant's building (mode)"),
    Feature("FONDKAPREMONT_MODE", "application", "categorical", "Missing", "Type of wall material for capital repairs (mode)"),
    Feature("CNT_CHILDREN", "application", "numeric", 0, "Number of children applicant has"),
    Feature("CNT_FAM_MEMBERS", "application", "numeric", 0, "Number of family members"),
    Feature("REGION_RATING_CLIENT", "application", "numeric", -1, "Lender rating of applicant's region"),
    Feature("REGION_RATING_CLIENT_W_CITY", "application", "numeric", -1, "Lender rating of applicant's region with city"),
    Feature("REGION_POPULATION_RELATIVE", "application", "numeric", -1, "Normalised population of applicant's region"),
    Feature("HOUR_APPR_PROCESS_START", "application", "numeric", -1, "Hour of day application process started"),
    Feature("OWN_CAR_AGE", "application", "numeric", 0, "Age of applicant's car in years (0 if no car)"),
    Feature("LIVE_CITY_NOT_WORK_CITY", "application", "numeric", 0, "1 if applicant lives in different city than works"),
    Feature("REG_CITY_NOT_WORK_CITY", "application", "numeric", 0, "1 if registered city differs from work city"),
    Feature("REG_CITY_NOT_LIVE_CITY", "application", "numeric", 0, "1 if registered city differs from living city"),
    Feature("LIVE_REGION_NOT_WORK_REGION", "application", "numeric", 0, "1 if living region differs from work region"),
    Feature("REG_REGION_NOT_LIVE_REGION", "application", "numeric", 0, "1 if registered region differs from living region"),
    Feature("REG_REGION_NOT_WORK_REGION", "application", "numeric", 0, "1 if registered region differs from work region"),
    Feature("OBS_30_CNT_SOCIAL_CIRCLE", "application", "numeric", 0, "Observations of social circle defaulting in 30 days"),
    Feature("OBS_60_CNT_SOCIAL_CIRCLE", "application", "numeric", 0, "Observations of social circle defaulting in 60 days"),
    Feature("DEF_30_CNT_SOCIAL_CIRCLE", "application", "numeric", 0, "Defaults in social circle within 30 days"),
    Feature("DEF_60_CNT_SOCIAL_CIRCLE", "application", "numeric", 0, "Defaults in social circle within 60 days"),
    Feature("APARTMENTS_AVG", "application", "numeric", -1, "Normalised apartment size (avg)"),
    Feature("APARTMENTS_MODE", "application", "numeric", -1, "Normalised apartment size (mode)"),
    Feature("APARTMENTS_MEDI", "application", "numeric", -1, "Normalised apartment size (median)"),
    Feature("BASEMENTAREA_AVG", "application", "numeric", -1, "Normalised basement area (avg)"),
    Feature("BASEMENTAREA_MODE", "application", "numeric", -1, "Normalised basement area (mode)"),
    Feature("BASEMENTAREA_MEDI", "application", "numeric", -1, "Normalised basement area (median)"),
    Feature("YEARS_BEGINEXPLUATATION_AVG", "application", "numeric", -1, "Normalised year building started operation (avg)"),
    Feature("YEARS_BEGINEXPLUATATION_MODE", "application", "numeric", -1, "Normalised year building started operation (mode)"),
    Feature("YEARS_BEGINEXPLUATATION_MEDI", "application", "numeric", -1, "Normalised year building started operation (median)"),
    Feature("YEARS_BUILD_AVG", "application", "numeric", -1, "Normalised year building was built (avg)"),
    Feature("YEARS_BUILD_MODE", "application", "numeric", -1, "Normalised year building was built (mode)"),
    Feature("YEARS_BUILD_MEDI", "application", "numeric", -1, "Normalised year building was built (median)"),
    Feature("COMMONAREA_AVG", "application", "numeric", -1, "Normalised common area size (avg)"),
    Feature("COMMONAREA_MODE", "application", "numeric", -1, "Normalised common area size (mode)"),
    Feature("COMMONAREA_MEDI", "application", "numeric", -1, "Normalised common area size (median)"),
    Feature("ELEVATORS_AVG", "application", "numeric", -1, "Normalised number of elevators (avg)"),
    Feature("ELEVATORS_MODE", "application", "numeric", -1, "Normalised number of elevators (mode)"),
    Feature("ELEVATORS_MEDI", "application", "numeric", -1, "Normalised number of elevators (median)"),
    Feature("ENTRANCES_AVG", "application", "numeric", -1, "Normalised number of entrances (avg)"),
    Feature("ENTRANCES_MODE", "application", "numeric", -1, "Normalised number of entrances (mode)"),
    Feature("ENTRANCES_MEDI", "application", "numeric", -1, "Normalised number of entrances (median)"),
    Feature("FLOORSMAX_AVG", "application", "numeric", -1, "Normalised maximum floors in building (avg)"),
    Feature("FLOORSMAX_MODE", "application", "numeric", -1, "Normalised maximum floors in building (mode)"),
    Feature("FLOORSMAX_MEDI", "application", "numeric", -1, "Normalised maximum floors in building (median)"),
    Feature("FLOORSMIN_AVG", "application", "numeric", -1, "Normalised minimum floors in building (avg)"),
    Feature("FLOORSMIN_MODE", "application", "numeric", -1, "Normalised minimum floors in building (mode)"),
    Feature("FLOORSMIN_MEDI", "application", "numeric", -1, "Normalised minimum floors in building (median)"),
    Feature("LANDAREA_AVG", "application", "numeric", -1, "Normalised land area (avg)"),
    Feature("LANDAREA_MODE", "application", "numeric", -1, "Normalised land area (mode)"),
    Feature("LANDAREA_MEDI", "application", "numeric", -1, "Normalised land area (median)"),
    Feature("LIVINGAPARTMENTS_AVG", "application", "numeric", -1, "Normalised living apartment size (avg)"),
    Feature("LIVINGAPARTMENTS_MODE", "application", "numeric", -1, "Normalised living apartment size (mode)"),
    Feature("LIVINGAPARTMENTS_MEDI", "application", "numeric", -1, "Normalised living apartment size (median)"),
    Feature("LIVINGAREA_AVG", "application", "numeric", -1, "Normalised living area size (avg)"),
    Feature("LIVINGAREA_MODE", "application", "numeric", -1, "Normalised living area size (mode)"),
    Feature("LIVINGAREA_MEDI", "application", "numeric", -1, "Normalised living area size (median)"),
    Feature("NONLIVINGAPARTMENTS_AVG", "application", "numeric", -1, "Normalised non-living apartment size (avg)"),
    Feature("NONLIVINGAPARTMENTS_MODE", "application", "numeric", -1, "Normalised non-living apartment size (mode)"),
    Feature("NONLIVINGAPARTMENTS_MEDI", "application", "numeric", -1, "Normalised non-living apartment size (median)"),
    Feature("NONLIVINGAREA_AVG", "application", "numeric", -1, "Normalised non-living area size (avg)"),
    Feature("NONLIVINGAREA_MODE", "application", "numeric", -1, "Normalised non-living area size (mode)"),
    Feature("NONLIVINGAREA_MEDI", "application", "numeric", -1, "Normalised non-living area size (median)"),
    Feature("TOTALAREA_MODE", "application", "numeric", -1, "Normalised total area of building (mode)"),
    Feature("bureau_loan_count", "bureau", "numeric", 0, "Total number of external bureau loans"),
    Feature("bureau_loan_types", "bureau", "numeric", 0, "Number of distinct credit types in bureau"),
    Feature("bureau_days_since_last_loan", "bureau", "numeric", 0, "Days since most recent bureau loan opened"),
    Feature("bureau_days_since_first_loan", "bureau", "numeric", 0, "Days since oldest bureau loan opened"),
    Feature("bureau_avg_credit", "bureau", "numeric", -1, "Mean credit amount across all bureau loans"),
    Feature("total_debt", "bureau", "numeric", 0, "Sum of outstanding debt across all bureau loans"),
    Feature("total_credit", "bureau", "numeric", 0, "Sum of total credit amount across all bureau loans"),
    Feature("bureau_active_debt", "bureau", "numeric", 0, "Outstanding debt on currently active bureau loans"),
    Feature("debt_to_credit_ratio", "bureau", "numeric", -1, "Total debt divided by total credit"),
    Feature("bureau_max_overdue", "bureau", "numeric", 0, "Maximum days overdue ever recorded in bureau"),
    Feature("bureau_total_amt_overdue", "bureau", "numeric", 0, "Total overdue amount summed across bureau loans"),
    Feature("bureau_total_prolong_count", "bureau", "numeric", 0, "Total number of times bureau loans were prolonged"),
    Feature("bureau_global_worst_status", "bureau", "numeric", 0, "Worst monthly DPD status ever across bureau loans"),
    Feature("bureau_total_months_overdue_across_loans", "bureau", "numeric", 0, "Total overdue months summed across bureau loans"),
    Feature("bureau_global_worst_status_last_6m", "bureau", "numeric", 0, "Worst DPD status across bureau loans in last 6 months"),
    Feature("ins_total_installment_tracked", "ins", "numeric", 0, "Total number of installment records tracked"),
    Feature("ins_worst_underpay", "ins", "numeric", -1, "Largest single underpayment (most negative pay diff)"),
    Feature("ins_mean_payment_diff", "ins", "numeric", -1, "Mean difference between amount paid and amount due"),
    Feature("ins_mean_payratio", "ins", "numeric", -1, "Mean ratio of payment made to installment due"),
    Feature("ins_underpayment_count", "ins", "numeric", 0, "Number of installments where payment was less than due"),
    Feature("ins_worst_day_late", "ins", "numeric", -1, "Maximum days late across all installment payments"),
    Feature("ins_avg_day_late", "ins", "numeric", -1, "Average days late across all installment payments"),
    Feature("ins_late_count", "ins", "numeric", 0, "Number of installments paid late"),
    Feature("cc_months_tracked", "cc", "numeric", 0, "Total months of credit card history tracked"),
    Feature("cc_total_drawings_amt", "cc", "numeric", 0, "Total amount drawn on credit card across all months"),
    Feature("cc_max_single_month_drawing", "cc", "numeric", 0, "Largest drawing amount in a single month"),
    Feature("cc_total_drawings_count", "cc", "numeric", 0, "Total number of credit card drawings"),
    Feature("cc_total_atm_drawings_amt", "cc", "numeric", 0, "Total ATM drawing amount across all months"),
    Feature("cc_atm_to_total_drawing_ratio", "cc", "numeric", -1, "ATM drawings as a share of total drawings"),
    Feature("cc_total_paymemt", "cc", "numeric", 0, "Total payments made on credit card across all months"),
    Feature("cc_pay_to_min_inst_ratio", "cc", "numeric", -1, "Total payments relative to total minimum installments due"),
    Feature("cc_max_balance_ever", "cc", "numeric", 0, "Highest credit card balance ever recorded"),
    Feature("cc_current_balance", "cc", "numeric", 0, "Credit card balance in the most recent month"),
    Feature("cc_current_total_receivable", "cc", "numeric", 0, "Total receivable amount in the most recent month"),
    Feature("cc_current_utilization_ratio", "cc", "numeric", -1, "Current balance divided by current credit limit"),
    Feature("cc_max_days_past_due", "cc", "numeric", 0, "Maximum days past due ever on credit card"),
    Feature("cc_max_days_past_due_with_tolerance", "cc", "numeric", 0, "Maximum DPD with tolerance ever on credit card"),
    Feature("cc_month_overdue_count", "cc", "numeric", 0, "Number of months with any credit card overdue"),
    Feature("pos_month_tracked", "pos", "numeric", 0, "Total months of POS cash history tracked"),
    Feature("pos_max_loan_term", "pos", "numeric", 0, "Maximum loan term seen in POS"),
    Feature("pos_current_remaining_installments", "pos", "numeric", 0, "Remaining installments on most recent POS loan"),
    Feature("pos_remaining_installment_ratio", "pos", "numeric", -1, "Remaining installments as share of total loan term"),
    Feature("pos_max_days_past_due", "pos", "numeric", 0, "Maximum days past due ever on POS loans"),
    Feature("pos_max_days_past_due_with_tolerance", "pos", "numeric", 0, "Maximum DPD with tolerance ever on POS loans"),
    Feature("pos_month_overdue_count", "pos", "numeric", 0, "Number of months with any POS overdue"),
    Feature("prev_total_applications", "prev", "numeric", 0, "Total number of previous loan applications"),
    Feature("prev_days_since_last_decision", "prev", "numeric", 0, "Days since most recent application decision"),
    Feature("prev_days_since_first_decision", "prev", "numeric", 0, "Days since first ever application decision"),
    Feature("prev_total_amt_asked", "prev", "numeric", 0, "Total loan amount requested across previous applications"),
    Feature("prev_total_amt_approved", "prev", "numeric", 0, "Total loan amount approved across previous applications"),
    Feature("prev_credit_to_application_ratio", "prev", "numeric", -1, "Approved amount relative to requested amount"),
    Feature("prev_avg_annuity_amt", "prev", "numeric", -1, "Mean annuity amount across previous applications"),
    Feature("prev_avg_down_payment_rate", "prev", "numeric", -1, "Mean down payment rate across previous applications"),
    Feature("prev_avg_loan_term_months", "prev", "numeric", -1, "Mean loan term in months across previous applications"),
    Feature("prev_count_refused", "prev", "numeric", 0, "Number of previous applications refused"),
    Feature("prev_count_approved", "prev", "numeric", 0, "Number of previous applications approved"),
    Feature("prev_count_canceled", "prev", "numeric", 0, "Number of previous applications canceled"),
    Feature("prev_rejection_rate", "prev", "numeric", -1, "Share of previous applications that were refused"),
    Feature("prev_most_recent_status_Approved", "prev", "binary", 0, "Most recent application was Approved"),
    Feature("prev_most_recent_status_Refused", "prev", "binary", 0, "Most recent application was Refused"),
    Feature("prev_most_recent_status_Canceled", "prev", "binary", 0, "Most recent application was Canceled"),
    Feature("prev_most_recent_status_Unused offer", "prev", "binary", 0, "Most recent application was an Unused offer"),
]


def feature_rows() -> list[Feature]:
    return FEATURES


def feature_names(
    kind: str | None = None, group: str | None = None, exclude_groups: tuple[str, ...] = ()
) -> list[str]:
    return [
        f.name
        for f in feature_rows()
        if (kind is None or f.kind == kind)
        and (group is None or f.group == group)
        and f.group not in exclude_groups
    ]


def fill_values(exclude_groups: tuple[str, ...] = ()) -> dict[str, int | str]:
    """Fill value per feature, ready for ``df.na.fill``."""
    return {
        f.name: f.fill
        for f in feature_rows()
        if f.group not in exclude_groups
    }


def feature_table(spark: SparkSession) -> DataFrame:
    """The registry as a table; its size is fixed, so it may be broadcast."""
    schema = T.StructType(
        [T.StructField("position", T.IntegerType(), False)]
        + [T.StructField(n, T.StringType(), False) for n in Feature._fields]
    )
    return small_table(spark, [(i, f.name, f.group, f.kind, str(f.fill), f.description) for i, f in enumerate(feature_rows())], schema)


def fill_for_missing_history(name: str) -> int:
    return -1 if name.startswith(MINUS_ONE_PREFIXES) else 0
