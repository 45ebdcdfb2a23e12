"""History tables to one row per applicant, the star join, and the fill after it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions import aggregates as A
from creditloom.functions.histories import ArrayHistory, Getter, GroupedHistory, History, field, newest_ratio, ratio_of_totals
from creditloom.functions.registry import (
    CONTRACT_OUTCOMES,
    ID_COLUMN,
    LABEL_COLUMN,
    fill_for_missing_history,
)
from creditloom.functions.scalars import status_number
from creditloom.sources.schemas import raw_schema

# fixed value: months that count as recent, current month included
RECENT_MONTHS = -6


def loan_month_values(h: History, month: str = "MONTHS_BALANCE") -> dict[str, Column]:
    """Monthly statuses of one loan."""

    def level(c: Getter) -> Column:
        return status_number(c("STATUS"))

    return {
        "bb_total_months_tracked": h.rows(),
        "bb_worst_status": h.largest(level),
        "bb_months_overdue_count": h.count(lambda c: level(c) > 0),
        "bb_worst_status_last_6m": h.largest(level, lambda c: c(month) >= RECENT_MONTHS),
    }


def bureau_values(h: History) -> dict[str, Column]:
    """External loans, each beside the summary of its months."""
    debt, credit, zero = field("AMT_CREDIT_SUM_DEBT"), field("AMT_CREDIT_SUM"), F.lit(0).cast("long")
    return {
        "bureau_loan_count": h.rows(),
        "bureau_loan_types": h.distinct(field("CREDIT_TYPE")),
        "bureau_days_since_last_loan": h.largest(field("DAYS_CREDIT")),
        "bureau_days_since_first_loan": h.smallest(field("DAYS_CREDIT")),
        "bureau_avg_credit": h.mean(credit),
        "total_debt": h.total(debt),
        "total_credit": h.total(credit),
        "bureau_active_debt": h.total(debt, lambda c: c("CREDIT_ACTIVE") == "Active"),
        "debt_to_credit_ratio": ratio_of_totals(h, debt, credit),
        "bureau_max_overdue": h.largest(field("CREDIT_DAY_OVERDUE")),
        "bureau_total_amt_overdue": h.total(field("AMT_CREDIT_SUM_OVERDUE")),
        "bureau_total_prolong_count": h.total(field("CNT_CREDIT_PROLONG")),
        "bureau_global_worst_status": F.coalesce(h.largest(field("bb_worst_status")), zero),
        "bureau_total_months_overdue_across_loans": h.total(field("bb_months_overdue_count")),
        "bureau_global_worst_status_last_6m": F.coalesce(h.largest(field("bb_worst_status_last_6m")), zero),
    }


def installment_values(h: History) -> dict[str, Column]:
    """Payments against their instalments."""

    def gap(c: Getter) -> Column:
        return c("AMT_PAYMENT") - c("AMT_INSTALMENT")

    def late(c: Getter) -> Column:
        return c("DAYS_ENTRY_PAYMENT") - c("DAYS_INSTALMENT")

    return {
        "ins_total_installment_tracked": h.rows(),
        "ins_worst_underpay": h.smallest(gap),
        "ins_mean_payment_diff": h.mean(gap),
        "ins_mean_payratio": h.mean(lambda c: A.guarded_ratio(c("AMT_PAYMENT"), c("AMT_INSTALMENT"))),
        "ins_underpayment_count": h.count(lambda c: gap(c) < 0),
        "ins_worst_day_late": h.largest(late),
        "ins_avg_day_late": h.mean(late),
        "ins_late_count": h.count(lambda c: late(c) > 0),
    }


def credit_card_values(h: History, month: str = "MONTHS_BALANCE", tiebreak: str = "SK_ID_PREV") -> dict[str, Column]:
    """Monthly card statements; equal months go to the higher id."""
    drawn, atm, paid = field("AMT_DRAWINGS_CURRENT"), field("AMT_DRAWINGS_ATM_CURRENT"), field("AMT_PAYMENT_CURRENT")
    balance = field("AMT_BALANCE")
    return {
        "cc_months_tracked": h.rows(),
        "cc_total_drawings_amt": h.total(drawn),
        "cc_max_single_month_drawing": h.largest(drawn),
        "cc_total_drawings_count": h.total(field("CNT_DRAWINGS_CURRENT")),
        "cc_total_atm_drawings_amt": h.total(atm),
        "cc_atm_to_total_drawing_ratio": ratio_of_totals(h, atm, drawn),
        "cc_total_paymemt": h.total(paid),
        "cc_pay_to_min_inst_ratio": ratio_of_totals(h, paid, field("AMT_INST_MIN_REGULARITY")),
        "cc_max_balance_ever": h.largest(balance),
        "cc_current_balance": h.newest(balance, month, tiebreak),
        "cc_current_total_receivable": h.newest(field("AMT_TOTAL_RECEIVABLE"), month, tiebreak),
        "cc_current_utilization_ratio": newest_ratio(h, balance, field("AMT_CREDIT_LIMIT_ACTUAL"), month, tiebreak),
        "cc_max_days_past_due": h.largest(field("SK_DPD")),
        "cc_max_days_past_due_with_tolerance": h.largest(field("SK_DPD_DEF")),
        "cc_month_overdue_count": h.count(lambda c: c("SK_DPD") > 0),
    }


def pos_values(h: History, month: str = "MONTHS_BALANCE", tiebreak: str = "SK_ID_PREV") -> dict[str, Column]:
    """Monthly point-of-sale loan states."""
    future = field("CNT_INSTALMENT_FUTURE")
    return {
        "pos_month_tracked": h.rows(),
        "pos_max_loan_term": h.largest(field("CNT_INSTALMENT")),
        "pos_current_remaining_installments": h.newest(future, month, tiebreak),
        "pos_remaining_installment_ratio": newest_ratio(h, future, field("CNT_INSTALMENT"), month, tiebreak),
        "pos_max_days_past_due": h.largest(field("SK_DPD")),
        "pos_max_days_past_due_with_tolerance": h.largest(field("SK_DPD_DEF")),
        "pos_month_overdue_count": h.count(lambda c: c("SK_DPD") > 0),
    }


def previous_application_values(h: History, day: str = "DAYS_DECISION", tiebreak: str = "SK_ID_PREV") -> dict[str, Column]:
    """Past applications; ``newest`` is the newest outcome's position in the fixed domain, 0 for one outside it.

    As a number it keeps the aggregation buffer fixed-width.
    """

    def outcome(c: Getter) -> Column:
        place = F.array_position(F.array(*[F.lit(o) for o in CONTRACT_OUTCOMES]), c("NAME_CONTRACT_STATUS"))
        return F.coalesce(place.cast("int"), F.lit(0))

    def status(name: str) -> Column:
        return h.count(lambda c: c("NAME_CONTRACT_STATUS") == name)

    return {
        "prev_total_applications": h.rows(),
        "prev_days_since_last_decision": h.largest(field(day)),
        "prev_days_since_first_decision": h.smallest(field(day)),
        "prev_total_amt_asked": h.total(field("AMT_APPLICATION")),
        "prev_total_amt_approved": h.total(field("AMT_CREDIT")),
        "prev_credit_to_application_ratio": ratio_of_totals(h, field("AMT_CREDIT"), field("AMT_APPLICATION")),
        "prev_avg_annuity_amt": h.mean(field("AMT_ANNUITY")),
        "prev_avg_down_payment_rate": h.mean(field("RATE_DOWN_PAYMENT")),
        "prev_avg_loan_term_months": h.mean(field("CNT_PAYMENT")),
        "prev_count_refused": status("Refused"),
        "prev_count_approved": status("Approved"),
        "prev_count_canceled": status("Canceled"),
        "prev_rejection_rate": F.try_divide(status("Refused"), h.rows()),
        "newest": h.newest(outcome, day, tiebreak),
    }


def _grouped(rows: DataFrame, key: str, values: dict[str, Column], flag: str | None = None) -> DataFrame:
    out = rows.groupBy(key).agg(*[value.alias(name) for name, value in values.items()])
    return out if flag is None else out.withColumn(flag, F.lit(1))


def loan_month_features(
    balance: DataFrame, key: str = "SK_ID_BUREAU", month: str = "MONTHS_BALANCE"
) -> DataFrame:
    """Monthly loan statuses to one row per loan."""
    return _grouped(balance.select(key, month, "STATUS"), key, loan_month_values(GroupedHistory(), month))


def bureau_features(
    bureau: DataFrame,
    loan_months: DataFrame | None = None,
    key: str = ID_COLUMN,
    loan_key: str = "SK_ID_BUREAU",
) -> DataFrame:
    """External loans, each with its monthly summary, to one row per applicant."""
    if loan_months is not None:
        bureau = bureau.join(loan_months, loan_key, "left")
    absent = [name for name in loan_month_values(GroupedHistory()) if name not in bureau.columns]
    bureau = bureau.withColumns({name: F.lit(None).cast("long") for name in absent})
    return _grouped(bureau, key, bureau_values(GroupedHistory()), "HAS_BUREAU_RECORD")


def installment_features(payments: DataFrame, key: str = ID_COLUMN) -> DataFrame:
    """Payments against their instalments to one row per applicant."""
    return _grouped(payments, key, installment_values(GroupedHistory()), "HAS_INSTALMENT_HISTORY")


def credit_card_features(
    cards: DataFrame,
    key: str = ID_COLUMN,
    month: str = "MONTHS_BALANCE",
    tiebreak: str = "SK_ID_PREV",
) -> DataFrame:
    """Monthly card statements to one row per applicant."""
    return _grouped(cards, key, credit_card_values(GroupedHistory(), month, tiebreak), "HAS_CREDIT_CARD_HISTORY")


def pos_features(
    pos: DataFrame,
    key: str = ID_COLUMN,
    month: str = "MONTHS_BALANCE",
    tiebreak: str = "SK_ID_PREV",
) -> DataFrame:
    """Monthly point-of-sale loan states to one row per applicant."""
    return _grouped(pos, key, pos_values(GroupedHistory(), month, tiebreak), "HAS_POS_HISTORY")


def newest_outcome_columns(newest: Column) -> dict[str, Column]:
    """One 0/1 column per outcome from the code that ``previous_application_values`` gives."""
    return {f"prev_most_recent_status_{o}": F.coalesce((newest == i + 1).cast("int"), F.lit(0)) for i, o in enumerate(CONTRACT_OUTCOMES)}


def previous_application_features(
    previous: DataFrame,
    key: str = ID_COLUMN,
    day: str = "DAYS_DECISION",
    tiebreak: str = "SK_ID_PREV",
) -> DataFrame:
    """Past applications to one row per applicant, with the newest outcome one-hot encoded.

    An outcome outside the fixed domain leaves all four columns 0.
    """
    out = _grouped(previous, key, previous_application_values(GroupedHistory(), day, tiebreak))
    return one_hot(out, "newest", {o: i + 1 for i, o in enumerate(CONTRACT_OUTCOMES)},
                   "prev_most_recent_status").withColumn("HAS_PREVIOUS_APPLICATION", F.lit(1))


def loans_with_months(loans: Column, months: Column) -> Column:
    """A request's loans, each with the summary of its own records among the months."""

    def joined(loan: Column) -> Column:
        own = F.filter(months, lambda m: m["SK_ID_BUREAU"] == loan["SK_ID_BUREAU"])
        summary = {n: F.when(F.size(own) > 0, v) for n, v in loan_month_values(ArrayHistory(own)).items()}
        return F.struct(
            *[loan[n].alias(n) for n in raw_schema("bureau").names], *[value.alias(name) for name, value in summary.items()]
        )

    return F.transform(loans, joined)


def request_history_columns(lists: Callable[[str], Column]) -> dict[str, Column]:
    """All history features of a request from its child lists, folded inside the row that holds them.

    ``lists`` gives the array of a list's name; the loans come with their months already. Without records a list's features are null, as
    a missing partner of the star join leaves them.
    """
    parts = [
        (lists("bureau"), bureau_values, "HAS_BUREAU_RECORD"),
        (lists("installments"), installment_values, "HAS_INSTALMENT_HISTORY"),
        (lists("credit_card"), credit_card_values, "HAS_CREDIT_CARD_HISTORY"),
        (lists("pos_cash"), pos_values, "HAS_POS_HISTORY"),
        (lists("previous_applications"), previous_application_values, "HAS_PREVIOUS_APPLICATION"),
    ]
    out = {}
    for records, values, flag in parts:
        present = F.size(records) > 0
        found = {**values(ArrayHistory(records)), flag: F.lit(1)}
        if "newest" in found:
            flag_value, newest = found.pop(flag), found.pop("newest")
            found |= {**newest_outcome_columns(newest), flag: flag_value}
        out |= {name: F.when(present, value) for name, value in found.items()}
    return out


def one_hot(df: DataFrame, column: str, domain: dict[str, object], prefix: str) -> DataFrame:
    """One 0/1 column per value of a fixed domain; all are 0 for any other value."""
    rest = [c for c in df.columns if c != column]
    hot = [
        F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}_{label}")
        for label, v in domain.items()
    ]
    return df.select(*rest, *hot)


def unknown_outcomes(previous: DataFrame) -> DataFrame:
    """How many rows carry an outcome outside the fixed domain, or none at all."""
    known = F.col("NAME_CONTRACT_STATUS").isin(CONTRACT_OUTCOMES)
    return previous.agg(
        A.row_count().alias("n_rows"),
        A.count_where(~F.coalesce(known, F.lit(False))).alias("n_unknown"),
    )


def star_join(base: DataFrame, *histories: DataFrame, key: str = ID_COLUMN) -> DataFrame:
    """Left-join every per-applicant table to the applications.

    Each side holds one row per key and leaves its aggregation already hashed on it, so only the
    applications move again.
    """
    for history in histories:
        base = base.join(history, key, "left")
    return base


def filled_columns(schema: T.StructType, skip: tuple[str, ...] = (ID_COLUMN, LABEL_COLUMN)) -> list[Column]:
    """The projection of ``fill_joined_nulls`` for a table of this schema."""

    def filled(field: T.StructField) -> Column:
        name = f"`{field.name}`"
        if field.name in skip:
            return F.col(name)
        if isinstance(field.dataType, T.NumericType):
            value = F.lit(fill_for_missing_history(field.name)).cast(field.dataType)
            return F.coalesce(F.col(name), value).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.coalesce(F.col(name), F.lit("Missing")).alias(field.name)
        return F.col(name)

    return [filled(f) for f in schema.fields]


def fill_joined_nulls(df: DataFrame, skip: tuple[str, ...] = (ID_COLUMN, LABEL_COLUMN)) -> DataFrame:
    """-1 for ratios and averages, 0 for other numbers, "Missing" for text, in one projection."""
    return df.select(*filled_columns(df.schema, skip))
