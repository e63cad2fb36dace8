"""Document numbers, status codes and fixed documents of the target model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.money import money_value
from tokenloom.functions.text import ColumnLike, as_column

# Kinds of tokenised value and their codes.
VT_TYPES = {
    "mobile": 1,
    "gaid_idfa": 2,
    "bank_account": 3,
    "id_number": 4,
    "emergency_contact": 5,
    "id2": 6,
}

# States of a dictionary row.
PENDING, OK, FAILED, CLAIMED = 0, 1, 2, 9

# Risk order status -> application status; status 10 depends on overdue.
APPLICATION_STATUS = {2: 3, 4: 5, 6: 13, 8: 15, 11: 23, 40: 25, 20: 27, 30: 27, 50: 27}
APPLICATION_STATUS_DEFAULT = 1
# Risk order status -> loan status; status 10 depends on overdue and amount repaid.
LOAN_STATUS = {11: 23, 40: 25, 20: 27, 30: 27, 50: 27}
LOAN_STATUS_DEFAULT = 20
OVERDUE_STATUS, RUNNING_STATUS, PART_PAID_STATUS = 23, 20, 24

# Risk order statuses of orders that never became loans.
NOT_A_LOAN = (0, 2, 4, 6, 8)

# Product documents of the target model.
PRODUCT_SCHEMES = (
    '{"repayment_method":1,"interest_start":"next_day","term":7,"periods":1,"periods_days":[7],'
    '"param_tpl":{"aha":0.5,"interest_rate":0,"penalty_rate":0.05,"post_paid_rate":0,'
    '"reduction_rate":0,"roll_allowed":0,"roll_due_method":1,"rollover_rate":0,'
    '"service_fee_rate":0,"tax_fee_rate":0,"upfront_rate":0.35,"value_date":0}}'
)
SCHEME_RATES = '{"penalty_rate":0.05,"upfront_rate":0.35,"interest_rate":0,"post_paid_rate":0.05}'
SCHEME_ID = "PROD-002-D7"
BUSINESS_LINE = "ng01"


def application_no(app_code: ColumnLike, order_no: ColumnLike) -> Column:
    return F.concat(F.lit("ng0"), F.trim(as_column(app_code).cast("string")), F.lit("-"), as_column(order_no))


def loan_no(order_no: ColumnLike, period: ColumnLike, roll: ColumnLike | int = 0) -> Column:
    roll = F.lit(roll) if isinstance(roll, int) else as_column(roll)
    period = F.coalesce(as_column(period), F.lit(1))
    return F.concat(
        F.lit("ng-"),
        as_column(order_no),
        F.lit("-"),
        F.lpad(period.cast("string"), 2, "0"),
        F.lpad(F.coalesce(roll, F.lit(0)).cast("string"), 3, "0"),
    )


def _from_table(status: Column, table: dict[int, int], start: Column | None = None) -> Column:
    result = F if start is None else start
    for code, mapped in table.items():
        result = result.when(status == code, mapped)
    return result


def application_risk_status(status: ColumnLike, is_overdue: ColumnLike) -> Column:
    status, overdue = as_column(status), as_column(is_overdue) == 1
    running = F.when(overdue, OVERDUE_STATUS).otherwise(RUNNING_STATUS)
    mapped = _from_table(status, APPLICATION_STATUS, F.when(status == 10, running))
    return mapped.otherwise(APPLICATION_STATUS_DEFAULT).cast("int")


def loan_status(status: ColumnLike, is_overdue: ColumnLike, repaid: ColumnLike) -> Column:
    status, overdue = as_column(status), as_column(is_overdue) == 1
    running = (
        F.when(overdue, OVERDUE_STATUS)
        .when(money_value(repaid) == 0, RUNNING_STATUS)
        .otherwise(PART_PAID_STATUS)
    )
    mapped = _from_table(status, LOAN_STATUS, F.when(status == 10, running))
    return mapped.otherwise(LOAN_STATUS_DEFAULT).cast("int")


def vt_type_name(code: ColumnLike) -> Column:
    code = as_column(code)
    result = F
    for name, number in VT_TYPES.items():
        result = result.when(code == number, name)
    return result.otherwise(code.cast("string"))


def vt_type_code(name: ColumnLike) -> Column:
    name = as_column(name)
    result = F
    for text, number in VT_TYPES.items():
        result = result.when(name == text, number)
    return result.cast("int")
