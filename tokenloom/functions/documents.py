"""JSON documents written to the target tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.channels import map_install_source
from tokenloom.functions.money import money_minor, parse_credit_limit, parse_salary
from tokenloom.functions.text import ColumnLike, address_detail, as_column, blank_to_null, full_name
from tokenloom.functions.times import date_text, epoch_ms

CONTACTS_TYPE = "array<struct<name:string,mobile:string,relation:int>>"


def _object(**fields: Column | int | None) -> Column:
    """A struct whose fields keep the given order; None becomes a JSON null."""
    parts = []
    for name, value in fields.items():
        column = value if isinstance(value, Column) else F.lit(value)
        if value is None:
            column = column.cast("string")
        parts.append(column.alias(name))
    return F.struct(*parts)


def to_json_text(document: Column) -> Column:
    return F.to_json(document, {"ignoreNullFields": "false"})


def contact_object(name: ColumnLike, mobile: ColumnLike, relation: ColumnLike) -> Column:
    return _object(name=blank_to_null(name), mobile=as_column(mobile), relation=as_column(relation))


def info_json(zone: str, contacts: ColumnLike = "emergency_contacts") -> Column:
    """The profile document of one assembled user row. Its keys and their order."""
    empty = F.from_json(F.lit("[]"), CONTACTS_TYPE)
    registered_s = F.floor(epoch_ms("create_time", zone) / 1000)
    return to_json_text(
        _object(
            birthday=date_text("date_of_birth"),
            job_type=F.col("work_type"),
            education=F.col("education_level"),
            gender=F.col("gender"),
            registration_ip=F.col("registration_ip"),
            salary=parse_salary("monthly_income"),
            loan_purpose=None,
            face_similarity=None,
            pay_cycle=None,
            salary_yearly=None,
            credit_limit=parse_credit_limit("credit_limit"),
            company=blank_to_null("company_name"),
            install_source=map_install_source("tracker_name"),
            registration_time=registered_s,
            email=None,
            ocr=None,
            profession=F.col("occupation"),
            app=_object(name=F.col("app_name"), version=F.col("version"), app_id=F.col("app_code")),
            emergency_contacts=F.coalesce(as_column(contacts), empty),
            salary_day=None,
            address=_object(
                province=F.col("living_address_state"),
                city=F.col("living_address_city"),
                district=None,
                detail=blank_to_null(address_detail("living_address_first_line", "living_address_second_line")),
                village=None,
            ),
            salary_fortnightly=None,
            salary_daily=None,
            salary_monthly=1,
            children_num=F.col("number_of_children"),
            religion=None,
            marital=F.col("marriage"),
            full_name=blank_to_null(full_name("first_name", "sur_name")),
            salary_weekly=None,
            survey=None,
            salary_type=None,
        )
    )


def repayment_plan_json(scale: int = 1) -> Column:
    """The trial repayment plan of one order. Its keys, their order, the zeros."""
    received, repayment = money_minor("received", scale), money_minor("repayment", scale)
    return to_json_text(
        _object(
            roll_sequence=0,
            period=1,
            principal=received,
            disbursed_amount=received,
            interest=0,
            admin_fee=money_minor("poundage", scale),
            service_fee=0,
            tax_fee=0,
            reduction_amount=0,
            total_amount=repayment,
            term=F.coalesce(F.col("period_days"), F.lit(7)),
            start_date=date_text("order_time"),
            due_date=date_text("last_repayment_time"),
            roll_allowed=0,
        )
    )


def merge_contacts(info: ColumnLike, contacts: ColumnLike) -> Column:
    """Puts a contacts array text under ``emergency_contacts`` at the end of an object text."""
    info = blank_to_null(info)
    array = F.coalesce(blank_to_null(contacts), F.lit("[]"))
    entry = F.concat(F.lit('"emergency_contacts":'), array, F.lit("}"))
    body = F.left(info, F.char_length(info) - 1)
    return (
        F.when(info.isNull(), F.concat(F.lit("{"), entry))
        .when(~info.endswith("}"), info)
        .when(body.endswith("{"), F.concat(F.lit("{"), entry))
        .otherwise(F.concat(body, F.lit(","), entry))
    )
