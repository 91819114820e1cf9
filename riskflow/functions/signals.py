"""Row-local fraud signals, as Column expressions.

A flag whose inputs are NULL is False, except `income_realistic`, where nothing
known against an income leaves it True.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def hour_of_day(ts: str = "transaction_ts") -> Column:
    return F.hour(F.col(ts))


def is_weekend(ts: str = "transaction_ts") -> Column:
    """Saturday or Sunday (dayofweek counts from Sunday = 1)."""
    return _flag(F.dayofweek(F.col(ts)).isin(1, 7))


def is_international(
    merchant: str = "merchant_country", billing: str = "billing_country"
) -> Column:
    return _flag(F.col(merchant) != F.col(billing))


def loan_to_income(
    amount: str = "loan_amount_requested", income: str = "stated_income"
) -> Column:
    """Ratio to 4 places; NULL unless the income is positive."""
    a, i = F.col(amount), F.col(income)
    return F.when(i > 0, F.round(a / i, 4))


def income_realistic(
    status: str = "stated_employment_status",
    years: str = "stated_years_employed",
    income: str = "stated_income",
    unemployed_limit: float = 50_000,
    new_job_limit: float = 100_000,
    new_job_years: int = 1,
) -> Column:
    s, y, i = F.col(status), F.col(years), F.col(income)
    doubtful = ((s == "unemployed") & (i > unemployed_limit)) | (
        (y <= new_job_years) & (i > new_job_limit)
    )
    return ~_flag(doubtful)


def payment_shortfall(due: str = "due_amount", paid: str = "paid_amount") -> Column:
    return F.round(F.col(due) - F.col(paid), 2)


def payment_flags(status: str = "payment_status") -> dict[str, Column]:
    s = F.col(status)
    return {
        "is_missed": _flag(s == "missed"),
        "is_partial": _flag(s == "partial"),
        "is_late": _flag(s == "late"),
    }


def age(date_of_birth: str, as_of: Column) -> Column:
    """Whole years from a date of birth to `as_of`."""
    return F.floor(F.months_between(as_of, F.col(date_of_birth)) / 12).cast("int")
