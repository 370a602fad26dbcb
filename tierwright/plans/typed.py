"""Raw -> typed: dates, exact decimals, codes, one row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwright.functions import domains as D
from tierwright.functions.values import (
    code_is_unknown,
    combine_timestamp,
    empty_to_null,
    money,
    normalize_code,
    parse_date,
)
from tierwright.operators.dedup import DEFAULT_ORDER, keep_first


def typed_customers(
    raw: DataFrame,
    formats: Sequence[str] = D.DATE_FORMATS,
    province_aliases: Mapping[str, str] | None = None,
    order: Sequence[Column | str] = DEFAULT_ORDER,
) -> DataFrame:
    changes = {
        "dob": parse_date("dob", formats),
        "risk_score": F.col("risk_score").cast("int"),
    }
    if province_aliases:
        changes["province"] = normalize_code("province", province_aliases)
    return keep_first(raw, ["customer_id"], order).withColumns(changes)


def typed_accounts(
    raw: DataFrame,
    formats: Sequence[str] = D.DATE_FORMATS,
    order: Sequence[Column | str] = DEFAULT_ORDER,
) -> DataFrame:
    return keep_first(raw, ["account_id"], order).withColumns(
        {
            "mobile_number": empty_to_null("mobile_number"),
            "open_date": parse_date("open_date", formats),
            "last_activity_date": parse_date("nullif(last_activity_date, '')", formats),
            "credit_limit": money(empty_to_null("credit_limit")),
            "current_balance": money("current_balance"),
        }
    )


def typed_transactions(
    raw: DataFrame,
    formats: Sequence[str] = D.DATE_FORMATS,
    currency_codes: Mapping[str, str] = D.CURRENCY_CODES,
    currency: str = D.CURRENCY,
    order: Sequence[Column | str] = DEFAULT_ORDER,
    strict_amounts: bool = True,
    province_aliases: Mapping[str, str] | None = None,
    placed_by: Sequence[str] = (),
) -> DataFrame:
    """Losing duplicates are dropped on the raw text, so only winners are parsed.

    The timestamp is built from the parsed date, so every accepted date format
    has one.  A currency outside ``currency_codes`` is coerced and flagged.
    ``placed_by`` are columns that follow from the id and by which the rows already lie.
    """
    winners = keep_first(raw, [*placed_by, "transaction_id"], order)
    if province_aliases:
        winners = winners.withColumn("location_province", normalize_code("location_province", province_aliases))
    return (
        winners.withColumns(
            {
                "dq_flag": F.when(
                    code_is_unknown("currency", currency_codes), "CURRENCY_VARIANT"
                ),
                "transaction_date": parse_date("transaction_date", formats),
                "amount": money("amount", strict=strict_amounts),
                "currency": normalize_code("currency", currency_codes, currency),
            }
        ).withColumn(
            "transaction_timestamp", combine_timestamp("transaction_date", "transaction_time")
        )
    )
