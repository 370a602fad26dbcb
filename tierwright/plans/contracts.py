"""Contracts of the three layers.

The typed contracts derive from the raw ones: same columns, other types, a unique
key.  Uniqueness starts at the typed layer, because removing duplicates is that
layer's job.
"""

from __future__ import annotations

from collections.abc import Sequence

from tierwright.functions import domains as D
from tierwright.operators.contracts import ColumnRule, Contract

MONEY = "decimal(18,2)"


def _rules(names: Sequence[str], nullable: Sequence[str] = ()) -> list[ColumnRule]:
    """Text columns."""
    return [ColumnRule(n, nullable=n in nullable) for n in names]


AUDIT = [
    ColumnRule("_ingested_at", "timestamp"),
    ColumnRule("_source_system"),
    ColumnRule("_batch_id"),
    ColumnRule("_source_row_hash"),
]

# The sources' columns, in their order, and those that may be empty.
CUSTOMER_COLUMNS = (
    "customer_id",
    "id_number",
    "first_name",
    "last_name",
    "dob",
    "gender",
    "province",
    "income_band",
    "segment",
    "risk_score",
    "kyc_status",
    "product_flags",
)

ACCOUNT_COLUMNS = (
    "account_id",
    "customer_ref",
    "account_type",
    "account_status",
    "open_date",
    "product_tier",
    "mobile_number",
    "digital_channel",
    "credit_limit",
    "current_balance",
    "last_activity_date",
)

TRANSACTION_COLUMNS = (
    "transaction_id",
    "account_id",
    "transaction_date",
    "transaction_time",
    "transaction_type",
    "merchant_category",
    "merchant_subcategory",
    "amount",
    "currency",
    "channel",
    "location_province",
    "location_city",
    "location_coordinates",
    "metadata_device_id",
    "metadata_session_id",
    "metadata_retry_flag",
)

RAW_CUSTOMERS = Contract(
    "raw_customers", tuple(_rules(CUSTOMER_COLUMNS) + AUDIT)
)

_account_optional = ("mobile_number", "credit_limit", "last_activity_date")
RAW_ACCOUNTS = Contract(
    "raw_accounts",
    tuple(_rules(ACCOUNT_COLUMNS, _account_optional) + AUDIT),
)

_transaction_optional = (
    "merchant_category",
    "merchant_subcategory",
    "location_province",
    "location_city",
    "location_coordinates",
    "metadata_device_id",
    "metadata_session_id",
)
RAW_TRANSACTIONS = Contract(
    "raw_transactions",
    tuple(_rules(TRANSACTION_COLUMNS, _transaction_optional) + AUDIT),
).derive("raw_transactions", {"metadata_retry_flag": {"type": "boolean"}})

TYPED_CUSTOMERS = RAW_CUSTOMERS.derive(
    "typed_customers",
    {
        "customer_id": {"unique": True},
        "dob": {"type": "date"},
        "risk_score": {"type": "int"},
    },
)

TYPED_ACCOUNTS = RAW_ACCOUNTS.derive(
    "typed_accounts",
    {
        "account_id": {"unique": True},
        "open_date": {"type": "date"},
        "last_activity_date": {"type": "date"},
        "credit_limit": {"type": MONEY},
        "current_balance": {"type": MONEY},
    },
)

_typed_transactions = RAW_TRANSACTIONS.derive(
    "typed_transactions",
    {
        "transaction_id": {"unique": True},
        "transaction_date": {"type": "date"},
        "amount": {"type": MONEY},
        "transaction_type": {"domain": D.TRANSACTION_TYPES},
        "currency": {"domain": (D.CURRENCY,)},
    },
)
TYPED_TRANSACTIONS = Contract(
    "typed_transactions",
    (
        *_typed_transactions.columns,
        ColumnRule("transaction_timestamp", "timestamp_ntz"),
        ColumnRule("dq_flag", nullable=True, domain=D.DQ_CODES),
    ),
)

DIM_CUSTOMERS = Contract(
    "dim_customers",
    (
        ColumnRule("customer_sk", "bigint", unique=True),
        ColumnRule("customer_id", unique=True),
        ColumnRule("gender", domain=D.GENDERS),
        ColumnRule("province", domain=D.PROVINCES),
        ColumnRule("income_band", domain=D.INCOME_BANDS),
        ColumnRule("segment", domain=D.SEGMENTS),
        ColumnRule("risk_score", "int"),
        ColumnRule("kyc_status", domain=D.KYC_STATUSES),
        ColumnRule("age_band", domain=D.AGE_BAND_LABELS),
    ),
    ordered=True,
)

DIM_ACCOUNTS = Contract(
    "dim_accounts",
    (
        ColumnRule("account_sk", "bigint", unique=True),
        ColumnRule("account_id", unique=True),
        ColumnRule("customer_id"),
        ColumnRule("account_type", domain=D.ACCOUNT_TYPES),
        ColumnRule("account_status", domain=D.ACCOUNT_STATUSES),
        ColumnRule("open_date", "date"),
        ColumnRule("product_tier", domain=D.PRODUCT_TIERS),
        ColumnRule("digital_channel", domain=D.DIGITAL_CHANNELS),
        ColumnRule("credit_limit", MONEY, nullable=True),
        ColumnRule("current_balance", MONEY),
        ColumnRule("last_activity_date", "date", nullable=True),
    ),
    ordered=True,
)

FACT_TRANSACTIONS = Contract(
    "fact_transactions",
    (
        ColumnRule("transaction_sk", "bigint", unique=True),
        ColumnRule("transaction_id", unique=True),
        ColumnRule("account_sk", "bigint"),
        ColumnRule("customer_sk", "bigint"),
        ColumnRule("transaction_date", "date"),
        ColumnRule("transaction_timestamp", "timestamp_ntz"),
        ColumnRule("transaction_type", domain=D.TRANSACTION_TYPES),
        ColumnRule("merchant_category", nullable=True, domain=D.MERCHANT_CATEGORIES),
        ColumnRule("merchant_subcategory", nullable=True),
        ColumnRule("amount", MONEY),
        ColumnRule("currency", domain=(D.CURRENCY,)),
        ColumnRule("channel", domain=D.CHANNELS),
        ColumnRule("province", nullable=True, domain=D.PROVINCES),
        ColumnRule("dq_flag", nullable=True, domain=D.DQ_CODES),
        ColumnRule("ingestion_timestamp", "timestamp_ntz"),
    ),
    ordered=True,
)

CURRENT_BALANCES = Contract(
    "current_balances",
    (
        ColumnRule("account_id", unique=True),
        ColumnRule("current_balance", MONEY),
        ColumnRule("last_transaction_timestamp", "timestamp"),
        ColumnRule("updated_at", "timestamp"),
    ),
    ordered=True,
)

RECENT_TRANSACTIONS = Contract(
    "recent_transactions",
    (
        ColumnRule("account_id"),
        ColumnRule("transaction_id"),
        ColumnRule("transaction_timestamp", "timestamp"),
        ColumnRule("amount", MONEY),
        ColumnRule("transaction_type", domain=D.TRANSACTION_TYPES),
        ColumnRule("channel", nullable=True),
        ColumnRule("updated_at", "timestamp"),
    ),
    ordered=True,
)
