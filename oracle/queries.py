"""The SQL of each registered query, over the given tables."""

from __future__ import annotations

from oracle import shapes as S
from tierwright.functions import domains as D
from tierwright.plans import contracts as C

CUST, ACC, TXN = C.CUSTOMER_COLUMNS, C.ACCOUNT_COLUMNS, C.TRANSACTION_COLUMNS
A, X = S.accounts(), S.transactions()
DIRTY_A, DIRTY_X = S.accounts(True), S.transactions(True)
MONEY = "DECIMAL(18,2)"

CURRENCY_KEY = "upper(trim(currency))"
NORMAL_CURRENCY = "'ZAR'"
UNKNOWN_CURRENCY = f"{CURRENCY_KEY} NOT IN ('ZAR', 'R', 'RANDS', '710')"
PROVINCE = (
    "CASE upper(trim(province)) WHEN 'KZN' THEN 'KwaZulu-Natal' WHEN 'WC' THEN 'Western Cape' "
    "WHEN 'GAUTENG' THEN 'Gauteng' ELSE province END"
)


def cols(names, table: str = "") -> str:
    return ", ".join(f"{table}.{n}" if table else n for n in names)


def age(date: str) -> str:
    return f"cast(floor(date_diff('day', dob, DATE '{date}') / 365.25) AS INT)"


def band(years: str) -> str:
    bounds = sorted(D.AGE_BANDS, reverse=True)
    whens = " ".join(f"WHEN {years} >= {low} THEN '{label}'" for low, label in bounds)
    return f"CASE {whens} END"


def rename(names, changes: dict[str, str]) -> str:
    return ", ".join(f"{changes[n]} AS {n}" if n in changes else n for n in names)


# typed layer ----------------------------------------------------------------

FIRST = "row_number() OVER (PARTITION BY {key} ORDER BY _source_row_hash)"

TYPED_CUSTOMERS = f"""{S.CUSTOMERS}, {S.hashed(CUST, "customers", "raw_customers")},
typed_customers AS (
  SELECT {rename(CUST, {"dob": S.parsed("dob"), "risk_score": "cast(risk_score AS INT)",
                        "province": PROVINCE})}, _source_row_hash
  FROM raw_customers)"""

ACCOUNT_TYPES = {
    "mobile_number": "nullif(mobile_number, '')",
    "open_date": S.parsed("open_date"),
    "last_activity_date": S.parsed("last_activity_date"),
    "credit_limit": f"cast(nullif(credit_limit, '') AS {MONEY})",
    "current_balance": f"cast(current_balance AS {MONEY})",
}
TYPED_ACCOUNTS = f"""{A}, {S.hashed(ACC, "accounts", "raw_accounts")},
typed_accounts AS (SELECT {rename(ACC, ACCOUNT_TYPES)}, _source_row_hash FROM raw_accounts)"""

RAW_X = f"{X}, {S.hashed(TXN, 'transactions', 'raw_transactions')}"
WINNERS = f"""{RAW_X}, winners AS (
  SELECT * FROM (SELECT *, {FIRST.format(key="transaction_id")} AS rn,
                   count(*) OVER (PARTITION BY transaction_id) AS copies FROM raw_transactions)
  WHERE rn = 1)"""
TYPED_TRANSACTIONS = f"""{WINNERS}, typed_transactions AS (
  SELECT {rename(TXN, {"transaction_date": S.parsed("transaction_date"),
                       "amount": f"cast(amount AS {MONEY})", "currency": NORMAL_CURRENCY})},
    {S.stamp(S.parsed("transaction_date"), "transaction_time")} AS transaction_timestamp,
    CASE WHEN {UNKNOWN_CURRENCY} THEN 'CURRENCY_VARIANT' END AS dq_flag, _source_row_hash
  FROM winners)"""


# star -----------------------------------------------------------------------


def dim_customers(date: str) -> str:
    return f"""dim_customers AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id, gender, province,
    income_band, segment, risk_score, kyc_status, {band(age(date))} AS age_band
  FROM typed_customers)"""


DIM_ACCOUNTS = """dim_accounts AS (
  SELECT row_number() OVER (ORDER BY account_id) AS account_sk, account_id,
    customer_ref AS customer_id, account_type, account_status, open_date, product_tier,
    digital_channel, credit_limit, current_balance, last_activity_date
  FROM typed_accounts)"""

STAR = f"""{TYPED_CUSTOMERS}, {TYPED_ACCOUNTS}, {TYPED_TRANSACTIONS},
{dim_customers("2026-12-31")}, {DIM_ACCOUNTS},
numbered AS (
  SELECT row_number() OVER (ORDER BY transaction_id) AS transaction_sk, * FROM typed_transactions),
fact AS (
  SELECT transaction_sk, transaction_id, account_sk, customer_sk, transaction_date,
    transaction_timestamp, transaction_type, merchant_category, merchant_subcategory, amount,
    currency, channel, location_province AS province, dq_flag,
    {S.INGESTED} AS ingestion_timestamp
  FROM numbered JOIN (SELECT account_id, account_sk, customer_id FROM dim_accounts) a
    USING (account_id)
  JOIN (SELECT customer_id, customer_sk FROM dim_customers) c USING (customer_id))"""


# data quality ---------------------------------------------------------------

CODES = (
    "NULL_REQUIRED",
    "ORPHANED_ACCOUNT",
    "DUPLICATE_DEDUPED",
    "TYPE_MISMATCH",
    "DATE_FORMAT",
    "CURRENCY_VARIANT",
)
MARKED = f"""{A}, {DIRTY_X.replace("transactions AS", "irregular AS", 1)},
{S.hashed(TXN, "irregular", "raw_irregular")},
marked AS (
  SELECT i.*, ({S.AMOUNT_AS_TEXT} OR TRY_CAST(amount AS {MONEY}) IS NULL) AS is_text,
    TRY_CAST(amount AS {MONEY}) IS NULL AS no_amount,
    try_strptime(transaction_date, '%Y-%m-%d') IS NULL AS odd_date,
    {S.parsed("transaction_date")} IS NULL AS no_date,
    currency <> 'ZAR' AS odd_currency,
    i.account_id NOT IN (SELECT account_id FROM accounts) AS is_orphan
  FROM raw_irregular i),
handled AS (
  SELECT *, CASE WHEN is_orphan OR no_amount OR no_date THEN 'quarantine' ELSE 'load' END AS handling,
    CASE WHEN is_orphan THEN 'ORPHANED_ACCOUNT' WHEN no_amount THEN 'TYPE_MISMATCH'
         WHEN no_date THEN 'DATE_FORMAT' END AS reason
  FROM marked),
survivors AS (
  SELECT *, concat_ws('|', CASE WHEN is_orphan THEN 'ORPHANED_ACCOUNT' END,
      CASE WHEN copies > 1 THEN 'DUPLICATE_DEDUPED' END, CASE WHEN is_text THEN 'TYPE_MISMATCH' END,
      CASE WHEN odd_date THEN 'DATE_FORMAT' END,
      CASE WHEN odd_currency THEN 'CURRENCY_VARIANT' END) AS issues
  FROM (SELECT *, count(*) OVER (PARTITION BY transaction_id) AS copies,
          row_number() OVER (PARTITION BY transaction_id
            ORDER BY handling <> 'load', _source_row_hash) AS rn FROM handled)
  WHERE rn = 1),
issue_counts AS (
  SELECT 'NULL_REQUIRED' AS issue_code, 0 AS records_affected, 'quarantine' AS handling_action
  UNION ALL SELECT 'ORPHANED_ACCOUNT', count(*) FILTER (is_orphan), 'quarantine' FROM marked
  UNION ALL SELECT 'DUPLICATE_DEDUPED', count(*) - count(DISTINCT transaction_id), 'flag' FROM marked
  UNION ALL SELECT 'TYPE_MISMATCH', count(*) FILTER (is_text), 'correct' FROM marked
  UNION ALL SELECT 'DATE_FORMAT', count(*) FILTER (odd_date), 'correct' FROM marked
  UNION ALL SELECT 'CURRENCY_VARIANT', count(*) FILTER (odd_currency), 'correct' FROM marked)"""

TERMINAL = "CASE WHEN channel = 'ATM' THEN metadata_session_id END"
STREAM = f"""{S.EVENTS}, known AS (
  SELECT e.* FROM stream_events e JOIN stream_accounts a USING (account_id))"""


def with_(cte: str, select: str) -> str:
    return f"WITH {cte}\n{select}"


def domain(table: str, column: str, expected) -> str:
    values = ", ".join(f"('{v}')" for v in expected)
    return f"""SELECT '{column}' AS column_name, coalesce(value, wanted) AS value,
  CASE WHEN n IS NULL THEN 'missing' ELSE 'unexpected' END AS status,
  cast(coalesce(n, 0) AS BIGINT) AS row_count
FROM (SELECT {column} AS value, count(*) AS n FROM {table} GROUP BY 1) v
FULL JOIN (VALUES {values}) w(wanted) ON value = wanted
WHERE value IS NULL OR wanted IS NULL"""


def nulls(table: str, names) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{n}' AS column_name, "
        f"count(*) - count({n}) AS nulls, count(*) AS row_count FROM {table}"
        for n in names
    )


def violations(contract: str, table: str, required, unique, domains: dict) -> str:
    rows = [(n, "not_null", f"count(*) - count({n})") for n in required]
    for column, values in domains.items():
        listed = ", ".join(f"'{v}'" for v in values)
        rows.append((column, "domain", f"count(*) FILTER ({column} NOT IN ({listed}))"))
    parts = [
        f"SELECT '{contract}' AS contract, '{c}' AS column_name, '{r}' AS rule, "
        f"{n} AS violations FROM {table}"
        for c, r, n in rows
    ]
    for column in unique:
        parts.append(
            f"SELECT '{contract}', '{column}', 'unique', cast(coalesce(sum(n), 0) AS BIGINT) "
            f"FROM (SELECT count({column}) AS n FROM {table} GROUP BY {column}) WHERE n > 1"
        )
    return "\nUNION ALL ".join(parts)


def dense(table: str, key: str) -> str:
    return f"""SELECT '{key}' AS key_name, TRUE AS is_bigint, count(*) AS row_count,
  count(*) - count({key}) AS nulls, cast(count(*) - count(DISTINCT {key}) AS BIGINT) AS repeated,
  min({key}) AS lowest, max({key}) AS highest,
  min({key}) = 1 AND max({key}) = count(*) AND count(DISTINCT {key}) = count(*) AS holds
FROM {table}"""


AUDIT = f"{S.INGESTED} AS _ingested_at, '{{system}}' AS _source_system, '{S.BATCH_ID}' AS _batch_id"
FULL_NULLS = {n: f"nullif({n}, '')" for n in ("mobile_number", "credit_limit", "last_activity_date")}

SQL: dict[str, str] = {}

# An empty CSV field reads as NULL, and is hashed as NULL.
SQL["csv_bronze"] = with_(
    f"{A}, read AS (SELECT {rename(ACC, FULL_NULLS)} FROM accounts), {S.hashed(ACC, 'read', 'raw')}",
    f"SELECT {cols(ACC)}, {AUDIT.format(system='fintech_accounts')}, _source_row_hash FROM raw",
)
SQL["jsonl_bronze"] = with_(
    RAW_X,
    f"SELECT {cols(TXN)}, {AUDIT.format(system='fintech_events')}, _source_row_hash "
    "FROM raw_transactions",
)
SQL["missing_key_null"] = with_(
    X,
    "\nUNION ALL ".join(
        f"SELECT merchant_category, '{o}' AS origin, count(*) AS row_count, "
        "count(*) AS null_subcategories FROM transactions GROUP BY 1"
        for o in ("json", "table")
    ),
)
SQL["empty_source_guard"] = with_(
    X,
    f"""SELECT 'transactions' AS source, count(*) AS row_count, TRUE AS passes FROM transactions
UNION ALL SELECT 'negative_transactions', count(*), FALSE FROM transactions
WHERE cast(amount AS {MONEY}) < 0""",
)
SQL["layer_scan_pruned"] = with_(
    X, f"SELECT transaction_id, channel, cast(amount AS {MONEY}) AS amount FROM transactions"
)
SQL["row_counts"] = with_(
    f"{S.CUSTOMERS}, {A}, {X}",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("customers", "accounts", "transactions")
    ),
)
SQL["write_roundtrip"] = with_(TYPED_ACCOUNTS, f"SELECT {cols(ACC)} FROM typed_accounts")
_EMPTY_TYPES = {
    "transaction_date": "date",
    "amount": "decimal(18,2)",
    "metadata_retry_flag": "boolean",
}
SQL["write_empty"] = with_(
    X,
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS column_name, '{_EMPTY_TYPES.get(n, 'string')}' AS data_type, "
        f"count(*) AS row_count FROM transactions WHERE cast(amount AS {MONEY}) < 0"
        for n in TXN
    ),
)
SQL["write_partitioned"] = with_(
    X, "SELECT transaction_id, amount, transaction_type, location_province FROM transactions"
)
SQL["cast_to_schema"] = with_(
    X,
    f"""SELECT transaction_id, {S.parsed("transaction_date")} AS transaction_date,
  cast(amount AS {MONEY}) AS amount, metadata_retry_flag, {S.INGESTED} AS _ingested_at
FROM transactions""",
)
SQL["quarantine_split"] = with_(
    MARKED,
    "SELECT 'transactions' AS source, reason, transaction_id, account_id FROM survivors "
    "WHERE handling <> 'load'",
)
SQL["audit_columns"] = with_(
    TYPED_CUSTOMERS,
    f"SELECT customer_id, {AUDIT.format(system='bank_crm')}, _source_row_hash FROM raw_customers",
)
SQL["row_hash"] = with_(
    RAW_X,
    """SELECT transaction_id, min(_source_row_hash) AS lowest_hash,
  count(DISTINCT _source_row_hash) AS distinct_rows, count(*) AS row_count
FROM raw_transactions GROUP BY 1""",
)
SQL["flatten_struct"] = """SELECT event_id, cast(json_extract_string(props, '$.k') AS INT) AS props_k,
  user_id AS user_id, event_type AS user_seen_event_type FROM events"""
SQL["utc_retag"] = "SELECT event_id, epoch_us(ts) AS micros, ts FROM events"
SQL["table_profile"] = with_(
    TYPED_ACCOUNTS, f"SELECT {cols(ACC)} FROM typed_accounts ORDER BY account_id LIMIT 5"
)

SQL["empty_to_null"] = with_(
    A,
    """SELECT account_id, nullif(mobile_number, '') AS mobile_number,
  nullif(credit_limit, '') AS credit_limit, nullif(last_activity_date, '') AS last_activity_date
FROM accounts""",
)
SQL["parse_dates"] = with_(
    DIRTY_X,
    f"""SELECT transaction_date AS date_text, {S.parsed("transaction_date")} AS parsed,
  count(*) AS row_count FROM transactions GROUP BY 1, 2""",
)
SQL["combine_ts"] = with_(
    DIRTY_X,
    f"""SELECT transaction_id, transaction_date,
  {S.stamp(S.parsed("transaction_date"), "transaction_time")} AS transaction_timestamp
FROM transactions""",
)
SQL["currency_norm"] = with_(
    X,
    f"SELECT currency AS raw_currency, {NORMAL_CURRENCY} AS currency, count(*) AS row_count "
    "FROM transactions GROUP BY 1, 2",
)
SQL["province_alias"] = with_(
    S.CUSTOMERS,
    f"SELECT customer_id, province AS raw_province, {PROVINCE} AS province FROM customers",
)
SQL["typed_casts"] = with_(
    f"{DIRTY_X}, {S.CUSTOMERS}",
    f"""SELECT transaction_id, TRY_CAST(amount AS {MONEY}) AS amount FROM transactions
UNION ALL SELECT 'c-' || customer_id, cast(cast(risk_score AS INT) AS {MONEY}) FROM customers""",
)
SQL["age_band"] = with_(
    TYPED_CUSTOMERS,
    f"""SELECT customer_id, {age("2025-12-31")} AS age, {band(age("2025-12-31"))} AS age_band
FROM typed_customers""",
)

SQL["orphan_accounts"] = with_(
    f"{DIRTY_A}, {S.CUSTOMERS}",
    """SELECT account_id, customer_ref FROM accounts a WHERE NOT EXISTS (
  SELECT 1 FROM customers c WHERE c.customer_id = a.customer_ref)""",
)
SQL["orphan_transactions"] = with_(
    f"{DIRTY_X}, {A}",
    """SELECT transaction_id, account_id FROM transactions t WHERE NOT EXISTS (
  SELECT 1 FROM accounts a WHERE a.account_id = t.account_id)""",
)
_RATE = """SELECT '{relation}' AS relation, count(*) FILTER (p.id IS NULL) AS orphans,
  count(*) AS total, 100.0::DOUBLE * count(*) FILTER (p.id IS NULL) / greatest(count(*), 1)
    AS orphan_pct
FROM {child} c LEFT JOIN (SELECT DISTINCT {key} AS id FROM {parent} WHERE {key} IS NOT NULL) p
  ON c.{fk} = p.id"""
SQL["orphan_rate"] = with_(
    f"{DIRTY_A}, {DIRTY_X}, {S.CUSTOMERS}",
    _RATE.format(
        relation="accounts.customer_ref",
        child="accounts",
        fk="customer_ref",
        parent="customers",
        key="customer_id",
    )
    + "\nUNION ALL "
    + _RATE.format(
        relation="transactions.account_id",
        child="transactions",
        fk="account_id",
        parent="accounts",
        key="account_id",
    ),
)
SQL["q2_unlinked"] = with_(
    STAR,
    """SELECT count(*) AS unlinked_accounts FROM dim_accounts a
LEFT JOIN dim_customers c ON a.customer_id = c.customer_id WHERE c.customer_id IS NULL""",
)
SQL["q3_province"] = with_(
    STAR,
    """SELECT c.province, count(DISTINCT a.account_id) AS account_count FROM dim_accounts a
JOIN dim_customers c ON a.customer_id = c.customer_id GROUP BY c.province ORDER BY c.province""",
)
SQL["fk_check"] = with_(
    STAR,
    """SELECT 'fact.account_sk' AS relation, count(*) AS orphans FROM fact
WHERE account_sk NOT IN (SELECT account_sk FROM dim_accounts)
UNION ALL SELECT 'fact.customer_sk', count(*) FROM fact
WHERE customer_sk NOT IN (SELECT customer_sk FROM dim_customers)
UNION ALL SELECT 'accounts.customer_id', count(*) FROM dim_accounts
WHERE customer_id NOT IN (SELECT customer_id FROM dim_customers)""",
)
SQL["province_consistency"] = with_(
    STAR,
    """SELECT c.province, count(*) AS facts, count(*) FILTER (f.province <> c.province) AS mismatches
FROM fact f JOIN dim_customers c USING (customer_sk) GROUP BY c.province""",
)

SQL["q1_volume"] = with_(
    STAR,
    """SELECT transaction_type, count(*) AS record_count,
  cast(sum(amount) AS DECIMAL(28,2)) AS total_amount,
  cast(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS DOUBLE) AS pct_of_total
FROM fact GROUP BY transaction_type ORDER BY transaction_type""",
)
SQL["dedup_stats"] = with_(
    f"{S.CUSTOMERS}, {A}, {X}",
    "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows_in, count(DISTINCT {k}) AS rows_out, "
        f"count(*) - count(DISTINCT {k}) AS duplicates_removed FROM {t}"
        for t, k in (
            ("customers", "customer_id"),
            ("accounts", "account_id"),
            ("transactions", "transaction_id"),
        )
    ),
)
SQL["null_profile"] = with_(
    f"{DIRTY_X}, {DIRTY_A}", nulls("transactions", TXN) + "\nUNION ALL " + nulls("accounts", ACC)
)
SQL["unique_check"] = with_(
    f"{S.CUSTOMERS}, {A}, {X}",
    "\nUNION ALL ".join(
        f"SELECT '{k}' AS column_name, count(*) AS row_count, count(DISTINCT {k}) AS distinct_values, "
        f"count(*) = count(DISTINCT {k}) AS is_unique FROM {t}"
        for t, k in (
            ("customers", "customer_id"),
            ("accounts", "account_id"),
            ("transactions", "transaction_id"),
        )
    ),
)
SQL["domain_check"] = with_(
    f"{X}, {S.CUSTOMERS}",
    "\nUNION ALL ".join(
        (
            domain("transactions", "transaction_type", (*D.TRANSACTION_TYPES, "TRANSFER")),
            domain("transactions", "merchant_category", D.MERCHANT_CATEGORIES),
            domain("transactions", "currency", (D.CURRENCY,)),
            domain("customers", "province", D.PROVINCES),
        )
    ),
)
SQL["tolerance_check"] = with_(
    WINNERS,
    """SELECT a.transaction_type, a.n AS actual_value, e.n AS expected_value,
  abs(a.n - e.n) <= 0.25 * e.n AS "within"
FROM (SELECT transaction_type, count(*) AS n FROM winners GROUP BY 1) a
JOIN (SELECT transaction_type, count(*) AS n FROM transactions GROUP BY 1) e USING (transaction_type)""",
)

SQL["surrogate_key"] = with_(
    A, "SELECT row_number() OVER (ORDER BY account_id) AS account_sk, account_id FROM accounts"
)
SQL["surrogate_key_hash"] = with_(
    A,
    "SELECT cast(cast('0x' || substr(sha256(account_id), 1, 16) AS UBIGINT) % 9223372036854775808 "
    "AS BIGINT) AS account_sk, account_id "
    "FROM accounts",
)
SQL["sk_contract"] = with_(
    STAR,
    "\nUNION ALL ".join(
        (
            dense("dim_customers", "customer_sk"),
            dense("dim_accounts", "account_sk"),
            dense("fact", "transaction_sk"),
        )
    ),
)
SQL["dedup_first"] = with_(
    WINNERS, "SELECT transaction_id, _source_row_hash, transaction_date, amount FROM winners"
)
SQL["dedup_losers"] = with_(
    RAW_X,
    f"""SELECT transaction_id, transaction_date, amount, _source_row_hash, count(*) AS copies
FROM (SELECT *, {FIRST.format(key="transaction_id")} AS rn FROM raw_transactions)
WHERE rn > 1 GROUP BY 1, 2, 3, 4""",
)
SQL["recent_50"] = """SELECT user_id, event_id, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events)
WHERE rn <= 50"""

SQL["silver_customers"] = with_(
    TYPED_CUSTOMERS, f"SELECT {cols(CUST)}, _source_row_hash FROM typed_customers"
)
SQL["silver_accounts"] = with_(
    TYPED_ACCOUNTS, f"SELECT {cols(ACC)}, _source_row_hash FROM typed_accounts"
)
SQL["silver_transactions"] = with_(
    TYPED_TRANSACTIONS,
    f"SELECT {cols(TXN)}, transaction_timestamp, dq_flag, _source_row_hash FROM typed_transactions",
)
SQL["dim_customers"] = with_(
    f"{TYPED_CUSTOMERS}, {dim_customers('2025-12-31')}", "SELECT * FROM dim_customers"
)
SQL["dim_accounts"] = with_(f"{TYPED_ACCOUNTS}, {DIM_ACCOUNTS}", "SELECT * FROM dim_accounts")
SQL["fact_star"] = with_(STAR, "SELECT * FROM fact")
SQL["layers_end_to_end"] = with_(
    STAR,
    "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, "
        f"(SELECT count(*) FROM {source}) AS rows_in, (SELECT count(*) FROM {result}) AS rows_out"
        for layer, name, source, result in (
            ("raw", "customers", "customers", "customers"),
            ("raw", "accounts", "accounts", "accounts"),
            ("raw", "transactions", "transactions", "transactions"),
            ("typed", "customers", "customers", "typed_customers"),
            ("typed", "accounts", "accounts", "typed_accounts"),
            ("typed", "transactions", "transactions", "typed_transactions"),
            ("star", "dim_customers", "typed_customers", "dim_customers"),
            ("star", "dim_accounts", "typed_accounts", "dim_accounts"),
            ("star", "fact_transactions", "typed_transactions", "fact"),
        )
    ),
)

_AUDIT_NAMES = ["_ingested_at", "_source_system", "_batch_id", "_source_row_hash"]
_REQUIRED_ACC = [
    n for n in ACC if n not in ("mobile_number", "credit_limit", "last_activity_date")
]
_OPTIONAL_TXN = (
    "merchant_subcategory location_province location_city location_coordinates metadata_device_id "
    "metadata_session_id"
).split()
_WITH_AUDIT = ", 'x' AS _ingested_at, 'x' AS _source_system, 'x' AS _batch_id"
SQL["contract_check"] = with_(
    f"""{DIRTY_A}, {S.hashed(ACC, "accounts", "hashed_accounts")}, {RAW_X},
audited_accounts AS (SELECT *{_WITH_AUDIT} FROM hashed_accounts),
audited_transactions AS (SELECT *{_WITH_AUDIT} FROM raw_transactions)""",
    violations("accounts", "audited_accounts", _REQUIRED_ACC + _AUDIT_NAMES, ["account_id"], {})
    + "\nUNION ALL "
    + violations(
        "transactions",
        "audited_transactions",
        [n for n in TXN if n not in _OPTIONAL_TXN] + _AUDIT_NAMES,
        ["transaction_id"],
        {"currency": ("ZAR",)},
    ),
)
_TYPED_ACC = {
    "open_date": "date",
    "last_activity_date": "date",
    "credit_limit": "decimal(18,2)",
    "current_balance": "decimal(18,2)",
}


def _schema_lines() -> str:
    parts = []
    for n in ACC:
        want = _TYPED_ACC.get(n, "string")
        if n == "product_tier":
            parts.append((n, f"'{want}'", "cast(NULL AS VARCHAR)", "missing", "NULL"))
        else:
            status = "ok" if want == "string" else "type"
            parts.append((n, f"'{want}'", "'string'", status, f"count(*) - count({n})"))
    parts.append(
        ("tier", "cast(NULL AS VARCHAR)", "'string'", "unexpected", "count(*) - count(product_tier)")
    )
    for n in _AUDIT_NAMES:
        kind = "timestamp" if n == "_ingested_at" else "string"
        parts.append((n, f"'{kind}'", "cast(NULL AS VARCHAR)", "missing", "NULL"))
    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS column_name, {want} AS expected_type, {have} AS actual_type, "
        f"'{status}' AS status, cast({count} AS BIGINT) AS nulls FROM accounts"
        + ("" if "count" in count else " LIMIT 1")
        for n, want, have, status, count in parts
    )


SQL["schema_diff"] = with_(
    DIRTY_A,
    "\nUNION ALL ".join(f"SELECT * FROM ({p})" for p in _schema_lines().split("\nUNION ALL ")),
)
SQL["drift_strict"] = with_(
    X,
    f"SELECT 'terminal' AS unknown_key, count({TERMINAL}) AS row_count, TRUE AS stopped "
    "FROM transactions",
)
SQL["drift_quarantine"] = with_(
    X,
    """SELECT 'transactions' AS source, 'UNKNOWN_COLUMNS' AS reason, transaction_id,
  CASE channel WHEN 'ATM' THEN 'terminal' WHEN 'POS' THEN 'location.suburb' ELSE 'location[0].suburb' END AS path,
  '"' || metadata_session_id || '"' AS json
FROM transactions WHERE channel IN ('ATM', 'POS', 'EFT')
UNION ALL SELECT 'transactions', 'IN_BAND', transaction_id, NULL, NULL FROM transactions""",
)
SQL["drift_autoevolve"] = with_(
    X,
    f"SELECT channel, 2 * count(*) AS row_count, count({TERMINAL}) AS with_terminal "
    "FROM transactions GROUP BY 1",
)

SQL["dq_type_mismatch"] = with_(
    X,
    f"SELECT transaction_id, cast(amount AS {MONEY}) AS amount, {S.AMOUNT_AS_TEXT} AS amount_is_text "
    "FROM transactions",
)
SQL["dq_orphan"] = with_(
    f"{DIRTY_X}, {A}",
    """SELECT transaction_id, t.account_id,
  CASE WHEN a.account_id IS NULL THEN 'ORPHANED_ACCOUNT' END AS dq_flag
FROM transactions t LEFT JOIN accounts a ON t.account_id = a.account_id""",
)
SQL["dq_duplicate"] = with_(
    WINNERS,
    """SELECT transaction_id, _source_row_hash, copies,
  CASE WHEN copies > 1 THEN 'DUPLICATE_DEDUPED' END AS dq_flag FROM winners""",
)
SQL["dq_date_format"] = with_(
    DIRTY_X,
    f"""SELECT transaction_id, transaction_date, {S.parsed("transaction_date")} AS parsed,
  {S.parsed("transaction_date")} IS NULL AS unfixable
FROM transactions WHERE try_strptime(transaction_date, '%Y-%m-%d') IS NULL""",
)
SQL["dq_currency"] = with_(
    X,
    f"SELECT transaction_id, currency AS raw_currency, {NORMAL_CURRENCY} AS currency "
    "FROM transactions WHERE currency <> 'ZAR'",
)
SQL["dq_null_required"] = with_(
    DIRTY_A,
    "SELECT customer_ref, open_date, current_balance, 'NULL_REQUIRED' AS reason FROM accounts "
    "WHERE account_id IS NULL OR customer_ref IS NULL",
)
SQL["dq_apply"] = with_(
    MARKED,
    """SELECT transaction_id, _source_row_hash, handling, reason,
  nullif(split_part(issues, '|', 1), '') AS dq_flag, issues FROM survivors""",
)
SQL["row_conservation"] = with_(
    MARKED,
    """SELECT (SELECT count(*) FROM marked) AS rows_in, count(*) FILTER (handling = 'load') AS loaded,
  count(*) FILTER (handling = 'quarantine') AS quarantined, cast(0 AS BIGINT) AS rejected,
  (SELECT count(*) FROM marked) - count(*) AS deduped, TRUE AS conserved FROM survivors""",
)
SQL["dq_report"] = with_(
    MARKED,
    """SELECT issue_code, records_affected, handling_action,
  100.0::DOUBLE * records_affected / (SELECT count(*) FROM marked) AS pct_of_total FROM issue_counts""",
)
SQL["dq_thresholds"] = with_(
    MARKED,
    """SELECT issue_code, records_affected,
  CASE WHEN records_affected > 0.50 * n THEN 'fail' WHEN records_affected > 0.05 * n THEN 'warn'
       ELSE 'ok' END AS level
FROM issue_counts, (SELECT count(*) AS n FROM marked)""",
)
# Rows that only a contract refuses, with the column and rule of each breach in the order of the contracts.
# An unquoted amount of a JSON line arrives as the shortest text of its number.
BROKEN = f"""{S.accounts(dirty=True, broken=True)}, {S.BROKEN_CUSTOMERS},
good_customers AS (SELECT customer_id FROM customers WHERE gender <> '?'),
placed_accounts AS (
  SELECT *, concat_ws(',', CASE WHEN account_id IS NULL THEN 'account_id:not_null' END,
      CASE WHEN account_status = 'FROZEN' THEN 'account_status:domain' END) AS breaches
  FROM accounts),
linked AS (SELECT account_id FROM placed_accounts
  WHERE breaches = '' AND customer_ref IN (SELECT customer_id FROM good_customers)),
{S.transactions(dirty=True, name="irregular", broken=True)},
arrived AS (
  SELECT * REPLACE (CASE WHEN {S.AMOUNT_AS_TEXT} OR TRY_CAST(amount AS {MONEY}) IS NULL THEN amount
    ELSE cast(cast(amount AS DOUBLE) AS VARCHAR) END AS amount) FROM irregular),
{S.hashed(TXN, "arrived", "raw_irregular")},
marked AS (
  SELECT i.*, TRY_CAST(amount AS {MONEY}) IS NULL AS no_amount, {S.parsed("transaction_date")} IS NULL AS no_date,
    i.account_id NOT IN (SELECT account_id FROM linked) AS is_orphan
  FROM raw_irregular i),
handled AS (
  SELECT *, concat_ws(',', CASE WHEN no_date THEN 'transaction_date:not_null' END,
      CASE WHEN transaction_type = 'GIFT' THEN 'transaction_type:domain' END,
      CASE WHEN no_amount THEN 'amount:not_null' END, CASE WHEN channel IS NULL THEN 'channel:not_null' END,
      CASE WHEN metadata_retry_flag IS NULL THEN 'metadata_retry_flag:not_null' END,
      CASE WHEN no_date OR transaction_time = '9am' THEN 'transaction_timestamp:not_null' END,
      CASE WHEN location_province = 'Atlantis' THEN 'province:domain' END) AS breaches
  FROM marked),
reasoned AS (
  SELECT *, CASE WHEN is_orphan THEN 'ORPHANED_ACCOUNT' WHEN no_amount THEN 'TYPE_MISMATCH'
      WHEN no_date THEN 'DATE_FORMAT' WHEN breaches <> '' THEN 'CONTRACT_BREACH' END AS reason
  FROM handled),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY reason IS NOT NULL, _source_row_hash) AS rn FROM reasoned)"""
SQL["dq_end_to_end"] = with_(
    BROKEN,
    """SELECT 'customers' AS source, 'CONTRACT_BREACH' AS reason, 'gender:domain' AS breaches,
  count(*) AS row_count FROM customers WHERE gender = '?' HAVING count(*) > 0
UNION ALL SELECT 'accounts', CASE WHEN account_id IS NULL THEN 'NULL_REQUIRED' ELSE 'CONTRACT_BREACH' END,
  breaches, count(*) FROM placed_accounts WHERE breaches <> '' GROUP BY 2, 3
UNION ALL SELECT 'accounts', 'ORPHANED_ACCOUNT', '', count(*) FROM placed_accounts
WHERE breaches = '' AND customer_ref NOT IN (SELECT customer_id FROM good_customers)
UNION ALL SELECT 'transactions', reason, breaches, count(*) FROM ranked
WHERE rn = 1 AND reason IS NOT NULL GROUP BY 2, 3
UNION ALL SELECT 'transactions', 'DUPLICATE_DEDUPED', breaches, count(*) FROM ranked WHERE rn > 1 GROUP BY 3
UNION ALL SELECT 'fact_transactions', 'LOADED', '', count(*) FROM ranked WHERE rn = 1 AND reason IS NULL""",
)
SQL["dq_reconcile"] = with_(
    MARKED,
    """SELECT 'fact_transactions' AS source, count(*) AS flagged_count FROM survivors
WHERE handling = 'load' AND issues <> ''
UNION ALL SELECT 'clean_records', count(*) FROM survivors WHERE handling = 'load' AND issues = ''
ORDER BY source""",
)

_REDELIVERED = "SELECT * FROM stream_events WHERE transaction_type = 'CREDIT'"
_ARRIVED = f"arrived AS (SELECT * FROM stream_events UNION ALL {_REDELIVERED})"
SQL["stream_source"] = with_(
    f"{S.EVENTS}, {_ARRIVED}",
    """SELECT account_id, transaction_id, transaction_timestamp, amount, transaction_type,
  cast(NULL AS VARCHAR) AS channel FROM arrived""",
)
SQL["stream_balances"] = with_(
    STREAM,
    f"""SELECT account_id, cast(any_value(opening) + sum(CASE WHEN transaction_type IN
    ('CREDIT', 'REVERSAL') THEN amount ELSE -amount END) AS {MONEY}) AS current_balance,
  max(transaction_timestamp) AS last_transaction_timestamp
FROM known JOIN stream_accounts USING (account_id) GROUP BY account_id""",
)
SQL["stream_recent"] = with_(
    STREAM,
    """SELECT account_id, transaction_id, transaction_timestamp, amount, transaction_type,
  cast(NULL AS VARCHAR) AS channel
FROM (SELECT *, row_number() OVER (PARTITION BY account_id
        ORDER BY transaction_timestamp DESC, transaction_id) AS rn FROM known)
WHERE rn <= 50""",
)
SQL["stream_dedup"] = with_(
    f"{S.EVENTS}, {_ARRIVED}",
    """SELECT transaction_type, count(*) AS arrived, count(DISTINCT transaction_id) AS applied
FROM arrived GROUP BY 1""",
)
SQL["stream_orphans"] = with_(
    S.EVENTS,
    """SELECT transaction_id, account_id, amount, 'ORPHANED_ACCOUNT' AS reason FROM stream_events
WHERE account_id NOT IN (SELECT account_id FROM stream_accounts)""",
)
SQL["stream_sla"] = with_(
    S.EVENTS,
    """SELECT CASE WHEN 10 * k <= 300 THEN 'full' WHEN 10 * k <= 600 THEN 'partial' ELSE 'none' END
  AS tier, count(*) AS row_count FROM stream_events GROUP BY 1""",
)
