"""SQL forms of the source shapes, as common table expressions."""

from __future__ import annotations

from tierwright.functions import domains as D

BATCH_ID = "20260101T000000Z-0a1b2c"
INGESTED = "TIMESTAMP '2026-01-01 06:30:00'"


def words(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def pick(values, index: str) -> str:
    return f"({words(values)})[cast({index} + 1 AS INT)]"


def date_text(date: str, dmy: str, epoch: str) -> str:
    return (
        f"CASE WHEN {dmy} THEN strftime({date}, '%d/%m/%Y') "
        f"WHEN {epoch} THEN cast(cast(epoch({date}) AS BIGINT) AS VARCHAR) "
        f"ELSE strftime({date}, '%Y-%m-%d') END"
    )


def parsed(text: str) -> str:
    """Text in any of the three date formats, or NULL."""
    seconds = f"TRY_CAST({text} AS BIGINT)"
    return (
        f"coalesce(cast(try_strptime({text}, '%Y-%m-%d') AS DATE), "
        f"cast(try_strptime({text}, '%d/%m/%Y') AS DATE), "
        f"cast(make_timestamp({seconds} * 1000000) AS DATE))"
    )


def stamp(date: str, time: str) -> str:
    return f"TRY_CAST(cast({date} AS VARCHAR) || ' ' || {time} AS TIMESTAMP)"


BORN = "(DATE '1940-01-01' + cast(c_custkey * 17 % 25000 AS INT))"
_PROVINCE = pick(D.PROVINCES, "c_nationkey % 9")

_GENDER = pick(D.GENDERS, "c_custkey % 4")

CUSTOMERS = f"""customers AS (
  SELECT cast(c_custkey AS VARCHAR) AS customer_id,
    '**********' || lpad(cast(c_custkey % 10000 AS VARCHAR), 4, '0') AS id_number,
    n_name AS first_name, c_name AS last_name,
    {date_text(BORN, "c_custkey % 11 = 3", "c_custkey % 11 = 7")} AS dob,
    {_GENDER} AS gender,
    CASE WHEN {_PROVINCE} = 'KwaZulu-Natal' AND c_custkey % 4 = 0 THEN ' kzn'
         WHEN {_PROVINCE} = 'Western Cape' AND c_custkey % 4 = 1 THEN 'WC'
         WHEN {_PROVINCE} = 'Gauteng' AND c_custkey % 4 = 2 THEN 'GAUTENG '
         ELSE {_PROVINCE} END AS province,
    {pick(D.INCOME_BANDS, "c_custkey % 5")} AS income_band,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'MASS' WHEN 'BUILDING' THEN 'EMERGING'
         WHEN 'FURNITURE' THEN 'MIDDLE_MKT' WHEN 'HOUSEHOLD' THEN 'PROFESSIONAL'
         WHEN 'MACHINERY' THEN 'PRIVATE' END AS segment,
    cast(c_custkey % 10 + 1 AS VARCHAR) AS risk_score,
    {pick(D.KYC_STATUSES, "c_custkey % 3")} AS kyc_status,
    {pick(("HL|CC", "SA|CA|INS", "PL"), "c_custkey % 3")} AS product_flags
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


BROKEN_CUSTOMERS = CUSTOMERS.replace(
    f"{_GENDER} AS gender", f"CASE WHEN c_custkey % 53 = 7 THEN '?' ELSE {_GENDER} END AS gender"
)


def accounts(dirty: bool = False, name: str = "accounts", broken: bool = False) -> str:
    account_id = "cast(o_orderkey AS VARCHAR)"
    customer = "cast(o_custkey AS VARCHAR)"
    if dirty:
        account_id = f"CASE WHEN o_orderkey % 200 <> 9 THEN {account_id} END"
        customer = f"CASE WHEN o_orderkey % 71 = 5 THEN 'N' || {customer} ELSE {customer} END"
    status = pick(D.ACCOUNT_STATUSES, "o_orderkey % 4")
    if broken:
        status = f"CASE WHEN o_orderkey % 59 = 3 THEN 'FROZEN' ELSE {status} END"
    price = "cast(cast(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
    return f"""{name} AS (
  SELECT {account_id} AS account_id, {customer} AS customer_ref,
    {pick(D.ACCOUNT_TYPES, "o_orderkey % 3")} AS account_type,
    {status} AS account_status,
    {date_text("o_orderdate", "o_orderkey % 7 = 2", "o_orderkey % 7 = 5")} AS open_date,
    {pick(D.PRODUCT_TIERS, "cast(substr(o_orderpriority, 1, 1) AS INT) % 3")} AS product_tier,
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '+27' || lpad({customer}, 9, '0') END
      AS mobile_number,
    {pick(D.DIGITAL_CHANNELS, "o_orderkey % 3")} AS digital_channel,
    CASE WHEN o_orderkey % 3 = 2 THEN {price} ELSE '' END AS credit_limit,
    {price} AS current_balance,
    CASE WHEN o_orderkey % 5 = 0 THEN ''
         ELSE strftime(cast(o_orderdate AS DATE) + 30, '%Y-%m-%d') END AS last_activity_date
  FROM orders)"""


def transactions(dirty: bool = False, name: str = "transactions", broken: bool = False) -> str:
    account_id = "cast(l_orderkey AS VARCHAR)"
    date = date_text("l_shipdate", "l_partkey % 10 = 0", "l_partkey % 10 = 1")
    amount = "cast(cast(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)"
    if dirty:
        account_id = f"CASE WHEN l_partkey % 50 = 7 THEN 'X' || {account_id} ELSE {account_id} END"
        date = f"CASE WHEN l_partkey % 97 = 5 THEN 'unknown' ELSE {date} END"
        amount = f"CASE WHEN l_partkey % 89 = 3 THEN 'n/a' ELSE {amount} END"
    currencies = ("R", "rands", "710", "zar", " ZAR ", "XXX", "ZAR", "ZAR", "ZAR", "ZAR")
    currency = pick(currencies, "l_suppkey % 10")
    kind, channel = pick(D.TRANSACTION_TYPES, "l_linenumber % 4"), pick(D.CHANNELS, "l_partkey % 6")
    province, session, retry = pick(D.PROVINCES, "l_suppkey % 9"), "'sess-' || l_suppkey", "l_partkey % 50 = 0"
    clock = """lpad(cast(l_suppkey % 24 AS VARCHAR), 2, '0') || ':' ||
      lpad(cast(l_partkey % 60 AS VARCHAR), 2, '0') || ':' ||
      lpad(cast(l_linenumber * 7 % 60 AS VARCHAR), 2, '0')"""
    if broken:
        currency = f"CASE WHEN l_partkey % 4 = 0 THEN {currency} ELSE 'ZAR' END"
        clock = f"CASE WHEN l_partkey % 103 = 2 THEN '9am' ELSE {clock} END"
        kind = f"CASE WHEN l_partkey % 107 = 3 THEN 'GIFT' ELSE {kind} END"
        channel = f"CASE WHEN l_partkey % 101 <> 1 THEN {channel} END"
        province = f"CASE WHEN l_partkey % 109 = 4 THEN 'Atlantis' ELSE {province} END"
        session, retry = (f"CASE WHEN l_partkey % 113 <> 5 THEN {c} END" for c in (session, retry))
    return f"""{name} AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
    {account_id} AS account_id, {date} AS transaction_date,
    {clock} AS transaction_time,
    {kind} AS transaction_type,
    CASE WHEN l_partkey % 9 <> 0 THEN {pick(D.MERCHANT_CATEGORIES, "l_suppkey % 20")} END
      AS merchant_category,
    cast(NULL AS VARCHAR) AS merchant_subcategory, {amount} AS amount,
    {currency} AS currency,
    {channel} AS channel,
    {province} AS location_province,
    cast(NULL AS VARCHAR) AS location_city,
    CASE WHEN l_partkey % 5 <> 0 THEN '-26.1,' || l_suppkey END AS location_coordinates,
    cast(NULL AS VARCHAR) AS metadata_device_id,
    {session} AS metadata_session_id,
    {retry} AS metadata_retry_flag
  FROM lineitem)"""


def hashed(columns, of: str, name: str) -> str:
    """``of`` with the SHA-256 of each row's JSON text."""
    fields = ", ".join(f"{c} := {c}" for c in columns)
    return (
        f"{name} AS (SELECT *, sha256(cast(to_json(struct_pack({fields})) AS VARCHAR)) "
        f"AS _source_row_hash FROM {of})"
    )


AMOUNT_AS_TEXT = "coalesce(TRY_CAST(substr(transaction_time, 4, 2) AS INT) % 12 = 3, FALSE)"

EVENTS = """stream_events AS (
  SELECT cast(event_id AS VARCHAR) AS transaction_id, cast(user_id AS VARCHAR) AS account_id,
    cast(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS transaction_timestamp,
    CASE event_type WHEN 'purchase' THEN 'DEBIT' WHEN 'click' THEN 'CREDIT' WHEN 'view' THEN 'FEE'
      WHEN 'signup' THEN 'REVERSAL' WHEN 'error' THEN 'DEBIT' END AS transaction_type,
    cast(value AS DECIMAL(18,2)) AS amount,
    cast(json_extract_string(props, '$.k') AS INT) AS k
  FROM events),
stream_accounts AS (
  SELECT cast(c_custkey AS VARCHAR) AS account_id, cast(c_acctbal AS DECIMAL(18,2)) AS opening
  FROM customer WHERE c_mktsegment <> 'BUILDING')"""
