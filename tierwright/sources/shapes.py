"""Source-shaped views of the test tables.

The given tables have no customers, accounts or transactions, so these
projections derive them, row for row, all columns as text like a source file.
Irregular values (date formats, currency spellings, unknown accounts) come from
arithmetic on the row's own keys, so any SQL engine can derive the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwright.functions import domains as D
from tierwright.operators.dedup import has_hot_key, together
from tierwright.operators.integrity import mark_orphans
from tierwright.operators.keys import BUCKET, key_buckets
from tierwright.sources.files import spread

PROVINCE_ALIASES = {"KZN": "KwaZulu-Natal", "WC": "Western Cape", "GAUTENG": "Gauteng"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _text(c: Column) -> Column:
    return c.cast("string")


def _pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _date_text(date: Column, dmy: Column, epoch: Column) -> Column:
    seconds = F.unix_seconds(date.cast("date").cast("timestamp"))
    return (
        F.when(dmy, F.date_format(date, "dd/MM/yyyy"))
        .when(epoch, _text(seconds))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )


def customers(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """``broken`` adds a gender outside the known ones."""
    c = table(spark, sf_dir, "customer")
    nation = spark.read.parquet(f"{sf_dir.rstrip('/')}/nation.parquet")
    key = F.col("c_custkey")
    born = F.expr("date_add(date'1940-01-01', cast(c_custkey * 17 % 25000 as int))")
    gender = _pick(D.GENDERS, key % 4)
    province = _pick(D.PROVINCES, F.col("c_nationkey") % 9)
    spelled = (
        F.when((province == "KwaZulu-Natal") & (key % 4 == 0), " kzn")
        .when((province == "Western Cape") & (key % 4 == 1), "WC")
        .when((province == "Gauteng") & (key % 4 == 2), "GAUTENG ")
        .otherwise(province)
    )
    segments = dict(
        zip(("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), D.SEGMENTS)
    )
    segment = F.create_map(*[F.lit(p) for kv in segments.items() for p in kv])
    return c.join(nation, c.c_nationkey == nation.n_nationkey).select(
        _text(key).alias("customer_id"),
        F.concat(F.lit("**********"), F.lpad(_text(key % 10000), 4, "0")).alias("id_number"),
        F.col("n_name").alias("first_name"),
        F.col("c_name").alias("last_name"),
        _date_text(born, key % 11 == 3, key % 11 == 7).alias("dob"),
        (F.when(key % 53 == 7, "?").otherwise(gender) if broken else gender).alias("gender"),
        spelled.alias("province"),
        _pick(D.INCOME_BANDS, key % 5).alias("income_band"),
        F.element_at(segment, F.col("c_mktsegment")).alias("segment"),
        _text(key % 10 + 1).alias("risk_score"),
        _pick(D.KYC_STATUSES, key % 3).alias("kyc_status"),
        _pick(("HL|CC", "SA|CA|INS", "PL"), key % 3).alias("product_flags"),
    )


def accounts(
    spark: SparkSession, sf_dir: str, dirty: bool = False, broken: bool = False, by_key: bool = False
) -> DataFrame:
    """``dirty`` adds NULL account ids and customers that do not exist, ``broken`` an unknown status.

    ``by_key`` brings rows of one account id together while they are narrow.
    """
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    account_id, customer = _text(key), _text(F.col("o_custkey"))
    if dirty:
        account_id = F.when(key % 200 != 9, account_id)
        customer = F.when(key % 71 == 5, F.concat(F.lit("N"), customer)).otherwise(customer)
    if by_key:
        o = together(o, [account_id])
    status = _pick(D.ACCOUNT_STATUSES, key % 4)
    price = _text(F.col("o_totalprice").cast("decimal(18,2)"))
    active = F.expr("date_add(cast(o_orderdate as date), 30)")
    return o.select(
        account_id.alias("account_id"),
        customer.alias("customer_ref"),
        _pick(D.ACCOUNT_TYPES, key % 3).alias("account_type"),
        (F.when(key % 59 == 3, "FROZEN").otherwise(status) if broken else status).alias("account_status"),
        _date_text(F.col("o_orderdate"), key % 7 == 2, key % 7 == 5).alias("open_date"),
        _pick(D.PRODUCT_TIERS, F.substring("o_orderpriority", 1, 1).cast("int") % 3).alias(
            "product_tier"
        ),
        F.when(key % 7 == 0, "")
        .otherwise(F.concat(F.lit("+27"), F.lpad(customer, 9, "0")))
        .alias("mobile_number"),
        _pick(D.DIGITAL_CHANNELS, key % 3).alias("digital_channel"),
        F.when(key % 3 == 2, price).otherwise("").alias("credit_limit"),
        price.alias("current_balance"),
        F.when(key % 5 == 0, "")
        .otherwise(F.date_format(active, "yyyy-MM-dd"))
        .alias("last_activity_date"),
    )


def transactions(
    spark: SparkSession,
    sf_dir: str,
    dirty: bool = False,
    broken: bool = False,
    by: str | None = None,
    known_accounts: DataFrame | None = None,
    in_buckets: bool = False,
) -> DataFrame:
    """Many rows share a transaction id, as in a feed that delivers twice.

    ``dirty`` adds unknown accounts and dates and amounts that cannot be parsed.  ``broken`` adds what only a
    contract refuses (no channel, an unreadable time, an unknown type or province, no metadata), and leaves
    most currencies in their canonical spelling.  ``by`` is an id column whose equal rows are brought together while they
    are narrow.  With ``known_accounts`` rows meet these by ``account_id`` while they are narrow, and have ``is_orphan``.
    With ``in_buckets`` rows lie in key buckets of ``by`` and have ``_bucket``, unless an id is hot.
    """
    line = table(spark, sf_dir, "lineitem")
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    number = F.col("l_linenumber")
    transaction_id = F.concat_ws("-", order, number)
    account_id = _text(order)
    date = _date_text(F.col("l_shipdate"), part % 10 == 0, part % 10 == 1)
    amount = _text(F.col("l_extendedprice").cast("decimal(18,2)"))
    if dirty:
        account_id = F.when(part % 50 == 7, F.concat(F.lit("X"), account_id)).otherwise(account_id)
        date = F.when(part % 97 == 5, "unknown").otherwise(date)
        amount = F.when(part % 89 == 3, "n/a").otherwise(amount)
    ids = {"transaction_id": transaction_id, "account_id": account_id}
    marks = []
    if known_accounts is not None:
        # rows of one transaction have at most two account ids, so without a hot account no transaction is hot
        hot = has_hot_key(line, [account_id])
        line = (line if hot else line.repartition(account_id)).withColumn("_account", account_id)
        line = mark_orphans(line, "_account", known_accounts, "account_id")
        line = line.repartition(ids[by]) if by == "transaction_id" and not hot else line
        marks = ["is_orphan"]
    elif in_buckets and not has_hot_key(line, [ids[by]]):
        line = key_buckets(line, ids[by])
        marks = [BUCKET]
    elif by and not in_buckets:
        line = together(line, [ids[by]])
    spelled = _pick(("R", "rands", "710", "zar", " ZAR ", "XXX", "ZAR", "ZAR", "ZAR", "ZAR"), supp % 10)
    clock = F.concat_ws(
        ":",
        F.lpad(_text(supp % 24), 2, "0"),
        F.lpad(_text(part % 60), 2, "0"),
        F.lpad(_text(number * 7 % 60), 2, "0"),
    )
    kind, channel = _pick(D.TRANSACTION_TYPES, number % 4), _pick(D.CHANNELS, part % 6)
    province, retry = _pick(D.PROVINCES, supp % 9), part % 50 == 0
    session = F.concat(F.lit("sess-"), _text(supp))
    if broken:
        spelled = F.when(part % 4 == 0, spelled).otherwise(D.CURRENCY)
        clock = F.when(part % 103 == 2, "9am").otherwise(clock)
        kind = F.when(part % 107 == 3, "GIFT").otherwise(kind)
        channel = F.when(part % 101 != 1, channel)
        province = F.when(part % 109 == 4, "Atlantis").otherwise(province)
        retry, session = (F.when(part % 113 != 5, c) for c in (retry, session))
    return line.select(
        transaction_id.alias("transaction_id"),
        account_id.alias("account_id"),
        date.alias("transaction_date"),
        clock.alias("transaction_time"),
        kind.alias("transaction_type"),
        F.when(part % 9 != 0, _pick(D.MERCHANT_CATEGORIES, supp % 20)).alias("merchant_category"),
        F.lit(None).cast("string").alias("merchant_subcategory"),
        amount.alias("amount"),
        spelled.alias("currency"),
        channel.alias("channel"),
        province.alias("location_province"),
        F.lit(None).cast("string").alias("location_city"),
        F.when(part % 5 != 0, F.concat(F.lit("-26.1,"), _text(supp))).alias("location_coordinates"),
        F.lit(None).cast("string").alias("metadata_device_id"),
        session.alias("metadata_session_id"),
        retry.alias("metadata_retry_flag"),
        *marks,
    )


def amount_sent_as_text() -> Column:
    """Which transactions quote their amount; needs the lineitem-shaped columns."""
    minutes = F.substring("transaction_time", 4, 2).try_cast("int")
    return F.coalesce(minutes % 12 == 3, F.lit(False))


def transaction_lines(rows: DataFrame, extra_key: bool = False) -> DataFrame:
    """JSON lines of transactions: nested objects, numeric amounts unless
    :func:`amount_sent_as_text`, numeric ``710``, no ``merchant_subcategory`` key.

    ``extra_key`` adds a key no reader expects to some lines: at the top, in an object, and in an object that
    comes as an array.
    """
    place = [
        F.col("location_province").alias("province"),
        F.col("location_city").alias("city"),
        F.col("location_coordinates").alias("coordinates"),
    ]
    if extra_key:
        nested = F.col("channel").isin("POS", "EFT")
        place.append(F.when(nested, F.col("metadata_session_id")).alias("suburb"))
    location = F.struct(*place)
    metadata = F.struct(
        F.col("metadata_device_id").alias("device_id"),
        F.col("metadata_session_id").alias("session_id"),
        F.col("metadata_retry_flag").alias("retry_flag"),
    )
    names = [
        "transaction_id",
        "account_id",
        "transaction_date",
        "transaction_time",
        "transaction_type",
        "merchant_category",
        "amount",
        "currency",
        "channel",
    ]
    fields = [F.col(n) for n in names]
    if extra_key:
        # a NULL field is left out of the text
        fields.append(F.when(F.col("channel") == "ATM", F.col("metadata_session_id")).alias("terminal"))
    metadata = F.when(F.col("metadata_retry_flag").isNotNull(), metadata)

    def line(place: Column) -> Column:
        return F.to_json(F.struct(*fields, place.alias("location"), metadata.alias("metadata")))

    text = line(location)
    if extra_key:
        text = F.when(F.col("channel") == "EFT", line(F.array(location))).otherwise(text)
    text = F.regexp_replace(text, r'"currency":"710"', '"currency":710')
    plain = F.regexp_replace(text, r'"amount":"([0-9.]+)"', '"amount":$1')
    return rows.select(F.when(amount_sent_as_text(), text).otherwise(plain).alias("value"))


# What each event type of the events table stands for.
EVENT_TYPES = {
    "purchase": "DEBIT",
    "click": "CREDIT",
    "view": "FEE",
    "signup": "REVERSAL",
    "error": "DEBIT",
}


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions of the account named after their user."""
    kinds = F.create_map(*[F.lit(p) for kv in EVENT_TYPES.items() for p in kv])
    return table(spark, sf_dir, "events").select(
        _text(F.col("event_id")).alias("transaction_id"),
        _text(F.col("user_id")).alias("account_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("transaction_date"),
        F.date_format("ts", "HH:mm:ss").alias("transaction_time"),
        F.element_at(kinds, F.col("event_type")).alias("transaction_type"),
        _text(F.col("value").cast("decimal(18,2)")).alias("amount"),
        F.get_json_object("props", "$.k").alias("k"),
    )
