"""Cleaning and derivation of single values.

Longer expressions are built as SQL text: that is one call to the JVM instead of
one per operator, which matters when a plan has many columns.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierwright.functions.domains import AGE_BANDS, DATE_FORMATS

MONEY = "decimal(18,2)"
EPOCH_SECONDS = "epoch_s"
# timestamp_seconds() overflows outside these years under ANSI mode
_EPOCH_LIMIT = 253_402_300_799
_TWO_SEPARATORS = re.compile(r"[-/. ]{2}")


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def _parse_pattern(text: str, fmt: str) -> str:
    """SQL for a strict parse of one format, NULL on failure.

    A failed ``try_to_date`` raises and catches an exception per row.  Formats made
    of one year, month and day field are therefore matched by shape, reordered and
    cast, which costs the same whether a row parses or not.
    """
    places = [fmt.find(f) + 1 for f in ("yyyy", "MM", "dd")]
    if 0 in places or len(fmt) != 10 or not _TWO_SEPARATORS.fullmatch(re.sub("[yMd]", "", fmt)):
        return f"try_to_date({text}, {sql_text(fmt)})"
    shape = re.sub("[yMd]", "[0-9]", fmt.replace(".", "[.]"))
    year, month, day = (f"substr({text}, {at}, {n})" for at, n in zip(places, (4, 2, 2)))
    iso = text if fmt == "yyyy-MM-dd" else f"concat({year}, '-', {month}, '-', {day})"
    return f"CASE WHEN {text} RLIKE '^{shape}$' THEN try_cast({iso} AS date) END"


def _parse_epoch(text: str) -> str:
    seconds = f"try_cast({text} AS bigint)"
    in_range = f"{seconds} BETWEEN -{_EPOCH_LIMIT} AND {_EPOCH_LIMIT}"
    return f"to_date(timestamp_seconds(CASE WHEN {in_range} THEN {seconds} END))"


def parse_date(sql: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that parses wins; NULL when none does.

    ``sql`` is a column name or other SQL text of a string value.
    """
    attempts = [_parse_epoch(sql) if f == EPOCH_SECONDS else _parse_pattern(sql, f) for f in formats]
    return F.expr(f"coalesce({', '.join(attempts)})")


def date_needs_repair(sql: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """True where the text is present but not in the first (canonical) format."""
    return F.expr(sql).isNotNull() & parse_date(sql, formats[:1]).isNull()


def combine_timestamp(date: str, time: str) -> Column:
    """Parsed date + ``HH:MM:SS`` text -> zone-less timestamp, NULL if either is bad."""
    stamp = f"concat(cast({date} AS string), ' ', {time})"
    shape = "^[0-9]{2}:[0-9]{2}:[0-9]{2}$"
    return F.expr(f"CASE WHEN {time} RLIKE '{shape}' THEN try_cast({stamp} AS timestamp_ntz) END")


def _code_key(sql: str) -> str:
    return f"upper(btrim(cast({sql} AS string), ' \\t\\n\\r\\f\\v'))"


def normalize_code(sql: str, codes: Mapping[str, str], default: str | None = None) -> Column:
    """Trim, upper-case and look up; unknown (or NULL) input becomes ``default``.

    With ``default=None`` an unknown value is left as it came.  The lookup is a
    map literal, so keep ``codes`` to a small reference list.
    """
    pairs = ", ".join(
        f"{sql_text(part)}" for k, v in codes.items() for part in (k.strip().upper(), v)
    )
    found = f"try_element_at(map({pairs}), {_code_key(sql)})" if pairs else "cast(NULL AS string)"
    fallback = f"cast({sql} AS string)" if default is None else sql_text(default)
    return F.expr(f"coalesce({found}, {fallback})")


def code_is_unknown(sql: str, codes: Mapping[str, str]) -> Column:
    """True where the lookup of :func:`normalize_code` finds nothing."""
    accepted = ", ".join(sql_text(k.strip().upper()) for k in codes)
    return F.expr(f"NOT coalesce({_code_key(sql)} IN ({accepted}), false)")


def code_is_variant(c: Column | str, canonical: str) -> Column:
    """True where the raw text, untrimmed, is not exactly the canonical code."""
    return ~_col(c).cast("string").eqNullSafe(F.lit(canonical))


def money(c: Column | str, strict: bool = True) -> Column:
    """Exact two-place decimal; ``strict=False`` gives NULL on unparseable text."""
    c = _col(c)
    return c.cast(MONEY) if strict else c.try_cast(MONEY)


def age_in_years(birth: Column | str, as_of: dt.date | Column) -> Column:
    as_of = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    return F.floor(F.datediff(as_of, _col(birth)) / F.lit(365.25).cast("double")).cast("int")


def band_label(value: Column, bands: Sequence[tuple[int, str]] = AGE_BANDS) -> Column:
    """Label of the highest lower bound reached, NULL below the lowest."""
    chain = None
    for bound, label in sorted(bands, reverse=True):
        hit = value >= bound
        chain = F.when(hit, label) if chain is None else chain.when(hit, label)
    return chain if chain is not None else F.lit(None).cast("string")


def resolve_run_date(value: dt.date | str | None) -> dt.date:
    if value is None:
        return dt.datetime.now(dt.timezone.utc).date()
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    if isinstance(value, str):
        return dt.date.fromisoformat(value)
    raise TypeError(f"run date must be a date, ISO text or None, not {type(value).__name__}")


def row_hash(columns: Sequence[str], algorithm: str = "xxhash64") -> Column:
    """Hash of a row as text, telling NULL apart from every value and position.

    ``xxhash64`` alone skips NULLs, so each value is followed by its null mark.
    ``sha256`` hashes the row's JSON text and can be reproduced outside Spark.
    """
    if algorithm == "xxhash64":
        parts = [part for n in columns for part in (f"`{n}`", f"isnull(`{n}`)")]
        return F.expr(f"cast(xxhash64({', '.join(parts)}) AS string)")
    if algorithm == "sha256":
        fields = ", ".join(f"`{n}`" for n in columns)
        row = f"to_json(struct({fields}), map('ignoreNullFields', 'false'))"
        return F.expr(f"sha2({row}, 256)")
    raise ValueError(f"unknown hash algorithm: {algorithm}")


def hashed_key(c: Column | str) -> Column:
    """63-bit key from SHA-256: stable across engines, not guaranteed unique."""
    digest = F.sha2(_col(c).cast("string"), 256)
    first_64_bits = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    return (first_64_bits % F.expr("9223372036854775808BD")).cast("bigint")


def json_field_is_text(line: Column | str, path: str) -> Column:
    """True where the JSON value at ``path`` is a quoted string, NULL if absent."""
    field = F.variant_get(F.try_parse_json(_col(line)), path, "variant")
    return F.schema_of_variant(field) == "STRING"


def to_utc_wall_clock(c: Column | str) -> Column:
    """Zoned -> zone-less, keeping the UTC reading (the session must be UTC)."""
    return _col(c).cast("timestamp_ntz")


def from_utc_wall_clock(c: Column | str) -> Column:
    """Zone-less UTC reading -> zoned, without shifting the value."""
    return _col(c).cast("timestamp")
