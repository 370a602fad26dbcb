import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierwright.functions import domains as D
from tierwright.functions import values as V


def each(spark, column, values, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def one(spark, column, value, kind="string"):
    return each(spark, column, [value], kind)[0]


def test_parse_date(spark):
    cases = [
        ("2025-06-18", dt.date(2025, 6, 18)),
        ("18/06/2025", dt.date(2025, 6, 18)),
        ("1750204800", dt.date(2025, 6, 18)),
        ("-86400", dt.date(1969, 12, 31)),
        ("2025-02-30", None),
        ("31/02/2025", None),
        ("2025-3-2", None),
        (" 2025-06-18", None),
        ("99999999999999999999", None),
        ("9223372036854775807", None),
        ("soon", None),
        ("", None),
        (None, None),
    ]
    assert each(spark, V.parse_date("x"), [t for t, _ in cases]) == [d for _, d in cases]


@pytest.mark.parametrize(
    "fmt, text, expected",
    [
        ("dd.MM.yyyy", "18.06.2025", dt.date(2025, 6, 18)),
        ("dd.MM.yyyy", "22x03x2025", None),
        ("MM/dd/yyyy", "06/18/2025", dt.date(2025, 6, 18)),
        ("yyyyMMdd", "20250618", dt.date(2025, 6, 18)),
        ("d MMM yyyy", "2 Mar 2025", dt.date(2025, 3, 2)),
    ],
)
def test_other_formats(spark, fmt, text, expected):
    assert one(spark, V.parse_date("x", [fmt]), text) == expected


def test_earlier_format_wins(spark):
    assert one(spark, V.parse_date("x", ["MM/dd/yyyy", "dd/MM/yyyy"]), "04/05/2025") == dt.date(
        2025, 4, 5
    )


def test_date_needs_repair(spark):
    needs = V.date_needs_repair("x")
    assert each(spark, needs, ["2025-06-18", "18/06/2025", "x", None]) == [
        False,
        True,
        True,
        False,
    ]


def test_combine_timestamp(spark):
    times = ["11:52:40", "11:52", "25:00:00", None]
    got = each(spark, V.combine_timestamp("DATE'2025-06-18'", "x"), times)
    assert got == [dt.datetime(2025, 6, 18, 11, 52, 40), None, None, None]


def test_combine_timestamp_without_date(spark):
    assert one(spark, V.combine_timestamp("cast(NULL AS date)", "x"), "10:00:00") is None


def test_currency_is_always_canonical(spark):
    raw = ["ZAR", "R", "rands", "zar", " ZAR ", "710", "\tr\n", "USD", None]
    normal = V.normalize_code("x", D.CURRENCY_CODES, D.CURRENCY)
    assert each(spark, normal, raw) == ["ZAR"] * len(raw)


def test_unknown_and_variant_codes(spark):
    unknown = V.code_is_unknown("x", D.CURRENCY_CODES)
    assert each(spark, unknown, ["zar", "710", "\tr\n", "USD", None]) == [False, False, False, True, True]
    variant = V.code_is_variant("x", "ZAR")
    assert each(spark, variant, ["ZAR", "zar", " ZAR", None]) == [False, True, True, True]


def test_alias_without_default_keeps_value(spark):
    lookup = V.normalize_code("x", {"KZN": "KwaZulu-Natal", "o'x": "O'X"})
    assert each(spark, lookup, [" kzn", "Gauteng", "O'x", None]) == [
        "KwaZulu-Natal",
        "Gauteng",
        "O'X",
        None,
    ]


def test_empty_map(spark):
    assert one(spark, V.normalize_code("x", {}), "a") == "a"
    assert one(spark, V.normalize_code("x", {}, "d"), "a") == "d"


def test_age_band_edges(spark):
    run = dt.date(2025, 12, 31)
    ages = {17: None, 18: "18-25", 25: "18-25", 26: "26-35", 55: "46-55", 56: "56-65", 64: "56-65",
            65: "65+", 90: "65+"}
    assert each(spark, V.band_label(F.col("x")), list(ages), "int") == list(ages.values())
    born = run - dt.timedelta(days=6575)  # 18 * 365.25 = 6574.5
    assert one(spark, V.age_in_years("x", run), born, "date") == 18
    assert one(spark, V.age_in_years("x", run), born + dt.timedelta(days=1), "date") == 17


def test_money(spark):
    assert str(one(spark, V.money("x"), "271.5")) == "271.50"
    assert one(spark, V.money("x", strict=False), "n/a") is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, V.money("x"), "n/a")


def test_run_date():
    day = dt.date(2025, 1, 2)
    assert V.resolve_run_date(day) == V.resolve_run_date("2025-01-02") == day
    assert V.resolve_run_date(dt.datetime(2025, 1, 2, 3)) == day
    assert V.resolve_run_date(None) == dt.datetime.now(dt.timezone.utc).date()
    with pytest.raises(TypeError):
        V.resolve_run_date(20250102)


@pytest.mark.parametrize("algorithm", ["xxhash64", "sha256"])
def test_row_hash_tells_nulls_apart(spark, algorithm):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), (None, None), ("a", "a"), ("aa", None)]
    df = spark.createDataFrame(rows, "x string, y string")
    hashes = [r[0] for r in df.select(V.row_hash(["x", "y"], algorithm)).collect()]
    assert len(set(hashes)) == len(rows) and None not in hashes
    assert hashes == [r[0] for r in df.select(V.row_hash(["x", "y"], algorithm)).collect()]


def test_json_field_is_text(spark):
    lines = ['{"amount":"12.30"}', '{"amount":12.30}', '{"amount":7}', "{}", "broken"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [r[0] for r in df.select(V.json_field_is_text("value", "$.amount")).collect()]
    assert got[:3] == [True, False, False] and not got[3] and not got[4]


def test_utc_round_trip(spark):
    stamp = dt.datetime(2025, 3, 30, 2, 30, 0, 123456)
    ntz = one(spark, V.to_utc_wall_clock(V.from_utc_wall_clock("x")), stamp, "timestamp_ntz")
    assert ntz == stamp
