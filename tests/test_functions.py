import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from almenara.fixed_values import CSV_NULL_TOKENS, LABELS, TEXT_REPAIR
from almenara.functions import codes, dates, text


def apply(spark, values, *columns, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    rows = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    return [r[1] if len(columns) == 1 else tuple(r[1:]) for r in rows]


def single_pass(value):
    """Brute force: leftmost match, first alternative, one pass."""
    keys = "|".join(re.escape(k) for k in TEXT_REPAIR)
    return re.sub(keys, lambda m: TEXT_REPAIR[m.group()], value)


GOLDEN_REPAIR = [
    ("EngativÃ¡", "Engativá", "ENGATIVÁ", "ENGATIVÁ"),
    ("AÃ‘OS", "AÑOS", "AÑOS", "AÑOS"),
    ("FONTIB¢N", "FONTIBNN", "FONTIBNN", "FONTIBNN"),
    ("C‡digo", "COdigo", "CODIGO", "CODIGO"),
    ("Â¡", "¡", "I", "I"),
    ("â€¢", "•", "N", "N"),
    ("Â§", "§", "ñ", "ñ"),
    ("A\u00a0B", "AAB", "AAB", "AAB"),
]


def test_repair_golden(spark):
    one = text.repair_text("v")
    df = spark.createDataFrame([(r[0],) for r in GOLDEN_REPAIR], "v string")
    df = df.withColumn("p1", one)
    df = df.withColumn("u", text.standard_text("p1"))
    df = df.withColumn("p2", text.repair_text("u"))
    df = df.withColumn("p3", text.repair_text("p2"))
    assert [tuple(r) for r in df.select("v", "p1", "p2", "p3").collect()] == GOLDEN_REPAIR


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.text(alphabet=sorted({c for k, v in TEXT_REPAIR.items() for c in k + v} | set("aZ€ ")), max_size=14),
        min_size=100,
        max_size=300,
    )
)
def test_repair_is_one_pass(spark, values):
    assert apply(spark, values, text.repair_text("v")) == [single_pass(v) for v in values]


def test_repair_every_pair_of_keys(spark):
    parts = list(TEXT_REPAIR) + ["Ã", "Â", "â", "â€", "x"]
    values = [a + b for a in parts for b in parts] + [a + b + c for a in parts[-5:] for b in parts for c in parts]
    want = [(single_pass(v),) * 2 for v in values]
    assert apply(spark, values, text.repair_text("v"), text.repair_text(F.col("v"))) == want


def test_repair_with_another_table(spark):
    table = {"ñx": "n", "é": "E", "x": "y"}
    assert apply(spark, ["ñxéx", "éx", "ñ"], text.repair_text(F.col("v"), table)) == ["nEy", "Ey", "ñ"]
    for ambiguous in ({"ñx": "n", "ñ": "N"}, {"éb": "c", "dc": "x"}, {"éb": "x", "bñ": "y"}, {"éb": "xy"}, {"ab": "c"}):
        with pytest.raises(ValueError):
            text.repair_text("v", ambiguous)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet=list(text.WHITE_SPACE) + ["a", "ñ", "ß", "\u200b"], max_size=8), min_size=50, max_size=100))
def test_strip_blank_and_standard(spark, values):
    got = apply(spark, values, text.strip("v"), text.blank_to_null("v"), text.standard_text("v"))
    want = [
        (v.strip(), None if re.fullmatch(r"\s*", v) else v, v.replace("\u00a0", " ").strip().upper())
        for v in values
    ]
    assert got == want


def test_white_space_is_complete():
    assert set(text.WHITE_SPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_null_tokens(spark):
    values = CSV_NULL_TOKENS + ["Null", " NA", "0", None]
    assert apply(spark, values, text.null_tokens("v")) == [None] * len(CSV_NULL_TOKENS) + ["Null", " NA", "0", None]


def test_null_words(spark):
    assert apply(spark, [" NaN ", "None", "NULL", "", "  ", " x ", "<NA>", None], text.null_words("v")) == [
        None, None, None, None, None, "x", "<NA>", None,
    ]


def test_lenient_int(spark):
    values = ["25", "25.0", "25,5", " 7 ", "007", "3.999", "-3", "", "<NA>", "nan", "1e2", "12.", "\t7", "99999999999", None]
    assert apply(spark, values, codes.lenient_int("v")) == [25, 25, 25, 7, 7, 3] + [None] * 9


def test_standard_code(spark):
    values = ["07", "7.00", "USAQUÉN", "7.5", "NULL", None, "suba ", "LA CANDELARIA", "ENGATIVAX", "99", "USME", "sin_d", "9" * 30]
    want = [7, 7, None, None, None, None, 11, 17, 10, 99, 5, None, None]
    assert apply(spark, values, codes.standard_code("v")) == want


def test_normalized_code(spark):
    values = ["15.0", "15", "15.00", "<NA>", "nan", "NONE", "", None]
    assert apply(spark, values, codes.normalized_code("v")) == ["15", "15", "15.00", "<NA>", None, None, None, None]


def test_labels(spark):
    values = list(LABELS) + ["other", None]
    assert apply(spark, values, codes.map_label("v")) == list(LABELS.values()) + ["other", None]
    assert apply(spark, ["1", "4", "CRITICA", None], codes.map_priority("v")) == ["CRITICA", "BAJA", "CRITICA", None]


def test_timestamps(spark):
    d = dt.datetime
    values = [
        "2024-01-05 10:00:00", "2024-01-05T10:00:00", "2024-01-05", "05/02/2024 11:00", "25/02/2024 11:00",
        "5/2/2024 9:05:30", "2024/01/05 10:00", "05/02/2024", "5/2/2024 3:04:05 PM", "5/2/2024 12:04 am", "02-05-2024 10:00",
        "05/02/2024 10:00:00.250", "25-02-2024", "NaT", "", "garbage", "02/30/2024 10:00", "31/04/2024 10:00",
        "10:30", "13/13/2024 10:00", None,
    ]
    want = [
        d(2024, 1, 5, 10), d(2024, 1, 5, 10), d(2024, 1, 5), d(2024, 5, 2, 11), d(2024, 2, 25, 11),
        d(2024, 5, 2, 9, 5, 30), d(2024, 1, 5, 10), d(2024, 5, 2), d(2024, 5, 2, 15, 4, 5), d(2024, 5, 2, 0, 4), d(2024, 2, 5, 10),
        d(2024, 5, 2, 10, 0, 0, 250000), d(2024, 2, 25),
    ] + [None] * 8
    assert apply(spark, values, dates.parse_timestamp("v")) == want
    day_first = dates.timestamp_formats(day_first=True)
    got = apply(spark, ["05/02/2024 11:00", "2-5-2024", "02/25/2024 1:00 PM"], dates.parse_timestamp("v", day_first))
    assert got == [d(2024, 2, 5, 11), d(2024, 5, 2), d(2024, 2, 25, 13)]


def test_guards_lose_nothing(spark):
    """Guarded formats read what trying each format in turn would read."""
    from itertools import product

    values = [f"{a}/{b}/2024 {t}" for a, b, t in product(
        ["0", "1", "02", "11", "12", "13", "29", "31", "32"], ["1", "02", "12", "13", "29", "30", "31", "32"],
        ["0:00", "9:59:59", "23:00", "24:00", "x"])]
    tried = F.coalesce(*[F.try_to_timestamp("v", F.lit(p)) for p in ("M/d/yyyy H:mm[:ss]", "d/M/yyyy H:mm[:ss]")])
    got = apply(spark, values, dates.parse_timestamp("v"), tried)
    assert all(a == b for a, b in got) and any(a for a, _ in got)


def test_custom_format(spark):
    day_first = [(r"^\d+/", "d/M/yyyy H:mm")]
    assert apply(spark, ["05/02/2024 11:00"], dates.parse_timestamp("v", day_first)) == [dt.datetime(2024, 2, 5, 11)]


def test_safe_timestamp_and_date(spark):
    values = [" 2024-01-05 10:00:00 ", "NaT", "none", "x", None]
    assert apply(spark, values, dates.safe_timestamp("v")) == [dt.datetime(2024, 1, 5, 10)] + [None] * 4
    assert apply(spark, ["2024-01-05", "2024-01-05 10:00:00", "NaT", ""], dates.safe_date("v")) == [
        dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, None,
    ]


def test_weekdays(spark):
    values = [f"2024-01-{d:02d}" for d in range(1, 8)]
    got = apply(spark, values + [None], dates.weekday_es(dates.safe_date("v")), dates.weekday_en(dates.safe_date("v")))
    assert got == [
        ("Lunes", "Monday"), ("Martes", "Tuesday"), ("Miércoles", "Wednesday"), ("Jueves", "Thursday"),
        ("Viernes", "Friday"), ("Sábado", "Saturday"), ("Domingo", "Sunday"), (None, None),
    ]
    assert apply(spark, ["Lunes", "Domingo", "x"], dates.weekday_position("v")) == [1, 7, 0]
