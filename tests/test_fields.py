import pandas as pd
from pyspark.sql import functions as F

from scrubline.functions import fields, rates, text
from scrubline.operators import detect


def apply(frame, expression, values):
    rows = frame([(i, v) for i, v in enumerate(values)], "i int, v string")
    result = rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [row.r for row in result]


def test_strip_and_fold_agree_with_python_for_every_code_point(spark):
    # Nothing folds or is white space beyond the second plane.
    points = [chr(c) for c in range(1, 0x20000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame(pd.DataFrame({"v": points, "s": [p.strip() for p in points],
                                             "f": [p.casefold() for p in points]}))
    assert df.where(text.strip(F.col("v")) != F.col("s")).count() == 0
    assert df.where(text.fold_case(F.col("v")) != F.col("f")).count() == 0


def test_token_key(frame):
    names = ["Quarry  Stone\tLtd.", "stone QUARRY ltd.", "  Straße ", "", "   ", None]
    assert apply(frame, text.token_key, names) == [
        "ltd. quarry stone", "ltd. quarry stone", "strasse", "", "", None,
    ]


def test_clean_cell(frame):
    cells = ["a\nb", " nan ", "\r\n x \t", "nano", None]
    assert apply(frame, text.clean_cell, cells) == ["a b", None, "x", "nano", None]


def test_null_tokens(frame):
    cells = ["", "NA", "null", "None", "x", "na", " NA", None, "#N/A"]
    assert apply(frame, text.null_tokens, cells) == [
        None, None, None, None, "x", "na", " NA", None, None,
    ]
    assert apply(frame, lambda c: text.null_tokens(c, [""]), ["", "NA"]) == [None, "NA"]


def test_part_numbers(frame):
    cases = [
        ("PN-0420", "current", "PN-0420"),
        ("PN-7777", "current", "PN-7777"),
        ("2019-PN-8080", "2019", "PN-8080"),
        ("2019-PN-55", "2019", "PN-0055"),
        ("2019-PN-6", "2019", "PN-0006"),
        ("P9", "legacy", "PN-0009"),
        ("P5678", "legacy", "PN-5678"),
        ("P00012", "legacy", "PN-0012"),
        ("P0", "legacy", "PN-0000"),
        ("P12345", "legacy", "PN-12345"),
        ("P12345678901234567890", "legacy", "PN-12345678901234567890"),
        ("\tP9 \n", "legacy", "PN-0009"),
        ("  PN-0003 ", "current", "PN-0003"),
        ("PN-1", "unknown", "PN-1"),
        ("PN-12345", "unknown", "PN-12345"),
        ("X-31", "unknown", "X-31"),
        ("", "unknown", ""),
        (None, "unknown", None),
    ]
    numbers = [number for number, _, _ in cases]
    assert apply(frame, fields.era, numbers) == [era for _, era, _ in cases]
    normalized = apply(frame, fields.normalized_part_number, numbers)
    assert normalized == [wanted for _, _, wanted in cases]


def test_normalizing_part_numbers_twice_changes_nothing(frame):
    numbers = ["P7", "2019-PN-3", " PN-0001", "P99999", "x", None]
    twice = lambda c: fields.normalized_part_number(fields.normalized_part_number(c))
    assert apply(frame, twice, numbers) == apply(frame, fields.normalized_part_number, numbers)


def test_invalid_email(frame):
    cases = {
        "desk@mill.example": False, "nobody": True, "mill.invalid": True,
        "a.b@mill.example.org": False, "front desk@mill.example": True, " x@mill.example ": False,
        "x@mill.invalid": True, "x@mill.INVALID": False, "": False, "  ": False, "nan": False,
        "None": False, None: False, "a\tb@mill.example": False,
    }
    assert apply(frame, fields.invalid_email, list(cases)) == list(cases.values())


def test_lenient_timestamp(frame):
    values = ["2024-01-15", "2024-01-15 10:30:00", "15.01.2024", "never", "", None]
    parsed = apply(frame, lambda c: fields.lenient_timestamp(c, ["dd.MM.yyyy"]), values)
    assert [None if p is None else str(p) for p in parsed] == [
        "2024-01-15 00:00:00", "2024-01-15 10:30:00", "2024-01-15 00:00:00", None, None, None,
    ]


def test_dates_as_people_write_them(frame):
    values = {
        "3/1/2024": "2024-03-01 00:00:00", "03/01/2024 7:05": "2024-03-01 07:05:00",
        "1 Mar 2024": "2024-03-01 00:00:00", "March 1, 2024": "2024-03-01 00:00:00",
        "20240301": "2024-03-01 00:00:00", "2024/3/1": "2024-03-01 00:00:00",
        " 2024-03-01T09:00:00 ": "2024-03-01 09:00:00", "2024": "2024-01-01 00:00:00",
        "08:00:00": None, "T08:00": None, "12": None, "1,5": None, "13/13/2024": None, "soon 3 4": None,
    }
    parsed = apply(frame, fields.lenient_timestamp, list(values))
    assert [None if p is None else str(p) for p in parsed] == list(values.values())
    assert apply(frame, lambda c: fields.lenient_timestamp(c, []), ["3/1/2024"]) == [None]


def test_rates(frame):
    rows = frame([(0, 0), (1, 2), (0, 3)], "part long, whole long")
    share = rates.share(F.col("part"), F.col("whole"))
    assert [r.s for r in rows.select(share.alias("s")).collect()] == [1.0, 0.5, 0.0]
    pr = frame([(0.0, 0.0), (0.5, 1.0), (0.03125, 0.95)], "p double, r double")
    out = pr.select(
        rates.f1(F.col("p"), F.col("r")).alias("f"), rates.rounded(F.col("p")).alias("p4"),
        rates.health(F.col("r")).alias("h"), rates.percent(F.col("r")).alias("pc"),
    ).collect()
    assert [round(r.f, 4) for r in out] == [0.0, 0.6667, 0.0605]
    assert out[2].p4 == 0.0312
    assert [r.h for r in out] == ["red", "green", "green"]
    assert [r.pc for r in out] == ["0.0%", "100.0%", "95.0%"]


def test_day_and_month_in_either_order(frame):
    values = ["13/1/2024", "1/13/2024", "3.4.2024", "3-4-2024 8:05", "31/4/2024", "3/4-2024"]
    read = lambda day_first: [
        None if p is None else str(p)[:16]
        for p in apply(frame, lambda c: fields.lenient_timestamp(c, day_first=day_first), values)
    ]
    both = ["2024-01-13 00:00", "2024-01-13 00:00"]
    assert read("") == [*both, "2024-03-04 00:00", "2024-03-04 08:05", None, None]
    assert read("/.") == [*both, "2024-04-03 00:00", "2024-03-04 08:05", None, None]


def test_columns_say_in_which_order_they_write_dates(frame):
    schema = "co_number string, opened_at string, closed_at string"
    # Opened with the day first: 5/3 is the fifth of March. Closed with the month first: 3/4 is the fourth.
    rows = [("1", "5/3/2024", "3/4/2024"), ("2", "25/3/2024", "3/26/2024"), ("3", "1.2.2024", "2.1.2024"), ("4", None, "")]
    df = frame(rows, schema)
    assert {tuple(r) for r in detect.date_orders(df).collect()} == {
        ("opened_at", "/", 1, 0, 1, "day_first"), ("closed_at", "/", 0, 1, 1, "month_first"),
        ("opened_at", ".", 0, 0, 1, "ambiguous"), ("closed_at", ".", 0, 0, 1, "ambiguous"),
    }
    assert [r.record_key for r in detect.impossible_dates(df).collect()] == ["1"]
    assert sorted(r.record_key for r in detect.impossible_dates(df, formats=["M/d/yyyy"]).collect()) == ["1"]
    assert detect.date_orders(df.select("co_number")).count() == 0
