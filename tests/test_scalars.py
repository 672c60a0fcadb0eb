from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest

from tallyhouse.functions import scalars, text


def values(rows, column, *inputs):
    frame = rows("i int, x string", *enumerate(inputs))
    return [r[0] for r in frame.orderBy("i").select(column).collect()]


def test_strip_removes_every_kind_of_white_space(rows):
    given = ["  a ", "\ta\n", " a ", "\x1fa", "a b", "　", None]
    assert values(rows, text.strip("x"), *given) == [g.strip() if g is not None else None for g in given]


def test_blank_rules(rows):
    assert values(rows, text.stripped("x"), " ", "", None, " b") == [None, None, None, "b"]
    assert values(rows, text.or_default("x", "D"), "", None, " ", "v") == ["D", "D", " ", "v"]


def test_dates(rows):
    given = ["2021-03-01", " 2021-03-01T10:00 ", "2021-02-30", "01.03.2021", "", None, "2021-3-1"]
    assert values(rows, scalars.parse_date("x"), *given) == [
        date(2021, 3, 1), date(2021, 3, 1), None, None, None, None, None
    ]


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("2026-03-15T01:30:00+03:00", datetime(2026, 3, 14, 22, 30)),
        ("2026-03-15T01:30:00Z", datetime(2026, 3, 15, 1, 30)),
        ("2026-03-15 01:30", datetime(2026, 3, 15, 1, 30)),
        ("2026-03-15T01", datetime(2026, 3, 15, 1)),
        ("2026-03-15", datetime(2026, 3, 15)),
        ("2026-03-15T01:30:00.250-02:00", datetime(2026, 3, 15, 3, 30, 0, 250000)),
        (" \n", None),
        ("12:30", None),
        ("2026", None),
        ("2026-03", None),
        ("yesterday", None),
    ],
)
def test_timestamps(rows, given, expected):
    seconds = scalars.parse_timestamp("x")
    assert values(rows, seconds, given) == [expected]


def test_local_date_is_the_day_of_the_source_offset(rows):
    assert values(rows, scalars.local_date("x"), "2026-03-15T01:30:00+03:00") == [date(2026, 3, 15)]
    utc = scalars.utc_date(scalars.parse_timestamp("x"))
    assert values(rows, utc, "2026-03-15T01:30:00+03:00") == [date(2026, 3, 14)]


def test_decimals_round_half_up_and_accept_a_comma(rows):
    given = ["1,50", "2.345", " 7 ", "1e3", "-0,005", "x", "", None, "NaN"]
    assert values(rows, scalars.parse_decimal("x", 18, 2), *given) == [
        Decimal("1.50"), Decimal("2.35"), Decimal("7.00"), Decimal("1000.00"), Decimal("-0.01"),
        None, None, None, None,
    ]


def test_numbers_reject_special_and_suffixed_literals(rows):
    given = ["12,5", "-3", ".5", "NaN", "inf", "1d", "0x1p3", "1e400", "", None]
    assert values(rows, scalars.parse_number("x"), *given) == [
        12.5, -3.0, 0.5, None, None, None, None, None, None, None
    ]


def test_number_text_matches_plain_float_notation(rows):
    given = ["1500.5", "4794", "0", "123456789.25", "0.1", "99999999999.99"]
    shown = values(rows, scalars.number_text(scalars.parse_number("x")), *given)
    assert shown == [str(float(g)) for g in given]


def test_flags(rows):
    given = ["1", "TRUE", "Yes", "t", "0", "no", " true", "", None]
    assert values(rows, scalars.parse_bool("x"), *given) == [
        True, True, True, True, False, False, False, None, None
    ]


def test_integers(rows):
    assert values(rows, scalars.parse_unsigned("x"), " 7 ", "-7", "7.0", "99999999999", "") == [
        7, None, None, None, None
    ]
    assert values(rows, scalars.parse_signed("x"), " -2 ", "+3", "x", "") == [-2, 3, None, None]


def test_unreadable_is_not_blank(rows):
    column = scalars.unreadable("x", scalars.parse_date("x"))
    assert values(rows, column, "soon", " ", None, "2021-01-01") == [True, False, False, False]


def test_numbers_of_any_length_count_while_they_are_finite(rows):
    given = ("1e100", "1e-100", "9" * 221, "1e309", "-1e309", "9" * 400)
    found = rows("v string", *[(v,) for v in given]).select(scalars.parse_number("v").alias("n")).collect()
    assert [r.n for r in found] == [1e100, 1e-100, float("9" * 221), None, None, None]
