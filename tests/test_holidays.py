"""Holiday rules over many years, against tables of known dates and properties of the calendar."""

import datetime as dt

from farebox import cli
from farebox.config import TAXI_JANUARY_2019
from farebox.functions import holidays as H

#: Known Easter Sundays (fixed values), the earliest and the latest possible among them.
EASTERS = ["1818-03-22", "1943-04-25", "1954-04-18", "1961-04-02", "1981-04-19", "1990-04-15", "1996-04-07", "2000-04-23", "2005-03-27", "2008-03-23",
           "2011-04-24", "2016-03-27", "2019-04-21", "2024-03-31", "2025-04-20", "2038-04-25", "2049-04-18", "2076-04-19", "2285-03-22"]


def names(start, end):
    return {str(d): n for d, n in H.holidays_between(dt.date.fromisoformat(start), dt.date.fromisoformat(end)).items()}


def test_easter():
    assert [str(H.easter(int(e[:4]))) for e in EASTERS] == EASTERS
    for y in range(1583, 3000):
        day = H.easter(y)
        assert day.weekday() == H.SUNDAY and (3, 22) <= (day.month, day.day) <= (4, 25)


def test_weekdays_of_months_by_counting():
    for y in range(1995, 2031):
        for m in range(1, 13):
            days = [dt.date(y, m, d) for d in range(1, 32) if d <= (dt.date(y + m // 12, m % 12 + 1, 1) - H.DAY).day]
            for w in range(7):
                mine = [d for d in days if d.weekday() == w]
                assert [H.weekday_of_month(y, m, w, n) for n in (1, 2, 3, 4, -1, -2)] == [*mine[:4], mine[-1], mine[-2]]


def test_thirty_years_of_all_months():
    for y in range(1996, 2031):
        got = H.holidays_between(dt.date(y, 1, 1), dt.date(y + 1, 1, 1))
        own = {n: d for d, n in got.items() if "observed" not in n}
        assert len(own) == (11 if y >= 2021 else 10)
        assert own["Independence Day"] == dt.date(y, 7, 4) and own["Thanksgiving Day"].weekday() == H.THURSDAY
        assert 22 <= own["Thanksgiving Day"].day <= 28 and 25 <= own["Memorial Day"].day <= 31
        for d, n in got.items():
            if "observed" in n:
                assert d.weekday() in (0, 4)
        # month by month gives the same as the year at once
        months = {}
        for m in range(1, 13):
            months |= H.holidays_between(dt.date(y, m, 1), dt.date(y + m // 12, m % 12 + 1, 1))
        assert months == got


def test_observed_days():
    assert names("2021-07-01", "2021-08-01") == {"2021-07-04": "Independence Day", "2021-07-05": "Independence Day (observed)"}
    # New Year's Day 2022 is a Saturday: observed in the year before
    assert names("2021-12-20", "2022-01-05") == {"2021-12-24": "Christmas Day (observed)", "2021-12-25": "Christmas Day",
                                                 "2021-12-31": "New Year's Day (observed)", "2022-01-01": "New Year's Day"}
    assert H.next_workday(dt.date(2021, 12, 25)) == dt.date(2021, 12, 27)


def test_other_calendars():
    rules = (H.from_easter("Good Friday", -2), H.from_easter("Whit Monday", 50), H.fixed("Labour Day", 5, 1, observed=H.next_workday))
    got = H.holidays_between(dt.date(2022, 4, 1), dt.date(2022, 7, 1), rules)
    assert {str(d): n for d, n in got.items()} == {"2022-04-15": "Good Friday", "2022-05-01": "Labour Day", "2022-05-02": "Labour Day (observed)",
                                                   "2022-06-06": "Whit Monday"}


def test_cli_periods():
    rules = lambda *argv: cli._rules(cli.parser().parse_args(["pipeline", "--zones", "z", "--work", "w", *argv])).holiday_rows()
    assert [(str(d), n) for d, n in rules("--period", "2019-07")] == [("2019-07-04", "Independence Day")]
    assert rules("--period", "2019-01") == TAXI_JANUARY_2019.holiday_rows()
    assert [str(d) for d, _ in rules("--period", "2019-11")] == ["2019-11-11", "2019-11-28"]
    assert rules("--period", "2019-08") == []
