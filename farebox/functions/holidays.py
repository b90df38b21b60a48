"""Public holidays by rules: fixed dates, n-th and last weekdays, days around Easter, observed days.

A rule gives at most one day a year. A holiday on a weekend may be observed on
another day; both days then count. Rules are evaluated for the years of a
period, so any period has its holidays without a list of dates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

MONDAY, THURSDAY, SATURDAY, SUNDAY = 0, 3, 5, 6
DAY = dt.timedelta(days=1)


def easter(year: int) -> dt.date:
    """Easter Sunday: the first Sunday after the church's full moon that falls on 21 March or later (Gregorian)."""
    century, place = year // 100, year % 19             # a year's place in the 19-year cycle of the moon
    leap_days_left_out = century - century // 4
    moon_drift = (8 * century + 13) // 25
    after = (19 * place + 15 + leap_days_left_out - moon_drift) % 30     # days from 21 March to the full moon
    if after == 29 or (after == 28 and place > 10):                      # the cycle has no such late full moon
        after -= 1
    moon = dt.date(year, 3, 21) + after * DAY
    return moon + (6 - moon.weekday() or 7) * DAY


def weekday_of_month(year: int, month: int, weekday: int, n: int) -> dt.date:
    """The n-th such weekday of a month; n = -1 is the last one."""
    if n > 0:
        first = dt.date(year, month, 1)
        return first + ((weekday - first.weekday()) % 7 + 7 * (n - 1)) * DAY
    last = dt.date(year + month // 12, month % 12 + 1, 1) - DAY
    return last - ((last.weekday() - weekday) % 7 + 7 * (-n - 1)) * DAY


def nearest_workday(day: dt.date) -> dt.date:
    """Saturday's holiday is observed on Friday, Sunday's on Monday."""
    return day + {SATURDAY: -1, SUNDAY: 1}.get(day.weekday(), 0) * DAY


def next_workday(day: dt.date) -> dt.date:
    """A weekend's holiday is observed on Monday."""
    return day + {SATURDAY: 2, SUNDAY: 1}.get(day.weekday(), 0) * DAY


@dataclass(frozen=True)
class Holiday:
    """A yearly holiday from ``since`` on."""
    name: str
    day: Callable[[int], dt.date]
    since: int = 1
    observed: Callable[[dt.date], dt.date] | None = None


def fixed(name: str, month: int, day: int, since: int = 1, observed=None) -> Holiday:
    return Holiday(name, lambda y: dt.date(y, month, day), since, observed)


def nth(name: str, month: int, weekday: int, n: int, since: int = 1) -> Holiday:
    return Holiday(name, lambda y: weekday_of_month(y, month, weekday, n), since)


def from_easter(name: str, days: int, since: int = 1) -> Holiday:
    return Holiday(name, lambda y: easter(y) + days * DAY, since)


#: Federal holidays of the United States with the years they began (fixed values).
US_FEDERAL = (
    fixed("New Year's Day", 1, 1, observed=nearest_workday),
    nth("Martin Luther King Jr. Day", 1, MONDAY, 3, since=1986),
    nth("Washington's Birthday", 2, MONDAY, 3, since=1971),
    nth("Memorial Day", 5, MONDAY, -1, since=1971),
    fixed("Juneteenth", 6, 19, since=2021, observed=nearest_workday),
    fixed("Independence Day", 7, 4, observed=nearest_workday),
    nth("Labor Day", 9, MONDAY, 1, since=1894),
    nth("Columbus Day", 10, MONDAY, 2, since=1971),
    fixed("Veterans Day", 11, 11, since=1978, observed=nearest_workday),
    nth("Thanksgiving Day", 11, THURSDAY, 4, since=1942),
    fixed("Christmas Day", 12, 25, observed=nearest_workday),
)


def holidays_between(start: dt.date, end: dt.date, rules: tuple[Holiday, ...] = US_FEDERAL) -> dict[dt.date, str]:
    """Holidays of the half-open period [start, end), a day's first rule naming it.

    An observed day may lie in another year than its holiday (New Year's Day on a Saturday), so the years around count too.
    """
    out: dict[dt.date, str] = {}
    for year in range(start.year - 1, end.year + 2):
        for rule in rules:
            if year >= rule.since:
                day = rule.day(year)
                out.setdefault(day, rule.name)
                if rule.observed and rule.observed(day) != day:
                    out.setdefault(rule.observed(day), f"{rule.name} (observed)")
    return {d: n for d, n in sorted(out.items()) if start <= d < end}
