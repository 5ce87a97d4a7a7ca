"""Reporting periods relative to an explicit as-of date."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def months_before(day: date, months: int) -> date:
    """Calendar subtraction that clamps to the end of a shorter month."""
    total = day.year * 12 + day.month - 1 - months
    year, month = divmod(total, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last))


@dataclass(frozen=True)
class Clock:
    """The day a report is made for; every bound derives from it as a literal."""

    as_of: date

    @property
    def year_start(self) -> date:
        return date(self.as_of.year, 1, 1)

    def days_back(self, days: int) -> date:
        return self.as_of - timedelta(days=days)

    def bounds(self, time_range: str, previous: bool = False) -> tuple[date | None, date | None]:
        """Half-open [from, to) bounds; None is unbounded.

        The current period has no upper bound. The previous one is 60 to 30 days back for
        ``30d``, the whole last calendar year for ``ytd`` and everything before this year
        otherwise.
        """
        jan1 = self.year_start
        table = {
            ("30d", False): (self.days_back(30), None),
            ("ytd", False): (jan1, None),
            ("active", False): (None, None),
            ("all", False): (None, None),
            ("30d", True): (self.days_back(60), self.days_back(30)),
            ("ytd", True): (date(jan1.year - 1, 1, 1), jan1),
            ("active", True): (None, jan1),
            ("all", True): (None, jan1),
        }
        if (time_range, previous) not in table:
            raise ValueError(f"unknown time range: {time_range}")
        return table[time_range, previous]

    def within_sql(self, column: str, time_range: str, previous: bool = False) -> str:
        return between_days_sql(column, *self.bounds(time_range, previous))

    def within(self, column: str, time_range: str, previous: bool = False) -> Column:
        return F.expr(self.within_sql(column, time_range, previous))

    def heat(self, column: str, time_range: str) -> Column:
        """Heatmap periods: unlike rankings, the year to date ends today."""
        if time_range == "30d":
            return F.col(column) >= F.lit(self.days_back(30))
        if time_range == "ytd":
            return F.col(column).between(F.lit(self.year_start), F.lit(self.as_of))
        raise ValueError(f"unknown heatmap range: {time_range}")

    def cohort(self, column: str, previous: bool = False) -> Column:
        """Registered during the last year, or during the year before that."""
        year_ago, two_ago = months_before(self.as_of, 12), months_before(self.as_of, 24)
        if previous:
            return (F.col(column) >= F.lit(two_ago)) & (F.col(column) < F.lit(year_ago))
        return F.col(column).between(F.lit(year_ago), F.lit(self.as_of))

    def month_labels(self, months: int = 10) -> list[str]:
        first = self.as_of.replace(day=1)
        return [f"{months_before(first, n):%Y-%m}" for n in range(months - 1, -1, -1)]

    def month_floor(self, months: int = 10) -> date:
        return months_before(self.as_of.replace(day=1), months - 1)

    def years(self, years: int = 10) -> list[int]:
        return list(range(self.as_of.year - years + 1, self.as_of.year + 1))


def between_days_sql(column: str, low: date | None, high: date | None) -> str:
    """Half-open day range as an SQL condition; no bound is no condition."""
    parts = []
    if low is not None:
        parts.append(f"{column} >= DATE '{low:%Y-%m-%d}'")
    if high is not None:
        parts.append(f"{column} < DATE '{high:%Y-%m-%d}'")
    return " AND ".join(parts) or "true"


def tenths(value: Column) -> Column:
    """Round a double to one decimal place by its exact binary value, ties to even.

    ``bround`` rounds the printed decimal instead: it takes 49.85 (stored as a little more) for a
    tie. Here 20 * value is compared with the odd number in the middle; splitting the product
    into 16 and 4 times the value keeps every step exact.
    """
    size = F.abs(value)
    low = F.floor(size * 10).cast("double")
    over = (size * 16 - (low * 2 + 1)) + size * 4
    up = (over > 0) | ((over == 0) & (low % 2 == 1))
    out = F.when(up, low + 1).otherwise(low) / 10
    return F.when((value < 0) & (out != 0), -out).otherwise(out)


def growth_pct(current: Column, previous: Column, empty: float | None) -> Column:
    """Percent change to one place; ``empty`` when there was nothing before."""
    pct = tenths((current - previous) / previous * 100)
    return F.when(previous > 0, pct).otherwise(F.lit(empty).cast("double"))


def share_pct(part: Column, total: Column) -> Column:
    return F.when(total > 0, tenths(part / total * 100)).otherwise(F.lit(0.0))


def compound_growth_pct(first: Column, last: Column, steps: int) -> Column:
    """Average growth per step over ``steps`` steps, in percent; 0 from an empty start."""
    rate = (F.pow(last / first, F.lit(1.0 / steps)) - 1) * 100
    return F.when(first > 0, tenths(rate)).otherwise(F.lit(0.0))
