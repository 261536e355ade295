"""Date context and relative-date windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.columns import as_col

# Season sentence per month, southern hemisphere.
SEASON_SENTENCES = {
    (12, 1, 2): "Summer is a period of low economic activity",
    (3, 4, 5): "Autumn Business is in full swing",
    (6, 7, 8): "Winter is when end of financial year happens",
    (9, 10, 11): "Spring is when new projects and initiatives typically kick off",
}
# Relative windows and filing lags.
RECENT_DAYS = 30
UPCOMING_DAYS = 60
QUARTERLY_LAG_DAYS = 45
HALF_YEARLY_LAG_DAYS = 75
ANNUAL_LAG_MONTHS = 4


def financial_year_end(ts) -> Column:
    """Calendar year in which the July-June year of ``ts`` ends."""
    ts = as_col(ts)
    return F.year(ts) + F.when(F.month(ts) >= 7, 1).otherwise(0)


def temporal_context(ts) -> dict[str, Column]:
    """Named columns describing a date for use in a prompt."""
    ts = as_col(ts)
    end = financial_year_end(ts)
    season = F.when(F.lit(False), F.lit(""))
    for months, sentence in SEASON_SENTENCES.items():
        season = season.when(F.month(ts).isin(*months), F.lit(sentence))
    return {
        "current_date": F.date_format(ts, "MMMM dd, yyyy"),
        "current_day": F.date_format(ts, "EEEE"),
        "current_quarter": F.concat(
            F.lit("Q"), F.quarter(ts).cast("string"), F.lit(" "), F.year(ts).cast("string")
        ),
        "financial_year": F.concat(
            F.lit("FY"),
            end.cast("string"),
            F.lit(" (July "),
            (end - 1).cast("string"),
            F.lit(" - June "),
            end.cast("string"),
            F.lit(")"),
        ),
        "season_context": season,
    }


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Replace ``{name}`` in a template by a column's text."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def is_recent(day, today) -> Column:
    return as_col(day).between(F.date_sub(today, RECENT_DAYS), today)


def is_upcoming(day, today) -> Column:
    return as_col(day).between(today, F.date_add(today, UPCOMING_DAYS))


def same_quarter(day, today) -> Column:
    return F.trunc(as_col(day), "quarter") == F.trunc(today, "quarter")


def same_financial_year(day, today) -> Column:
    return financial_year_end(day) == financial_year_end(today)


def window_days(today, window: str) -> tuple[Column, Column]:
    """First and last day of a relative-date window."""
    if window == "recent":
        return F.date_sub(today, RECENT_DAYS), today
    if window == "upcoming":
        return today, F.date_add(today, UPCOMING_DAYS)
    if window == "quarter":
        first = F.trunc(today, "quarter")
        return first, F.date_sub(F.add_months(first, 3), 1)
    if window == "financial_year":
        year = financial_year_end(today)
        return F.make_date(year - 1, F.lit(7), F.lit(1)), F.make_date(year, F.lit(6), F.lit(30))
    raise ValueError(f"unknown window {window!r}")


def in_window(day, today, window: str | None = None) -> Column:
    """Relative-date condition by name; no window, no condition."""
    if window is None:
        return F.lit(True)
    return as_col(day).between(*window_days(today, window))


def filing_due(period_end, period: str) -> Column:
    """Last day a report for the period may be filed."""
    end = as_col(period_end)
    if period == "quarter":
        return F.date_add(end, QUARTERLY_LAG_DAYS)
    if period == "half":
        return F.date_add(end, HALF_YEARLY_LAG_DAYS)
    if period == "year":
        return F.add_months(end, ANNUAL_LAG_MONTHS)
    raise ValueError(f"unknown period {period!r}")


def millis_to_timestamp(millis) -> Column:
    return F.timestamp_millis(as_col(millis))


def iso_text(ts) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def stamp_text(ts) -> Column:
    return F.date_format(as_col(ts), "yyyyMMdd_HHmmss")
