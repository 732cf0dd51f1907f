"""Period expressions (H1-H8). Every function returns a Column; the "now" of
the reference is an explicit ``as_of`` date column, never ``current_date()``.

Period labels: month ``yyyyMM``, ISO week ``yyyyWn`` (no zero padding on
output, both forms accepted on input), quarter ``yyyyQn``, year ``yyyy``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WEEKLY, MONTHLY, QUARTERLY, YEARLY = "WEEKLY", "MONTHLY", "QUARTERLY", "YEARLY"
FREQUENCIES = [WEEKLY, MONTHLY, QUARTERLY, YEARLY]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def month_start(yyyymm) -> Column:
    return F.to_date(_c(yyyymm), "yyyyMM")


def month_label(d) -> Column:
    return F.date_format(_c(d), "yyyyMM")


def iso_week_label(d) -> Column:
    """ISO week of a date as ``yyyyWn`` (2024-12-31 -> 2025W1)."""
    d = _c(d)
    return F.concat(F.extract(F.lit("YEAROFWEEK"), d).cast("string"), F.lit("W"),
                    F.weekofyear(d).cast("string"))


def quarter_label(d) -> Column:
    d = _c(d)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def year_label(d) -> Column:
    return F.year(_c(d)).cast("string")


def label(d, frequency) -> Column:
    f = F.upper(_lit(frequency))
    return (F.when(f == WEEKLY, iso_week_label(d)).when(f == MONTHLY, month_label(d))
             .when(f == QUARTERLY, quarter_label(d)).when(f == YEARLY, year_label(d))
             .otherwise(F.raise_error(F.concat(F.lit("unsupported frequency: "), f))))


def month_range(start, end) -> Column:
    """H1: inclusive list of ``yyyyMM`` from start to end; start > end raises."""
    s, e = month_start(start), month_start(end)
    checked_end = F.when(s > e, F.raise_error(F.lit("start month after end month"))).otherwise(e)
    return F.transform(F.sequence(s, checked_end, F.expr("INTERVAL 1 MONTH")), lambda d: month_label(d))


def month_window_defaults(as_of, window: int = 6) -> Column:
    """H2: struct(start, end): start = as_of - window months, end = the month
    before as_of."""
    m = F.trunc(_c(as_of), "month")
    return F.struct(month_label(F.add_months(m, -window)).alias("start"),
                    month_label(F.add_months(m, -1)).alias("end"))


def is_valid_yyyymm(p, strict_year: bool = False) -> Column:
    """H3: six characters whose last two are a month 1-12; the year is not
    checked (as in the reference) unless ``strict_year``."""
    p = _c(p)
    month = F.substring(p, 5, 2).try_cast("int")
    ok = (F.length(p) == 6) & month.between(1, 12)
    if strict_year:
        ok = ok & p.rlike(r"^[0-9]{4}")
    return F.coalesce(ok, F.lit(False))


def month_bounds_ok(start, end) -> Column:
    """H3: both bounds valid (when given) and start not after end (compared
    as text, which orders yyyyMM correctly)."""
    s, e = _c(start), _c(end)
    return (F.coalesce(s.isNull() | is_valid_yyyymm(s), F.lit(False))
            & F.coalesce(e.isNull() | is_valid_yyyymm(e), F.lit(False))
            & F.coalesce(s.isNull() | e.isNull() | (s <= e), F.lit(False)))


def weeks_of_month(yyyymm) -> Column:
    """H4: ISO weeks touching a month; boundary weeks belong to both months."""
    first = month_start(yyyymm)
    mondays = F.sequence(F.date_trunc("week", first).cast("date"), F.last_day(first), F.expr("INTERVAL 7 DAY"))
    return F.transform(mondays, lambda d: iso_week_label(d))


def periods_for_frequency(frequency, yyyymm) -> Column:
    """H5: periods a month covers: weekly -> its weeks, monthly -> itself,
    yearly -> its year; anything else raises."""
    f = F.lower(_lit(frequency))
    m = _c(yyyymm)
    return (F.when(f == "weekly", weeks_of_month(m)).when(f == "monthly", F.array(m))
             .when(f == "yearly", F.array(F.substring(m, 1, 4)))
             .otherwise(F.raise_error(F.concat(F.lit("frequency not supported: "), f))))


def shift(as_of, n, frequency) -> Column:
    """Date ``n`` periods of ``frequency`` before ``as_of``."""
    d, n, f = _c(as_of).cast("date"), _lit(n), F.upper(_lit(frequency))
    return (F.when(f == WEEKLY, F.date_sub(d, n * 7)).when(f == MONTHLY, F.add_months(d, -n))
             .when(f == QUARTERLY, F.add_months(d, -n * 3)).when(f == YEARLY, F.add_months(d, -n * 12)))


def period_back(as_of, n, frequency) -> Column:
    """H6: label of the period ``n`` periods of ``frequency`` before ``as_of``."""
    return label(shift(as_of, n, frequency), frequency)


def period_start_date(p) -> Column:
    """First day of a period label of any supported form."""
    p = _c(p)
    y = F.regexp_extract(p, r"^([0-9]{4})", 1).cast("int")
    wk = F.regexp_extract(p, r"^[0-9]{4}W([0-9]{1,2})$", 1)
    q = F.regexp_extract(p, r"^[0-9]{4}Q([1-4])$", 1)
    week1 = F.date_trunc("week", F.make_date(y, F.lit(1), F.lit(4))).cast("date")
    return (F.when(p.rlike(r"^[0-9]{4}W[0-9]{1,2}$"), F.date_add(week1, (wk.cast("int") - 1) * 7))
             .when(p.rlike(r"^[0-9]{4}Q[1-4]$"), F.make_date(y, (q.cast("int") - 1) * 3 + 1, F.lit(1)))
             .when(p.rlike(r"^[0-9]{6}$"), F.to_date(p, "yyyyMM"))
             .when(p.rlike(r"^[0-9]{4}$"), F.make_date(y, F.lit(1), F.lit(1))))


def _dates(s: Column, e: Column, frequency) -> Column:
    """Period start dates from s to e (day and month intervals are different
    types, so one sequence per frequency)."""
    f = F.upper(_lit(frequency))
    return (F.when(f == WEEKLY, F.sequence(s, e, F.expr("INTERVAL 7 DAY")))
             .when(f == MONTHLY, F.sequence(s, e, F.expr("INTERVAL 1 MONTH")))
             .when(f == QUARTERLY, F.sequence(s, e, F.expr("INTERVAL 3 MONTH")))
             .when(f == YEARLY, F.sequence(s, e, F.expr("INTERVAL 12 MONTH"))))


def period_floor(d, frequency) -> Column:
    """First day of the period of ``frequency`` containing date ``d``."""
    d, f = _c(d), F.upper(_lit(frequency))
    return (F.when(f == WEEKLY, F.date_trunc("week", d)).when(f == MONTHLY, F.date_trunc("month", d))
             .when(f == QUARTERLY, F.date_trunc("quarter", d)).when(f == YEARLY, F.date_trunc("year", d))
            ).cast("date")


def extract_periods(start, end, window, frequency, as_of) -> Column:
    """H7: periods from ``start`` (default: ``window`` periods before as_of) to
    ``end`` (default: the current period), both inclusive; when start is not
    before end, just [start]. Bounds are compared as dates, not text.

    Pass plain column references for start / end: each is read a few times.
    """
    f = F.upper(_lit(frequency))
    start = _c(start) if start is not None else F.lit(None).cast("string")
    end = _c(end) if end is not None else F.lit(None).cast("string")
    day = _c(as_of).cast("date")
    bounds = F.named_struct(
        F.lit("s"), period_floor(F.coalesce(period_start_date(start), shift(day, window, f)), f),
        F.lit("e"), period_floor(F.coalesce(period_start_date(end), day), f),
        F.lit("start"), start, F.lit("f"), f)
    # A one-element array binds the bounds to a name: they are worked out once
    # per row, however often the periods below refer to them.
    return F.element_at(F.transform(F.array(bounds), _periods_between), 1)


def _periods_between(b: Column) -> Column:
    return F.when(b["s"] < b["e"], F.transform(_dates(b["s"], b["e"], b["f"]), lambda d: label(d, b["f"]))).otherwise(
        F.array(F.coalesce(b["start"], label(b["s"], b["f"]))))


def first_day_of_future_month(yyyymm, n) -> Column:
    """H8: ``yyyyMM`` + n months -> ``yyyy-MM-01``."""
    return F.date_format(F.add_months(month_start(yyyymm), _lit(n)), "yyyy-MM-01")


# The form of each frequency's period labels.
PERIOD_FORMS = {"monthly": "^[0-9]{6}$", "yearly": "^[0-9]{4}$", "weekly": "^[0-9]{4}W[0-9]{1,2}$",
                "quarterly": "^[0-9]{4}Q[1-4]$"}


def frequency_of(period) -> Column:
    """The frequency whose label form ``period`` has; NULL for any other text."""
    p = F.col(period) if isinstance(period, str) else period
    return F.coalesce(*[F.when(p.rlike(form), F.lit(name)) for name, form in PERIOD_FORMS.items()])
