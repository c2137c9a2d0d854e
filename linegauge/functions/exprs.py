"""Column -> Column helpers: ratios, flags, calendar, buckets, comparison of periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- ratios and flags -----------------------------------------------------------

def ratio(num, den) -> Column:
    """num / den as double; null when the denominator is 0 or null."""
    return F.when(_c(den) != 0, _c(num).cast("double") / _c(den))


def ratio_or_zero(num, den) -> Column:
    """num / den as double; 0 when the denominator is not positive."""
    return F.when(_c(den) > 0, _c(num).cast("double") / _c(den)).otherwise(F.lit(0.0))


def flag(cond: Column, when_null: bool = False) -> Column:
    """A boolean that is never null: null counts as ``when_null``."""
    return F.coalesce(cond, F.lit(when_null))


def bit(cond: Column) -> Column:
    """A boolean as 0/1, null as 0."""
    return flag(cond).cast("int")


def all_of(*conds: Column) -> Column:
    return flag(reduce(lambda a, b: a & b, conds))


# -- time -----------------------------------------------------------------------

def day_micros(ts) -> Column:
    """Microseconds since midnight, in the session zone."""
    ts = _c(ts).cast("timestamp")
    return F.unix_micros(ts) - F.unix_micros(F.date_trunc("DAY", ts))


def _clock(text: str) -> int:
    h, m, s = (int(p) for p in text.split(":"))
    return ((h * 60 + m) * 60 + s) * 1_000_000


def in_clock_window(ts, start: str, end: str) -> Column:
    """Time of day between two clock readings, both included, to the microsecond."""
    return day_micros(ts).between(_clock(start), _clock(end))


def clock_bucket(ts, windows: Sequence[tuple[str, str, str]]) -> Column:
    """Label of the first window (label, start, end) the time of day lies in, else null."""
    out = F.lit(None).cast("string")
    for label, start, end in reversed(windows):
        out = F.when(in_clock_window(ts, start, end), F.lit(label)).otherwise(out)
    return out


def hours_crossed(a, b) -> Column:
    """Hour boundaries passed between two timestamps (13:50 -> 14:10 is 1)."""
    hour = lambda ts: F.unix_seconds(F.date_trunc("HOUR", _c(ts).cast("timestamp")))
    return ((hour(b) - hour(a)) / 3600).cast("bigint")


def minutes_between(a, b) -> Column:
    """Absolute distance in minutes, with fractions."""
    micros = lambda ts: F.unix_micros(_c(ts).cast("timestamp"))
    return F.abs(micros(a) - micros(b)) / F.lit(60_000_000.0)


def month_start(ts) -> Column:
    return F.trunc(_c(ts), "month")


def week_start(ts) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", _c(ts)).cast("date")


def in_period(ts, start: str, end: str, closed_at_midnight: bool = False) -> Column:
    """Rows of a period given by two dates.

    By default the whole end day belongs to the period. ``closed_at_midnight`` keeps the
    literal reading ``ts <= end 00:00``, which leaves the last day out.
    """
    ts = _c(ts)
    low = F.to_timestamp(F.lit(start))
    high = F.to_timestamp(F.lit(end))
    if closed_at_midnight:
        return (ts >= low) & (ts <= high)
    return (ts >= low) & (ts < high + F.expr("INTERVAL 1 DAY"))


def on_day(ts, day: str) -> Column:
    """Calendar-day equality as a range, so that it reaches the scan."""
    return in_period(ts, day, day)


# -- buckets, rounding, change --------------------------------------------------

def right_closed_bucket(x, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edge[i-1], edge[i]]; the first takes everything up to its edge."""
    x = _c(x)
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels))):
        out = F.when(x <= F.lit(float(edge)), F.lit(label)).otherwise(out)
    return F.when(x.isNotNull(), out)


def relative_change(cur, prior) -> Column:
    """(cur - prior) / |prior|; null when the prior value is 0 or missing."""
    return F.when(_c(prior) != 0, (_c(cur) - _c(prior)) / F.abs(_c(prior)))


def change_arrow(cur, prior) -> Column:
    change = relative_change(cur, prior)
    return F.when(change.isNull(), F.lit("")).when(change > 0, F.lit("up")).otherwise(F.lit("down"))


def change_verdict(cur, prior, lower_is_better: bool) -> Column:
    change = relative_change(cur, prior)
    better = (change < 0) if lower_is_better else (change > 0)
    return F.when(change.isNull(), F.lit("neutral")).when(better, F.lit("good")).otherwise(F.lit("bad"))


def ordinal(col, order: Sequence[str]) -> Column:
    """Position of a value in a given order; unknown values come last."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), _c(col))
    return F.when(pos > 0, pos - 1).otherwise(F.lit(len(order)))


# -- text -----------------------------------------------------------------------

def normalised(col, fold_case: bool = True, null_token: str = "__null__") -> Column:
    """Text form used for comparing values; null becomes a token."""
    text = _c(col).cast("string")
    if fold_case:
        text = F.lower(F.trim(text))
    return F.coalesce(text, F.lit(null_token))


def fingerprint_text(cols: Sequence[str], leave_out: Sequence[str] = (), fold_case: bool = False) -> Column:
    """``col=value|col=value`` over the given columns."""
    return F.concat_ws("|", *[F.concat(F.lit(f"{c}="), normalised(c, fold_case))
                              for c in cols if c not in leave_out])


def title_text(col) -> Column:
    return F.initcap(F.replace(_c(col), F.lit("_"), F.lit(" ")))


def has_outer_space(col) -> Column:
    return _c(col) != F.trim(_c(col))


def composite_label(*cols, missing: str = "(no shift)", sep: str = " | ") -> Column:
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit(missing)) for c in cols])


def after_prefix(col, sep: str = "__") -> Column:
    """Text after the last separator."""
    return F.element_at(F.split(_c(col), sep), -1)


def gauge_number(col) -> Column:
    """Number in front of ``ga`` (``16ga Steel`` -> 16), else null."""
    digits = F.regexp_extract(_c(col), r"(\d+)ga", 1)
    return F.when(digits != "", digits.cast("int"))


def map_value(col, mapping: Mapping[str, str], fallback: Column | None = None) -> Column:
    """Value of a small fixed mapping; ``fallback`` (default: the key) when absent."""
    col = _c(col)
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col if fallback is None else fallback)


def reasons(*pairs: tuple[Column, Column | str]) -> Column:
    """Array of the texts whose condition holds, in the given order."""
    items = [F.when(flag(cond), text if isinstance(text, Column) else F.lit(text)) for cond, text in pairs]
    return F.array_compact(F.array(*items))
