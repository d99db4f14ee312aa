"""Dates, durations and intervals on columns.

A duration is ISO text on the outside and (months, microseconds) on the inside: ``P1M`` is not ``P30D``.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripleframe.model import column, names

DAY_MICROS = 86_400_000_000

# The 13 relations of two intervals.
ALLEN_RELATIONS = (
    "before", "meets", "overlaps", "starts", "during", "finishes", "equals",
    "after", "met_by", "overlapped_by", "started_by", "contains", "finished_by",
)

# Fixed pattern: ISO 8601 duration.
_DURATION = (
    r"^(-)?P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)(?:\.(\d{1,6}))?S)?)?$"
)


# Calendar -------------------------------------------------------------------------------------------


def month_start_date(year_month: Any) -> Column:
    """First day of a ``yyyy-MM``."""
    return F.to_date(F.concat(column(year_month), F.lit("-01")))


def month_end_date(year_month: Any) -> Column:
    """Last day of a ``yyyy-MM``."""
    return F.last_day(month_start_date(year_month))


def _months(start: Column, end: Column) -> Column:
    first = F.trunc(start, "MM").cast("date")
    return F.when(start < end, F.sequence(first, end, F.expr("interval 1 month")))


def month_start_dates(df: DataFrame, date: str, start: Any, end: Any) -> DataFrame:
    """Generate the first days of months in ``[start, end)``."""
    s, e = column(start).cast("date"), column(end).cast("date")
    return df.withColumn(names([date])[0], F.explode(F.filter(_months(s, e), lambda d: (d >= s) & (d < e))))


def month_end_dates(df: DataFrame, date: str, start: Any, end: Any) -> DataFrame:
    """Generate the last days of months in ``[start, end)``."""
    s, e = column(start).cast("date"), column(end).cast("date")
    lasts = F.transform(_months(s, e), F.last_day)
    return df.withColumn(names([date])[0], F.explode(F.filter(lasts, lambda d: (d >= s) & (d < e))))


def next_day(date: Any) -> Column:
    return F.date_add(column(date), 1)


def previous_day(date: Any) -> Column:
    return F.date_sub(column(date), 1)


def day_after(df: DataFrame, date: str, following: str) -> DataFrame:
    """Relate a date and the next day: the missing one is computed, two bound ones are checked."""
    d, n = names([date, following])
    if d in df.columns and n in df.columns:
        return df.where(F.col(n) == next_day(d))
    return df.withColumn(n, next_day(d)) if d in df.columns else df.withColumn(d, previous_day(n))


def day_before(df: DataFrame, date: str, previous: str) -> DataFrame:
    """Relate a date and the day before: the missing one is computed, two bound ones are checked."""
    return day_after(df, previous, date)


def weekday(date: Any) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(column(date)) + 1


def weekday_sunday_start(date: Any) -> Column:
    """Sunday 1 to Saturday 7."""
    return F.dayofweek(column(date))


def iso_year(date: Any) -> Column:
    """Year the ISO week belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), column(date))


def iso_week(date: Any) -> Column:
    return F.weekofyear(column(date))


# Durations ------------------------------------------------------------------------------------------


def parse_duration(text: Any) -> Column:
    """(months, micros) of ISO duration text; null if it is not a duration."""
    t = column(text)

    def part(n: int) -> Column:
        return F.coalesce(F.regexp_extract(t, _DURATION, n).try_cast("bigint"), F.lit(0))

    sign = F.when(F.startswith(t, F.lit("-")), -1).otherwise(1).cast("bigint")
    fraction = F.coalesce(F.rpad(F.regexp_extract(t, _DURATION, 9), 6, "0").try_cast("bigint"), F.lit(0))
    days = part(4) * 7 + part(5)
    micros = days * DAY_MICROS + part(6) * 3_600_000_000 + part(7) * 60_000_000 + part(8) * 1_000_000 + fraction
    ok = t.rlike(_DURATION) & ~F.endswith(t, F.lit("P")) & ~F.endswith(t, F.lit("T"))
    return F.when(
        ok, F.struct((sign * (part(2) * 12 + part(3))).alias("months"), (sign * micros).alias("micros"))
    )


def _seconds_text(micros: Column) -> Column:
    whole = _div(micros, 1_000_000).cast("string")
    rest = micros % 1_000_000
    fraction = F.regexp_replace(F.lpad(rest.cast("string"), 6, "0"), "0+$", "")
    return F.when(rest == 0, whole).otherwise(F.concat(whole, F.lit("."), fraction))


def _unit(n: Column, mark: str) -> Column:
    return F.when(n != 0, F.concat(n.cast("string"), F.lit(mark))).otherwise("")


def format_duration(months: Any, micros: Any) -> Column:
    """ISO text of a duration, the zero one being ``P0D``."""
    m, u = column(months).cast("bigint"), column(micros).cast("bigint")
    sign = F.when((m < 0) | (u < 0), F.lit("-")).otherwise("")
    m, u = F.abs(m), F.abs(u)
    in_day = u % DAY_MICROS
    date = F.concat(_unit(_div(m, 12), "Y"), _unit(m % 12, "M"), _unit(_div(u, DAY_MICROS), "D"))
    seconds = in_day % 60_000_000
    time = F.concat(
        _unit(_div(in_day, 3_600_000_000), "H"),
        _unit(_div(in_day % 3_600_000_000, 60_000_000), "M"),
        F.when(seconds != 0, F.concat(_seconds_text(seconds), F.lit("S"))).otherwise(""),
    )
    body = F.concat(date, F.when(time != "", F.concat(F.lit("T"), time)).otherwise(""))
    return F.concat(sign, F.lit("P"), F.when(body == "", F.lit("0D")).otherwise(body))


def _div(n: Column, d: int) -> Column:
    return F.call_function("div", n, F.lit(d))


def _moment(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp_ntz").cast("timestamp"))


def duration_between(start: Any, end: Any) -> Column:
    """Days and time between two moments as ISO text."""
    return format_duration(F.lit(0), _moment(column(end)) - _moment(column(start)))


def add_months(date: Column, months: Column) -> Column:
    """Add months; the last day of a month goes to the last day of the target month."""
    day = date.cast("date")
    moved = F.add_months(day, months.cast("int"))
    return F.when(day == F.last_day(day), F.last_day(moved)).otherwise(moved)


def _shift(value: Column, duration: Any, sign: int, kind: str) -> Column:
    d = parse_duration(duration)
    months, micros = d["months"] * sign, d["micros"] * sign
    if kind == "date":
        # A time of day cannot be added to a date: no value.
        return F.when(
            micros % DAY_MICROS == 0, F.date_add(add_months(value, months), _div(micros, DAY_MICROS).cast("int"))
        )
    moment = value.cast("timestamp_ntz")
    in_day = _moment(moment) - _moment(moment.cast("date"))
    total = _moment(add_months(moment, months)) + in_day + micros
    return F.timestamp_micros(total).cast("timestamp_ntz")


def plus_duration(start: Any, duration: Any, kind: str = "date") -> Column:
    """Start plus an ISO duration, for ``date`` or ``dateTime`` values."""
    return _shift(column(start), duration, 1, kind)


def minus_duration(end: Any, duration: Any, kind: str = "date") -> Column:
    """End minus an ISO duration, for ``date`` or ``dateTime`` values."""
    return _shift(column(end), duration, -1, kind)


def date_duration(df: DataFrame, start: str, end: str, duration: str) -> DataFrame:
    """Relate start, end and duration: any two give the third, all three are checked."""
    s, e, d = names([start, end, duration])
    held = next(c for c in (s, e) if c in df.columns)
    kind = "date" if df.schema[held].dataType.simpleString() == "date" else "dateTime"
    missing = [c for c in (s, e, d) if c not in df.columns]
    if not missing:
        end_by_duration = plus_duration(s, d, kind)
        return df.where((duration_between(s, e) == F.col(d)) | (end_by_duration == F.col(e)))
    if missing == [d]:
        return df.withColumn(d, duration_between(s, e))
    if missing == [e]:
        return df.withColumn(e, plus_duration(s, d, kind)).where(F.col(e).isNotNull())
    if missing == [s]:
        return df.withColumn(s, minus_duration(e, d, kind)).where(F.col(s).isNotNull())
    raise ValueError("two of start, end and duration must be bound")


# Intervals ------------------------------------------------------------------------------------------


def lexical_moment(c: Column, kind: str) -> Column:
    """Text of an endpoint: dates as ``yyyy-MM-dd``, moments with ``T`` and ``Z``."""
    if kind == "date":
        return F.date_format(c, "yyyy-MM-dd")
    if kind == "string":
        return c
    seconds = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    rest = F.regexp_replace(F.date_format(c, "SSSSSS"), "0+$", "")
    return F.concat(seconds, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""), F.lit("Z"))


def _kind(df: DataFrame, name: str) -> str:
    return {"date": "date", "string": "string"}.get(df.schema[name].dataType.simpleString(), "dateTime")


def endpoint(text: Column) -> Column:
    """Moment of an endpoint's text."""
    return F.try_to_timestamp(F.regexp_replace(text, "Z$", "")).cast("timestamp_ntz")


def endpoint_type(text: Any) -> Column:
    """Datatype of an endpoint's text."""
    return F.when(F.contains(column(text), F.lit("T")), F.lit("xsd:dateTime")).otherwise(F.lit("xsd:date"))


def interval_text(start: Any, end: Any) -> Column:
    """Interval of two endpoint texts."""
    return F.concat_ws("/", column(start), column(end))


def interval_start(interval: Any) -> Column:
    return F.split_part(column(interval), F.lit("/"), F.lit(1))


def interval_end(interval: Any) -> Column:
    return F.split_part(column(interval), F.lit("/"), F.lit(2))


def _same_kind(moment: Column, like: Column) -> Column:
    """Text of a computed moment: a date if the given endpoint is one and no time of day remains."""
    in_day = F.date_format(moment, "HH:mm:ss.SSSSSS") != "00:00:00.000000"
    return F.when(F.contains(like, F.lit("T")) | in_day, lexical_moment(moment, "dateTime")).otherwise(
        lexical_moment(moment, "date")
    )


def interval(df: DataFrame, start: str, end: str, value: str) -> DataFrame:
    """Relate endpoints and the half-open interval ``[start, end)``; split endpoints stay text."""
    s, e, v = names([start, end, value])
    if v not in df.columns:
        return df.withColumn(v, interval_text(_text_of(df, s), _text_of(df, e)))
    return _split(df, {s: interval_start(v), e: interval_end(v)})


def _text_of(df: DataFrame, name: str) -> Column:
    return lexical_moment(F.col(name), _kind(df, name))


def _moment_of(df: DataFrame, name: str) -> Column:
    """Moment of an endpoint column; only text is parsed."""
    return endpoint(F.col(name)) if _kind(df, name) == "string" else F.col(name).cast("timestamp_ntz")


def _split(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """Check the parts that are bound, bind the others."""
    for name, part in parts.items():
        df = df.where(_text_of(df, name) == part) if name in df.columns else df.withColumn(name, part)
    return df


def interval_start_duration(df: DataFrame, start: str, duration: str, value: str) -> DataFrame:
    """Relate an interval to its start and duration."""
    s, d, v = names([start, duration, value])
    if v in df.columns:
        length = duration_between(endpoint(interval_start(v)), endpoint(interval_end(v)))
        return _split(df, {s: interval_start(v), d: length})
    df = df.where(parse_duration(d).isNotNull()).withColumn("_moved", plus_duration(_moment_of(df, s), d, "dateTime"))
    begin = _text_of(df, s)
    return df.withColumn(v, interval_text(begin, _same_kind(F.col("_moved"), begin))).drop("_moved")


def interval_duration_end(df: DataFrame, duration: str, end: str, value: str) -> DataFrame:
    """Relate an interval to its duration and end."""
    d, e, v = names([duration, end, value])
    if v in df.columns:
        length = duration_between(endpoint(interval_start(v)), endpoint(interval_end(v)))
        return _split(df, {d: length, e: interval_end(v)})
    df = df.where(parse_duration(d).isNotNull()).withColumn("_moved", minus_duration(_moment_of(df, e), d, "dateTime"))
    finish = _text_of(df, e)
    return df.withColumn(v, interval_text(_same_kind(F.col("_moved"), finish), finish)).drop("_moved")


def interval_relation(x_start: Any, x_end: Any, y_start: Any, y_end: Any) -> Column:
    """Name of the relation between ``[x_start, x_end)`` and ``[y_start, y_end)``: exactly one of 13."""
    a, b, c, d = (column(p) for p in (x_start, x_end, y_start, y_end))
    return (
        F.when(b < c, "before")
        .when(b == c, "meets")
        .when(d < a, "after")
        .when(d == a, "met_by")
        .when((a == c) & (b == d), "equals")
        .when(a == c, F.when(b < d, "starts").otherwise("started_by"))
        .when(b == d, F.when(a > c, "finishes").otherwise("finished_by"))
        .when((a > c) & (b < d), "during")
        .when((a < c) & (b > d), "contains")
        .when(a < c, "overlaps")
        .when(a > c, "overlapped_by")
    )


def interval_relation_typed(x: Any, y: Any) -> Column:
    """Name of the relation between two interval values."""
    ends = [endpoint(f(v)) for v in (x, y) for f in (interval_start, interval_end)]
    return interval_relation(*ends)


def holds(relation: str, *ends: Any) -> Column:
    """Whether a named relation holds between two intervals."""
    if relation not in ALLEN_RELATIONS:
        raise ValueError(f"unknown interval relation {relation}")
    return interval_relation(*ends) == relation
