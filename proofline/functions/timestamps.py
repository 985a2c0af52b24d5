"""ISO 8601 timestamps with an explicit offset, entirely in native expressions.

The accepted grammar is that of the standard Python parser (calendar dates, basic and week forms,
any separator character, comma or dot fractions, hour-only times), which Spark's own cast neither
contains nor is contained in.  Text in the everyday form takes a short path through
``try_to_timestamp``; only the rest is taken apart by the long pattern.

Two departures, both towards rejecting the row instead of failing the run: an offset with seconds
and an instant that leaves the years 1 to 9999 when moved to UTC count as invalid.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EVERYDAY = (
    r"^(?!000[01]|9999)[0-9]{4}-[0-9]{2}-[0-9]{2}T(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"
    r"(?:\.[0-9]{1,6})?(?:Z|[+-](?:0[0-9]|1[0-7]):[0-5][0-9])\z"
)

# Date forms.  The look-aheads decide where a week date ends when a digit or a hyphen follows it.
_DATE = (
    r"(?:([0-9]{4})-([0-9]{2})-([0-9]{2})"  # 1-3 YYYY-MM-DD
    r"|([0-9]{4})([0-9]{2})([0-9]{2})"  # 4-6 YYYYMMDD
    r"|([0-9]{4})-W([0-9]{2})(?=-[0-9][0-9])"  # 7-8 YYYY-Www, hyphen as separator
    r"|([0-9]{4})-W([0-9]{2})-([0-9])(?![0-9])"  # 9-11 YYYY-Www-D
    r"|([0-9]{4})-W([0-9]{2})(?!-)"  # 12-13 YYYY-Www
    r"|([0-9]{4})W([0-9]{2})(?=[0-9](?:[0-9]{2})+(?![0-9]))"  # 14-15 YYYYWww, digit as separator
    r"|([0-9]{4})W([0-9]{2})([0-9])(?:(?![0-9])|(?=[0-9](?:[0-9]{2})*(?![0-9])))"  # 16-18 YYYYWwwD
    r"|([0-9]{4})W([0-9]{2})(?![0-9]))"  # 19-20 YYYYWww
)
_CLOCK = (
    r"(?:([0-9]{2})"  # 21 hour
    r"(?::([0-9]{2})(?::([0-9]{2}))?+|([0-9]{2})(?:([0-9]{2}))?+)?+"  # 22-23 or 24-25
)
# Digits after the sixth are ignored, and with an offset so is anything else up to the offset.
_AWARE_TAIL = (
    r"(?:(?:[.,]|(?<=:[0-9]{2}:[0-9]{2}):|(?<=[0-9]{6})(?=[0-9]{2}))"
    r"(?:([0-9]{6})[^+\-Z]*|([0-9]{1,5}))|[\x00-\x7f&&[^+\-Z]])?"  # 26-27 fraction
    r"(?:Z|([+-])([0-9]{2})(?::?([0-9]{2}))?)\z"  # 28-30 offset
)
_NAIVE_TAIL = (
    r"(?:(?:(?:[.,]|(?<=:[0-9]{2}:[0-9]{2}):|(?<=[0-9]{6})(?=[0-9]{2}))"
    r"(?:([0-9]{6})[0-9]*(?:\x00[^+\-Z]*)?|([0-9]{1,5})))|\x00)?\z"
)
_AWARE_PATTERN = rf"(?s)^{_DATE}.{_CLOCK}{_AWARE_TAIL})"
_NAIVE_PATTERN = rf"(?s)^{_DATE}(?:.{_CLOCK}{_NAIVE_TAIL})|\z)"
_FIELDS = (
    "$1$4$7$9$12$14$16$19|$2$5|$3$6|$8$10$13$15$17$20|$11$18|$21|$22$24|$23$25|$26$27"
)
OFFSET_PATTERN = r"(Z|[+-][0-9]{2}(?::?[0-9]{2})?)\z"


def _let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` inside ``body``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _number(text: str, default: int) -> str:
    return f"if({text} = '', {default}, cast({text} as int))"


# Day of an ISO week date ``p``; NULL when the week or the weekday does not exist.
_WEEK_DAY = _let(
    "date_add(date_sub(make_date(cast(p[0] as int), 1, 4), weekday(make_date(cast(p[0] as int), 1, 4))),"
    " (cast(p[3] as int) - 1) * 7)",
    "monday",
    _let(
        _number("p[4]", 1),
        "weekday",
        "case when weekofyear(monday) = cast(p[3] as int) and weekday between 1 and 7"
        " and year(date_add(monday, weekday - 1)) <= 9999 then date_add(monday, weekday - 1) end",
    ),
)
# Microseconds of the wall-clock parts ``p`` read as UTC; NULL when a part is out of range.
_WALL_CLOCK = f"""case when p[0] <> '0000' and {_number("p[5]", 0)} <= 23 and {_number("p[6]", 0)} <= 59
  and {_number("p[7]", 0)} <= 59 then
  unix_micros(cast(case when p[3] = '' then to_date(try_to_timestamp(concat_ws('-', p[0], p[1], p[2]), 'yyyy-MM-dd'))
    else {_WEEK_DAY} end as timestamp))
  + cast({_number("p[5]", 0)} * 3600 + {_number("p[6]", 0)} * 60 + {_number("p[7]", 0)} as bigint) * 1000000
  + if(p[8] = '', 0, cast(rpad(p[8], 6, '0') as int)) end"""


def _parts(pattern: str) -> str:
    return f"split(regexp_replace(t, r'{pattern}', '{_FIELDS}'), r'\\|')"


# Minutes east of UTC of offset text ``z``; NULL from a whole day on.
_OFFSET = _let(
    "regexp_replace(z, '[^0-9]', '')",
    "digits",
    _let(
        f"{_number('substring(digits, 1, 2)', 0)} * 60 + {_number('substring(digits, 3, 2)', 0)}",
        "minutes",
        "case when minutes < 1440 then if(startswith(z, '-'), -minutes, minutes) end",
    ),
)
_AWARE_MICROS = (
    _let(_parts(_AWARE_PATTERN), "p", _WALL_CLOCK)
    + " - 60000000L * "
    + _let(f"regexp_extract(t, r'{OFFSET_PATTERN}', 1)", "z", _OFFSET)
)
_AWARE = _let(
    f"timestamp_micros({_AWARE_MICROS})", "moment", "case when year(moment) between 1 and 9999 then moment end"
)
_ANY_FORM = f"""case
  when t rlike r'{_AWARE_PATTERN}' then named_struct('instant', {_AWARE}, 'naive', false)
  when t rlike r'{_NAIVE_PATTERN}' then
    named_struct('instant', cast(null as timestamp), 'naive', {_let(_parts(_NAIVE_PATTERN), "p", _WALL_CLOCK)} is not null)
  else named_struct('instant', cast(null as timestamp), 'naive', false) end"""


def parse_timestamp(column: str) -> Column:
    """Struct ``(instant, naive)``: a valid time without offset has no instant but ``naive`` set."""
    return F.expr(
        f"""case when {column} rlike r'{_EVERYDAY}'
          then named_struct('instant', try_to_timestamp({column}), 'naive', false)
          when {column} is not null then {_let(column, "t", _ANY_FORM)} end"""
    )


def offset_text(text: Column) -> Column:
    """The offset exactly as written at the end of an accepted timestamp."""
    return F.regexp_extract(text, OFFSET_PATTERN, 1)


def iso_utc(instant: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss[.ffffff]+00:00``; the fraction only when it is not zero."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(instant), F.lit(1_000_000))
    fraction = F.when(micros == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    )
    return F.concat(whole, fraction, F.lit("+00:00"))
