"""Text cells to typed values, as column expressions.

Each rule yields a value and an error. Blank cells give neither. Cells that come from a
spreadsheet already typed carry a ``kind``: ``text``, ``int``, ``float``, ``datetime``, ``date``
or ``bool``; without one every cell is text.

Integers and decimals come back in a wide decimal so that bounds are checked on what the tenant
wrote; :func:`stored` narrows them afterwards.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SPARK_TYPES, ContractError, ParseOptions
from .text import collapse, is_collapsed, strip
from .timeutil import local_to_utc

# What tenants write for yes and no, currency marks, spreadsheet date serials.
TRUE_VALUES = ("true", "t", "yes", "y", "1", "x")
FALSE_VALUES = ("false", "f", "no", "n", "0")
_MARKS = "$€£¢"
CURRENCY = rf"(?i)[{_MARKS}]|CAD|USD"
SERIAL_EPOCH = "1899-12-30 00:00:00"
SERIAL_MIN, SERIAL_MAX = 20000, 80000
EXAMPLE = dt.datetime(2026, 7, 4, 14, 30)
EXPECTED = {
    "integer": "expected a whole number",
    "decimal": "expected a number",
    "date": "expected a date",
    "timestamp": "expected a date and time",
    "boolean": "expected yes or no",
}

WIDE_INTEGER = "decimal(38,0)"
WIDE_DECIMAL = "decimal(38,18)"
NUMBER_KINDS = ("int", "float")
_MARK = "\u0001"


@dataclass(frozen=True)
class Coerced:
    cell: Column  # struct<value, bad>, or the text itself of a type that reads any text
    message: Column
    is_text: bool = False

    @property
    def value(self) -> Column:
        return self.value_of(self.cell)

    @property
    def error(self) -> Column:
        """Null when the cell was readable or blank."""
        return F.when(self.bad_of(self.cell), self.message)

    def value_of(self, cell: Column) -> Column:
        return F.nullif(cell, F.lit("")) if self.is_text else cell["value"]

    def bad_of(self, cell: Column) -> Column:
        """Whether a cell is neither blank nor readable."""
        return F.lit(False) if self.is_text else cell["bad"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate an expression once and use it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def coerce(
    text: Column,
    type_: str,
    opts: ParseOptions = ParseOptions(),
    zone: Column | str = "UTC",
    kind: Column | None = None,
) -> Coerced:
    """Coerce one cell column. ``kind`` is null or absent for text cells."""
    if type_ not in SPARK_TYPES:
        raise ContractError(f"unknown type {type_!r}")
    if type_ == "string":
        return Coerced(_string(text, kind), unread(type_, opts), is_text=True)
    zone = F.lit(zone) if isinstance(zone, str) else zone
    rules = {
        "integer": lambda t: _integer(t, opts, kind),
        "decimal": lambda t: _decimal(t, opts, kind),
        "date": lambda t: _date(t, opts, kind),
        "timestamp": lambda t: _timestamp(t, opts, zone, kind),
        "boolean": _boolean,
    }
    cell = let(
        strip(text),
        lambda t: let(
            F.when(t != "", rules[type_](t)),
            lambda v: F.struct(
                v.alias("value"), (F.coalesce(t != "", F.lit(False)) & v.isNull()).alias("bad")
            ),
        ),
    )
    return Coerced(cell, unread(type_, opts, kind))


def quick(text: Column, type_: str, opts: ParseOptions = ParseOptions(), zone: Column | str = "UTC") -> Column | None:
    """What :func:`stored` makes of a text cell in the plainest form of its type, read by one pattern and one
    cast; null for any other cell, whatever it holds. None where a type has no such form."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    if type_ == "integer":
        return F.when(text.rlike(r"\A-?\d{1,9}\z"), text.try_cast("int"))
    if type_ == "decimal":
        point = opts.decimal_separator
        bare = F.ltrim(text, F.lit(_MARKS))
        number = (F.translate(bare, ",", ".") if point == "," else bare).try_cast(SPARK_TYPES[type_])
        return F.when(text.rlike(rf"\A[{_MARKS}]?-?\d{{1,10}}(?:[{point}]\d{{1,2}})?\z"), number)
    if type_ == "date" and not opts.date_formats:
        return F.when(text.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), text.try_cast("date"))
    if type_ == "timestamp" and not opts.timestamp_formats:
        shaped = text.rlike(r"\A\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2})?)?\z")
        moment = text.try_cast("timestamp_ntz")
        return F.when(shaped, F.when(zone == "UTC", moment).otherwise(local_to_utc(moment, zone)))
    return None


def unread(type_: str, opts: ParseOptions, kind: Column | None = None) -> Column:
    """What to say of a cell that can't be read as the type; any text can be read as a string."""
    if type_ == "string":
        return F.lit(None).cast("string")
    message = F.lit(expected(type_, opts))
    if kind is not None and type_ in ("date", "timestamp"):
        message = F.when(kind.isin(*NUMBER_KINDS), EXPECTED["date"]).otherwise(message)
    return message


def stored(value: Column, type_: str) -> Column:
    """Narrow a coerced value to its storage type (decimals round half up to cents)."""
    return value.try_cast(SPARK_TYPES[type_])


def expected(type_: str, opts: ParseOptions) -> str:
    """Error text, with an example in the tenant's first format where there is one."""
    formats = {"date": opts.date_formats, "timestamp": opts.timestamp_formats}.get(type_, ())
    return EXPECTED[type_] + (f" like {EXAMPLE.strftime(formats[0])}" if formats else "")


def _is(kind: Column | None, *kinds: str) -> Column:
    return F.lit(False) if kind is None else F.coalesce(kind.isin(*kinds), F.lit(False))


def _string(text: Column, kind: Column | None) -> Column:
    value = F.when(is_collapsed(text), text).otherwise(let(text, collapse))
    if kind is None:
        return value
    # A spreadsheet shows 101 for the number 101.0.
    return F.when(_is(kind, "float"), F.regexp_replace(value, r"\A(-?\d+)\.0+\z", "$1")).otherwise(value)


def _plain_number(text: Column, opts: ParseOptions) -> Column:
    """Drop blanks and thousands separators, make the decimal separator a point."""
    if opts.decimal_separator == ",":
        return F.translate(text, ",. \u00a0", ".")
    return F.translate(text, ", \u00a0", "")


def _integer(text: Column, opts: ParseOptions, kind: Column | None) -> Column:
    def whole(t: Column) -> Column:
        return F.when(t.rlike(r"\A-?\d+(?:\.0+)?\z"), t.try_cast(WIDE_INTEGER))

    value = let(_plain_number(text, opts), whole)
    if kind is None:
        return value
    number = text.try_cast(WIDE_DECIMAL)
    return (
        F.when(_is(kind, "bool"), F.lit(None))
        .when(_is(kind, *NUMBER_KINDS), F.when(number == F.floor(number), number.try_cast(WIDE_INTEGER)))
        .otherwise(value)
    )


def _decimal(text: Column, opts: ParseOptions, kind: Column | None) -> Column:
    literal = r"\A[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?\z"

    def finite(t: Column) -> Column:
        return F.when(t.rlike(literal), t.try_cast(WIDE_DECIMAL))

    def signed(amount: Column) -> Column:
        bare = strip(F.regexp_replace(amount, r"\A[()]+|[()]+\z", ""))
        number = let(F.translate(_plain_number(bare, opts), "_", ""), finite)
        sign = F.when(amount.startswith("(") & amount.endswith(")"), -1).otherwise(1)
        return (number * sign).cast(WIDE_DECIMAL)

    value = let(strip(F.regexp_replace(text, CURRENCY, "")), signed)
    if kind is None:
        return value
    return (
        F.when(_is(kind, "bool"), F.lit(None))
        .when(_is(kind, *NUMBER_KINDS), finite(text))
        .otherwise(value)
    )


def _boolean(text: Column) -> Column:
    return let(
        F.lower(text),
        lambda word: F.when(word.isin(*TRUE_VALUES), F.lit(True)).when(
            word.isin(*FALSE_VALUES), F.lit(False)
        ),
    )


def _serial(text: Column) -> Column:
    days = text.try_cast("decimal(20,10)")
    seconds = (days * 86400).cast("decimal(18,6)")
    zero = F.lit(0)
    moment = F.lit(SERIAL_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
    return F.when(days.between(SERIAL_MIN, SERIAL_MAX), moment)


def _matched(text: Column, pattern: str, groups: int, body: Callable[[Column], Column]) -> Column:
    """``body`` of the capture groups of a full match (group n at n), null without a match."""
    marked = F.regexp_replace(
        text, rf"\A(?:{pattern})\z", _MARK + _MARK.join(f"${i}" for i in range(1, groups + 1))
    )
    return let(F.split(marked, _MARK), lambda parts: F.when(F.size(parts) == groups + 1, body(parts)))


def _moment(y: Column, mo: Column, d: Column, h: Column, mi: Column, s: Column) -> Column:
    def whole(c: Column) -> Column:
        return c.try_cast("int")

    return F.try_make_timestamp_ntz(
        whole(y), whole(mo), whole(d), whole(h), whole(mi), s.try_cast("decimal(16,6)")
    )


# The parts of a strptime pattern and the text each one accepts.
_DIRECTIVES = {
    "Y": r"(\d{4})",
    "y": r"(\d{2})",
    "m": r"(1[0-2]|0?[1-9])",
    "d": r"(3[01]|[12]\d|[0 ]?[1-9])",
    "H": r"(2[0-3]|[01]?\d)",
    "I": r"(1[0-2]|[0 ]?[1-9])",
    "M": r"([0-5]?\d)",
    "S": r"([0-5]?\d)",
    "f": r"(\d{1,6})",
    "p": r"([AaPp][Mm])",
}


def _formatted(text: Column, fmt: str) -> Column:
    """Parse text with one strptime pattern to a naive timestamp, null when it does not fit."""
    pattern, order, i = "", [], 0
    while i < len(fmt):
        ch = fmt[i]
        if ch == "%":
            code = fmt[i + 1 : i + 2]
            if code == "%":
                pattern += "%"
            elif code in _DIRECTIVES and code not in order:
                pattern += _DIRECTIVES[code]
                order.append(code)
            else:
                raise ContractError(f"unsupported date pattern {fmt!r}")
            i += 2
        elif ch.isspace():
            while i < len(fmt) and fmt[i].isspace():
                i += 1
            pattern += r"\s+"
        else:
            pattern += re.escape(ch)
            i += 1

    def moment(parts: Column) -> Column:
        def part(code: str, default: str) -> Column:
            if code not in order:
                return F.lit(default)
            return F.trim(F.get(parts, F.lit(order.index(code) + 1)))

        year = part("Y", "1900")
        if "y" in order:
            short = part("y", "0").try_cast("int")
            year = (F.when(short >= 69, 1900).otherwise(2000) + short).cast("string")
        hour = part("H", "0")
        if "I" in order:
            noon = F.when(F.lower(part("p", "AM")) == "pm", 12).otherwise(0)
            hour = (part("I", "12").try_cast("int") % 12 + noon).cast("string")
        seconds = F.concat(part("S", "0"), F.lit("."), part("f", "0"))
        return _moment(year, part("m", "1"), part("d", "1"), hour, part("M", "0"), seconds)

    return _matched(text, pattern, len(order), moment)


_ISO_DATE = r"(\d{4})-?(\d{2})-?(\d{2})"
_ISO_DAY = r"(?:\d{4}-\d{2}-\d{2}|\d{8})"
_ISO_TIME = (
    r"(?:\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?|\d{2}(?:\d{2}(?:\d{2}(?:[.,]\d+)?)?)?)"
    r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?"
)


def _iso_date(text: Column) -> Column:
    zero = F.lit("0")

    def day(parts: Column) -> Column:
        return _moment(
            F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), zero, zero, zero
        )

    return F.when(text.rlike(rf"\A{_ISO_DAY}\z"), _matched(text, _ISO_DATE, 3, day))


def _iso_timestamp(text: Column, zone: Column) -> Column:
    """ISO text to naive UTC. An offset in the text wins over the tenant's zone."""
    time = r"(\d{2})?:?(\d{2})?:?(\d{2})?(?:[.,](\d+))?"
    offset = r"(?:(Z)|([+-])(\d{2}):?(\d{2})?:?(\d{2})?)?"

    def moment(parts: Column) -> Column:
        def part(i: int, default: str = "0") -> Column:
            p = F.get(parts, F.lit(i))
            return F.when(p == "", default).otherwise(p)

        fraction = F.substring(F.rpad(part(7), 6, "0"), 1, 6)
        seconds = F.concat(part(6), F.lit("."), fraction)
        away = part(10).try_cast("int") * 3600 + part(11).try_cast("int") * 60 + part(12).try_cast("int")
        away = F.when(part(9, "") == "-", -away).otherwise(away)
        zero = F.lit(0)
        has_offset = (part(8, "") != "") | (part(9, "") != "")
        return let(
            _moment(part(1), part(2), part(3), part(4), part(5), seconds),
            lambda local: F.when(
                has_offset, local - F.make_dt_interval(zero, zero, zero, away)
            ).otherwise(local_to_utc(local, zone)),
        )

    shaped = text.rlike(rf"(?s)\A{_ISO_DAY}(?:.{_ISO_TIME})?\z")
    return F.when(shaped, _matched(text, rf"{_ISO_DATE}(?:(?s:.){time}{offset})?", 12, moment))


def _first(values: Sequence[Column]) -> Column:
    return values[0] if len(values) == 1 else F.coalesce(*values)


def _date(text: Column, opts: ParseOptions, kind: Column | None) -> Column:
    value = _first([*[_formatted(text, f) for f in opts.date_formats], _iso_date(text)]).cast("date")
    if kind is None:
        return value
    return (
        F.when(_is(kind, "datetime", "date"), _iso_date(F.substring(text, 1, 10)).cast("date"))
        .when(_is(kind, *NUMBER_KINDS), _serial(text).cast("date"))
        .otherwise(value)
    )


def _timestamp(text: Column, opts: ParseOptions, zone: Column, kind: Column | None) -> Column:
    local = [local_to_utc(_formatted(text, f), zone) for f in opts.timestamp_formats]
    iso = _iso_timestamp(text, zone)
    if kind is None:
        return _first([*local, iso])
    # Typed moments are ISO text already and skip the tenant's formats.
    moment = _is(kind, "datetime", "date")
    number = F.when(_is(kind, *NUMBER_KINDS), local_to_utc(_serial(text), zone))
    formats = [F.when(~moment & ~_is(kind, *NUMBER_KINDS), c) for c in local]
    return F.coalesce(number, *formats, F.when(~_is(kind, *NUMBER_KINDS), iso))
