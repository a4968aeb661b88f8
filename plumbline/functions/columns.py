"""Row-level derivations, all built from JVM-side column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

OTHERS = "Others"
MISSING = "missing"
TOTAL = "total"

# Fixed value: four digits in round brackets.
YEAR_PATTERN = r"\((\d{4})\)"


def capture(column: Column | str, pattern: str, group: int = 1) -> Column:
    """First regex capture, NULL (not the empty string) when nothing matches."""
    return F.nullif(F.regexp_extract(column, pattern, group), F.lit(""))


def year_of(title: Column | str) -> Column:
    return capture(title, YEAR_PATTERN)


def as_text(column: Column | str) -> Column:
    """Cast to string; NULL stays NULL."""
    return _col(column).cast("string")


def number(column: Column | str) -> Column:
    """Double with NaN read as NULL, the one missing value used here."""
    value = _col(column).cast("double")
    return F.when(~F.isnan(value), value)


def present(df: DataFrame, name: str) -> Column:
    """The column; NaN in a floating-point one is read as NULL."""
    kind = df.schema[name].dataType
    value = F.col(name)
    return F.when(~F.isnan(value), value) if isinstance(kind, (DoubleType, FloatType)) else value


def present_text(df: DataFrame, name: str) -> Column:
    return present(df, name).cast("string")


def unreserved(text: Column | str, *names: str) -> Column:
    """The text, in double quotes if it reads like a reserved row name."""
    value = _col(text)
    quoted = F.concat(F.lit('"'), value, F.lit('"'))
    return F.when(value.isin(*(names or (MISSING, TOTAL))), quoted).otherwise(value)


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """UTC wall time, independent of the session time zone."""
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    zero = F.lit(0)
    return start + F.make_dt_interval(zero, zero, zero, _col(seconds))


def epoch_seconds(wall_time: Column | str) -> Column:
    """Whole seconds since 1970 of a UTC wall time."""
    t = _col(wall_time)
    days = F.datediff(t, F.lit("1970-01-01")).cast("long")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def month_text(timestamp: Column | str) -> Column:
    """Two-digit month, e.g. ``03``."""
    return F.date_format(timestamp, "MM")


def percent_label(share: Column | str) -> Column:
    """``0.2829`` becomes ``28.29%``."""
    return F.concat(F.round(_col(share) * 100, 2).cast("string"), F.lit("%"))


def feature_kind(name: Column | str, categorical: Sequence[str]) -> Column:
    """``categorical`` when the name is in the list, else ``numerical``."""
    return F.when(_col(name).isin(*categorical), F.lit("categorical")).otherwise(
        F.lit("numerical")
    )


def share(part: Column, whole: Column) -> Column:
    """``part / whole``; NULL instead of an error when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def hash_number(*parts: Column | str) -> Column:
    """A repeatable 60-bit number from the md5 of the parts joined by ``|``."""
    text = F.concat_ws("|", *[_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


_ESCAPES = (
    r"(?:\\u[0-9a-fA-F]{4})+|\\U[0-9a-fA-F]{8}|\\x[0-9a-fA-F]{2}|\\[0-7]{1,3}"
    r"|\\[abfnrtv\\'\"]|[^\\]+|\\"
)
# What a backslash and a letter stand for.
_NAMED = {"a": 7, "b": 8, "t": 9, "n": 10, "v": 11, "f": 12, "r": 13, "\\": 92, "'": 39, '"': 34}


def decode_escapes(column: Column | str) -> Column:
    """Text with backslash escapes turned into their characters.

    ``\\xhh``, ``\\uhhhh`` (pairs of surrogates too), ``\\Uhhhhhhhh``, one to three octal digits, and
    the named ones; any other backslash stays as it is.
    """
    text = _col(column)

    def character(part: Column) -> Column:
        def of(hexadecimal: Column, encoding: str) -> Column:
            return F.decode(F.unhex(hexadecimal), encoding)

        octal = F.conv(F.substring(part, 2, 3), 8, 16)
        made = (
            F.when(part.startswith("\\u"), of(F.replace(part, F.lit("\\u"), F.lit("")), "UTF-16BE"))
            .when(part.startswith("\\U"), of(F.substring(part, 3, 8), "UTF-32"))
            .when(part.startswith("\\x"), of(F.concat(F.lit("00"), F.substring(part, 3, 2)), "UTF-16BE"))
            .when(part.rlike(r"^\\[0-7]"), of(F.lpad(octal, 4, "0"), "UTF-16BE"))
        )
        for letter, code in _NAMED.items():
            made = made.when(part == F.lit("\\" + letter), F.lit(chr(code)))
        return made.otherwise(part)

    parts = F.regexp_extract_all(text, F.lit(_ESCAPES), F.lit(0))
    decoded = F.array_join(F.transform(parts, character), "")
    return F.when(F.contains(text, F.lit("\\")), decoded).otherwise(text)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
