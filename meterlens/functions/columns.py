"""Scalar column expressions used by the operators.

Everything here compiles to built-in Catalyst expressions, so it stays inside
whole-stage codegen; nothing calls back into Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (``str.isspace``),
# so trimming in Spark matches trimming at ingest time character for character.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Text that ends a clock time with an explicit zone: ``Z``, an offset, or a
# zone name (``UTC``, ``GMT+1``, ``Europe/London``).
ZONED_TIME = (
    r":[0-9]{2}([.][0-9]+)?[ ]*"
    r"([Zz]|[+-][0-9]{1,2}(:?[0-9]{2})?|(UTC|GMT|UT)([+-][0-9:]+)?|[A-Za-z]+/[A-Za-z_]+)$"
)

_EPOCH_NTZ = "1970-01-01 00:00:00"

# English day names in ``dayofweek`` order (1 = Sunday).
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

# Energy texts meaning "no reading" (compared case-insensitively).
MISSING_ENERGY_TEXTS = ("null", "none", "")

# A plain decimal number: optional sign, digits with an optional fraction (or a
# bare fraction), optional exponent.  Java's double parser behind Spark's cast
# also takes type suffixes (``0.5d``, ``1f``) and hex floats; those are not
# numbers to Python's ``float`` and must not be to us either.  Deliberately
# ASCII digits only (Python would also read ``1_000`` and non-ASCII digits).
DECIMAL_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

_INF = float("inf")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Trim leading/trailing whitespace exactly like Python ``str.strip``."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def is_finite(c: Column | str) -> Column:
    c = _col(c)
    return ~F.isnan(c) & (F.abs(c) != F.lit(_INF))


def parse_energy(c: Column | str) -> Column:
    """Energy text -> nullable double.

    Stripped; ``null``/``none``/empty in any case -> null; anything that is not a
    finite number (``abc``, ``NaN``, ``inf``) -> null as well, so one bad cell
    never aborts an ingest and non-finite values never poison a sum.
    """
    text = strip_text(c)
    value = text.try_cast("double")
    return (
        F.when(F.lower(text).isin(*MISSING_ENERGY_TEXTS), F.lit(None).cast("double"))
        .when(text.rlike(DECIMAL_NUMBER) & is_finite(value), value)
        .otherwise(F.lit(None).cast("double"))
    )


def parse_reading_time(c: Column | str) -> Column:
    """Reading-time text -> ``timestamp_ntz`` (wall clock), null when unparseable.

    A meter reports local wall-clock time without a zone, so the result is a
    zone-free timestamp: hour, date and weekday never depend on the session or
    host time zone.  ``try_cast`` is the ANSI-safe form (never raises).  Text
    that carries an explicit zone names an instant; it becomes that instant's
    UTC wall clock (epoch + its microseconds, so again session-independent).
    """
    text = _col(c)
    # cheap character tests first, so plain wall-clock text never runs the
    # pattern: a zone ends in a letter, or carries a sign inside the time part
    maybe_zoned = (
        ~F.substring(text, -1, 1).between("0", "9")
        | (F.instr(text, "+") > 0)
        | (F.locate("-", text, 12) > 0)
    )
    zoned = maybe_zoned & text.rlike(ZONED_TIME)
    instant_utc = F.timestamp_add(
        "MICROSECOND",
        F.unix_micros(text.try_cast("timestamp")),
        F.lit(_EPOCH_NTZ).cast("timestamp_ntz"),
    )
    return F.when(zoned, instant_utc).otherwise(text.try_cast("timestamp_ntz"))


def day_name(t: Column | str) -> Column:
    """Full English day name of a date/timestamp (same as ``date_format(t, 'EEEE')``
    under the default locale), via an integer lookup instead of per-row
    string formatting."""
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.element_at(names, F.dayofweek(_col(t)))


def sample_bucket(*cols: Column | str) -> Column:
    """Deterministic bucket 0..99 of ``xxhash64(concat_ws('||', cols...))``.

    Equals ``pmod(abs(h), 100)`` for every hash value ``h`` except the minimum
    long, where ``abs`` overflows (and raises under ANSI); ``abs(h % 100)`` has
    no overflow and gives the mathematically correct bucket there too.
    """
    h = F.xxhash64(F.concat_ws("||", *[_col(c) for c in cols]))
    return F.abs(h % F.lit(100))


def period_label(year: Column | str, month: Column | str) -> Column:
    """``YYYY-MM`` from integer year and month."""
    return F.concat(
        _col(year).cast("string"), F.lit("-"), F.lpad(_col(month).cast("string"), 2, "0")
    )


def hour_label(hour: Column | str) -> Column:
    """``HH:00`` from an hour of day (null for a null hour)."""
    h = _col(hour)
    return F.when(h.isNotNull(), F.format_string("%02d:00", h))


def format_measure(c: Column | str) -> Column:
    """Thousands separators and two decimals; ``0.00`` when not a number."""
    value = _col(c).try_cast("double")
    return F.coalesce(
        F.when(is_finite(value), F.format_number(value, 2)), F.lit("0.00")
    )
