"""Column rules that turn free-text application fields into numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.events import normal_text

# Texts that stand for an unknown employment length, and the length used instead.
UNKNOWN_EMPLOYMENT = ("", "N/", "o", "0.5", "3 1/2")
DEFAULT_YEARS = "3"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_years_on_job(c: Column | str) -> Column:
    """The text before "Year(s)", trimmed; empty if that marker is missing."""
    c = _col(c)
    found = F.position(F.lit("year(s)"), F.lower(c))
    return F.trim(F.substring(c, F.lit(1), F.greatest(found - 1, F.lit(0))))


def employment_default(c: Column | str) -> Column:
    """Unknown employment lengths become three years; other texts stay."""
    c = _col(c)
    unknown = normal_text(c).isin(*[t.lower() for t in UNKNOWN_EMPLOYMENT])
    return F.when(c.isNull() | unknown, F.lit(DEFAULT_YEARS)).otherwise(c)


def clean_employment(c: Column | str) -> Column:
    """Years as double: text with N, / or o, or no text at all, is 0; null is 3; other rubbish is null."""
    c = _col(c).cast("string")
    not_a_number = c.rlike("[N/o]") | (c == "")
    return F.when(c.isNull(), F.lit(float(DEFAULT_YEARS))).when(not_a_number, F.lit(0.0)).otherwise(
        c.try_cast("double")
    )


def clean_salary(c: Column | str, quirk: bool = True) -> Column:
    """Salary as double. A leading $ goes; `1.234.56` reads 1234.56.

    The dot after the first digit goes if the third character from the end is a dot too. With `quirk` these may be
    one and the same dot, so `2.50` reads 250, as in the data the model was fitted on. Texts too short for the
    test are null. A column of numbers is left as it is.
    """
    given = _col(c)
    is_number = F.typeof(given).rlike("^(tinyint|smallint|int|bigint|float|double|decimal)")
    c = given.cast("string")
    bare = F.when(c.startswith("$"), F.substring(c, F.lit(2), F.length(c))).otherwise(c)
    n = F.length(bare)
    dotted = F.substring(bare, 2, 1) == "."
    both = dotted & (F.substring(bare, -3, 1) == ".")
    if not quirk:
        both = both & (n > 4)
    joined = F.concat(F.substring(bare, 1, 1), F.substring(bare, F.lit(3), n))
    too_short = (n < 2) | (dotted & (n < 3))
    text = F.when(too_short, F.lit(None)).when(both, joined).otherwise(bare)
    return F.when(is_number, given.try_cast("double")).otherwise(text.try_cast("double"))


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double; null where b is zero."""
    return F.try_divide(_col(a).cast("double"), _col(b).cast("double"))


def age(dob: Column | str, at: Column | str, fix_century: bool = False) -> Column:
    """Whole years of 365 days. `fix_century` takes 1000 off ages above 1000 (birth years typed as 0975)."""
    years = (F.datediff(_col(at), _col(dob)) / F.lit(365)).cast("int")
    return F.when(years > 1000, years - 1000).otherwise(years) if fix_century else years
