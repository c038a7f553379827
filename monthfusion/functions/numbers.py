"""Strict reading of numbers from text.

Spark's cast takes some spellings that data files must not use (``1d``, hex) and
refuses one they may (``1_000``).  The pattern decides what is a number; the
cast only converts.
"""

from __future__ import annotations

from monthfusion.functions.keys import strip

# Accepted spellings of numbers, and of values that are none.
DECIMAL = (
    "^[+-]?([0-9]+(_[0-9]+)*[.]?([0-9]+(_[0-9]+)*)?|[.][0-9]+(_[0-9]+)*)"
    "([eE][+-]?[0-9]+(_[0-9]+)*)?$"
)
NOT_FINITE = "^[+-]?([iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$"


# Text without any of these characters is read alike by Spark and the patterns above.
_UNUSUAL = "[^-+0-9.eE]"


def is_blank(text: str) -> str:
    """True for missing, empty and white-space-only text."""
    return f"coalesce({strip(text)} = '', true)"


def spelled(text: str) -> str:
    """Text as double: NULL when it is no number, NaN when it says so, else finite or not.

    Nearly all values are plain: one look at their characters and the cast.  There is one
    cast for all spellings, as code for many columns is too long to be compiled otherwise.
    """
    t = strip(text)
    return (
        f"try_cast(CASE WHEN NOT {text} RLIKE '{_UNUSUAL}' THEN {text}"
        f" WHEN {t} RLIKE '{DECIMAL}' THEN replace({t}, '_', '')"
        f" WHEN {t} RLIKE '{NOT_FINITE}' THEN 'NaN' END AS DOUBLE)"
    )


def finite(value: str) -> str:
    """NaN in place of a double that is not finite."""
    return f"CASE WHEN abs({value}) = double('Infinity') THEN double('NaN') ELSE {value} END"


def number(text: str) -> str:
    """Text as double: NULL when it is no number, NaN when it is not finite."""
    return finite(spelled(text))


def whole(value: str) -> str:
    """Double cut to its whole part; NULL when it does not fit an int."""
    return f"CASE WHEN NOT isnan({value}) THEN try_cast({value} AS INT) END"


def cast_text(text: str, type_: str) -> str:
    """Text as a typed value, NULL where it does not fit.

    Whole numbers may carry a fraction of zero, as columns with gaps do when
    they are exported as floating point.
    """
    if type_ == "string":
        return text
    value = f"try_cast({text} AS {type_})"
    if type_ in ("int", "bigint"):
        # Not through double, which has no place for all digits of a bigint.
        real = f"try_cast({text} AS DECIMAL(38, 18))"
        value = (
            f"coalesce({value}, CASE WHEN {real} = floor({real})"
            f" THEN try_cast({real} AS {type_}) END)"
        )
    return value
