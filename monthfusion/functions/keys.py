"""Key columns: county names and month dates."""

from __future__ import annotations

# Every character counted as white space.
WHITE_SPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        *(0x85, 0xA0, 0x1680),
        *range(0x2000, 0x200B),
        *(0x2028, 0x2029, 0x202F, 0x205F, 0x3000),
    )
)


def county_title(c: str) -> str:
    """Display form of a county name: outer spaces off, words capitalised."""
    return f"initcap(trim({c}))"


def strip(c: str) -> str:
    """Remove white space of any kind from both ends."""
    return f"btrim({c}, '{WHITE_SPACE}')"


def county_fold(c: str) -> str:
    """Case-blind form of a county name.

    Upper then lower case folds the letters that lower case alone keeps apart
    (sharp s, ligatures, long s).  Lower-casing sigma by hand in between avoids
    its word-final form, and keeps the optimizer from dropping the upper case.
    Capital sharp s stays itself in upper case and is spelled out at the end.
    """
    return f"replace(lower(translate(upper({strip(c)}), 'Σ', 'σ')), 'ß', 'ss')"


def county_key(c: str) -> str:
    """The same as :func:`county_fold`, with a short way for names of printable ASCII characters.

    The long way is in a function of an array, which has no generated code, so that it adds
    little to a stage's; Spark evaluates such a step by itself and in several methods.
    """
    long = f"transform(array({c}), c -> {county_fold('c')})[0]"
    return f"CASE WHEN {c} RLIKE '[^ -~]' THEN {long} ELSE lower(trim({c})) END"


def month_start(year: str, month: str) -> str:
    """First day of a month; NULL where year or month is no calendar value.

    ``make_date`` raises on month 13, which would hide the row from the quality
    rules, so impossible values are kept away from it.
    """
    return (
        f"CASE WHEN {month} BETWEEN 1 AND 12 AND {year} BETWEEN 1 AND 9999"
        f" THEN make_date({year}, {month}, 1) END"
    )
