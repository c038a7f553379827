"""Key, unit and number expressions."""

import datetime
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from monthfusion.functions.keys import WHITE_SPACE, county_fold, county_key, county_title, month_start, strip
from monthfusion.functions.numbers import cast_text, is_blank, number, whole


def evaluate(spark, texts, expression):
    """Values of an expression over a text column ``c``."""
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    return [r[0] for r in rows.orderBy("i").selectExpr(expression).collect()]


def test_county_title(spark):
    texts = [" adams ", "ST. CLAIR", "jo-daviess", "de  kalb", "o'brien", "\tx", "  ", None]
    want = ["Adams", "St. Clair", "Jo-daviess", "De  Kalb", "O'brien", "\tx", "", None]
    assert evaluate(spark, texts, county_title("c")) == want


def test_county_fold_equals_casefold(spark):
    texts = [" Adams\t", "STRASSE", "straße", "STRAẞE", "ΣΊΣΥΦΟΣ", "ﬁeld", "É", " x ", "\x1cy\x1f", ""]
    assert evaluate(spark, texts, county_fold("c")) == [t.strip().casefold() for t in texts]


def test_county_key_equals_fold(spark):
    """Each character below U+3100 alone, within and around a name, and no name at all."""
    chars = [chr(c) for c in range(0x3100)]
    texts = [None, "", " ", " DE KALB ", *chars, *(f"{c}St. Clair{c}" for c in chars), *(f" A{c}Z " for c in chars)]
    assert evaluate(spark, texts, county_key("c")) == evaluate(spark, texts, county_fold("c"))


def test_white_space_is_pythons():
    assert set(WHITE_SPACE) == {chr(c) for c in range(0x10000) if chr(c).isspace()}


def test_strip_and_blank(spark):
    texts = ["", " \t　", None, " a b "]
    assert evaluate(spark, texts, is_blank("c")) == [True, True, True, False]
    assert evaluate(spark, texts, strip("c")) == ["", "", None, "a b"]


def test_month_start(spark):
    rows = spark.createDataFrame([(2002, 8), (2002, 13), (2002, 0), (None, 1), (0, 1)], "y int, m int")
    got = [r[0] for r in rows.selectExpr(month_start("y", "m")).collect()]
    assert got == [datetime.date(2002, 8, 1), None, None, None, None]


def python_number(text):
    try:
        value = float(text)
    except ValueError:
        return None
    return value if math.isfinite(value) else math.nan


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


SPELLINGS = (
    "1 -1 +1 1. .5 -.5 . 1e5 1E+5 1e 1e999 -1e999 1_000 1__0 _1 1_ 1._5 1_0.5_0 1e1_0 nan NaN +nan inf "
    "-Infinity infinit 1d 1f 0x1p3 0x10 12abc 1,5 --1 +-1 00012 e5 1.5.2 1e-400"
).split() + ["", "  ", " 12 ", "\t-3.5\n", "1 2", " 7 "]


def test_number_reads_what_python_reads(spark):
    got = evaluate(spark, SPELLINGS, number("c"))
    want = [python_number(t) for t in SPELLINGS]
    assert [t for t, g, w in zip(SPELLINGS, got, want) if not same(g, w)] == []


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("0123456789+-.eE_ dfxnaiINFty", max_size=8), min_size=40, max_size=40))
def test_number_reads_what_python_reads_at_random(spark, texts):
    got = evaluate(spark, texts, number("c"))
    assert [t for t, g in zip(texts, got) if not same(g, python_number(t))] == []


def test_whole_cuts_towards_zero(spark):
    got = evaluate(spark, ["2002.7", "-0.5", "-3.9", "1e12", "nan"], whole(number("c")))
    assert got == [2002, 0, -3, None, None]


def test_cast_text(spark):
    texts = ["2", "2.0", "2.5", "x", "3e9", None]
    assert evaluate(spark, texts, cast_text("c", "int")) == [2, 2, None, None, None, None]
    assert evaluate(spark, texts, cast_text("c", "bigint")) == [2, 2, None, None, 3000000000, None]
    assert evaluate(spark, texts, cast_text("c", "string")) == texts
