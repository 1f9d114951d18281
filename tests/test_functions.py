import datetime as dt
import math
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vintara.config import INCIDENTS
from vintara.functions import keys, text, typing


def one(spark, values, make, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_date_is_strict_but_takes_a_time_of_day(spark):
    given_ = ["2022-01-13", "2022-01-13 00:00:00", "NULL", "44874", "2022-02-30", "2022-1-3", "2022", "2022-01-13x", None]
    day = dt.date(2022, 1, 13)
    assert one(spark, given_, typing.to_date) == [day, day] + [None] * 7


def test_int_keeps_only_whole_numbers_in_range(spark):
    given_ = ["325", " 325 ", "325.0", "KM 102", "(Vazio)", "99999999999", "-4", None]
    assert one(spark, given_, typing.to_int) == [325, 325, None, None, None, None, -4, None]


def test_coordinate_drops_zero_sentinels_and_non_finite(spark):
    given_ = ["-23.54", "0", "0.0", "-0", "-", " NULL ", "", "-23,5", "NaN", "Infinity", "-Infinity", "1e999", None]

    def clean(c):
        return typing.finite_nonzero(typing.to_double(c, INCIDENTS.coordinate_sentinels))

    assert one(spark, given_, clean) == [-23.54] + [None] * 12


def test_finite_nonzero_keeps_every_other_double(spark):
    extremes = [5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 1.0]
    assert one(spark, extremes + [math.nan, math.inf, 0.0], typing.finite_nonzero, "double") == extremes + [None] * 3


def test_sentinels_compare_trimmed_and_keep_other_values_untouched(spark):
    given_ = ["NULL", " NULL ", "(Vazio)", "", "  ", "SOME ", "-", "null", None]
    expected = [None, None, None, None, None, "SOME ", "-", "null", None]
    assert one(spark, given_, lambda c: text.null_if_listed(c, INCIDENTS.text_sentinels)) == expected


def test_normalise(spark):
    decomposed = "SA" + "̃" + "O"
    given_ = ["São José ", decomposed, "NÃO INFORMADO", "piñata", "çã Õ", None]
    assert one(spark, given_, text.normalise) == ["SAO JOSE", decomposed, "NAO INFORMADO", "PIÑATA", "CA O", None]


def test_fold_reaches_further_than_normalise(spark):
    given_ = ["SA" + "̃" + "O", "piñata", "\tÅngström ", None]
    assert one(spark, given_, text.fold) == ["SAO", "PINATA", "ANGSTROM", None]


def test_labels(spark):
    given_ = ["PELA MANHÃ", "a noite", " de madrugada ", "X", None]
    expected = ["Pela manhã", "A noite", "De madrugada", "X", None]
    assert one(spark, given_, lambda c: text.canonical_label(c, INCIDENTS.labels)) == expected


def test_month_and_day_keys(spark):
    days = [dt.date(2022, 4, 5), None]
    assert one(spark, days, typing.month_key, "date") == ["202204", "000000"]
    assert one(spark, days, typing.day_key, "date") == [20220405, None]


def test_surrogate_key_depends_on_the_parts_not_on_their_concatenation(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("ab", "c")], "a string, b string")
    first, second, third = (r[0] for r in df.select(keys.surrogate_key("a", "b")).collect())
    assert first == third != second
    assert all(0 <= k < 2**60 for k in (first, second))


@settings(max_examples=25, deadline=None, derandomize=True)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F)), min_size=1, max_size=20))
def test_fold_agrees_with_the_unicode_definition(spark, values):
    # Letters that expand to several, and case rules outside one-to-one, are out of scope.
    def plain(value):
        bare = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
        return bare.strip().upper()

    simple = [v for v in values if all(len(plain(c)) <= 1 and len(c.upper()) == 1 for c in v) and "\x00" not in v]
    simple = [v for v in simple if all(not (c.isspace() and c != " ") for c in v) and " " not in v.strip()]
    spacing = {c for v in simple for c in v if unicodedata.normalize("NFKD", c).startswith(" ")}
    simple = [v for v in simple if not spacing & set(v)]
    if simple:
        assert one(spark, simple, text.fold) == [plain(v) for v in simple]


def test_strip_removes_what_python_strips(spark):
    given_ = ["  a b\t", " x　", "plain"]
    assert one(spark, given_, text.strip) == [v.strip() for v in given_]


@pytest.mark.parametrize("kind", ["text", "hour", "label", "int", "date", "coordinate"])
def test_every_kind_of_field_survives_null(spark, kind):
    from vintara.config import Field
    from vintara.operators.conform import clean_column

    df = spark.createDataFrame([(None,)], "v string")
    assert df.select(clean_column(Field("v", ("V",), kind), INCIDENTS)).first()[0] is None
