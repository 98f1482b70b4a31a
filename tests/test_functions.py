import datetime
import math
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from riskloom.functions.dates import fiscal_year, to_date
from riskloom.functions.numeric import (
    flag, mean_of_present, risk_band, risk_bin, round_half_even, round_settled, to_double,
)
from riskloom.functions.significance import correlation_p
from riskloom.functions.text import alias_key, clean_key, compare_text, is_success, strip_text, year_in_text


def column(spark, items, kind, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", function(F.col("v"))).orderBy("i").collect()]


def test_fiscal_year_ends_in_june(spark):
    texts = ["2022-03-15", "2022-08-01", "2023-01-10", "2023-06-30", "2023-07-01", "2023-12-31", "not-a-date", None]
    assert column(spark, texts, "string", lambda c: fiscal_year(to_date(c))) == [
        2022, 2023, 2023, 2023, 2024, 2024, None, None,
    ]


def test_dates_in_several_formats(spark):
    texts = ["2023-07-01T00:00:00.000Z", "07/01/2023", "01-Jul-2023", "2023-07-01 23:30:00", " 2023-07-01 "]
    assert set(column(spark, texts, "string", to_date)) == {datetime.date(2023, 7, 1)}


def test_date_column_passes_through(spark):
    day = datetime.date(2020, 2, 29)
    assert column(spark, [day], "date", to_date) == [day]


def test_rounding_is_half_even_on_the_scaled_double(spark):
    assert column(spark, [0.25, 0.35, 0.45, -0.04, None], "double", lambda c: round_half_even(c, 1)) == [
        0.2, 0.4, 0.4, 0.0, None,
    ]
    assert math.copysign(1, column(spark, [-0.04], "double", lambda c: round_half_even(c, 1))[0]) == 1


def test_settled_rounding_ignores_addition_noise(spark):
    assert len(set(column(spark, [24.949999999999996, 24.95, 24.950000000000003], "double",
                          lambda c: round_settled(c, 1)))) == 1


def test_bad_numbers_become_null(spark):
    assert column(spark, ["1.5", "abc", "", None, "NaN", " 7 "], "string", to_double) == [
        1.5, None, None, None, None, 7.0,
    ]


def test_mean_of_present(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None), (4.0, 5.0, 6.0)], "a double, b double, c double")
    got = [r[0] for r in df.select(mean_of_present(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [2.0, None, 5.0]


def test_risk_bins_are_closed_above(spark):
    scores = [0.0, 33.0, 33.5, 66.1, 100.0, 100.1, None]
    assert column(spark, scores, "double", risk_bin) == [
        None, "Low (0–33)", "Medium (34–66)", "High (67–100)", "High (67–100)", None, None,
    ]


def test_risk_bands_are_closed_below(spark):
    assert column(spark, [33.9, 34.0, 66.9, 67.0], "double", risk_band) == ["low", "medium", "medium", "high"]


def test_flag_counts_unknown_as_false(spark):
    assert column(spark, [50.0, 10.0, None], "double", lambda c: flag(c >= 40)) == [1, 0, 0]


@pytest.mark.parametrize(
    "text, key",
    [
        ("INDIA", "india"),
        ("  Brazil  ", "brazil"),
        ("Côte d'Ivoire", "cote d'ivoire"),
        ("Côte d’Ivoire", "cote divoire"),
        ("São Tomé ", "sao tome"),
        ("ﬁji", "fiji"),
        ("½ Łódź", "12 odz"),
        ("\tTürkiye\n", "turkiye"),
        (None, None),
    ],
)
def test_clean_key(spark, text, key):
    assert column(spark, [text], "string", clean_key) == [key]


@given(st.lists(st.text(max_size=12), min_size=1, max_size=20))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_clean_key_equals_decomposition(spark, texts):
    texts = [t for t in texts if "\0" not in t and t.isprintable() and t.lower() == t.casefold()] or ["x"]
    expected = [
        unicodedata.normalize("NFKD", t.strip().lower()).encode("ascii", "ignore").decode("ascii") for t in texts
    ]
    assert column(spark, texts, "string", clean_key) == expected


def test_alias_key(spark):
    names = ["Egypt, Arab Republic of", "Côte d’Ivoire", "Viet Nam", "Türkiye", "Turkey", "Brazil"]
    assert column(spark, names, "string", alias_key) == [
        "egypt, arab rep.", "cote d'ivoire", "vietnam", "turkiye", "turkiye", "brazil",
    ]


def test_compare_text(spark):
    assert column(spark, ["micronesia, fed. sts.", "a_b-c"], "string", compare_text) == ["micronesia  fed  sts", "a_b c"]


def test_year_in_text(spark):
    assert column(spark, ["FY2022", "12345", "99", "06/30/2019", None], "string", year_in_text) == [
        2022, 1234, None, 2019, None,
    ]


def test_success_words(spark):
    outcomes = ["Satisfactory", "Unsatisfactory", "Moderately Satisfactory", " HIGHLY SATISFACTORY ", "not rated", None]
    assert column(spark, outcomes, "string", is_success) == [1, 0, 1, 1, 0, 0]


def test_strip_text(spark):
    assert column(spark, ["\t Brazil \n", " x\x1f"], "string", strip_text) == ["Brazil", "x"]


@pytest.mark.parametrize(
    "r, n, p",
    [
        # Student-t tables: t = 2.306 with 8, 2.042 with 30 and 1.96 with very many degrees of freedom
        (2.306004 / math.sqrt(2.306004**2 + 8), 10, 0.05),
        (2.042272 / math.sqrt(2.042272**2 + 30), 32, 0.05),
        (1.959964 / math.sqrt(1.959964**2 + 1e8), 1e8 + 2, 0.05),
        (0.0, 30, 1.0),
        (1.0, 30, 0.0),
        (-1.0, 30, 0.0),
    ],
)
def test_p_value(r, n, p):
    assert correlation_p(r, n) == pytest.approx(p, abs=1e-6)


def test_p_value_with_two_degrees_of_freedom_is_closed_form():
    for r in (0.1, -0.4, 0.77, 0.999):
        assert correlation_p(r, 4) == pytest.approx(1 - abs(r), rel=1e-12)


def test_p_value_needs_three_rows():
    assert correlation_p(0.5, 2) is None and correlation_p(None, 9) is None


def test_date_forms(spark):
    from pyspark.sql import functions as F

    from riskloom.functions.dates import to_date

    forms = ["3/5/2022", "5-Mar-2022", "5-Mar-22", "03/05/2022 12:00:00 AM", "Mar 5, 2022", "20220305", "2022/03/05", "5 March 2022"]
    got = [str(r[0]) for r in spark.createDataFrame([(f,) for f in forms], "v string").select(to_date(F.col("v"))).collect()]
    assert got == ["2022-03-05"] * 2 + ["2022-03-05"] * 6


def test_java_number_suffix_is_no_number(spark):
    from pyspark.sql import functions as F

    from riskloom.functions.numeric import to_double

    df = spark.createDataFrame([("10d",), ("1f",), ("1.5",), ("-2e3",), ("x",)], "v string")
    assert [r[0] for r in df.select(to_double(F.col("v"))).collect()] == [None, None, 1.5, -2000.0, None]


def test_the_column_tells_whether_the_day_comes_first(spark):
    from pyspark.sql import functions as F

    from riskloom.functions.dates import puts_day_first, to_date
    from riskloom.sources.feeds import normalise_loans

    def read(*texts):
        df = spark.createDataFrame([(t,) for t in texts], "v string")
        day_first = puts_day_first(df, F.col("v"))
        return [str(r[0]) for r in df.select(to_date(F.col("v"), day_first=day_first)).collect()]

    assert read("15/03/2022", "03/04/2022", None, "x") == ["2022-03-15", "2022-04-03", "None", "None"]
    assert read("03/15/2022", "03/04/2022 10:00:00") == ["2022-03-15", "2022-03-04"]
    assert read("03/04/2022") == ["2022-03-04"]
    # a column that holds both can only be read as month first, and what does not fit is no date
    assert read("15/03/2022", "03/15/2022") == ["None", "2022-03-15"]
    assert read("12345", "99999-01-01", "2022", "-0001-01-01") == ["None", "None", "2022-01-01", "None"]
    raw = spark.createDataFrame([("1", "Chad", "25/06/2022", "1"), ("2", "Chad", "01/07/2022", "2")],
                                "id string, country string, board_approval_date string, original_principal_amount string")
    assert {(r.loan_id, r.fiscal_year) for r in normalise_loans(raw, "IDA").collect()} == {("1", 2022), ("2", 2023)}
