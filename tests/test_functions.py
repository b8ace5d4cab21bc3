"""Column functions on hand-computed rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marlstone.functions import dates, numbers, text


def column(spark, expr):
    """Value of one expression that needs no input."""
    return spark.range(1).select(expr.alias("x")).first()["x"]


def stamp(value):
    return F.lit(value).cast("timestamp")


@pytest.mark.parametrize(
    "later,earlier,want",
    [
        ("2024-01-02 12:00:00", "2024-01-01 00:00:00", 1.5),
        ("2024-01-01 00:07:12", "2024-01-01 00:00:00", 0.01),  # 0.005 goes up
        ("2024-01-01 00:00:00", "2024-01-01 03:00:00", -0.13),  # and away from zero
        (None, "2024-01-01 00:00:00", -1.0),
    ],
)
def test_days_between(spark, later, earlier, want):
    assert column(spark, dates.days_between(stamp(later), stamp(earlier), -1)) == want


def test_whole_days_cut_toward_zero(spark):
    back = dates.whole_days(stamp("2024-01-01 00:00:00"), stamp("2024-01-02 16:48:00"))
    assert column(spark, back) == -1


@pytest.mark.parametrize(
    "born,want",
    [("2000-02-29", 17), ("2000-02-28", 18), ("2000-03-01", 17), ("1999-12-31", 18)],
)
def test_age_before_on_and_after_the_birthday(spark, born, want):
    age = dates.age_years(F.lit(dt.date.fromisoformat(born)), F.lit(dt.date(2018, 2, 28)))
    assert column(spark, age) == want


def test_parsing_never_fails(spark):
    assert column(spark, dates.parse_dmy(F.lit("31/12/2017"))) == dt.date(2017, 12, 31)
    assert column(spark, dates.parse_dmy(F.lit("2017-12-31"))) is None
    assert column(spark, numbers.parse_decimal_comma(F.lit("12,50"))) == 12.5
    assert column(spark, numbers.parse_decimal_comma(F.lit("abc"))) is None
    assert column(spark, numbers.parse_decimal_comma(F.lit(""))) is None


def test_cut_is_right_closed(spark):
    ages = [18, 19, 30, 31, 100, 101, None]
    df = spark.createDataFrame([(a,) for a in ages], "a int")
    groups = numbers.cut(F.col("a"), [18, 30, 40, 50, 60, 100], ["18-29", "30-39", "40-49", "50-59", "60+"])
    got = [r["g"] for r in df.select(groups.alias("g")).collect()]
    assert got == [None, "18-29", "18-29", "30-39", "60+", None, None]


def test_bucketize_is_left_closed(spark):
    df = spark.createDataFrame([(x,) for x in (-5.0, 3.0, 50.0, 49.9, 100.0, 500.0, None)], "x double")
    splits = [3.0, 50.0, 100.0]

    def run(mode):
        return [r["b"] for r in df.select(numbers.bucketize(F.col("x"), splits, mode).alias("b")).collect()]

    assert run("extend") == [0.0, 0.0, 1.0, 0.0, 1.0, 1.0, None]
    assert run("null") == [None, 0.0, 1.0, 0.0, 1.0, None, None]
    with pytest.raises(Exception, match="outside bucket splits"):
        run("error")


@pytest.mark.parametrize("compound,want", [(0.05, "positive"), (0.0499, "neutral"), (-0.05, "negative")])
def test_polarity_bounds(spark, compound, want):
    assert column(spark, numbers.polarity(F.lit(compound))) == want


def test_unmapped_codes_are_null(spark):
    assert column(spark, numbers.map_values(F.lit(7), {0: "a"})) is None
    assert column(spark, numbers.map_classes(F.lit(7), {0: [1, 2]})) is None


def test_softmax_of_large_scores(spark):
    p = column(spark, numbers.softmax(F.array(F.lit(1000.0), F.lit(1000.0))))
    assert p == [0.5, 0.5]
    assert column(spark, numbers.argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0)))) == 1


def test_exact_stddev_of_sums(spark):
    df = spark.createDataFrame([(100000000.01,), (100000000.03,)], "x double")
    x = F.col("x")
    spread = numbers.stddev_from_sums(F.count(x), F.sum(numbers.exact(x)), F.sum(numbers.exact_square(x)))
    assert df.agg(spread).first()[0] == pytest.approx(0.0141421356, rel=1e-6)
    assert df.limit(1).agg(spread).first()[0] is None


def test_sums_keep_all_decimals(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("x"))
    sums = df.agg(numbers.exact_sum(F.col("x")), numbers.rounded_sum(F.col("x")), numbers.exact_mean(F.col("x")))
    assert tuple(sums.first()) == (4.0, 4.0, 0.004)


def test_cleaning_removes_every_match(spark):
    raw = "  It's 100% \"re-newable\"! WIND " + "x1" * 300
    assert column(spark, text.clean_text(F.lit(raw))) == "its  renewable wind " + "x" * 300
    assert column(spark, text.normalize(F.lit("The WIND, the wind; don't"))) == "wind wind dont"
    assert column(spark, text.normalize(F.lit("12 34"))) == ""


def test_aspect_modes(spark):
    sample = F.lit("every soil needs carbon tax")
    assert column(spark, text.tag_aspects(sample)) == ["emissions", "fossil_fuels", "policy", "transportation"]
    assert column(spark, text.tag_aspects(sample, mode="word")) == ["emissions", "policy"]
    # Keywords with digits or hyphens cannot occur in cleaned text.
    assert column(spark, text.tag_aspects(text.clean_text(F.lit("co2")))) == []


def test_extract_field(spark):
    assert column(spark, text.extract_field(F.lit('{"description": "a"}'), "description")) == "a"
    assert column(spark, text.extract_field(F.lit('{"title": "a"}'), "description")) == ""
    assert column(spark, text.extract_field(F.lit("plain"), "description")) == "plain"


def test_extract_field_keeps_texts_that_begin_with_a_brace(spark):
    def extracted(value):
        return column(spark, text.extract_field(F.lit(value), "description"))

    for plain in ("{breaking} news today", "{", '{"description": "a"} trailing', '{"description": }', '{"description": "a"}, {}', '{"description": "a"}] [', " {x}", "[1]", '"a"'):
        assert extracted(plain) == plain
    assert extracted(' \n{"description": "a", "other": {"b": 1}}') == "a"
    assert extracted('{"description": null}') == "" and extracted("{}") == ""
    assert extracted('{"description": 12}') == "12"
    assert column(spark, text.extract_field(F.lit(None).cast("string"), "description")) is None
    assert column(spark, text.extract_field(F.lit('{"a b": "x"}'), "a b")) == "x"
