import datetime
import math

import pytest
from pyspark.sql import functions as F

from cardlens import functions as fn


def one(spark, column, **values):
    """``column`` over one row of ``values``."""
    return spark.createDataFrame([values or {"x": 0}]).select(column.alias("r")).head().r


def places():
    return [F.col(c) for c in "abcd"]


def test_haversine_of_equal_points_is_zero(spark):
    assert one(spark, fn.haversine_km(*places()), a=10.0, b=20.0, c=10.0, d=20.0) == 0.0


def test_haversine_of_antipodes_is_half_the_circumference(spark):
    assert one(spark, fn.haversine_km(*places()), a=0.0, b=0.0, c=0.0, d=180.0) == pytest.approx(20015.09, abs=0.01)
    assert one(spark, fn.haversine_km(*places()), a=37.3, b=12.7, c=-37.3, d=-167.3) == pytest.approx(20015.09, abs=0.01)


def test_missing_coordinate(spark):
    partly = [F.col("a"), F.lit(None).cast("double"), F.col("c"), F.col("d")]
    for distance in (fn.haversine_km, fn.euclid_deg):
        assert one(spark, distance(*partly), a=1.0, c=1.0, d=1.0) == 0.0
        assert one(spark, distance(*partly, null_as=None), a=1.0, c=1.0, d=1.0) is None


def test_euclid(spark):
    assert one(spark, fn.euclid_deg(*places()), a=0.0, b=0.0, c=3.0, d=4.0) == 5.0


def test_ages(spark):
    born = fn.parse_date(F.col("b"))
    assert one(spark, fn.age_years(born, "2020-01-01"), b="2000-12-31") == 20
    assert round(one(spark, fn.age_exact(born, "2020-01-01"), b="2000-12-31"), 1) == 19.0
    assert one(spark, fn.age_years(born), b="2000-12-31") == datetime.date.today().year - 2000


@pytest.mark.parametrize("text", ["not a time", "2020-13-01 00:00:00", "", "2020-01-01"])
def test_unreadable_time_is_null(spark, text):
    assert one(spark, fn.parse_time(F.col("t")), t=text) is None


def test_time_parts(spark):
    time = fn.parse_time(F.col("t"))
    assert one(spark, fn.trans_hour(time), t="2020-06-21 23:59:59") == 23.0
    assert one(spark, fn.trans_day(time), t="2020-06-21 23:59:59") == "2020-06-21"
    assert one(spark, fn.clock_time(F.col("t")), t="2020-06-21 23:59:59") == "23:59:59"
    assert one(spark, fn.clock_time(F.col("t")), t="2020-06-21") == "Now"
    assert one(spark, fn.clock_time(F.lit(None).cast("string"))) == "Now"


@pytest.mark.parametrize("card, shown", [("4263982640269299", "9299"), ("12", "12"), ("", "****"), (None, "****")])
def test_mask(spark, card, shown):
    assert one(spark, fn.mask_card(F.lit(card))) == shown
    assert one(spark, fn.mask_card(F.lit(4263982640269299))) == "9299"


@pytest.mark.parametrize(
    "category, label",
    [("shopping_net", "Shopping Net"), (None, "Unknown"), ("", "Unknown"), ("personal_care_and_more", "Personal Care A")],
)
def test_category_label(spark, category, label):
    assert one(spark, fn.category_label(F.lit(category).cast("string"))) == label


@pytest.mark.parametrize("flag, status", [(1, "FRAUD"), (0, "Safe"), (None, "Safe")])
def test_status(spark, flag, status):
    assert one(spark, fn.status_label(F.lit(flag).cast("int"))) == status


def test_percent_of_nothing_is_null(spark):
    assert one(spark, fn.percent(F.lit(0), F.lit(0), 2)) is None
    assert one(spark, fn.percent(F.lit(1), F.lit(3), 2)) == 33.33


def test_money_ignores_nan_and_null(spark):
    rows = spark.createDataFrame([(0.1,), (0.2,), (math.nan,), (None,)], "amt double")
    assert tuple(rows.agg(fn.money_sum("amt"), fn.money_mean("amt")).head()) == (0.3, 0.15)
    empty = rows.where("amt < 0")
    assert tuple(empty.agg(fn.money_sum("amt"), fn.money_mean("amt")).head()) == (None, None)


def test_money_sum_is_exact_in_any_order(spark):
    rows = spark.range(100_000).select((F.col("id") % 1000 / 100.0).alias("amt"))
    expected = sum(i % 1000 for i in range(100_000)) / 100
    for parts in (1, 7, 32):
        assert rows.repartition(parts).agg(fn.money_sum("amt")).head()[0] == expected


def test_numbers_beyond_rounding(spark):
    from cardlens.functions.geo import euclid_deg, haversine_km
    from cardlens.functions.numeric import money_sum, round_half_up

    df = spark.sql("SELECT 1e18 AS big, double('NaN') AS nan, -2.345 AS small")
    row = df.select(round_half_up(F.col("big"), 2), round_half_up(F.col("nan"), 2), round_half_up(F.col("small"), 1)).head()
    assert tuple(row) == (1e18, None, -2.3)
    assert df.select(haversine_km(F.col("nan"), F.lit(0.0), F.lit(0.0), F.lit(1.0)), euclid_deg(F.col("nan"), F.lit(0.0), F.lit(0.0), F.lit(1.0))).head() == (0.0, 0.0)
    with pytest.raises(Exception, match="too large"):
        spark.sql("SELECT 1e20 AS amt").select(money_sum("amt")).collect()
