import pytest
from pyspark.sql import functions as F

from cardlens.operators import analytics, evaluation, features, keyed, quality, sampling, scoring, serving
from cardlens.plans.analysis import analysis
from checks.tables import transactions
from tests.conftest import SMALL


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_conform_adds_defaults_and_casts(spark):
    narrow = spark.createDataFrame([("t1", "12.5", "x")], "trans_num string, amt string, is_fraud string")
    row = features.conform(narrow).head()
    assert (row.amt, row.is_fraud, row.lat, row.city_pop, row.city) == (12.5, None, 0.0, 0, None)
    assert "lat" in features.defaulted_columns(narrow) and "amt" not in features.defaulted_columns(narrow)


def test_times_are_conformed_to_the_record_format(spark):
    df = spark.sql("SELECT TIMESTAMP'2020-01-02 03:04:05.678' AS trans_date_trans_time, DATE'1990-05-06' AS dob")
    row = features.conform(df).head()
    assert (row.trans_date_trans_time, row.dob) == ("2020-01-02 03:04:05", "1990-05-06")


def test_reports_on_text_columns_with_bad_values(spark):
    df = spark.createDataFrame(
        [("2020-01-01 10:00:00", "1990-01-01", 1.0, 10, 0), ("bad", "bad", 2.0, 20, 0)],
        "trans_date_trans_time string, dob string, amt double, city_pop int, is_fraud int",
    )
    assert {str(r.txn_date): r.total_txn for r in analytics.daily_trend(df).collect()} == {"2020-01-01": 1, "None": 1}
    assert analytics.fraud_profile(df, "2020-06-21").head().avg_age == 30.5


def test_index_columns_are_dropped(spark):
    df = spark.createDataFrame([(0, 1, "a")], "`_c0` int, `Unnamed: 0` int, x string")
    assert features.drop_index_columns(df).columns == ["x"]
    assert features.drop_index_columns(df.select("x")).columns == ["x"]


def test_missing_label_belongs_to_neither_side(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "is_fraud int")
    assert features.fraud_rows(df).count() == features.non_fraud_rows(df).count() == 1


def test_model_features_never_null(spark):
    df = spark.createDataFrame(
        [("bad", None, float("nan"), None, None, None, None, None, None)],
        "trans_date_trans_time string, dob string, amt double, lat double, long double, merch_lat double,"
        " merch_long double, city_pop int, is_fraud int",
    )
    made = features.model_features(df, "2020-01-01").head()
    assert [made[c] for c in features.MODEL_NUMERICS] == [0.0, 0.0, 30.0, 0.0, 0.0, 0.0, 0.0]
    assert made.label is None


def test_model_features_of_a_narrow_table(spark):
    made = features.model_features(spark.createDataFrame([(5.0,)], "amt double")).head()
    assert (made.amt, made.age, made.trans_hour, made.distance, made.label) == (5.0, 30.0, 0.0, 0.0, 0.0)


def test_mode_ties_and_empty_columns(spark):
    df = spark.createDataFrame([("a", None), ("b", None), (None, None)], "x string, y string")
    assert rows(quality.column_modes(df, ("x", "y"))) == [("x", "a", 1)]
    assert sorted(rows(quality.impute_modes(df, ("x", "y")))) == [("a", None), ("a", None), ("b", None)]


def test_mode_is_left_out_when_null_is_most_frequent(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "x string")
    assert rows(quality.column_modes(df, ("x",))) == []


def test_value_counts_are_ranked(spark):
    df = spark.createDataFrame([(v,) for v in "aabbbcd"], "x string")
    assert rows(quality.value_counts(df, ("x",), 3)) == [("x", "b", 3, 1), ("x", "a", 2, 2), ("x", "c", 1, 3)]


def test_reports_on_an_empty_table(spark):
    empty = transactions(spark, SMALL).where("amt < 0")
    assert analytics.kpi_overview(empty).head()[:3] == (0, None, None)
    assert analytics.daily_trend(empty).count() == analytics.category_fraud(empty).count() == 0
    assert analytics.amount_quantiles(empty).head().p50 is None
    assert analytics.amount_quantiles_exact(empty).head().p50 is None
    assert serving.detection_series(features.with_trans_time(empty)).count() == 0


def test_analysis_names_all_reports(spark):
    reports = analysis(transactions(spark, SMALL))
    assert len(reports) == 10 and all(df.count() >= 0 for df in reports.values())
    assert reports["profile_long"].count() == 6


@pytest.mark.parametrize(
    "amounts, expected",
    [
        ([1.0], (1.0, 1.0, 1.0, 1.0)),
        ([1.0, 2.0, 3.0, 4.0], (1.0, 2.0, 3.0, 4.0)),
        ([-5.0, -1.0, 0.0, 2.5, 1e9], (-1.0, 0.0, 2.5, 1e9)),
        ([7.77] * 50 + [0.01], (7.77, 7.77, 7.77, 7.77)),
        ([-300.0, -200.0, -100.0, -50.0], (-300.0, -200.0, -100.0, -50.0)),
    ],
)
def test_exact_quantiles(spark, amounts, expected):
    df = spark.createDataFrame([(a,) for a in amounts], "amt double")
    assert tuple(analytics.amount_quantiles_exact(df).head()) == expected


def test_slices_grow_with_the_amount(spark):
    numbers = [s * (2**k + d) for k in range(50) for d in (-1, 0, 1) for s in (-1, 1)]
    df = spark.createDataFrame([(n,) for n in sorted(set(numbers))], "c bigint").select("c", analytics._slice(F.col("c")).alias("s"))
    slices = [r.s for r in df.orderBy("c").collect()]
    assert slices == sorted(slices)


def test_approximate_quantiles_are_close(spark):
    df = transactions(spark, SMALL, "amt")
    exact, near = analytics.amount_quantiles_exact(df).head(), analytics.amount_quantiles(df).head()
    assert near.p50 == pytest.approx(exact.p50, rel=0.01) and near.max_amt == exact.max_amt


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "k string, t int, v string")
    assert sorted(rows(keyed.latest_per_key(df, ("k",), [F.desc("t")]))) == [("a", 2, "y"), ("b", 1, "z")]


def test_union_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([("y", 2)], "s string, i int")
    assert rows(keyed.union_all(a, b)) == [(1, "x"), (2, "y")]


def test_customer_dim_keeps_differing_details(spark):
    everything = transactions(spark, SMALL)
    assert keyed.customer_dim(everything).select("cc_num").distinct().count() == 150
    assert keyed.customer_dim(everything).count() > 150


def labelled(spark, fraud, normal):
    return spark.range(fraud + normal).select(
        F.concat(F.lit("t"), "id").alias("trans_num"), F.when(F.col("id") < fraud, 1.0).otherwise(0.0).alias("label")
    )


def test_balance_keeps_all_fraud_at_three_to_one(spark):
    kept = sampling.balance(labelled(spark, 500, 20_000)).groupBy("label").count().collect()
    counts = {r.label: r["count"] for r in kept}
    assert counts[1.0] == 500 and counts[0.0] == pytest.approx(1500, rel=0.15)


def test_balance_keeps_everything_when_fraud_is_common(spark):
    assert sampling.balance(labelled(spark, 100, 200)).count() == 300


def test_balance_without_normal_rows_is_an_error(spark):
    with pytest.raises(Exception, match="no non-fraud rows"):
        sampling.balance(labelled(spark, 10, 0)).collect()


def test_samples_do_not_depend_on_partitioning(spark):
    df = labelled(spark, 100, 5000)
    picked = {parts: {r.trans_num for r in sampling.balance(df.repartition(parts)).collect()} for parts in (1, 8)}
    assert picked[1] == picked[8]


def test_split_is_a_partition(spark):
    df = labelled(spark, 1000, 4000)
    train, test = sampling.split(df)
    assert train.count() + test.count() == 5000 and train.intersect(test).isEmpty()
    assert train.count() == pytest.approx(4000, rel=0.05)


def test_metrics_match_spark_ml(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = spark.createDataFrame([(1.0, 1.0)] * 7 + [(1.0, 0.0)] * 3 + [(0.0, 1.0)] * 2 + [(0.0, 0.0)] * 28, "label double, prediction double")
    ours = evaluation.class_metrics(evaluation.confusion(df)).head()
    names = {"accuracy": "accuracy", "weightedPrecision": "weighted_precision", "weightedRecall": "weighted_recall", "f1": "f1"}
    for theirs, mine in names.items():
        assert ours[mine] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df), abs=1e-12)


def test_metrics_when_a_class_is_never_predicted(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    ours = evaluation.class_metrics(evaluation.confusion(df)).head()
    assert ours.accuracy == 0.5 and ours.weighted_precision == 0.25


def test_score_is_zero_without_probability(spark):
    df = spark.createDataFrame([(1.0,)], "prediction double")
    assert df.select(scoring.positive_probability(df)).head()[0] == 0.0


def test_series_has_quiet_intervals(spark):
    df = spark.sql("SELECT explode(array(TIMESTAMP'2024-01-01 00:01:00', TIMESTAMP'2024-01-01 00:21:00')) AS trans_time")
    counts = [r.new_alerts for r in serving.detection_series(df, points=6).orderBy("window_start").collect()]
    assert counts == [0, 1, 0, 0, 0, 1]


def test_points_keep_zero_coordinates(spark):
    df = spark.sql(
        "SELECT 't' AS trans_num, TIMESTAMP'2024-01-01 00:00:00' AS trans_time, 0.0D AS merch_lat,"
        " 0.0D AS merch_long, 'm' AS merchant, 1.0D AS amt"
    )
    assert serving.fraud_points(df).count() == 1


def test_live_stats_of_empty_tables(spark):
    none = spark.createDataFrame([], "x int")
    assert tuple(serving.live_stats(none, none, none, none).head()) == (0, 0, 0, 0.0)


def test_notified_texts_have_defaults(spark):
    df = spark.sql("SELECT CAST(NULL AS STRING) trans_num, CAST(NULL AS STRING) cc_num, CAST(NULL AS TIMESTAMP) trans_time,"
                   " CAST(NULL AS STRING) merchant, CAST(NULL AS DOUBLE) amt, CAST(NULL AS STRING) category")
    assert tuple(serving.feed_rows(df).head()) == ("", "****", "", "Now", "", "", 0.0, "0.00", "")
