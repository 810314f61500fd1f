"""Fraud questions over the transaction table.

All of them are hash aggregations with a partial step before the shuffle, so a key
that holds a large share of the rows costs one partial row per task.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions import cents, money_mean, money_sum, percent, round_half_up
from cardlens.functions.temporal import DAYS_PER_YEAR, as_of_date

TIME = "trans_date_trans_time"


def _fraud_count() -> Column:
    return F.sum("is_fraud").cast("bigint")


def _traffic(rate_digits: int = 2) -> list[Column]:
    """Counts, rate and mean amount that most of the reports share."""
    return [
        F.count(F.lit(1)).alias("total_txn"),
        _fraud_count().alias("fraud_txn"),
        percent(F.sum("is_fraud"), F.count(F.lit(1)), rate_digits).alias("fraud_rate_pct"),
        money_mean("amt").alias("avg_amount"),
    ]


def kpi_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        _fraud_count().alias("total_fraud"),
        percent(F.sum("is_fraud"), F.count(F.lit(1)), 3).alias("fraud_rate_pct"),
        money_mean("amt").alias("avg_amount"),
        round_half_up(F.max("amt"), 2).alias("max_amount"),
        F.min(TIME).alias("first_date"),
        F.max(TIME).alias("last_date"),
    )


def daily_trend(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col(TIME).try_cast("date").alias("txn_date")).agg(*_traffic()).orderBy("txn_date")


def fraud_rate_by(df: DataFrame, key: str, above: int | None = None, k: int | None = 20) -> DataFrame:
    """Fraud rate per ``key``, worst first; only groups with more than ``above`` rows."""
    groups = df.groupBy(key).agg(*_traffic())
    if above is not None:
        groups = groups.where(F.col("total_txn") > above)
    ranked = groups.orderBy(F.desc("fraud_rate_pct"), F.desc("fraud_txn"), F.asc(key))
    return ranked if k is None else ranked.limit(k)


def category_fraud(df: DataFrame, k: int = 20) -> DataFrame:
    return fraud_rate_by(df, "category", k=k)


def state_fraud(df: DataFrame, above: int = 1000, k: int = 20) -> DataFrame:
    return fraud_rate_by(df, "state", above=above, k=k)


def high_risk_customers(df: DataFrame, min_txn: int = 50, min_fraud: int = 3, k: int = 20) -> DataFrame:
    per_customer = df.groupBy(F.col("cc_num").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("total_txn"),
        _fraud_count().alias("fraud_txn"),
        percent(F.sum("is_fraud"), F.count("is_fraud"), 2).alias("fraud_rate_pct"),
        money_sum("amt").alias("total_spent"),
        F.min(TIME).alias("first_txn_ts"),
        F.max(TIME).alias("last_txn_ts"),
    )
    return (
        per_customer.where((F.col("total_txn") >= min_txn) & (F.col("fraud_txn") >= min_fraud))
        .orderBy(F.desc("fraud_rate_pct"), F.desc("fraud_txn"), F.desc("total_spent"), F.asc("customer_id"))
        .limit(k)
    )


def fraud_profile(df: DataFrame, as_of: datetime.date | str | None = None) -> DataFrame:
    """Mean amount, city size and age of fraudulent against normal rows."""
    days = F.datediff(as_of_date(as_of), F.col("dob").try_cast("date"))
    people = F.col("city_pop").cast("bigint")
    return df.groupBy("is_fraud").agg(
        money_mean("amt").alias("avg_amount"),
        round_half_up(F.try_divide(F.sum(people).cast("double"), F.count(people)), 2).alias("avg_city_pop"),
        round_half_up(F.try_divide(F.sum(days).cast("double"), F.count(days)) / F.lit(DAYS_PER_YEAR), 1).alias("avg_age"),
    )


# Labels of the long form.
PROFILE_LABELS = {
    "avg_amount": "Avg Transaction Amount ($)",
    "avg_city_pop": "Avg City Population",
    "avg_age": "Avg Customer Age",
}


def fraud_profile_long(profile: DataFrame) -> DataFrame:
    """One row per label and feature, with readable feature names."""
    labels = F.create_map(*[F.lit(x) for pair in PROFILE_LABELS.items() for x in pair])
    return profile.unpivot("is_fraud", list(PROFILE_LABELS), "feature", "average").withColumn(
        "feature", labels[F.col("feature")]
    )


def fraud_distribution(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("is_fraud")
        .agg(
            F.count(F.lit(1)).alias("count"),
            money_mean("amt").alias("avg_amount"),
            round_half_up(F.max("amt"), 2).alias("max_amount"),
        )
        .orderBy("is_fraud")
    )


def category_avg(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(money_mean("amt", digits=None).alias("avg_amt"))


def amount_quantiles(df: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75), accuracy: int = 10_000) -> DataFrame:
    """Approximate quantiles in one pass, rank error at most ``rows / accuracy``."""
    points = F.percentile_approx("amt", list(probs), accuracy)
    return df.agg(points.alias("q"), F.max("amt").alias("max_amt")).select(
        *[F.col("q")[i].alias(quantile_name(p)) for i, p in enumerate(probs)], "max_amt"
    )


def quantile_name(prob: float) -> str:
    return f"p{prob * 100:g}".replace(".", "_")


def _slice(amount: Column) -> Column:
    """A growing function of whole cents with at most some 230,000 values.

    Cents up to 4095 keep a slice each; beyond that a slice spans 1/2048 of its
    power of two, so it holds at most that many distinct amounts.
    """
    size = F.abs(amount)
    drop = F.greatest(F.lit(0), F.floor(F.log2(F.greatest(size, F.lit(1)))).cast("int") - 11)
    place = drop * 4096 + F.call_function("shiftright", size, drop)
    return F.when(amount < 0, -place - 1).otherwise(place)


def amount_quantiles_exact(df: DataFrame, probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles (smallest amount whose cumulative share reaches ``p``), to the cent.

    One scan counts rows per distinct amount; the rank of an amount is then a
    two-level prefix sum.  Slice totals are accumulated first, over a bounded number
    of rows, and amounts only inside the one slice that holds a wanted rank.
    """
    hist = df.select(cents("amt").alias("c")).where("c IS NOT NULL").groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    sliced = hist.withColumn("slice", _slice(F.col("c")))

    totals = sliced.groupBy("slice").agg(F.sum("n").alias("slice_n"), F.max("c").alias("top"))
    in_order = Window.orderBy("slice")
    everything = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = totals.select(
        "slice",
        (F.sum("slice_n").over(in_order) - F.col("slice_n")).alias("before"),
        F.sum("slice_n").over(in_order).alias("upto"),
        F.sum("slice_n").over(everything).alias("total"),
        F.max("top").over(everything).alias("max_c"),
    )
    wanted = F.explode(F.array(*[F.struct(F.lit(quantile_name(p)).alias("q"), F.lit(float(p)).alias("p")) for p in probs]))
    targets = (
        ranked.withColumn("want", wanted)
        .withColumn("rank", F.greatest(F.lit(1), F.ceil(F.col("want.p") * F.col("total"))))
        .where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("upto")))
        .select(F.col("slice").alias("target"), "before", F.col("want.q").alias("q"), "rank", "max_c")
    )
    # Null-safe equality: a plain one would push a null test below the count per amount
    # on this side only, and the count would run twice instead of being shared.
    inside = Window.partitionBy("q").orderBy("c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = (
        sliced.join(F.broadcast(targets), F.col("slice").eqNullSafe(F.col("target")))  # one row per quantile
        .withColumn("reached", F.col("before") + F.sum("n").over(inside))
        .where(F.col("reached") >= F.col("rank"))
    )
    picked = {
        quantile_name(p): F.min(F.when(F.col("q") == quantile_name(p), F.col("c"))) / F.lit(100.0) for p in probs
    }
    return hits.agg(*[value.alias(name) for name, value in picked.items()], (F.max("max_c") / F.lit(100.0)).alias("max_amt"))
