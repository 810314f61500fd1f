"""All analytics reports over one transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cardlens.operators import analytics, quality

DATA_END = "2020-06-21"  # fixed value: reference date for ages in the profile


def analysis(df: DataFrame, as_of: str = DATA_END) -> dict[str, DataFrame]:
    """Name to lazy report; each reads only the columns it needs."""
    profile = analytics.fraud_profile(df, as_of)
    return {
        "overview": analytics.kpi_overview(df),
        "daily": analytics.daily_trend(df),
        "missing": quality.missing_values(df),
        "quantiles": analytics.amount_quantiles(df),
        "high_risk": analytics.high_risk_customers(df),
        "profile": profile,
        "profile_long": analytics.fraud_profile_long(profile),
        "by_category": analytics.category_fraud(df),
        "by_state": analytics.state_fraud(df),
        "by_label": analytics.fraud_distribution(df),
    }
