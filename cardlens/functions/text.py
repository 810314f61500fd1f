"""Display forms used by the serving queries.

``nullif`` is avoided: it adds a projection between LIMIT and ORDER BY, and Spark
then sorts the whole table where it would have taken the top k of each task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts and lengths of the display forms.
UNKNOWN = "Unknown"
MASKED = "****"
LABEL_LENGTH = 15
FRAUD_STATUS, SAFE_STATUS = "FRAUD", "Safe"


def mask_card(card: Column) -> Column:
    """Last four digits; ``****`` for a missing or empty number."""
    text = card.cast("string")
    return F.when(text != "", F.substring(text, -4, 4)).otherwise(F.lit(MASKED))


def category_label(category: Column) -> Column:
    """``shopping_net`` to ``Shopping Net``, first 15 characters."""
    known = F.when(category != "", category).otherwise(F.lit(UNKNOWN))
    return F.substring(F.initcap(F.replace(known, F.lit("_"), F.lit(" "))), 1, LABEL_LENGTH)


def or_default(value: Column, default: str | float) -> Column:
    return F.coalesce(value, F.lit(default))


def truncate(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def status_label(is_fraud: Column) -> Column:
    return F.when(is_fraud == 1, F.lit(FRAUD_STATUS)).otherwise(F.lit(SAFE_STATUS))


def amount_text(amount: Column) -> Column:
    """Two decimals, no grouping."""
    return F.format_string("%.2f", amount)
