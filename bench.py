"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads.  Every result is
computed in full and thrown away.  Queries run once to warm up and then three
times, of which the median counts; the long jobs run once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from cardlens.plans.train import train  # noqa: E402
from checks.queries import AS_OF, QUERIES  # noqa: E402
from checks.tables import transactions  # noqa: E402

REPEATED = (
    "kpi_overview", "daily_trend", "missing_values", "amount_quantiles", "amount_quantiles_approx",
    "high_risk_customers", "fraud_profile", "category_fraud", "state_fraud", "fraud_distribution",
    "category_avg", "haversine", "enrich_history", "model_features", "customer_dim", "upsert_latest",
    "column_mode", "mode_impute", "value_counts", "balance", "split", "live_stats", "recent_fraud",
    "category_top", "fraud_points", "alerts_by_day", "alert_rate_5m", "detection_rate_60",
    "score_rule", "class_metrics", "exact_auc", "table_profile", "decode_messages",
)
ONCE = ("stream_alerts", "stream_totals", "csv_source", "import_tables", "log_structured_upserts")


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def consume(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in REPEATED:
        consume(name)
        seconds[name] = statistics.median(timed(lambda: consume(name)) for _ in range(3))
        print(f"{name} {seconds[name]:.2f}", file=sys.stderr, flush=True)
    for name in ONCE:
        seconds[name] = timed(lambda: consume(name))
        print(f"{name} {seconds[name]:.2f}", file=sys.stderr, flush=True)

    trees, depth = int(os.environ.get("BENCH_TREES", "100")), int(os.environ.get("BENCH_DEPTH", "10"))
    fitted = {}
    seconds["train_forest"] = timed(
        lambda: fitted.update(result=train(transactions(spark, folder), AS_OF, num_trees=trees, max_depth=depth))
    )
    scores = {row["on"]: row.asDict() for row in fitted["result"].metrics.collect()}

    rows = transactions(spark, folder, "trans_num").count()
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(value, 3) for name, value in seconds.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "transactions": rows,
                "enrich_rows_per_sec": round(rows / seconds["enrich_history"]),
                "stream_rows_per_sec": round(events / seconds["stream_alerts"]),
                "forest": {"trees": trees, "depth": depth, **{f"auc_{on}": round(s["auc"], 4) for on, s in scores.items()}},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
