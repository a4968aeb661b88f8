"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from plumbline import build_session
from plumbline.queries import all_queries

HEADLINE = (
    "value_counts_event_type",
    "stats_by_category_target",
    "stats_over_time",
    "numeric_summary_targets",
    "summaries_of_columns",
    "categorical_summary_targets",
    "bins_quantile",
    "target_rates_per_bin",
    "boxplot_stats_time",
    "psi_numeric",
    "psi_categorical",
    "kl_numeric",
    "recency_rank",
    "dense_user_ids",
    "pos_neg_union",
    "split_label_counts",
    "join_user_item_features",
    "frequency_encoded",
    "topk_recommendations",
    "metric_table",
    "learning_curve",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    shared = tempfile.TemporaryDirectory(prefix="plumbline-bench-")
    spark = build_session(
        "plumbline-bench",
        spark__checkpoint__dir=shared.name,
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry, times = all_queries(), {}
    # One untimed query starts the JVM's code generation.
    registry["value_counts_event_type"](spark, sf_dir).write.format("noop").mode(
        "overwrite"
    ).save()
    for name in HEADLINE:
        start = time.perf_counter()
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()
    shared.cleanup()


if __name__ == "__main__":
    main()
