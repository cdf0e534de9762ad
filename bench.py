"""Times the headline queries on local[$BENCH_CPUS] and prints one JSON line.

The layers are stored tables, built once and timed on their own (``bronze_build``,
``gold_build``); typing, quality and feature queries read stored Bronze and reports read
stored Gold, as in use. ``csv_to_gold`` is the whole layered run from a CSV file of the feed, with
profile, quarantine, identity and manifest. Results go to a sink that reads every row and
keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gustline import contract as K  # noqa: E402
from gustline.plans.layered import run_layers  # noqa: E402
from gustline.session import drop_staged, local_session, staged_path  # noqa: E402
from gustline.sources.delimited import export_csv  # noqa: E402
from gustline.workload import queries as registered  # noqa: E402

ON_BRONZE = (
    "snake_columns", "soft_profile", "quality_rate", "quarantine_rows", "silver_events",
    "layer_identity", "utility_features", "state_risk_summary",
)
ON_GOLD = (
    "kpi_row", "top_findings", "state_metric_saidi", "tier_by_ownership", "tier_quantiles",
    "score_histogram", "region_heat", "region_radar", "bubble_points", "ranking_table",
    "top_loss", "top_states", "compare_two", "centroid_lookup", "relabel_thresholds",
)
ON_TABLES = (
    "exposure_join", "parse_damage", "avg_pct_rank", "quantile_thresholds", "grouped_quantiles",
    "table_parity", "exact_difference", "binary_metrics",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    queries = registered.QUERIES
    seconds: dict[str, float] = {}

    def timed(name: str) -> None:
        started = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)

    queries["exposure_join"](spark, sf_dir).count()  # start the engine
    for name in ON_TABLES:
        timed(name)
    for label, build, names in (
        ("bronze_build", registered.bronze, ON_BRONZE),
        ("gold_build", registered.gold, ON_GOLD),
    ):
        started = time.time()
        build(spark, sf_dir)
        seconds[label] = round(time.time() - started, 3)
        for name in names:
            timed(name)
    raw = export_csv(registered.bronze(spark, sf_dir).drop(K.ROW_ID), staged_path(spark, "bench-csv"))
    started = time.time()
    run_layers(spark, raw, staged_path(spark, "bench-layers"))
    seconds["csv_to_gold"] = round(time.time() - started, 3)
    drop_staged(spark)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
