"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query is computed completely into Spark's no-op sink.  Two small queries
run first so that the figures do not include the start of the JVM.
``BENCH_QUERIES`` (comma-separated prefixes, or ``all``) changes the selection.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from finecast.session import local_session  # noqa: E402

HEADLINE = (
    "flagship_history_on_forecast", "w02_rolling_past_only", "w03_rain_sums_wet_days", "w03_long_series_in_pieces",
    "w05_lookback_own_anchor", "w08_allocation_weights", "w09_block_median_anomaly", "w10_spatial_score",
    "i02_append_new", "i03_upsert_latest", "i04_conflicts", "i05_missing_keys", "p05_clean", "p16_complete_days",
    "j01_daily_master", "j02_training_base", "j03_merge_one_to_one", "j05_expand_entities", "j08_polygon_membership",
    "j10_neighbours", "j12_cross_overlaps", "j17_asof_strict", "j18_match_rates", "a01_daily_forecast",
    "a07_zonal_stats", "a09_monthly_composite", "a11_sar_profile", "a15_column_profile", "a18_observation_qc",
    "a21_distribution", "a24_category_errors", "a25_extreme_share", "a26_regression_metrics", "f02_stage_two_frame",
    "f03_horizon_dataset", "m01_date_split", "m02_row_split", "m05_median_imputation", "q05_verify_history",
    "q09_training_audit_pass", "r01_weather_risks", "r02_advisories", "r04_scenarios", "j20_serving_assembly",
    "z01_incremental_archive", "z02_daily_completeness",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, partitions=max(int(cpus), 1) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    from finecast.plans.catalog import QUERIES

    wanted = os.environ.get("BENCH_QUERIES", "")
    if wanted == "all":
        names = list(QUERIES)
    elif wanted:
        names = [n for n in QUERIES if any(n.startswith(p) for p in wanted.split(","))]
    else:
        names = [n for n in HEADLINE if n in QUERIES]
    for n in ("u02_distinct_keys", "w01_lags"):
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for n in names:
        start = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[n] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
