"""Time the headline queries and print one JSON line: seconds of the first run, and of a second one.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default all)
    BENCH_QUERIES  comma-separated names, or "all"
    BENCH_AGAIN    seconds of first runs up to which a query runs a second time (default 20)
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from citygrain.queries import QUERIES
from citygrain.session import build_session

HEADLINE = [
    "flood_exposure_by_settlement_year",
    "hazard_composite",
    "dense_population_exposed",
    "raster_histogram",
    "land_cover_frequency",
    "land_cover_burnability",
    "fire_weather_weekly",
    "vegetation_index",
    "coarsened_classes",
    "terrain_slope",
    "clip_touched",
    "resampled_population",
    "street_hazard_exposure",
    "points_in_zones",
    "zones_by_country",
    "nearest_node",
    "nearest_zone_outline",
    "place_density",
    "ways_to_edges",
    "intersection_delays",
    "near_duplicate_edges_dropped",
    "facility_reach",
    "od_between_points",
    "contracted_chains",
    "edge_betweenness",
    "gravity_demand",
    "facilities_for_coverage",
    "significant_earthquakes",
    "flood_magnitudes",
    "benchmark_cities",
    "quantile_breaks",
    "demographic_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    asked = os.environ.get("BENCH_QUERIES")
    names = HEADLINE if not asked else list(QUERIES) if asked == "all" else asked.split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # one machine; a cluster names a folder that all executors share
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-checkpoints-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the engine before the clock runs
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    again: dict[str, float] = {}
    limit = float(os.environ.get("BENCH_AGAIN", "20"))
    for name in names:
        started = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - started, 3)
            if seconds[name] <= limit:
                started = time.time()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                again[name] = round(time.time() - started, 3)
            print(f"{seconds[name]:8.2f} {again.get(name, 0):8.2f} {name}", file=sys.stderr, flush=True)
        except Exception as error:  # a failing query must not hide the others
            failed[name] = str(error)[:200]
    scale = re.search(r"sf([\d.]+)", sf_dir)
    result = {
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "second_run": again,
        "sf": float(scale.group(1)) if scale else None,
        "cpus": int(cpus),
        "shuffle_partitions": int(cpus),
    }
    if "edge_betweenness" in seconds:
        # every supplier is a source
        sources = spark.read.parquet(f"{sf_dir}/supplier.parquet").count()
        result["betweenness_sources_per_sec"] = round(sources / seconds["edge_betweenness"], 2)
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
