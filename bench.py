"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fallowlens import catalog  # noqa: E402
from fallowlens.session import local_session  # noqa: E402

HEADLINE = (
    "seed_features",
    "pixel_features",
    "pixel_timeseries",
    "spectral_indices",
    "last_of_day",
    "median_mosaic",
    "least_cloud_mosaic",
    "window_join",
    "resample_nearest",
    "stack_to_pixels",
    "composite_grid",
    "error_quarantine",
    "survey_join",
    "lookup_describe",
    "training_table",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries = catalog.queries()
    seconds: dict[str, float] = {}

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold = run("seed_features")
    for name in HEADLINE:
        seconds[name] = run(name)
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "seed_features_cold": cold,
                "seed_features_obs_per_sec": round(rows / seconds["seed_features"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
