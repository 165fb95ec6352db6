"""Headline timings: prints one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plotloom.plans import catalog  # noqa: E402
from plotloom.session import build_session  # noqa: E402

HEADLINE = [
    "comparison_table", "worst10", "colour_verdict", "coverage_status", "last_error_per_key", "lookup_exact_then_parent",
    "trusted_neighbours", "mutual_adjacency", "rank_poses", "runner_up_support", "classify_lines", "scale_from_dimensions",
    "size_bands", "template_match", "ring_measures", "outline_samples", "edge_table", "rigid_fit", "jackknife_heading",
    "label_to_polygon", "nearest_sample", "close_pairs", "overlap_ledger", "hausdorff", "dissolve_outline",
    "stream_latest_verdict",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", "plotloom-bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.sql.adaptive.coalescePartitions.enabled": "false"})    # keep every core busy
    spark.range(1).count()
    qs, took = catalog.queries(), {}
    for key in only:
        t0 = time.time()
        qs[key](spark, sf_dir).write.mode("overwrite").format("noop").save()
        took[key] = round(time.time() - t0, 3)
        print(f"{key}: {took[key]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
