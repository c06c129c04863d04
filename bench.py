"""Benchmark: the pipeline's headline queries on one scale factor.

Runs every stage in pipeline order on ``local[$BENCH_CPUS]`` against
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1); each query is fully
materialised with the ``noop`` sink. Stages share persisted intermediates
exactly as one pipeline run does, so the total is the end-to-end time.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "frontmatter_split", "sections", "facts", "image_resolution", "term_weights", "section_neighbours",
    "fact_neighbours", "request_grid", "partner_sections", "rendered_prompts", "chat_requests",
    "parsed_responses", "failed_sections", "retry_first_success", "chat_records", "type_stats",
    "invalid_images", "dataset_verdict",
]


def main() -> None:
    from mdquarry.plans.queries import QUERIES
    from mdquarry.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="mdquarry-bench")
    times: dict[str, float] = {}
    t_all = time.time()
    for name in HEADLINE:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    total = round(time.time() - t_all, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "pipeline_wall_time", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
